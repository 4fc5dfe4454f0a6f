"""A vector collection stored as a table: ``id, content, embedding, metadata``
(any extra columns are kept).  Adding is idempotent on ``id``; querying is the
exact kNN join.

Layout: ``rows/commit=c`` holds the rows of a commit, ``ids/commit=c/bucket=b`` their
ids alone, by a hash of the id, and ``log`` one line for each commit, written last.
Readers see the commits of the log only, so an add that dies leaves nothing
behind.  An add reads the ids of the buckets that its own ids fall into (two
levels of folders are pruned), never the rows; so what it reads is bounded by its
own size times the size of a bucket, and ``buckets`` is chosen for the table to
come.  ``compact`` writes the ids of many commits as one and logs which folders that
replaces; ``add`` does so whenever ``MERGE_AT`` folders of ids have come together, as
each of them is listed by every later add.  An add that finds nothing new writes
no ids."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.knn import knn, metadata_filter
from tessera.sources.files import stored

BUCKETS = 64
#: Folders of ids that an add makes into one.
MERGE_AT = 4
LOG = "commit string, ids string, epoch string, replaces array<string>"


class Collection:
    def __init__(self, spark: SparkSession, path: str, id_col: str = "id", buckets: int = BUCKETS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.id_col = id_col
        self.buckets = buckets

    def log(self) -> list:
        """(commit, ids, epoch, replaces) of each line: a commit with the folder of its
        ids (if it has any), or ids that replace those of other folders."""
        try:
            return self.spark.read.schema(LOG).json(f"{self.path}/log").collect()
        except AnalysisException:
            return []

    def commits(self) -> list:
        """The lines of commits: rows lie under their ``commit``."""
        return [r for r in self.log() if r.commit is not None]

    def places(self) -> list[str]:
        """The folders that hold the ids of all commits."""
        log = self.log()
        return sorted({r.ids for r in log if r.ids} - {i for r in log for i in r.replaces or []})

    def exists(self) -> bool:
        return bool(self.commits())

    def frame(self) -> DataFrame:
        known = [r.commit for r in self.commits()]
        return self.spark.read.option("mergeSchema", True).parquet(*[f"{self.path}/rows/commit={c}" for c in known])

    def count(self) -> int:
        return self.frame().count() if self.exists() else 0

    def isEmpty(self) -> bool:  # noqa: N802 - as a DataFrame's
        return not self.exists() or self.frame().isEmpty()

    def known_ids(self, buckets: list[int]) -> DataFrame:
        """(id, bucket) of the stored rows in some buckets."""
        ids = self.spark.read.option("basePath", f"{self.path}/ids").parquet(*[f"{self.path}/ids/commit={c}" for c in self.places()])
        return ids.filter(F.col("bucket").isin(buckets)).select(self.id_col, "bucket")

    def add(self, batch: DataFrame, order: str | None = None, epoch: str | None = None) -> None:
        """Append the rows whose id is not stored yet.  Inside the batch the row that
        is first by ``order`` wins, among equals (or without it) the one whose JSON
        text is smallest, so replaying a batch changes nothing.  A batch with an
        ``epoch`` that the log has is not looked at again."""
        log = self.log()
        if epoch is not None and any(r.epoch == epoch for r in log):
            return
        cols = [c for c in batch.columns if c != self.id_col]
        if cols:
            key = F.struct(*([F.col(order).alias("o")] if order else []), F.to_json(F.struct(*cols)).alias("j"))
            batch = batch.groupBy(self.id_col).agg(F.min_by(F.struct(*cols), key).alias("_r")).select(self.id_col, "_r.*")
        else:
            batch = batch.distinct()
        name = uuid.uuid4().hex
        fresh = stored(batch.withColumn("bucket", F.pmod(F.xxhash64(self.id_col), F.lit(self.buckets)).cast("int")), "collection-batch")
        if any(r.ids for r in log):
            touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most the number of buckets
            known = self.known_ids(touched).hint("merge")  # as many as the table has: never sent to the driver
            fresh = stored(fresh.join(known, [self.id_col, "bucket"], "left_anti").select(*fresh.columns), "collection-new")
        fresh.drop("bucket").write.parquet(f"{self.path}/rows/commit={name}")
        if fresh.isEmpty():  # no ids to list
            return self._commit(name, None, epoch)
        fresh.select(self.id_col, "bucket").repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/ids/commit={name}")
        self._commit(name, name, epoch)
        if len(self.places()) >= MERGE_AT:
            self.compact()

    def _commit(self, name: str | None, ids: str | None, epoch: str | None, replaces: list[str] | None = None) -> None:
        self.spark.createDataFrame([(name, ids, epoch, replaces)], LOG).coalesce(1).write.mode("append").json(f"{self.path}/log")

    def compact(self) -> None:
        """One folder of ids for all commits so far (the rows stay where they are)."""
        name, places = uuid.uuid4().hex, self.places()
        self.known_ids(list(range(self.buckets))).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/ids/commit={name}")
        self._commit(None, name, None, places)

    def get(self, ids: DataFrame | list) -> DataFrame:
        if isinstance(ids, list):
            return self.frame().filter(F.col(self.id_col).isin(ids))
        return self.frame().join(ids.select(self.id_col), self.id_col, "left_semi")

    def query(self, queries: DataFrame, k: int, where: dict | None = None, **kw) -> DataFrame:
        coll = self.frame() if not where else metadata_filter(self.frame(), where)
        return knn(queries, coll, k, id_col=self.id_col, **kw)


def get_or_create(spark: SparkSession, path: str, seed: DataFrame, id_col: str = "id") -> Collection:
    """Open the collection at ``path``, creating it; documents are loaded only
    when it holds none (running twice gives the same rows)."""
    c = Collection(spark, path, id_col)
    if c.isEmpty():
        c.add(seed)
    return c
