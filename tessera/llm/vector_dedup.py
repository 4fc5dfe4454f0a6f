"""Embedding near-dedup: random-hyperplane signs in several tables, exact cosine
verification, connected components.

1. Equal vectors are one *class* (its smallest id, its number of rows); all later
   steps see classes, so exact copies cost one row however many they are.
2. ``tables`` times ``bits`` random hyperplanes through the origin give each class
   a bucket per table: the signs of its products with the table's planes.  Two
   vectors at the threshold fall on one side of a plane with probability
   1 - acos(threshold)/pi; ``plan`` takes bits so that a bucket of unrelated
   vectors stays near ``BUCKET`` rows as the table grows, and as many tables as a
   pair at the threshold needs to meet with probability ``RECALL``.
3. A bucket is one group, or, beyond ``BLOCK`` rows, the pairs of its blocks (dealt
   by a hash of the class), so a hot bucket is many bounded tasks.  A group
   computes its exact cosines by matrix products in double precision.  A pair is
   counted in the first table in which it meets (a group knows the buckets of its
   rows in all tables), so no pair is counted twice and none leaves a task: a
   group returns, per class, the rows it is linked to and one link of a spanning
   forest.
4. Links are summed by class; the forests' links are contracted by alternating
   stars, and every row gets its class's figures by a join on the vector.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components are linked with nothing (0 links, their own component); vectors of
different lengths are not linked; repeated rows are vectors of their own and
linked with each other; a null id is no smallest id, and the component of null
ids alone is null (kept, as id and component are both null); components of any
finite size are scaled first, so that norms neither overflow nor vanish; an
empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import partitions, stored
from tessera.llm.simhash_dedup import _labels, stars

THRESHOLD = 0.9
#: Probability that a pair exactly at the threshold meets in a table.
RECALL = 0.999
#: Unrelated vectors expected in a bucket, and most rows of a block.
BUCKET = 512
BLOCK = 4_096
#: Crowded buckets up to which their table is broadcast; beyond, it is joined by a shuffle.
CROWDED = 100_000
CHUNK = 256  # rows whose products are held at a time
SEED = 11


def plan(rows: int, threshold: float = THRESHOLD, recall: float = RECALL, bucket: int = BUCKET) -> tuple[int, int]:
    """(bits, tables) for so many classes."""
    bits = min(30, max(4, math.ceil(math.log2(max(1, rows) / bucket))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def links_with_others(vec: Column) -> Column:
    """Whether a vector can be linked at all."""
    number = ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vec.isNotNull() & number & F.exists(vec, lambda x: x != 0), F.lit(False))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _signer(bits: int, tables: int):
    power = 1 << np.arange(bits, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for whole in batches:
            size = np.array([len(v) for v in whole.column("vec")], dtype=np.int64)
            for width in np.unique(size).tolist():
                batch = whole.filter(pa.array(size == width))
                if width not in planes:
                    planes[width] = np.random.default_rng([SEED, width]).standard_normal((width, tables * bits))
                x = unit(_matrix(batch.column("vec")))
                side = (x @ planes[width] > 0).reshape(len(x), tables, bits)
                signs = (side @ power).astype(np.int32)
                offsets = pa.array(np.arange(0, signs.size + 1, tables), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(signs.ravel()))], names=[*batch.schema.names, "signs"])

    return run


def _verify(threshold: float):
    def group(t: pa.Table) -> pa.Table:
        x, signs = unit(_matrix(t["vec"])), _matrix(t["signs"])
        key, rows, own = (t[c].to_numpy() for c in ("key", "n", "own"))
        table, halves = t["tab"][0].as_py(), t["a"][0] != t["b"][0]
        linked, left, right = np.zeros(len(x), dtype=np.int64), [], []
        for at in range(0, len(x), CHUNK):
            i, j = np.nonzero(x[at:at + CHUNK] @ x[at:].T >= threshold)
            i, j = i[j > i] + at, j[j > i] + at
            fresh = own[i] != own[j] if halves else np.ones(len(i), dtype=bool)
            for earlier in range(table):
                fresh &= signs[i, earlier] != signs[j, earlier]
            i, j = i[fresh], j[fresh]
            linked += np.bincount(i, rows[j], len(x)).astype(np.int64) + np.bincount(j, rows[i], len(x)).astype(np.int64)
            if len(i):  # a forest of the chunk's links is enough
                lab = _labels(len(x), i, j)
                far = np.flatnonzero(lab != np.arange(len(x)))
                left.append(far)
                right.append(lab[far])
        forest = _labels(len(x), *(np.concatenate(s) if s else np.zeros(0, dtype=np.int64) for s in (left, right)))
        told = linked > 0
        return pa.table({"key": key[told], "links": linked[told], "root": key[forest[told]]})

    return group


def found_links(classes: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(key, links, root) of every class and group in which it has links: rows
    linked there, and a class of its part of the group."""
    bits, tables = plan(classes.count(), threshold)
    signed = stored(classes.mapInArrow(_signer(bits, tables), "key long, vec array<{}>, n long, signs array<int>".format(
        classes.schema["vec"].dataType.elementType.simpleString())), "vectors-signed")
    bucket = [F.size("vec").alias("width"), F.posexplode("signs").alias("tab", "bucket")]
    many = stored(signed.select(*bucket).groupBy("width", "tab", "bucket").agg(F.count(F.lit(1)).alias("_size")).filter(f"_size > {block}"),
                  "vectors-crowded")
    many = F.broadcast(many) if many.count() <= CROWDED else many.hint("merge")
    dealt = signed.select("key", "vec", "n", "signs", *bucket).join(many, ["width", "tab", "bucket"], "left")
    parts = F.expr(f"cast((coalesce(_size, 1L) + {block - 1}) div {block} as int)")
    cells = dealt.withColumn("_parts", parts).withColumn("own", F.pmod(F.xxhash64("key"), F.col("_parts")).cast("int")).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    cells = cells.select("key", "vec", "n", "signs", "width", "tab", "bucket", "own",
                         F.least("own", "_other").alias("a"), F.greatest("own", "_other").alias("b"))
    where = ["width", "tab", "bucket", "a", "b"]
    return cells.repartition(partitions(cells), *where).groupBy(*where).applyInArrow(
        _verify(threshold), "key long, links long, root long")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", threshold: float = THRESHOLD,
                    block: int = BLOCK) -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept)."""
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vec).alias("vec"))
    able = links_with_others(F.col("vec"))
    alone = rows.filter(~able).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    able_rows = rows.filter(able)
    classes = stored(able_rows.groupBy("vec").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
                     .withColumn("key", F.monotonically_increasing_id()), "vectors-classes")
    found = stored(found_links(classes.select("key", "vec", "n"), threshold, block), "vectors-links")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    edges = found.filter("key <> root").select(F.greatest("key", "root").alias("u"), F.least("key", "root").alias("v")).distinct()
    root = stars(edges).select(F.col("u").alias("key"), F.col("v").alias("root"))
    rooted = stored(classes.select("key", "first", "n").join(links, "key", "left").join(root, "key", "left").select(
        "key", "first", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "key").alias("root")),
        "vectors-rooted")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_class = rooted.join(smallest, "root").select("key", "n_links", "component_id")
    by_vector = classes.select("key", "vec").join(by_class, "key").select("vec", "n_links", "component_id")
    whole = able_rows.join(by_vector, "vec").select("id", "n_links", "component_id").unionByName(alone)
    return whole.select(F.col("id").alias(vec_id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
