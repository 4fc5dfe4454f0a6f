"""Ranked lexical search with hashed max-sketches.

*Index.*  Every document is reduced to its terms, their frequencies and a
*max-sketch*: a byte array of about ``SPREAD`` cells a distinct term into which
``MAPPINGS`` hash functions fold the term frequencies by coordinatewise maxima
(255 stands for 255 and more).  A term's frequency is at most the smallest of
its cells.  A term's impact grows with its frequency, so the cells bound impacts
as well, whatever the corpus statistics and the queries; those come later.
Document frequencies of all terms, the number of documents and of terms are
counted in the same pass.

*Search.*  Queries go in blocks of bounded size.  A task reads its part of the
index; for each batch of documents the terms of all queries are looked up in
each sketch at once and give an upper bound for every document and query.  Per
query the documents follow in order of falling bounds and are rescored exactly
from their terms until the bound is below the k-th best score that the task has
found so far.  k rows a query leave a task; a ``row_number() <= k`` window
merges them.  The rows are exact: a document is passed over only when its bound
is below k scores that are already certain.

Scores are integers: the weight w of a term is floor(1000 ln((2N+2)/(2df+1))),
a document's m is 100-75+((75*n*N) div L), and the score sums
w*((10^9*tf) div (1000*tf+8*m)) over the query's terms, repeats included.

Defined cases: a null or termless text has no terms, takes no part in N and is
never returned; a query without terms returns nothing; repeated query rows (same
id and text) are answered once, rows that share an id but not the text each on
their own; repeated documents each take a rank; equal scores by ascending id,
null ids last; texts are scored whole, of any length; empty tables give no
rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.files import scratch_path

# Terms are runs of ASCII letters and digits and of all characters
# beyond ASCII.  On UTF-8 bytes the class is the same; bytes.lower knows A-Z only.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Cells a distinct term (rounded up to a power of two) and hash functions.
SPREAD = 12
MAPPINGS = 3
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
#: Terms whose counts a task holds before it passes them on.
FLUSH = 150_000
TEXTS_AT_ONCE = 256
#: Most queries of a block, and bytes of their texts.
QUERY_BLOCK = 512
QUERY_BYTES = 4 << 20

_DOC = "doc_id long, n long, terms binary, tfs binary, sketch binary"
_INDEX = _DOC + ", term binary, df long, part string"


def terms_of(data: bytes | None) -> list[bytes]:
    return TERM.findall((data or b"").lower())


def cells(hashes: np.ndarray, log_width: int) -> np.ndarray:
    """Cell of each hash under each mapping: (mappings, hashes)."""
    return (hashes[None, :] * FACTORS[:MAPPINGS, None]) >> np.uint64(64 - log_width)


def sketch_of(terms: list[bytes], tfs: np.ndarray) -> np.ndarray:
    log_width = max(4, math.ceil(math.log2(SPREAD * len(terms))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, terms), dtype=np.uint64, count=len(terms))
    order = np.argsort(tfs, kind="stable")  # the last one written to a cell is its maximum
    out = np.zeros(1 << log_width, dtype=np.uint8)
    out[cells(hashes[order], log_width).T.ravel()] = np.repeat(np.minimum(tfs[order], 255), MAPPINGS)
    return out


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    """The part of a term's score that does not depend on its weight."""
    return (1_000_000_000 * tf) // (1_000 * tf + 8 * m)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted(df: dict) -> pa.RecordBatch:
        none = [pa.nulls(len(df), t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())]
        return pa.RecordBatch.from_arrays([*none, pa.array(list(df), pa.binary()), pa.array(list(df.values()), pa.int64()),
                                           pa.array(["term"] * len(df), pa.string())], names=names)  # none left: still of that type

    names = ["doc_id", "n", "terms", "tfs", "sketch", "term", "df", "part"]
    df: Counter = Counter()
    for whole in batches:
        for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
            batch, out = whole.slice(at, TEXTS_AT_ONCE), []
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = terms_of(data)
                if not words:
                    continue
                tf = Counter(words)
                df.update(tf.keys())
                terms = list(tf)
                tfs = np.fromiter(tf.values(), dtype=np.int64, count=len(tf))
                out.append((doc_id, len(words), b" ".join(terms), tfs.astype("<u4").tobytes(), zlib.compress(sketch_of(terms, tfs), 1)))
            if out:
                cols = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([*cols, pa.nulls(len(out), pa.binary()), pa.nulls(len(out), pa.int64()),
                                                  pa.array(["doc"] * len(out), pa.string())], names=names)
            pa.default_memory_pool().release_unused()
            if len(df) > FLUSH:
                yield counted(df)
                df = Counter()
    yield counted(df)


class Index:
    """The stored index: ``docs`` (doc_id, n, terms, tfs, sketch deflated, as most of
    its cells are 0 and whole batches of rows are held on their way), ``df`` (term, df),
    number of documents with terms and number of all their terms."""

    def __init__(self, docs: DataFrame, df: DataFrame):
        self.docs, self.df = docs, df
        self.n_docs, self.n_terms = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()


def build(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> Index:
    """Write the index of all documents to the shared folder, in one pass."""
    spark = docs.sparkSession
    path = scratch_path(spark, "lexical-index")
    made = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(_index, _INDEX)
    made.write.parquet(path)  # terms and documents share files, not columns: each reader takes its own
    stored = spark.read.schema(_INDEX).parquet(path)
    counts = stored.filter("part = 'term'").groupBy("term").agg(F.sum("df").alias("df"))
    return Index(stored.filter("part = 'doc'").drop("part", "term", "df"), counts)


class Block:
    """A block of queries as arrays: distinct terms with weights, and for each query
    its distinct terms (a slice of ``at``) with weight times repeats."""

    def __init__(self, items: list[tuple], df: dict[bytes, int], n_docs: int):
        counts = [(i, Counter(words)) for i, words in items]
        self.ids = [i for i, _ in counts]
        self.vocabulary = {t: k for k, t in enumerate(sorted({t for _, c in counts for t in c}))}
        terms = list(self.vocabulary)
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, terms), dtype=np.uint64, count=len(terms))
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in terms}
        self.at = np.array([self.vocabulary[t] for _, c in counts for t in c], dtype=np.int64)
        self.weights = np.array([weight[t] * k for _, c in counts for t, k in c.items()], dtype=np.int64)
        self.starts = np.cumsum([0] + [len(c) for _, c in counts])[:-1]

    def sums(self, impact: np.ndarray) -> np.ndarray:
        """Every query's score from the impacts of the distinct terms."""
        return np.add.reduceat(impact[self.at] * self.weights, self.starts)


def _searcher(block: Block, k: int, n_docs: int, n_terms: int):
    tf_values = np.arange(256, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in block.ids]
        floor = np.ones(len(block.ids), dtype=np.int64)  # scores above 0 only
        where: dict[int, np.ndarray] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                ids, lengths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                m = [100 - 75 + (75 * n * n_docs) // n_terms for n in lengths]
                bound = np.empty((len(ids), len(block.ids)), dtype=np.int64)
                for d in range(len(ids)):
                    sketch = np.frombuffer(zlib.decompress(batch.column(4)[d].as_buffer()), dtype=np.uint8)
                    log_width = len(sketch).bit_length() - 1
                    if log_width not in where:
                        where[log_width] = cells(block.hashes, log_width)
                    most = impacts(tf_values, m[d])
                    most[255] = 1_000_000  # of any frequency
                    bound[d] = block.sums(most[sketch[where[log_width]].min(axis=0)])
                exact: dict[int, np.ndarray] = {}
                for q in np.flatnonzero((bound >= floor).any(axis=0)).tolist():
                    near = np.flatnonzero(bound[:, q] >= floor[q])
                    for d in near[np.argsort(-bound[near, q], kind="stable")].tolist():
                        if bound[d, q] < floor[q]:
                            break
                        if d not in exact:
                            exact[d] = rescored(batch, d, m[d])
                        score = int(exact[d][q])
                        if score >= floor[q]:
                            insort(best[q], (-score, ids[d] is None, ids[d] or 0))
                            del best[q][k:]
                            if len(best[q]) == k:
                                floor[q] = -best[q][-1][0]
                pa.default_memory_pool().release_unused()
        rows = [(q, None if none else i, -s) for q, found in enumerate(best) for s, none, i in found]
        q, i, s = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array([block.ids[x][0] for x in q], pa.int64()), pa.array([block.ids[x][1] for x in q], pa.int64()),
                                          pa.array(i, pa.int64()), pa.array(s, pa.int64())], names=["no", "item_id", "doc_id", "score"])

    def rescored(batch: pa.RecordBatch, d: int, m: int) -> np.ndarray:
        """Exact scores of one document for all queries of the block."""
        known = [block.vocabulary.get(t, -1) for t in batch.column(2)[d].as_py().split(b" ")]
        at = np.array(known, dtype=np.int64)
        tf = np.frombuffer(batch.column(3)[d].as_buffer(), dtype="<u4").astype(np.int64)
        impact = np.zeros(len(block.vocabulary), dtype=np.int64)
        impact[at[at >= 0]] = impacts(tf[at >= 0], m)
        return block.sums(impact)

    return run


def search(index: Index, items: DataFrame, k: int = 10, item: str = "item_id", text: str = "text",
           query_block: int = QUERY_BLOCK, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents."""
    spark = items.sparkSession
    data = F.col("_text").cast("binary")
    asked = items.select(F.col(item).cast("long").alias("item_id"), F.col(text).alias("_text")).filter("_text is not null").distinct()
    n, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(data)), F.lit(0))).first()
    blocks = max(-(-n // query_block), -(-size // query_bytes))
    found = spark.createDataFrame([], "no long, item_id long, doc_id long, score long")
    no = 0
    for b in range(blocks if index.n_docs else 0):
        own = asked.filter(F.pmod(F.xxhash64("item_id", "_text"), F.lit(blocks)) == b)
        queries = [(i, w) for i, w in ((r.item_id, terms_of(bytes(r.data))) for r in own.select("item_id", data.alias("data")).collect()) if w]
        if not queries:
            continue
        queries = [((no + j, i), w) for j, (i, w) in enumerate(queries)]
        no += len(queries)
        wanted = spark.createDataFrame([(t,) for t in {t for _, w in queries for t in w}], "term binary")
        df = {bytes(r.term): r.df for r in index.df.join(F.broadcast(wanted), "term", "left_semi").collect()}
        block = Block(queries, df, index.n_docs)
        found = found.unionByName(index.docs.mapInArrow(_searcher(block, k, index.n_docs, index.n_terms),
                                                        "no long, item_id long, doc_id long, score long"))
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
