"""Exact top-k inner-product search by the three-phase uniform threshold.

A vector's score for a query is the sum of partial scores over ``lists`` blocks
of dimensions, so every candidate block holds one *local score list* per
dimension block.

1. *Gather*: each candidate block reports, per query, the exact scores of the
   entries at the head (top k) of each local list.  The k-th best of all the
   reported scores is a lower bound of the final k-th score: a safe cutoff.
2. *Collect*: the cutoff travels with its query to every candidate block.  A
   vector whose total reaches it has at least one partial score of cutoff/lists
   (the uniform threshold), so entries under the threshold in all lists are
   out.  Each list that did not report an entry adds at most the threshold to
   its upper bound; entries whose bound stays under the cutoff go as well.
3. *Resolve*: the remaining entries get exact scores; per block at most k rows
   a query leave (ties by smaller id), and a ``row_number() <= k`` window
   merges them.

Queries and candidates meet in blocks of bounded size: each query block is
dealt to every candidate block by a shuffle (no cross join, nothing through the
driver), and blocks are dealt by a hash of the row, so no id makes a hot block.

Defined cases: vectors that are null, or hold null or non-finite components,
take no part; an empty vector scores 0 with all; vectors of different lengths
meet on their common components (missing ones are 0); components and scores
saturate at the limits of long; repeated rows (same id and vector) take a rank
each; of several vectors under one query id the smallest (array order) is
the query, and every row of that id is its own and no candidate; null ids take
no part; equal scores are ordered by smaller id, then vector; fewer than k
candidates give them all; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import partitions, stored

SCALE = 64
#: Most bytes of vectors in a query block and in a candidate block.
QUERY_BYTES = 8 << 20
CANDIDATE_BYTES = 32 << 20
LISTS = 2
CHUNK = 64  # queries whose scores are held at a time
EXACT = 2**53


def quantised(vec: Column) -> Column:
    """floor(64 * x) of every component as long; null when the vector takes no part."""
    ok = vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    top = F.lit(float(2**63))
    whole = lambda x: F.when(x >= top, F.lit(2**63 - 1)).when(x <= -top, F.lit(-(2**63))).otherwise(F.floor(x))
    return F.when(ok, F.transform(vec, lambda x: whole(x.cast("double") * F.lit(float(SCALE)))))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _pair(q: pd.DataFrame, c: pd.DataFrame):
    """Query and candidate matrices in a type that is exact for their products."""
    width = max(max(map(len, q["vec"])), max(map(len, c["vec"])), 1)
    a, b = _matrix(q["vec"], width), _matrix(c["vec"], width)
    size = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
    top = size(a) * size(b) * width
    if top < 2**24:
        return a.astype(np.float32), b.astype(np.float32)
    if top < EXACT:
        return a.astype(np.float64), b.astype(np.float64)
    return a.astype(object), b.astype(object)


def _slices(width: int, lists: int) -> list[slice]:
    edges = np.linspace(0, width, min(lists, width) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]


def _long(x) -> int:
    return int(max(-(2**63), min(2**63 - 1, int(x))))


def _gather(k: int, lists: int):
    def phase1(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        cols = ["query_id", "score"]
        if not len(q) or not len(c):
            return pd.DataFrame({x: pd.Series(dtype="int64") for x in cols})
        a, b = _pair(q, c)
        qid, cid = q["id"].to_numpy(), c["id"].to_numpy()
        out_q, out_s = [], []
        for at in range(0, len(a), CHUNK):
            rows = slice(at, at + CHUNK)
            own = qid[rows, None] == cid[None, :]
            heads = []
            for s in _slices(a.shape[1], lists):
                part = a[rows, s] @ b[:, s].T
                part = np.where(own, -np.inf, part) if part.dtype != object else np.where(own, -(2**200), part)
                heads.append(np.argpartition(-part, k - 1, axis=1)[:, :k] if len(b) > k else
                             np.broadcast_to(np.arange(len(b)), part.shape))
            for i in range(own.shape[0]):
                entries = np.unique(np.concatenate([h[i] for h in heads]))
                entries = entries[~own[i, entries]]
                scores = np.sort(b[entries] @ a[at + i])[::-1][:k]
                out_q += [qid[at + i]] * len(scores)
                out_s += [_long(x) for x in scores]
        return pd.DataFrame({"query_id": out_q, "score": out_s}, columns=cols)

    return phase1


def _resolve(k: int, lists: int):
    def phases23(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        cols = ["query_id", "vec_id", "score", "copies"]
        if not len(q) or not len(c):
            return pd.DataFrame({x: pd.Series(dtype="int64") for x in cols})
        a, b = _pair(q, c)
        qid, cid, copies = q["id"].to_numpy(), c["id"].to_numpy(), c["copies"].to_numpy()
        cut = q["cutoff"].to_numpy(dtype=object)
        parts_of = _slices(a.shape[1], lists)
        out = []
        for at in range(0, len(a), CHUNK):
            rows = slice(at, at + CHUNK)
            floor = np.array([-(2**200) if x is None or x != x else int(x) for x in cut[rows]], dtype=object)
            level = floor if a.dtype == object else floor.astype(np.float64)
            level = level[:, None]
            threshold = level / len(parts_of) if a.dtype != object else level // len(parts_of)
            bound, seen = None, None
            for s in parts_of:
                part = a[rows, s] @ b[:, s].T
                listed = part >= threshold
                upper = np.where(listed, part, threshold)
                bound = upper if bound is None else bound + upper
                seen = listed if seen is None else seen | listed
            left = seen & (bound >= level) & (qid[rows, None] != cid[None, :])
            for i in range(left.shape[0]):
                entries = np.flatnonzero(left[i])
                if not len(entries):
                    continue
                scores = b[entries] @ a[at + i]
                if a.dtype != object:
                    scores = scores.astype(np.int64)
                order = np.lexsort((cid[entries], -scores))[:k]
                out += [(qid[at + i], cid[entries[j]], _long(scores[j]), copies[entries[j]]) for j in order]
        return pd.DataFrame(out, columns=cols).astype("int64")

    return phases23


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, lists: int = LISTS,
          query_bytes: int = QUERY_BYTES, candidate_bytes: int = CANDIDATE_BYTES) -> DataFrame:
    """``vectors`` and ``queries`` hold (id long, vec array<long>).  Returns
    (query_id, rank, vec_id, score).  Blocks are bounded in bytes whatever the
    table size; small tables are cut finer, so that all cores have a block."""
    c = stored(vectors.filter("id IS NOT NULL AND vec IS NOT NULL").groupBy("id", "vec").agg(
        F.count(F.lit(1)).alias("copies")), "topk-vectors")
    q = stored(queries.filter("id IS NOT NULL AND vec IS NOT NULL").groupBy("id").agg(F.min("vec").alias("vec")), "topk-queries")
    n = partitions(c)
    rows, width = c.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vec")), F.lit(1))).first()
    n_q = max(1, -(-q.count() * 8 * max(1, width) // query_bytes))
    n_c = max(1, -(-rows * 8 * max(1, width) // candidate_bytes), min(n, rows // 1024))
    deal = lambda m: F.pmod(F.xxhash64("id", "vec"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    n = max(n, min(n_q * n_c, 4 * n))
    candidates = c.withColumn("cb", deal(n_c)).withColumn("qb", every(n_q)).repartition(n, "qb", "cb").groupBy("qb", "cb")

    def meet(side: DataFrame, phase, schema: str) -> DataFrame:
        dealt = side.withColumn("qb", deal(n_q)).withColumn("cb", every(n_c)).repartition(n, "qb", "cb")
        return dealt.groupBy("qb", "cb").cogroup(candidates).applyInPandas(phase, schema)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    heads = meet(q, _gather(k, lists), "query_id long, score long").withColumn("_n", F.row_number().over(best))
    cutoffs = heads.filter(F.col("_n") <= k).groupBy("query_id").agg(
        F.when(F.count("score") >= k, F.min("score")).alias("cutoff"))
    cut_q = stored(q.join(cutoffs, q["id"] == cutoffs["query_id"], "left").select("id", "vec", "cutoff"), "topk-cutoffs")
    found = meet(cut_q, _resolve(k, lists), "query_id long, vec_id long, score long, copies long").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k)))))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
