"""Exact and approximate k-nearest-neighbour joins between a query frame and a
vector collection.

*Exact* (``knn``, ``knn_self``).  A query batch whose size is checked to be small
(``BROADCAST_QUERY_BYTES``) is broadcast and the collection is scored in place
by ``mapInArrow``: it is never shuffled, and at most k rows a query leave a
task.  With many queries a collection within that size is broadcast instead, and k
rows a query leave in all.  Larger batches meet the collection in *pivot cells*:

* pivots are a bounded sample of the collection; every vector goes to the cell of
  its nearest pivot, once;
* a query is scored in its own cell first; the k-th best score there bounds
  how far its neighbours can be;
* a cell can be passed over when no vector in it can be as near as that bound:
  by the triangle inequality with the cell's smallest and largest distance to its
  pivot, or by the plane half-way between the two pivots.  A query is copied
  to the remaining cells only; the collection is not copied (only a cell that
  very many queries want is dealt to several tasks);
* a query for which the cells left hold half of all vectors, as where the data have
  no groups, takes the collection in a few *wide* blocks of 32 MB instead: it is
  copied as often as there are such blocks, not cells.

*Approximate* (``knn_lsh``).  Same cells, but the routing and a filter are fitted
on a sample: from the exact neighbours of ``SAMPLE_QUERIES`` queries come the
distance to a cell's border within which neighbours lie, and the Hamming distance
of bit sketches (signs on planes through the collection's mean direction) within
which they lie.  Only pairs inside both are scored.  Planes, centres and sketches
are integers, so every engine computes the same candidates.

The cosine of a zero vector is 0 with everything.  Rows without a vector take no
part.  Scores are ranked after rounding to ``RANK_DECIMALS``, equal ones by id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.files import stored

# Rows scored per matrix product: a 2048 x 2048 float64 score chunk is 32 MiB.
CHUNK_ROWS = 2048
# A query batch at most this large (count x dim x 8 bytes, checked before
# anything is collected) is broadcast and the collection is scored where it
# lies, without being shuffled; larger batches take the pivot cells.
BROADCAST_QUERY_BYTES = 64 << 20
# Vectors a cell aims at, most vectors and most bytes of a block of a cell, queries
# of a cell that one task scores, most bytes of all pivots (they are broadcast).
CELL_ROWS = 2048
BLOCK_ROWS, BLOCK_BYTES = 4096, 32 << 20
QUERY_ROWS = 65_536
# Numbers of a matrix that a task holds while it compares rows with centres or a
# block, and rows of a batch of routed queries, however many cells they go to.
MATRIX_CELLS = 1 << 20
# Pairs scored one by one at once, and fewest queries of a part of a wide cell.
EXACT_PAIRS = 1 << 16
WIDE_QUERIES = 4096
ROUTED_ROWS = 8192
PIVOT_BYTES = 64 << 20
# Scores are ranked after rounding to this many decimals, so that
# mathematically equal scores (duplicate or collinear vectors) tie exactly
# and fall back to the id order instead of to floating-point noise.
RANK_DECIMALS = 12


def _matrix(tbl: pa.Table, col: str) -> np.ndarray:
    arr = tbl.column(col).combine_chunks()
    n = len(arr)
    if n == 0:
        return np.zeros((0, 0))
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1)


def _ids(tbl: pa.Table, col: str) -> np.ndarray:
    return tbl.column(col).combine_chunks().to_numpy(zero_copy_only=False)


def _order_codes(ids: np.ndarray) -> np.ndarray:
    """Integer codes preserving the natural order of the ids (for tie-breaks)."""
    if ids.dtype.kind in "iu":
        return ids.astype(np.int64)
    _, codes = np.unique(ids, return_inverse=True)
    return codes.astype(np.int64)


def _topk_sparse(rows: np.ndarray, scores: np.ndarray, codes: np.ndarray, k: int):
    """Among candidate triples keep, per row, the k best by (score desc, id asc)."""
    order = np.lexsort((codes, -scores, rows))
    rows, scores, codes = rows[order], scores[order], codes[order]
    first = np.searchsorted(rows, rows, side="left")
    keep = (np.arange(len(rows)) - first) < k
    return order[keep], rows[keep]


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def _scores(q: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    """Scores of which the larger are better: cosine of unit vectors, or the
    negative squared distance."""
    s = q @ c.T
    if metric != "cosine":
        s = -(np.einsum("ij,ij->i", q, q)[:, None] - 2.0 * s + np.einsum("ij,ij->i", c, c)[None, :])
    return np.round(s, RANK_DECIMALS)


def _best(s: np.ndarray, k: int) -> np.ndarray:
    """Mask of the finite scores that reach their row's k-th best."""
    if s.shape[1] > k:
        return (s >= -np.partition(-s, k - 1, axis=1)[:, k - 1][:, None]) & np.isfinite(s)
    return np.isfinite(s)


def _exact(q: np.ndarray, x: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Cosines of single pairs of unit vectors, in double precision."""
    out = np.empty(len(rows))
    for at in range(0, len(rows), EXACT_PAIRS):
        some = slice(at, at + EXACT_PAIRS)
        out[some] = np.einsum("ij,ij->i", q[rows[some]], x[cols[some]])
    return np.round(out, RANK_DECIMALS)


def _top_of_block(q: np.ndarray, x: np.ndarray, codes: np.ndarray, k: int, metric: str, floor: np.ndarray,
                  apart: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, columns, scores) of the k best of a block for each query (ties by
    code) that reach the query's ``floor``, some queries at a time; pairs whose values
    in one of ``apart`` (of queries, of the block) are equal are left out.

    Each query's k-th score so far passes over nearly all pairs with one comparison.
    Cosines are compared in single precision first; a pair within the bound of its
    rounding error is scored in double precision."""
    rough = x.astype(np.float32) if metric == "cosine" else None
    slack = (x.shape[1] + 8) * 2.0**-23 if metric == "cosine" else 0.0
    step = _rows_at_once(min(len(x), CHUNK_ROWS))
    for at in range(0, len(q), step):
        some, low = q[at:at + step], floor[at:at + step].copy()
        keys = [(a[at:at + step], b) for a, b in apart]
        near = some.astype(np.float32) if rough is not None else some
        last = np.full(len(some), np.iinfo(np.int64).max)
        found, waiting = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0
        for start in range(0, len(x), CHUNK_ROWS):
            part = slice(start, start + CHUNK_ROWS)
            s = near @ rough[part].T if rough is not None else _scores(some, x[part], metric)
            cut = low - slack
            new = np.flatnonzero(np.isneginf(low))  # no k-th score yet: that of this chunk
            if len(new) and s.shape[1] > k:
                first = s[new]
                for a, b in keys:
                    first[a[new, None] == b[None, part]] = -np.inf
                kth = -np.partition(-first, k - 1, axis=1)[:, k - 1]
                cut[new] = np.where(np.isnan(kth), -np.inf, kth - 2 * slack)
            r, c = np.divmod(np.flatnonzero(s >= cut[:, None].astype(s.dtype)), s.shape[1])
            if rough is None:
                score = s[r, c]
            elif len(r) * 16 > s.size:  # many equal vectors: all pairs at once
                score = np.round(some @ x[part].T, RANK_DECIMALS)[r, c]
            else:
                score = _exact(some, x, r, c + start)
            c += start
            keep = np.isfinite(score) & ((score > low[r]) | ((score == low[r]) & (codes[c] < last[r])))
            for a, b in keys:
                keep &= a[r] != b[c]
            found.append((r[keep], c[keep], score[keep]))
            waiting += len(found[-1][0])
            if 2 * waiting > k * len(some) or part.stop >= len(x):
                r, c, score = map(np.concatenate, zip(*found))
                kept, r = _topk_sparse(r, score, codes[c], k)
                c, score = c[kept], score[kept]
                found, waiting = [(r, c, score)], 0
                full = np.flatnonzero(np.bincount(r, minlength=len(some)) == k)
                end = np.searchsorted(r, full, side="right") - 1
                low[full], last[full] = score[end], codes[c[end]]
        yield found[0][0] + at, found[0][1], found[0][2]


def _arrow_type(dt: T.DataType) -> pa.DataType:
    if isinstance(dt, T.LongType):
        return pa.int64()
    if isinstance(dt, T.IntegerType):
        return pa.int32()
    if isinstance(dt, T.StringType):
        return pa.string()
    raise TypeError(f"unsupported id type {dt}")


def _knn_broadcast(q: DataFrame, c: DataFrame, k: int, metric: str, exclude_self: bool) -> DataFrame:
    """Size-checked query batch broadcast to every task; each task scores its
    slice of the collection in chunks and keeps a running per-query top-k
    (ties by id), emitting at most k rows per query per task."""
    qpdf = q.toPandas()  # bounded by the caller's size check
    q_ids = qpdf["qid"].to_numpy()
    qm = np.vstack(qpdf["vec"].to_numpy()).astype(np.float64) if len(qpdf) else np.zeros((0, 1))
    qm = _unit(qm) if metric == "cosine" else qm
    bc = q.sparkSession.sparkContext.broadcast((q_ids, qm))
    id_type = c.schema["id"].dataType
    out_arrow = pa.schema([("qid", _arrow_type(q.schema["qid"].dataType)), ("id", _arrow_type(id_type)),
                           ("score", pa.float64())])
    out_spark = T.StructType([T.StructField("qid", q.schema["qid"].dataType), T.StructField("id", id_type),
                              T.StructField("score", T.DoubleType())])

    def reduce(rows, ids, scores):
        sel, sel_rows = _topk_sparse(rows, scores, _order_codes(ids), k)
        return sel_rows, ids[sel], scores[sel]

    def part(batches):
        qids, qmat = bc.value
        if len(qids) == 0:
            return
        acc_r, acc_i, acc_s = [np.zeros(0, np.int64)], [], [np.zeros(0)]
        acc_n = 0
        floor = np.full(len(qids), -np.inf)  # the k-th best score so far, of queries that have k
        for rb in batches:
            tbl = pa.Table.from_batches([rb])
            if tbl.num_rows == 0:
                continue
            cm_all, c_ids_all = _matrix(tbl, "vec"), _ids(tbl, "id")
            for start in range(0, tbl.num_rows, CHUNK_ROWS):
                cm, c_ids = cm_all[start:start + CHUNK_ROWS], c_ids_all[start:start + CHUNK_ROWS]
                cm = _unit(cm) if metric == "cosine" else cm
                step = _rows_at_once(len(cm))
                for at in range(0, len(qids), step):  # chunks of queries too: scores stay within MATRIX_CELLS
                    some = slice(at, at + step)
                    sc = _scores(qmat[some], cm, metric)
                    if exclude_self:
                        sc[qids[some, None] == c_ids[None, :]] = -np.inf
                    r, cc = np.nonzero(_best(sc, k) & (sc >= floor[some, None]))
                    acc_r.append(r + at); acc_i.append(c_ids[cc]); acc_s.append(sc[r, cc])
                    acc_n += len(r)
                if acc_n > 2 * k * len(qids):  # keep the running state at about k per query
                    rr, ii, ss = reduce(np.concatenate(acc_r), np.concatenate(acc_i), np.concatenate(acc_s))
                    acc_r, acc_i, acc_s, acc_n = [rr], [ii], [ss], len(rr)
                    full = np.flatnonzero(np.bincount(rr, minlength=len(qids)) == k)
                    floor[full] = ss[np.searchsorted(rr, full, side="right") - 1]
        if not acc_i:
            return
        rr, ii, ss = reduce(np.concatenate(acc_r), np.concatenate(acc_i), np.concatenate(acc_s))
        if metric != "cosine":
            ss = -ss
        yield pa.RecordBatch.from_arrays(
            [pa.array(qids[rr], type=out_arrow.field("qid").type), pa.array(ii, type=out_arrow.field("id").type),
             pa.array(ss, type=pa.float64())], schema=out_arrow)

    return c.mapInArrow(part, out_spark)


def _knn_held(q: DataFrame, c: DataFrame, k: int, metric: str, exclude_self: bool) -> DataFrame:
    """Size-checked collection broadcast to every task; each task scores its queries
    against all of it, and at most k rows a query leave."""
    rows = c.toArrow()  # bounded by the caller's size check
    ids, x = _ids(rows, "id"), _matrix(rows, "vec")
    order = np.argsort(_order_codes(ids), kind="stable")  # equal scores: the later ids are passed over
    ids, x = ids[order], x[order]
    bc = q.sparkSession.sparkContext.broadcast((ids, _unit(x) if metric == "cosine" else x))
    out = _result(q.schema["qid"].dataType, c.schema["id"].dataType)
    out_arrow = pa.schema([(f.name, _arrow_type(f.dataType) if f.name != "score" else pa.float64()) for f in out.fields])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c_ids, held = bc.value
        codes = _order_codes(c_ids)
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if not t.num_rows:
                continue
            own, q_ids = _matrix(t, "vec"), _ids(t, "qid")
            own = _unit(own) if metric == "cosine" else own
            apart = [(q_ids, c_ids)] if exclude_self else []
            for r, cols, score in _top_of_block(own, held, codes, k, metric, np.full(len(own), -np.inf), apart):
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[r], out_arrow.field("qid").type), pa.array(c_ids[cols], out_arrow.field("id").type),
                                                  pa.array(score if metric == "cosine" else -score, pa.float64())], schema=out_arrow)

    return q.mapInArrow(part, out)


# --- pivot cells -----------------------------------------------------------------

def _result(qid_type, id_type) -> T.StructType:
    return T.StructType([T.StructField("qid", qid_type), T.StructField("id", id_type), T.StructField("score", T.DoubleType())])


def pivots(vectors: DataFrame, count: int) -> np.ndarray:
    """A sample of ``count`` vectors by a hash of their id (a top-n, not a sort)."""
    rows = vectors.select("vec").orderBy(F.xxhash64("id"), "id").limit(count).toArrow()
    return _matrix(rows, "vec")


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    d = np.einsum("ij,ij->i", x, x)[:, None] - 2.0 * (x @ p.T) + np.einsum("ij,ij->i", p, p)[None, :]
    return np.sqrt(np.maximum(d, 0.0))


def _rows_at_once(columns: int) -> int:
    return max(16, min(CHUNK_ROWS, MATRIX_CELLS // max(1, columns)))


def _copies(t: pa.Table, keep: list[str], rows: np.ndarray, cells: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The columns ``keep`` of ``rows``, each with its cell, in batches of bounded size."""
    for at in range(0, len(rows), ROUTED_ROWS):
        i, c = pa.array(rows[at:at + ROUTED_ROWS]), pa.array(cells[at:at + ROUTED_ROWS].astype(np.int32))
        yield pa.RecordBatch.from_arrays([*[t[name].combine_chunks().take(i) for name in keep], c], names=[*keep, "cell"])


def _assigned(vectors: DataFrame, centres: np.ndarray, metric: str) -> DataFrame:
    """Adds (cell, far): the nearest pivot and the distance to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(pa.Table.from_batches([batch]), "vec")
            x = _unit(x) if metric == "cosine" else x
            cell, far = np.empty(len(x), dtype=np.int32), np.empty(len(x))
            step = _rows_at_once(len(centres))
            for at in range(0, len(x), step):
                d = _distances(x[at:at + step], centres)
                cell[at:at + step] = d.argmin(axis=1)
                far[at:at + step] = d.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=[*batch.schema.names, "cell", "far"])

    schema = T.StructType([*vectors.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("far", T.DoubleType())])
    return vectors.mapInArrow(run, schema)


def _stream_scorer(k: int, metric: str, exclude_self: bool, out_schema: pa.Schema, cut: int | None = None):
    """Scores rows sorted by (cell, block, part, side): the block's vectors (side 0)
    are held while its queries (side 1) pass in batches, however many they are.
    With ``cut`` only pairs of sketches within that Hamming distance count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, block, waiting = None, None, []

        def load() -> tuple:
            t = pa.concat_tables(waiting).combine_chunks()
            x = _matrix(t, "vec")
            ids = _ids(t, "id")
            own = t["own"].to_numpy() if "own" in t.column_names else None
            return _unit(x) if metric == "cosine" else x, ids, _order_codes(ids), _words(t) if cut is not None else None, own

        def hits(q_ids, ids, rows, cols, found) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(q_ids[rows], out_schema.field("qid").type), pa.array(ids[cols], out_schema.field("id").type),
                                               pa.array(found if metric == "cosine" else -found, pa.float64())], schema=out_schema)

        def best(t: pa.Table) -> Iterator[pa.RecordBatch]:
            x, ids, codes, _, own = block
            q, q_ids = _matrix(t, "vec"), _ids(t, "qid")
            q = _unit(q) if metric == "cosine" else q
            apart = ([(q_ids, ids)] if exclude_self else []) + ([(t["own"].to_numpy(), own)] if own is not None else [])
            for rows, cols, found in _top_of_block(q, x, codes, k, metric, t["floor"].to_numpy(), apart):
                yield hits(q_ids, ids, rows, cols, found)

        def score(t: pa.Table) -> Iterator[pa.RecordBatch]:
            if cut is None:
                yield from best(t)
                return
            x, ids, codes, words, _ = block
            step = _rows_at_once(len(x))
            for at in range(0, t.num_rows, step):
                part = t.slice(at, step)
                q, q_ids = _matrix(part, "vec"), _ids(part, "qid")
                q = _unit(q) if metric == "cosine" else q
                own = _words(part)
                s = np.full((len(q), len(x)), -np.inf)
                near = sum(np.bitwise_count(own[:, w][:, None] ^ words[:, w][None, :]).astype(np.int16) for w in range(own.shape[1])) <= cut
                i, j = np.nonzero(near)
                s[i, j] = _exact(q, x, i, j)
                if exclude_self:
                    s[q_ids[:, None] == ids[None, :]] = -np.inf
                s[s < part["floor"].to_numpy()[:, None]] = -np.inf
                r, c = np.nonzero(_best(s, k))
                sel, rows = _topk_sparse(r, s[r, c], codes[c], k)
                yield hits(q_ids, ids, rows, c[sel], s[r, c][sel])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            keys = np.stack([t[c].to_numpy() for c in ("cell", "block", "part", "side")])
            starts = np.concatenate(([0], np.flatnonzero(np.any(keys[:, 1:] != keys[:, :-1], axis=0)) + 1, [t.num_rows])) if t.num_rows else []
            for a, b in zip(starts[:-1], starts[1:]):
                group, run_of = tuple(keys[:3, a]), t.slice(a, b - a)
                if group != here:
                    here, block, waiting = group, None, []
                if keys[3, a] == 0:
                    waiting.append(run_of)
                elif waiting or block is not None:
                    if block is None:
                        block, waiting = load(), []
                    yield from score(run_of)

    return run


def _words(t: pa.Table) -> np.ndarray:
    return t["words"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64).reshape(t.num_rows, -1)


def _score_in_cells(routed: DataFrame, wanted: DataFrame, cells: DataFrame, members: DataFrame, k: int, metric: str, exclude_self: bool,
                    cut: int | None = None, wide: int = 0) -> DataFrame:
    """Partial top-k (qid, id, score) of queries in the cells they are routed to.

    ``routed``: (qid, vec, floor, cell); ``wanted``: (cell, queries); ``cells``:
    (id, vec, cell); ``members``: (cell, rows).  A cell is cut into blocks of
    bounded size, and the queries of one into parts beyond ``QUERY_ROWS``; each of
    the ``wide`` cells (below 0) is one block already, and its queries are cut into so
    many parts that all partitions have work.  With a column ``own`` on both sides, pairs of the same
    value are left out.  The two small tables have a row for each cell."""
    dim = max(1, (cells.select(F.size("vec")).first() or [1])[0])
    rows = max(256, min(BLOCK_ROWS, BLOCK_BYTES // (8 * dim)))
    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_wide = F.col("cell") < 0
    split = F.least(F.ceil(F.col("queries") / WIDE_QUERIES), F.lit(-(-n // max(1, wide))))
    plan = members.join(wanted, "cell").select(
        "cell", F.when(is_wide, 1).otherwise(F.ceil(F.col("rows") / rows)).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.col("queries") / QUERY_ROWS), F.when(is_wide, split)).cast("int").alias("parts"))
    extra = [name for name in ("words", "own") if name in cells.columns]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = cells.join(F.broadcast(plan), "cell").withColumn("part", every("parts")).select(
        "cell", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "part", F.lit(0).alias("side"),
        F.lit(None).cast(routed.schema["qid"].dataType).alias("qid"), "id", "vec", F.lit(None).cast("double").alias("floor"), *extra)
    asked = routed.join(F.broadcast(plan), "cell").withColumn("block", every("blocks")).select(
        "cell", "block", F.pmod(F.xxhash64("qid"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("side"),
        "qid", F.lit(None).cast(cells.schema["id"].dataType).alias("id"), "vec", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"), *extra)
    both = held.unionByName(asked).repartition(n, "cell", "block", "part").sortWithinPartitions("cell", "block", "part", "side")
    out = _result(routed.schema["qid"].dataType, cells.schema["id"].dataType)
    out_arrow = pa.schema([(f.name, _arrow_type(f.dataType) if f.name != "score" else pa.float64()) for f in out.fields])
    return both.mapInArrow(_stream_scorer(k, metric, exclude_self, out_arrow, cut), out)


def _router(centres: np.ndarray, table: dict[str, np.ndarray], metric: str, keep: list[str], wide: int = 0):
    """Copies a query to each cell, other than its own, that may hold a vector as
    near as its bound.  With ``keep`` empty only the cells are returned.  A query that
    may have such vectors in cells with half of all vectors goes to the ``wide`` cells
    (-1, -2, ...) instead, if there are any."""
    between = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal between
        if between is None:
            between = _distances(centres, centres)
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if not t.num_rows:
                continue
            x = _matrix(t, "vec")
            x = _unit(x) if metric == "cosine" else x
            own, floor = t["cell"].to_numpy(), t["floor"].to_numpy(zero_copy_only=False).astype(float)
            reach = np.sqrt(np.maximum(2.0 - 2.0 * floor if metric == "cosine" else -floor, 0.0))  # nan: no bound yet
            reach = np.where(np.isnan(reach), np.inf, reach)
            step = _rows_at_once(len(centres))
            for at in range(0, len(x), step):
                some = slice(at, at + step)
                d, o = _distances(x[some], centres), own[some]
                low = np.maximum(d - table["far"], table["near"] - d)
                gap = between[o]
                plane = np.divide(d**2 - np.take_along_axis(d, o[:, None], 1)**2, 2 * gap, out=np.zeros_like(d), where=gap > 0)
                slack = 1e-6 * (1.0 + d + table["far"])  # rounding of scores and distances
                open_ = (np.maximum(low, plane) <= reach[some, None] + slack) & (table["rows"] > 0)
                open_[np.arange(len(o)), o] = False
                if wide:
                    many = np.flatnonzero(2 * (open_ @ table["rows"]) >= table["rows"].sum())
                    open_[many] = False
                    yield from _copies(t, keep, np.repeat(many, wide) + at, np.tile(-1 - np.arange(wide), len(many)))
                i, c = np.nonzero(open_)
                yield from _copies(t, keep, i + at, c)

    return run


def knn_cells(q: DataFrame, c: DataFrame, k: int, metric: str, exclude_self: bool, cells: int | None = None) -> DataFrame:
    """Exact partial top-k lists of ``q`` (qid, vec) in ``c`` (id, vec) by pivot
    cells; a query without k hits in its own cell is routed to all of them.  Where the
    bounds exclude little, a query takes the collection in wide cells, blocks of
    ``BLOCK_BYTES`` by a hash of the id, rather than in every cell."""
    empty = q.sparkSession.createDataFrame([], _result(q.schema["qid"].dataType, c.schema["id"].dataType))
    if metric == "cosine":  # the angle of a zero vector is undefined, its score is not
        zero = ~F.exists("vec", lambda x: x != 0)
        zeros_q, zeros_c = q.filter(zero), c.filter(zero)
        empty = _zero_scores(zeros_q, c, k, exclude_self, empty).unionByName(
            _zero_scores(q.filter(~zero), zeros_c, k, exclude_self, empty))
        q, c = q.filter(~zero), c.filter(~zero)
    n = c.count()
    if not n:
        return empty
    dim = c.select(F.size("vec")).first()[0]
    count = max(1, min(cells or -(-n // CELL_ROWS), n, PIVOT_BYTES // (8 * dim)))
    centres = pivots(c, count)
    centres = _unit(centres) if metric == "cosine" else centres
    held = stored(_assigned(c, centres, metric), "knn-cells")
    asked = stored(_assigned(q, centres, metric).drop("far"), "knn-queries")
    members = held.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.min("far").alias("near"), F.max("far").alias("far"))
    table = {name: np.zeros(len(centres)) for name in ("rows", "near", "far")}
    for r in members.collect():
        for name in table:
            table[name][r.cell] = r[name]
    size = members.select("cell", "rows")
    own = asked.withColumn("floor", F.lit(None).cast("double"))
    near = stored(_merge_topk(_score_in_cells(own, asked.groupBy("cell").agg(F.count(F.lit(1)).alias("queries")), held, size, k, metric, exclude_self),
                              k, metric).drop("rank"), "knn-near")
    worst = F.min("score") if metric == "cosine" else -F.max("score")
    bound = near.groupBy("qid").agg(F.when(F.count(F.lit(1)) >= k, worst).alias("floor"))
    bounded = stored(asked.join(bound, "qid", "left"), "knn-bounds")
    wide = -(-n * 8 * dim // BLOCK_BYTES)
    if wide >= count:  # no fewer copies
        wide = 0
    wanted = bounded.mapInArrow(_router(centres, table, metric, [], wide), "cell int").groupBy("cell").agg(F.count(F.lit(1)).alias("queries"))
    routed = bounded.withColumn("own", F.col("cell")).select("qid", "vec", "cell", "floor", "own").mapInArrow(
        _router(centres, table, metric, ["qid", "vec", "floor", "own"], wide),
        T.StructType([bounded.schema["qid"], bounded.schema["vec"], T.StructField("floor", T.DoubleType()),
                      T.StructField("own", T.IntegerType()), T.StructField("cell", T.IntegerType())]))
    held = held.select("id", "vec", "cell", F.col("cell").alias("own"))
    if wide:
        across = (-1 - F.pmod(F.xxhash64("id"), F.lit(wide))).cast("int").alias("cell")
        size = size.unionByName(held.groupBy(across).agg(F.count(F.lit(1)).alias("rows")))
        held = held.unionByName(held.select("id", "vec", across, "own"))
    return near.unionByName(_score_in_cells(routed, wanted, held, size, k, metric, exclude_self, wide=wide)).unionByName(empty)


def _zero_scores(q: DataFrame, c: DataFrame, k: int, exclude_self: bool, empty: DataFrame) -> DataFrame:
    """Pairs whose cosine is 0 because one vector is zero: the k smallest ids (one
    more, as one may be the query's own) are all that can be returned."""
    if q.isEmpty():
        return empty
    few = [r.id for r in c.groupBy("id").count().orderBy("id").limit(k + 1).collect()]
    ids = F.array(*[F.lit(i) for i in few]).cast(T.ArrayType(empty.schema["id"].dataType))
    pairs = q.select("qid", F.explode(ids).alias("id"), F.lit(0.0).alias("score"))
    return pairs.filter(F.col("qid") != F.col("id")) if exclude_self else pairs


def knn(
    queries: DataFrame,
    collection: DataFrame,
    k: int,
    *,
    query_id: str = "qid",
    query_vec: str = "embedding",
    id_col: str = "id",
    vec_col: str = "embedding",
    metric: str = "cosine",
    exclude_self: bool = False,
    cells: int | None = None,
    broadcast_bytes: int = BROADCAST_QUERY_BYTES,
) -> DataFrame:
    """Exact top-k per query: ``(qid, id, score, rank)``.

    ``metric="cosine"``: score = cosine similarity (= 1 - cosine distance), best first.
    ``metric="l2"``: score = squared Euclidean distance, smallest first.
    ``exclude_self`` drops the pair whose ids are equal (query set = collection).
    ``cells`` asks for the pivot cells, so many, whatever the size of the batch.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(metric)
    # a row without a vector cannot be ranked
    q = queries.select(F.col(query_id).alias("qid"), F.col(query_vec).alias("vec")).filter(F.size("vec") > 0)
    c = collection.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).filter(F.size("vec") > 0)
    if cells is None:
        n, dim = q.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
        many = n > CHUNK_ROWS  # then they are the work to deal out, if the collection can be broadcast
        if many and c.agg(F.count(F.lit(1))).first()[0] * dim * 8 <= broadcast_bytes:
            spread = int(c.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            return _merge_topk(_knn_held(q.repartition(spread, "qid"), c, k, metric, exclude_self), k, metric)
        if n * (dim or 1) * 8 <= broadcast_bytes:
            spread = int(c.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            if n and c.rdd.getNumPartitions() < spread:  # one file of a small collection is work for several tasks
                c = c.repartition(spread, "id")
            return _merge_topk(_knn_broadcast(q, c, k, metric, exclude_self), k, metric)
    return _merge_topk(knn_cells(q, c, k, metric, exclude_self, cells), k, metric)


def knn_self(vectors: DataFrame, k: int, *, id_col: str = "id", vec_col: str = "embedding", metric: str = "cosine",
             cells: int | None = None, broadcast_bytes: int = BROADCAST_QUERY_BYTES) -> DataFrame:
    """Exact top-k of every vector among all the others (its own id excluded)."""
    return knn(vectors, vectors, k, query_id=id_col, query_vec=vec_col, id_col=id_col, vec_col=vec_col, metric=metric,
               exclude_self=True, cells=cells, broadcast_bytes=broadcast_bytes)


def _merge_topk(partial: DataFrame, k: int, metric: str) -> DataFrame:
    """Per query, the k best of the partial lists (scores arrive rounded, ties by id)."""
    order = F.col("score").asc() if metric == "l2" else F.col("score").desc()
    w = Window.partitionBy("qid").orderBy(order, F.col("id").asc())
    return partial.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        "qid", "id", "score", "rank")


def metadata_filter(df: DataFrame, where: dict, metadata_col: str = "metadata") -> DataFrame:
    """``where={"k": v, ...}``: equality on every key (AND).  A key that is a
    top-level column is compared as a column, otherwise looked up in the map."""
    cond = F.lit(True)
    for key, value in where.items():
        if key in df.columns:
            cond = cond & (F.col(key) == F.lit(value))
        else:
            cond = cond & (F.col(metadata_col).getItem(key) == F.lit(str(value)))
    return df.filter(cond)


# --- approximate neighbours: cells and sketches fitted on a sample ------------------

# Hundredths of the sample's true neighbours that each of the two limits keeps.
LSH_KEEP = 98
SKETCH_BITS = 512
SAMPLE_QUERIES = 256
# The integers of vectors and of planes, and the multiplicative
# generator (Lehmer's, modulo a Mersenne prime) that spreads ids and draws planes.
UNIT = 1 << 14
PRIME, FACTOR = 2_147_483_647, 48_271
PLANE_STEP = 15


def spread_key(id_col: str) -> F.Column:
    """Orders integer ids without regard to their size."""
    return F.pmod(F.pmod(F.col(id_col), F.lit(PRIME)) * FACTOR, F.lit(PRIME))


def planes(dim: int, count: int, seed: int) -> np.ndarray:
    """(count, dim) small integers: the sum of two digits of a product generator."""
    j, i = np.arange(count, dtype=np.int64)[:, None], np.arange(dim, dtype=np.int64)[None, :]
    x = (j * dim + i + seed * 7_919 + 1) % PRIME
    for _ in range(3):
        x = (x * FACTOR + 12_345) % PRIME
        x ^= x >> 13
    return x % PLANE_STEP + (x // PLANE_STEP) % PLANE_STEP - (PLANE_STEP - 1)


def integer_units(x: np.ndarray) -> np.ndarray:
    """Unit vectors in ``UNIT``-ths, rounded: their products are exact."""
    return np.floor(_unit(x) * UNIT + 0.5)


def _words_of(units: np.ndarray, normals: np.ndarray, middle: np.ndarray) -> np.ndarray:
    side = (units - middle) @ normals.T > 0
    side = np.pad(side, ((0, 0), (0, -side.shape[1] % 62)))
    return side.reshape(len(units), -1, 62) @ (1 << np.arange(62, dtype=np.int64))


def _sketched(vectors: DataFrame, centres: np.ndarray, normals: np.ndarray, middle: np.ndarray) -> DataFrame:
    """Adds (cell, words): the centre with the largest product (the first of
    equals) and the sketch, 62 bits a long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if not t.num_rows:
                continue
            u = integer_units(_matrix(t, "vec"))
            words = _words_of(u, normals, middle)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, words.size + 1, words.shape[1]), pa.int32()), pa.array(words.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((u @ centres.T).argmax(axis=1).astype(np.int32)), lists],
                                             names=[*batch.schema.names, "cell", "words"])

    schema = T.StructType([*vectors.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("words", T.ArrayType(T.LongType()))])
    return vectors.mapInArrow(run, schema)


def _border_router(centres: np.ndarray, border: float, keep: list[str]):
    """Copies a query to every cell whose centre is at most ``border`` farther (in
    products) than the nearest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if not t.num_rows:
                continue
            u = integer_units(_matrix(t, "vec"))
            step = _rows_at_once(len(centres))
            for at in range(0, len(u), step):
                p = u[at:at + step] @ centres.T
                i, c = np.nonzero(p >= p.max(axis=1, keepdims=True) - border)
                yield from _copies(t, keep, i + at, c)

    return run


def _limits(q: DataFrame, c: DataFrame, k: int, exclude_self: bool, centres: np.ndarray, normals: np.ndarray, middle: np.ndarray,
            keep: int) -> tuple[float, int]:
    """(border, Hamming distance) within which the true neighbours of a sample of
    queries lie, ``keep`` hundredths of them each."""
    some = q.orderBy(spread_key("qid"), "qid").limit(SAMPLE_QUERIES)
    true = _merge_topk(_knn_broadcast(some, c, k, "cosine", exclude_self), k, "cosine").select("qid", "id")
    both = true.join(some.select("qid", F.col("vec").alias("qv")), "qid").join(c.select("id", F.col("vec").alias("cv")), "id")
    rows = both.select("qv", "cv").toArrow()  # k rows for each query of the sample
    if not rows.num_rows:
        return math.inf, normals.shape[0]
    a, b = integer_units(_matrix(rows, "qv")), integer_units(_matrix(rows, "cv"))
    p = a @ centres.T
    border = p.max(axis=1) - p[np.arange(len(p)), (b @ centres.T).argmax(axis=1)]
    apart = np.bitwise_count(_words_of(a, normals, middle) ^ _words_of(b, normals, middle)).sum(axis=1)
    at = -(-keep * len(p) // 100) - 1
    return float(np.sort(border)[at]), int(np.sort(apart)[at])


def lsh_model(q: DataFrame, c: DataFrame, k: int, bits: int | None, tables: int | None, seed: int, keep: int,
              exclude_self: bool) -> dict:
    """Centres, planes, the collection's middle and the two limits; q (qid, vec),
    c (id, vec)."""
    n, dim = c.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    bits = bits or 16
    normals = planes(dim, bits * (tables or -(-SKETCH_BITS // bits)), seed).astype(np.float64)
    count = max(1, min(math.isqrt(n), PIVOT_BYTES // (8 * dim)))
    rows = c.orderBy(spread_key("id"), "id").limit(max(count, SAMPLE_QUERIES)).select("vec").toArrow()
    sample = integer_units(_matrix(rows, "vec"))
    middle, centres = np.floor(sample.mean(axis=0) + 0.5), sample[:count]
    border, cut = _limits(q, c, k, exclude_self, centres, normals, middle, keep)
    return {"centres": centres, "normals": normals, "middle": middle, "border": border, "cut": cut}


def _integer_ids(df: DataFrame, name: str) -> None:
    if not isinstance(df.schema[name].dataType, (T.LongType, T.IntegerType)):
        raise TypeError(f"{name}: approximate neighbours take integer ids")


def knn_lsh(
    queries: DataFrame,
    collection: DataFrame,
    k: int,
    *,
    query_id: str = "qid",
    query_vec: str = "embedding",
    id_col: str = "id",
    vec_col: str = "embedding",
    bits: int | None = None,
    tables: int | None = None,
    seed: int = 42,
    keep: int = LSH_KEEP,
    exclude_self: bool = False,
) -> DataFrame:
    """Approximate cosine top-k: ``(qid, id, score, rank)``.

    Sketches have ``bits`` planes in each of ``tables`` groups (``SKETCH_BITS`` in
    all unless given).  A query visits the cells within the fitted border and scores
    there the vectors within the fitted Hamming distance, exactly; so recall follows
    from the sample's neighbours (about ``keep`` hundredths squared) whatever the data,
    the bits and the size, and the share of pairs scored is what the data allow."""
    q = queries.select(F.col(query_id).alias("qid"), F.col(query_vec).alias("vec")).filter(F.size("vec") > 0)
    c = collection.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).filter(F.size("vec") > 0)
    _integer_ids(q, "qid")
    _integer_ids(c, "id")
    if c.isEmpty():
        return _merge_topk(q.sparkSession.createDataFrame([], _result(q.schema["qid"].dataType, c.schema["id"].dataType)), k, "cosine")
    m = lsh_model(q, c, k, bits, tables, seed, keep, exclude_self)
    held = stored(_sketched(c, m["centres"], m["normals"], m["middle"]), "lsh-cells")
    asked = stored(_sketched(q, m["centres"], m["normals"], m["middle"]).drop("cell").withColumn("floor", F.lit(None).cast("double")), "lsh-queries")
    wanted = asked.select("vec").mapInArrow(_border_router(m["centres"], m["border"], []), "cell int").groupBy("cell").agg(
        F.count(F.lit(1)).alias("queries"))
    fields = [asked.schema[x] for x in ("qid", "vec", "floor", "words")]
    routed = asked.select("qid", "vec", "floor", "words").mapInArrow(
        _border_router(m["centres"], m["border"], ["qid", "vec", "floor", "words"]), T.StructType([*fields, T.StructField("cell", T.IntegerType())]))
    members = held.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))
    found = _score_in_cells(routed, wanted, held, members, k, "cosine", exclude_self, m["cut"])
    return _merge_topk(found, k, "cosine")
