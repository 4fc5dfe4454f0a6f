"""SimHash near-duplicates with BK-trees.

1. *Fingerprints*: a bit is set when over half of a document's word shingles
   have it set in their XXH64 (seed 42).  Equal fingerprints are one point from
   then on, so a group of exact copies of any size costs one row.
2. *Shards*: the 64 bits are cut into ``radius + same`` blocks; two points
   within the radius agree on at least ``same`` whole blocks.  So every pair
   meets in a shard (choice of ``same`` blocks, their bits).  A shard of more
   than ``shard_points`` points is dealt into sub-shards, and the tree of each
   goes to the points of every later one, so no shard is too large for a task.
3. *BK-trees*: a shard's points form a tree whose children are keyed by their
   integer Hamming distance to the parent.  A search at distance d from a node
   follows only edges d-radius..d+radius.  Subtrees that lie wholly in the
   searcher's component already are skipped: they can add no component.
   All trees of a batch grow and are searched level by level in numpy.
4. *Components*: a shard returns one link for each point but one of a local
   component (never all pairs); alternating large-star/small-star rounds join
   them, each round written to the shared folder.

The trees travel by the shuffle to the tasks that search them: a driver
broadcast would have to collect the fingerprints of all documents.

Defined cases: null and empty texts, and texts of white space, have fingerprint
0 and are linked like any other; shorter texts are one shingle; every input row
gets a row; null ids never name a component unless all its ids are null (then
the component id is null); rows that repeat an id are linked by their texts
only; an empty table gives an empty result; extra columns pass through
``keep_one``, columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import partitions, stored

SHINGLE = 4
RADIUS = 4
SAME = 2
SHARD_POINTS = 4_096
SEED = 42
FRONTIER = 500_000  # pairs of searcher and node held at a time


def simhash(data: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of UTF-8 text.  ``bytes.lower`` and
    ``bytes.split`` know ASCII only: A-Z, and white space \\x20 \\x09-\\x0D."""
    words = (data or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist())]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = np.array(hashes[at:at + 65_536], dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = counts * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def of(series: pd.Series) -> pd.Series:
        return pd.Series([simhash(x, shingle) for x in series], dtype="int64")

    return of(text.cast("binary"))


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def _labels(n: int, a: np.ndarray, b: np.ndarray, lab: np.ndarray | None = None) -> np.ndarray:
    """Smallest index of each point's component over the links (a, b)."""
    lab = np.arange(n) if lab is None else lab.copy()
    while len(a):
        low = np.minimum(lab[a], lab[b])
        np.minimum.at(lab, lab[a], low)
        np.minimum.at(lab, lab[b], low)
        while True:
            jumped = lab[lab]
            if (jumped == lab).all():
                break
            lab = jumped
        open_ = lab[a] != lab[b]
        a, b = a[open_], b[open_]
    return lab


def link_shards(shard: np.ndarray, fp: np.ndarray, in_tree: np.ndarray, searches: np.ndarray, radius: int) -> np.ndarray:
    """Component label (an index) of every point, from one BK-tree per shard.

    ``shard`` is sorted; ``in_tree`` marks the points the trees are made of and
    ``searches`` those that search them."""
    n = len(fp)
    nodes = np.flatnonzero(in_tree)
    if not len(nodes):
        return np.arange(n)
    fresh = np.concatenate(([True], shard[nodes][1:] != shard[nodes][:-1]))
    roots = nodes[fresh]
    root_of = dict(zip(shard[roots].tolist(), roots.tolist()))
    parent, edge = np.full(n, -1), np.zeros(n, dtype=np.int64)
    here = nodes[~fresh]
    at = roots[np.cumsum(fresh) - 1][~fresh]
    link_a, link_b, levels = [], [], [roots]
    while len(here):  # one level of all trees
        d = _distance(fp[here], fp[at])
        near = d <= radius
        link_a.append(here[near])
        link_b.append(at[near])
        key = at * 65 + d
        _, first, group = np.unique(key, return_index=True, return_inverse=True)
        child = here[first]
        parent[child], edge[child] = at[first], d[first]
        levels.append(child)
        rest = np.ones(len(here), dtype=bool)
        rest[first] = False
        here, at = here[rest], child[group][rest]
    lab = _labels(n, np.concatenate(link_a or [[]]).astype(int), np.concatenate(link_b or [[]]).astype(int))
    # subtrees within one component, from the leaves up
    mixed = np.zeros(n, dtype=bool)
    for level in reversed(levels[1:]):
        bad = mixed[level] | (lab[level] != lab[parent[level]])
        mixed[parent[level][bad]] = True
    kids = np.flatnonzero(parent >= 0)
    kids = kids[np.argsort(parent[kids] * 65 + edge[kids], kind="stable")]
    keys = parent[kids] * 65 + edge[kids]
    out_a, out_b = [], []
    q = np.flatnonzero(searches)
    start = np.array([root_of.get(s, -1) for s in shard[q].tolist()])
    stack = [(q[start >= 0], start[start >= 0])]
    known = np.where(in_tree, lab, -1)  # component a searcher is known to be in
    while stack:
        q, node = stack.pop()
        if len(q) > FRONTIER:
            half = len(q) // 2
            stack += [(q[half:], node[half:]), (q[:half], node[:half])]
            continue
        live = mixed[node] | (known[q] != lab[node])
        q, node = q[live], node[live]
        if not len(q):
            continue
        d = _distance(fp[q], fp[node])
        near = (d <= radius) & (q != node)
        out_a.append(q[near])
        out_b.append(node[near])
        lone = near & (known[q] < 0)
        known[q[lone]] = lab[node[lone]]
        lo = np.searchsorted(keys, node * 65 + np.maximum(d - radius, 0))
        hi = np.searchsorted(keys, node * 65 + np.minimum(d + radius, 64), side="right")
        width = hi - lo
        if width.sum():
            q = np.repeat(q, width)
            offset = np.arange(len(q)) - np.repeat(np.cumsum(width) - width, width)
            stack.append((q, kids[np.repeat(lo, width) + offset]))
    return _labels(n, np.concatenate(out_a or [[]]).astype(int), np.concatenate(out_b or [[]]).astype(int), lab)


def _linker(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows (choice, bits, a, b, own, fp): whole shards are linked, the
        last one of a batch waits for the next batch."""

        def links(part: list[np.ndarray], shard: np.ndarray) -> pa.RecordBatch:
            a, b, own, fp = part[2], part[3], part[4], part[5].view(np.uint64)
            lab = link_shards(shard, fp, own == a, own == b, radius)
            far = np.flatnonzero(lab != np.arange(len(lab)))
            u, v = part[5][far], part[5][lab[far]]
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])

        held = None
        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            if not len(held[0]):
                continue
            change = np.any([x[1:] != x[:-1] for x in held[:4]], axis=0)
            shard = np.concatenate(([0], np.cumsum(change)))
            done = int(np.searchsorted(shard, shard[-1]))
            if done:
                yield links([x[:done] for x in held], shard[:done])
                held = [x[done:] for x in held]
        if held is not None and len(held[0]):
            yield links(held, np.zeros(len(held[0]), dtype=np.int64))

    return run


def _masks(blocks: int, same: int) -> list[int]:
    edges = np.linspace(0, 64, blocks + 1).astype(int).tolist()
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:])]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(sum(block[i] for i in c)) for c in combinations(range(blocks), same)]


def links(points: DataFrame, radius: int = RADIUS, same: int = SAME, shard_points: int = SHARD_POINTS) -> DataFrame:
    """Links (u > v) that connect exactly the points ``fp`` (distinct longs)
    that chains of at most ``radius`` differing bits connect."""
    masks = _masks(radius + same, same)
    choices = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)])
    dealt = points.select("fp", F.explode(choices).alias("c")).select("c.choice", "c.bits", "fp")
    sizes = dealt.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    alone = dealt.join(sizes, ["choice", "bits"]).withColumn("parts", F.expr(f"cast((n + {shard_points - 1}) div {shard_points} as int)"))
    own = alone.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = own.select("choice", "bits", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "fp")
    cells = cells.repartition(partitions(cells), "choice", "bits", "a", "b").sortWithinPartitions("choice", "bits", "a", "b", "own", "fp")
    return cells.mapInArrow(_linker(radius), "u long, v long").distinct()


def stars(edges: DataFrame) -> DataFrame:
    """(u, v): v is the smallest point of u's component, for every u that is not
    the smallest itself (alternating large-star and small-star rounds)."""
    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    at = stored(edges, "simhash-links")
    seen = state(at)
    while seen[0]:
        both = at.unionByName(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        at = stored(pairs.select("e.u", "e.v").filter("u <> v").distinct(), "simhash-stars")
        now = state(at)
        if now == seen:
            break
        seen = now
    return at


def components(docs: DataFrame, doc: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document row: (doc, _text_hash, fp, root, component_id).
    ``root`` is the smallest fingerprint of the component, ``component_id`` its
    smallest document id."""
    prints = stored(docs.select(F.col(doc), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_text_hash"),
                                fingerprint(F.col(text), shingle).alias("fp")), "simhash-prints")
    points = stored(prints.groupBy("fp").agg(F.min(doc).alias("first_doc")), "simhash-points")
    root = stars(links(points, radius=radius))
    rooted = points.join(root, points["fp"] == root["u"], "left").select(
        "fp", "first_doc", F.coalesce("v", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    by_print = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return prints.join(by_print, "fp").select(doc, "_text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, found: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, one for each component: the one with the smallest
    (id, text hash), null ids last; of repeated rows one."""
    order = F.struct(F.col(doc).isNull().alias("none"), F.col(doc).alias("d"), F.col("_text_hash").alias("h"))
    first = found.groupBy("root").agg(F.min(order).alias("w"))
    winners = stored(first.select(F.col("w.d").alias("_d"), F.col("w.h").alias("_wh")), "simhash-winners")
    hashed = docs.withColumn("_simhash_h", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    one = hashed.join(winners, hashed[doc].eqNullSafe(winners["_d"]) & (hashed["_simhash_h"] == winners["_wh"]), "left_semi")
    repeats = found.groupBy(doc, "_text_hash").count().filter("count > 1")
    if not repeats.isEmpty():
        one = one.dropDuplicates([doc, "_simhash_h"])
    return one.drop("_simhash_h")
