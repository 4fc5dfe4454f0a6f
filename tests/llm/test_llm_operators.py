"""The training-data operators: each case that the docstrings define, and
brute-force versions of what SQL cannot express."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as se
from tessera.llm import brown_lm, decontaminate, line_dedup, mixing, pii, quality_qda, simhash_dedup, token_counts, topk_search, url_filter
from tessera.llm.common import fold, lower_ascii

LONG = " ".join(f"w{i % 977}x" for i in range(20_000))
SAME = "this very line is shared by all of the documents"
DOCS = [
    (0, None, "en", "a", 0), (1, "", "en", "a", 0), (2, " \t\n\n ", None, None, None), (None, "no id here\n" + SAME, "fr", "b", 5),
    (3, f"{SAME}\nÉcole À LA\n  {SAME.upper()} \nshort", "fr", "b", 9), (4, SAME + "\n" + SAME, "en", "b", 9),
    (5, SAME + "\ntail", "en", None, 9), (5, SAME + "\ntail", "en", None, 9), (5, "other text under one id", "en", "", 9),
    (6, LONG, "en", "a", len(LONG)), (7, LONG + " end", "en", "a", 1), (8, "x" * 50_000, "en", "c", 1),
    (9, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen", "en", "c", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("_row", "_doc", "_text_hash", "label", "score", "trains", "fp", "root", "size", "no", "block", "items", "_h1", "word", "n", "key", "_t")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, SCHEMA)
    for c in CLASHES:
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


def ascii_lower(t):
    return t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def test_lower_ascii_leaves_other_letters(spark):
    df = spark.createDataFrame([("ÀBC É",), ("ABC",), (None,)], "t string").select(lower_ascii(F.col("t")).alias("t"))
    assert [r.t for r in df.collect()] == ["Àbc É", "abc", None]


# --- quality ---------------------------------------------------------------

def test_quality_edge_cases(spark, docs, empty):
    labels = spark.createDataFrame([(6, 1, "x"), (6, 1, "x"), (7, 1, "x"), (8, 0, "x"), (9, 1, None), (1, None, None), (None, 1, None), (4, 0, None)],
                                   "doc_id long, quality int, stats string")
    got = quality_qda.classify(docs, labels, F.lit(True)).collect()
    assert len(got) == len(DOCS) and all(0 <= r.score <= 1 for r in got)
    by_text = {}
    for r in got:
        by_text.setdefault(r.doc_id, set()).add(r.score)
    assert by_text[0] == by_text[1]  # null is scored like the empty text
    one_class = quality_qda.classify(docs, labels.filter("quality = 1"), F.lit(True)).first().score
    assert one_class == pytest.approx(5 / 6)
    assert quality_qda.classify(docs, labels.filter("false"), F.lit(True)).first().score == 0.5
    assert quality_qda.classify(empty, labels, F.lit(True)).count() == 0
    assert quality_qda.keep_good(docs, labels, F.lit(True)).columns == docs.columns


def test_quality_factors_match_the_plain_density():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 3))
    cov = np.cov(x.T)
    root = np.linalg.inv(np.linalg.cholesky(cov))
    m = quality_qda.Qda(np.zeros((2, 3)), np.array([root, np.eye(3)]), np.array([np.linalg.slogdet(cov)[1], 0.0]), np.log([0.3, 0.7]))

    def density(v, c):
        return -0.5 * (v @ np.linalg.inv(c) @ v + math.log(np.linalg.det(c)))

    want = [math.log(0.7) + density(v, np.eye(3)) - math.log(0.3) - density(v, cov) for v in x]
    assert np.allclose(m.log_odds(x), want)


def test_quality_scores_match_an_independent_fit(spark):
    """Means, both shrinkages and densities from the plain formulas."""
    rng = random.Random(5)
    good = lambda: " ".join(rng.choice(["the", "of", "language", "Word", "runs", "on."]) for _ in range(rng.randint(5, 60)))
    bad = lambda: "".join(rng.choice("#$|AB12 \n") for _ in range(rng.randint(5, 200)))
    rows = [(i, good() if i % 3 else bad(), int(i % 3 > 0) if i % 7 else 1 - int(i % 3 > 0)) for i in range(90)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(100, ""), (101, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality_qda.classify(docs, labels, F.col("doc_id") % 5 != 0).collect()}

    x = {i: np.array(quality_qda.statistics((t or "").encode())) for i, t in [(i, t) for i, t, _ in rows] + [(100, ""), (101, None)]}
    own = {k: np.array([x[i] for i, _, y in rows if y == k and i % 5]) for k in (0, 1)}
    n = {k: len(v) for k, v in own.items()}
    cov = {k: np.cov(v.T, bias=True) for k, v in own.items()}
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / (n[0] + n[1])
    level = np.diag(np.maximum(np.diag(pooled), 1e-6))
    shrunk = {k: (1 - quality_qda.TO_DIAGONAL) * ((1 - quality_qda.TO_POOLED) * cov[k] + quality_qda.TO_POOLED * pooled) + quality_qda.TO_DIAGONAL * level
              for k in (0, 1)}

    def log_density(v, k):
        d = v - own[k].mean(axis=0)
        return math.log(n[k] / (n[0] + n[1])) - 0.5 * (d @ np.linalg.solve(shrunk[k], d) + np.linalg.slogdet(shrunk[k])[1])

    for i, v in x.items():
        odds = log_density(v, 1) - log_density(v, 0)
        assert got[i] == pytest.approx(1 / (1 + math.exp(-max(-700, min(700, odds)))), abs=1e-6)


def test_quality_held_out(spark, sf_dir):
    got = {r.doc_id: r for r in se.queries()["op1_quality_qda"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    held = [(got[r.doc_id].predicted, r.quality) for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(g.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, g in got.items())
    assert sum(a == b for a, b in held) / len(held) > 0.95


# --- top-k -----------------------------------------------------------------

def test_topk_matches_brute_force_with_ties_and_odd_vectors(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.choice([-1, 0, 1, 0.5])) for _ in range(5)]) for i in range(300)]
    rows += [(310, [2.0**30] * 5), (311, [2.0**34] * 5), (312, [-(2.0**57)] * 5), (313, [2.0**57, 1.0, 0.0, 0.0, 0.0]), (9, [0.5] * 5), (9, [0.5] * 5), (9, [0.5] * 5)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0]), (302, [float("nan")] * 5), (303, [float("inf")] * 5), (304, []), (305, [1.0]),
             (None, [1.0] * 5), (306, [1e300] * 5), (7, rows[7][1]), (8, [0.25] * 5)]
    v = spark.createDataFrame(rows, "id long, e array<double>").select("id", topk_search.quantised(F.col("e")).alias("vec"))
    got = {}
    for r in topk_search.top_k(v, v.filter("id % 20 = 0"), k=7, lists=3, query_bytes=200, candidate_bytes=2_000).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    clean = [(i, tuple(max(-(2**63), min(2**63 - 1, math.floor(64 * x))) for x in e)) for i, e in rows
             if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    clamp = lambda s: max(-(2**63), min(2**63 - 1, s))
    for q in {i for i, _ in clean if i % 20 == 0}:
        qv = min(e for i, e in clean if i == q)
        want = sorted((-clamp(sum(a * b for a, b in zip(qv, e))), i) for i, e in clean if i != q)[:7]
        assert [got[q][r] for r in range(1, 8)] == [(i, -s) for s, i in want]
    assert topk_search.top_k(v.filter("false"), v).count() == 0
    assert topk_search.top_k(v.filter("id < 3"), v.filter("id = 1"), k=7).count() == 2


# --- SimHash ---------------------------------------------------------------

def plain_simhash(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), seed=42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(points, radius=4):
    parent = {p: p for p in points}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ps = sorted(points)
    v = np.array(ps, dtype=np.uint64)
    for i in range(len(ps)):
        for j in np.flatnonzero(np.bitwise_count(v[i] ^ v[i + 1:]) <= radius):
            a, b = find(ps[i]), find(ps[i + 1 + j])
            parent[max(a, b)] = min(a, b)
    return {p: find(p) for p in ps}


def check_components(rows, got):
    prints = [(i, plain_simhash(t)) for i, t in rows]
    root = plain_components({p for _, p in prints})
    smallest = {}
    for i, p in prints:
        if i is not None:
            smallest[root[p]] = min(smallest.get(root[p], i), i)
    want = Counter((i, p, smallest.get(root[p])) for i, p in prints)
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == want


def test_simhash_edge_cases_and_kept_documents(spark, docs, empty):
    found = simhash_dedup.components(docs)
    got = found.collect()
    check_components([(d[0], d[1]) for d in DOCS], got)
    kept = simhash_dedup.keep_one(docs, found)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len({r.root for r in got})
    assert simhash_dedup.components(empty).count() == 0
    assert simhash_dedup.keep_one(empty, simhash_dedup.components(empty)).count() == 0


def test_simhash_query_matches_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check_components([tuple(r) for r in rows], simhash_dedup.components(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect())
    q = {r.doc_id: (r.fingerprint, r.component_id) for r in se.queries()["op3_simhash_dedup"](spark, sf_dir).collect()}
    assert all(q[i][0] == format(plain_simhash(t), "016x") for i, t in rows)


def test_simhash_dense_and_chained_points_in_small_shards(spark):
    rng = random.Random(5)
    points = {0, 2**64 - 1}
    for _ in range(6):  # dense balls and chains
        c = rng.getrandbits(64)
        for _ in range(60):
            points.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
        for _ in range(25):
            c ^= sum(1 << b for b in rng.sample(range(64), 4))
            points.add(c)
    points |= {rng.getrandbits(64) for _ in range(300)}
    signed = [p - 2**64 if p >> 63 else p for p in points]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    root = simhash_dedup.stars(simhash_dedup.links(df, shard_points=16))
    got = {p: p for p in points} | {r.u % 2**64: r.v % 2**64 for r in root.collect()}
    want = plain_components(points)
    classes = lambda m: {frozenset(p for p in m if m[p] == r) for r in set(m.values())}
    assert classes(got) == classes(want)


# --- language model --------------------------------------------------------

def test_lm_counts_base_scores_and_edge_cases(spark, docs, empty):
    held = docs.withColumn("held_out", fold(F.col("doc_id")) == 1)
    model = brown_lm.train(held.filter("not held_out").select(F.col("text").cast("binary").alias("_t")), n_classes=8, groups=16, rounds=4)
    got = brown_lm.score(held, model, ["doc_id", "held_out", "n"]).collect()
    assert len(got) == len(DOCS)
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t or "")) + [None]
    c = Counter(w for i, t, *_ in DOCS if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1 for w in words(t))
    n, v = sum(c.values()), len(c)
    want = Counter((i, len(words(t)), sum(c[w] > 0 for w in words(t)),
                    round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t)), 5)) for i, t, *_ in DOCS)
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in got) == want
    assert model.n == n and all(r.score < 0 and math.isfinite(r.score) and r.n == "clash" for r in got)
    assert brown_lm.score(empty, model, ["doc_id"]).count() == 0
    nothing = brown_lm.train(empty.select(F.col("text").cast("binary").alias("_t")), n_classes=4, groups=4, rounds=2)
    assert all(math.isfinite(r.score) for r in brown_lm.score(docs, nothing, ["doc_id"]).collect())


def test_lm_classes_separate_contexts_and_beat_the_base(spark):
    rng = random.Random(2)
    text = lambda side: " ".join(f"{side}{rng.randint(0, 9)}" for _ in range(60))
    rows = [(i, text("ab"[i % 2])) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = brown_lm.train(df.filter("doc_id < 60").select(F.col("text").cast("binary").alias("_t")), n_classes=3, groups=4, symbol_share=1e-3)
    a, b = ({int(model.classes[s]) for w, s in model.own.items() if w.startswith(x)} for x in (b"a", b"b"))
    assert len(a) == len(b) == 1 and a != b
    got = brown_lm.score(df.filter("doc_id >= 60"), model, ["doc_id"]).agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_lm_probabilities_sum_to_one(spark):
    df = spark.createDataFrame([(1, "a b a c"), (2, "b b d")], "doc_id long, text string")
    m = brown_lm.train(df.select(F.col("text").cast("binary").alias("_t")), n_classes=4, groups=4, symbol_share=0.2)
    assert np.allclose((10 ** m.transition).sum(axis=1), 1)


def test_lm_places_every_training_word(spark):
    """Each word without a symbol of its own is where a plain count of its
    neighbours, against the class tables of the round, puts it; rounds gain."""
    rng = random.Random(3)
    noun, verb = [f"n{i}x" for i in range(60)], [f"v{i}x" for i in range(60)]
    texts = [" ".join(w for _ in range(rng.randint(1, 6)) for w in ("The", rng.choice(noun), "can", rng.choice(verb))) for _ in range(150)]
    df = spark.createDataFrame([(t,) for t in texts + ["", "once"]] + [(None,)], "text string").select(F.col("text").cast("binary").alias("_t"))
    m = brown_lm.learn(df, n_classes=5, groups=3, symbol_share=5e-2)
    assert set(m.own) == {b"the", b"can"}
    rest = {bytes(r.word).decode(): (r.n, r.cls) for r in m.rest.collect()}
    count = Counter(w for t in texts + ["once"] for w in ascii_lower(t).split())
    assert {w: n for w, (n, _) in rest.items()} == {w: n for w, n in count.items() if w not in ("the", "can")}
    assert all(b >= a for a, b in zip(m.values, m.values[1:])) and all(c < 4 for _, c in rest.values())
    kinds = [Counter(rest[w][1] for w in words if w in rest).most_common(1)[0][0] for words in (noun, verb)]
    assert kinds[0] != kinds[1]  # nouns and verbs stand between different words
    assert all(rest[w][1] == k for words, k in zip((noun, verb), kinds) for w in words if w in rest)

    # one round from the start, word by word
    first = lambda w: int(m.classes[-1 if w is None else brown_lm.symbols([w.encode()], m.own, m.groups)[0]])
    follow, precede, near = np.zeros((5, 5)), np.zeros((5, 5)), {}
    for t in texts + ["once", "", ""]:
        path = [None, *ascii_lower(t).split(), None]
        for a, b in zip(path, path[1:]):
            follow[first(a), first(b)] += 1
            precede[first(b), first(a)] += 1
        for a, w, b in zip(path, path[1:], path[2:]):
            near.setdefault(w, []).append((first(a), first(b)))
    nxt, prv = brown_lm._profiles(follow, precede)
    want = {w: max(range(4), key=lambda c: (round(sum(nxt[c, b] + prv[c, a] for a, b in near[w]), 9), -c)) for w in rest}
    contexts = brown_lm.word_contexts(df, m.own, m.classes, m.groups, 5)
    zero = np.zeros((5, 5))
    placed, _ = brown_lm.place(contexts, (zero, zero), (follow, precede), rounds=1)
    assert {bytes(r.word).decode(): r.cls for r in placed.collect()} == want


def test_lm_scores_match_plain_probabilities(spark):
    """Class transitions, emissions and totals from the training words themselves,
    given the clustering; the words of a class and an unseen one share its mass."""
    rng = random.Random(7)
    text = lambda: " ".join(rng.choice(["the", "a", "cat", "dog", "runs", "sleeps", f"x{rng.randint(0, 40)}ing"]) for _ in range(rng.randint(0, 12)))
    train, held = [text() for _ in range(80)], [text() + rng.choice(["", " unseenword", " The"]) for _ in range(15)] + ["", None]
    df = spark.createDataFrame([(t,) for t in train], "text string")
    m = brown_lm.train(df.select(F.col("text").cast("binary").alias("_t")), n_classes=4, groups=5, symbol_share=2e-2, known_share=5e-2)
    docs = spark.createDataFrame(list(enumerate(held)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in brown_lm.score(docs, m, ["doc_id"]).collect()}

    placed = {bytes(r.word).decode(): r.cls for r in m.rest.collect()}

    def cls(w):
        if w in placed:
            return placed[w]
        return int(m.classes[-1 if w is None else brown_lm.symbols([w.encode()], m.own, m.groups)[0]])

    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t or ""))
    count = Counter(w for t in train for w in words(t))
    size, kinds = Counter(), Counter()
    for w, n in count.items():
        size[cls(w)] += n
        kinds[cls(w)] += 1
    follows, k = np.zeros((4, 4)), 4
    for t in train:
        path = [cls(None), *map(cls, words(t)), cls(None)]
        for a, b in zip(path, path[1:]):
            follows[a, b] += 1
    share = (follows.sum(axis=0) + 1) / (follows.sum() + k)
    step = lambda a, b: (follows[a, b] + brown_lm.BACK * share[b]) / (follows[a].sum() + brown_lm.BACK)
    emit = lambda w: (count[w] + brown_lm.ADD) / (size[cls(w)] + brown_lm.ADD * (kinds[cls(w)] + 1))
    for i, t in enumerate(held):
        path = [None, *words(t), None]
        want = sum(math.log10(step(cls(a), cls(b)) * (1 if b is None else emit(b))) for a, b in zip(path, path[1:]))
        assert got[i] == pytest.approx(want)
    assert all(sum(step(a, b) for b in range(k)) == pytest.approx(1) for a in range(k))
    for c in {cls(w) for w in count}:
        known = [w for w in count if cls(w) == c]
        assert sum(map(emit, known)) + brown_lm.ADD / (size[c] + brown_lm.ADD * (kinds[c] + 1)) == pytest.approx(1)


# --- token counts ----------------------------------------------------------

def test_token_counts_match_a_programme_per_word(spark, docs, empty, sf_dir):
    pieces = token_counts.piece_scores()
    seg = token_counts.Segmenter(pieces)

    def plain(word):
        w = token_counts.MARK + word
        best = [(0.0, 0)]
        for i in range(1, len(w) + 1):
            tries = [(best[j][0] - pieces[w[j:i]], best[j][1] + 1) for j in range(max(0, i - seg.longest), i) if w[j:i] in pieces]
            if w[i - 1] not in pieces:
                tries.append((best[i - 1][0] - seg.worst, best[i - 1][1] + len(w[i - 1].encode())))
            best.append(min(tries))
        return best[-1][1]

    extra = spark.createDataFrame([(20, "日本語 naïve 😀😀 \u2028x the theory then"), (21, "The the")], "doc_id long, text string")
    src = docs.select("doc_id", "text").unionByName(extra).filter("doc_id is null or doc_id <> 8")
    got = Counter((r.doc_id, r.n_pretokens, r.n_tokens) for r in token_counts.count_tokens(src, pieces).collect())
    rows = [(i, t) for i, t, *_ in DOCS if i != 8] + [tuple(r) for r in extra.collect()]
    memo = {}
    count = lambda w: memo.setdefault(w, plain(w)) if w not in memo else memo[w]
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    assert got == Counter((i, len(split(t)), sum(map(count, split(t)))) for i, t in rows)
    assert token_counts.count_tokens(empty, pieces).count() == 0
    assert token_counts.count_tokens(docs.filter("doc_id = 8"), pieces).first().n_tokens > 0


def test_token_scores_are_estimated_from_the_documents(spark, empty):
    rng = random.Random(9)
    names = ["▁", *"abc", "▁a", "ab", "▁ab", "bc", "abc", "cab", "▁abca"]
    scores = {p: -rng.uniform(0.5, 4) for p in names}
    words = ["abc", "abcabc", "b", "axb", "cab", "é", "a" * 9]

    def cuts(w):
        if not w:
            yield []
        for i in range(1, len(w) + 1):
            if w[:i] in scores or i == 1:
                yield from ([w[:i], *rest] for rest in cuts(w[i:]))

    want, value, times = Counter(), 0.0, np.arange(1.0, len(words) + 1)
    for w, n in zip(words, times):
        every = [(c, math.exp(sum(scores.get(p, min(scores.values()) - token_counts.UNKNOWN) for p in c))) for c in cuts("▁" + w)]
        total = sum(p for _, p in every)
        value += n * math.log(total)
        for c, p in every:
            want.update({x: n * p / total * k for x, k in Counter(c).items() if x in scores})
    got, likelihood = token_counts.Lattice(scores).expected(words, times)
    assert likelihood == pytest.approx(value) and dict(zip(names, got)) == pytest.approx({p: want[p] for p in names})

    one_by_one = np.zeros(len(names))
    lattice = token_counts.Lattice(scores)
    assert sum(lattice._one(w, float(n), one_by_one) for w, n in zip(words, times)) == pytest.approx(value)
    assert one_by_one == pytest.approx(got)

    text = "the language of distributed processing is the international language "
    df = spark.createDataFrame([(i, text * 400) for i in range(20)] + [(99, None)], "doc_id long, text string")
    found = token_counts.estimate(df, token_counts.piece_scores())
    assert sum(map(math.exp, found.values())) == pytest.approx(1, abs=1e-4)
    assert token_counts.count_tokens(df, found).filter("doc_id = 0").first().n_tokens == 9 * 400
    assert len(set(token_counts.estimate(empty, names).values())) == 1


def test_long_pretokens_count_like_short_ones(monkeypatch):
    """Words beyond ``WIDE`` go one by one; 60 000 characters take seconds."""
    rng = random.Random(2)
    names = ["▁", *"abcé", "▁a", "ab", "▁ab", "bc", "abc", "cab", "▁abca", "bcab"]
    scores = {p: round(-rng.uniform(0.5, 4) * 2**20) / 2**20 for p in names}
    words = sorted({"".join(rng.choices("abcéx日", k=rng.randint(1, 30))) for _ in range(300)})
    times = np.arange(1.0, len(words) + 1)
    together, whole = token_counts.Segmenter(scores).counts(words), token_counts.Lattice(scores).expected(words, times)
    monkeypatch.setattr(token_counts, "WIDE", 5)
    assert token_counts.Segmenter(scores).counts(words) == together
    apart = token_counts.Lattice(scores).expected(words, times)
    assert apart[1] == pytest.approx(whole[1]) and apart[0] == pytest.approx(whole[0])
    long = "abc日" * 15_000
    assert token_counts.Segmenter(scores).counts([long])[long] > 15_000
    assert token_counts.Lattice(scores).expected([long], np.ones(1))[0].sum() > 15_000


# --- decontamination -------------------------------------------------------

def words13(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t or ""))


def plain_scan(rows, items, n=13):
    windows = {}
    for item, t in items:
        w = words13(t)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = Counter()
    for doc, t in rows:
        w = words13(t)
        hit, ids = set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if (found := windows.get(tuple(w[i:i + size]))) is not None:
                    hit |= set(range(i, i + size))
                    ids |= {x for x in found if x is not None}
        out[(doc, len(w), len(hit), tuple(sorted(ids)))] += 1
    return out


def test_decontamination_matches_brute_force(spark, docs, empty, monkeypatch):
    rng = random.Random(4)
    vocab = ["aa", "bb", "cc", "É", "d1", "e\u00a0e"]
    text = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", ",", "-", "\n"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]) + 3)) for i in range(12)] + [(50, None), (51, ""), (52, "?!"), (None, text(14)), (53, text(30))]
    items += [(54, "six seven eight NINE ten"), (54, "six seven eight NINE ten")]
    rows = [(100 + i, " ".join([text(rng.randint(0, 25)), items[rng.randrange(len(items))][1] or "", text(rng.randint(0, 9))])) for i in range(60)]
    both = docs.select("doc_id", "text", "items", "_row").unionByName(
        spark.createDataFrame(rows, "doc_id long, text string").withColumns({"items": F.lit("x"), "_row": F.lit("x")}))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.scan(both, bench).collect())
    assert got == plain_scan([(d[0], d[1]) for d in DOCS] + rows, items)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)  # windows that are too many for a broadcast
    shuffled = decontaminate.scan(both, bench)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in shuffled.collect()) == got
    monkeypatch.undo()
    assert decontaminate.scan(empty, bench).count() == 0
    assert decontaminate.scan(docs, bench.filter("false")).filter("n_hit > 0").count() == 0
    assert decontaminate.remove(docs, bench).columns == docs.columns


# --- mixing ----------------------------------------------------------------

def test_mixing_targets_totals_and_edge_cases(spark, docs, empty):
    m = mixing.mix(docs, block_words=16, shard_slots=8, slice_docs=2)
    rows = mixing.taken(m).collect()
    assert len(rows) == len(DOCS)
    sizes = Counter((i, s or (s if s is None else ""), len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _, s, _ in DOCS)
    assert Counter((r.doc_id, r.source, r["size"]) for r in rows) == sizes
    total = sum(r["size"] for r in rows)
    target = {r.source: (r.target, r.source_size) for r in rows}
    assert sum(t for t, _ in target.values()) == pytest.approx(total)
    assert all(t <= 3 * s + 1e-9 for t, s in target.values())
    # resharing round by round gives the same targets
    names = sorted(target, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped = {}
    while True:
        left, open_ = total - sum(capped.values()), [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * target[s][1]]
        if not over:
            break
        capped |= {s: 3 * target[s][1] for s in over}
    assert {s: pytest.approx(t) for s, t in (capped | share).items()} == {s: t for s, (t, _) in target.items()}
    # rounded slots and a shorter last block, and what the draws of the shards add: each border of a
    # source moves by a Bernoulli number a shard, so four standard deviations of both borders
    shards = 1 + max(r.shard for r in m.slots.collect())
    for s, (t, _) in target.items():
        assert abs(sum(r.taken for r in rows if r.source == s) - t) <= 16 * (2 + 4 * math.sqrt(shards / 2))
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    again = mixing.taken(mixing.mix(docs.repartition(5), block_words=16, shard_slots=8, slice_docs=2)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, str(r.source), r["size"], r.taken)
    assert sorted(map(key, rows), key=str) == sorted(map(key, again), key=str)
    slots = m.slots.collect()
    assert len({(r.shard, r.position) for r in slots}) == len(slots)
    assert mixing.taken(mixing.mix(empty)).count() == 0
    assert {r.taken for r in mixing.taken(mixing.mix(docs.filter("doc_id < 3"))).collect()} == {0}


def test_shard_counts_are_stratified_multinomial_draws(spark):
    """Each shard is full, each count within one of its share, and their mean is the
    share; what a source gets is the sum of its shards' draws."""
    sizes = {"a": 30_000, "b": 8_000, "c": 500, "d": 90}
    docs = spark.createDataFrame([(i, "w " * (n // 10), s) for s, n in sizes.items() for i in range(10)], "doc_id long, text string, source string")
    m = mixing.mix(docs, block_words=4, shard_slots=32)
    src = {r.no: r for r in m.sources.collect()}
    tickets, slots = next(iter(src.values())).tickets, m.slots.collect()
    count = Counter((r.shard, r.no) for r in slots)
    shards = -(-tickets // 32)
    moved = 0
    for shard in range(shards - 1):
        assert 30 <= sum(count[shard, no] for no in src) <= 32  # slots beyond three passes stay empty
        for no, r in src.items():
            share = 32 * r.n_slots / tickets
            assert abs(count[shard, no] - share) < 2
            moved += count[shard, no] != round(share)
    assert moved > shards / 4  # the draws differ from shard to shard
    for no, r in src.items():
        total = sum(count[shard, no] for shard in range(shards))
        assert abs(total - r.n_slots) <= 4 * math.sqrt(shards / 2) and total <= 3 * r.blocks
    per_source = Counter()
    for r in mixing.taken(m).collect():
        per_source[r.source] += r.taken
    assert per_source == Counter({src[no].source: 4 * sum(count[s, no] for s in range(shards)) - short for no in src
                                  for short in [4 * sum(count[s, no] for s in range(shards)) - per_source[src[no].source]] if 0 <= short <= 12})


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 1000):
        df = spark.range(n).selectExpr("id as x", f"{n}L as m")
        assert sorted(r.x for r in mixing.permuted(df, "x", "m", "5", 0).collect()) == list(range(n))


# --- URL rules -------------------------------------------------------------

def test_url_rules(spark):
    urls = {
        1: ("http://A.Example.org/es/1?x", "a.example.org", "/es/1", "example.org/es/", "block"),
        2: ("https://example.org/en/17#f", "example.org", "/en/17", "example.org/en/1", "block"),
        3: ("https://badexample.org/es/1", "badexample.org", "/es/1", "org/", "allow"),
        4: ("ftp://x.com/de/", "x.com", "/de/", "com/de/", "block"), 5: ("http://x.com/DE/", "x.com", "/DE/", None, "allow"),
        6: ("http://spam-farm.example.net/a", "spam-farm.example.net", "/a", None, "block"),
        7: ("http://spam-farm.example.com/fr/a", "spam-farm.example.com", "/fr/a", "com/fr/", "allow"),
        8: (None, "", "", None, "allow"), 9: ("", "", "", None, "allow"), 10: ("no scheme", "", "", None, "allow"),
        11: ("http://org", "org", "", None, "allow"), 12: ("http://org/", "org", "/", "org/", "allow"),
        13: ("x://y://org/es", "y:", "//org/es", None, "allow"), 14: ("http://" + "a" * 9000 + ".org/x", "a" * 9000 + ".org", "/x", "org/", "allow"),
        15: ("http://h.net/casino?com/de/", "h.net", "/casino", None, "block"), 16: ("http://É.ORG/\nx", "É.org", "/\nx", "org/", "allow"),
    }
    df = spark.createDataFrame([(i, u[0], "h") for i, u in urls.items()] * 2, "page_id long, url string, token string")
    got = url_filter.judge(df, url_filter.default_rules()).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == urls[r.page_id][1:], r.page_id
    assert url_filter.judge(df.filter("false"), url_filter.default_rules()).count() == 0
    assert {r.verdict for r in url_filter.judge(df, []).collect()} == {"allow"}


def test_rule_sets_of_thousands_as_tables(spark, monkeypatch):
    """Rules that are rows, against every rule on every URL; also beyond the broadcast bound."""
    rng = random.Random(12)
    part = lambda: "".join(rng.choices("abcde", k=rng.randint(1, 3)))
    hosts = {(rng.choice(["allow", "block"]), ".".join(part() for _ in range(rng.randint(1, 3))), "/" + "/".join(part() for _ in range(rng.randint(0, 2))))
             for _ in range(4_000)}
    hosts = {(v, h, p + rng.choice(["", "/", "-x/"])) for v, h, p in hosts}
    patterns = [(f"p{i}", rf"(?:^|[./-]){t}(?:[./-]|$)", [t]) for i, t in enumerate({part() for _ in range(1_500)})]
    urls = [f"http://{'.'.join(part() for _ in range(rng.randint(1, 4)))}/{'/'.join(part() for _ in range(rng.randint(0, 3)))}{rng.choice(['', '/', '-x/y'])}" for _ in range(300)]
    urls += [None, "http://" + "abc." * 2_000 + "com/", "x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = url_filter.rule_table(spark.createDataFrame(sorted(hosts), "verdict string, host string, path string"),
                                  spark.createDataFrame(patterns, "name string, regex string, tokens array<string>"))
    want = {}
    for i, u in enumerate(urls):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (ascii_lower(m.group(1)), m.group(2)) if m else ("", "")
        fits = [(len(h + p), len(h), v, h + p) for v, h, p in hosts if m and (host == h or host.endswith("." + h)) and path.startswith(p)]
        hit = sorted(n for n, rx, _ in patterns if re.search(rx, host + path))
        best = max(fits, default=None)
        want[i] = (best and best[3], best[2] if best else "block" if hit else "allow", ",".join(hit))
    for most in (100_000, 100):
        monkeypatch.setattr(url_filter, "BROADCAST_RULES", most)
        got = {r.page_id: (r.rule, r.verdict, r.patterns) for r in url_filter.judge(pages, table).collect()}
        assert got == want
    as_list = [url_filter.host_rule(*h) for h in sorted(hosts)[:500]]
    frame = url_filter.rule_table(spark.createDataFrame(sorted(hosts)[:500], "verdict string, host string, path string"),
                                  spark.createDataFrame([], "name string, regex string, tokens array<string>"))
    both = [sorted(map(str, url_filter.judge(pages, r).collect())) for r in (as_list, frame)]
    assert both[0] == both[1]


# --- personal data ---------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_base(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    return ([("email", *m.span()) for m in EMAIL.finditer(t)]
            + [("ip", *m.span()) for m in IP.finditer(t) if all(int(x.lstrip("0")[:4] or 0) <= 255 for x in m.group().split("."))]
            + [("card", *m.span()) for m in CARD.finditer(t) if 13 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
            + [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= len(digits(m.group())) <= 15])


def test_base_spans_match_the_plain_expressions():
    rng = random.Random(6)
    for _ in range(20_000):
        t = "".join(rng.choice("a@.b-_+1234567890 ()é") for _ in range(rng.randint(0, 60)))
        assert pii.detect(t) == plain_base(t), t


@pytest.mark.parametrize("text, kind, found", [
    ("to jоhn.d@exаmple.com now", "email", "jоhn.d@exаmple.com"),
    ("to ann [at] mail3 (dot) example [dot] com now", "email", "ann [at] mail3 (dot) example [dot] com"),
    ("ann at mail3 dot example dot com", "email", "ann at mail3 dot example dot com"),
    ("nm.29 at mail7.example.com", "email", "nm.29 at mail7.example.com"),
    ("jo\u200bhn＠example．com", "email", "jo\u200bhn＠example．com"),
    ("ring plus one five five five zero one two three four five six ok", "phone", "plus one five five five zero one two three four five six"),
    ("at one nine two dot one six eight dot zero dot one.", "ip", "one nine two dot one six eight dot zero dot one"),
    ("card ４２７９ ０５５８ ９０７６ ４９１３", "card", "４２７９ ０５５８ ９０７６ ４９１３"),
])
def test_disguises_map_back_to_the_source(text, kind, found):
    assert [(k, text[a:b]) for k, a, b in pii.added_spans(text, pii.detect(text))] == [(kind, found)]


@pytest.mark.parametrize("text", ["The heed at the dot. It at nd on", "one two three and four", "Une école à Paris, un deux trois", "привет мир. как дела",
                                  "at an.the", "1,234.56", "", "a@b.co x"])
def test_clean_text_gets_no_added_span(text):
    assert pii.added_spans(text, pii.detect(text)) == []


@pytest.mark.parametrize("address", [
    "jane.doe at example.com", "ann at example.com", "jane_smith at mail.example.org", "ann at mail.example dot com", "ann at mail dot example.com",
    "ann at mail [dot] example.com", "ann at x-y.example (dot) co.uk", "Bob AT EXAMPLE.COM", "ann at " + "a." * 20 + "com", "ann at a.xn--p1ai"])
def test_any_name_at_a_whole_host_is_an_address(address):
    for text in (address, f"write: {address}, or call.", f"{address}. Then"):
        assert [(k, text[a:b]) for k, a, b in pii.added_spans(text, pii.detect(text))] == [("email", address)]


@pytest.mark.parametrize("text", ["arrived at 9.30 today", "sold at 3.50 each", "meet at home.Then go", "it stood at the dot on the map", "look at the point of it",
                                  "we met at noon. Then we left", "v at 1.2.3.4", "seen at section 2.a now", "at example.com",
                                  "arrived at noon.Bring it", "she works at Node.js", "he was at work.Nobody came", "smiled at John.Mary left",
                                  "it was sold at amazon.com", "look at example.com", "Look at example.com now", "we were at home.It rained",
                                  "the shop at example.org is new", "the 2 at example.org", "Stay at home.in the end"])
def test_prose_with_at_gets_no_added_span(text):
    assert pii.added_spans(text, pii.detect(text)) == []


@pytest.mark.parametrize("text", ["mail ann at example.com", "Write to ann at example.com.", "reach me: ann at example.com", "no, ann2 at example.com is it",
                                  "the shop.desk at example.org is new", "the desk at example dot org is new"])
def test_names_are_told_by_shape_or_context(text):
    assert [k for k, _, _ in pii.added_spans(text, pii.detect(text))] == ["email"]


def test_no_address_in_the_prose_of_the_documents(spark):
    """Sentences of all documents run together without a space: words at words."""
    rng = random.Random(1)
    words = sorted({w for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
                    for w in re.findall(r"[A-Za-zÀ-ÿ]+", r.text or "")})
    for _ in range(5_000):
        a, b, c = rng.sample(words, 3)
        text = f"so {a.lower()} at {b.lower()}.{c.capitalize()} went"
        assert pii.added_spans(text, pii.detect(text)) == [], text


def test_long_address_parts():
    for text in ("0" * 5_000 + ".1.1.1", "1.1.1." + "0" * 5_000 + "255", "9" * 5_000 + ".1.1.1"):
        assert pii.detect(text) == plain_base(text)
    assert [k for k, _, _ in pii.detect("0" * 5_000 + "7.1.1.1")] == ["ip"]


def test_pii_edge_cases(spark, docs, empty):
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(30, "9" * 60_000), (31, "a" * 60_000 + "@"), (32, "+1" * 30_000), (33, "😀 a@b.co 😀 c@d.ef")], "doc_id long, text string"))
    got = {r.doc_id: [(s.kind, s["from"], s.to) for s in r.found] for r in pii.find(rows).collect()}
    assert got[0] == got[1] == [] and got[30] == got[31] == [] and got[33] == [("email", 2, 8), ("email", 11, 17)]
    assert pii.find(rows).count() == len(DOCS) + 4 and pii.find(empty).count() == 0


def test_pii_query_matches_brute_force(spark, sf_dir):
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in se.queries()["op9_pii"](spark, sf_dir).collect():
        base = sorted(plain_base(text[r.doc_id]), key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in pii.KINDS)


# --- line dedup ------------------------------------------------------------

def plain_lines(rows):
    key = lambda s: ascii_lower(s.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for i, t in rows:
        for s in (t or "").split("\n"):
            if len(key(s)) >= 20:
                held.setdefault(key(s), set()).add(-(2**63) if i is None else i)
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        me = -(2**63) if i is None else i
        stay = [s for s in lines if not (key(s) in held and len(held[key(s)]) >= 3 and max(held[key(s)]) != me)]
        out[(i, len(lines), len(lines) - len(stay), "\n".join(stay))] += 1
    return out


def test_line_dedup_matches_brute_force(spark, docs, empty):
    rng = random.Random(8)
    pool = [f"a line number {i} that is long enough" for i in range(12)] + ["short", "", "  Padded LINE number 1 that is long  "]
    rows = [(100 + i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 150)))) for i in range(40)] + [(d[0], d[1]) for d in DOCS]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_h1", F.lit("clash"))
    got = line_dedup.dedup_lines(df)
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()) == plain_lines(rows)
    assert "_h1" in got.columns
    assert line_dedup.dedup_lines(empty).count() == 0
    assert line_dedup.dedup_lines(docs).count() == len(DOCS)


# --- pipeline --------------------------------------------------------------

def test_pipeline_stages_against_brute_force(spark, sf_dir):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    after = []
    at = docs
    for _, stage in cp.STAGES:
        at = cp.stored(stage(spark, at, sf_dir), "pipeline-test")
        after.append(at)
    assert all(d.columns == names for d in after[:-1])
    good = {r.doc_id for r in se.queries()["op1_quality_qda"](spark, sf_dir).filter("predicted = 1").collect()}
    first = {r.doc_id: r for r in after[0].collect()}
    assert set(first) == good
    second = {r.doc_id: r for r in after[1].collect()}
    assert Counter({(i, t): 1 for i, _, _, t in plain_lines([(i, r.text) for i, r in first.items()])}) == Counter({(i, r.text or ""): 1 for i, r in second.items()})
    assert all(r.n_chars == len(r.text) for i, r in second.items() if r.text != first[i].text)
    prints = {i: plain_simhash(r.text) for i, r in second.items()}
    root = plain_components(set(prints.values()))
    third = {r.doc_id: r for r in after[2].collect()}
    assert set(third) == {min(i for i in prints if root[prints[i]] == c) for c in set(root.values())}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    scan = plain_scan([(i, r.text) for i, r in third.items()], items)
    assert {r.doc_id for r in after[3].collect()} == {i for i, n, hit, _ in scan if not (hit and 20 * hit >= n)}
    last = after[4].collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in after[3].collect()}
    assert sum({r.source: r.target for r in last}.values()) == pytest.approx(sum(r["size"] for r in last))


def test_pipeline_on_odd_documents(spark, docs, empty, sf_dir):
    import corpus_pipeline as cp

    for at in (docs, empty):
        columns = at.columns
        for i, (_, stage) in enumerate(cp.STAGES):
            at = cp.stored(stage(spark, at, sf_dir), "pipeline-odd")
            if i + 1 < len(cp.STAGES):
                assert at.columns == columns
