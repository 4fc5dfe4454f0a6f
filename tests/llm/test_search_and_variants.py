"""Embedding near-dedup, ranked lexical search and spelling variants: brute-force
versions, and each case that the docstrings define."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
import oracle
from tessera.llm import lexical_search, spelling, vector_dedup

# --- embedding near-dedup --------------------------------------------------


def plain_links(rows, threshold=0.9):
    """(n_links, component) of every row, by all pairs."""
    def unit(e):
        if not e or any(x is None or not math.isfinite(x) for x in e) or not any(e):
            return None
        m = max(map(abs, e))
        v = np.array(e, dtype=float) / m
        return v / np.linalg.norm(v)

    u = [unit(e) for _, e in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if u[i] is not None and u[j] is not None and len(u[i]) == len(u[j]) and u[i] @ u[j] >= threshold:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    low = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            r = find(i)
            low[r] = min(low.get(r, name), name)
    return [(name, links[i], low.get(find(i))) for i, (name, _) in enumerate(rows)]


def planted(rng, clusters=(1, 2, 30, 200), width=24, noise=0.12):
    rows = []
    for size in clusters:
        centre = rng.normal(size=width)
        centre /= np.linalg.norm(centre)
        rows += [(centre + noise / math.sqrt(width) * rng.normal(size=width) * rng.uniform(0, 3)).tolist() for _ in range(size)]
    return rows


@pytest.mark.parametrize("block", [4_096, 64])
def test_vector_links_match_all_pairs(spark, block):
    rng = np.random.default_rng(5)
    vectors = planted(rng) + rng.normal(size=(300, 24)).tolist()
    order = rng.permutation(len(vectors)).tolist()
    rows = [(7 * i, vectors[k]) for i, k in enumerate(order)]
    rows += [(5_000, None), (5_001, []), (5_002, [0.0] * 24), (5_003, [math.nan] * 24), (5_004, [math.inf] * 24), (5_005, [None] + [1.0] * 23),
             (5_006, [1.0] * 23), (5_007, [2.0] * 23), (5_008, [1e300] * 23), (5_009, [1e-300] * 23), (None, rows[0][1]), (None, [-5.0] * 23),
             (0, rows[0][1]), (7, rows[1][1]), (14, [3.0] * 23)]
    df = spark.createDataFrame([(a, b, "clash", 1) for a, b in rows], "vec_id long, embedding array<double>, key string, n int")
    got = [tuple(r) for r in vector_dedup.near_duplicates(df, block=block).collect()]
    want = [(*w, w[0] == w[2]) for w in plain_links(rows)]
    none_last = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=none_last) == sorted(want, key=none_last)
    assert max(r[1] for r in got) > 100  # chains and groups were there


def test_vector_dedup_without_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_dedup.near_duplicates(empty).collect() == []
    alone = spark.createDataFrame([(None, None), (3, [1.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, vector_dedup.near_duplicates(alone).collect()), key=str) == [(3, 0, 3, True), (None, 0, None, True)]


def test_vector_tables_keep_the_recall_as_rows_grow():
    agree = 1 - math.acos(0.9) / math.pi
    for rows in (1, 500, 10**5, 10**7, 10**9):
        bits, tables = vector_dedup.plan(rows)
        assert 1 - (1 - agree**bits) ** tables >= 0.999 and rows / 2**bits <= 512


# --- lexical search --------------------------------------------------------

TEXTS = [
    (1, "the cat sat on the mat"), (2, "The CAT sat"), (3, "dog"), (4, None), (5, ""), (6, " ,.! "), (None, "cat cat cat"), (7, "cat " * 5_000),
    (8, "École été ÉCOLE"), (9, "the the the the"), (9, "the the the the"), (10, "w1 w2 w3 " * 3_000 + "cat"), (11, "cat sat"), (12, "sat cat"),
]
ITEMS = [(1, "cat sat sat"), (1, "cat sat sat"), (1, "dog"), (2, None), (3, "..."), (4, "École THE the w1"), (None, "mat"), (5, "unseen")]


def plain_search(docs, items, k=10):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [(i, Counter(term.findall((t or "").translate(lower)))) for i, t in docs]
    words = [(i, c) for i, c in words if c]
    n_docs, n_terms = len(words), sum(c.total() for _, c in words)
    df = Counter(t for _, c in words for t in c)
    out = []
    for item, text in set(items):
        found = []
        for i, c in words:
            m = 100 - 75 + (75 * c.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in term.findall((text or "").translate(lower)) if c[t])
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


@pytest.mark.parametrize("k", [1, 3, 10])
@pytest.mark.parametrize("query_block", [512, 2])
def test_search_matches_brute_force(spark, k, query_block):
    docs = spark.createDataFrame([(i, t, "clash", 0) for i, t in TEXTS], "doc_id long, text string, term string, n int").repartition(3)
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, score int")
    got = lexical_search.search(lexical_search.build(docs), items, k=k, query_block=query_block).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(plain_search(TEXTS, ITEMS, k), key=key)


def test_search_without_rows(spark):
    docs, items = spark.createDataFrame(TEXTS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    full, none = lexical_search.build(docs), lexical_search.build(docs.filter("false"))
    assert lexical_search.search(full, items.filter("false")).collect() == []
    assert lexical_search.search(none, items).collect() == []
    assert lexical_search.search(lexical_search.build(docs.filter("doc_id in (4, 5, 6)")), items).collect() == []


def test_sketches_bound_the_frequencies():
    rng = random.Random(2)
    for size in (1, 7, 300):
        terms = [f"t{rng.random()}".encode() for _ in range(size)]
        tfs = np.array([rng.choice([1, 1, 2, 9, 254, 255, 256, 10**6]) for _ in terms], dtype=np.int64)
        sketch = lexical_search.sketch_of(terms, tfs)
        hashes = np.array([lexical_search.xxhash.xxh64_intdigest(t) for t in terms], dtype=np.uint64)
        assert (sketch[lexical_search.cells(hashes, len(sketch).bit_length() - 1)].min(axis=0) >= np.minimum(tfs, 255)).all()


# --- spelling variants -----------------------------------------------------

def plain_counts(docs, shortest=6, least=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def plain_variants(counts):
    by_rest = defaultdict(set)
    for w in counts:
        for rest in {(p, w[:p] + w[p + 1:]) for p in range(len(w))}:
            by_rest[rest].add(w)
    near = defaultdict(set)
    for group in by_rest.values():
        for w in group:
            near[w] |= group - {w}
    for w in counts:
        for shorter in {w[:p] + w[p + 1:] for p in range(len(w))} & counts.keys():
            near[w].add(shorter)
            near[shorter].add(w)
    form = {}
    for w, n in counts.items():
        if near[w] and counts[f := min(near[w], key=lambda x: (-counts[x], x))] >= 5 * n:
            form[w] = f
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


def test_variants_match_brute_force_on_all_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = plain_variants(plain_counts(docs))
    got = [tuple(r) for r in se.queries()["op13_spelling_variants"](spark, sf).collect()]
    assert len(got) == len(want) > 5_000 and set(got) == want


def word_list(rng, letters, n):
    words = {"".join(rng.choices(letters, k=rng.randint(3, 14))) for _ in range(n)}
    for w in sorted(words)[:n // 2]:
        p = rng.randrange(len(w))
        words |= {w[:p] + w[p + 1:], w[:p] + rng.choice(letters) + w[p:], w[:p] + rng.choice(letters) + w[p + 1:]}
    long = "".join(rng.choices(letters, k=70))
    words |= {"a" * k for k in (5, 6, 7, 64, 65, 66, 300, 301)} | {"a" * 30 + "b" + "a" * 34, "a" * 30 + "b" + "a" * 33}
    words |= {long, long[:64], long[:65], long[:66], long[:20] + "é" + long[21:], long[1:], "×÷×÷×÷", "×÷×÷×"}
    return {w: rng.choice([5, 6, 30, 31, 200, 1_000]) for w in words if len(w) >= 2}


@pytest.mark.parametrize("letters,frequent,block", [("ab", 8, 64), ("abcdeé", 4, 4_096), ("abcdefghijklmnopqrstuvwxyz", 64, 16)])
def test_variants_match_brute_force_on_odd_words(spark, letters, frequent, block):
    counts = word_list(random.Random(len(letters)), letters, 300)
    words = spark.createDataFrame([(w, n, "clash") for w, n in counts.items()], "word string, n long, form string")
    got = [tuple(r) for r in spelling.variants(words, frequent=frequent, block=block).collect()]
    assert len(got) == len(counts) and set(got) == plain_variants(counts)


def test_affected_grams_bound_every_edit():
    """No edit changes more grams than the word's NAG says."""
    rng = random.Random(4)
    grams = {"".join(rng.choices("abc", k=rng.randint(3, 4))) for _ in range(30)}
    grams |= {g[:3] for g in grams}
    inner = {g[:k] for g in grams for k in range(2, len(g))}
    for _ in range(300):
        word = "".join(rng.choices("abc", k=rng.randint(2, 12)))
        own, nag = spelling.decompose(word, grams, inner, 4)
        for p in range(len(word) + 1):
            for x in "abcd":
                for other in (word[:p] + x + word[p:], word[:p] + x + word[p + 1:], word[:p] + word[p + 1:]):
                    kept = Counter(own) & Counter(spelling.decompose(other, grams, inner, 4)[0])
                    assert kept.total() >= len(own) - nag


def test_word_counts_of_odd_texts(spark):
    rows = [(None, "Letters LETTERS letters"), (None, "letters, letters"), (1, None), (2, ""), (3, "12 ! ?"), (4, "Étoile×÷ étoile×÷ " * 3), (5, "x" * 70_000 + " "),
            (6, ("y" * 6 + " ") * 40_000), (6, "letters short five5six")]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, word string")
    got = {r.word: r.n for r in spelling.word_counts(df).collect()}
    assert got == plain_counts(rows)
    assert spelling.variants(spelling.word_counts(df.filter("false"))).collect() == []


@pytest.mark.parametrize("key", ["op11_vector_dedup", "op12_lexical_search"])
def test_sql(spark, sf_dir, key):
    assert oracle.compare(se.queries()[key](spark, sf_dir), oracle.duck(sf_dir), se.oracle_sql()[key])["ok"]


def test_extra_columns_leave_the_texts_alone(spark):
    docs = spark.createDataFrame([(1, "cat", "b")], "doc_id long, text string, part string").withColumn("df", F.lit(1))
    assert lexical_search.build(docs).n_docs == 1
