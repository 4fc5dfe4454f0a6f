"""Spelling variant grouping with an index of variable-length grams.

1. *Words.*  Runs of letters of whole texts are counted by text, lower-cased
   (A-Z only), changed where the contract's noise rule says so, and summed.
2. *Gram dictionary.*  Grams of 2 to ``LONGEST`` letters are counted over the
   distinct words.  A gram longer than 2 enters the dictionary when its prefix is
   frequent and it is not rare itself; the level that is frequent grows with the
   words, so the dictionary has at most ``MOST_GRAMS`` grams and is broadcast.
3. *Decomposition.*  From every position of a word the longest dictionary gram (or
   else the 2-gram) is taken, unless an earlier one covers it.
4. *Affected grams.*  For each place of an edit the grams are counted that it can
   change: those read through it or that a gram newly read through it may cover.
   The largest count, the word's NAG, is the most that one edit takes away, so
   near words share at least (grams - NAG) of either one's grams.
5. *List merging.*  Two words that share that many have one in common among the
   NAG + 1 rarest of either; only those lists are merged.  Words all of whose
   grams one edit may change have no bound: they are listed under all their grams
   for the others, and among themselves under the rarest three of their plain
   2-grams, of which an edit takes two (up to ``TINY`` letters under what is left
   without one of them).  A repeated gram counts by occurrence.
   Lists beyond ``BLOCK`` words are merged block by block in tasks of their own.
6. *Verification.*  Pairs of a list that differ by one inserted, deleted or replaced
   letter leave the task, compared as arrays of letters (words over ``WIDE``
   letters one by one).  A word has no more near words than places times letters.
7. *Forms.*  A word's form is its most frequent near word, if frequent enough; roots
   follow forms by pointer doubling.

Defined cases: null texts have no words, a null document id counts as an empty
one in the noise rule; repeated rows count again; ties of equal counts go to the
smaller word in code-point order; a word without near words has 0 and is its own
root; empty tables give none; texts and words of any length are taken whole;
extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import partitions, stored

# Fixed values of the contract: letters, shortest word, fewest occurrences, the
# divisor of the noise rule, how much more frequent a form is.
LETTERS = "A-Za-zÀ-ÿ"
SHORTEST = 6
LEAST = 5
NOISE = 199
TIMES = 5

LONGEST = 4
#: A gram is extended when more words than this hold it, and kept above an eighth.
FREQUENT = 64
MOST_GRAMS = 200_000
BLOCK = 4_096
WIDE = 64
#: Up to so many letters one edit may take all 2-grams.
TINY = 4
FLUSH = 500_000
TEXTS_AT_ONCE = 512
PAIRS = 1 << 20  # pairs held at a time


def lowered(run: str) -> str:
    """A-Z lower-cased; other letters stay (``bytes.lower`` knows ASCII only)."""
    return run.lower() if run.isascii() else run.encode().lower().decode()


def word_counts(docs: DataFrame, doc: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST,
                noise: int | None = NOISE) -> DataFrame:
    """(word, n): words of at least ``shortest`` letters seen at least ``least`` times."""
    runs = re.compile(f"[{LETTERS}]{{{shortest},}}")

    def emit(counts: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                for doc_id, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    begun = zlib.crc32(f"{doc_id}:".encode())
                    for word, n in Counter(runs.findall(x or "")).items():
                        word = lowered(word)
                        if noise and not (h := zlib.crc32(word.encode(), begun)) % noise:
                            word = word[:h % len(word)] + word[h % len(word) + 1:]
                            if len(word) < shortest:
                                continue
                        counts[word] = counts.get(word, 0) + n
                if len(counts) > FLUSH:
                    yield emit(counts)
                    counts = {}
        yield emit(counts)

    texts = docs.select(F.coalesce(F.col(doc).cast("string"), F.lit("")).alias("d"), F.col(text).alias("t"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def gram_dictionary(words: DataFrame, longest: int = LONGEST, frequent: int = FREQUENT, most: int = MOST_GRAMS) -> set[str]:
    """The frequency-pruned grams longer than 2: at most ``most`` of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(c: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["gram", "n"])

        c: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                c.update(word[p:p + size] for size in range(2, longest + 1) for p in range(len(word) - size + 1))
                if len(c) > FLUSH:
                    yield emit(c)
                    c = Counter()
        yield emit(c)

    grams = stored(words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")), "spelling-grams")
    total = grams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    level = max(frequent, -(-8 * total // most))
    often = grams.filter(F.col("n") > level).select(F.col("gram").alias("prefix"))
    longer = grams.filter((F.char_length("gram") > 2) & (F.col("n") > level // 8)).withColumn(
        "prefix", F.expr("left(gram, char_length(gram) - 1)"))
    return {r.gram for r in longer.join(often, "prefix", "left_semi").select("gram").collect()}


def decompose(word: str, grams: set[str], inner: set[str], longest: int) -> tuple[list[str], int]:
    """The word's grams and its NAG.  ``inner`` holds the proper prefixes of the
    dictionary: a gram is read on as long as what is read is one of them."""
    n, taken, read, end = len(word), [], [], -1
    for p in range(n - 1):
        e = best = p + 2
        while word[p:e] in inner:
            if e == n:
                e += 1  # the end of the word is read as well
                break
            e += 1
            if word[p:e] in grams:
                best = e
        read.append(max(e, best) - 1)  # the last place looked at
        if best > end:
            taken.append((p, best))
            end = best
    worst = lo = 0
    for i in range(n + 1):
        while lo < len(taken) and taken[lo][0] < i - longest:
            lo += 1
        from_ = next((p for p in range(max(0, i - longest), min(i, n - 1)) if read[p] >= i), i)
        hit = 0
        for p, e in taken[lo:]:
            if p > i + longest:
                break
            hit += from_ <= p <= i or p > i and e <= i + longest
        worst = max(worst, hit)
    return [word[p:e] for p, e in taken], worst


def _numbered(grams: list[str]) -> list[tuple[str, int]]:
    seen: Counter = Counter()
    out = []
    for g in grams:
        seen[g] += 1
        out.append((g, seen[g]))
    return out


def decomposed(words: DataFrame, grams: set[str], longest: int = LONGEST) -> DataFrame:
    """(word, n, grams, nag) of every word."""
    inner = {g[:k] for g in grams for k in range(2, len(g))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [decompose(w, grams, inner, longest) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([g for g, _ in out], pa.list_(pa.string())),
                                              pa.array([k for _, k in out], pa.int32())], names=["word", "n", "grams", "nag"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, grams array<string>, nag int")


def listings(parts: DataFrame) -> DataFrame:
    """(token, word, n): the lists in which each word stands.  The frequencies that
    order the lists are of dictionary grams and 2-grams of letters, a bounded number."""
    used = parts.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    often = {r.gram: r.n for r in used.collect()}

    def rarest(tokens: list[tuple[str, int]], keep: int) -> list[tuple[str, int]]:
        return sorted(tokens, key=lambda t: (often.get(t[0], 0) >> min(62, 2 * (t[1] - 1)), t))[:keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            token, at = [], []
            for i, (word, grams, nag) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("word", "grams", "nag")))):
                own = _numbered(grams)
                if nag < len(grams):
                    lists = [f"{g}{k}" for g, k in rarest(own, nag + 1)]
                else:
                    plain = _numbered([word[p:p + 2] for p in range(len(word) - 1)])
                    lists = [f"{g}{k}" for g, k in own] + [f"={g}{k}" for g, k in rarest(plain, 3)]
                if len(word) <= TINY:
                    lists += [f"~{x}" for x in {word} | {word[:p] + word[p + 1:] for p in range(len(word))}]
                token += lists
                at += [i] * len(lists)
            yield pa.RecordBatch.from_arrays([pa.array(token, pa.string()), batch.column("word").take(pa.array(at, pa.int32())),
                                              batch.column("n").take(pa.array(at, pa.int32()))], names=["token", "word", "n"])

    return parts.mapInArrow(run, "token string, word string, n long")


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced letter turns a into b."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    if len(b) - len(a) > 1 or a == b:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + (len(a) == len(b)):] == b[p + 1:]


class Words:
    """Words as rows of letters, each of which is one byte in Latin-1."""

    def __init__(self, words: list[str]):
        self.words = words
        self.size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self.wide = self.size > WIDE
        width = int(self.size[~self.wide].max(initial=0)) + 1
        fixed = np.array([w.encode("latin-1") if not big else b"" for w, big in zip(words, self.wide.tolist())], dtype=f"S{width}")
        self.letters = fixed.view(np.uint8).reshape(len(words), width)
        bit = np.left_shift(np.uint64(1), (self.letters % 64).astype(np.uint64))
        self.mask = np.bitwise_or.reduce(np.where(self.letters > 0, bit, np.uint64(0)), axis=1)

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.abs(self.size[i] - self.size[j]) <= 1
        slow = out & (self.wide[i] | self.wide[j])
        quick = np.flatnonzero(out & ~slow)
        # one edit changes the set of letters by two at most
        quick = quick[np.bitwise_count(self.mask[i[quick]] ^ self.mask[j[quick]]) <= 2]
        out[:] = False
        a, b = i[quick], j[quick]
        swap = self.size[a] > self.size[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        same = self.letters[a] == self.letters[b]
        equal = self.size[a] == self.size[b]
        shifted = self.letters[a, :-1] == self.letters[b, 1:]
        first = np.argmin(same, axis=1)  # the first place that differs
        after = np.arange(shifted.shape[1])[None, :] >= first[:, None]
        within = np.arange(shifted.shape[1])[None, :] < self.size[a][:, None]
        out[quick] = np.where(equal, (~same).sum(axis=1) == 1, (shifted | ~(after & within)).all(axis=1))
        for k in np.flatnonzero(slow).tolist():
            out[k] = one_edit(self.words[i[k]], self.words[j[k]])
        return out


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (token, a, b, own, word, n): the pairs of each list that are near.
    Whole lists are merged; the last one of a batch waits for the next batch."""
    def pairs(rows: pa.Table, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        words, n = Words(rows["word"].to_pylist()), rows["n"].to_numpy()
        own, halves = rows["own"].to_numpy(), rows["a"].to_numpy() != rows["b"].to_numpy()
        ends = np.searchsorted(group, group, side="right")
        width = ends - np.arange(len(group)) - 1
        edges = np.concatenate(([0], np.cumsum(width)))
        at = 0
        while at < len(group):  # so many rows that their pairs are few enough
            to = max(at + 1, int(np.searchsorted(edges, edges[at] + PAIRS, side="right")) - 1)
            i = np.repeat(np.arange(at, to), width[at:to])
            j = i + 1 + np.arange(len(i)) - np.repeat(edges[at:to] - edges[at], width[at:to])
            open_ = ~halves[i] | (own[i] != own[j])
            i, j = i[open_], j[open_]
            found = words.near(i, j)
            i, j, at = i[found], j[found], to
            if len(i):
                yield pa.RecordBatch.from_arrays([rows["word"].take(pa.array(i)).combine_chunks(), pa.array(n[i]),
                                                  rows["word"].take(pa.array(j)).combine_chunks(), pa.array(n[j])], names=["u", "nu", "v", "nv"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        token, a, b = held["token"].combine_chunks().dictionary_encode().indices.to_numpy(), held["a"].to_numpy(), held["b"].to_numpy()
        change = (token[1:] != token[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        group = np.concatenate(([0], np.cumsum(change)))
        done = int(np.searchsorted(group, group[-1]))
        if done:
            yield from pairs(held.slice(0, done).combine_chunks(), group[:done])
            held = held.slice(done).combine_chunks()
    if held is not None:
        yield from pairs(held, np.zeros(held.num_rows, dtype=np.int64))


def near_pairs(words: DataFrame, longest: int = LONGEST, frequent: int = FREQUENT, block: int = BLOCK) -> DataFrame:
    """(u, nu, v, nv): every two words that are one edit apart, once."""
    parts = stored(decomposed(words, gram_dictionary(words, longest, frequent), longest), "spelling-words")
    lists = stored(listings(parts), "spelling-lists")
    many = lists.groupBy("token").agg(F.count(F.lit(1)).alias("_size")).filter(f"_size > {block}")
    dealt = lists.join(many, "token", "left").withColumn("_parts", F.expr(f"cast((coalesce(_size, 1L) + {block - 1}) div {block} as int)"))
    cells = dealt.withColumn("own", F.pmod(F.xxhash64("word"), F.col("_parts")).cast("int")).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    cells = cells.select("token", F.least("own", "_other").alias("a"), F.greatest("own", "_other").alias("b"), "own", "word", "n")
    cells = cells.repartition(partitions(cells), "token", "a", "b").sortWithinPartitions("token", "a", "b", "word")
    found = cells.mapInArrow(_merge, "u string, nu long, v string, nv long")
    first = F.col("u") < F.col("v")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    return found.select(pick("u", "v").alias("u"), pick("nu", "nv").alias("nu"), pick("v", "u").alias("v"), pick("nv", "nu").alias("nv")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, which has none itself."""
    at = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                       "spelling-roots")
        at = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return at


def variants(words: DataFrame, times: int = TIMES, longest: int = LONGEST, frequent: int = FREQUENT, block: int = BLOCK) -> DataFrame:
    """``words`` holds (word, n).  Returns (word, form, root, n, n_near, form_n)."""
    pairs = near_pairs(words, longest, frequent, block)
    sides = F.array(F.struct(F.col("u").alias("word"), F.col("v").alias("other"), F.col("nv").alias("m")),
                    F.struct(F.col("v").alias("word"), F.col("u").alias("other"), F.col("nu").alias("m")))
    near = pairs.select(F.explode(sides).alias("s")).select("s.*").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    known = stored(words.select("word", "n").join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.m") >= times * F.col("n"), F.col("best.other")).alias("form"),
        F.when(-F.col("best.m") >= times * F.col("n"), -F.col("best.m")).alias("form_n")), "spelling-forms")
    return known.join(roots(known.filter("form is not null")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
