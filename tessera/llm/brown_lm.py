"""Language-model scores from Brown class-based bigrams.

P(w | previous word) = P(class(w) | class(previous)) * P(w | class(w)).

1. *Counts* of all training words (partial sums per task, then one shuffle).
2. *Exchange clustering of symbols*: words with at least ``symbol_share`` of the
   training tokens are symbols of their own (at most 1/share of them); the
   others stand, in this step only, as one of ``groups`` symbols by their
   ending.  Each round counts from the symbol bigrams of all training texts how
   often every symbol stands before and after every class, and moves each symbol
   of one half to the class where the class-bigram likelihood gains most; halves
   take turns, so that two symbols do not just swap.  The best assignment is
   kept.  The end of a text is a symbol and a class of its own, which also
   precedes first words.
3. *Exchange of all other training words*, one by one, however rare: a shuffle
   brings together how often each of them stands between which classes; every
   round sends the class tables (classes x classes numbers) to the tasks, moves
   each word to the class that makes its neighbours likeliest, and adds the
   tables up again.  A round cannot lower the likelihood of the neighbours; the
   rounds end when it gains less than ``LEAST_GAIN``.  The classes are a table
   (word, n, cls) that grows with the corpus.  Only words never seen in training
   take the class of their ending.
4. *Class paths*: counts and classes of words with at least ``known_share`` of
   the tokens (again at most 1/share) travel to the tasks; the other words of a
   document meet theirs in a shuffle join on the word, where no key can be hot
   because frequent words never go there, and return to the document's row.
5. *Scores*: class transitions counted on the paths of the training texts, with
   interpolated smoothing, and emissions with additive smoothing and one unseen
   word per class.

Defined cases: null and empty texts are one end token; words are bytes between
ASCII white space, A-Z lower-cased; a null id counts as the empty id in the
fold; every input row gets a row; with no training text every count is 0, base
and model give the smoothed probability of unseen tokens; equal gains go to the
smaller class; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored

CLASSES = 64  # at most 255: a class is a byte of a path
GROUPS = 512
SYMBOL_SHARE = 1e-4
KNOWN_SHARE = 2e-6
ROUNDS = 10
LEAST_GAIN = 1e-3  # of the likelihood, for another round over the rare words
ADD = 0.5  # to every word count
BACK = 2.0  # weight of the class unigram in a transition
FLUSH = 500_000  # partial counts that a task holds
TEXTS_AT_ONCE = 2_048  # where counts add up
PATHS_AT_ONCE = 1_024  # where every text gives rows of its own
BYTES_AT_ONCE = 16 << 20
JOINED = 255  # in a path: the class comes by the join


# --- texts in a task ---------------------------------------------------------

def slices(batch: pa.RecordBatch, at: int, texts: int = TEXTS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Cut by the number and the bytes of the texts in column ``at``; one text is never cut."""
    size = pc.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(size):
        if i > start and (i - start >= texts or held + n > BYTES_AT_ONCE):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if batch.num_rows > start:
        yield batch.slice(start)


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, word of each token, text of each token) of UTF-8 bytes:
    ASCII-only lower-casing and white space."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    flat = lists.flatten().view(pa.binary())
    full = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(full).dictionary_encode()
    where = pc.list_parent_indices(lists).filter(full).to_numpy(zero_copy_only=False).astype(np.int64)
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), where


def between_ends(values: np.ndarray, where: np.ndarray, n_texts: int, end: int) -> np.ndarray:
    """end, values of the first text, end, values of the second, ..., end."""
    out = np.full(len(values) + n_texts + 1, end, dtype=np.int64)
    out[np.arange(len(values)) + where + 1] = values
    return out


def ending(word: bytes, groups: int) -> int:
    return zlib.crc32(word[-3:]) % groups


def symbols(words: list[bytes], own: dict[bytes, int], groups: int) -> np.ndarray:
    """Symbol of each word: its own, or that of its ending."""
    return np.fromiter((own[w] if w in own else len(own) + ending(w, groups) for w in words), np.int64, len(words))


# --- counts over all training texts ------------------------------------------

def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, n) over a column ``_t`` of UTF-8 bytes."""
    def merged(parts: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return pa.table([sums.column("word"), sums.column("n_sum")], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for whole in batches:
            for batch in slices(whole, 0):
                words, ids, _ = tokens(batch.column(0))
                parts.append(pa.table([words, pa.array(np.bincount(ids, minlength=len(words)).astype(np.int64))], names=["word", "n"]))
                held += len(words)
                pa.default_memory_pool().release_unused()
                if held > FLUSH:
                    parts = [merged(parts)]
                    held = parts[0].num_rows
                    if held > FLUSH // 2:
                        yield from parts[0].to_batches()
                        parts, held = [], 0
        if parts:
            yield from merged(parts).to_batches()

    return texts.select("_t").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def bigrams(texts: DataFrame, own: dict[bytes, int], groups: int = GROUPS) -> DataFrame:
    """(a, b, n): symbol b follows symbol a; texts begin after, and end with, the end symbol."""
    end = len(own) + groups
    width = end + 1

    def emit(code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array((code // width).astype(np.int32)), pa.array((code % width).astype(np.int32)),
                                           pa.array(n)], names=["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for whole in batches:
            for batch in slices(whole, 0):
                words, ids, where = tokens(batch.column(0))
                s = between_ends(symbols(words.to_pylist(), own, groups)[ids], where, batch.num_rows, end)
                mine, times = np.unique(s[:-1] * width + s[1:], return_counts=True)
                code, at = np.unique(np.concatenate([code, mine]), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([n, times])).astype(np.int64)
                pa.default_memory_pool().release_unused()
                if len(code) > FLUSH:
                    yield emit(code, n)
                    code, n = code[:0], n[:0]
        yield emit(code, n)

    return texts.select("_t").mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def word_contexts(texts: DataFrame, own: dict[bytes, int], classes: np.ndarray, groups: int, n_classes: int) -> DataFrame:
    """(word, n, ctx) of every word without a symbol of its own: how often it
    stands between which classes, as (previous * n_classes + next, times)."""
    end, cells = n_classes - 1, n_classes * n_classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 0):
                words, ids, where = tokens(batch.column(0))
                s = symbols(words.to_pylist(), own, groups)
                path = between_ends(classes[s][ids], where, batch.num_rows, end)
                at = np.flatnonzero((s >= len(own))[ids])
                spot = at + where[at] + 1
                code, n = np.unique(ids[at] * cells + path[spot - 1] * n_classes + path[spot + 1], return_counts=True)
                yield pa.RecordBatch.from_arrays([words.take(pa.array(code // cells)), pa.array((code % cells).astype(np.int32)),
                                                  pa.array(n.astype(np.int64))], names=["word", "code", "n"])
                pa.default_memory_pool().release_unused()

    rows = texts.select("_t").mapInArrow(run, "word binary, code int, n long").repartition("word")  # one shuffle for both groupings
    return rows.groupBy("word", "code").agg(F.sum("n").alias("n")).groupBy("word").agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("code", "n")).alias("ctx"))


# --- classes -----------------------------------------------------------------

def _contexts(pairs: DataFrame, classes: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """after[s, c]: class c follows symbol s; before[s, c]: it precedes it.
    At most symbols x classes x 2 rows reach the driver."""
    spark = pairs.sparkSession
    table = spark.createDataFrame([(i, int(c)) for i, c in enumerate(classes)], "s int, c int")
    after = pairs.join(F.broadcast(table), pairs["b"] == table["s"]).groupBy("a", "c").agg(F.sum("n").alias("n"))
    before = pairs.join(F.broadcast(table), pairs["a"] == table["s"]).groupBy("b", "c").agg(F.sum("n").alias("n"))
    both = after.select(F.lit(0).alias("k"), F.col("a").alias("s"), "c", "n").unionByName(
        before.select(F.lit(1).alias("k"), F.col("b").alias("s"), "c", "n")).toArrow()
    out = np.zeros((2, len(classes), n_classes))
    cols = [both.column(i).to_numpy() for i in range(4)]
    out[cols[0], cols[1], cols[2]] = cols[3]
    return out[0], out[1]


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def _by_class(classes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    table = np.zeros((rows.shape[1], rows.shape[1]))
    np.add.at(table, classes, rows)
    return table


def exchange(pairs: DataFrame, n_symbols: int, n_classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each symbol, classes after it, classes before it).  The end
    symbol, the last one, keeps the last class for itself."""
    end = n_classes - 1
    classes = np.arange(n_symbols) % end
    classes[-1] = end
    best, best_value = None, -math.inf
    for r in range(rounds + 1):
        after, before = _contexts(pairs, classes, n_classes)
        table = _by_class(classes, after)
        value = _xlogx(table).sum() - _xlogx(table.sum(axis=1)).sum() - _xlogx(table.sum(axis=0)).sum()
        if value > best_value:
            best, best_value = (classes.copy(), after, before), value
        if r == rounds:
            break
        # likelihood of each symbol's neighbours if it were in each class, its own counts taken out
        gain = np.full((n_symbols, n_classes), -np.inf)
        movable = np.flatnonzero((np.arange(n_symbols) * 2_654_435_761 >> 7) % 2 == r % 2)
        movable = movable[movable != n_symbols - 1]
        log_next, log_prev = _profiles(table, table.T)
        gain[movable] = after[movable] @ log_next.T + before[movable] @ log_prev.T
        for s in movable:
            c = classes[s]
            nxt = np.maximum(table[c] - after[s], 0) + 0.1
            prv = np.maximum(table[:, c] - before[s], 0) + 0.1
            gain[s, c] = after[s] @ np.log(nxt / nxt.sum()) + before[s] @ np.log(prv / prv.sum())
        gain[:, end] = -np.inf
        seen = movable[(after[movable].sum(axis=1) + before[movable].sum(axis=1)) > 0]
        moved = gain[seen].argmax(axis=1)
        if (moved == classes[seen]).all() and r:
            break
        classes = classes.copy()
        classes[seen] = moved
    return best


def _profiles(follow: np.ndarray, precede: np.ndarray) -> list[np.ndarray]:
    """log P(next class | class), log P(previous class | class), smoothed."""
    return [np.log((t + 0.1) / (t.sum(axis=1, keepdims=True) + 0.1 * len(t))) for t in (follow, precede)]


def _chosen(batch: pa.RecordBatch, profiles: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each word of a batch of contexts, its counts of next, of previous classes)."""
    k, words = len(profiles[0]), batch.num_rows
    ctx = batch.column("ctx")
    cell = ctx.flatten()
    word = pc.list_parent_indices(ctx).to_numpy(zero_copy_only=False).astype(np.int64)
    code, n = (cell.field(i).to_numpy(zero_copy_only=False) for i in range(2))
    nxt, prv = (np.bincount(word * k + c, weights=n, minlength=words * k).reshape(words, k) for c in (code % k, code // k))
    gain = nxt @ profiles[0].T + prv @ profiles[1].T
    gain[:, k - 1] = -np.inf
    return gain.argmax(axis=1), nxt, prv


def place(contexts: DataFrame, fixed: tuple[np.ndarray, np.ndarray], start: tuple[np.ndarray, np.ndarray],
          rounds: int = ROUNDS) -> tuple[DataFrame, list[float]]:
    """Exchange of the words in ``contexts``: (word, n, cls), and the likelihood
    of the neighbours after each round.  ``fixed`` holds the class tables
    (following, preceding) without these words, ``start`` those to begin with."""
    k = len(start[0])

    def tables(profiles: list[np.ndarray]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((2, k, k))
            for whole in batches:
                for at in range(0, whole.num_rows, 1_024):
                    cls, nxt, prv = _chosen(whole.slice(at, 1_024), profiles)
                    sums += [_by_class(cls, nxt), _by_class(cls, prv)]
            cell = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(sums.ravel()[cell].astype(np.int64))], names=["cell", "n"])

        rows = contexts.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n")).toArrow()  # at most 2 k k rows
        out = np.zeros(2 * k * k)
        out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
        return out.reshape(2, k, k) + np.array(fixed)

    best, values = _profiles(*start), []
    profiles = best
    for _ in range(rounds):
        now = tables(profiles)
        value = float((_xlogx(now) - now * np.log(np.maximum(now.sum(axis=2, keepdims=True), 1e-300))).sum())
        if values and value <= values[-1] + LEAST_GAIN * abs(values[-1]):
            if value > values[-1]:
                best = profiles
                values.append(value)
            break
        best = profiles
        values.append(value)
        profiles = _profiles(*now)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1_024):
                batch = whole.slice(at, 1_024)
                yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(_chosen(batch, best)[0].astype(np.int32))],
                                                 names=["word", "n", "cls"])

    return contexts.mapInArrow(run, "word binary, n long, cls int"), values


# --- the model ---------------------------------------------------------------

@dataclass
class Model:
    own: dict  # word -> symbol
    known: dict  # word -> (count, class), of words over known_share
    classes: np.ndarray  # of symbols
    rest: DataFrame  # (word, n, cls) of all training words without a symbol of their own
    rare: DataFrame  # those below known_share
    class_total: np.ndarray  # log10 of each class's emission denominator
    n: int
    v: int
    ends: int
    groups: int
    values: list  # likelihood after each round over the rare words
    transition: np.ndarray | None = None  # log10 P(class | class)


def learn(texts: DataFrame, n_classes: int = CLASSES, groups: int = GROUPS, symbol_share: float = SYMBOL_SHARE,
          known_share: float = KNOWN_SHARE, rounds: int = ROUNDS) -> Model:
    """Counts and classes of all words of ``texts``, a column ``_t`` of UTF-8 bytes."""
    counts = stored(word_counts(texts), "lm-counts")
    ends = texts.count()
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n, v = total + ends, distinct + (ends > 0)
    least = max(1, known_share * n)
    # at most 1/share rows each
    often = {bytes(w): c for w, c in counts.filter(F.col("n") >= max(1, symbol_share * n)).collect()}
    own = {w: i for i, w in enumerate(sorted(often, key=lambda w: (-often[w], w)))}
    pairs = stored(bigrams(texts, own, groups), "lm-bigrams")
    classes, after, before = exchange(pairs, len(own) + groups + 1, n_classes, rounds)
    kept = np.r_[np.arange(len(own)), len(own) + groups]  # not the endings: their words are placed one by one
    contexts = stored(word_contexts(texts, own, classes, groups, n_classes), "lm-contexts")
    placed, values = place(contexts, tuple(_by_class(classes[kept], t[kept]) for t in (after, before)),
                           tuple(_by_class(classes, t) for t in (after, before)), rounds)
    rest = stored(placed, "lm-classes")
    known = {w: (often[w], int(classes[s])) for w, s in own.items()}
    known |= {bytes(w): (c, k) for w, c, k in rest.filter(F.col("n") >= least).collect()}
    # emission denominators: all words of a class
    size, kinds = np.zeros(n_classes), np.zeros(n_classes)
    for w, s in own.items():
        size[classes[s]] += often[w]
        kinds[classes[s]] += 1
    for c, words, k in rest.groupBy("cls").agg(F.sum("n"), F.count(F.lit(1))).collect():
        size[c] += words
        kinds[c] += k
    return Model(own, known, classes, rest, rest.filter(F.col("n") < least), np.log10(size + ADD * (kinds + 1)), n, v, ends, groups, values)


def class_paths(docs: DataFrame, m: Model, keep: list[str], text: str = "text") -> DataFrame:
    """(_keep, path, n_tokens, n_known, emit): the classes of a text's words, one
    byte each, and the sum of the logarithms of the words' smoothed counts."""
    own, known, groups, classes, ends = m.own, m.known, m.groups, m.classes, m.ends
    src = docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(F.lit(True).alias("_any"), *keep).alias("_keep"),
                      F.col(text).cast("binary").alias("_t"))
    kind = src.schema["_keep"].dataType.simpleString()
    mine = f"struct<_keep:{kind},path:binary,which:binary,n_known:bigint,emit:double>"  # one column, null in the rows of rare words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (0, -1)
        for whole in batches:
            for batch in slices(whole, 2, PATHS_AT_ONCE):
                docs, rows = batch.num_rows, batch.column(0).to_numpy()
                words, ids, where = tokens(batch.column(2))
                spelled = words.to_pylist()
                found = np.array([known.get(w, none) for w in spelled], dtype=np.int64).reshape(-1, 2)
                guess = classes[symbols(spelled, own, groups)]  # for words that training never saw
                log = np.where(found[:, 1] >= 0, np.log10(found[:, 0] + ADD), 0.0)
                cls = found[:, 1][ids]
                path = np.where(cls < 0, JOINED, cls).astype(np.uint8)
                length = np.bincount(where, minlength=docs)
                # the rare words of each document, numbered in it
                at = np.flatnonzero(cls < 0)
                pair, which, times = np.unique(where[at] * max(1, len(words)) + ids[at], return_inverse=True, return_counts=True)
                doc, word = pair // max(1, len(words)), pair % max(1, len(words))
                number = np.arange(len(pair)) - np.searchsorted(doc, np.arange(docs))[doc]
                order = number[which].astype(np.int32)
                k = len(pair)

                def cut(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
                    offsets = np.concatenate([[0], np.cumsum(lengths * values.itemsize)]).astype(np.int32)
                    return pa.Array.from_buffers(pa.binary(), docs, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])

                texts = pa.StructArray.from_arrays(
                    [batch.column(1), cut(path, length), cut(order, np.bincount(where[at], minlength=docs)),
                     pa.array(np.bincount(where, weights=cls >= 0, minlength=docs).astype(np.int64) + (ends > 0)),
                     pa.array(np.bincount(where, weights=log[ids], minlength=docs), pa.float64())], names=["_keep", "path", "which", "n_known", "emit"])
                zero = np.zeros(docs, np.int64)
                # a document's own row has a key that is no word, as it holds a space; then its rare words
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([rows, rows[doc]])),
                    pa.concat_arrays([pa.array([b" %d" % r for r in rows], pa.binary()), words.take(pa.array(word))]),
                    *(pa.array(np.concatenate([zero + first, rare]), pa.int32()) for first, rare in ((0, times), (-1, number), (0, guess[word]))),
                    pa.concat_arrays([texts, pa.nulls(k, texts.type)])], names=["_row", "word", "times", "number", "guess", "mine"])
                pa.default_memory_pool().release_unused()

    met = src.mapInArrow(run, f"_row long, word binary, times int, number int, guess int, mine {mine}").join(m.rare, "word", "left")
    rows = met.groupBy("_row").agg(
        F.first("mine", ignorenulls=True).alias("mine"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + ADD)).alias("emit"),
        F.collect_list(F.when(F.col("number") >= 0, F.col("number").cast("long") * 256 + F.coalesce("cls", "guess"))).alias("met"),
    ).select("mine._keep", "mine.path", "mine.which", (F.octet_length("mine.path") + 1).cast("long").alias("n_tokens"),
             (F.col("mine.n_known") + F.col("n_known")).alias("n_known"), (F.col("mine.emit") + F.col("emit")).alias("emit"), "met")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = []
            for path, which, met in zip(batch.column("path"), batch.column("which"), batch.column("met")):
                p = np.frombuffer(path.as_buffer(), np.uint8).copy()
                m = met.values.to_numpy()
                cls = np.empty(len(m), np.uint8)
                cls[m >> 8] = m & 255
                p[p == JOINED] = cls[np.frombuffer(which.as_buffer(), np.int32)]
                whole.append(p.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("_keep"), pa.array(whole, pa.binary()), *(batch.column(c) for c in ("n_tokens", "n_known", "emit"))],
                                             names=["_keep", "path", "n_tokens", "n_known", "emit"])

    return rows.mapInArrow(fill, f"_keep {kind}, path binary, n_tokens long, n_known long, emit double")


def _steps(paths: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(classes of all texts between ends, where the steps of each text begin)."""
    length = pc.binary_length(paths).to_numpy(zero_copy_only=False).astype(np.int64)
    classes = np.frombuffer(b"".join(paths.to_pylist()), np.uint8)
    where = np.repeat(np.arange(len(length)), length)
    return between_ends(classes, where, len(length), end), np.concatenate([[0], np.cumsum(length + 1)])[:-1]


def fit(m: Model, paths: DataFrame) -> Model:
    """The model with its transitions, counted on the class paths of the training texts."""
    k = len(m.class_total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(k * k, np.int64)
        for whole in batches:
            for batch in slices(whole, 0):
                path, _ = _steps(batch.column(0), k - 1)
                sums += np.bincount(path[:-1] * k + path[1:], minlength=k * k)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k, dtype=np.int32)), pa.array(sums)], names=["cell", "n"])

    rows = paths.select("path").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n")).toArrow()
    table = np.zeros(k * k)
    table[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    table = table.reshape(k, k)
    seen = table.sum(axis=0)
    unigram = (seen + 1) / (seen.sum() + k)
    return replace(m, transition=np.log10((table + BACK * unigram[None, :]) / (table.sum(axis=1)[:, None] + BACK)))


def scores(paths: DataFrame, m: Model) -> DataFrame:
    """One row per class path: the kept columns, n_tokens, n_known, base_score, score."""
    transition, end = m.transition, len(m.class_total) - 1
    total = m.class_total.copy()
    total[end] = 0  # an end has no emission
    base_total = math.log10(m.n + ADD * (m.v + 1))
    end_base = math.log10(m.ends + ADD) - base_total
    kept = paths.schema["_keep"].dataType
    names = [f.name for f in kept if f.name != "_any"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                path, starts = _steps(batch.column(1), end)
                emit = batch.column(4).to_numpy()
                n = batch.column(2).to_numpy()
                value = np.add.reduceat(transition[path[:-1], path[1:]] - total[path[1:]], starts) + emit
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(emit - (n - 1) * base_total + end_base), pa.array(value)],
                                                 names=["_keep", "n_tokens", "n_known", "base_score", "score"])

    out = paths.mapInArrow(run, f"_keep {kept.simpleString()}, n_tokens long, n_known long, base_score double, score double")
    return out.select(*(F.col("_keep")[c].alias(c) for c in names), "n_tokens", "n_known", "base_score", "score")


def train(texts: DataFrame, n_classes: int = CLASSES, groups: int = GROUPS, symbol_share: float = SYMBOL_SHARE,
          known_share: float = KNOWN_SHARE, rounds: int = ROUNDS) -> Model:
    """``texts`` has one column ``_t`` of UTF-8 bytes."""
    m = learn(texts, n_classes, groups, symbol_share, known_share, rounds)
    return fit(m, class_paths(texts, m, [], "_t"))


def score(docs: DataFrame, m: Model, keep: list[str], text: str = "text") -> DataFrame:
    """One row per document row: ``keep`` columns, n_tokens, n_known, base_score, score."""
    return scores(class_paths(docs, m, keep, text), m)
