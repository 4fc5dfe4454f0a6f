"""Token counts: unigram segmentation with one dynamic programme per shared prefix.

The vocabulary is a public piece list.  Its file belongs to a BPE model and
holds merge ranks, no probabilities, so the pieces' log-probabilities are
estimated here by expectation maximisation over the distinct pre-tokens of all
documents, weighted by their counts: each round sums in Spark the expected
count of every piece (forward-backward over all segmentations), from equal
probabilities on, until the likelihood gains less than ``GAIN``.

A pre-token (a run of non-white characters, led by the word mark) is cut into
the pieces with the largest score sum, ties to fewer pieces.  A task inserts the distinct
pre-tokens of its rows in a trie and computes the forward score of each trie node
once, for all pre-tokens that share the prefix: a level of the trie at a time, as
arrays.  The count at a terminal node is stored and summed for the documents.
The rounds of the estimation run over the same kind of trie.

Documents need no shuffle: a task shares tries over up to ``TRIE_ENTRIES``
distinct pre-tokens and then starts a new one, so its memory is bounded.  The
piece table (tens of thousands of entries, a file of fixed size) travels with
the function.

Defined cases: null, empty and white texts have 0 pre-tokens and 0 tokens; a
piece that no document needs keeps the probability of ``ADD`` occurrences, and
without documents all pieces are equally likely; a
character outside the vocabulary costs ``UNKNOWN`` under the worst piece and
counts one token per UTF-8 byte (byte fallback); texts are taken whole, a very
long pre-token (over ``WIDE`` characters) costs a few microseconds a character in
each round; repeated rows are counted one by one; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import os
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored

MARK = "▁"
UNKNOWN = 10.0
TRIE_ENTRIES = 300_000
ADD = 0.5  # to every expected count
GAIN = 1e-3  # of the log-likelihood, below which the rounds end
FLUSH = 200_000  # distinct pre-tokens that a task counts at once
CHARS = 400_000  # characters of pre-tokens in one forward-backward pass
WIDE = 128  # characters up to which words share a trie
TEXTS_AT_ONCE = 1024
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def piece_scores(model: str = MODEL) -> dict[str, float]:
    """Ordinary pieces of a sentencepiece model with the scores of the file
    (merge ranks if it is a BPE model: ``estimate`` uses the pieces only)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=os.path.realpath(model))
    return {sp.id_to_piece(i): float(sp.get_score(i)) for i in range(sp.vocab_size())
            if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))}


def pretoken_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word binary, n): the distinct pre-tokens of all documents."""
    def emit(c: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()
        for batch in batches:
            for x in batch.column(0).to_pylist():
                c.update((x or b"").split())
                if len(c) > FLUSH:
                    yield emit(c)
                    c = Counter()
        yield emit(c)

    return docs.select(F.col(text).cast("binary").alias("_t")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _log_sums(value: np.ndarray, run: np.ndarray, size: np.ndarray) -> np.ndarray:
    top = np.maximum.reduceat(value, run)
    return top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, size)), run))


class Trie:
    """The distinct prefixes of many words as nodes in order of their depth (0 is
    the empty one), and the pieces between them: every edge stands for all words
    that share both ends."""

    def __init__(self, lattice: "Lattice", words: list[str]):
        size = np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words))
        start = np.cumsum(size) - size
        text = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        self.word = np.zeros(len(words), dtype=np.int64)  # node of each word's end
        parents, chars, depths = [np.zeros(1, dtype=np.int64)], [np.zeros(1, dtype=np.int64)], [np.zeros(1, dtype=np.int64)]
        count, depth, open_ = 1, 0, np.arange(len(words))
        while len(open_):  # one level of the trie; children of a node follow each other
            key, inverse = np.unique(self.word[open_] << 21 | text[start[open_] + depth], return_inverse=True)
            self.word[open_] = count + inverse
            parents.append(key >> 21)
            chars.append(key & (1 << 21) - 1)
            depth += 1
            depths.append(np.full(len(key), depth))
            count += len(key)
            open_ = open_[size[open_] > depth]
        self.parent, self.char, self.depth = map(np.concatenate, (parents, chars, depths))
        self.code = lattice.codes(self.char)
        first = np.searchsorted(self.parent[1:], np.arange(count)) + 1
        children = np.searchsorted(self.parent[1:], np.arange(count), side="right") + 1 - first
        single = np.full(count, -1, dtype=np.int64)
        froms, tos, pieces = [], [], []
        begun, here, state, long = np.arange(count), np.arange(count), np.zeros(count, dtype=np.int64), 0
        while len(here) and len(lattice.keys):  # one more letter down both tries
            many = children[here]
            begun, state = np.repeat(begun, many), np.repeat(state, many)
            here = np.repeat(first[here], many) + np.arange(len(begun)) - np.repeat(np.cumsum(many) - many, many)
            key = state * lattice.width + self.code[here]
            at = np.minimum(np.searchsorted(lattice.keys, key), len(lattice.keys) - 1)
            ok = lattice.keys[at] == key
            begun, here, state, long = begun[ok], here[ok], lattice.next[at[ok]], long + 1
            is_piece = lattice.piece[state] >= 0
            if long == 1:
                single[here[is_piece]] = lattice.piece[state[is_piece]]
            else:
                froms.append(begun[is_piece])
                tos.append(here[is_piece])
                pieces.append(lattice.piece[state[is_piece]])
        self.a = np.concatenate([self.parent[1:], *froms])
        self.b = np.concatenate([np.arange(1, count), *tos])
        self.piece = np.concatenate([single[1:], *pieces])

    def bytes_of(self, node: np.ndarray) -> np.ndarray:
        """UTF-8 length of the last character of a node."""
        return 1 + (self.char[node] > 0x7F) + (self.char[node] > 0x7FF) + (self.char[node] > 0xFFFF)

    @staticmethod
    def sweep(total: np.ndarray, source: np.ndarray, target: np.ndarray, level: np.ndarray, weight: np.ndarray, merge, join=None) -> np.ndarray:
        """Values carried over the edges, level by level of the targets: ``merge``
        takes the runs of values that meet in a node, ``join`` adds what it had."""
        order = np.lexsort((target, level))
        src, dst, lev, add = source[order], target[order], level[order], weight[order]
        heads = np.flatnonzero(np.diff(dst, prepend=-1))  # one run of edges for each node
        cuts = np.flatnonzero(np.diff(lev[heads], prepend=np.iinfo(np.int64).min))
        for i, j in zip(cuts, [*cuts[1:], len(heads)]):
            lo, hi = heads[i], heads[j] if j < len(heads) else len(dst)
            run = heads[i:j] - lo
            value = merge(total[src[lo:hi]] + add[lo:hi], run, np.diff(run, append=hi - lo))
            total[dst[heads[i:j]]] = value if join is None else join(total[dst[heads[i:j]]], value)
        return total


class Lattice:
    """The piece table as a trie, and sums over the segmentations of many words.

    Words of up to ``WIDE`` characters go through one trie together: forward sums
    are computed once for each shared prefix, and backward sums, being linear,
    once for all words below a node.  Longer words go one by one, in lists of one
    number per character."""

    def __init__(self, scores: dict[str, float]):
        self.names = list(scores)
        self.logp = np.array([scores[p] for p in self.names])
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN
        self.chars = np.array(sorted({ord(c) for p in self.names for c in p}), dtype=np.int64)
        self.width = len(self.chars) + 1
        code = {c: i for i, c in enumerate(self.chars.tolist())}
        step, piece = {}, [-1]
        for no, p in enumerate(self.names):
            at = 0
            for c in p:
                key = at * self.width + code[ord(c)]
                if key not in step:
                    step[key] = len(piece)
                    piece.append(-1)
                at = step[key]
            piece[at] = no
        self.step = step
        self.keys = np.array(sorted(step), dtype=np.int64)
        self.next = np.array([step[k] for k in sorted(step)], dtype=np.int64)
        self.piece = np.array(piece, dtype=np.int64)

    def codes(self, chars: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.chars, chars)
        return np.where(np.append(self.chars, -1)[place] == chars, place, self.width - 1)

    def expected(self, words: list[str], times: np.ndarray) -> tuple[np.ndarray, float]:
        """Expected count of each piece over all segmentations of the words, and
        their log-likelihood; ``times`` weighs the words."""
        counts, value = np.zeros(len(self.names)), 0.0
        short = [i for i, w in enumerate(words) if len(w) <= WIDE]
        for i in set(range(len(words))).difference(short):
            value += self._one(words[i], float(times[i]), counts)
        if not short:
            return counts, value
        t, n = Trie(self, [words[i] for i in short]), np.asarray(times, dtype=float)[short]
        w = np.where(t.piece >= 0, self.logp[t.piece], self.unknown)
        ahead = np.full(len(t.depth), -np.inf)
        ahead[0] = 0.0
        Trie.sweep(ahead, t.a, t.b, t.depth[t.b], w, _log_sums)
        behind = np.zeros(len(t.depth))
        np.add.at(behind, t.word, n)
        with np.errstate(divide="ignore"):
            behind = np.log(behind) - ahead
            Trie.sweep(behind, t.b, t.a, -t.depth[t.a], w, _log_sums, np.logaddexp)
        known = t.piece >= 0
        share = np.exp(ahead[t.a[known]] + w[known] + behind[t.b[known]])
        return counts + np.bincount(t.piece[known], weights=share, minlength=len(self.names)), value + float(ahead[t.word] @ n)

    def matches(self, codes: list[int], at: int) -> Iterator[tuple[int, int]]:
        """(end, piece) of the pieces that begin at a place of a word."""
        state, get = 0, self.step.get
        for i in range(at, len(codes)):
            state = get(state * self.width + codes[i])
            if state is None:
                return
            if self.piece[state] >= 0:
                yield i + 1, int(self.piece[state])

    def _one(self, word: str, times: float, counts: np.ndarray) -> float:
        codes = self.codes(np.array([ord(c) for c in MARK + word], dtype=np.int64)).tolist()
        n = len(codes)

        def edges(at: int) -> list[tuple[int, int, float]]:
            found = [(e, p, float(self.logp[p])) for e, p in self.matches(codes, at)]
            return found if found and found[0][0] == at + 1 else [(at + 1, -1, self.unknown), *found]

        def total(values: list[float]) -> float:
            top = max(values)
            return top + math.log(sum(math.exp(v - top) for v in values))

        arriving: dict[int, list[float]] = {}
        ahead = [0.0] * (n + 1)
        for at in range(n):
            if at:
                ahead[at] = total(arriving.pop(at))
            for e, _, w in edges(at):
                arriving.setdefault(e, []).append(ahead[at] + w)
        ahead[n] = total(arriving[n])
        behind = [0.0] * (n + 1)
        for at in range(n - 1, -1, -1):
            out = edges(at)
            behind[at] = total([w + behind[e] for e, _, w in out])
            for e, p, w in out:
                if p >= 0:
                    counts[p] += times * math.exp(ahead[at] + w + behind[e] - ahead[n])
        return ahead[n] * times


def estimate(docs: DataFrame, pieces: Iterable[str], text: str = "text") -> dict[str, float]:
    """Log-probability of each piece, from all documents.  At most one row for
    each piece of the vocabulary reaches the driver in a round."""
    names = sorted(pieces)
    words = stored(pretoken_counts(docs, text).orderBy("word"), "token-words")  # neighbours share prefixes
    scores = dict.fromkeys(names, -math.log(max(1, len(names))))
    before = -math.inf
    while names:
        def run(batches: Iterator[pa.RecordBatch], scores=scores) -> Iterator[pa.RecordBatch]:
            lattice, counts, value = Lattice(scores), np.zeros(len(names)), 0.0
            for batch in batches:
                rows = [(w.decode("utf-8", "replace"), n) for w, n in zip(*(c.to_pylist() for c in batch.columns))]
                lo = 0
                while lo < len(rows):
                    hi, chars = lo, 0
                    while hi < len(rows) and (hi == lo or chars + len(rows[hi][0]) < CHARS):
                        chars += len(rows[hi][0])
                        hi += 1
                    more, gain = lattice.expected([r[0] for r in rows[lo:hi]], np.array([float(r[1]) for r in rows[lo:hi]]))
                    counts, value, lo = counts + more, value + gain, hi
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([-1, *some.tolist()], pa.int32()), pa.array([value, *counts[some]], pa.float64())],
                                             names=["piece", "n"])

        got = {r.piece: r.n for r in words.mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()}
        value = got.pop(-1, 0.0) + ADD * sum(scores.values())
        if value - before <= GAIN * abs(value):
            break
        before = value
        total = math.log(sum(got.values()) + ADD * len(names))
        # multiples of 2^-20: their sums are exact, so the order of additions decides no tie
        scores = {p: round((math.log(got.get(i, 0.0) + ADD) - total) * 2**20) / 2**20 for i, p in enumerate(names)}
    return scores


class Segmenter:
    """The best segmentation's token count: largest score sum, fewest tokens among
    equals.  Scores count in 2^-20ths, so that sums are exact and ties are ties."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.worst = min(pieces.values(), default=0.0) - UNKNOWN
        self.lattice = Lattice(pieces)
        # score and tokens in one integer; WIDE characters have fewer than 2^20 tokens
        self.units = np.round(np.append(self.lattice.logp, self.worst) * 2**20).astype(np.int64)
        self.joint = int(np.abs(self.units).max()) * (WIDE + 2) < 2**42

    def counts(self, words: Iterable[str]) -> dict[str, int]:
        """Token count of each pre-token.  The value of a trie node is computed once
        for all pre-tokens that share the prefix; terminal nodes hold the counts."""
        words = list(words)
        short = [w for w in words if self.joint and len(w) <= WIDE]
        out = self._by_one([w for w in words if not (self.joint and len(w) <= WIDE)])
        if short:
            t = Trie(self.lattice, short)
            tokens = np.where(t.piece >= 0, 1, t.bytes_of(t.b))
            best = Trie.sweep(np.zeros(len(t.depth), dtype=np.int64), t.a, t.b, t.depth[t.b], (self.units[t.piece] << 20) - tokens,
                              lambda value, run, size: np.maximum.reduceat(value, run))
            out.update(zip(short, (-best[t.word] & (1 << 20) - 1).tolist()))
        return out

    def _by_one(self, words: list[str]) -> dict[str, int]:
        """The same programme in lists, for words too long for the trie: ``score[i]``
        and ``least[i]`` are the state at place i of the current path, and going on
        to the next word in sorted order keeps those of the shared prefix."""
        out: dict[str, int] = {}
        score, least, path = [0], [0], ""
        units, worst = dict(zip(self.lattice.names, self.units.tolist())), int(self.units[-1])
        get = units.get
        for word in sorted(words):
            marked = MARK + word
            shared, limit = 0, min(len(path), len(marked))
            while shared < limit and path[shared] == marked[shared]:
                shared += 1
            del score[shared + 1:], least[shared + 1:]
            for i in range(shared + 1, len(marked) + 1):
                char = marked[i - 1]
                known = char in units
                best = score[i - 1] + (units[char] if known else worst)
                few = least[i - 1] + (1 if known else len(char.encode("utf-8", "surrogatepass")))
                for j in range(max(0, i - self.longest), i - 1):
                    s = get(marked[j:i])
                    if s is not None:
                        s += score[j]
                        if s > best or s == best and least[j] + 1 < few:
                            best, few = s, least[j] + 1
                score.append(best)
                least.append(few)
            path = marked
            out[word] = least[-1]
        return out


def count_tokens(docs: DataFrame, pieces: dict[str, float], doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: (doc, n_pretokens, n_tokens)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, known = Segmenter(pieces), {}
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                # bytes.split parts at ASCII white space only
                rows = [(x or b"").split() for x in part.column(1).to_pylist()]
                fresh = set().union(*rows).difference(known)
                if len(known) + len(fresh) > TRIE_ENTRIES:
                    known, fresh = {}, set().union(*rows)
                text_of = {w.decode("utf-8", "replace"): w for w in fresh}
                known.update((text_of[w], n) for w, n in seg.counts(list(text_of)).items())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(r) for r in rows], pa.int64()),
                     pa.array([sum(map(known.__getitem__, r)) for r in rows], pa.int64())], names=[doc, "n_pretokens", "n_tokens"])

    src = docs.select(F.col(doc).cast("long").alias(doc), F.col(text).cast("binary").alias("_t"))
    return src.mapInArrow(run, f"`{doc}` long, n_pretokens long, n_tokens long")
