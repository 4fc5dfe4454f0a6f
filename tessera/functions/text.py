"""Text column expressions: tokenisers, n-grams, keyword sets (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stop words of the keyword extractor (Russian function words).
KEYWORD_STOP_WORDS = ["и", "в", "на", "с", "по", "для", "это", "что", "как"]
KEYWORDS_KEPT = 10
# The white space of Python's str.strip and str.split, as a
# character class that Java and RE2 read alike (their \\s is ASCII only), and
# the characters of a word in any script.
SPACE = "\\t-\\r\\x1c-\\x20\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = r"\p{L}\p{N}_"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def by_key(df, key: str):
    """Hash-partition rows by ``key`` into the session's shuffle-partition
    count.  The count is explicit so that AQE does not coalesce the (small)
    text shuffle into a few partitions: the token work after it is several
    times larger than the text that moved."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key)


def nonempty(arr: Column) -> Column:
    return F.array_remove(arr, "")


def whitespace_tokens(text) -> Column:
    """Python ``str.split()``: split on whitespace runs, no empty tokens."""
    return nonempty(F.split(_c(text), f"[{SPACE}]+"))


def rouge_tokens(text, mode: str = "ascii") -> Column:
    """ROUGE tokeniser: lower-case, anything but [a-z0-9] separates ("ascii",
    the scorer's default, which drops non-Latin letters) or anything but
    letters/digits separates ("unicode")."""
    low = F.lower(_c(text))
    if mode == "ascii":
        cleaned = F.regexp_replace(low, "[^a-z0-9]+", " ")
    elif mode == "unicode":
        cleaned = F.regexp_replace(low, r"[^\p{L}\p{N}]+", " ")
    else:
        raise ValueError(mode)
    return nonempty(F.split(cleaned, " "))


def bleu_tokens(text) -> Column:
    """Word runs and single punctuation marks as separate tokens (case kept)."""
    return F.regexp_extract_all(_c(text), F.lit(f"([{WORD}]+|[^{WORD}{SPACE}])"), 1)


def ngrams(tokens, n: int) -> Column:
    """Array of the n-grams (space-joined) of a token array; empty when
    shorter than n.  Tokens hold no whitespace, so every overlapping n-gram is
    the lookahead capture at each token start of the space-joined text (a
    codegen'd regex instead of an interpreted lambda per position)."""
    toks = _c(tokens)
    if n == 1:
        return toks
    pattern = r"(?=(\S+" + r"(?: \S+)" * (n - 1) + r"))\S+"
    return F.regexp_extract_all(F.array_join(toks, " "), F.lit(pattern), 1)


def word_count(text) -> Column:
    return F.size(whitespace_tokens(text))


def keywords(text, kept: int = KEYWORDS_KEPT) -> Column:
    """Distinct lower-cased whitespace words longer than 3 chars, stop words
    removed, sorted, the first ``kept`` (the original keeps an arbitrary 10 of
    the set; ours is ordered so that the result is reproducible)."""
    stop = F.array(*[F.lit(w) for w in KEYWORD_STOP_WORDS])
    # maximal runs of >= 4 non-whitespace characters (code points) = the
    # whitespace tokens longer than 3; a codegen'd regex, no per-word lambda
    run = f"(?<![^{SPACE}])[^{SPACE}]{{4,}}(?![^{SPACE}])"
    words = F.regexp_extract_all(F.lower(_c(text)), F.lit(run), 0)
    return F.slice(F.array_sort(F.array_except(words, stop)), 1, kept)  # array_except also de-duplicates
