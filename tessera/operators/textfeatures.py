"""Text features: answer flags, token encoding with padding, TF-IDF, and the
quality columns and model summary built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import WORD
from tessera.operators.retrieval import strip_ws

# Phrases marking an uncertain answer.
UNCERTAINTY_PHRASES = ["не знаю", "нет информации"]
PAD_TOKEN = "[PAD]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def has_content(text) -> Column:
    """Trimmed answer longer than 10 characters."""
    return F.char_length(strip_ws(_c(text))) > 10


def contains_uncertainty(text) -> Column:
    low = F.lower(_c(text))
    cond = F.lit(False)
    for p in UNCERTAINTY_PHRASES:
        cond = cond | F.contains(low, F.lit(p))
    return cond


def tokenize_pad(text, max_len: int = 128) -> Column:
    """Word tokens (lower-cased, split on non-word runs), truncated to
    ``max_len`` and padded with ``[PAD]``; the attention mask marks real tokens.
    Returns struct(input_tokens, attention_mask, n_tokens)."""
    toks = F.array_remove(F.split(F.lower(_c(text)), f"[^{WORD}]+"), "")
    head = F.slice(toks, 1, max_len)
    n = F.size(head)
    padded = F.concat(head, F.array_repeat(F.lit(PAD_TOKEN), F.lit(max_len) - n))
    mask = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(max_len) - n))
    return F.struct(padded.alias("input_tokens"), mask.alias("attention_mask"), n.alias("n_tokens"))


def tfidf(docs: DataFrame, key: str, text: str, vocab_size: int = 1000) -> DataFrame:
    """TF-IDF rows ``(key, term, weight)``: tokens of >= 2 word characters,
    vocabulary = the ``vocab_size`` most frequent terms of the corpus (ties by
    term), idf = ln((1 + n) / (1 + df)) + 1, raw counts, L2 norm per document.

    The vocabulary is a global top-k (bounded by ``vocab_size``), so it is the
    only side that is broadcast; every other step is keyed by document or term."""
    # hash-partition the documents once: the (doc, term) aggregation then needs no
    # shuffle of tokens (which outnumber the text several times), nor does the
    # window below: its rows are checkpointed as they are partitioned, so that the
    # texts are tokenised once for both readers
    from tessera.functions.text import by_key
    from tessera.operators.fixpoint import cut

    by_doc = by_key(docs.select(key, text), key)
    tok = by_doc.select(key, F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"[\p{L}\p{N}_]{2,}"), 0)).alias("term"))
    tf = cut(tok.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf")))
    # one pass over (doc, term) rows gives both the corpus frequency and the
    # document frequency of every term; the vocabulary keeps its df
    vocab = (
        tf.groupBy("term").agg(F.sum("tf").alias("freq"), F.count(F.lit(1)).alias("df"))
        .orderBy(F.col("freq").desc(), F.col("term").asc())
        .limit(vocab_size)
        .select("term", "df")
    )
    n_docs = docs.count()
    w = tf.join(F.broadcast(vocab), "term").select(  # vocabulary: <= vocab_size rows
        key, "term", (F.col("tf") * (F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0)).alias("w")
    )
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return w.select(key, "term", (F.col("w") / norm).alias("weight"))


def answer_quality(coverage: DataFrame) -> DataFrame:
    """The quality columns of each recorded answer (``coverage`` has pair_id,
    answer, keyword_coverage, matched_keywords_count); an answer without text is
    no success."""
    return coverage.select(
        "pair_id",
        F.char_length("answer").alias("answer_length"),
        (strip_ws(F.col("answer")) != "").alias("success"),
        has_content("answer").alias("answer_has_content"),
        contains_uncertainty("answer").alias("contains_uncertainty"),
        "keyword_coverage",
        "matched_keywords_count",
    )


def model_summary(frame: DataFrame, model: str = "model") -> DataFrame:
    """Per model: mean time, coverage, success share and answer length,
    rounded half-to-even to 3 places (pandas ``round``)."""
    return frame.groupBy(model).agg(
        F.bround(F.avg("generation_time"), 3).alias("avg_generation_time"),
        F.bround(F.avg("keyword_coverage"), 3).alias("avg_keyword_coverage"),
        F.bround(F.avg(F.col("success").cast("double")), 3).alias("success_rate"),
        F.bround(F.avg("answer_length"), 3).alias("avg_answer_length"),
    )
