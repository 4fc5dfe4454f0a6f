"""Evaluation of retrieval and of generated text, as Spark jobs.

Retrieval metrics are computed per case from a hit frame and a relevance
frame (never a Python loop); n-gram and sequence metrics are computed in the
row of each pair, so only the texts themselves move; all metrics meet in one
long table (case, metric, value), which one aggregation rolls up."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions import vector as vx

# Overall-score weights and advice thresholds of the evaluator.
OVERALL_WEIGHTS = {"precision": 0.3, "recall": 0.2, "semantic_similarity": 0.3, "rougeL": 0.2}
ADVICE = [
    ("mean_precision", 0.7, "• Улучшить точность поиска: настроить эмбеддинг-модель или увеличить размер базы знаний"),
    ("mean_recall", 0.6, "• Увеличить полноту поиска: рассмотреть использование гибридного поиска"),
    ("mean_semantic_similarity", 0.7,
     "• Улучшить качество генерации: настроить промпты или использовать более мощную языковую модель"),
    ("mean_rougeL", 0.4, "• Работать над соответствием эталонным ответам: добавить few-shot примеры в промпты"),
]
ADVICE_DEFAULT = "• Система показывает хорошие результаты! Рекомендуется продолжить мониторинг качества."


def safe_div(num: Column, den: Column) -> Column:
    """num / den, 0.0 when the denominator is 0 (or null)."""
    return F.when(F.coalesce(den, F.lit(0)) == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def harmonic(p: Column, r: Column) -> Column:
    return F.when((p + r) == 0, F.lit(0.0)).otherwise(2.0 * p * r / (p + r))


def retrieval_metrics(hits: DataFrame, relevant_count: DataFrame, key: str = "qid") -> DataFrame:
    """Per-case precision/recall/F1/MRR.

    ``hits``: (key, id, rank, is_relevant) with the retrieved ids (duplicates
    allowed; precision counts distinct ids).  ``relevant_count``: (key,
    n_relevant).  Cases with no hit get zeros (left join from relevant_count);
    ``top_score`` is the best hit score (when the hits carry ``score``)."""
    score = F.max("score") if "score" in hits.columns else F.lit(None).cast("double")
    per_id = hits.groupBy(key, "id").agg(F.min("rank").alias("rank"), F.max(F.col("is_relevant").cast("int")).alias("rel"),
                                         score.alias("score"))
    per_case = per_id.groupBy(key).agg(
        F.count(F.lit(1)).alias("retrieved_count"),
        F.sum("rel").cast("long").alias("hits_relevant"),
        F.min(F.when(F.col("rel") == 1, F.col("rank"))).alias("first_rank"),
        F.max("score").alias("top_score"),
    )
    out = relevant_count.join(per_case, on=key, how="left")
    ret = F.coalesce(F.col("retrieved_count"), F.lit(0)).cast("long")
    both = F.coalesce(F.col("hits_relevant"), F.lit(0)).cast("long")
    p = safe_div(both, ret)
    r = safe_div(both, F.col("n_relevant"))
    return out.select(
        key,
        ret.alias("retrieved_count"),
        F.col("n_relevant").cast("long").alias("relevant_count"),
        both.alias("overlap"),
        p.alias("precision"),
        r.alias("recall"),
        harmonic(p, r).alias("f1_score"),
        F.coalesce(1.0 / F.col("first_rank").cast("double"), F.lit(0.0)).alias("mrr"),
        F.col("top_score"),
    )


def mean_std_min_max(df: DataFrame, metrics: list[str], group: list[str] | None = None) -> DataFrame:
    """mean, population std, min, max of each metric (nulls skipped; 0.0 when empty)."""
    aggs = []
    for m in metrics:
        aggs += [
            F.coalesce(F.avg(m), F.lit(0.0)).alias(f"mean_{m}"),
            F.coalesce(F.stddev_pop(m), F.lit(0.0)).alias(f"std_{m}"),
            F.coalesce(F.min(m).cast("double"), F.lit(0.0)).alias(f"min_{m}"),
            F.coalesce(F.max(m).cast("double"), F.lit(0.0)).alias(f"max_{m}"),
        ]
    return (df.groupBy(*group) if group else df.groupBy()).agg(*aggs)


def overall_score(precision: Column, recall: Column, similarity: Column, rouge_l: Column) -> Column:
    w = OVERALL_WEIGHTS
    z = F.lit(0.0)
    return (
        F.coalesce(precision, z) * w["precision"]
        + F.coalesce(recall, z) * w["recall"]
        + F.coalesce(similarity, z) * w["semantic_similarity"]
        + F.coalesce(rouge_l, z) * w["rougeL"]
    )


def advice(metrics: dict[str, Column]) -> Column:
    """Advice lines for metrics under their thresholds, or the default line."""
    items = F.array_compact(
        F.array(*[F.when(metrics[name] < thr, F.lit(text)) for name, thr, text in ADVICE])
    )
    return F.when(F.size(items) == 0, F.lit(ADVICE_DEFAULT)).otherwise(F.array_join(items, "\n"))


# --- n-gram and sequence metrics, in the row ------------------------------------
#
# The tokens of a pair are made once, by Spark; what two token arrays share is
# counted by a small function on the pair's own row, over Arrow batches: no n-gram
# leaves the row, nothing is joined back.  The texts are dealt to the session's
# partitions first (``by_key``): they are small against the work on them.

def _bind(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns in a projection of their own, so that the next step refers to
    their values instead of repeating the expressions."""
    return df.select("*", *[c.alias(name) for name, c in cols.items()])


def shared_grams(pred: list[str], ref: list[str], orders: list[int]) -> list[int]:
    """For each of the ascending ``orders`` the sum over the n-grams of the smaller
    of their two counts; with no shared gram there is none of a higher order."""
    out = [0] * len(orders)
    for place, n in enumerate(orders):
        few, many = (zip(*(t[i:] for i in range(n))) if n > 1 else t for t in sorted((pred, ref), key=len))
        few = Counter(few)
        shared = Counter(filter(few.__contains__, many))
        out[place] = sum(min(c, few[g]) for g, c in shared.items())
        if not out[place]:
            break
    return out


def lcs_length(pred: list[str], ref: list[str]) -> int:
    """Length of the longest common subsequence.

    A column of the dynamic programme is a bit vector over the positions of the
    shorter sequence, an integer of as many bits; each token of the longer one
    updates it by one addition (Hyyrö 2004).  Tokens that only one of them has are
    left out first."""
    both = set(pred) & set(ref)
    few, many = sorted(([t for t in x if t in both] for x in (pred, ref)), key=len)
    places: dict[str, int] = {}
    for i, t in enumerate(few):
        places[t] = places.get(t, 0) | 1 << i
    full = (1 << len(few)) - 1
    v = full
    for t in many:
        hit = v & places[t]
        v = (v + hit | v - hit) & full
    return len(few) - v.bit_count()


def _split(texts) -> list[list[str]]:
    return [x.split(" ") if x else [] for x in texts]


def _joined(tokens: str) -> Column:
    return F.array_join(tokens, " ")  # tokens hold no space


def with_overlaps(df: DataFrame, pred: str, ref: str, orders: list[int]) -> DataFrame:
    """Adds ``pred_total{n}``, ``ref_total{n}`` and ``overlap{n}`` (sum over the
    n-grams of the smaller of their two counts) for the token arrays ``pred`` and
    ``ref``."""
    orders = sorted(orders)

    @F.pandas_udf("array<long>")
    def overlaps(preds: pd.Series, refs: pd.Series) -> pd.Series:
        return pd.Series([shared_grams(p, r, orders) for p, r in zip(_split(preds), _split(refs))], dtype=object)

    total = lambda t, n: F.greatest(F.size(t) - (n - 1), F.lit(0)).cast("long")
    out = _bind(df, _overlaps=overlaps(_joined(pred), _joined(ref)))
    totals = {f"{side}_total{n}": total(t, n) for n in orders for side, t in (("pred", pred), ("ref", ref))}
    return _bind(out, **totals, **{f"overlap{n}": F.get("_overlaps", F.lit(i)) for i, n in enumerate(orders)}).drop("_overlaps")


def with_lcs(df: DataFrame, pred: str, ref: str, out: str = "lcs") -> DataFrame:
    """Adds the length of the longest common subsequence of two token arrays
    (``lcs_length``): |longer| steps on |shorter| bits, and as many bits for each
    distinct token that both have."""
    @F.pandas_udf("long")
    def lcs(preds: pd.Series, refs: pd.Series) -> pd.Series:
        return pd.Series([lcs_length(p, r) for p, r in zip(_split(preds), _split(refs))], dtype="int64")

    return _bind(df, **{out: lcs(_joined(pred), _joined(ref))})


def f_measure(overlap: Column, pred_total: Column, ref_total: Column) -> Column:
    return harmonic(safe_div(overlap, pred_total), safe_div(overlap, ref_total))


def _tokens(pairs: DataFrame, pred: str, ref: str, tokens) -> DataFrame:
    return _bind(pairs, _pt=tokens(F.coalesce(F.col(pred), F.lit(""))), _rt=tokens(F.coalesce(F.col(ref), F.lit(""))))


def with_rouge(pairs: DataFrame, pred: str, ref: str, orders=(1, 2), longest: bool = False, mode: str = "ascii") -> DataFrame:
    """Adds ``rouge{n}`` for each order and, with ``longest``, ``lcs`` and ``rougeL``
    (F-measures; a missing text counts as empty)."""
    out = _tokens(pairs, pred, ref, lambda x: tx.rouge_tokens(x, mode))
    counts = [f"{c}{n}" for n in orders for c in ("pred_total", "ref_total", "overlap")]
    if orders:
        out = with_overlaps(out, "_pt", "_rt", list(orders))
        out = _bind(out, **{f"rouge{n}": f_measure(F.col(f"overlap{n}"), F.col(f"pred_total{n}"), F.col(f"ref_total{n}")) for n in orders})
    if longest:
        out = with_lcs(out, "_pt", "_rt")
        out = _bind(out, rougeL=f_measure(F.col("lcs"), F.size("_pt"), F.size("_rt")))
    return out.drop("_pt", "_rt", *counts)


def with_bleu(pairs: DataFrame, pred: str, ref: str, max_order: int = 4) -> DataFrame:
    """Adds ``bleu``: corpus BLEU of one (prediction, reference) pair, no smoothing:
    geometric mean of clipped n-gram precisions (0 if any is 0) times the
    brevity penalty exp(1 - r/c) when the prediction is not longer."""
    orders = list(range(1, max_order + 1))
    out = with_overlaps(_tokens(pairs, pred, ref, tx.bleu_tokens), "_pt", "_rt", orders)
    precision = [safe_div(F.col(f"overlap{n}"), F.col(f"pred_total{n}")) for n in orders]
    logs = sum((F.log(p) for p in precision[1:]), F.log(precision[0]))
    geo = F.when(F.least(*precision) > 0, F.exp(logs / F.lit(float(max_order)))).otherwise(F.lit(0.0))
    c, r = F.col("pred_total1"), F.col("ref_total1")
    penalty = F.when(c == 0, F.lit(0.0)).when(c > r, F.lit(1.0)).otherwise(F.exp(1.0 - r.cast("double") / c.cast("double")))
    counts = [f"{x}{n}" for n in orders for x in ("pred_total", "ref_total", "overlap")]
    return _bind(out, bleu=geo * penalty).drop("_pt", "_rt", *counts)


def rouge_n(pairs: DataFrame, key: str, pred: str, ref: str, orders=(1, 2), mode: str = "ascii") -> DataFrame:
    """ROUGE-n F-measure per pair, one column ``rouge{n}`` per order."""
    return with_rouge(tx.by_key(pairs.select(key, pred, ref), key), pred, ref, orders, mode=mode).select(key, *[f"rouge{n}" for n in orders])


def rouge_l(pairs: DataFrame, key: str, pred: str, ref: str, mode: str = "ascii") -> DataFrame:
    """ROUGE-L F-measure per pair: P = lcs/|pred|, R = lcs/|ref| over whole texts."""
    return with_rouge(tx.by_key(pairs.select(key, pred, ref), key), pred, ref, (), longest=True, mode=mode).select(key, "lcs", "rougeL")


def bleu(pairs: DataFrame, key: str, pred: str, ref: str, max_order: int = 4) -> DataFrame:
    return with_bleu(tx.by_key(pairs.select(key, pred, ref), key), pred, ref, max_order).select(key, "bleu")


GENERATION_METRICS = ["rouge1", "rouge2", "rougeL", "bleu", "semantic_similarity"]


def generation_metrics(pairs: DataFrame, pred: str, ref: str, pred_vec: str | None = None, ref_vec: str | None = None) -> DataFrame:
    """Adds every metric of a generated answer against its reference: ROUGE-1/2/L,
    BLEU, the cosine of the stored vectors (null without both) and the answer's
    length in words."""
    out = with_bleu(with_rouge(pairs, pred, ref, (1, 2), longest=True), pred, ref)
    similarity = vx.cosine(pred_vec, ref_vec) if pred_vec and ref_vec else F.lit(None).cast("double")
    return _bind(out, semantic_similarity=similarity, answer_length=tx.word_count(F.coalesce(F.col(pred), F.lit("")))).drop("lcs")


# --- one long metric table, rolled up once ---------------------------------------

def metric_rows(df: DataFrame, keep: list[str], metrics: list[str]) -> DataFrame:
    """(keep..., metric, value): one row for every metric that a row of ``df`` has."""
    each = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return df.select(*keep, F.inline(each)).filter("value is not null")


def rollup(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """(group_type, group_value, metric, n, mean, std, min, max) of a long metric
    table, overall and for each dimension alone, in one aggregation.  std is the
    population's."""
    sets = [["metric"], *[["metric", d] for d in dimensions]]
    in_set = [F.grouping(d) == 0 for d in dimensions]
    out = rows.groupingSets(sets, "metric", *dimensions).agg(
        F.coalesce(*[F.when(c, F.lit(d)) for c, d in zip(in_set, dimensions)], F.lit("overall")).alias("group_type"),
        F.coalesce(*[F.when(c, F.col(d).cast("string")) for c, d in zip(in_set, dimensions)]).alias("group_value"),
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    return out.select("group_type", "group_value", "metric", "n", "mean", "std", "min", "max")


def means(rolled: DataFrame, metrics: list[str]) -> DataFrame:
    """One row a group with ``mean_{metric}``; null where the group has no such metric."""
    return rolled.groupBy("group_type", "group_value").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("mean"))).alias(f"mean_{m}") for m in metrics])


def keyword_coverage(context_text: Column, answer_text: Column) -> tuple[Column, Column]:
    """(coverage, matched count): share of the context keywords found among the
    answer keywords; 0 when the context has no keyword."""
    ck = tx.keywords(context_text)
    ak = tx.keywords(answer_text)
    matched = F.size(F.array_intersect(ck, ak))
    return safe_div(matched, F.size(ck)), matched
