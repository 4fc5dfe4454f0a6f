"""Retrieval, retrieval metrics and evaluation rollups over ``embeddings`` /
``documents`` / ``conversations``.

Fixture: every embedding is a question against the collection of all other
embeddings (whole table, self excluded); a hit is relevant when it carries
the question's ``label``; the content of vector ``i`` is document ``i``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import SPACE, by_key
from tessera.operators import evaluation as ev
from tessera.operators import retrieval as rt
from tessera.operators.knn import knn, knn_self
from tessera.operators.requests import ERR_EMPTY, ERR_TOO_LONG, TEXT_MAX_CHARS, TEXT_MIN_CHARS, length_error
from tessera.plans.registry import register
from tessera.sources.files import stored
from tessera.sources.tables import Tables

THRESHOLD = 0.25  # fixture threshold (the 0.6 default leaves no non-self hit on this data)


def self_knn(spark: SparkSession, sf_dir: str, k: int, metric: str = "cosine", where_label: int | None = None) -> DataFrame:
    """Every embedding against all others.  Without a metadata filter the
    query set is the collection, so the symmetric form scores each block pair
    once; with a filter the collection is pre-filtered (before ranking)."""
    e = Tables(spark, sf_dir).embeddings
    if where_label is None:
        return knn_self(e, k, id_col="vec_id", metric=metric)
    coll = e.filter(F.col("label") == where_label)
    return knn(e, coll, k, query_id="vec_id", id_col="vec_id", metric=metric, exclude_self=True)


def knn_sql(k: int, where: str = "") -> str:
    return f"""
e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pairs AS (
  SELECT a.vec_id AS qid, b.vec_id AS id,
         round(list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))), 12) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id {where}),
hits AS (
  SELECT qid, id, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS INTEGER) AS rank
  FROM pairs QUALIFY rank <= {k})"""


# --- kNN and ranking ----------------------------------------------------------

@register("join_knn_exact", sql=f"WITH {knn_sql(5)} SELECT qid, id AS vec_id, round(score, 6) AS score, rank FROM hits")
def join_knn_exact(spark, sf_dir):
    h = self_knn(spark, sf_dir, 5)
    return h.select("qid", F.col("id").alias("vec_id"), F.round("score", 6).alias("score"), "rank")


@register("win_rank", sql=f"WITH {knn_sql(5)} SELECT qid, id AS vec_id, round(1 - score, 6) AS distance, rank FROM hits")
def win_rank(spark, sf_dir):
    h = self_knn(spark, sf_dir, 5)
    return h.select("qid", F.col("id").alias("vec_id"), F.round(1 - F.col("score"), 6).alias("distance"), "rank")


@register(
    "join_knn_filtered",
    sql=f"WITH {knn_sql(3, 'AND b.label = 3')} SELECT qid, id AS vec_id, round(score, 6) AS score, rank FROM hits",
)
def join_knn_filtered(spark, sf_dir):
    h = self_knn(spark, sf_dir, 3, where_label=3)
    return h.select("qid", F.col("id").alias("vec_id"), F.round("score", 6).alias("score"), "rank")


@register(
    "join_knn_l2",
    sql="""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pairs AS (
  SELECT a.vec_id AS qid, b.vec_id AS id,
         round(list_dot_product(a.v, a.v) - 2 * list_dot_product(a.v, b.v) + list_dot_product(b.v, b.v), 12) AS d
  FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT qid, id AS vec_id, round(d, 6) AS distance,
       CAST(row_number() OVER (PARTITION BY qid ORDER BY d, id) AS INTEGER) AS rank
FROM pairs QUALIFY rank <= 5""",
)
def join_knn_l2(spark, sf_dir):
    h = self_knn(spark, sf_dir, 5, metric="l2")
    return h.select("qid", F.col("id").alias("vec_id"), F.round("score", 6).alias("distance"), "rank")


@register(
    "flt_similarity_threshold",
    sql=f"WITH {knn_sql(5)} SELECT qid, id AS vec_id, round(score, 6) AS score, rank FROM hits "
    f"WHERE coalesce(score, 0) >= {THRESHOLD}",
)
def flt_similarity_threshold(spark, sf_dir):
    h = rt.similarity_threshold(self_knn(spark, sf_dir, 5), THRESHOLD)
    return h.select("qid", F.col("id").alias("vec_id"), F.round("score", 6).alias("score"), "rank")


@register(
    "sort_stable_desc",
    sql=f"WITH {knn_sql(5)} SELECT qid, id AS vec_id, round(score, 6) AS score, "
    "CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, rank) AS INTEGER) AS pos "
    f"FROM hits WHERE score >= {THRESHOLD}",
)
def sort_stable_desc(spark, sf_dir):
    h = rt.stable_desc_position(rt.similarity_threshold(self_knn(spark, sf_dir, 5), THRESHOLD))
    return h.select("qid", F.col("id").alias("vec_id"), F.round("score", 6).alias("score"), "pos")


@register(
    "win_context_budget",
    sql="""SELECT doc_id, source, n_chars FROM (
  SELECT doc_id, source, n_chars,
         sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM documents) WHERE run <= 2000""",
)
def win_context_budget(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "source", "n_chars")
    return rt.context_budget(d, ["source"], ["doc_id"], "n_chars", 2000).select("doc_id", "source", "n_chars")


# --- the flagship: retrieve -> threshold -> stable sort -> budget -> response ----

def retrieve_pipeline(spark: SparkSession, sf_dir: str, k: int = rt.TOP_K, threshold: float = THRESHOLD,
                      budget: int = rt.MAX_CONTEXT_LENGTH, generator_factory=None) -> DataFrame:
    """Questions = every embedding (the text of document ``qid``).  A question
    without text, or beyond a request's length, fails: it is not searched for and
    its response tells the error.  With a ``generator_factory`` the kept documents become a numbered context, the
    prompt goes through the user's generator (batched, ``mapInPandas``) and
    the answer is cut after the prompt and post-processed."""
    t = Tables(spark, sf_dir)
    lengths = t.documents.select(F.col("doc_id").alias("qid"), "n_chars")  # of the texts, which need not be read
    asked = t.embeddings.select(F.col("vec_id").alias("qid"), "embedding").join(lengths, "qid", "left")
    asked = asked.select("qid", "embedding", length_error(F.col("n_chars")).alias("error"))
    questions = asked.select("qid", "error")
    hits = knn(asked.filter("error is null"), t.embeddings, k, id_col="vec_id", exclude_self=True)
    hits = rt.similarity_threshold(hits, threshold)
    hits = rt.stable_desc_position(hits)
    docs = t.documents.select(F.col("doc_id").alias("id"), F.col("n_chars").alias("doc_length"))
    hits = hits.join(docs, on="id", how="left").withColumn("doc_length", F.coalesce(F.col("doc_length"), F.lit(0)))
    kept = rt.context_budget(hits, ["qid"], ["pos"], "doc_length", budget, rows_per_key_bounded=True)  # <= k per qid
    answers = None
    if generator_factory is not None:
        from tessera.operators import hooks

        content = t.documents.select(F.col("doc_id").alias("id"), F.col("text").alias("content"),
                                     F.col("source").alias("title"))
        hits_content = kept.join(content, "id", "left").fillna("", ["content", "title"])
        ctx = rt.context_string(hits_content, "qid", "pos", "title", "score", "content")
        qtext = t.documents.select(F.col("doc_id").alias("qid"), F.col("text").alias("question"))
        prompts = ctx.join(qtext, "qid", "left").select(
            "qid", rt.prompt(F.col("context"), F.coalesce(F.col("question"), F.lit(""))).alias("prompt"))
        gen = hooks.generate(prompts, "prompt", generator_factory)
        raw = F.coalesce(rt.extract_after_prompt(F.col("generated"), F.col("prompt")), F.col("generated"))
        answers = gen.select("qid", rt.postprocess(raw).alias("answer"))
    return rt.assemble_response(questions, kept, answers=answers, error="error")


RAG_SQL = f"""WITH {knn_sql(5)},
asked AS (SELECT vec_id AS qid, CASE WHEN n_chars IS NULL OR n_chars < {TEXT_MIN_CHARS} THEN '{ERR_EMPTY}'
    WHEN n_chars > {TEXT_MAX_CHARS} THEN '{ERR_TOO_LONG}' END AS error FROM embeddings LEFT JOIN documents ON doc_id = vec_id),
f AS (
  SELECT h.qid, h.id, h.score, coalesce(d.n_chars, 0) AS len,
         row_number() OVER (PARTITION BY h.qid ORDER BY h.score DESC, h.rank) AS pos
  FROM hits h JOIN asked ON asked.qid = h.qid AND error IS NULL LEFT JOIN documents d ON d.doc_id = h.id WHERE h.score >= {THRESHOLD}),
b AS (SELECT *, sum(len) OVER (PARTITION BY qid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM f),
k AS (SELECT qid, count(*) AS n_docs, string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) AS doc_ids,
             CAST(sum(len) AS BIGINT) AS context_chars, round(max(score), 6) AS best_score
      FROM b WHERE run <= 2000 GROUP BY qid)
SELECT q.qid, CAST(coalesce(k.n_docs, 0) AS BIGINT) AS n_docs, coalesce(k.doc_ids, '') AS doc_ids,
       CAST(coalesce(k.context_chars, 0) AS BIGINT) AS context_chars, k.best_score,
       CASE WHEN error IS NOT NULL THEN 'error' WHEN coalesce(k.n_docs, 0) = 0 THEN 'no_context' ELSE 'ready' END AS status,
       CASE WHEN error IS NOT NULL THEN '{rt.ERROR_ANSWER}' || error WHEN coalesce(k.n_docs, 0) = 0 THEN '{rt.NO_CONTEXT_ANSWER}' END AS answer
FROM asked q LEFT JOIN k ON k.qid = q.qid"""


@register("rag_retrieve_pipeline", sql=RAG_SQL)
def rag_retrieve_pipeline(spark, sf_dir):
    return retrieve_pipeline(spark, sf_dir)


@register(
    "rag_ask_top3",
    sql=f"""WITH {knn_sql(3)}
SELECT qid, count(*) AS n_docs, arg_min(id, rank) AS best_id, round(max(score), 6) AS best_score
FROM hits GROUP BY qid""",
)
def rag_ask_top3(spark, sf_dir):
    h = self_knn(spark, sf_dir, 3)
    return h.groupBy("qid").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min_by("id", "rank").alias("best_id"), F.round(F.max("score"), 6).alias("best_score")
    )


# --- retrieval metrics ----------------------------------------------------------

def case_metrics(spark: SparkSession, sf_dir: str, k: int = 5, hits: DataFrame | None = None) -> DataFrame:
    """Per question: precision, recall, F1, MRR of the top-k against the
    same-label vectors (self excluded from both sides)."""
    e = Tables(spark, sf_dir).embeddings.select("vec_id", "label")
    h = self_knn(spark, sf_dir, k) if hits is None else hits
    q = e.select(F.col("vec_id").alias("qid"), F.col("label").alias("qlabel"))
    c = e.select(F.col("vec_id").alias("id"), F.col("label").alias("clabel"))
    hits = h.join(q, "qid").join(c, "id").withColumn("is_relevant", F.coalesce(F.col("qlabel") == F.col("clabel"), F.lit(False)))
    per_label = e.groupBy("label").agg((F.count(F.lit(1)) - 1).alias("n_relevant"))
    # a question without a label has no relevant document and scores 0
    relevant = q.join(per_label, q.qlabel == per_label.label, "left").select("qid", F.coalesce("n_relevant", F.lit(0)).alias("n_relevant"))
    return ev.retrieval_metrics(hits, relevant, "qid")


CASE_SQL = f"""{knn_sql(5)},
lab AS (SELECT label, count(*) - 1 AS n_rel FROM embeddings GROUP BY label),
hl AS (SELECT h.qid, h.id, h.rank, (qe.label = ce.label) AS rel
       FROM hits h JOIN embeddings qe ON qe.vec_id = h.qid JOIN embeddings ce ON ce.vec_id = h.id),
pc AS (SELECT qid, count(DISTINCT id) AS ret, count(DISTINCT CASE WHEN rel THEN id END) AS ov,
              min(CASE WHEN rel THEN rank END) AS fr FROM hl GROUP BY qid),
cm0 AS (SELECT q.vec_id AS qid, CAST(coalesce(pc.ret, 0) AS BIGINT) AS retrieved_count, CAST(coalesce(lab.n_rel, 0) AS BIGINT) AS relevant_count,
               CAST(coalesce(pc.ov, 0) AS BIGINT) AS overlap,
               CASE WHEN coalesce(pc.ret, 0) = 0 THEN 0.0 ELSE coalesce(pc.ov, 0) / pc.ret END AS precision,
               CASE WHEN coalesce(lab.n_rel, 0) = 0 THEN 0.0 ELSE coalesce(pc.ov, 0) / lab.n_rel END AS recall,
               coalesce(1.0 / pc.fr, 0.0) AS mrr
        FROM embeddings q LEFT JOIN lab ON lab.label = q.label LEFT JOIN pc ON pc.qid = q.vec_id),
cm AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1_score FROM cm0)"""


@register("join_set_overlap", sql=f"WITH {CASE_SQL} SELECT qid, overlap FROM cm")
def join_set_overlap(spark, sf_dir):
    return case_metrics(spark, sf_dir).select("qid", "overlap")


@register(
    "agg_retrieval_prf",
    sql=f"WITH {CASE_SQL} SELECT qid, retrieved_count, relevant_count, round(precision, 6) AS precision, "
    "round(recall, 6) AS recall, round(f1_score, 6) AS f1_score FROM cm",
)
def agg_retrieval_prf(spark, sf_dir):
    m = case_metrics(spark, sf_dir)
    return m.select("qid", "retrieved_count", "relevant_count", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1_score")])


@register("agg_mrr", sql=f"WITH {CASE_SQL} SELECT qid, round(mrr, 6) AS mrr FROM cm")
def agg_mrr(spark, sf_dir):
    return case_metrics(spark, sf_dir).select("qid", F.round("mrr", 6).alias("mrr"))


_METRICS = ["precision", "recall", "f1_score", "mrr"]


@register(
    "agg_mean_std_min_max",
    sql=f"WITH {CASE_SQL} SELECT "
    + ", ".join(
        f"round(coalesce(avg({m}), 0.0), 6) AS mean_{m}, round(coalesce(stddev_pop({m}), 0.0), 6) AS std_{m}, "
        f"round(coalesce(min({m}), 0.0), 6) AS min_{m}, round(coalesce(max({m}), 0.0), 6) AS max_{m}"
        for m in _METRICS
    )
    + " FROM cm",
)
def agg_mean_std_min_max(spark, sf_dir):
    out = ev.mean_std_min_max(case_metrics(spark, sf_dir), _METRICS)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@register(
    "agg_dataset_stats",
    sql="""SELECT CASE grouping(lang, source) WHEN 3 THEN 'total' WHEN 1 THEN 'by_category' ELSE 'by_difficulty' END AS stat,
       lang AS category, source AS difficulty, count(*) AS n
FROM documents GROUP BY GROUPING SETS ((), (lang), (source))""",
)
def agg_dataset_stats(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    g = d.groupingSets([[], ["lang"], ["source"]], "lang", "source").agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id("lang", "source").alias("gid")
    )
    stat = F.when(F.col("gid") == 3, "total").when(F.col("gid") == 1, "by_category").otherwise("by_difficulty")
    return g.select(stat.alias("stat"), F.col("lang").alias("category"), F.col("source").alias("difficulty"), "n")


# --- evaluation of cases: retrieval and generated answers, one long metric table -------

def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn and the assistant turn right after it (equi-join on
    (conv_id, turn + 1); no window, so no conversation is gathered whole)."""
    c = Tables(spark, sf_dir).conversations
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = c.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return u.join(a, ["conv_id", "turn"]).withColumn(
        "pair_id", F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    )


PAIRS_SQL = """qa AS (
  SELECT u.conv_id, u.turn, CAST(u.conv_id AS VARCHAR) || ':' || CAST(u.turn AS VARCHAR) AS pair_id,
         u.text AS question, a.text AS answer
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""


GENERATION = [*ev.GENERATION_METRICS, "answer_length"]


def generation_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(case_id, turn, generation metrics) of every question/answer pair.  The
    case is the conversation; the stored vector of the question is that of the
    case, the answer's the one ``turn + 1`` places after it."""
    e = Tables(spark, sf_dir).embeddings.select("vec_id", F.col("embedding").alias("vec"))
    pairs = qa_pairs(spark, sf_dir).select(F.col("conv_id").alias("case_id"), "turn", "question", "answer")
    asked = e.select(F.col("vec_id").alias("case_id"), F.col("vec").alias("question_vec"))
    told = e.select(F.col("vec_id").alias("_answer_id"), F.col("vec").alias("answer_vec"))
    with_vectors = pairs.join(asked, "case_id", "left").join(told, F.col("case_id") + F.col("turn") + 1 == F.col("_answer_id"), "left")
    return ev.generation_metrics(by_key(with_vectors, "case_id"), "answer", "question", "answer_vec", "question_vec").select("case_id", "turn", *GENERATION)


def case_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category and difficulty of a case: language and source of its document."""
    return Tables(spark, sf_dir).documents.select(F.col("doc_id").alias("case_id"), F.col("lang").alias("category"), F.col("source").alias("difficulty"))


def metric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(case_id, turn, category, difficulty, metric, value): retrieval metrics of
    every question, generation metrics of every answer (``turn`` says which)."""
    found = case_metrics(spark, sf_dir).select(F.col("qid").alias("case_id"), F.lit(None).cast("long").alias("turn"), *_METRICS)
    rows = ev.metric_rows(found, ["case_id", "turn"], _METRICS).unionByName(
        ev.metric_rows(generation_cases(spark, sf_dir), ["case_id", "turn"], GENERATION))
    return rows.join(case_groups(spark, sf_dir), "case_id", "left").select("case_id", "turn", "category", "difficulty", "metric", "value")


def grouped_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.rollup(metric_table(spark, sf_dir), ["category", "difficulty"])


def _metric_table_sql() -> str:
    """CTEs ending in ``mt`` (the metric table) and ``ru`` (its rollup)."""
    from tessera.plans.text_queries import bleu_sql, bleu_tok_sql, f_sql, lcs_sql, overlap_sql, rouge_l_sql, rouge_tok_sql

    dot = "list_dot_product({0}, {1})".format
    retrieval = " UNION ALL ".join(f"SELECT qid AS case_id, NULL::BIGINT AS turn, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM cm" for m in _METRICS)
    generation = " UNION ALL ".join(f"SELECT case_id, turn, '{m}', CAST({m} AS DOUBLE) FROM gen" for m in GENERATION)
    stats = "count(*) AS n, avg(value) AS mean, stddev_pop(value) AS std, min(value) AS min, max(value) AS max"
    return f"""{CASE_SQL}, {PAIRS_SQL},
{overlap_sql('qa', rouge_tok_sql('answer'), rouge_tok_sql('question'), [1, 2])}, {lcs_sql()},
{overlap_sql('qa', bleu_tok_sql('answer'), bleu_tok_sql('question'), [1, 2, 3, 4], 'b')}, {bleu_sql('b')},
rg AS (SELECT pair_id, max(CASE WHEN n = 1 THEN {f_sql()} END) AS rouge1, max(CASE WHEN n = 2 THEN {f_sql()} END) AS rouge2 FROM ov GROUP BY pair_id),
ev AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
gen AS (
  SELECT qa.conv_id AS case_id, qa.turn, rouge1, rouge2, {rouge_l_sql()} AS rougeL, bleu,
         {dot('a.v', 'b.v')} / (sqrt({dot('a.v', 'a.v')}) * sqrt({dot('b.v', 'b.v')})) AS semantic_similarity,
         len(list_filter(string_split_regex(answer, '[{SPACE}]+'), lambda w: w <> '')) AS answer_length
  FROM qa JOIN rg USING (pair_id) JOIN lcs USING (pair_id) JOIN bl USING (pair_id)
  LEFT JOIN ev b ON b.vec_id = qa.conv_id LEFT JOIN ev a ON a.vec_id = qa.conv_id + qa.turn + 1),
mt AS (SELECT case_id, turn, d.lang AS category, d.source AS difficulty, metric, value
       FROM ({retrieval} UNION ALL {generation}) m LEFT JOIN documents d ON d.doc_id = m.case_id WHERE value IS NOT NULL),
ru AS (SELECT 'overall' AS group_type, NULL AS group_value, metric, {stats} FROM mt GROUP BY metric
  UNION ALL SELECT 'category', category, metric, {stats} FROM mt GROUP BY metric, category
  UNION ALL SELECT 'difficulty', difficulty, metric, {stats} FROM mt GROUP BY metric, difficulty),
gg AS (SELECT group_type, group_value, """ + ", ".join(f"max(mean) FILTER (metric = '{m}') AS mean_{m}" for m in (*_METRICS, *GENERATION)) + """
       FROM ru GROUP BY group_type, group_value)"""


METRIC_SQL = _metric_table_sql()
_STATS = ["mean", "std", "min", "max"]


@register("agg_eval_by_group", sql=f"WITH {METRIC_SQL} SELECT group_type, group_value, metric, n, "
          + ", ".join(f"round({c}, 6) AS {c}" for c in _STATS) + " FROM ru")
def agg_eval_by_group(spark, sf_dir):
    """Every retrieval and generation metric overall, by category and by
    difficulty: per-case metrics computed once, rolled up once."""
    return grouped_eval(spark, sf_dir).select("group_type", "group_value", "metric", "n", *[F.round(c, 6).alias(c) for c in _STATS])


OVERALL_SQL = " + ".join(f"{w} * coalesce(mean_{m}, 0)" for m, w in ev.OVERALL_WEIGHTS.items())


def overall(rolled: DataFrame) -> DataFrame:
    """(group_type, group_value, overall_score) of a rollup."""
    by_group = ev.means(rolled, list(ev.OVERALL_WEIGHTS))
    return by_group.select("group_type", "group_value", ev.overall_score(*[F.col(f"mean_{m}") for m in ev.OVERALL_WEIGHTS]).alias("overall_score"))


@register("agg_overall_score", sql=f"WITH {METRIC_SQL} SELECT group_type, group_value, round({OVERALL_SQL}, 6) AS overall_score FROM gg")
def agg_overall_score(spark, sf_dir):
    return overall(grouped_eval(spark, sf_dir)).withColumn("overall_score", F.round("overall_score", 6))


def _advice_sql() -> str:
    parts = [f"CASE WHEN coalesce({name}, 0.0) < {level} THEN '{text}' END" for name, level, text in ev.ADVICE]
    arr = "list_filter([" + ", ".join(parts) + "], lambda x: x IS NOT NULL)"
    return (f"WITH {METRIC_SQL} SELECT group_type, group_value, CASE WHEN len({arr}) = 0 THEN '{ev.ADVICE_DEFAULT}' "
            f"ELSE array_to_string({arr}, chr(10)) END AS advice FROM gg")


def advise(rolled: DataFrame) -> DataFrame:
    """(group_type, group_value, advice) of a rollup; a missing metric counts as 0."""
    names = [name for name, _, _ in ev.ADVICE]
    by_group = ev.means(rolled, [n.removeprefix("mean_") for n in names])
    return by_group.select("group_type", "group_value", ev.advice({n: F.coalesce(F.col(n), F.lit(0.0)) for n in names}).alias("advice"))


@register("val_threshold_advice", sql=_advice_sql())
def val_threshold_advice(spark, sf_dir):
    return advise(grouped_eval(spark, sf_dir))


def _eval_report_sql() -> str:
    dims = ("category", "difficulty")
    counts = " UNION ALL ".join(
        f"SELECT 'statistics', '{g}', {v}, NULL, NULL, 'cases', CAST(count(DISTINCT case_id) AS DOUBLE) FROM mt" + (f" GROUP BY {v}" if g != "overall" else "")
        for g, v in (("overall", "NULL"), *[(d, d) for d in dims]))
    stats = " UNION ALL ".join(f"SELECT 'aggregate', group_type, group_value, NULL, NULL, '{c}_' || metric, {c} FROM ru" for c in _STATS)
    return f"""WITH {METRIC_SQL},
report(section, group_type, group_value, case_id, turn, metric, value) AS (
  SELECT 'case', NULL, NULL, case_id, turn, metric, value FROM mt
  UNION ALL {stats}
  UNION ALL SELECT 'aggregate', group_type, group_value, NULL, NULL, 'overall_score', {OVERALL_SQL} FROM gg
  UNION ALL {counts})
SELECT section, group_type, group_value, case_id, turn, metric, round(value, 6) AS value FROM report"""


@register("rag_eval_report", sql=_eval_report_sql())
def rag_eval_report(spark, sf_dir):
    """The whole report as one long table: the metrics of every case (of each of
    its answers), their aggregates and the overall score of every group, and the
    numbers of cases."""
    rows = stored(metric_table(spark, sf_dir), "eval-metrics")  # read by the three sections
    rolled = ev.rollup(rows, ["category", "difficulty"])
    none = F.lit(None)
    cases = rows.select(F.lit("case").alias("section"), none.cast("string").alias("group_type"), none.cast("string").alias("group_value"),
                        "case_id", "turn", "metric", "value")
    group = [F.lit("aggregate").alias("section"), "group_type", "group_value", none.cast("long").alias("case_id"), none.cast("long").alias("turn")]
    entries = F.array(*[F.struct(F.concat(F.lit(f"{c}_"), F.col("metric")).alias("metric"), F.col(c).alias("value")) for c in _STATS])
    aggregates = rolled.select(*group, F.inline(entries))
    scores = overall(rolled).select(*group, F.lit("overall_score").alias("metric"), F.col("overall_score").alias("value"))
    of_case = ev.metric_rows(rows.select("case_id", "category", "difficulty").distinct().withColumn("cases", F.lit(1)),
                             ["category", "difficulty"], ["cases"])
    counts = ev.rollup(of_case, ["category", "difficulty"]).select(
        F.lit("statistics").alias("section"), *group[1:], "metric", F.col("n").cast("double").alias("value"))
    report = cases.unionByName(aggregates).unionByName(scores).unionByName(counts)
    return report.withColumn("value", F.round("value", 6))


def _approximate_sql(k: int) -> str:
    """The fitted limits and the candidates, integer for integer, then the exact ranking."""
    from tessera.operators import knn as m

    x = f"(j * dim + i - 1 + {42 * 7919 + 1}) % {m.PRIME}"
    for _ in range(3):
        y = f"(({x}) * {m.FACTOR} + 12345) % {m.PRIME}"
        x = f"xor({y}, ({y}) >> 13)"
    step, bits = m.PLANE_STEP, 16 * -(-m.SKETCH_BITS // 16)
    cosine = "round(list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))), 12)"
    return f"""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, len(embedding) AS dim FROM embeddings WHERE len(embedding) > 0),
u AS (SELECT *, list_transform(v, lambda x: CASE WHEN n = 0 THEN 0 ELSE floor(x / n * {m.UNIT} + 0.5) END) AS u,
        row_number() OVER (ORDER BY (vec_id % {m.PRIME}) * {m.FACTOR} % {m.PRIME}, vec_id) AS no
      FROM (SELECT *, sqrt(list_dot_product(v, v)) AS n FROM e)),
size AS (SELECT max(dim) AS dim, greatest(1, CAST(floor(sqrt(count(*))) AS BIGINT)) AS centres FROM u),
comp AS (SELECT vec_id, no, generate_subscripts(u, 1) AS i, CAST(unnest(u) AS BIGINT) AS x FROM u),
middle AS (SELECT i, CAST(floor(avg(x) + 0.5) AS BIGINT) AS mid FROM comp, size WHERE no <= greatest(centres, {m.SAMPLE_QUERIES}) GROUP BY i),
planes AS (SELECT j, i, x % {step} + (x // {step}) % {step} - {step - 1} AS w FROM (
  SELECT j, i, {x} AS x FROM size, (SELECT unnest(range(0, {bits})) AS j), LATERAL (SELECT unnest(range(1, dim + 1)) AS i))),
sides AS (SELECT vec_id, j, sum((x - mid) * w) > 0 AS side FROM comp JOIN middle USING (i) JOIN planes USING (i) GROUP BY vec_id, j),
words AS (SELECT vec_id, j // 62 AS place, CAST(sum(CASE WHEN side THEN 1::BIGINT << (j % 62) ELSE 0 END) AS BIGINT) AS word FROM sides GROUP BY ALL),
sketch AS (SELECT vec_id, list(word ORDER BY place) AS words FROM words GROUP BY vec_id),
prod AS (SELECT a.vec_id, c.no AS cell, list_dot_product(a.u, c.u) AS p FROM u a, u c, size WHERE c.no <= centres),
best AS (SELECT vec_id, cell, p FROM prod QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, cell) = 1),
true_pairs AS (
  SELECT a.vec_id AS qid, b.vec_id AS id FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE a.no <= {m.SAMPLE_QUERIES}
  QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY {cosine} DESC, b.vec_id) <= {k}),
apart AS (
  SELECT a.vec_id AS qid, b.vec_id AS id,
    list_sum(list_transform(range(1, len(a.words) + 1), lambda i: bit_count(xor(a.words[i], b.words[i])))) AS bits,
    top.p - prod.p AS border
  FROM sketch a JOIN sketch b ON a.vec_id <> b.vec_id JOIN best own ON own.vec_id = b.vec_id
  JOIN best top ON top.vec_id = a.vec_id JOIN prod ON prod.vec_id = a.vec_id AND prod.cell = own.cell),
ranked AS (
  SELECT row_number() OVER (ORDER BY bits) AS bits_no, bits, row_number() OVER (ORDER BY border) AS border_no, border, count(*) OVER () AS n
  FROM true_pairs JOIN apart USING (qid, id)),
limits AS (SELECT max(bits) FILTER (bits_no = ({m.LSH_KEEP} * n + 99) // 100) AS most_bits,
                  max(border) FILTER (border_no = ({m.LSH_KEEP} * n + 99) // 100) AS most_border FROM ranked)
SELECT qid, id AS vec_id, round({cosine}, 6) AS score,
  CAST(row_number() OVER (PARTITION BY qid ORDER BY {cosine} DESC, id) AS INTEGER) AS rank
FROM apart, limits, u a, u b WHERE a.vec_id = qid AND b.vec_id = id AND bits <= most_bits AND border <= most_border
QUALIFY rank <= {k}"""


@register("join_knn_lsh", sql=_approximate_sql(5))
def join_knn_lsh(spark, sf_dir):
    from tessera.operators.knn import knn_lsh

    e = Tables(spark, sf_dir).embeddings
    h = knn_lsh(e, e, 5, query_id="vec_id", id_col="vec_id", exclude_self=True)
    return h.select("qid", F.col("id").alias("vec_id"), F.round("score", 6).alias("score"), "rank")
