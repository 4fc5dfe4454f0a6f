"""Text metrics, text features and prompt assembly over ``conversations`` /
``documents`` / ``embeddings``.  Pairs: a user turn and the assistant turn
right after it (prediction = the answer, reference = the question)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions import vector as vx
from tessera.operators import evaluation as ev
from tessera.operators import retrieval as rt
from tessera.operators import textfeatures as tf
from tessera.plans.registry import register
from tessera.plans.retrieval_queries import PAIRS_SQL, knn_sql, qa_pairs, self_knn
from tessera.sources.tables import Tables

# --- SQL helpers (DuckDB) ----------------------------------------------------------

STRIP = f"^[{tx.SPACE}]+|[{tx.SPACE}]+$"
STOP_SQL = "[" + ", ".join(f"'{w}'" for w in tx.KEYWORD_STOP_WORDS) + "]"


def rouge_tok_sql(x: str) -> str:
    return f"list_filter(string_split(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"


def bleu_tok_sql(x: str) -> str:
    return f"regexp_extract_all({x}, '([{tx.WORD}]+|[^{tx.WORD}{tx.SPACE}])', 1)"


def ws_tok_sql(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '[{tx.SPACE}]+'), lambda w: w <> '')"


def keywords_sql(x: str) -> str:
    return (f"list_sort(list_distinct(list_filter({ws_tok_sql(f'lower({x})')}, "
            f"lambda w: length(w) > 3 AND NOT list_contains({STOP_SQL}, w))))[1:10]")


def overlap_sql(src: str, pred: str, ref: str, orders: list[int], tag: str = "") -> str:
    """CTEs ending in ``ov(pair_id, n, pred_total, ref_total, overlap)``, names with ``tag``."""
    o = ", ".join(str(n) for n in orders)
    gram = "unnest(list_transform(range(1, len({t}) - n + 2), lambda i: array_to_string({t}[i:i + n - 1], ' ')))"
    return f"""tk{tag} AS (SELECT pair_id, {pred} AS pt, {ref} AS rt FROM {src}),
ord{tag} AS (SELECT unnest([{o}]) AS n),
gp{tag} AS (SELECT pair_id, n, {gram.format(t='pt')} AS gram FROM tk{tag}, ord{tag}),
gr{tag} AS (SELECT pair_id, n, {gram.format(t='rt')} AS gram FROM tk{tag}, ord{tag}),
cp{tag} AS (SELECT pair_id, n, gram, count(*) AS c FROM gp{tag} GROUP BY ALL),
cr{tag} AS (SELECT pair_id, n, gram, count(*) AS c FROM gr{tag} GROUP BY ALL),
ovl{tag} AS (SELECT pair_id, n, sum(least(cp{tag}.c, cr{tag}.c)) AS overlap FROM cp{tag} JOIN cr{tag} USING (pair_id, n, gram) GROUP BY ALL),
tot{tag} AS (SELECT pair_id, n, greatest(len(pt) - n + 1, 0) AS pred_total, greatest(len(rt) - n + 1, 0) AS ref_total FROM tk{tag}, ord{tag}),
ov{tag} AS (SELECT tot{tag}.*, coalesce(ovl{tag}.overlap, 0) AS overlap FROM tot{tag} LEFT JOIN ovl{tag} USING (pair_id, n))"""


def lcs_sql(tokens: str = "tk") -> str:
    """CTEs ending in ``lcs(pair_id, lcs, n_pred, n_ref)``: the dynamic programme
    of the longest common subsequence, one predicted token a step.  A cell is the
    largest up to its place of what the token gives there or leaves."""
    return f"""dp AS (
  WITH RECURSIVE steps AS (
    SELECT pair_id, pt, rt, 0 AS i, list_transform(rt, lambda x: 0) AS cells FROM {tokens}
    UNION ALL
    SELECT pair_id, pt, rt, i + 1, list_transform(range(1, len(rt) + 1), lambda j: list_max(own[1:j])) FROM (
      SELECT *, list_transform(range(1, len(rt) + 1), lambda j:
                  CASE WHEN rt[j] = pt[i + 1] THEN coalesce(cells[j - 1], 0) + 1 ELSE cells[j] END) AS own
      FROM steps WHERE i < len(pt)))
  SELECT * FROM steps),
lcs AS (SELECT pair_id, CAST(coalesce(cells[len(rt)], 0) AS BIGINT) AS lcs, len(pt) AS n_pred, len(rt) AS n_ref FROM dp WHERE i = len(pt))"""


def bleu_sql(tag: str = "") -> str:
    """CTEs ending in ``bl(pair_id, bleu)`` over those of ``overlap_sql``."""
    return f"""prec AS (SELECT pair_id, n, CASE WHEN pred_total = 0 THEN 0.0 ELSE overlap / pred_total END AS p FROM ov{tag}),
geo AS (SELECT pair_id, CASE WHEN min(p) > 0 THEN exp(sum(ln(p)) / 4.0) ELSE 0.0 END AS geo FROM prec GROUP BY pair_id),
bl AS (SELECT pair_id, coalesce(geo, 0.0) * CASE WHEN len(pt) = 0 THEN 0.0 WHEN len(pt) > len(rt) THEN 1.0 ELSE exp(1 - len(rt) / len(pt)) END AS bleu
       FROM tk{tag} LEFT JOIN geo USING (pair_id))"""


def rouge_l_sql() -> str:
    p, r = "CASE WHEN n_pred = 0 THEN 0.0 ELSE lcs / n_pred END", "CASE WHEN n_ref = 0 THEN 0.0 ELSE lcs / n_ref END"
    return f"CASE WHEN lcs = 0 THEN 0.0 ELSE 2 * ({p}) * ({r}) / (({p}) + ({r})) END"


def f_sql(ov: str = "ov") -> str:
    p = "CASE WHEN pred_total = 0 THEN 0.0 ELSE overlap / pred_total END"
    r = "CASE WHEN ref_total = 0 THEN 0.0 ELSE overlap / ref_total END"
    return f"CASE WHEN ({p}) + ({r}) = 0 THEN 0.0 ELSE 2 * ({p}) * ({r}) / (({p}) + ({r})) END"


# --- n-gram and sequence metrics ------------------------------------------------------

@register(
    "txt_rouge_n",
    sql=f"""WITH {PAIRS_SQL}, {overlap_sql('qa', rouge_tok_sql('answer'), rouge_tok_sql('question'), [1, 2])}
SELECT pair_id, round(max(CASE WHEN n = 1 THEN {f_sql()} END), 6) AS rouge1,
       round(max(CASE WHEN n = 2 THEN {f_sql()} END), 6) AS rouge2
FROM ov GROUP BY pair_id""",
)
def txt_rouge_n(spark, sf_dir):
    r = ev.rouge_n(qa_pairs(spark, sf_dir), "pair_id", "answer", "question", (1, 2))
    return r.select("pair_id", F.round("rouge1", 6).alias("rouge1"), F.round("rouge2", 6).alias("rouge2"))


@register(
    "txt_rouge_l",
    sql=f"""WITH {PAIRS_SQL}, tk AS (SELECT pair_id, {rouge_tok_sql('answer')} AS pt, {rouge_tok_sql('question')} AS rt FROM qa), {lcs_sql()}
SELECT pair_id, lcs, round({rouge_l_sql()}, 6) AS rougeL FROM lcs""",
)
def txt_rouge_l(spark, sf_dir):
    r = ev.rouge_l(qa_pairs(spark, sf_dir), "pair_id", "answer", "question")
    return r.select("pair_id", "lcs", F.round("rougeL", 6).alias("rougeL"))


@register(
    "txt_bleu",
    sql=f"""WITH {PAIRS_SQL}, {overlap_sql('qa', bleu_tok_sql('answer'), bleu_tok_sql('question'), [1, 2, 3, 4])}, {bleu_sql()}
SELECT pair_id, round(bleu, 6) AS bleu FROM bl""",
)
def txt_bleu(spark, sf_dir):
    b = ev.bleu(qa_pairs(spark, sf_dir), "pair_id", "answer", "question")
    return b.select("pair_id", F.round("bleu", 6).alias("bleu"))


@register(
    "txt_semantic_similarity",
    sql="""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
SELECT a.vec_id, b.vec_id AS next_id,
       round(list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))), 6) AS similarity
FROM e a JOIN e b ON b.vec_id = a.vec_id + 1""",
)
def txt_semantic_similarity(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    a = e.select("vec_id", F.col("embedding").alias("a"))
    b = e.select(F.col("vec_id").alias("next_id"), F.col("embedding").alias("b"))
    j = a.join(b, b.next_id == a.vec_id + 1)
    return j.select("vec_id", "next_id", F.round(vx.cosine("a", "b"), 6).alias("similarity"))


@register(
    "txt_answer_length",
    sql=f"SELECT conv_id, turn, CAST(len({ws_tok_sql('text')}) AS INTEGER) AS n_words, "
    "CAST(length(text) AS INTEGER) AS n_chars FROM conversations",
)
def txt_answer_length(spark, sf_dir):
    c = Tables(spark, sf_dir).conversations
    return c.select("conv_id", "turn", tx.word_count("text").alias("n_words"), F.char_length("text").alias("n_chars"))


def _coverage_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents.select(F.col("doc_id").alias("conv_id"), F.col("text").alias("context"))
    pairs = qa_pairs(spark, sf_dir).join(docs, "conv_id")
    cov, matched = ev.keyword_coverage(F.col("context"), F.col("answer"))
    return pairs.select("pair_id", "answer", F.round(cov, 6).alias("keyword_coverage"),
                        matched.alias("matched_keywords_count"))


COVERAGE_SQL = f"""{PAIRS_SQL},
cov AS (
  SELECT qa.pair_id, qa.answer, {keywords_sql('d.text')} AS ck, {keywords_sql('qa.answer')} AS ak
  FROM qa JOIN documents d ON d.doc_id = qa.conv_id),
cov2 AS (SELECT pair_id, answer, CAST(len(list_intersect(ck, ak)) AS INTEGER) AS matched_keywords_count,
                CASE WHEN len(ck) = 0 THEN 0.0 ELSE len(list_intersect(ck, ak)) / len(ck) END AS kc FROM cov)"""


@register(
    "txt_keyword_coverage",
    sql=f"WITH {COVERAGE_SQL} SELECT pair_id, round(kc, 6) AS keyword_coverage, matched_keywords_count FROM cov2",
)
def txt_keyword_coverage(spark, sf_dir):
    return _coverage_frame(spark, sf_dir).drop("answer")


# --- answer flags, benchmark grid, model summary ---------------------------------------

UNCERTAINTY_SQL = " OR ".join(f"contains(lower({{x}}), '{p}')" for p in tf.UNCERTAINTY_PHRASES)


@register(
    "prj_answer_flags",
    sql=f"SELECT conv_id, turn, length(regexp_replace(text, '{STRIP}', '', 'g')) > 10 AS answer_has_content, "
    f"({UNCERTAINTY_SQL.format(x='text')}) AS contains_uncertainty FROM conversations WHERE role = 'assistant'",
)
def prj_answer_flags(spark, sf_dir):
    c = Tables(spark, sf_dir).conversations.filter(F.col("role") == "assistant")
    return c.select("conv_id", "turn", tf.has_content("text").alias("answer_has_content"),
                    tf.contains_uncertainty("text").alias("contains_uncertainty"))


@register(
    "rag_benchmark_frame",
    sql=f"""WITH {COVERAGE_SQL}
SELECT d.source AS category, pair_id, CAST(length(answer) AS INTEGER) AS answer_length,
       regexp_replace(answer, '{STRIP}', '', 'g') <> '' AS success,
       length(regexp_replace(answer, '{STRIP}', '', 'g')) > 10 AS answer_has_content,
       ({UNCERTAINTY_SQL.format(x='answer')}) AS contains_uncertainty,
       round(kc, 6) AS keyword_coverage, matched_keywords_count
FROM cov2 JOIN documents d ON CAST(d.doc_id AS VARCHAR) = string_split(pair_id, ':')[1]""",
)
def rag_benchmark_frame(spark, sf_dir):
    """The quality columns of every recorded answer, with the source of its document to group by."""
    d = Tables(spark, sf_dir).documents.select(F.col("doc_id").cast("string").alias("_doc"), F.col("source").alias("category"))
    frame = tf.answer_quality(_coverage_frame(spark, sf_dir))
    return frame.join(d, F.substring_index("pair_id", ":", 1) == F.col("_doc")).select("category", *frame.columns)


@register(
    "agg_model_summary",
    sql="""SELECT event_type AS model, round_even(avg(value), 3) AS avg_generation_time,
       round_even(avg(CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0), 3) AS avg_keyword_coverage,
       round_even(avg(CASE WHEN value IS NOT NULL THEN 1.0 ELSE 0.0 END), 3) AS success_rate,
       round_even(avg(length(props)), 3) AS avg_answer_length
FROM events GROUP BY event_type""",
)
def agg_model_summary(spark, sf_dir):
    ev_ = Tables(spark, sf_dir).events.select(
        F.col("event_type").alias("model"),
        F.col("value").alias("generation_time"),
        (F.get_json_object("props", "$.k").cast("double") / 100.0).alias("keyword_coverage"),
        F.col("value").isNotNull().alias("success"),
        F.char_length("props").alias("answer_length"),
    )
    return tf.model_summary(ev_, "model")


# --- request id, context strings, prompt, answer extraction, post-processing -----------

@register(
    "rag_request_id",
    sql="""SELECT conv_id, turn, substr(md5(c.text || CASE WHEN d.doc_id IS NULL THEN '{}' ELSE
  '{"lang": ' || coalesce('"' || d.lang || '"', 'null') || ', "source": ' || coalesce('"' || d.source || '"', 'null')
  || ', "turn": "' || CAST(turn AS VARCHAR) || '"}' END), 1, 10) AS request_id
FROM conversations c LEFT JOIN documents d ON d.doc_id = c.conv_id WHERE role = 'user'""",
)
def rag_request_id(spark, sf_dir):
    """The user context is a map made of the conversation's document and the turn."""
    t = Tables(spark, sf_dir)
    d = t.documents.select(F.col("doc_id").alias("conv_id"), "lang", "source", F.lit(True).alias("known"))
    c = t.conversations.filter(F.col("role") == "user").join(d, "conv_id", "left")
    context = F.when(F.col("known"), F.create_map(
        F.lit("turn"), F.col("turn").cast("string"), F.lit("source"), F.col("source"), F.lit("lang"), F.col("lang")))
    return c.select("conv_id", "turn", rt.request_id(F.col("text"), rt.canonical_json(context)).alias("request_id"))


def _hits_with_docs(spark: SparkSession, sf_dir: str, k: int = 3) -> DataFrame:
    d = Tables(spark, sf_dir).documents.select(F.col("doc_id").alias("id"), F.col("text").alias("content"),
                                               F.col("source").alias("title"), F.col("lang").alias("category"))
    return self_knn(spark, sf_dir, k).join(d, "id")


HITS_DOCS_SQL = f"""{knn_sql(3)},
hd AS (SELECT h.qid, h.rank, h.score, d.text AS content, d.source AS title, d.lang AS category
       FROM hits h JOIN documents d ON d.doc_id = h.id)"""

CTX_SQL = f"""{HITS_DOCS_SQL},
ctx AS (SELECT qid, string_agg(printf('[{rt.CONTEXT_DOC_LABEL} %d] %s ({rt.CONTEXT_SIMILARITY_LABEL} %.3f): %s',
                                      rank, title, score, content), chr(10) || chr(10) ORDER BY rank) AS context
        FROM hd GROUP BY qid)"""


@register("rag_context_string",
          sql=f"WITH {CTX_SQL} SELECT qid, md5(context) AS context_md5, CAST(length(context) AS INTEGER) AS context_chars FROM ctx")
def rag_context_string(spark, sf_dir):
    c = rt.context_string(_hits_with_docs(spark, sf_dir), "qid", "rank", "title", "score", "content")
    return c.select("qid", F.md5("context").alias("context_md5"), F.char_length("context").alias("context_chars"))


STRUCTURED_SQL = f"""sc AS (SELECT qid, chr(10) || '{rt.RULE}' || string_agg(printf('{rt.CONTEXT_DOC_LABEL} %d:' || chr(10) ||
         '{rt.STRUCTURED_TITLE}: %s' || chr(10) || '{rt.STRUCTURED_CATEGORY}: %s' || chr(10) ||
         '{rt.STRUCTURED_RELEVANCE}: %.3f' || chr(10) || '{rt.STRUCTURED_CONTENT}: %s' || chr(10),
         rank, title, category, score, content), chr(10) ORDER BY rank) || '{rt.RULE}' AS context FROM hd GROUP BY qid)"""


@register(
    "rag_structured_context",
    sql=f"""WITH {HITS_DOCS_SQL}, {STRUCTURED_SQL}
SELECT qid, md5(context) AS context_md5, CAST(length(context) AS INTEGER) AS context_chars FROM sc""",
)
def rag_structured_context(spark, sf_dir):
    c = rt.structured_context(_hits_with_docs(spark, sf_dir), "qid", "rank", "title", "category", "score", "content")
    return c.select("qid", F.md5("context").alias("context_md5"), F.char_length("context").alias("context_chars"))


@register(
    "rag_prompt",
    sql=f"""WITH {CTX_SQL}, {STRUCTURED_SQL},
p AS (SELECT ctx.qid, 'plain' AS template, '{rt.PROMPT_TEMPLATE_HEAD}' || ctx.context || '{rt.PROMPT_TEMPLATE_QUESTION}' || d.text
             || '{rt.PROMPT_TEMPLATE_TAIL}' AS prompt FROM ctx JOIN documents d ON d.doc_id = ctx.qid
      UNION ALL SELECT sc.qid, 'instructed', '{rt.INSTRUCTED_HEAD}' || sc.context || '{rt.INSTRUCTED_QUESTION}' || d.text
             || '{rt.INSTRUCTED_TAIL}' FROM sc JOIN documents d ON d.doc_id = sc.qid)
SELECT qid, template, md5(prompt) AS prompt_md5, CAST(length(prompt) AS INTEGER) AS prompt_length FROM p""",
)
def rag_prompt(spark, sf_dir):
    """Both templates for every question: the plain one over the context string and
    the one with instructions over the structured context."""
    hits = _hits_with_docs(spark, sf_dir)
    q = Tables(spark, sf_dir).documents.select(F.col("doc_id").alias("qid"), F.col("text").alias("question"))
    plain = rt.context_string(hits, "qid", "rank", "title", "score", "content")
    structured = rt.structured_context(hits, "qid", "rank", "title", "category", "score", "content")
    both = [(plain, "plain", rt.prompt), (structured, "instructed", rt.instructed_prompt)]
    rows = [c.join(q, "qid").select("qid", F.lit(name).alias("template"), made(F.col("context"), F.col("question")).alias("prompt"))
            for c, name, made in both]
    return rows[0].unionByName(rows[1]).select("qid", "template", F.md5("prompt").alias("prompt_md5"), F.char_length("prompt").alias("prompt_length"))


@register(
    "rag_extract_answer",
    sql=f"""WITH {PAIRS_SQL}
SELECT pair_id,
  CASE WHEN starts_with(question || answer, question)
       THEN regexp_replace(substr(question || answer, length(question) + 1), '{STRIP}', '', 'g') END AS after_prompt,
  regexp_replace(string_split(question || ' SPARQL: ' || answer, 'SPARQL:')[-1], '{STRIP}', '', 'g') AS after_marker
FROM qa""",
)
def rag_extract_answer(spark, sf_dir):
    p = qa_pairs(spark, sf_dir)
    generated = F.concat("question", "answer")
    marked = F.concat(F.col("question"), F.lit(" SPARQL: "), F.col("answer"))
    return p.select("pair_id", rt.extract_after_prompt(generated, F.col("question")).alias("after_prompt"),
                    rt.after_last_marker(marked, "SPARQL:").alias("after_marker"))


@register(
    "rag_postprocess",
    sql=f"""SELECT conv_id, turn, CASE WHEN length(c) < 10 THEN '{rt.SHORT_ANSWER_APOLOGY}' ELSE c END AS answer
FROM (SELECT conv_id, turn, regexp_replace(regexp_replace(text, '[{tx.SPACE}]+', ' ', 'g'), '{STRIP}', '', 'g') AS c
      FROM conversations)""",
)
def rag_postprocess(spark, sf_dir):
    c = Tables(spark, sf_dir).conversations
    return c.select("conv_id", "turn", rt.postprocess(F.col("text")).alias("answer"))


# --- token features ---------------------------------------------------------------------

@register(
    "txt_tokenize_pad",
    sql="""WITH t AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}_]+'), lambda w: w <> '') AS tok FROM documents),
p AS (SELECT doc_id, least(len(tok), 128) AS n,
             list_concat(tok[1:128], list_transform(range(128 - least(len(tok), 128)), lambda i: '[PAD]')) AS padded FROM t)
SELECT doc_id, CAST(n AS INTEGER) AS n_tokens, CAST(n AS INTEGER) AS mask_sum, CAST(len(padded) AS INTEGER) AS seq_len,
       md5(array_to_string(padded, ' ')) AS tokens_md5 FROM p""",
)
def txt_tokenize_pad(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    enc = tf.tokenize_pad(F.col("text"), 128)
    x = d.select("doc_id", enc.alias("e"))
    return x.select(
        "doc_id",
        F.col("e.n_tokens").alias("n_tokens"),
        F.aggregate("e.attention_mask", F.lit(0), lambda a, v: a + v).alias("mask_sum"),
        F.size("e.input_tokens").alias("seq_len"),
        F.md5(F.array_join("e.input_tokens", " ")).alias("tokens_md5"),
    )


@register(
    "txt_tfidf",
    sql="""WITH tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
vocab AS (SELECT term FROM (SELECT term, sum(tf) AS freq FROM tf GROUP BY term) ORDER BY freq DESC, term LIMIT 1000),
df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM vocab) GROUP BY term),
n AS (SELECT count(*) AS n FROM documents),
w AS (SELECT tf.doc_id, tf.term, tf.tf * (ln((1 + n.n) / (1 + df.df)) + 1) AS w FROM tf JOIN df USING (term) CROSS JOIN n),
nw AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM w)
SELECT doc_id, count(*) AS n_terms, round(max(w), 6) AS max_weight, first(term ORDER BY w DESC, term) AS top_term
FROM nw GROUP BY doc_id""",
)
def txt_tfidf(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    w = tf.tfidf(d, "doc_id", "text", vocab_size=1000)
    return w.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_terms"),
        F.round(F.max("weight"), 6).alias("max_weight"),
        F.min_by("term", F.struct((-F.col("weight")).alias("w"), F.col("term"))).alias("top_term"),
    )
