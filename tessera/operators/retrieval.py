"""Retrieval-augmented answering steps over hit frames ``(qid, id, score, rank)``.

Every step is a DataFrame -> DataFrame function; the per-question work is
keyed by ``qid`` (at most k hits per question), so no step groups more than
k rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import SPACE

# Fixed values (texts the original pipeline answers with, in Russian as there).
NO_CONTEXT_ANSWER = "К сожалению, я не нашел достаточно информации для ответа на этот вопрос."
SHORT_ANSWER_APOLOGY = "Извините, не удалось сгенерировать содержательный ответ на основе найденной информации."
PROMPT_TEMPLATE_HEAD = (
    "На основе предоставленного контекста, ответь на вопрос пользователя. "
    "Если в контексте нет достаточной информации, скажи об этом. Контекст: "
)
PROMPT_TEMPLATE_QUESTION = " Вопрос: "
PROMPT_TEMPLATE_TAIL = " Ответ: "
INSTRUCTED_HEAD = """Ты - AI-ассистент, который отвечает на вопросы на основе предоставленного контекста.
        ИНСТРУКЦИИ:
        1. Используй только информацию из предоставленного контекста
        2. Если в контексте нет ответа, честно скажи об этом
        3. Будь точным и информативным
        4. Отвечай на русском языке
        КОНТЕКСТ: """
INSTRUCTED_QUESTION = "\n        ВОПРОС: "
INSTRUCTED_TAIL = "\n        ОТВЕТ: "
ERROR_ANSWER = "Произошла ошибка: "
CONTEXT_DOC_LABEL = "Документ"
CONTEXT_SIMILARITY_LABEL = "схожесть"
STRUCTURED_TITLE = "Заголовок"
STRUCTURED_CATEGORY = "Категория"
STRUCTURED_RELEVANCE = "Релевантность"
STRUCTURED_CONTENT = "Содержание"
RULE = "=" * 50

# Defaults of the retriever configuration.
TOP_K = 5
SIMILARITY_THRESHOLD = 0.6
MAX_CONTEXT_LENGTH = 2000


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: drop leading/trailing whitespace of any kind."""
    return F.regexp_replace(c, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def similarity_threshold(hits: DataFrame, threshold: float = SIMILARITY_THRESHOLD, score: str = "score") -> DataFrame:
    """Keep hits with score >= threshold; a missing score counts as 0."""
    return hits.filter(F.coalesce(F.col(score), F.lit(0.0)) >= F.lit(threshold))


def stable_desc_position(hits: DataFrame, key: str = "qid", score: str = "score", rank: str = "rank") -> DataFrame:
    """Stable sort by score descending: ties keep the original rank order."""
    w = Window.partitionBy(key).orderBy(F.col(score).desc(), F.col(rank).asc())
    return hits.withColumn("pos", F.row_number().over(w))


def _order(order: list[str]) -> list[Column]:
    """``["-score", "rank"]`` -> sort expressions (a leading '-' means descending)."""
    return [F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc() for o in order]


def context_budget(df: DataFrame, partition: list[str], order: list[str], length: str,
                   limit: int = MAX_CONTEXT_LENGTH, rows_per_key_bounded: bool = False) -> DataFrame:
    """Walk rows in ``order`` within each partition, keep them while the running
    length stays <= limit and stop at the first that does not fit.

    Lengths are >= 0, so the running sum never falls back under the limit and
    the ``break`` is a filter on the running sum.  The running sum is the
    distributed prefix sum of ``running_sum`` (range-partitioned slices plus
    per-slice offsets), so a hot partition key is spread over many tasks.
    ``rows_per_key_bounded=True`` is for callers whose keys hold at most a
    few rows by construction (one plain window, no range partitioning)."""
    sort = _order(order)
    if rows_per_key_bounded:
        w = Window.partitionBy(*partition).orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn("_run", F.sum(F.coalesce(F.col(length), F.lit(0))).over(w)).filter(
            F.col("_run") <= limit).drop("_run")
    from tessera.operators.requests import running_sum

    with_len = df.withColumn("_len", F.coalesce(F.col(length), F.lit(0)))
    run = running_sum(with_len, partition, sort, "_len")
    return run.filter(F.col("running_sum") <= limit).drop("_len", "running_sum", "running_count")


def assemble_response(questions: DataFrame, kept: DataFrame, qid: str = "qid",
                      answers: DataFrame | None = None, error: str | None = None) -> DataFrame:
    """One response row per question (questions with no surviving document
    get the fixed no-information answer; with ``answers`` = (qid, answer)
    from a generator, the others get theirs).  A question whose column ``error``
    is set has failed: its response has no documents and tells the error."""
    per_q = kept.groupBy(qid).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"].cast("string")), ","
        ).alias("doc_ids"),
        F.sum("doc_length").cast("long").alias("context_chars"),
        F.round(F.max("score"), 6).alias("best_score"),
    )
    failed = F.col(error) if error else F.lit(None).cast("string")
    out = questions.select(qid, failed.alias("_error")).join(per_q, on=qid, how="left")
    generated = F.lit(None).cast("string")
    if answers is not None:
        out = out.join(answers.select(qid, F.col("answer").alias("_gen")), on=qid, how="left")
        generated = F.col("_gen")
    n = F.coalesce(F.col("n_docs"), F.lit(0)).cast("long")
    return out.select(
        qid,
        n.alias("n_docs"),
        F.coalesce(F.col("doc_ids"), F.lit("")).alias("doc_ids"),
        F.coalesce(F.col("context_chars"), F.lit(0)).cast("long").alias("context_chars"),
        "best_score",
        F.when(F.col("_error").isNotNull(), F.lit("error")).when(n == 0, F.lit("no_context")).otherwise(F.lit("ready")).alias("status"),
        F.when(F.col("_error").isNotNull(), F.concat(F.lit(ERROR_ANSWER), "_error"))
        .when(n == 0, F.lit(NO_CONTEXT_ANSWER)).otherwise(generated).alias("answer"),
    )


def _json_text(text: Column) -> Column:
    """A string as JSON in ASCII: escapes for quotes, backslashes and controls,
    ``\\uXXXX`` (of UTF-16) for every other character."""
    quoted = F.to_json(F.array(text))
    inside = F.substring(quoted, 2, F.char_length(quoted) - 2)

    def escaped(done: Column, char: Column) -> Column:
        code = F.lower(F.hex(F.encode(char, "UTF-16BE")))
        units = F.transform(F.sequence(F.lit(0), (F.char_length(code) / 4 - 1).cast("int")), lambda i: F.concat(
            F.lit("\\u"), F.substring(code, (i * 4 + 1).cast("int"), F.lit(4))))
        return F.replace(done, char, F.array_join(units, ""))

    return F.aggregate(F.array_distinct(F.regexp_extract_all(inside, F.lit(r"[^\x20-\x7E]"), 0)), inside, escaped)


def canonical_json(fields: Column) -> Column:
    """A map of strings as JSON text with sorted keys, ``", "`` and ``": "``
    (the default form of Python's ``json.dumps``); no map is ``{}``."""
    pairs = F.array_sort(F.map_entries(fields))
    entry = lambda e: F.concat(_json_text(e["key"]), F.lit(": "), F.coalesce(_json_text(e["value"]), F.lit("null")))
    return F.coalesce(F.concat(F.lit("{"), F.array_join(F.transform(pairs, entry), ", "), F.lit("}")), F.lit("{}"))


def request_id(question: Column, context_json: Column | None = None) -> Column:
    """First 10 hex chars of md5(question + JSON of the user context); no
    context is the text ``{}``."""
    ctx = F.lit("{}") if context_json is None else F.coalesce(context_json, F.lit("{}"))
    return F.substring(F.md5(F.concat(question, ctx)), 1, 10)


def context_string(hits: DataFrame, key: str, pos: str, title: str, score: str, content: str) -> DataFrame:
    """``[Документ i] title (схожесть 0.950): content`` blocks joined by a blank line."""
    block = F.format_string(
        f"[{CONTEXT_DOC_LABEL} %d] %s ({CONTEXT_SIMILARITY_LABEL} %.3f): %s",
        F.col(pos), F.col(title), F.col(score), F.col(content),
    )
    return hits.groupBy(key).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), block.alias("b")))), lambda x: x["b"]),
            "\n\n",
        ).alias("context")
    )


def structured_context(hits: DataFrame, key: str, pos: str, title: str, category: str, score: str,
                       content: str) -> DataFrame:
    """Five-line block per hit, rules of '=' around the whole (no newline next
    to the first and last block, as in the original)."""
    block = F.format_string(
        f"{CONTEXT_DOC_LABEL} %d:\n{STRUCTURED_TITLE}: %s\n{STRUCTURED_CATEGORY}: %s\n"
        f"{STRUCTURED_RELEVANCE}: %.3f\n{STRUCTURED_CONTENT}: %s\n",
        F.col(pos), F.col(title), F.col(category), F.col(score), F.col(content),
    )
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), block.alias("b")))), lambda x: x["b"]),
        "\n",
    )
    return hits.groupBy(key).agg(F.concat(F.lit("\n" + RULE), joined, F.lit(RULE)).alias("context"))


def prompt(context: Column, question: Column) -> Column:
    return F.concat(F.lit(PROMPT_TEMPLATE_HEAD), context, F.lit(PROMPT_TEMPLATE_QUESTION), question,
                    F.lit(PROMPT_TEMPLATE_TAIL))


def instructed_prompt(structured: Column, question: Column) -> Column:
    """The prompt with instructions, over a structured context."""
    return F.concat(F.lit(INSTRUCTED_HEAD), structured, F.lit(INSTRUCTED_QUESTION), question, F.lit(INSTRUCTED_TAIL))


def extract_after_prompt(generated: Column, prompt_text: Column) -> Column:
    """Text after the prompt (when the output starts with it), stripped."""
    rest = generated.substr(F.char_length(prompt_text) + 1, F.char_length(generated) + 1)
    return F.when(F.startswith(generated, prompt_text), strip_ws(rest))


def after_last_marker(generated: Column, marker: str) -> Column:
    return strip_ws(F.element_at(F.split(generated, re.escape(marker)), -1))


def postprocess(answer: Column) -> Column:
    """Collapse whitespace runs; answers shorter than 10 chars become the apology."""
    collapsed = strip_ws(F.regexp_replace(answer, f"[{SPACE}]+", " "))
    return F.when(F.char_length(collapsed) < 10, F.lit(SHORT_ANSWER_APOLOGY)).otherwise(collapsed)
