"""Scoring of generated queries: form rules, ontology-term checks, expected
pattern share and the weighted pattern/result score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.retrieval import strip_ws

# Accepted query forms, messages, weights and pass mark.
QUERY_FORMS = ["SELECT", "CONSTRUCT", "ASK", "DESCRIBE"]
MSG_BAD_START = "Query must start with SELECT, CONSTRUCT, ASK or DESCRIBE"
MSG_NO_WHERE = "Missing WHERE clause"
MSG_SYNTAX_OK = "Syntax appears valid"
MSG_NO_PREFIX = "Missing prefix usage"
MSG_TERMS_OK = "Ontology compatibility check passed"
MSG_TERMS_BAD = "May reference non-existent ontology elements"
PATTERN_WEIGHT, RESULT_WEIGHT, PASS_MARK = 0.6, 0.4, 0.7


def validate_form(query: Column) -> tuple[Column, Column]:
    """(valid, message): the first failing rule gives the message."""
    up = F.upper(strip_ws(query))
    starts = F.lit(False)
    for form in QUERY_FORMS:
        starts = starts | F.startswith(up, F.lit(form))
    has_where = F.contains(F.upper(query), F.lit("WHERE"))
    msg = F.when(~starts, F.lit(MSG_BAD_START)).when(~has_where, F.lit(MSG_NO_WHERE)).otherwise(F.lit(MSG_SYNTAX_OK))
    return starts & has_where, msg


def ontology_terms(queries: DataFrame, key: str, query: str, classes: DataFrame, prefix: str) -> DataFrame:
    """Every ``prefix:Name`` a query uses must be a declared class.

    ``classes`` has one column ``cls``.  The referenced names are exploded and
    anti-joined with the class set, so the check is a join, not a lookup
    list shipped to every task."""
    refs = queries.select(key, F.explode(F.regexp_extract_all(F.col(query), F.lit(prefix + r":(\w+)"), 1)).alias("cls"))
    missing = refs.join(classes, "cls", "left_anti").groupBy(key).agg(F.count(F.lit(1)).alias("n_missing"))
    out = queries.select(key, query).join(missing, key, "left")
    has_prefix = F.contains(F.col(query), F.lit(prefix + ":"))
    ok = has_prefix & F.coalesce(F.col("n_missing") == 0, F.lit(True))
    msg = F.when(~has_prefix, F.lit(MSG_NO_PREFIX)).when(ok, F.lit(MSG_TERMS_OK)).otherwise(F.lit(MSG_TERMS_BAD))
    return out.select(key, ok.alias("valid"), msg.alias("message"))


def pattern_score(text: Column, patterns: list[str]) -> Column:
    """Share of the expected substrings present in the text (case-sensitive)."""
    arr = F.array(*[F.lit(p) for p in patterns])
    return F.size(F.filter(arr, lambda p: F.contains(text, p))) / F.lit(float(len(patterns)))


def result_score(found: Column, min_results: int) -> Column:
    return F.least(F.lit(1.0), found.cast("double") / F.lit(float(min_results)))


def total_score(pattern: Column, result: Column) -> tuple[Column, Column]:
    total = pattern * PATTERN_WEIGHT + result * RESULT_WEIGHT
    return total, F.when(total >= PASS_MARK, F.lit("PASS")).otherwise(F.lit("FAIL"))
