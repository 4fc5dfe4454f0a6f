"""URL filter: rules indexed by their rarest literal token.

Two kinds of rules share one index:

* host/path rules ``allow org/`` or ``block example.org/es/``: fit the host and
  all its subdomains when the path starts with the rule's; the longest wins;
* patterns ``(name, regular expression, literal tokens)`` on ``host + path``:
  they block pages that no host/path rule decides.

Every rule needs some literal tokens (maximal ``[a-z0-9]`` runs) in each URL it
fits.  It is filed under the one that the fewest URLs of the table hold.  The
tokens of a URL fetch candidate rules from the index, and only those run their
regular expression.  A rule whose patterns guarantee no whole token is filed
under the empty token, which every URL has.

Defined cases: null URLs and URLs without ``://`` have empty host and path, fit
no rule and are allowed; repeated rows are judged one by one; equally long
host/path rules are decided by the longer host, then block before allow, then
by text; URLs of any length are judged whole; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lower_ascii, stored

# The rules of the contract.
HOST_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
              ("allow", "com", "/fr/"), ("block", "com", "/de/")]
# Block patterns on host + path, with the literal tokens each match contains.
PATTERNS = [
    ("spam farms", r"(?:^|[.-])spam-farm(?:[.-]|$|/)", ["spam", "farm"]),
    ("pills", r"(?:^|[.-])cheap-pills(?:[.-]|$|/)", ["cheap", "pills"]),
    ("casino", r"(?:^|[./-])casino(?:[./-]|$)", ["casino"]),
    ("bets", r"(?:^|[./-])free-bets(?:[./-]|$)", ["free", "bets"]),
    ("adult", r"(?:^|[./-])adult(?:[./-]|$)", ["adult"]),
    ("trackers", r"(?:^|[.-])ads-track(?:[.-]|$|/)", ["ads", "track"]),
]
#: Rules are sent to every executor only up to this many; more are joined by a shuffle.
BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class Rule:
    kind: str  # "host" or "pattern"
    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    length: int
    host_length: int


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """The path of a rule is a prefix, so its last token may go on in the URL
    and is literal only when the rule ends it."""
    tokens = re.findall(r"[a-z0-9]+", host)
    tokens += [m.group().lower() for m in re.finditer(r"[A-Za-z0-9]+", path) if m.end() < len(path)]
    regex = r"^(?:[^/]*\.)?" + re.escape(host) + re.escape(path)
    return Rule("host", host + path, verdict, regex, tuple(tokens), len(host + path), len(host))


def pattern_rule(name: str, regex: str, tokens: list[str]) -> Rule:
    return Rule("pattern", name, "block", regex, tuple(tokens), 0, 0)


def default_rules() -> list[Rule]:
    return [host_rule(*r) for r in HOST_RULES] + [pattern_rule(*p) for p in PATTERNS]


RULE_TABLE = ("rule_no int, kind string, name string, verdict string, regex string, tokens array<string>, length int, host_length int")


def _quoted(text: Column) -> Column:
    return F.regexp_replace(text, r"([^A-Za-z0-9])", r"\\$1")


def rule_table(host_rules: DataFrame, patterns: DataFrame) -> DataFrame:
    """Rule sets that are tables themselves, of any size: ``host_rules`` holds
    (verdict, host, path), ``patterns`` (name, regex, tokens)."""
    inside = F.transform(F.regexp_extract_all("path", F.lit("([A-Za-z0-9]+)(?=[^A-Za-z0-9])"), 1), lambda t: F.lower(t))
    hosts = host_rules.select(
        F.lit("host").alias("kind"), F.concat("host", "path").alias("name"), "verdict",
        F.concat(F.lit(r"^(?:[^/]*\.)?"), _quoted(F.col("host")), _quoted(F.col("path"))).alias("regex"),
        F.concat(F.regexp_extract_all("host", F.lit("[a-z0-9]+"), 0), inside).alias("tokens"),
        F.char_length(F.concat("host", "path")).alias("length"), F.char_length("host").alias("host_length"))
    others = patterns.select(F.lit("pattern").alias("kind"), "name", F.lit("block").alias("verdict"), "regex", "tokens",
                             F.lit(0).alias("length"), F.lit(0).alias("host_length"))
    numbered = hosts.unionByName(others).withColumn("rule_no", F.xxhash64("kind", "name", "verdict", "regex"))
    return numbered.select("rule_no", "kind", "name", "verdict", "regex", "tokens", "length", "host_length").dropDuplicates(["rule_no"])


def _table(spark, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([(i, r.kind, r.name, r.verdict, r.regex, list(r.tokens), r.length, r.host_length) for i, r in enumerate(rules)], RULE_TABLE)


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: list[Rule] | DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, ``rule`` (the winning host/path
    rule or null), ``patterns`` (names of the patterns that matched, sorted, comma-joined) and
    ``verdict``.  ``rules`` is a list, or a table made by ``rule_table``."""
    table = stored(rules, "url-rules") if isinstance(rules, DataFrame) else _table(pages.sparkSession, rules)
    n_rules = table.count() if isinstance(rules, DataFrame) else len(rules)
    urls = pages.select(F.col(id_col).alias("_id"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"), F.monotonically_increasing_id().alias("_row"))
    key = F.concat("host", "path")
    # the empty token files rules without a literal token; it also keeps every URL in the stream below
    tokens = F.array_distinct(F.concat(F.array(F.lit("")), F.regexp_extract_all(lower_ascii(key), F.lit("[a-z0-9]+"), 0)))

    small = F.broadcast if n_rules <= BROADCAST_RULES else (lambda d: d)
    literal = table.select("rule_no", F.explode("tokens").alias("token"))
    # how many URLs hold each literal token (one partial sum per task and token), then the rarest per rule
    held = urls.select(F.explode(tokens).alias("token")).join(small(literal.select("token").distinct()), "token")
    held = held.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = literal.join(held, "token", "left").groupBy("rule_no").agg(
        F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    index = table.drop("tokens").join(rarest, "rule_no", "left").withColumn("token", F.coalesce("token", F.lit("")))

    fetched = urls.withColumn("_url", key).withColumn("token", F.explode(tokens)).join(small(index), "token", "left")
    # a URL without candidates keeps its row through the empty token
    matched = fetched.filter((F.col("token") == "") | F.col("rule_no").isNotNull()).withColumn(
        "_fits", F.when(F.col("rule_no").isNotNull(), F.expr("regexp_like(_url, regex)")).otherwise(F.lit(False)))
    host_fit = F.col("_fits") & (F.col("kind") == "host")
    best = F.max_by(F.struct("name", "verdict"), F.when(host_fit, F.struct(
        "length", "host_length", "verdict", "name")))
    return matched.groupBy("_row").agg(
        F.first("_id").alias(id_col), F.first("host").alias("host"), F.first("path").alias("path"),
        best.alias("_best"),
        F.sort_array(F.collect_set(F.when(F.col("_fits") & (F.col("kind") == "pattern"), F.col("name")))).alias("patterns"),
    ).select(
        id_col, "host", "path", F.col("_best.name").alias("rule"),
        F.coalesce("_best.verdict", F.when(F.size("patterns") > 0, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.array_join("patterns", ",").alias("patterns"))
