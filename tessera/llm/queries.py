"""The registered queries of this package: one ``opN_<name>`` for each operator,
applied to its whole table with production parameters, and the DuckDB SQL of
those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    brown_lm, decontaminate, lexical_search, line_dedup, mixing, pii, quality_qda, simhash_dedup, spelling, token_counts, topk_search, url_filter,
    vector_dedup,
)
from tessera.llm.common import fold, stored
from tessera.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query("op2_topk_search", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, min(vec) AS qv FROM v WHERE vec_id % 20 = 0 GROUP BY vec_id),
pairs AS (
  SELECT query_id, vec_id, CAST(coalesce(list_sum(list_transform(
           range(1, least(len(qv), len(vec)) + 1), lambda i: qv[i] * vec[i])), 0) AS BIGINT) AS score
  FROM q JOIN v ON vec_id <> query_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 20""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), topk_search.quantised(F.col("embedding")).alias("vec"))
    return topk_search.top_k(vectors, vectors.filter("id % 20 = 0"), k=20)


def _url_sql() -> str:
    host = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p}'"
        for _, h, p in sorted(url_filter.HOST_RULES, key=lambda r: -len(r[1] + r[2])))
    verdict = " ".join(f"WHEN rule = '{h + p}' THEN '{v}'" for v, h, p in url_filter.HOST_RULES)
    hits = ", ".join(f"CASE WHEN regexp_matches(host || path, '{rx}') THEN '{n}' END" for n, rx, _ in url_filter.PATTERNS)
    return f"""
WITH u AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (SELECT *, CASE {host} END AS rule,
        list_sort(list_filter([{hits}], lambda x: x IS NOT NULL)) AS patterns FROM u)
SELECT page_id, host, path, rule, CASE {verdict} WHEN len(patterns) > 0 THEN 'block' ELSE 'allow' END AS verdict,
  array_to_string(patterns, ',') AS patterns
FROM r"""


@query("op8_url_filter", _url_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.default_rules())


DECONTAMINATION_SQL = f"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
    array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i) WHERE len(w) > 0),
d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM documents),
starts AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM d, (SELECT DISTINCT n FROM bw), LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)),
hits AS (SELECT rid, n, i, item_id FROM starts JOIN bw USING (n, win)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (
  SELECT DISTINCT rid, n, i FROM hits), LATERAL (SELECT unnest(range(i, i + n)) AS p) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)"""


def decontamination_digest(found: DataFrame) -> DataFrame:
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(ids, 256).alias("items_sha256"),
                        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


@query("op6_decontaminate", DECONTAMINATION_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination_digest(decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def _permutation_sql(source: str, x: str, n: str, key: str, salt: int, tag: str) -> tuple[str, str]:
    """CTEs that repeat ``mixing.permuted`` round by round; the last one's name."""
    p, out, at = mixing.PRIME, [], source
    for r in range(mixing.ROUNDS):
        a, b, c = (mixing._factor(r, salt + j) for j in (1, 2, 3))
        k = f"(((({key}) + {r}) % {p} * {a}) % {p} * {p} + ((({key}) + {b}) % {p} * {c}) % {p}) % {n}"
        y = f"(({k}) - {x} + {n}) % {n}"
        bit = f"(((greatest({x}, {y}) % {p} * {b} + {a} + ({key})) % {p}) // 65536) % 2"
        out.append(f"{tag}{r} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN {bit} = 1 THEN {y} ELSE {x} END AS {x}) FROM {at})")
        at = f"{tag}{r}"
    return ",\n".join(out), at


def _mixing_sql() -> str:
    size_b, most, p = mixing.BLOCK_WORDS, mixing.MOST, mixing.PRIME
    blocks, last = _permutation_sql("slots0", "block", "blocks", "no * 4 + pass", 0, "pb")
    drawn = lambda c: mixing.drawn(c).replace("div", "//").replace(f"{p}L", str(p))
    return f"""
WITH d AS (SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
n AS (SELECT count(*) // {mixing.SLICE_DOCS} + 1 AS n_slices FROM (SELECT DISTINCT * FROM d)),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no, {most} * source_size AS lim FROM s0),
s2 AS (SELECT *, no % 3 + 1 AS weight FROM s1),
s3 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY lim / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY lim / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev FROM s2),
s4 AS (SELECT *, least(CAST(lim AS DOUBLE), max(lev) OVER () * weight) AS target, (source_size + {size_b - 1}) // {size_b} AS blocks FROM s3),
src AS (SELECT no, source, source_size, target, blocks,
    CASE WHEN source_size > 0 THEN least(CAST(floor(target * blocks / source_size + 0.5) AS BIGINT), {most} * blocks) ELSE 0 END AS n_slots FROM s4),
u AS (SELECT d.*, no, source_size, target, ((coalesce(doc_id, 0) % {p} + {p}) % {p} * 48271) % {p} % n_slices AS slice,
    row_number() OVER () AS rid FROM d JOIN src ON d.source IS NOT DISTINCT FROM src.source, n),
placed AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY no ORDER BY slice, doc_id NULLS FIRST, size, rid
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos FROM u),
pieces AS (SELECT rid, no, block, least(pos + size, (block + 1) * {size_b}) - greatest(pos, block * {size_b}) AS words
  FROM placed, LATERAL (SELECT unnest(range(pos // {size_b}, (pos + size - 1) // {size_b} + 1)) AS block) WHERE size > 0),
tk AS (SELECT *, CAST(sum(n_slots) OVER () AS BIGINT) AS tickets,
    CAST(coalesce(sum(n_slots) OVER (ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_ticket FROM src),
fl AS (SELECT *, greatest({mixing.SHARD_SLOTS}, (tickets + {mixing.MOST_SHARDS - 1}) // {mixing.MOST_SHARDS}) AS whole FROM tk WHERE tickets > 0),
sh AS (SELECT *, least(whole, tickets - shard * whole) AS size FROM fl, LATERAL (SELECT unnest(range(0, (tickets - 1) // whole + 1)) AS shard)),
dr AS (SELECT no, blocks, shard, ({drawn('(first_ticket + n_slots)')}) - ({drawn('first_ticket')}) AS n FROM sh),
ds AS (SELECT *, CAST(coalesce(sum(n) OVER (PARTITION BY no ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS f FROM dr),
slots0 AS (SELECT no, blocks, i % blocks AS block, i // blocks AS pass
  FROM ds, LATERAL (SELECT unnest(range(f, least(f + n, {most} * blocks))) AS i)),
{blocks},
uses AS (SELECT no, block, count(*) AS times FROM {last} GROUP BY no, block),
got AS (SELECT rid, sum(words * times) AS taken FROM pieces JOIN uses USING (no, block) GROUP BY rid)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM u LEFT JOIN got USING (rid)"""


@query("op7_mix_sources", _mixing_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents"))).select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op10_line_dedup", f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, coalesce(doc_id, -9223372036854775808) AS doc, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
dup AS (SELECT key, max(doc) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc) >= 3),
j AS (SELECT rid, pos, line, top IS NOT NULL AND top <> doc AS gone FROM k LEFT JOIN dup USING (key))
SELECT doc_id, n_lines, n_dropped, sha256(coalesce(kept, '')) AS kept_sha256 FROM d JOIN (
  SELECT rid, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
    string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS kept FROM j GROUP BY rid) USING (rid)""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op3_simhash_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, token_counts.estimate(docs, token_counts.piece_scores()))


@query("op9_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: ~s["added"])
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["from"].cast("string"), s["to"].cast("string"))), ",")
    of_kind = lambda k: F.filter(base, lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
                        F.size(F.filter("found", lambda s: s["added"])).cast("long").alias("n_added"),
                        F.size("found").cast("long").alias("n_spans"))


@query("op1_quality_qda")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id")) == 0
    scored = quality_qda.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", (~F.col("trains")).alias("held_out"), "score",
                         (F.col("score") >= quality_qda.KEEP_AT).cast("int").alias("predicted"))


@query("op4_brown_lm")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(F.col("doc_id")) == 1)
    words = brown_lm.learn(docs.filter(~F.col("held_out")).select(F.col("text").cast("binary").alias("_t")))
    paths = stored(brown_lm.class_paths(docs, words, ["doc_id", "held_out"]), "lm-paths")  # read twice: to count steps, to score
    model = brown_lm.fit(words, paths.filter(~F.col("_keep.held_out")))
    scored = brown_lm.scores(paths, model)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"),
                         "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


@query("op11_vector_dedup", """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS e,
    embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS able
  FROM embeddings),
u AS (SELECT rid, vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM v WHERE able),
links AS (
  SELECT a.rid AS a, b.rid AS b FROM u a JOIN u b ON a.rid <> b.rid AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
degree AS (SELECT a AS rid, count(*) AS n_links FROM links GROUP BY a),
reach AS (
  WITH RECURSIVE r AS (SELECT rid AS a, rid AS b FROM u UNION SELECT r.a, links.b FROM r JOIN links ON r.b = links.a) SELECT * FROM r),
low AS (SELECT a AS rid, min(vec_id) AS component_id FROM reach JOIN v ON v.rid = b GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links,
  CASE WHEN able THEN component_id ELSE vec_id END AS component_id,
  vec_id IS NOT DISTINCT FROM CASE WHEN able THEN component_id ELSE vec_id END AS kept
FROM v LEFT JOIN degree USING (rid) LEFT JOIN low USING (rid)""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


_TERMS = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@query("op12_lexical_search", f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY rid, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
b AS (SELECT row_number() OVER () AS no, item_id, {_TERMS} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
q AS (SELECT no, item_id, term, count(*) AS qtf FROM (SELECT no, item_id, unnest(w) AS term FROM b) GROUP BY no, item_id, term),
scored AS (
  SELECT no, item_id, doc_id, rid, CAST(sum(qtf * CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
      * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(w) * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN d USING (rid), s GROUP BY no, item_id, doc_id, rid)
SELECT item_id, CAST(row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"), k=10)


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(stored(spelling.word_counts(table(spark, sf_dir, "documents")), "spelling-counts"))
