"""Request validation, batch checks, request metrics, latency files and
per-user windows over ``events`` (request key = user_id + event_type,
success = event_type <> 'error', time = value) and ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import requests as rq
from tessera.plans.registry import register
from tessera.sources import files
from tessera.sources.tables import Tables


@register("val_request_bounds", sql=f"""SELECT doc_id, length(text) BETWEEN 1 AND 1000 AS is_valid,
  CASE WHEN text IS NULL OR length(text) < 1 THEN '{rq.ERR_EMPTY}' WHEN length(text) > 1000 THEN '{rq.ERR_TOO_LONG}' END AS error
FROM documents""")
def val_request_bounds(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    ok, err = rq.validate_text(F.col("text"))
    return d.select("doc_id", ok.alias("is_valid"), err.alias("error"))


@register("val_batch_size", sql=f"""SELECT user_id, count(*) AS n_texts, count(*) <= 100 AS accepted,
  CASE WHEN count(*) > 100 THEN '{rq.ERR_BATCH}' END AS error FROM events GROUP BY user_id""")
def val_batch_size(spark, sf_dir):
    return rq.batch_sizes(Tables(spark, sf_dir).events, "user_id")


@register("src_request_json", sql="""SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
  coalesce(json_extract_string(props, '$.model_version'), 'default') AS model_version FROM events""")
def src_request_json(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    req = rq.parse_request(F.col("props"), "k int, model_version string", {"model_version": rq.DEFAULT_MODEL_VERSION})
    return ev.select("event_id", req.alias("r")).select("event_id", "r.k", "r.model_version")


CACHE_TTL_SECONDS = 3600  # the pipeline's default cache TTL

WALK_SQL = f"""e AS (
  SELECT user_id, event_type, event_id, value, epoch_us(ts) AS t, event_type <> 'error' AS ok,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events),
walk AS (
  SELECT user_id, event_type, rn, event_id, CASE WHEN ok THEN t END AS miss, false AS hit FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.event_type, e.rn, e.event_id,
         CASE WHEN coalesce(e.t - w.miss < {CACHE_TTL_SECONDS * 1_000_000}, false) THEN w.miss WHEN e.ok THEN e.t END,
         coalesce(e.t - w.miss < {CACHE_TTL_SECONDS * 1_000_000}, false)
  FROM walk w JOIN e ON e.user_id = w.user_id AND e.event_type = w.event_type AND e.rn = w.rn + 1),
r AS (SELECT e.event_type, e.value, walk.hit FROM e JOIN walk USING (event_id))"""


@register("agg_request_metrics", sql=f"""WITH RECURSIVE {WALK_SQL}
SELECT count(*) AS total_requests,
       count(*) FILTER (WHERE NOT hit AND event_type <> 'error') AS successful_requests,
       round(avg(value) FILTER (WHERE NOT hit AND event_type <> 'error'), 6) AS average_processing_time,
       count(*) FILTER (WHERE hit) AS cache_hits,
       round(CASE WHEN count(*) = 0 THEN 0.0 ELSE count(*) FILTER (WHERE hit) / count(*) END, 6) AS cache_hit_rate
FROM r""")
def agg_request_metrics(spark, sf_dir):
    """Pipeline counters with the real cache: a request is a hit when its key
    (user_id, event_type) was computed with success less than an hour before; hits count
    in the total, only computed successes in the success count and mean time."""
    ev = Tables(spark, sf_dir).events.withColumn("t_us", F.unix_micros(F.col("ts").cast("timestamp")))
    hits = rq.ttl_cache_hits(ev, ["user_id", "event_type"], "t_us", "event_id", CACHE_TTL_SECONDS * 1_000_000,
                             success=F.col("event_type") != "error")
    m = rq.cache_metrics(ev.join(hits, "event_id"), F.col("event_type") != "error", "value")
    return m.select("total_requests", "successful_requests", F.round("average_processing_time", 6).alias("average_processing_time"),
                    "cache_hits", F.round("cache_hit_rate", 6).alias("cache_hit_rate"))


@register("agg_latency_mean", sql="""SELECT event_type AS endpoint,
  round(avg(CAST(replace(replace(printf('%.2f', value), '.', ','), ',', '.') AS DOUBLE)), 6) AS mean_seconds
FROM events GROUP BY event_type""")
def agg_latency_mean(spark, sf_dir):
    """Latency file with a decimal comma (quoted by the CSV writer): written,
    read back as text, comma turned into a point, averaged per endpoint."""
    ev = Tables(spark, sf_dir).events
    rows = ev.select(F.col("event_type").alias("endpoint"),
                     F.regexp_replace(F.format_string("%.2f", "value"), r"\.", ",").alias("seconds"))
    path = files.scratch_path(spark, "latency")
    files.write_csv(rows, path)
    raw = files.read_csv_strings(spark, path, ["endpoint", "seconds"])
    secs = F.regexp_replace("seconds", ",", ".").try_cast("double")
    return raw.filter(F.col("endpoint").isNotNull()).groupBy("endpoint").agg(F.round(F.avg(secs), 6).alias("mean_seconds"))


@register("win_running_average", sql="""SELECT event_id, user_id, running_count, round(running_sum, 2) AS running_sum,
  round(running_sum, 2) / running_count AS running_mean FROM (
  SELECT event_id, user_id,
    count(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count,
    sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_sum
  FROM events)""")
def win_running_average(spark, sf_dir):
    """Running mean of the processing time per user (values are in cents, so
    the checked mean is the running sum rounded to cents over the count: an
    exact IEEE quotient, not rounded again, so no decimal tie can differ)."""
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "value")
    r = rq.running_mean(ev, "user_id", ["ts", "event_id"], "value")
    cents = F.round("running_sum", 2)
    return r.select("event_id", "user_id", "running_count", cents.alias("running_sum"),
                    (cents / F.col("running_count")).alias("running_mean"))  # identical doubles in both engines


@register("win_keep_newest", sql="""SELECT event_id, user_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 5""")
def win_keep_newest(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts")
    return rq.keep_newest(ev, "user_id", ["ts", "event_id"], 5).select("event_id", "user_id")
