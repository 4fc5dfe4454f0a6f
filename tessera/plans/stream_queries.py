"""Streaming queries over ``events`` / ``embeddings`` run to completion with
``availableNow``; each returns the sink's content, checked against the batch
equivalent."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.registry import register
from tessera.sources import files
from tessera.sources.collection import Collection
from tessera.sources.tables import Tables
from tessera.streaming import requests as st

TTL_SECONDS = 3 * 24 * 3600  # checked TTL (the 3600 s default gives almost no hits on this data)


@register("stm_score_requests", sql="""SELECT event_id, k IS NOT NULL AND k BETWEEN 0 AND 100 AS is_valid,
  CASE WHEN k IS NOT NULL AND k BETWEEN 0 AND 100 THEN CASE WHEN k >= 50 THEN 'high' ELSE 'low' END ELSE 'error' END AS label,
  CASE WHEN k IS NOT NULL AND k BETWEEN 0 AND 100 THEN k / 100.0 ELSE 0.0 END AS confidence
FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""")
def stm_score_requests(spark, sf_dir):
    out = files.scratch_path(spark, "scored")
    st.run_to_parquet(st.score_requests(st.stream_table(spark, sf_dir, "events")), out + "/data", out + "/ck")
    return spark.read.parquet(out + "/data")


@register("stm_ttl_cache", sql=f"""WITH RECURSIVE e AS (
  SELECT user_id, event_type, event_id, epoch_us(ts) AS t,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events),
walk AS (
  SELECT user_id, event_type, rn, event_id, t AS miss, false AS hit FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.event_type, e.rn, e.event_id,
         CASE WHEN e.t - w.miss < {TTL_SECONDS * 1_000_000} THEN w.miss ELSE e.t END,
         e.t - w.miss < {TTL_SECONDS * 1_000_000}
  FROM walk w JOIN e ON e.user_id = w.user_id AND e.event_type = w.event_type AND e.rn = w.rn + 1)
SELECT event_id, hit FROM walk""")
def stm_ttl_cache(spark, sf_dir):
    out = files.scratch_path(spark, "ttl")
    s = st.ttl_cache(st.stream_table(spark, sf_dir, "events"), ["user_id", "event_type"], TTL_SECONDS)
    st.run_to_parquet(s, out + "/data", out + "/ck")
    return spark.read.parquet(out + "/data")


@register("stm_request_metrics", sql="""WITH k AS (
  SELECT date_trunc('day', ts) AS d, user_id, event_type, count(*) AS n, arg_min(value, (ts, event_id)) AS t FROM events GROUP BY ALL),
m AS (SELECT d, CAST(sum(n) AS BIGINT) AS total_requests, count(*) FILTER (WHERE event_type <> 'error') AS successful_requests,
  round(sum(t) FILTER (WHERE event_type <> 'error'), 2) AS success_seconds, CAST(sum(n) - count(*) AS BIGINT) AS cache_hits FROM k GROUP BY d)
SELECT strftime(d, '%Y-%m-%d') AS day, total_requests, successful_requests, success_seconds,
  success_seconds / successful_requests AS average_processing_time, cache_hits, cache_hits / total_requests AS cache_hit_rate FROM m""")
def stm_request_metrics(spark, sf_dir):
    """Daily windows with a watermark, complete output mode; a micro-batch's keyed
    counts are rolled up and written (overwrite) by foreachBatch.  Within a day a
    repeated key is a cache hit; the mean comes from the cent sum."""
    out = files.scratch_path(spark, "metrics")
    keyed = st.keyed_windows(st.stream_table(spark, sf_dir, "events"), ["user_id", "event_type"], F.col("event_type") != "error", "value", ["ts", "event_id"])
    st.run_foreach_batch(keyed, lambda b, _e: st.window_metrics(b).write.mode("overwrite").parquet(out + "/data"), out + "/ck", mode="complete")
    r = spark.read.parquet(out + "/data")
    cents = F.round("success_seconds", 2)
    return r.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "total_requests", "successful_requests",
                    cents.alias("success_seconds"), (cents / F.col("successful_requests")).alias("average_processing_time"), "cache_hits", "cache_hit_rate")


@register("stm_collection_ingest", sql="SELECT vec_id, label FROM embeddings")
def stm_collection_ingest(spark, sf_dir):
    """Two overlapping files arrive one per micro-batch; the stream is then
    replayed from scratch into the same collection: the table is unchanged."""
    base = files.scratch_path(spark, "ingest")
    e = Tables(spark, sf_dir).embeddings.select(F.col("vec_id").alias("id"), "embedding", "label")
    e.filter(F.col("label") <= 5).write.parquet(base + "/in/a")
    e.filter(F.col("label") >= 4).write.parquet(base + "/in/b")
    coll = Collection(spark, base + "/collection")
    for attempt in ("1", "2"):  # second run = replay with a fresh checkpoint
        stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(base + "/in/*")
        st.ingest(stream, coll, base + "/ck" + attempt)
    return coll.frame().select(F.col("id").alias("vec_id"), "label")
