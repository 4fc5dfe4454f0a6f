"""Structured Streaming forms of the request endpoints: score each request,
answer repeated requests from a TTL cache (keyed state), windowed request
metrics, and incremental ingest into a vector collection.

Queries run with ``trigger(availableNow=True)`` so that a bounded input is
processed to completion; checkpoints live under the shared checkpoint
folder, so a restarted query resumes instead of recomputing."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.sources.collection import Collection


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A driver table as a file stream.  The glob's character class matches
    exactly ``<name>.parquet`` inside the folder of all tables."""
    from tessera.sources.tables import literal, table

    schema = table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{literal(sf_dir.rstrip('/'))}/{name}.parque[t]")  # folder literal, file by glob


def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP; the stored times are wall-clock UTC (NTZ)."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    q = (df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(path))
    q.awaitTermination()


def run_foreach_batch(df: DataFrame, fn, checkpoint: str, mode: str = "append") -> None:
    q = (df.writeStream.foreachBatch(fn).outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


# --- X1: validate and score each request ---------------------------------------------------

def score_requests(requests: DataFrame) -> DataFrame:
    """Body ``{"k": n}`` -> valid when 0 <= k <= 100; label and confidence
    from k (the model stand-in is an expression, so it stays in codegen)."""
    k = F.get_json_object("props", "$.k").cast("int")
    valid = k.isNotNull() & k.between(0, 100)
    return requests.select(
        "event_id",
        valid.alias("is_valid"),
        F.when(valid, F.when(k >= 50, F.lit("high")).otherwise(F.lit("low"))).otherwise(F.lit("error")).alias("label"),
        F.when(valid, k / 100.0).otherwise(F.lit(0.0)).alias("confidence"),
    )


# --- X2: TTL cache as keyed state -----------------------------------------------------------

#: States that the keys of a cache share.
STATE_BUCKETS = 2048
NO_TIME = -(1 << 63)

def ttl_cache(requests: DataFrame, key: list[str], ttl_seconds: int, watermark: str = "1 hour", buckets: int = STATE_BUCKETS) -> DataFrame:
    """Per request: hit when the same key was computed less than
    ``ttl_seconds`` before (expiry counts from the miss; hits do not renew).
    Keys share a state by a hash of the key, so that a call of the walk serves many:
    the time of the last miss of each of them, dropped once the watermark passes its
    expiry (by an event-time timeout where no request comes).  ``buckets`` stays the
    same as long as a checkpoint lives.  A request without a time is computed and
    leaves no trace."""
    ttl_us = ttl_seconds * 1_000_000
    micros = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    src = event_time(requests).withWatermark("ts", watermark).select(
        F.pmod(F.xxhash64(*key), F.lit(buckets)).alias("bucket"), F.to_json(F.struct(*key), micros).alias("key"), "ts",
        F.coalesce(F.unix_micros("ts"), F.lit(NO_TIME)).alias("t_us"), F.col("event_id").isNull().alias("unnamed"),
        F.coalesce("event_id", F.lit(0)).cast("long").alias("event_id"))

    def walk(_bucket: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        misses = dict(zip(*state.get)) if state.exists else {}
        if not state.hasTimedOut:
            pdf = pd.concat(list(batches), ignore_index=True).sort_values(["t_us", "unnamed", "event_id"])
            hits = []
            for k, t in zip(pdf["key"].tolist(), pdf["t_us"].tolist()):
                hits.append(t != NO_TIME and k in misses and t - misses[k] < ttl_us)
                if not hits[-1] and t != NO_TIME:
                    misses[k] = t
            yield pd.DataFrame({"event_id": pdf["event_id"].astype("Int64").mask(pdf["unnamed"]).array, "hit": hits})
        now = state.getCurrentWatermarkMs() * 1000
        misses = {k: t for k, t in misses.items() if t + ttl_us > now}
        if misses:
            state.update((list(misses), list(misses.values())))
            state.setTimeoutTimestamp(-(-(min(misses.values()) + ttl_us) // 1000))
        elif state.exists:
            state.remove()

    return src.groupBy("bucket").applyInPandasWithState(
        walk, "event_id long, hit boolean", "keys array<string>, misses array<long>", "append", GroupStateTimeout.EventTimeTimeout)


# --- X3: windowed request metrics ------------------------------------------------------------

def keyed_windows(requests: DataFrame, key: list[str], success: Column, seconds: str, order: list[str], window: str = "1 day",
                  watermark: str = "1 hour") -> DataFrame:
    """(window, key..., n, first): the requests of each key in each window and the
    first of them - the one that is computed by a cache emptied with the window."""
    first = F.min_by(F.struct(success.alias("ok"), F.col(seconds).alias("t")), F.struct(*order))
    return event_time(requests).withWatermark("ts", watermark).groupBy(F.window("ts", window), *key).agg(
        F.count(F.lit(1)).alias("n"), first.alias("first"))


def window_metrics(keyed: DataFrame) -> DataFrame:
    """Counters of each window from ``keyed_windows``: all requests, computed
    successes with their time, cache hits and hit rate."""
    return keyed.groupBy("window").agg(
        F.sum("n").alias("total_requests"), F.count_if("first.ok").alias("successful_requests"),
        F.sum(F.when(F.col("first.ok"), F.col("first.t"))).alias("success_seconds"),
        (F.sum("n") - F.count(F.lit(1))).alias("cache_hits")).withColumn("cache_hit_rate", F.col("cache_hits") / F.col("total_requests"))


# --- X4: incremental collection ingest -------------------------------------------------------

def ingest(stream: DataFrame, collection: Collection, checkpoint: str) -> None:
    """Each micro-batch is added with the idempotent collection ``add``, so a
    replayed batch (after a failure) leaves the table unchanged; one that the
    collection's log has under this checkpoint is not read again."""
    run_foreach_batch(stream, lambda batch, epoch: collection.add(batch, epoch=f"{checkpoint}/{epoch}"), checkpoint)


def score_with_model(requests: DataFrame, model, text: str, keep: list[str]) -> DataFrame:
    """Streaming prediction requests scored by a fitted Spark ML pipeline
    (TF-IDF + forest, or any model with a ``probability`` column): requests
    failing the text rules give ("error", 0.0), the others the arg-max class
    and its probability.  The model is applied to each micro-batch by Spark;
    nothing is collected."""
    from tessera.operators import classify as cl

    return cl.batch_predict_safe(model, requests, text, keep)
