"""Request handling as data: validation predicates, batch-size checks, request
metrics, running averages and bounded recent-entry tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.fixpoint import cut

# Request bounds and rejection texts of the prediction service.
TEXT_MIN_CHARS, TEXT_MAX_CHARS = 1, 1000
MAX_BATCH = 100
ERR_EMPTY = "text must not be empty"
ERR_TOO_LONG = "text longer than 1000 characters"
ERR_BATCH = "Too many texts in batch"
DEFAULT_MODEL_VERSION = "default"


def validate_text(text: Column) -> tuple[Column, Column]:
    """(is_valid, error): 1..1000 characters, rows are kept and flagged."""
    err = length_error(F.char_length(text))
    return err.isNull(), err


def length_error(chars: Column) -> Column:
    """The rejection of a text of so many characters (null: no text), or null."""
    return F.when(chars.isNull() | (chars < TEXT_MIN_CHARS), F.lit(ERR_EMPTY)).when(chars > TEXT_MAX_CHARS, F.lit(ERR_TOO_LONG))


def batch_sizes(df: DataFrame, batch: str) -> DataFrame:
    """One row per batch: size, accepted (<= 100 texts), error.  A plain
    aggregation, so a huge batch is combined map-side."""
    g = df.groupBy(batch).agg(F.count(F.lit(1)).alias("n_texts"))
    ok = F.col("n_texts") <= MAX_BATCH
    return g.select(batch, "n_texts", ok.alias("accepted"), F.when(~ok, F.lit(ERR_BATCH)).alias("error"))


def parse_request(body: Column, schema: str, defaults: dict[str, object]) -> Column:
    """JSON body -> typed struct; malformed bodies give NULL fields
    (PERMISSIVE); absent optional fields get their defaults."""
    parsed = F.from_json(body, schema, {"mode": "PERMISSIVE"})
    st = T._parse_datatype_string(schema)
    fields = []
    for f in st.fields:
        c = parsed[f.name]
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]))
        fields.append(c.alias(f.name))
    return F.struct(*fields)


def request_metrics(requests: DataFrame, key: list[str], order: list[str], success: Column, seconds: str) -> DataFrame:
    """Counters of a request cache without expiry: the first request of a key
    is computed (a miss), every later one is a cache hit.  total, successful
    (computed and succeeded), mean time of those, hits and hit rate.

    Computed per key with ``min_by`` (partial aggregation, so a hot key is
    combined map-side), then summed."""
    per_key = requests.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(F.struct(success.alias("ok"), F.col(seconds).alias("t")), F.struct(*order)).alias("first"),
    )
    total = F.sum("n")
    hits = F.sum("n") - F.count(F.lit(1))
    return per_key.agg(
        total.cast("long").alias("total_requests"),
        F.count_if(F.col("first.ok")).cast("long").alias("successful_requests"),
        F.avg(F.when(F.col("first.ok"), F.col("first.t"))).alias("average_processing_time"),
        hits.cast("long").alias("cache_hits"),
        F.when(total == 0, F.lit(0.0)).otherwise(hits / total).alias("cache_hit_rate"),
    )


def cache_metrics(requests: DataFrame, success: Column, seconds: str, hit: str = "hit") -> DataFrame:
    """Counters of a request cache from per-request hit flags: total (hits
    included), successful and mean time over computed requests only, hits,
    hit rate (0 when there is no request).  One global aggregation."""
    computed_ok = ~F.col(hit) & success
    total = F.count(F.lit(1))
    hits = F.count_if(F.col(hit))
    return requests.agg(
        total.alias("total_requests"),
        F.count_if(computed_ok).alias("successful_requests"),
        F.avg(F.when(computed_ok, F.col(seconds))).alias("average_processing_time"),
        hits.alias("cache_hits"),
        F.when(total == 0, F.lit(0.0)).otherwise(hits / total).alias("cache_hit_rate"),
    )


def _slices(df: DataFrame) -> int:
    """Slices of a range-partitioned frame: the session's shuffle-partition
    count, which a cluster sizes to its data."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def keep_newest(df: DataFrame, key: str, order_desc: list[str], n: int) -> DataFrame:
    """At most ``n`` newest rows per key.  ``row_number <= n`` becomes a
    partial ``WindowGroupLimit`` before the shuffle, so no key ships more
    than n rows per map task."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order_desc])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def running_sum(df: DataFrame, keys: list[str], order: list, value: str, parts: int | None = None) -> DataFrame:
    """Adds ``running_sum`` / ``running_count`` of ``value`` per key in
    ``order`` (rows frame, unbounded preceding .. current row), as a
    distributed prefix sum: range-partition on (keys, order) so that a hot key
    is spread over several partitions, take running sums inside each
    (partition, key) slice, then add the totals of the key's earlier slices.
    ``order`` items are column names or sort expressions.  The
    range-partitioned frame is checkpointed so that slice ids are stable if a
    task is recomputed."""
    sort = [F.col(o) if isinstance(o, str) else o for o in order]
    parts = parts or _slices(df)
    ranged = cut(df.repartitionByRange(parts, *keys, *sort).withColumn("_slice", F.spark_partition_id()))
    w_in = Window.partitionBy("_slice", *keys).orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("_s", F.sum(value).over(w_in)).withColumn("_c", F.count(value).over(w_in))
    totals = ranged.groupBy(*keys, "_slice").agg(F.sum(value).alias("_ts"), F.count(value).alias("_tc"))
    w_prev = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_slice", F.coalesce(F.sum("_ts").over(w_prev), F.lit(0)).alias("_os"),
                            F.coalesce(F.sum("_tc").over(w_prev), F.lit(0)).alias("_oc"))
    out = local.join(offsets, [*keys, "_slice"])
    return out.withColumn("running_sum", F.col("_s") + F.col("_os")).withColumn(
        "running_count", F.col("_c") + F.col("_oc")).drop("_slice", "_s", "_c", "_os", "_oc")


def running_mean(df: DataFrame, key: str, order: list[str], value: str, parts: int | None = None) -> DataFrame:
    """Cumulative mean of ``value`` per key in ``order`` (see ``running_sum``)."""
    out = running_sum(df, [key], order, value, parts)
    return out.withColumn("running_mean", F.try_divide(F.col("running_sum"), F.col("running_count")))


def ttl_cache_hits(df: DataFrame, key: list[str], ts_us: str, event: str, ttl_us: int, parts: int | None = None,
                   success: Column | None = None) -> DataFrame:
    """Batch form of the TTL cache, exact and safe for hot keys.

    Only requests with ``success`` (all, if not given) fill the cache.  Per key,
    in (time, event) order, the first of them is a miss and fills it, and the
    next fill is the first of them at least ``ttl_us`` after the last; the
    others are hits.  A request without success is a hit when a fill of its key
    is less than ``ttl_us`` old, and otherwise a miss that fills nothing.  So the misses are the chain
    ``first -> nxt(first) -> ...`` where ``nxt(e)`` is the first request of
    the key at or after ``t(e) + ttl``.

    1. ``nxt`` without a per-key window: rows are range-partitioned on (key,
       time) into slices (a hot key spans several), each probe ``t + ttl``
       finds its successor inside its slice with a window over
       (slice, key), and otherwise takes the first request of the key's next
       non-empty slice from a per-(key, slice) table.
    2. Chain membership by pointer doubling: ``reach`` holds the requests
       within 2^i steps of a key's first request and ``jump`` the 2^i-th
       successor of every request; each round is two joins on the request
       id (uniformly distributed), and there are log2(chain length) rounds.
    Returns ``(event, hit)``."""
    parts = parts or _slices(df)
    every = df.select(*key, F.col(ts_us).alias("_t"), F.col(event).alias("_e"),
                      (F.lit(True) if success is None else F.coalesce(success, F.lit(False))).alias("_ok"))
    ev = every.filter("_ok").drop("_ok")
    probes = ev.select(*key, (F.col("_t") + F.lit(ttl_us)).alias("_t"), F.col("_e").alias("_src"),
                       F.lit(None).cast(ev.schema["_e"].dataType).alias("_e"), F.lit(0).alias("_kind"))
    rows = ev.select(*key, "_t", F.lit(None).cast(ev.schema["_e"].dataType).alias("_src"), "_e", F.lit(1).alias("_kind"))
    allr = cut(probes.unionByName(rows).repartitionByRange(parts, *key, "_t", "_kind", "_e")
               .withColumn("_slice", F.spark_partition_id()))
    # successor inside the slice: first real row at or after the probe (probes sort before rows at equal time)
    w_next = Window.partitionBy("_slice", *key).orderBy("_t", "_kind", "_e").rowsBetween(Window.currentRow,
                                                                                         Window.unboundedFollowing)
    local = allr.withColumn("_n", F.first("_e", ignorenulls=True).over(w_next)).filter(F.col("_kind") == 0)
    # otherwise: first row of the key in a later slice
    slices = allr.select(*key, "_slice").distinct()  # every (key, slice), also slices holding only probes
    first_in_slice = slices.join(
        allr.filter(F.col("_kind") == 1).groupBy(*key, "_slice").agg(F.min_by("_e", F.struct("_t", "_e")).alias("_first")),
        [*key, "_slice"], "left")
    w_later = Window.partitionBy(*key).orderBy("_slice").rowsBetween(1, Window.unboundedFollowing)
    carry = first_in_slice.select(*key, "_slice", F.first("_first", ignorenulls=True).over(w_later).alias("_carry"))
    nxt = cut(local.join(carry, [*key, "_slice"], "left").select(
        F.col("_src").alias("_e"), F.coalesce("_n", "_carry").alias("_n")))
    # chain heads: the first request of each key
    heads = ev.groupBy(*key).agg(F.min_by("_e", F.struct("_t", "_e")).alias("_e")).select("_e")
    reach = cut(heads)
    jump = nxt.filter(F.col("_n").isNotNull())
    rounds = 0
    while True:
        rounds += 1
        new = cut(reach.join(jump, "_e").select(F.col("_n").alias("_e")).join(reach, "_e", "left_anti").distinct())
        if new.isEmpty():
            break
        reach = reach.unionByName(new)  # both pieces are checkpointed
        if rounds % 3 == 0:
            reach = cut(reach)
        jump = cut(jump.alias("a").join(jump.alias("b"), F.col("a._n") == F.col("b._e")).select(
            F.col("a._e").alias("_e"), F.col("b._n").alias("_n")))
    misses = reach.withColumn("_miss", F.lit(True))
    hits = ev.select("_e").join(misses, "_e", "left").select(F.col("_e").alias(event), F.col("_miss").isNull().alias("hit"))
    if success is None:
        return hits
    # fills of a key are ttl apart, so at most two matter to a request: those of its ttl-long bucket and the one before
    bucket = F.floor(F.col("_t") / ttl_us)
    fills = ev.join(reach, "_e").select(*key, F.col("_t").alias("_fill"), F.explode(F.array(bucket, bucket + 1)).alias("_bucket"))
    failed = every.filter("NOT _ok").withColumn("_bucket", bucket)
    served = failed.join(fills, [*key, "_bucket"]).filter(
        (F.col("_fill") <= F.col("_t")) & (F.col("_t") < F.col("_fill") + ttl_us)).select("_e").distinct()
    failed_hits = failed.select("_e").join(served.withColumn("_hit", F.lit(True)), "_e", "left").select(
        F.col("_e").alias(event), F.col("_hit").isNotNull().alias("hit"))
    return hits.unionByName(failed_hits)
