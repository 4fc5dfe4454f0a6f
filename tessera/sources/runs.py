"""Experiment-run tables: an append-only long log of parameters, metrics, runs
and their artifacts, the per-run view that a run search returns, and trees of
nested runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.fixpoint import reach


class RunLog:
    """Parquet tables in append mode: ``(run_id, key, value, step)`` metrics,
    ``(run_id, key, value)`` params, ``(run_id, parent_run_id)`` runs (no parent at
    the top) and ``(run_id, path, content)`` artifacts, whose content is binary."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _append(self, df: DataFrame, table: str) -> None:
        df.write.mode("append").parquet(f"{self.root}/{table}")

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table}")

    def log_metrics(self, df: DataFrame) -> None:
        self._append(df.select("run_id", "key", F.col("value").cast("double"), F.col("step").cast("long")), "metrics")

    def log_params(self, df: DataFrame) -> None:
        self._append(df.select("run_id", "key", F.col("value").cast("string")), "params")

    def log_runs(self, df: DataFrame) -> None:
        self._append(df.select("run_id", "parent_run_id"), "runs")

    def log_artifacts(self, df: DataFrame) -> None:
        self._append(df.select("run_id", "path", F.col("content").cast("binary")), "artifacts")

    def metrics(self) -> DataFrame:
        return self._read("metrics")

    def params(self) -> DataFrame:
        return self._read("params")

    def runs(self) -> DataFrame:
        return self._read("runs")

    def artifacts(self) -> DataFrame:
        return self._read("artifacts")


def run_trees(runs: DataFrame) -> DataFrame:
    """(root, run_id): the run at the top above every run, itself for those at the
    top.  Parents are followed by path doubling; a parent that was never logged
    counts as one at the top."""
    up = runs.filter("parent_run_id is not null").select(F.col("run_id").alias("node"), F.col("parent_run_id").alias("next")).distinct()
    every = runs.select("run_id").distinct()
    above = reach(every.select(F.col("run_id").alias("start"), F.col("run_id").alias("node")), up)
    top = above.join(up.select("node").distinct(), "node", "left_anti")
    return top.select(F.col("node").alias("root"), F.col("start").alias("run_id"))


def run_table(metrics: DataFrame, params: DataFrame | None, order: Column) -> DataFrame:
    """One row per run: ``metrics`` map<string,double> with the last logged value
    of each key (``order`` decides "last") and ``params`` map<string,string>.
    Any metric name is kept.  A run's maps hold as many entries as it has names."""
    last = metrics.groupBy("run_id", "key").agg(F.max_by("value", order).alias("value"))
    named = lambda: F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value"))))
    runs = last.groupBy("run_id").agg(named().alias("metrics"))
    if params is None:
        return runs.withColumn("params", F.lit(None).cast("map<string,string>"))
    kept = params.groupBy("run_id", "key").agg(F.max("value").alias("value")).groupBy("run_id").agg(named().alias("params"))
    return runs.join(kept, "run_id", "full")


def best_run(runs: DataFrame, metric: str) -> DataFrame:
    """Run with the least ``metric`` (absent = +inf); ties go to the smallest run id."""
    key = F.struct(F.coalesce(F.col(metric), F.lit(float("inf"))).alias("m"), F.col("run_id").alias("r"))
    return runs.agg(F.min_by("run_id", key).alias("run_id"), F.min_by(metric, key).alias(metric))
