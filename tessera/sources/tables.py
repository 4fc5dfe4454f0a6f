"""Readers for the driver tables (one parquet file per table)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def literal(path: str) -> str:
    """Escape Hadoop glob characters so that a folder such as ``part [3-4]`` is
    read literally."""
    return re.sub(r"([\[\]*?{}\\])", r"\\\1", path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazily read one table; Catalyst prunes columns and pushes filters into the scan."""
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(f"{literal(sf_dir.rstrip('/'))}/{name}.parquet")


class Tables:
    """Attribute access to the tables of one scale-factor folder: ``t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def register(self) -> None:
        """Register every table as a temp view (for the SQL-expressed operators)."""
        for name in TABLES:
            table(self.spark, self.sf_dir, name).createOrReplaceTempView(name)
