"""File sources and sinks: CSV with header, JSON lines, text reports.

Scratch output goes under the shared reliable-checkpoint folder
(``spark.checkpoint.dir``), never a machine-local temp folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-io/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back:
    several readers do the work once, and a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, index: str | None = None, order: list[str] | None = None) -> None:
    """CSV with a header row.  ``index`` adds an explicit row-number column
    (pandas' index) computed from ``order`` — a global ordering, so only for
    report-sized frames.  Map/array columns are written as JSON text."""
    out = df
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType)):
            out = out.withColumn(f.name, F.to_json(f.name))
    if index:
        from pyspark.sql import Window

        out = out.withColumn(index, F.row_number().over(Window.orderBy(*(order or df.columns))) - 1)
        out = out.select(index, *[c for c in out.columns if c != index])
    out.write.mode("overwrite").option("header", True).csv(path)


def read_csv_strings(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """``LOAD CSV WITH HEADERS``: fields by the names of the header row, in
    whatever order the file has them, every one a string (no inference); a
    name that the header lacks is null."""
    rows = spark.read.option("header", True).csv(path)
    return rows.select(*[F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns])


def to_integer(col: str):
    """Cypher ``toInteger``: integer text -> int, anything else -> null."""
    return F.col(col).try_cast("long")


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_text(df: DataFrame, col: str, path: str) -> None:
    df.select(F.col(col).alias("value")).write.mode("overwrite").text(path)
