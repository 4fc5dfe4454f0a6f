"""Column helpers and scratch tables shared by the operators of this package."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.files import scratch_path

# The white space that separates words in the contracts, as a
# character set for trimming and as a regular-expression class.
WHITE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does that for pure ASCII (its fast
    path); other texts go through ``translate``, which leaves É or Ж alone."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def word_count(text: Column) -> Column:
    """Number of runs of non-white characters; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it
    back: the lineage ends there, so a lost executor costs a re-read, later
    branches read only the columns they need, and no work is done twice."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(df: DataFrame) -> int:
    """The session's shuffle-partition count (the cluster sizes it to the data)."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, *cols) -> DataFrame:
    """Hash-partition small rows that carry much work: the explicit count keeps
    AQE from putting them into a few tasks."""
    return df.repartition(partitions(df), *cols)


def fold(doc_id: Column, mod: int = 5) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod
