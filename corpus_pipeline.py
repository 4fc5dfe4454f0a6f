"""The corpus pipeline: five stages over ``documents``, each calling one operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's documents.  All but the last return
the columns of documents:

1. quality: documents that the classifier scores under 0.3 go;
2. line dedup: lines that many documents repeat go, except in one of them
   (``text`` and ``n_chars`` change, a document may become empty, none goes);
3. near-duplicates: of each SimHash component the smallest document id stays;
4. decontamination: documents with at least a twentieth of their words in
   benchmark windows go;
5. mixing: what the mix takes from each remaining document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, line_dedup, mixing, quality_qda, simhash_dedup
from tessera.llm.common import fold, stored
from tessera.sources.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_qda.keep_good(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id")) != 0)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("text")),
           "n_chars": F.when(changed, F.char_length("kept_text")).otherwise(F.col("n_chars")).cast("long")}
    return found.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.keep_one(docs, stored(simhash_dedup.components(docs), "pipeline-components"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(docs)).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [("quality classifier", quality), ("line dedup", lines), ("SimHash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("mixing sources", mix)]

#: SQL has no SimHash; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return docs
