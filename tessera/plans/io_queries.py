"""Sources and sinks: vector collections, CSV/JSON/text reports, N-Triples.

Every write goes to a fresh folder under the shared checkpoint folder; each
query returns what was read back, so the check covers the round trip."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import evaluation as ev
from tessera.plans import views
from tessera.plans.registry import register
from tessera.plans.retrieval_queries import METRIC_SQL, grouped_eval
from tessera.sources import files, rdf
from tessera.sources.collection import Collection, get_or_create
from tessera.sources.tables import Tables


def _vector_batch(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    return e.select(F.col("vec_id").alias("id"), "embedding",
                    F.create_map(F.lit("label"), F.col("label").cast("string")).alias("metadata"), "label")


@register("snk_collection_append", sql="SELECT vec_id, label FROM embeddings")
def snk_collection_append(spark, sf_dir):
    """Two overlapping batches (labels 0-5 and 4-9) added in turn: the ids of
    the overlap are stored once."""
    c = Collection(spark, files.scratch_path(spark, "collection"))
    batch = _vector_batch(spark, sf_dir)
    c.add(batch.filter(F.col("label") <= 5))
    c.add(batch.filter(F.col("label") >= 4))
    return c.frame().select(F.col("id").alias("vec_id"), "label")


@register("src_collection_get_or_create", sql="SELECT doc_id, lang FROM documents")
def src_collection_get_or_create(spark, sf_dir):
    """Open-or-create twice: the second open finds documents and does not re-load."""
    path = files.scratch_path(spark, "docs")
    docs = Tables(spark, sf_dir).documents.select(F.col("doc_id").alias("id"), F.col("text").alias("content"), "lang")
    get_or_create(spark, path, docs)
    c = get_or_create(spark, path, docs)
    return c.frame().select(F.col("id").alias("doc_id"), "lang")


@register("snk_persistent_roundtrip", sql="SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT 5")
def snk_persistent_roundtrip(spark, sf_dir):
    """First five items (by id) written to a durable collection, reopened."""
    path = files.scratch_path(spark, "persist")
    first5 = _vector_batch(spark, sf_dir).orderBy("id").limit(5)
    Collection(spark, path).add(first5)
    return Collection(spark, path).frame().select(F.col("id").alias("vec_id"))


@register("snk_csv_report", sql="""SELECT CAST(row_number() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS row_idx,
  o_orderstatus AS status, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus""")
def snk_csv_report(spark, sf_dir):
    """Report written as CSV with an explicit index column and read back typed."""
    o = Tables(spark, sf_dir).orders
    rep = o.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    path = files.scratch_path(spark, "report-csv")
    files.write_csv(rep, path, index="row_idx", order=["status"])
    back = spark.read.option("header", True).schema("row_idx int, status string, n_orders long, total double").csv(path)
    return back


_REPORTED = ["precision", "recall", "f1_score", "mrr", "rouge1", "rouge2", "rougeL", "bleu", "semantic_similarity", "answer_length"]


@register("snk_json_report", sql=f"WITH {METRIC_SQL} SELECT group_type, group_value, "
          + ", ".join(f"round(mean_{m}, 6) AS mean_{m}" for m in _REPORTED) + " FROM gg")
def snk_json_report(spark, sf_dir):
    """Nested report (group + struct of all means) as JSON lines, read back with its schema."""
    g = ev.means(grouped_eval(spark, sf_dir), _REPORTED)
    nested = g.select("group_type", "group_value", F.struct(*[F.round(f"mean_{m}", 6).alias(f"mean_{m}") for m in _REPORTED]).alias("metrics"))
    path = files.scratch_path(spark, "report-json")
    files.write_json_lines(nested, path)
    back = files.read_json_lines(spark, path, nested.schema)
    return back.select("group_type", "group_value", "metrics.*")


def _nt_sql() -> str:
    ns = rdf.DEFAULT_NS
    esc = "replace(replace(replace(replace(o, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r')"
    return views.with_views(f"""SELECT '<{ns}' || s || '> <{ns}' || p || '> ' ||
  CASE WHEN o_kind = 'lit' THEN '"' || {esc} || '"' || CASE WHEN lang <> '' THEN '@' || lang ELSE '' END
       ELSE '<{ns}' || o || '>' END || ' .' AS line FROM T""", views.T_SQL)


@register("snk_ntriples", sql=_nt_sql())
def snk_ntriples(spark, sf_dir):
    path = files.scratch_path(spark, "ntriples")
    rdf.write_ntriples(views.triples(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


XSD_INTEGER = "http://www.w3.org/2001/XMLSchema#integer"


@register("src_rdf_triples", sql=views.with_views(f"""SELECT format, s, p, o, o_kind, lang, dtype FROM (
  SELECT DISTINCT s, p, o, o_kind, lang, '' AS dtype FROM T
  UNION SELECT DISTINCT 'c' || CAST(c_custkey AS VARCHAR), 'nationNumber', CAST(c_nationkey AS VARCHAR), 'lit', '', '{XSD_INTEGER}' FROM customer),
  (SELECT unnest(['nt', 'rdf']) AS format)""", views.T_SQL))
def src_rdf_triples(spark, sf_dir):
    """Write the triple view (and a typed literal per customer) as N-Triples and as
    RDF/XML, then load each by its extension as a triple set."""
    typed = Tables(spark, sf_dir).customer.select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("s"), F.lit("nationNumber").alias("p"), F.col("c_nationkey").cast("string").alias("o"),
        F.lit("lit").alias("o_kind"), F.lit("").alias("lang"), F.lit(XSD_INTEGER).alias("dtype"))
    triples = views.triples(spark, sf_dir).withColumn("dtype", F.lit("")).unionByName(typed)
    path = files.scratch_path(spark, "triples")
    rdf.write_ntriples(triples, path + ".nt")
    rdf.write_rdfxml(triples, path + ".rdf")
    read = [rdf.read_triples(spark, f"{path}.{x}").withColumn("format", F.lit(x)) for x in ("nt", "rdf")]
    return read[0].unionByName(read[1])
