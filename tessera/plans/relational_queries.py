"""Projections, filters, heads, sorts, counts and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tessera.operators.knn import metadata_filter
from tessera.plans.registry import register
from tessera.sources.tables import TABLES, Tables

RENAMES = {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderstatus": "status",
           "o_totalprice": "total_price", "o_orderpriority": "priority"}


@register("prj_rename", sql="SELECT " + ", ".join(f"{a} AS {b}" for a, b in RENAMES.items()) + " FROM orders")
def prj_rename(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(*RENAMES)
    return o.withColumnsRenamed(RENAMES)


@register("prj_subset", sql="SELECT doc_id, lang, source FROM documents")
def prj_subset(spark, sf_dir):
    return Tables(spark, sf_dir).documents.select("doc_id", "lang", "source")


@register("prj_head", sql="SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 5")
def prj_head(spark, sf_dir):
    """First n rows by an explicit key (a bare limit is not deterministic)."""
    return Tables(spark, sf_dir).part.select("p_partkey", "p_name").orderBy("p_partkey").limit(5)


@register("flt_metadata_eq", sql="SELECT vec_id, label FROM embeddings WHERE label = 3")
def flt_metadata_eq(spark, sf_dir):
    return metadata_filter(Tables(spark, sf_dir).embeddings, {"label": 3}).select("vec_id", "label")


@register("flt_get_by_ids", sql="SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def flt_get_by_ids(spark, sf_dir):
    """Get by ids: the id list is itself a frame, so membership is a left-semi join."""
    t = Tables(spark, sf_dir)
    return t.documents.join(t.labels.select("doc_id"), "doc_id", "left_semi").select("doc_id", "lang")


@register("flt_case_attribute", sql="SELECT doc_id, source FROM documents WHERE lang = 'de'")
def flt_case_attribute(spark, sf_dir):
    return Tables(spark, sf_dir).documents.filter(F.col("lang") == "de").select("doc_id", "source")


@register("prj_default_missing", sql="""SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, 0) AS toxic
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def prj_default_missing(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return j.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


@register("agg_value_counts", sql="SELECT lang, count(*) AS n FROM documents GROUP BY lang ORDER BY n DESC, lang")
def agg_value_counts(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang")


@register("agg_count_all", sql=" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES))
def agg_count_all(spark, sf_dir):
    t = Tables(spark, sf_dir)
    parts = [getattr(t, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
             for name in TABLES]
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("sort_order_by", sql="SELECT n_nationkey, n_name FROM nation ORDER BY n_name NULLS FIRST")
def sort_order_by(spark, sf_dir):
    return Tables(spark, sf_dir).nation.select("n_nationkey", "n_name").orderBy(F.col("n_name").asc_nulls_first())


@register("topk_desc_limit", sql="SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 5")
def topk_desc_limit(spark, sf_dir):
    """Global top-k: ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject
    (k rows per task, then k overall)."""
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_retailprice")
    return p.orderBy(F.col("p_retailprice").desc(), "p_partkey").limit(5)


@register("limit_any", sql="SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey LIMIT 5")
def limit_any(spark, sf_dir):
    return Tables(spark, sf_dir).nation.select("n_nationkey", "n_name").orderBy("n_nationkey").limit(5)


@register("set_intersect", sql="SELECT c_nationkey AS nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_intersect(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.customer.select(F.col("c_nationkey").alias("nationkey")).intersect(
        t.supplier.select(F.col("s_nationkey").alias("nationkey")))


@register("join_positional_zip", sql="""SELECT CAST(u.conv_id AS VARCHAR) || ':' || CAST(u.turn AS VARCHAR) AS pair_id,
  a.role AS role, CAST(a.turn AS VARCHAR) AS turn, CAST(length(u.text) AS INTEGER) AS question_chars, CAST(length(a.text) AS INTEGER) AS answer_chars
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'""")
def join_positional_zip(spark, sf_dir):
    """Pair each case with its answer on an explicit case key (never a
    generated row number); the two rows are maps of their fields, and on a shared
    field the right side wins."""
    c = Tables(spark, sf_dir).conversations
    fields = lambda name: F.create_map(F.lit("role"), F.col("role"), F.lit("turn"), F.col("turn").cast("string"), F.lit(name), F.col("text"))
    asked = c.filter(F.col("role") == "user").select("conv_id", F.col("turn").alias("at"), fields("question").alias("left"))
    told = c.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("at"), fields("answer").alias("right"))
    pairs = asked.join(told, ["conv_id", "at"]).select("conv_id", "at", merged(F.col("left"), F.col("right")).alias("m"))
    return pairs.select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("at").cast("string")).alias("pair_id"),
                        F.col("m")["role"].alias("role"), F.col("m")["turn"].alias("turn"),
                        F.char_length(F.col("m")["question"]).alias("question_chars"), F.char_length(F.col("m")["answer"]).alias("answer_chars"))


def merged(left, right):
    """Both maps in one; the right value where both have a key (also a null one),
    whatever ``spark.sql.mapKeyDedupPolicy`` says."""
    return F.map_concat(F.map_filter(left, lambda k, _v: ~F.array_contains(F.map_keys(right), k)), right)
