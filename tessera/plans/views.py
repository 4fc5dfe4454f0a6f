"""Derived views over the driver tables: triples T, property-graph nodes V and
edges E, and the conversation role-transition graph ROLES.

Each view exists twice with the same meaning: a Spark DataFrame builder and a
SQL CTE body that the DuckDB oracle inlines.  Edge ids are built from the
edge's own keys (never from a global row_number, which would put every edge
into one task)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.tables import Tables


def _s(prefix: str, col: str):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def _t(s, p, o, kind="iri", lang="", when=None):
    """(predicate, triple as a struct); ``when`` makes it conditional (NULL otherwise)."""
    st = F.struct(
        s.alias("s"),
        F.lit(p).alias("p"),
        (F.lit(o) if isinstance(o, str) else o).alias("o"),
        F.lit(kind).alias("o_kind"),
        F.lit(lang).alias("lang"),
    )
    return p, (st if when is None else F.when(when, st))


def _emit(df: DataFrame, only: set[str] | None, *triples) -> DataFrame | None:
    """Each input row emits its triples: one scan per source table, expanded
    by a generator (conditional triples are NULL and dropped).  With ``only`` just
    those of the named predicates, from the columns they need."""
    wanted = [st for p, st in triples if only is None or p in only]
    return df.select(F.inline(F.array_compact(F.array(*wanted)))) if wanted else None


def triples(spark: SparkSession, sf_dir: str, only: set[str] | None = None) -> DataFrame:
    """The triple view, or the part of it that has the predicates ``only``."""
    t = Tables(spark, sf_dir)
    w = Window.partitionBy("n_regionkey").orderBy("n_nationkey")
    cell = t.nation.select(
        "n_nationkey",
        "n_regionkey",
        F.row_number().over(w).alias("i"),
        F.count(F.lit(1)).over(Window.partitionBy("n_regionkey")).alias("k"),
    )
    cell_id = lambda i: F.concat(F.lit("l"), F.col("n_regionkey").cast("string"), F.lit("_"), i.cast("string"))
    c, n, r = _s("c", "c_custkey"), _s("n", "n_nationkey"), _s("r", "r_regionkey")
    l0 = F.concat(F.lit("l"), F.col("r_regionkey").cast("string"), F.lit("_0"))
    parts = [
        _emit(t.customer, only,
              _t(c, "subClassOf", "NamedPlace"),
              _t(c, "subClassOf", _s("x", "c_nationkey")),
              _t(c, "type", "Class"),
              _t(c, "label", F.col("c_name"), "lit", "en"),
              _t(c, "label", F.lower("c_name"), "lit", "pt", when=F.col("c_custkey") % 2 == 0)),
        _emit(t.nation, only,
              _t(_s("x", "n_nationkey"), "someValuesFrom", n),
              _t(n, "subClassOf", _s("r", "n_regionkey")),
              _t(n, "type", "Class"),
              _t(n, "label", F.col("n_name"), "lit", "en", when=F.col("n_nationkey") % 3 > 0)),
        _emit(t.region, only,
              _t(r, "type", "Class"),
              _t(r, "label", F.col("r_name"), "lit", "en"),
              _t(r, "equivalentClass", _s("q", "r_regionkey")),
              _t(_s("q", "r_regionkey"), "intersectionOf", l0),
              _t(l0, "first", "Place")),
        _emit(cell, only,
              _t(cell_id(F.col("i")), "first", _s("x", "n_nationkey")),
              _t(cell_id(F.col("i") - 1), "rest", cell_id(F.col("i"))),
              _t(cell_id(F.col("i")), "rest", "nil", when=F.col("i") == F.col("k"))),
        _emit(spark.createDataFrame([("placedBy",), ("inNation",)], "p string"), only,
              _t(F.concat(F.lit("p_"), F.col("p")), "type", "ObjectProperty")),
        _emit(t.supplier, only, _t(_s("s", "s_suppkey"), "type", "NamedIndividual")),
    ]
    parts = [p for p in parts if p is not None]
    if not parts:
        return spark.createDataFrame([], "s string, p string, o string, o_kind string, lang string")
    return reduce(DataFrame.unionByName, parts)


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return (
        t.region.select(_s("r", "r_regionkey").alias("id"), F.lit("Region").alias("label"),
                        F.col("r_name").alias("name"), F.lit(None).cast("string").alias("prop"))
        .unionByName(t.nation.select(_s("n", "n_nationkey").alias("id"), F.lit("Nation").alias("label"),
                                     F.col("n_name").alias("name"), F.lit(None).cast("string").alias("prop")))
        .unionByName(t.supplier.select(_s("s", "s_suppkey").alias("id"), F.lit("Supplier").alias("label"),
                                       F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("prop")))
        .unionByName(t.customer.select(_s("c", "c_custkey").alias("id"), F.lit("Customer").alias("label"),
                                       F.col("c_name").alias("name"), F.col("c_mktsegment").alias("prop")))
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    raw = (
        t.nation.select(_s("n", "n_nationkey").alias("src"), F.lit("IN_REGION").alias("type"), _s("r", "n_regionkey").alias("dst"))
        .unionByName(t.supplier.select(_s("s", "s_suppkey").alias("src"), F.lit("BASED_IN").alias("type"),
                                       _s("n", "s_nationkey").alias("dst")))
        .unionByName(t.customer.select(_s("c", "c_custkey").alias("src"), F.lit("LIVES_IN").alias("type"),
                                       _s("n", "c_nationkey").alias("dst")))
    )
    return raw.select(F.concat_ws("|", "src", "type", "dst").alias("edge_id"), "src", "type", "dst")


def roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct role transitions turn t -> turn t + 1 of a conversation (an
    equi-join on (conv_id, turn), so a very long conversation is not
    gathered into one window task)."""
    conv = Tables(spark, sf_dir).conversations
    a = conv.select("conv_id", "turn", F.col("role").alias("src"))
    b = conv.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("dst"))
    trans = a.join(b, ["conv_id", "turn"]).select("src", "dst")
    return trans.distinct().select(F.concat_ws(">", "src", "dst").alias("edge_id"), "src", "dst")


# --- SQL bodies (DuckDB dialect; inlined by oracle queries as CTEs) -----------

T_SQL = """
cell AS (
  SELECT n_nationkey, n_regionkey,
         row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i,
         count(*) OVER (PARTITION BY n_regionkey) AS k
  FROM nation),
T AS (
SELECT 'c' || CAST(c_custkey AS VARCHAR) AS s, 'subClassOf' AS p, 'NamedPlace' AS o, 'iri' AS o_kind, '' AS lang FROM customer
UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), 'subClassOf', 'x' || CAST(c_nationkey AS VARCHAR), 'iri', '' FROM customer
UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), 'type', 'Class', 'iri', '' FROM customer
UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), 'label', c_name, 'lit', 'en' FROM customer
UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), 'label', lower(c_name), 'lit', 'pt' FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT 'x' || CAST(n_nationkey AS VARCHAR), 'someValuesFrom', 'n' || CAST(n_nationkey AS VARCHAR), 'iri', '' FROM nation
UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR), 'subClassOf', 'r' || CAST(n_regionkey AS VARCHAR), 'iri', '' FROM nation
UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR), 'type', 'Class', 'iri', '' FROM nation
UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR), 'label', n_name, 'lit', 'en' FROM nation WHERE n_nationkey % 3 > 0
UNION ALL SELECT 'r' || CAST(r_regionkey AS VARCHAR), 'type', 'Class', 'iri', '' FROM region
UNION ALL SELECT 'r' || CAST(r_regionkey AS VARCHAR), 'label', r_name, 'lit', 'en' FROM region
UNION ALL SELECT 'r' || CAST(r_regionkey AS VARCHAR), 'equivalentClass', 'q' || CAST(r_regionkey AS VARCHAR), 'iri', '' FROM region
UNION ALL SELECT 'q' || CAST(r_regionkey AS VARCHAR), 'intersectionOf', 'l' || CAST(r_regionkey AS VARCHAR) || '_0', 'iri', '' FROM region
UNION ALL SELECT 'l' || CAST(r_regionkey AS VARCHAR) || '_0', 'first', 'Place', 'iri', '' FROM region
UNION ALL SELECT 'l' || CAST(n_regionkey AS VARCHAR) || '_' || CAST(i AS VARCHAR), 'first', 'x' || CAST(n_nationkey AS VARCHAR), 'iri', '' FROM cell
UNION ALL SELECT 'l' || CAST(n_regionkey AS VARCHAR) || '_' || CAST(i - 1 AS VARCHAR), 'rest', 'l' || CAST(n_regionkey AS VARCHAR) || '_' || CAST(i AS VARCHAR), 'iri', '' FROM cell
UNION ALL SELECT 'l' || CAST(n_regionkey AS VARCHAR) || '_' || CAST(i AS VARCHAR), 'rest', 'nil', 'iri', '' FROM cell WHERE i = k
UNION ALL SELECT 'p_' || p, 'type', 'ObjectProperty', 'iri', '' FROM (SELECT 'placedBy' AS p UNION ALL SELECT 'inNation') u
UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), 'type', 'NamedIndividual', 'iri', '' FROM supplier)
"""

V_SQL = """
V AS (
SELECT 'r' || CAST(r_regionkey AS VARCHAR) AS id, 'Region' AS label, r_name AS name, CAST(NULL AS VARCHAR) AS prop FROM region
UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR), 'Nation', n_name, NULL FROM nation
UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), 'Supplier', s_name, CAST(s_nationkey AS VARCHAR) FROM supplier
UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), 'Customer', c_name, c_mktsegment FROM customer)
"""

E_SQL = """
E0 AS (
  SELECT 'n' || CAST(n_nationkey AS VARCHAR) AS src, 'IN_REGION' AS type, 'r' || CAST(n_regionkey AS VARCHAR) AS dst FROM nation
  UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), 'BASED_IN', 'n' || CAST(s_nationkey AS VARCHAR) FROM supplier
  UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), 'LIVES_IN', 'n' || CAST(c_nationkey AS VARCHAR) FROM customer),
E AS (SELECT src || '|' || type || '|' || dst AS edge_id, src, type, dst FROM E0)
"""

ROLES_SQL = """
ROLES AS (
  SELECT DISTINCT a.role || '>' || b.role AS edge_id, a.role AS src, b.role AS dst
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)
"""


def with_views(body: str, *views: str) -> str:
    """Prefix a SELECT with the CTEs it needs: ``with_views(sql, T_SQL, V_SQL)``."""
    return "WITH " + ",\n".join(v.strip() for v in views) + "\n" + body
