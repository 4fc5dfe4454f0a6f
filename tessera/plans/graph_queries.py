"""Property-graph queries over the node view V (regions, nations, suppliers,
customers) and edge view E (IN_REGION, BASED_IN, LIVES_IN), the role
transition graph ROLES, and CSV node import from ``supplier``."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.operators import graph as gr
from tessera.plans import views
from tessera.plans.registry import register
from tessera.sources import files
from tessera.sources.tables import Tables


def WV(body: str, *extra: str) -> str:
    return views.with_views(body, views.V_SQL, views.E_SQL, *extra)


@register("graph_build", sql=views.with_views("SELECT edge_id, src, type, dst FROM E", views.E_SQL))
def graph_build(spark, sf_dir):
    """Typed edges derived from the foreign keys of the star schema."""
    return views.edges(spark, sf_dir)


@register("graph_nodes", sql=views.with_views("SELECT name, label AS labels FROM V", views.V_SQL))
def graph_nodes(spark, sf_dir):
    return views.nodes(spark, sf_dir).select("name", F.col("label").alias("labels"))


@register("join_edge_endpoints", sql=WV("""SELECT a.name AS source, E.type AS relationship, b.name AS target
FROM E JOIN V a ON a.id = E.src JOIN V b ON b.id = E.dst"""))
def join_edge_endpoints(spark, sf_dir):
    return gr.edge_endpoints(views.nodes(spark, sf_dir), views.edges(spark, sf_dir))


@register("agg_node_degree", sql=WV("""SELECT V.id, V.name, coalesce(d.degree, 0) AS degree, V.label AS type
FROM V LEFT JOIN (SELECT id, count(DISTINCT edge_id) AS degree FROM (
    SELECT edge_id, src AS id FROM E UNION ALL SELECT edge_id, dst FROM E) GROUP BY id) d ON d.id = V.id"""))
def agg_node_degree(spark, sf_dir):
    return gr.degree(views.nodes(spark, sf_dir), views.edges(spark, sf_dir))


@register("graph_export", sql=views.with_views(
    "SELECT name, label AS labels, json_object('name', name, 'prop', prop)::VARCHAR AS properties FROM V", views.V_SQL))
def graph_export(spark, sf_dir):
    v = views.nodes(spark, sf_dir)
    props = F.to_json(F.create_map(F.lit("name"), F.col("name"), F.lit("prop"), F.col("prop")))
    return v.select("name", F.col("label").alias("labels"), props.alias("properties"))


# --- MATCH ..., (d {name}) CREATE and the narrowing WITH chain -----------------------------

S1, S2 = "Supplier#000000001", "Supplier#000000002"


@register("join_cross_connect", sql=views.with_views("""SELECT id AS src, 'WORKS_IN' AS type,
  (SELECT id FROM V WHERE label = 'Region' AND name = 'AFRICA') AS dst FROM V WHERE label = 'Supplier'""", views.V_SQL))
def join_cross_connect(spark, sf_dir):
    v = views.nodes(spark, sf_dir)
    target = gr.match_one(v, (F.col("label") == "Region") & (F.col("name") == "AFRICA"))
    return gr.connect(v.filter(F.col("label") == "Supplier"), target, "WORKS_IN")


@register("join_narrowing_chain", sql=views.with_views(f"""SELECT id AS src, 'WORKS_IN' AS type,
  (SELECT id FROM V WHERE label = 'Region' AND name = 'AFRICA') AS dst FROM V WHERE label = 'Supplier'
UNION ALL SELECT id, 'CONTRIBUTED_TO', (SELECT id FROM V WHERE label = 'Nation' AND name = 'NATION_1')
  FROM V WHERE label = 'Supplier' AND name = '{S1}'
UNION ALL SELECT id, 'CONTRIBUTED_TO', (SELECT id FROM V WHERE label = 'Nation' AND name = 'NATION_2')
  FROM V WHERE label = 'Supplier' AND name = '{S1}' AND name = '{S2}'""", views.V_SQL))
def join_narrowing_chain(spark, sf_dir):
    """Three MATCH/CREATE clauses chained by ``WITH r``: each re-match filters
    the rows carried from the clause before, so the third matches nothing."""
    v = views.nodes(spark, sf_dir)
    carried = v.filter(F.col("label") == "Supplier")
    e1 = gr.connect(carried, gr.match_one(v, (F.col("label") == "Region") & (F.col("name") == "AFRICA")), "WORKS_IN")
    carried = carried.filter(F.col("name") == S1)
    e2 = gr.connect(carried, gr.match_one(v, (F.col("label") == "Nation") & (F.col("name") == "NATION_1")), "CONTRIBUTED_TO")
    carried = carried.filter(F.col("name") == S2)
    e3 = gr.connect(carried, gr.match_one(v, (F.col("label") == "Nation") & (F.col("name") == "NATION_2")), "CONTRIBUTED_TO")
    return e1.unionByName(e2).unionByName(e3)


# --- all trails between two named nodes ---------------------------------------------------

@register("graph_all_paths", sql="WITH RECURSIVE " + views.ROLES_SQL.strip() + """,
tr(node, nodes, used) AS (
  SELECT dst, [src, dst], [edge_id] FROM ROLES WHERE src = 'system'
  UNION ALL
  SELECT r.dst, list_append(tr.nodes, r.dst), list_append(tr.used, r.edge_id)
  FROM tr JOIN ROLES r ON r.src = tr.node WHERE NOT list_contains(tr.used, r.edge_id))
SELECT array_to_string(nodes, '->') AS path, CAST(len(used) AS INTEGER) AS n_edges FROM tr WHERE node = 'user'""")
def graph_all_paths(spark, sf_dir):
    t = gr.trails(views.roles(spark, sf_dir), F.col("src") == "system")
    return t.filter(F.col("node") == "user").select(F.array_join("nodes", "->").alias("path"), F.size("used").alias("n_edges"))


# --- CSV import ------------------------------------------------------------------------------

def _suppliers_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the supplier table as a header CSV of strings (the import file)."""
    s = Tables(spark, sf_dir).supplier
    rows = s.select(
        F.col("s_name").alias("name"),
        F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")).alias("affiliation"),
        F.when(F.col("s_acctbal") < 0, F.lit("n/a")).otherwise(F.col("s_nationkey").cast("string")).alias("h_index"),
    )
    path = files.scratch_path(spark, "suppliers-csv")
    files.write_csv(rows, path)
    return path


CSV_SQL = """SELECT s_name AS name, 'Nation ' || CAST(s_nationkey AS VARCHAR) AS affiliation,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(s_nationkey AS BIGINT) END AS h_index FROM supplier"""


@register("src_csv_header", sql=CSV_SQL)
def src_csv_header(spark, sf_dir):
    raw = files.read_csv_strings(spark, _suppliers_csv(spark, sf_dir), ["name", "affiliation", "h_index"])
    return raw.select("name", "affiliation", files.to_integer("h_index").alias("h_index"))


@register("graph_import_nodes", sql=f"""SELECT 'Supplier' AS labels, name, affiliation, h_index FROM ({CSV_SQL})
UNION ALL SELECT 'Supplier', name, affiliation, h_index FROM ({CSV_SQL})""")
def graph_import_nodes(spark, sf_dir):
    """Plain CREATE per CSV row, imported twice: duplicates are kept (a
    ``merge`` import would anti-join on the name first)."""
    path = _suppliers_csv(spark, sf_dir)
    raw = files.read_csv_strings(spark, path, ["name", "affiliation", "h_index"])
    nodes = raw.select(F.lit("Supplier").alias("labels"), "name", "affiliation",
                       files.to_integer("h_index").alias("h_index"))
    return nodes.unionByName(nodes)


@register("flt_node_match", sql=views.with_views(
    "SELECT id, name FROM V WHERE label = 'Customer' AND prop = 'BUILDING'", views.V_SQL))
def flt_node_match(spark, sf_dir):
    """``MATCH (n:Customer {segment: 'BUILDING'})``: label membership and a
    property-map lookup."""
    v = views.nodes(spark, sf_dir).select(
        "id", "name", F.array("label").alias("labels"),
        F.create_map(F.lit("name"), F.col("name"), F.lit("segment"), F.col("prop")).alias("properties"))
    return v.filter(F.array_contains("labels", "Customer") & (F.col("properties")["segment"] == "BUILDING")).select("id", "name")
