"""Property-graph operations on a node frame ``(id, label, name, ...)`` and an
edge frame ``(edge_id, src, type, dst)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.fixpoint import cut, expand


def edge_endpoints(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``MATCH (a)-[r]->(b) RETURN a.name, type(r), b.name``."""
    a = nodes.select(F.col("id").alias("src"), F.col("name").alias("source"))
    b = nodes.select(F.col("id").alias("dst"), F.col("name").alias("target"))
    return edges.join(a, "src").join(b, "dst").select("source", F.col("type").alias("relationship"), "target")


def degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Undirected degree: distinct relationships touching each node (a
    self-loop counts once); isolated nodes get 0.  The count is a two-level
    aggregation (node, edge) -> node, so a hub node is combined map-side."""
    ends = edges.select("edge_id", F.explode(F.array("src", "dst")).alias("id"))
    per = ends.groupBy("id").agg(F.count_distinct("edge_id").alias("degree"))
    return nodes.join(per, "id", "left").select(
        "id", "name", F.coalesce(F.col("degree"), F.lit(0)).alias("degree"), F.col("label").alias("type")
    )


def match_one(nodes: DataFrame, cond: Column) -> Column:
    """The id of the single node matching ``cond``, as a scalar subquery
    (fails at run time if more than one node matches)."""
    return nodes.filter(cond).select("id").scalar()


def connect(sources: DataFrame, target_id: Column, rel_type: str) -> DataFrame:
    """``CREATE (r)-[:TYPE]->(d)`` for every carried row ``r`` and the single
    matched node ``d``."""
    return sources.select(F.col("id").alias("src"), F.lit(rel_type).alias("type"), target_id.alias("dst")).filter(
        F.col("dst").isNotNull())


def trails(edges: DataFrame, start: Column, max_edges: int | None = None) -> DataFrame:
    """Every directed walk from the start nodes that uses no relationship
    twice (nodes may repeat): rows ``(start, node, nodes, used)``.  The walk
    ends because each step consumes an unused edge; ``max_edges``, if given, asks
    for walks of at most that many edges."""
    e = cut(edges.select("edge_id", "src", "dst"))
    seed = e.filter(start).select(
        F.col("src").alias("start"), F.col("dst").alias("node"),
        F.array("src", "dst").alias("nodes"), F.array("edge_id").alias("used"),
    )

    def step(front: DataFrame) -> DataFrame:
        j = front.join(e, front.node == e.src).filter(~F.array_contains("used", F.col("edge_id")))
        return j.select("start", F.col("dst").alias("node"), F.concat("nodes", F.array("dst")).alias("nodes"),
                        F.concat("used", F.array("edge_id")).alias("used"))

    return expand(seed, step, None if max_edges is None else max_edges - 1)


def import_nodes(existing: DataFrame, incoming: DataFrame, key: str, mode: str = "create") -> DataFrame:
    """Node import: ``create`` appends every incoming row (re-importing
    duplicates, like a plain CREATE); ``merge`` appends only rows whose key is
    not present yet (an anti join, so re-importing changes nothing)."""
    if mode == "create":
        return existing.unionByName(incoming, allowMissingColumns=True)
    if mode == "merge":
        fresh = incoming.dropDuplicates([key]).join(existing.select(key), key, "left_anti")
        return existing.unionByName(fresh, allowMissingColumns=True)
    raise ValueError(mode)
