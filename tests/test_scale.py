"""Work and memory of a task that stay bounded as the tables grow; each test
builds its own rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tessera.sources import files


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_ttl_cache_keys_share_states(spark):
    """1,500 keys in 16 states, two micro-batches; times and ids may be missing."""
    from tessera.streaming import requests as st

    rng = random.Random(1)
    rows = [(i, rng.randrange(500), rng.choice(["a", "b", None]), 1_700_000_000 + rng.randrange(4_000)) for i in range(6_000)]
    rows += [(None, 1, "a", 1_700_000_500), (9_000, 2, "b", None), (9_001, None, "b", 1_700_000_100), (9_002, None, "b", 1_700_000_200)]
    rows.sort(key=lambda r: r[3] or 0)
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, at long").select(
        "event_id", F.timestamp_seconds("at").alias("ts"), "user_id", "event_type")
    base = files.scratch_path(spark, "ttl-states")
    late = F.col("ts") >= F.timestamp_seconds(F.lit(1_700_002_000))
    df.filter(~F.coalesce(late, F.lit(False))).coalesce(1).write.parquet(base + "/in/a")
    df.filter(late).coalesce(1).write.parquet(base + "/in/b")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(base + "/in/*")
    cache = st.ttl_cache(stream, ["user_id", "event_type"], 300, buckets=16)
    q = cache.writeStream.format("parquet").option("checkpointLocation", base + "/ck").trigger(availableNow=True).start(base + "/data")
    q.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) <= 16
    misses, want = {}, {}
    for e, u, t, at in sorted(rows, key=lambda r: (r[3] or 0, r[0] is None, r[0] or 0)):
        want[e] = at is not None and (u, t) in misses and at - misses[u, t] < 300
        if not want[e] and at is not None:
            misses[u, t] = at
    got = spark.read.parquet(base + "/data").collect()
    assert len(got) == len(rows) and {r.event_id: r.hit for r in got} == want


def test_rdfxml_documents_are_bounded(spark, monkeypatch):
    from tessera.sources import rdf

    triples = spark.createDataFrame([(f"s{i}", "label", f"line\n{i} & <x> " + "y" * (i % 7), "lit", "en") for i in range(205)],
                                    "s string, p string, o string, o_kind string, lang string").coalesce(1)
    monkeypatch.setattr(rdf, "LINES_AT_ONCE", 5)
    for lines, size, least in ((50, 1 << 20, 5), (50, 2_000, 9)):
        monkeypatch.setattr(rdf, "DOCUMENT_LINES", lines)
        monkeypatch.setattr(rdf, "DOCUMENT_BYTES", size)
        path = files.scratch_path(spark, "documents") + ".rdf"
        rdf.write_rdfxml(triples, path)
        written = spark.read.text(path, wholetext=True).collect()
        assert len(written) >= least
        assert all(r.value.count("\n") <= lines and r.value.startswith("<rdf:RDF") and r.value.endswith("</rdf:RDF>\n") for r in written)
        back = rdf.read_triples(spark, path).drop("dtype")
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, triples.collect()))


def test_collection_ids_stay_in_few_folders_and_off_the_driver(spark):
    from tessera.sources.collection import MERGE_AT, Collection

    c = Collection(spark, files.scratch_path(spark, "merged"), buckets=4)
    for b in range(6):
        c.add(spark.range(b * 50, b * 50 + 100).withColumn("content", F.lit(b)), epoch=f"e/{b}")
        assert len(c.places()) < MERGE_AT
    written = len(c.commits())
    c.add(spark.range(0, 300).withColumn("content", F.lit(9)), epoch="again/0")  # nothing new: no ids
    c.add(spark.range(400, 500).withColumn("content", F.lit(9)), epoch="again/0")  # which tells that the epoch is done
    assert written == 6 and len(c.commits()) == 7
    assert {r.id: r.content for r in c.frame().collect()} == {i: max(0, i // 50 - 1) for i in range(350)}
    assert c.known_ids([0, 1, 2, 3]).count() == 350


def test_collection_adds_do_not_broadcast_the_known_ids(spark, monkeypatch):
    from tessera.sources import collection as m

    plans = []
    stored = m.stored
    monkeypatch.setattr(m, "stored", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or stored(df, name))
    c = m.Collection(spark, files.scratch_path(spark, "joined"), buckets=4)
    c.add(spark.range(100))
    c.add(spark.range(50, 150))
    assert "SortMergeJoin" in plans[-1] and "Broadcast" not in plans[-1] and c.count() == 150


def test_graph_stats_deal_the_triples_out_first(spark):
    from tessera.operators.triples import graph_stats

    rows = [("a", "type", "Class", "iri", ""), ("a", "type", "Class", "iri", ""), ("a", "subClassOf", "b", "iri", ""), ("b", "subClassOf", None, "iri", ""),
            ("p", "type", "ObjectProperty", "iri", ""), ("i", "type", "NamedIndividual", "iri", ""), ("a", "type", "NamedIndividual", "iri", ""),
            (None, "type", "Class", "iri", ""), ("a", "label", "x", "lit", "en"), ("a", "label", "x", "lit", "pt"), ("a", None, "x", "lit", None)]
    t = spark.createDataFrame(rows, "s string, p string, o string, o_kind string, lang string")
    assert [tuple(r) for r in graph_stats(t).collect()] == [(2, 1, 2, 7)]
    assert [tuple(r) for r in graph_stats(t.limit(0)).collect()] == [(0, 0, 0, 0)]
    plan = _plan(graph_stats(t))
    assert "Expand" not in plan and "REPARTITION_BY_COL" in plan


def test_graphs_are_compared_by_the_same_step(spark, sf_dir):
    import __spark_entry__ as se
    from tessera.operators.triples import graph_stats

    for key in ("agg_graph_compare", "agg_count_distinct_by_type", "agg_union_distinct_counts"):
        plan = _plan(se.queries()[key](spark, sf_dir))
        assert "Expand" not in plan and "REPARTITION_BY_COL" in plan
    rows = [("one", "a", "type", "Class", "iri", ""), ("two", "a", "type", "Class", "iri", ""), ("two", "a", "subClassOf", "b", "iri", ""),
            (None, "c", "subClassOf", "b", "iri", "")]
    t = spark.createDataFrame(rows, "graph string, s string, p string, o string, o_kind string, lang string")
    got = {r.graph: tuple(r)[1:] for r in graph_stats(t, ["graph"]).collect()}
    assert got == {"one": (1, 0, 0, 1), "two": (1, 0, 0, 2), None: (1, 0, 0, 1)}


def test_routed_queries_leave_in_bounded_batches():
    import numpy as np
    import pyarrow as pa

    from tessera.operators import knn as m

    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4))
    centres = x[:200]
    far = {"rows": np.ones(200), "near": np.zeros(200), "far": np.full(200, 9.0)}
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(x.tolist()), pa.array(np.zeros(300, np.int32)), pa.array([None] * 300, pa.float64())],
                                       names=["qid", "vec", "cell", "floor"])
    out = list(m._router(centres, far, "l2", ["qid", "vec"])(iter([batch])))  # no bound: all to every other cell
    assert sum(b.num_rows for b in out) == 300 * 199 and max(b.num_rows for b in out) <= m.ROUTED_ROWS
    assert {(q, c) for b in out for q, c in zip(b["qid"].to_pylist(), b["cell"].to_pylist())} == {(q, c) for q in range(300) for c in range(1, 200)}
    out = list(m._border_router(m.integer_units(centres), np.inf, ["vec"])(iter([batch])))
    assert sum(b.num_rows for b in out) == 300 * 200 and max(b.num_rows for b in out) <= m.ROUTED_ROWS
    for columns in (1, 4096, 10**6):
        assert m._rows_at_once(columns) * columns <= max(m.MATRIX_CELLS, 16 * columns)


def test_lexical_index_rows_are_small(spark):
    from tessera.llm import lexical_search

    texts = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(200))) for i in range(20)], "doc_id long, text string")
    index = lexical_search.build(texts)
    sizes = index.docs.selectExpr("octet_length(sketch) AS s", "octet_length(terms) AS t").collect()
    assert all(r.s < 2_000 for r in sizes)  # 4,096 cells
    items = spark.createDataFrame([(1, "w3x7 w3x9 w4x1")], "item_id long, text string")
    assert [r.doc_id for r in lexical_search.search(index, items).orderBy("rank").collect()] == [3, 4]


def test_lexical_index_of_a_task_that_ends_on_a_flush(spark):
    from tessera.llm import lexical_search

    # one slice of texts has more terms than a task holds: no counts are left at its end
    texts = spark.range(0, 200, 1, 1).selectExpr("id AS doc_id", "concat_ws(' ', 'all', transform(sequence(1, 1000), j -> concat('w', id, 'x', j))) AS text")
    index = lexical_search.build(texts)
    assert (index.n_docs, index.n_terms) == (200, 200_200)
    assert 200_001 > lexical_search.FLUSH and index.df.count() == 200_001
    assert [tuple(r) for r in index.df.filter("term = 'all'").selectExpr("CAST(term AS string)", "df").collect()] == [("all", 200)]
