"""Triple-pattern queries, ontology statistics and class-hierarchy walks over
the derived triple view T (customers/nations/regions as classes, nation
lists as RDF collections, suppliers as individuals)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import triples as tp
from tessera.plans import views
from tessera.plans.registry import register
from tessera.sources.tables import Tables


def opened(spark: SparkSession, sf_dir: str, *patterns: tuple) -> tp.Triples:
    """The triple view for a query with these patterns: each reads the tables of
    its own predicate, predicates that many of them read are stored once."""
    from tessera.sources.files import scratch_path

    return tp.Triples.opened(lambda only: views.triples(spark, sf_dir, only), list(patterns), scratch_path(spark, "triples"))


def W(body: str, recursive: bool = False) -> str:
    """Prefix ``body`` (more CTEs then a SELECT, or just a SELECT) with the
    triple-view CTEs."""
    head = "WITH RECURSIVE " if recursive else "WITH "
    sep = "\n" if body.lstrip().upper().startswith("SELECT") else ",\n"
    return head + views.T_SQL.strip() + sep + body


# --- basic graph patterns, OPTIONAL, UNION, NOT EXISTS ------------------------------

@register("join_bgp_chain", sql=W("""SELECT a.s AS r, a.o AS q, b.o AS l, c.o AS name
FROM T a JOIN T b ON b.s = a.o AND b.p = 'intersectionOf' JOIN T c ON c.s = a.s AND c.p = 'label'
WHERE a.p = 'equivalentClass'"""))
def join_bgp_chain(spark, sf_dir):
    chain = [("?r", "equivalentClass", "?q"), ("?q", "intersectionOf", "?l"), ("?r", "label", "?name")]
    t = opened(spark, sf_dir, *chain).measured({p for _, p, _ in chain})
    return t.bgp(*chain).select("r", "q", "l", "name")


@register("join_bgp_var_predicate", sql=W("""SELECT a.s AS r, b.o AS l, c.p AS about
FROM T a JOIN T b ON b.s = a.o AND b.p = 'intersectionOf' JOIN T c ON c.s = b.o AND c.o = 'Place'
WHERE a.p = 'equivalentClass'"""))
def join_bgp_var_predicate(spark, sf_dir):
    chain = [("?r", "equivalentClass", "?q"), ("?q", "intersectionOf", "?l"), ("?l", "?about", "Place")]
    return opened(spark, sf_dir, *chain).bgp(*chain).select("r", "l", "about")


@register("set_union_bag", sql=W("""SELECT a.s AS x, l.o AS name, a.o AS c
FROM T a JOIN T b ON b.s = a.o AND b.p = 'intersectionOf' JOIN T d ON d.s = b.o AND d.o = 'Place'
     JOIN T l ON l.s = a.s AND l.p = 'label'
WHERE a.p = 'equivalentClass'
UNION ALL
SELECT a.s, l.o, NULL FROM T a JOIN T l ON l.s = a.s AND l.p = 'label' WHERE a.p = 'subClassOf' AND a.o = 'NamedPlace'"""))
def set_union_bag(spark, sf_dir):
    first = [("?x", "equivalentClass", "?c"), ("?c", "intersectionOf", "?i"), ("?i", "?about", "Place"), ("?x", "label", "?name")]
    second = [("?x", "subClassOf", "NamedPlace"), ("?x", "label", "?name")]
    t = opened(spark, sf_dir, *first, *second)
    return tp.union(t.bgp(*first), t.bgp(*second)).select("x", "name", "c")


CLASS_LABELS = [("?class", "type", "Class"), ("?class", "label", "?label")]


@register("set_distinct", sql=W("""SELECT DISTINCT a.s AS class, b.o AS label
FROM T a LEFT JOIN T b ON b.s = a.s AND b.p = 'label' WHERE a.p = 'type' AND a.o = 'Class'"""))
def set_distinct(spark, sf_dir):
    t = opened(spark, sf_dir, *CLASS_LABELS)
    return tp.optional(*[t.pattern(*pt) for pt in CLASS_LABELS]).distinct()


@register("join_optional", sql=W("""SELECT a.s AS class, b.o AS label
FROM T a LEFT JOIN T b ON b.s = a.s AND b.p = 'label' AND b.lang = 'en' WHERE a.p = 'type' AND a.o = 'Class'"""))
def join_optional(spark, sf_dir):
    t = opened(spark, sf_dir, *CLASS_LABELS)
    en = t.pattern("?class", "label", "?label", lang="lg").filter(F.col("lg") == "en").drop("lg")
    return tp.optional(t.pattern("?class", "type", "Class"), en)


@register("join_not_exists", sql=W("""SELECT a.s AS class FROM T a
WHERE a.p = 'type' AND a.o = 'Class' AND NOT EXISTS (SELECT 1 FROM T b WHERE b.s = a.s AND b.p = 'label')"""))
def join_not_exists(spark, sf_dir):
    t = opened(spark, sf_dir, *CLASS_LABELS)
    return tp.not_exists(*[t.pattern(*pt) for pt in CLASS_LABELS])


# --- the two-UNION compatible join and what is built on it ----------------------------

J5_SQL = """reach(start, node) AS (
  SELECT DISTINCT o, o FROM T WHERE p = 'intersectionOf'
  UNION SELECT r.start, t.o FROM reach r JOIN T t ON t.s = r.node AND t.p = 'rest'),
mem AS (SELECT DISTINCT r.start AS i, f.o AS r FROM reach r JOIN T f ON f.s = r.node AND f.p = 'first'),
A AS (SELECT a.s AS x, a.o AS c, b.o AS i, d.p AS about
      FROM T a JOIN T b ON b.s = a.o AND b.p = 'intersectionOf' JOIN T d ON d.s = b.o AND d.o = 'Place'
      WHERE a.p = 'equivalentClass'
      UNION ALL SELECT s, NULL, NULL, NULL FROM T WHERE p = 'subClassOf' AND o = 'NamedPlace'),
B AS (SELECT a.s AS x, a.o AS c, b.o AS i, m.r, sv.o AS t
      FROM T a JOIN T b ON b.s = a.o AND b.p = 'intersectionOf' JOIN mem m ON m.i = b.o
           JOIN T sv ON sv.s = m.r AND sv.p = 'someValuesFrom'
      WHERE a.p = 'equivalentClass'
      UNION ALL SELECT a.s, NULL, NULL, a.o, b.o FROM T a JOIN T b ON b.s = a.o AND b.p = 'someValuesFrom'
      WHERE a.p = 'subClassOf'),
J AS (SELECT A.x, A.about, B.r, B.t, coalesce(A.c, B.c) AS c, coalesce(A.i, B.i) AS i
      FROM A JOIN B ON A.x = B.x AND (A.c = B.c OR A.c IS NULL OR B.c IS NULL) AND (A.i = B.i OR A.i IS NULL OR B.i IS NULL))"""


def compatible(spark: SparkSession, sf_dir: str, with_label: bool = False) -> DataFrame:
    """{A1} UNION {A2} joined with {B1} UNION {B2}; A1/B1 bind c and i, A2/B2 do not."""
    a1 = [("?x", "equivalentClass", "?c"), ("?c", "intersectionOf", "?i"), ("?i", "?about", "Place")]
    a2 = [("?x", "subClassOf", "NamedPlace")]
    if with_label:
        a1.append(("?x", "label", "?name"))
        a2.append(("?x", "label", "?name"))
    b1, part = a1[:2], ("?r", "someValuesFrom", "?t")
    b2 = [("?x", "subClassOf", "?r"), part]
    t = opened(spark, sf_dir, *a1, *a2, *b1, *b2, part, a1[1], ("?n", "rest", "?m"), ("?n", "first", "?r"))
    a = tp.union(t.bgp(*a1), t.bgp(*a2))
    heads = t.pattern(*a1[1]).select("i").distinct()
    members = tp.path_star_then(t.source({"rest", "first"}), heads, "rest", "first", start_col="i", out_col="r")
    b1 = tp.join_all([t.bgp(*b1), members, t.pattern(*part)])
    b2 = t.bgp(*b2)
    return tp.compatible_join(a, tp.union(b1, b2), always_bound=["x"])


@register("join_compatible", sql=W(J5_SQL + "\nSELECT x, about, r, t, c, i FROM J", recursive=True))
def join_compatible(spark, sf_dir):
    return compatible(spark, sf_dir).select("x", "about", "r", "t", "c", "i")


@register("agg_group_count_topk", sql=W(J5_SQL + """
SELECT t, count(x) AS n FROM J GROUP BY t ORDER BY n DESC, t LIMIT 10""", recursive=True))
def agg_group_count_topk(spark, sf_dir):
    j = compatible(spark, sf_dir)
    return j.groupBy("t").agg(F.count("x").alias("n")).orderBy(F.col("n").desc(), F.col("t")).limit(10)


@register("flt_iri_neq", sql=W(J5_SQL + "\nSELECT x, t FROM J WHERE t <> 'n0'", recursive=True))
def flt_iri_neq(spark, sf_dir):
    return compatible(spark, sf_dir).filter(F.col("t") != "n0").select("x", "t")


@register("set_construct", sql=W(J5_SQL + """,
K AS (SELECT * FROM J WHERE t <> 'n0' AND x IN (SELECT s FROM T WHERE p = 'label'))
SELECT DISTINCT x AS s, 'isLocated' AS p, 'true' AS o, 'lit' AS o_kind FROM K
UNION SELECT DISTINCT x, 'inPlace', t, 'iri' FROM K""", recursive=True))
def set_construct(spark, sf_dir):
    j = compatible(spark, sf_dir, with_label=True).filter(F.col("t") != "n0")
    return tp.construct(j, [("?x", "isLocated", ("true", "lit")), ("?x", "inPlace", "?t")])


@register("flt_iri_suffix", sql=W("""A AS (
  SELECT a.s AS x, l.o AS name, l.lang AS lg
  FROM T a JOIN T b ON b.s = a.o AND b.p = 'intersectionOf' JOIN T d ON d.s = b.o AND d.o = 'Place'
       JOIN T l ON l.s = a.s AND l.p = 'label' WHERE a.p = 'equivalentClass'
  UNION ALL SELECT a.s, l.o, l.lang FROM T a JOIN T l ON l.s = a.s AND l.p = 'label'
  WHERE a.p = 'subClassOf' AND a.o = 'NamedPlace')
SELECT A.x, A.name, sv.o AS t
FROM A JOIN T sc ON sc.s = A.x AND sc.p = 'subClassOf' JOIN T sv ON sv.s = sc.o AND sv.p = 'someValuesFrom'
WHERE ends_with(sv.o, '3') AND A.lg = 'en'"""))
def flt_iri_suffix(spark, sf_dir):
    named, label = [("?x", "equivalentClass", "?c"), ("?c", "intersectionOf", "?i"), ("?i", "?about", "Place")], ("?x", "label", "?name")
    place, part = ("?x", "subClassOf", "NamedPlace"), [("?x", "subClassOf", "?r"), ("?r", "someValuesFrom", "?t")]
    t = opened(spark, sf_dir, *named, label, place, label, *part)
    labels = t.pattern(*label, lang="lg")
    a1, a2, parts = t.bgp(*named, labels), t.bgp(place, labels), t.bgp(*part)
    j = tp.join_all([tp.union(a1, a2), parts])
    return j.filter(F.col("t").endswith("3") & (F.col("lg") == "en")).select("x", "name", "t")


@register("flt_lang_tag", sql=W("SELECT s AS x, o AS name FROM T WHERE p = 'label' AND lang = 'en'"))
def flt_lang_tag(spark, sf_dir):
    t = opened(spark, sf_dir, ("?x", "label", "?name"))
    return t.pattern("?x", "label", "?name", lang="lg").filter(F.col("lg") == "en").select("x", "name")


@register("flt_contains_lcase", sql="SELECT doc_id FROM documents WHERE contains(lower(text), 'ment')")
def flt_contains_lcase(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.filter(F.contains(F.lower("text"), F.lit("ment"))).select("doc_id")


# --- ontology statistics -----------------------------------------------------------------

@register("agg_count_distinct_by_type", sql=W("""SELECT count(DISTINCT CASE WHEN o = 'Class' THEN s END) AS classes,
       count(DISTINCT CASE WHEN o = 'ObjectProperty' THEN s END) AS properties,
       count(DISTINCT CASE WHEN o = 'NamedIndividual' THEN s END) AS individuals
FROM T WHERE p = 'type'"""))
def agg_count_distinct_by_type(spark, sf_dir):
    t = views.triples(spark, sf_dir).filter(F.col("p") == "type").select("s", "o")
    each = t.repartition("s", "o").distinct()  # dealt out first, as in graph_stats
    return each.agg(*[F.count(F.when(F.col("o") == o, F.col("s"))).alias(n)
                      for o, n in (("Class", "classes"), ("ObjectProperty", "properties"), ("NamedIndividual", "individuals"))])


@register("agg_union_distinct_counts", sql=W("""U AS (
  SELECT s AS class, NULL AS prop, NULL AS ind FROM T WHERE p = 'type' AND o = 'Class'
  UNION ALL SELECT NULL, s, NULL FROM T WHERE p = 'type' AND o = 'ObjectProperty'
  UNION ALL SELECT NULL, NULL, s FROM T WHERE p = 'type' AND o = 'NamedIndividual')
SELECT count(DISTINCT class) AS classes, count(DISTINCT prop) AS properties, count(DISTINCT ind) AS individuals FROM U"""))
def agg_union_distinct_counts(spark, sf_dir):
    each = [("?class", "type", "Class"), ("?prop", "type", "ObjectProperty"), ("?ind", "type", "NamedIndividual")]
    t = opened(spark, sf_dir, *each)
    u = tp.union(*[t.pattern(*pt) for pt in each])
    each = u.repartition("class", "prop", "ind").distinct()  # a row binds one of the three; dealt out first, as in graph_stats
    return each.agg(F.count("class").alias("classes"), F.count("prop").alias("properties"), F.count("ind").alias("individuals"))


STATS_SQL = """SELECT count(DISTINCT CASE WHEN (p = 'type' AND o = 'Class') OR p = 'subClassOf' THEN s END) AS classes,
       count(DISTINCT CASE WHEN p = 'type' AND o = 'ObjectProperty' THEN s END) AS properties,
       count(DISTINCT CASE WHEN p = 'type' AND o = 'NamedIndividual' THEN s END) AS individuals,
       (SELECT count(*) FROM (SELECT DISTINCT s, p, o, o_kind, lang FROM {src})) AS triples
FROM {src}"""


@register("agg_graph_stats", sql=W(STATS_SQL.format(src="T")))
def agg_graph_stats(spark, sf_dir):
    return tp.graph_stats(views.triples(spark, sf_dir))


@register("agg_graph_compare", sql=W("""G AS (SELECT 'original' AS graph, * FROM T WHERE lang <> 'pt'
                 UNION ALL SELECT 'modified', * FROM T)
SELECT graph,
       count(DISTINCT CASE WHEN (p = 'type' AND o = 'Class') OR p = 'subClassOf' THEN s END) AS classes,
       count(DISTINCT CASE WHEN p = 'type' AND o = 'ObjectProperty' THEN s END) AS properties,
       count(DISTINCT CASE WHEN p = 'type' AND o = 'NamedIndividual' THEN s END) AS individuals,
       count(DISTINCT (s, p, o, o_kind, lang)) AS triples
FROM G GROUP BY graph"""))
def agg_graph_compare(spark, sf_dir):
    t = views.triples(spark, sf_dir)
    g = t.filter(F.col("lang") != "pt").withColumn("graph", F.lit("original")).unionByName(
        t.withColumn("graph", F.lit("modified")))
    return tp.graph_stats(g, ["graph"])


# --- paths and hierarchy ---------------------------------------------------------------------

@register("graph_list_members", sql=W("""reach(start, node) AS (
  SELECT DISTINCT o, o FROM T WHERE p = 'intersectionOf'
  UNION SELECT r.start, t.o FROM reach r JOIN T t ON t.s = r.node AND t.p = 'rest')
SELECT DISTINCT r.start AS head, f.o AS member FROM reach r JOIN T f ON f.s = r.node AND f.p = 'first'""",
                                      recursive=True))
def graph_list_members(spark, sf_dir):
    t = opened(spark, sf_dir, ("?c", "intersectionOf", "?head"), ("?n", "rest", "?m"), ("?n", "first", "?r"))
    heads = t.pattern("?c", "intersectionOf", "?head").select("head").distinct()
    return tp.path_star_then(t.source({"rest", "first"}), heads, "rest", "first", start_col="head", out_col="member")


HIER_SQL = """cls AS (SELECT DISTINCT s FROM T WHERE (p = 'type' AND o = 'Class') OR p = 'subClassOf'),
sub AS (SELECT DISTINCT s AS child, o AS parent FROM T WHERE p = 'subClassOf' AND o IN (SELECT s FROM cls)),
roots AS (SELECT s AS root FROM cls WHERE s NOT IN (SELECT child FROM sub))"""


def hierarchy(spark: SparkSession, sf_dir: str, again: bool = False) -> tuple[DataFrame, DataFrame]:
    """(roots, sub): classes without a named superclass, and the subclass
    edges between declared classes.  With ``again`` both will be read repeatedly,
    and the triples of the two predicates are stored."""
    from tessera.sources.files import stored

    t = views.triples(spark, sf_dir, {"type", "subClassOf"})
    t = stored(t, "hierarchy") if again else t
    is_class = ((F.col("p") == "type") & (F.col("o") == "Class")) | (F.col("p") == "subClassOf")
    cls = t.filter(is_class).select("s").distinct()
    sub = (
        t.filter(F.col("p") == "subClassOf")
        .select(F.col("s").alias("child"), F.col("o").alias("parent"))
        .join(cls.select(F.col("s").alias("parent")), "parent", "left_semi")
        .distinct()
    )
    roots = cls.join(sub.select(F.col("child").alias("s")), "s", "left_anti").select(F.col("s").alias("root"))
    return roots, sub


@register("graph_roots", sql=W(HIER_SQL + "\nSELECT root FROM roots"))
def graph_roots(spark, sf_dir):
    return hierarchy(spark, sf_dir)[0]


@register("graph_depth", sql=W(HIER_SQL + """,
walk(root, node, depth) AS (SELECT root, root, 1 FROM roots
  UNION SELECT w.root, sub.child, w.depth + 1 FROM walk w JOIN sub ON sub.parent = w.node)
SELECT root, max(depth) AS depth FROM walk GROUP BY root""", recursive=True))
def graph_depth(spark, sf_dir):
    return tp.depths(*hierarchy(spark, sf_dir, again=True))


@register("graph_closure_filter", sql=W("""sub AS (SELECT s AS child, o AS parent FROM T WHERE p = 'subClassOf'),
clos(c) AS (SELECT 'r0' UNION SELECT sub.child FROM clos JOIN sub ON sub.parent = clos.c),
parts AS (SELECT a.s AS x, b.o AS t FROM T a JOIN T b ON b.s = a.o WHERE a.p = 'subClassOf' AND b.p = 'someValuesFrom')
SELECT DISTINCT x FROM parts p
WHERE NOT EXISTS (SELECT 1 FROM parts q JOIN clos ON clos.c = q.t WHERE q.x = p.x)""", recursive=True))
def graph_closure_filter(spark, sf_dir):
    """Things none of whose parts is the excluded class or any subclass of it."""
    t = opened(spark, sf_dir, ("?c", "subClassOf", "?d"), ("?x", "subClassOf", "?r"), ("?r", "someValuesFrom", "?t"))
    excluded = tp.subclass_closure(t.source({"subClassOf"}), spark.createDataFrame([("r0",)], "root string")).select(F.col("cls").alias("t"))
    parts = t.bgp(("?x", "subClassOf", "?r"), ("?r", "someValuesFrom", "?t")).select("x", "t")
    bad = parts.join(excluded, "t", "left_semi").select("x")
    return parts.select("x").distinct().join(bad, "x", "left_anti")


# --- scoring of generated queries ----------------------------------------------------------

from tessera.operators import querygen as qg  # noqa: E402


def generated_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated query text per part: four forms (select/construct/ask/
    other) naming nation, region or customer classes, some of which exist."""
    p = Tables(spark, sf_dir).part
    k30 = (F.col("p_partkey") % 30).cast("string")
    k7 = (F.col("p_partkey") % 7).cast("string")
    form = F.col("p_size") % 4
    q = (F.when(form == 0, F.concat(F.lit("SELECT ?x WHERE { ?x a x:n"), k30, F.lit(" }")))
         .when(form == 1, F.concat(F.lit("  construct { ?x a x:r"), k7, F.lit(" } where { ?x a x:r"), k7, F.lit(" }")))
         .when(form == 2, F.concat(F.lit("ASK { ?x a x:c"), F.col("p_partkey").cast("string"), F.lit(" }")))
         .otherwise(F.concat(F.lit("FIND "), F.col("p_name"))))
    return p.select("p_partkey", q.alias("q"))


GQ_SQL = """gq AS (SELECT p_partkey, CASE p_size % 4
    WHEN 0 THEN 'SELECT ?x WHERE { ?x a x:n' || CAST(p_partkey % 30 AS VARCHAR) || ' }'
    WHEN 1 THEN '  construct { ?x a x:r' || CAST(p_partkey % 7 AS VARCHAR) || ' } where { ?x a x:r' || CAST(p_partkey % 7 AS VARCHAR) || ' }'
    WHEN 2 THEN 'ASK { ?x a x:c' || CAST(p_partkey AS VARCHAR) || ' }'
    ELSE 'FIND ' || p_name END AS q FROM part)"""

_STARTS = " OR ".join(f"starts_with(upper(regexp_replace(q, '^\\s+|\\s+$', '', 'g')), '{f}')" for f in qg.QUERY_FORMS)


@register("val_query_form", sql=f"""WITH {GQ_SQL}
SELECT p_partkey, ({_STARTS}) AND contains(upper(q), 'WHERE') AS valid,
  CASE WHEN NOT ({_STARTS}) THEN '{qg.MSG_BAD_START}' WHEN NOT contains(upper(q), 'WHERE') THEN '{qg.MSG_NO_WHERE}'
       ELSE '{qg.MSG_SYNTAX_OK}' END AS message FROM gq""")
def val_query_form(spark, sf_dir):
    g = generated_queries(spark, sf_dir)
    ok, msg = qg.validate_form(F.col("q"))
    return g.select("p_partkey", ok.alias("valid"), msg.alias("message"))


@register("val_ontology_terms", sql=W(GQ_SQL + f""",
cls AS (SELECT DISTINCT s FROM T WHERE p = 'type' AND o = 'Class'),
refs AS (SELECT p_partkey, unnest(regexp_extract_all(q, 'x:(\\w+)', 1)) AS c FROM gq),
miss AS (SELECT p_partkey, count(*) AS n FROM refs WHERE c NOT IN (SELECT s FROM cls) GROUP BY p_partkey)
SELECT gq.p_partkey, contains(q, 'x:') AND coalesce(miss.n, 0) = 0 AS valid,
  CASE WHEN NOT contains(q, 'x:') THEN '{qg.MSG_NO_PREFIX}' WHEN coalesce(miss.n, 0) = 0 THEN '{qg.MSG_TERMS_OK}'
       ELSE '{qg.MSG_TERMS_BAD}' END AS message
FROM gq LEFT JOIN miss ON miss.p_partkey = gq.p_partkey"""))
def val_ontology_terms(spark, sf_dir):
    classes = opened(spark, sf_dir, ("?cls", "type", "Class")).pattern("?cls", "type", "Class").distinct()
    return qg.ontology_terms(generated_queries(spark, sf_dir), "p_partkey", "q", classes, "x")


PATTERNS = ["the", "und", "que"]
_PAT_SQL = "[" + ", ".join(f"'{p}'" for p in PATTERNS) + "]"
SCORE_SQL = f"""sc AS (SELECT doc_id, len(list_filter({_PAT_SQL}, lambda x: contains(text, x))) / {float(len(PATTERNS))} AS ps,
  least(1.0, (length(text) - length(replace(text, '.', ''))) / 3.0) AS rs FROM documents)"""


@register("flt_expected_pattern_score", sql=f"WITH {SCORE_SQL} SELECT doc_id, round(ps, 6) AS pattern_score FROM sc")
def flt_expected_pattern_score(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", F.round(qg.pattern_score(F.col("text"), PATTERNS), 6).alias("pattern_score"))


@register("agg_result_score", sql=f"""WITH {SCORE_SQL}
SELECT doc_id, round(ps, 6) AS pattern_score, round(rs, 6) AS result_score, round(ps * 0.6 + rs * 0.4, 6) AS total_score,
  CASE WHEN ps * 0.6 + rs * 0.4 >= 0.7 THEN 'PASS' ELSE 'FAIL' END AS status FROM sc""")
def agg_result_score(spark, sf_dir):
    """min(1, found / min_results) with found = sentences ('.') in the text,
    total = 0.6 pattern + 0.4 result, PASS from 0.7."""
    d = Tables(spark, sf_dir).documents
    ps = qg.pattern_score(F.col("text"), PATTERNS)
    found = F.char_length("text") - F.char_length(F.replace(F.col("text"), F.lit("."), F.lit("")))
    rs = qg.result_score(found, 3)
    total, status = qg.total_score(ps, rs)
    return d.select("doc_id", F.round(ps, 6).alias("pattern_score"), F.round(rs, 6).alias("result_score"),
                    F.round(total, 6).alias("total_score"), status.alias("status"))


@register("set_union_distinct", sql=W("""SELECT s FROM T WHERE p = 'type' AND o = 'Class' UNION SELECT s FROM T WHERE p = 'subClassOf'"""))
def set_union_distinct(spark, sf_dir):
    """Declared classes: subjects typed Class ∪ subjects of subClassOf, as a set."""
    t = opened(spark, sf_dir, ("?s", "type", "Class"), ("?s", "subClassOf", "?o"))
    return t.pattern("?s", "type", "Class").union(t.pattern("?s", "subClassOf", "?o").select("s")).distinct()
