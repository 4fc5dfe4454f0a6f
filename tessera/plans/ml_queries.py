"""Classification metrics, dataset splits, Spark ML training/scoring and
experiment-run tables.

Fixtures: ``labels.quality`` is the truth and ``labels.toxic`` the prediction
of the metric queries; ``embeddings`` (64-dim, ``label`` 0..9) and
``documents`` x ``labels`` are the training sets; ``events`` is the run log
(run = user_id, metric = event_type, value, step = ts)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import classify as cl
from tessera.plans.registry import register
from tessera.sources import files
from tessera.sources.runs import RunLog, best_run, run_table, run_trees
from tessera.sources.tables import Tables


@register("agg_accuracy", sql="SELECT round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM labels")
def agg_accuracy(spark, sf_dir):
    return cl.accuracy(Tables(spark, sf_dir).labels, "quality", "toxic").select(F.round("accuracy", 6).alias("accuracy"))


def _wprf_sql(src: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    on = f"sup.{group} = pred.{group} AND " if group else ""
    gsel = f"coalesce(sup.{group}, pred.{group}) AS {group}, " if group else ""
    tpon = f"tp.{group} = coalesce(sup.{group}, pred.{group}) AND " if group else ""
    return f"""conf AS (SELECT {g}y, p, count(*) AS n FROM {src} GROUP BY ALL),
sup AS (SELECT {g}y AS c, sum(n) AS sup FROM conf GROUP BY ALL),
pred AS (SELECT {g}p AS c, sum(n) AS pred FROM conf GROUP BY ALL),
tp AS (SELECT {g}y AS c, sum(n) AS tp FROM conf WHERE y = p GROUP BY ALL),
per AS (SELECT {gsel}coalesce(sup.sup, 0) AS sup, coalesce(pred.pred, 0) AS pred, coalesce(tp.tp, 0) AS tp
        FROM sup FULL JOIN pred ON {on}sup.c = pred.c
        LEFT JOIN tp ON {tpon}tp.c = coalesce(sup.c, pred.c)),
m AS (SELECT {g}sup, CASE WHEN pred = 0 THEN 0.0 ELSE tp / pred END AS pc, CASE WHEN sup = 0 THEN 0.0 ELSE tp / sup END AS rc FROM per),
m2 AS (SELECT *, CASE WHEN pc + rc = 0 THEN 0.0 ELSE 2 * pc * rc / (pc + rc) END AS fc FROM m),
w AS (SELECT {g}sum(sup * pc) / sum(sup) AS precision, sum(sup * rc) / sum(sup) AS recall, sum(sup * fc) / sum(sup) AS f1
      FROM m2 {gb})"""


@register("agg_weighted_prf", sql="WITH " + _wprf_sql("(SELECT quality AS y, toxic AS p FROM labels)")
          + " SELECT round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM w")
def agg_weighted_prf(spark, sf_dir):
    w = cl.weighted_prf(Tables(spark, sf_dir).labels, "quality", "toxic")
    return w.select(*[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@register("agg_num_labels", sql="SELECT count(DISTINCT label) AS n_labels FROM embeddings")
def agg_num_labels(spark, sf_dir):
    return Tables(spark, sf_dir).embeddings.agg(F.count_distinct("label").alias("n_labels"))


SPLIT10 = "CASE doc_id % 10 WHEN 8 THEN 'validation' WHEN 9 THEN 'test' ELSE 'train' END"


def _split10(col: str = "doc_id"):
    m = F.col(col) % 10
    return F.when(m == 8, "validation").when(m == 9, "test").otherwise("train")


@register("ml_eval_per_split", sql=f"""WITH src AS (SELECT {SPLIT10} AS split, quality AS y, toxic AS p FROM labels),
acc AS (SELECT split, avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) AS accuracy FROM src GROUP BY split),
{_wprf_sql('src', 'split')}
SELECT acc.split, round(accuracy, 6) AS accuracy, round(w.f1, 6) AS f1 FROM acc JOIN w USING (split)""")
def ml_eval_per_split(spark, sf_dir):
    lb = Tables(spark, sf_dir).labels.withColumn("split", _split10())
    acc = cl.accuracy(lb, "quality", "toxic", ["split"])
    w = cl.weighted_prf(lb, "quality", "toxic", ["split"])
    return acc.join(w, "split").select("split", F.round("accuracy", 6).alias("accuracy"), F.round("f1", 6).alias("f1"))


@register("src_split_dataset", sql="""SELECT d.doc_id, CASE WHEN d.doc_id % 100 < 80 THEN 'train'
  WHEN d.doc_id % 100 < 90 THEN 'validation' ELSE 'test' END AS split, l.quality AS label, d.n_chars
FROM documents d JOIN labels l ON l.doc_id = d.doc_id""")
def src_split_dataset(spark, sf_dir):
    """A labelled text set with named splits; the split is a pure function of
    the id, so it is fixed at ingest and ``filter(split = ...)`` prunes."""
    t = Tables(spark, sf_dir)
    b = F.col("doc_id") % 100
    split = F.when(b < 80, "train").when(b < 90, "validation").otherwise("test")
    return t.documents.join(t.labels, "doc_id").select("doc_id", split.alias("split"), F.col("quality").alias("label"),
                                                       "n_chars")


@register("ml_split", sql="SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM embeddings")
def ml_split(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    return e.select("vec_id", F.when(F.col("vec_id") % 5 == 0, "test").otherwise("train").alias("split"))


SCORES_SQL = "s AS (SELECT vec_id, [" + ", ".join(
    f"list_sum([CAST(embedding[i] AS DOUBLE) for i in range(1, len(embedding) + 1) if i % 6 = {(j + 1) % 6}])" for j in range(6)
) + """] AS l FROM embeddings),
pr AS (SELECT vec_id, l, list_transform(l, lambda x: exp(x - list_max(l))) AS ex FROM s),
sm AS (SELECT vec_id, l, list_transform(ex, lambda v: v / list_sum(ex)) AS p FROM pr)"""


def six_scores(vec: str):
    """One score for each of the six labels from the whole vector: the sum of every sixth component."""
    v = F.transform(vec, lambda x: x.cast("double"))
    part = lambda j: F.aggregate(F.filter(v, lambda x, i: i % 6 == j), F.lit(0.0), lambda a, x: a + x)
    return F.array(*[part(j) for j in range(6)])


@register("ml_predict_confidence", sql=f"""WITH {SCORES_SQL}
SELECT vec_id, {'[' + ', '.join(repr(n) for n in cl.LABEL_NAMES) + ']'}[list_position(l, list_max(l))] AS emotion,
       round(p[list_position(l, list_max(l))], 6) AS confidence FROM sm""")
def ml_predict_confidence(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings.select("vec_id", six_scores("embedding").alias("l"))
    p = e.select("vec_id", "l", cl.softmax("l").alias("p"))
    i = cl.argmax_first("l")
    return p.select("vec_id", cl.label_name(i).alias("emotion"), F.round(F.element_at("p", i + 1), 6).alias("confidence"))


@register("ml_softmax", sql=f"WITH {SCORES_SQL} SELECT vec_id, "
          + ", ".join(f"round(p[{i + 1}], 6) AS p{i}" for i in range(6)) + " FROM sm")
def ml_softmax(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings.select("vec_id", cl.softmax(six_scores("embedding")).alias("p"))
    return e.select("vec_id", *[F.round(F.element_at("p", i + 1), 6).alias(f"p{i}") for i in range(6)])


# --- run tables -------------------------------------------------------------------------

def _metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    return ev.select(F.col("user_id").alias("run_id"), F.col("event_type").alias("key"), "value",
                     F.unix_micros(F.col("ts").cast("timestamp")).alias("step"), "event_id")


RUNS_SQL = """runs AS (SELECT user_id AS run_id, event_type AS key, arg_max(value, (ts, event_id)) AS value
  FROM events GROUP BY user_id, event_type)"""


@register("src_runs_search", sql=f"""WITH {RUNS_SQL} SELECT run_id, 'metric' AS kind, key, value FROM runs
UNION ALL SELECT user_id, 'param', 'n_events', CAST(count(*) AS DOUBLE) FROM events GROUP BY user_id""")
def src_runs_search(spark, sf_dir):
    """Every run with its last metrics and its parameters as maps, whatever
    their names, listed as one row for each entry."""
    m = _metric_log(spark, sf_dir)
    params = m.groupBy("run_id").agg(F.count(F.lit(1)).cast("string").alias("value")).withColumn("key", F.lit("n_events"))
    runs = run_table(m, params, F.struct("step", "event_id"))
    entries = lambda kind, col: runs.select("run_id", F.lit(kind).alias("kind"), F.explode(col).alias("key", "value"))
    return entries("metric", "metrics").unionByName(
        entries("param", "params").withColumn("value", F.col("value").cast("double")))


@register("agg_best_run", sql=f"""WITH {RUNS_SQL}
SELECT run_id, max(value) FILTER (WHERE key = 'error') AS eval_loss FROM runs GROUP BY run_id
ORDER BY coalesce(eval_loss, 'inf'::DOUBLE), run_id LIMIT 1""")
def agg_best_run(spark, sf_dir):
    runs = run_table(_metric_log(spark, sf_dir), None, F.struct("step", "event_id"))
    return best_run(runs.select("run_id", F.try_element_at("metrics", F.lit("error")).alias("eval_loss")), "eval_loss")


@register("snk_run_log", sql="""WITH RECURSIVE runs AS (
  SELECT DISTINCT user_id AS run_id, CASE WHEN user_id >= 10 THEN user_id // 10 END AS parent FROM events),
up AS (SELECT run_id, run_id AS root, parent FROM runs
  UNION ALL SELECT up.run_id, up.parent, runs.parent FROM up LEFT JOIN runs ON runs.run_id = up.parent WHERE up.parent IS NOT NULL),
tree AS (SELECT root, run_id FROM up WHERE parent IS NULL),
log AS (SELECT DISTINCT user_id, 'types.txt' AS path, string_agg(DISTINCT event_type, chr(10) ORDER BY event_type) AS content FROM events GROUP BY user_id)
SELECT 'metric' AS kind, user_id AS run_id, event_type AS key, value, epoch_us(ts) AS step FROM events
UNION ALL SELECT 'param', user_id, 'n_events', CAST(count(*) AS DOUBLE), NULL FROM events GROUP BY user_id
UNION ALL SELECT 'artifact', user_id, path || ':' || md5(content), CAST(strlen(content) AS DOUBLE), NULL FROM log
UNION ALL SELECT 'parent', run_id, 'parent_run_id', CAST(parent AS DOUBLE), NULL FROM runs
UNION ALL SELECT 'tree', root, 'runs', CAST(count(*) AS DOUBLE), NULL FROM tree GROUP BY root
UNION ALL SELECT 'tree', root, 'sum_error', round(sum(value), 2), NULL FROM tree JOIN events ON user_id = run_id WHERE event_type = 'error' GROUP BY root""")
def snk_run_log(spark, sf_dir):
    """Append the run log (metrics per step, one parameter, one artifact and the
    parent of each run), read it back and roll the nested runs up: a user's run is
    nested in that of the user whose number lacks the last digit."""
    log = RunLog(spark, files.scratch_path(spark, "runs"))
    m = _metric_log(spark, sf_dir)
    log.log_metrics(m)
    log.log_params(m.groupBy("run_id").agg(F.lit("n_events").alias("key"), F.count(F.lit(1)).alias("value")))
    log.log_runs(m.select("run_id", F.when(F.col("run_id") >= 10, F.expr("run_id div 10")).alias("parent_run_id")).distinct())
    log.log_artifacts(m.groupBy("run_id").agg(F.array_join(F.array_sort(F.collect_set("key")), "\n").alias("content")).withColumn("path", F.lit("types.txt")))
    row = lambda kind, run, key, value: [F.lit(kind).alias("kind"), F.col(run).alias("run_id"), key.alias("key"), value.cast("double").alias("value")]
    metrics = log.metrics()
    tree = run_trees(log.runs())
    errors = tree.join(metrics.filter("key = 'error'"), "run_id").groupBy("root").agg(F.round(F.sum("value"), 2).alias("value"))
    parts = [
        log.params().select(*row("param", "run_id", F.col("key"), F.col("value"))),
        log.artifacts().select(*row("artifact", "run_id", F.concat_ws(":", "path", F.md5("content")), F.octet_length("content"))),
        log.runs().select(*row("parent", "run_id", F.lit("parent_run_id"), F.col("parent_run_id"))),
        tree.groupBy("root").agg(F.count(F.lit(1)).alias("n")).select(*row("tree", "root", F.lit("runs"), F.col("n"))),
        errors.select(*row("tree", "root", F.lit("sum_error"), F.col("value"))),
    ]
    rows = metrics.select(F.lit("metric").alias("kind"), "run_id", "key", "value", "step")
    for part in parts:
        rows = rows.unionByName(part.withColumn("step", F.lit(None).cast("long")))
    return rows


@register("snk_metric_text", sql="""WITH a AS (SELECT avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END) AS acc FROM labels),
""" + _wprf_sql("(SELECT quality AS y, toxic AS p FROM labels)") + """
SELECT printf('Accuracy: %.4f', acc) AS line FROM a UNION ALL SELECT printf('F1 Score: %.4f', f1) FROM w""")
def snk_metric_text(spark, sf_dir):
    lb = Tables(spark, sf_dir).labels
    acc = cl.accuracy(lb, "quality", "toxic").select(F.format_string("Accuracy: %.4f", "accuracy").alias("line"))
    f1 = cl.weighted_prf(lb, "quality", "toxic").select(F.format_string("F1 Score: %.4f", "f1").alias("line"))
    path = files.scratch_path(spark, "metrics-text")
    files.write_text(acc.unionByName(f1), "line", path)
    return spark.read.text(path).select(F.col("value").alias("line"))


# --- Spark ML: fitted on the training split, measured on the held-out one (rows-only
# checks for the driver; tests hold the relational scores against Spark ML's) -------------

HELD_OUT = "CASE WHEN {0} % 5 = 0 THEN 'test' ELSE 'train' END"


def _labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return t.documents.join(t.labels, "doc_id").select(
        "doc_id", "text", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("label"))


def _with_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its label, if it has one, and its split."""
    t = Tables(spark, sf_dir)
    labels = t.labels.select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("label"))
    split = F.when(F.col("label").isNotNull(), F.expr(HELD_OUT.format("doc_id"))).otherwise("unlabelled")
    return t.documents.select("doc_id", "text").join(labels, "doc_id", "left").withColumn("split", split)


def _measured(rows: DataFrame, key: str) -> DataFrame:
    """The rows with the accuracy and the weighted precision, recall and F1 of their
    split (a row a split, broadcast)."""
    metrics = cl.held_out_metrics(rows, "label", "prediction", "split")
    names = ["accuracy", "precision", "recall", "f1"]
    return rows.join(F.broadcast(metrics), "split", "left").select(
        key, "split", "label", "prediction", F.round("confidence", 6).alias("confidence"), "agrees", *[F.round(c, 6).alias(c) for c in names])


@register("ml_train_forest")
def ml_train_forest(spark, sf_dir):
    """Forest fitted on the training split; all documents scored by joins with its
    nodes.  ``agrees``: Spark ML decides the same with the same confidence."""
    docs = files.stored(_with_split(spark, sf_dir), "forest-docs")
    model = cl.text_forest().fit(docs.filter("split = 'train'").select("doc_id", "text", "label"))
    forest = model.stages[-1]
    nodes = cl.forest_nodes(forest, files.scratch_path(spark, "forest"))
    vectors = model.transform(docs)
    mine = cl.decided(cl.score_forest(nodes, forest.getNumTrees, forest.getMaxDepth(), vectors, "doc_id", "features"), ["doc_id"], model.stages[3].labels)
    theirs = cl.predict_with_confidence(model, docs, ["doc_id"]).select("doc_id", F.col("prediction").alias("_p"), F.col("confidence").alias("_c"))
    same = (F.col("prediction") == F.col("_p")) & (F.abs(F.col("confidence") - F.col("_c")) < 1e-9)
    rows = docs.select("doc_id", "split", "label").join(mine, "doc_id").join(theirs, "doc_id").withColumn("agrees", same).drop("_p", "_c")
    return _measured(files.stored(rows, "forest-scores"), "doc_id")


def texts_with_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; of every fifty one has no text, one an empty and one a blank one."""
    at = F.col("doc_id") % 50
    text = F.when(at == 7, F.lit(None)).when(at == 8, "").when(at == 9, " \t\n ").otherwise(F.col("text"))
    return Tables(spark, sf_dir).documents.select("doc_id", text.alias("text"))


@register("ml_batch_predict_safe")
def ml_batch_predict_safe(spark, sf_dir):
    """A batch with texts that have no content: those are answered with the error
    label and do not stop the others."""
    model = cl.text_forest().fit(_with_split(spark, sf_dir).filter("split = 'train'").select("doc_id", "text", "label"))
    return cl.batch_predict_safe(model, texts_with_blanks(spark, sf_dir), "text", ["doc_id"])


def _labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir).embeddings.select("vec_id", "embedding", F.col("label").cast("double").alias("label"), F.expr(HELD_OUT.format("vec_id")).alias("split"))
    return cl.with_vector(e, "embedding")


@register("ml_train_logistic")
def ml_train_logistic(spark, sf_dir):
    """Multinomial regression fitted on the training split; all vectors scored by a
    join with its coefficients (see ``ml_train_forest``)."""
    e = _labelled_vectors(spark, sf_dir)
    model = cl.logistic().fit(e.filter("split = 'train'"))
    mine = cl.decided(cl.score_linear(cl.linear_coefficients(model), e, "vec_id", "embedding"), ["vec_id"])
    theirs = model.transform(e).select("vec_id", F.col("prediction").cast("int").alias("_p"), F.array_max(vector_to_array("probability")).alias("_c"))
    same = (F.col("prediction") == F.col("_p")) & (F.abs(F.col("confidence") - F.col("_c")) < 1e-9)
    rows = e.select("vec_id", "split", F.col("label").cast("int").alias("label")).join(mine, "vec_id").join(theirs, "vec_id").withColumn("agrees", same)
    return _measured(files.stored(rows.drop("_p", "_c"), "linear-scores"), "vec_id")


@register("ml_lr_sweep")
def ml_lr_sweep(spark, sf_dir):
    """One model per regularisation value, measured on the held-out split, and the
    best value marked (the learning-rate sweep re-aimed at Spark ML)."""
    e = _labelled_vectors(spark, sf_dir)
    out = cl.sweep(e.filter("split = 'train'"), e.filter("split = 'test'"), cl.logistic().setMaxIter(100), "regParam", [1e-5, 2e-5, 5e-5])
    return out.select(F.col("value").alias("reg_param"), *[F.round(c, 6).alias(f"val_{c}") for c in ("accuracy", "precision", "recall", "f1")], "is_best")
