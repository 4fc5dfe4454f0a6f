"""Classification metrics (as aggregations) and Spark ML training/scoring.

Metrics are computed from a confusion table ``groupBy(group, y, p)`` whose
size is (classes^2 x groups), so every step after the first aggregation works
on a tiny frame, whatever the number of scored rows."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import IDF, CountVectorizer, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Class names of the 6-class emotion label dictionary (id order).
LABEL_NAMES = ["sadness", "joy", "love", "anger", "fear", "surprise"]
ERROR_LABEL = "error"


def accuracy(df: DataFrame, y: str, p: str, group: list[str] | None = None) -> DataFrame:
    g = df.groupBy(*(group or []))
    return g.agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"))


def weighted_prf(df: DataFrame, y: str, p: str, group: list[str] | None = None) -> DataFrame:
    """Support-weighted precision, recall and F1 (a class whose denominator is
    0 contributes 0), over the classes seen in ``y`` or ``p``."""
    group = group or []
    conf = df.groupBy(*group, F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sup = conf.groupBy(*group, F.col("y").alias("c")).agg(F.sum("n").alias("sup"))
    pred = conf.groupBy(*group, F.col("p").alias("c")).agg(F.sum("n").alias("pred"))
    tp = conf.filter(F.col("y") == F.col("p")).groupBy(*group, F.col("y").alias("c")).agg(F.sum("n").alias("tp"))
    per = sup.join(pred, group + ["c"], "full").join(tp, group + ["c"], "left").fillna(0, ["sup", "pred", "tp"])
    prec = F.when(F.col("pred") == 0, 0.0).otherwise(F.col("tp") / F.col("pred"))
    rec = F.when(F.col("sup") == 0, 0.0).otherwise(F.col("tp") / F.col("sup"))
    f1 = F.when(prec + rec == 0, 0.0).otherwise(2 * prec * rec / (prec + rec))
    per = per.select(*group, "sup", prec.alias("pc"), rec.alias("rc"), f1.alias("fc"))
    tot = F.sum("sup")
    return per.groupBy(*group).agg(
        (F.sum(F.col("sup") * F.col("pc")) / tot).alias("precision"),
        (F.sum(F.col("sup") * F.col("rc")) / tot).alias("recall"),
        (F.sum(F.col("sup") * F.col("fc")) / tot).alias("f1"),
    )


def softmax(arr) -> Column:
    a = F.col(arr) if isinstance(arr, str) else arr
    m = F.array_max(a)
    ex = F.transform(a, lambda x: F.exp(x.cast("double") - m))
    s = F.aggregate(ex, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(ex, lambda v: v / s)


def argmax_first(arr) -> Column:
    """0-based index of the largest element; the lowest index on ties."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def label_name(idx: Column) -> Column:
    names = F.array(*[F.lit(n) for n in LABEL_NAMES])
    return F.element_at(names, idx + 1)


def valid_text(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\S"), F.lit(False))


# --- Spark ML ------------------------------------------------------------------------

def text_forest(text: str = "text", label: str = "label", seed: int = 42) -> Pipeline:
    """TF-IDF (<= 1000 terms) + 10-tree random forest; labels indexed in
    alphabetical order like a label encoder."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern=r"[\p{L}\p{N}_]{2,}", gaps=False, toLowercase=True),
        CountVectorizer(inputCol="_tok", outputCol="_tf", vocabSize=1000),
        IDF(inputCol="_tf", outputCol="features"),
        StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc"),
        RandomForestClassifier(featuresCol="features", labelCol="label_idx", numTrees=10, seed=seed),
    ])


def predict_with_confidence(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """Arg-max class (lowest index on ties), decoded to its label, and its probability."""
    labels = model.stages[3].labels
    scored = model.transform(df).withColumn("_p", vector_to_array("probability"))
    out = scored.select(*keep, argmax_first("_p").alias("_i"), F.array_max("_p").alias("confidence"))
    out = IndexToString(inputCol="_i_d", outputCol="prediction", labels=labels).transform(
        out.withColumn("_i_d", F.col("_i").cast("double")))
    return out.select(*keep, "prediction", "confidence")


def batch_predict_safe(model: PipelineModel, df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Per-text result; a text without content (null, empty, blank) gives
    ("error", 0.0) and does not stop the batch.  The length bound of a request
    is ``operators.requests.validate_text``, not a rule of batch scoring."""
    ok = valid_text(F.col(text))
    good = predict_with_confidence(model, df.filter(ok), keep)
    bad = df.filter(~ok).select(*keep, F.lit(ERROR_LABEL).alias("prediction"), F.lit(0.0).alias("confidence"))
    return good.unionByName(bad)


# --- fitted models as relations ---------------------------------------------------------
#
# A forest is a table of nodes, a linear model a table of coefficients; scoring
# is a join with them.  Both tables are bounded by the model's own size (trees
# times 2^(depth + 1) nodes; classes times features) and are broadcast.

def forest_nodes(model: RandomForestClassificationModel, path: str) -> DataFrame:
    """(tree, node, feature, threshold, below, above, votes): the stored form of a
    fitted forest, written to ``path``.  A leaf has no ``below``; votes are the
    class shares of the training rows in a node."""
    model.write().overwrite().save(path)
    n = F.col("nodeData")
    total = F.aggregate(n["impurityStats"], F.lit(0.0), lambda s, x: s + x)
    return SparkSession.active().read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        F.when(n["leftChild"] >= 0, n["leftChild"]).alias("below"), F.when(n["rightChild"] >= 0, n["rightChild"]).alias("above"),
        F.transform(n["impurityStats"], lambda x: x / total).alias("votes"))


def score_forest(nodes: DataFrame, trees: int, depth: int, rows: DataFrame, key: str, features: str) -> DataFrame:
    """(key, probability array<double>): every row of ``rows`` (unique ``key``, a
    vector column ``features``) walks down every tree, one join with the nodes a
    level, and the votes of its leaves are averaged by class."""
    dense = vector_to_array(features)
    entries = F.map_from_entries(F.filter(F.transform(dense, lambda x, i: F.struct(i.alias("feature"), x.alias("x"))), lambda e: e["x"] != 0))
    at = rows.select(key, entries.alias("_x")).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("node", F.lit(0))
    splits = F.broadcast(nodes.filter("below is not null").drop("votes"))
    for _ in range(depth):
        value = F.coalesce(F.try_element_at("_x", F.col("feature")), F.lit(0.0))
        next_ = F.when(F.col("below").isNull(), F.col("node")).when(value <= F.col("threshold"), F.col("below")).otherwise(F.col("above"))
        at = at.join(splits, ["tree", "node"], "left").select(key, "_x", "tree", next_.alias("node"))
    leaves = F.broadcast(nodes.select("tree", "node", "votes"))
    votes = at.join(leaves, ["tree", "node"]).select(key, F.posexplode("votes").alias("class", "vote"))
    return _by_class(votes, key, F.avg("vote"), "probability")


def linear_coefficients(model: LogisticRegressionModel) -> DataFrame:
    """(class, feature, weight) of a fitted multinomial model; the intercept is
    the weight of feature -1."""
    weights, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    rows = [(c, i, float(w)) for c, row in enumerate(weights) for i, w in enumerate(row)]
    rows += [(c, -1, float(w)) for c, w in enumerate(intercepts)]
    return SparkSession.active().createDataFrame(rows, "class int, feature int, weight double")


def score_linear(coefficients: DataFrame, rows: DataFrame, key: str, vec: str) -> DataFrame:
    """(key, probability array<double>): components join their weights, margins are
    sums by class, probabilities their softmax."""
    parts = rows.select(key, F.posexplode(F.concat(F.array(F.lit(1.0)), F.transform(vec, lambda x: x.cast("double")))).alias("at", "x"))
    weighted = parts.withColumn("feature", F.col("at") - 1).join(F.broadcast(coefficients), "feature")
    margins = _by_class(weighted, key, F.sum(F.col("x") * F.col("weight")), "margins")
    return margins.select(key, softmax("margins").alias("probability"))


def _by_class(rows: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """One row per key with ``value`` of its rows of each class, in class order."""
    each = rows.groupBy(key, "class").agg(value.alias("v"))
    return each.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("class", "v"))), lambda s: s["v"]).alias(name))


def decided(scored: DataFrame, keep: list[str], labels: list[str] | None = None) -> DataFrame:
    """(keep..., prediction, confidence): the first class of the largest
    probability, as its label or its number."""
    best = argmax_first("probability")
    named = F.element_at(F.array(*[F.lit(x) for x in labels]), best + 1) if labels else best
    return scored.select(*keep, named.alias("prediction"), F.array_max("probability").alias("confidence"))


def held_out_metrics(rows: DataFrame, y: str, p: str, group: str) -> DataFrame:
    """(group, accuracy, precision, recall, f1) of the rows with a truth."""
    known = rows.filter(F.col(y).isNotNull())
    return accuracy(known, y, p, [group]).join(weighted_prf(known, y, p, [group]), group)


def logistic(features: str = "features", label: str = "label") -> LogisticRegression:
    return LogisticRegression(featuresCol=features, labelCol=label, family="multinomial", maxIter=1000)


def with_vector(df: DataFrame, arr: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(arr)))


def sweep(train: DataFrame, held_out: DataFrame, estimator: LogisticRegression, param: str, values: list[float]) -> DataFrame:
    """(value, accuracy, precision, recall, f1, is_best): one model per parameter
    value, each measured on the same held-out rows; the best has the largest
    accuracy, the smaller value among equals."""
    label = estimator.getLabelCol()
    fitted = dict(estimator.fitMultiple(train, [{getattr(estimator, param): v} for v in values]))
    scored = [fitted[i].transform(held_out).select(F.lit(v).alias("value"), F.col(label).alias("_y"), F.col("prediction").alias("_p"))
              for i, v in enumerate(values)]
    metrics = held_out_metrics(reduce(DataFrame.unionByName, scored), "_y", "_p", "value")
    best = metrics.agg(F.max_by("value", F.struct("accuracy", -F.col("value"))).alias("best"))
    return metrics.join(F.broadcast(best), F.lit(True)).select(
        "value", "accuracy", "precision", "recall", "f1", (F.col("value") == F.col("best")).alias("is_best"))


def hash_split(df: DataFrame, key: str, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``split`` = 'test' / 'train' from a seeded hash of the key: stable
    across runs and partitionings, no global ordering (an exact share would
    need a ranking over all rows in one partition); the share converges to
    ``test_fraction`` as the table grows."""
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10_000))
    return df.withColumn("split", F.when(bucket < int(round(test_fraction * 10_000)), "test").otherwise("train"))
