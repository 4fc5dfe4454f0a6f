"""Benchmark decontamination: a broadcast hash set of normalised n-grams.

Texts are lower-cased (A-Z) and cut into words.  Every ``n`` consecutive words
of a benchmark item are a window; a shorter item is one window.

The scan reads a document as *aligned* chunks of k = (n+1)/2 words: whatever
place a window of n words takes, it holds one aligned chunk whole.  So one row
for k words, not one for each word, is looked up in the broadcast set of the
windows' k-grams.  A chunk that is found is verified: all windows of the three
chunks around it are looked up in the broadcast table of windows, by their
words.  Verified windows give spans, spans give hit words and items.

Only built-in functions run; the documents are read once and only verified
hits and one row per document are shuffled.  The windows are broadcast when
their measured bytes are within ``BROADCAST_BYTES``; beyond that the same joins
shuffle the chunks, each with its two neighbours: three times the text.

Defined cases: null and empty texts have no words and are clean; items without
words have no window; items without an id mark words but are not listed;
repeated items and rows are harmless (every input row gets its own result);
an empty benchmark or an empty table give clean or no rows; other columns of the
documents pass through ``remove`` and are ignored by ``scan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lower_ascii, stored

WINDOW = 13
BROADCAST_BYTES = 64 << 20
# Fixed value of the contract: what separates words (after lower-casing A-Z).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = "[^ ]++"


def normalised(text: Column) -> Column:
    """Words joined by one space each; empty for null."""
    return F.btrim(F.coalesce(F.regexp_replace(lower_ascii(text), SEPARATORS, " "), F.lit("")), F.lit(" "))


def chunks(norm: Column, k: int) -> Column:
    """Aligned chunks of k words, the last one shorter."""
    return F.regexp_extract_all(norm, F.lit(f"{WORD}(?: {WORD}){{0,{k - 1}}}"), 0)


def grams(norm: Column, n: int) -> Column:
    """Every n consecutive words (a capture at each word's start)."""
    return F.regexp_extract_all(norm, F.lit(f"(?=({WORD}(?: {WORD}){{{n - 1}}})){WORD}"), 1)


def benchmark_windows(items: DataFrame, n: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """(length, window, items): distinct windows with the sorted ids that hold them."""
    norm = items.select(F.col(item).alias("_item"), normalised(F.col(text)).alias("_norm")).filter("_norm != ''")
    norm = norm.withColumn("_n", F.size(F.split("_norm", " ")))
    long = norm.filter(F.col("_n") >= n).select("_item", F.lit(n).alias("length"), F.explode(grams(F.col("_norm"), n)).alias("window"))
    short = norm.filter(F.col("_n") < n).select("_item", F.col("_n").alias("length"), F.col("_norm").alias("window"))
    return long.unionByName(short).groupBy("length", "window").agg(F.sort_array(F.collect_set("_item")).alias("items"))


def scan(docs: DataFrame, items: DataFrame, n: int = WINDOW, doc: str = "doc_id", text: str = "text",
         item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document row: (doc, n_words, n_hit, spans, items): ``spans``
    are the occurrences [from, to) in words, ``items`` the sorted item ids."""
    windows = stored(benchmark_windows(items, n, item, item_text), "benchmark-windows")
    lengths, size = windows.agg(
        F.sort_array(F.collect_set("length")),
        F.coalesce(F.sum(F.octet_length("window") + 8 * F.size("items") + 64), F.lit(0))).first()
    small = F.broadcast if size <= BROADCAST_BYTES else (lambda d: d)
    sizes = sorted({(x + 1) // 2 for x in lengths}) or [(n + 1) // 2]  # chunk length for each window length
    pieces = [windows.filter(F.col("length").isin([x for x in lengths if (x + 1) // 2 == k])).select(
        F.lit(k).alias("_k"), F.explode(grams(F.col("window"), k)).alias("_chunk")) for k in sizes]
    known = pieces[0]
    for p in pieces[1:]:
        known = known.unionByName(p)
    known = known.distinct().withColumn("_known", F.lit(True))

    base = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(doc).alias("_doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_text_hash"),
                       normalised(F.col(text)).alias("_norm"))
    first = chunks(F.col("_norm"), sizes[0])
    cut = base.withColumn("_first", first).select(
        "_row", "_doc", "_text_hash", "_norm",
        F.when(F.size("_first") == 0, F.lit(0)).otherwise(
            (F.size("_first") - 1) * sizes[0] + F.size(F.split(F.element_at("_first", F.lit(-1)), " "))).cast("long").alias("n_words"),
        F.col("_first").alias(f"_a{sizes[0]}"))
    for k in sizes[1:]:
        cut = cut.withColumn(f"_a{k}", chunks(F.col("_norm"), k))
    if len(sizes) == 1:
        cut = cut.withColumnRenamed(f"_a{sizes[0]}", "_all").withColumn("_k", F.lit(sizes[0]))
    else:
        cut = cut.withColumn("_s", F.explode(F.array(*[F.struct(F.lit(k).alias("_k"), F.col(f"_a{k}").alias("_all")) for k in sizes])))
        cut = cut.select("_row", "_doc", "_text_hash", "n_words", "_s._k", "_s._all")
    # a chunk goes with its neighbours, so that no join carries a whole document
    none, n_all = F.array(F.lit(None).cast("string")), F.size("_all")
    shifted = F.when(n_all > 0, F.arrays_zip(
        F.col("_all").alias("_chunk"), F.concat(none, F.slice("_all", 1, F.greatest(n_all - 1, F.lit(0)))).alias("_before"),
        F.concat(F.slice("_all", 2, F.greatest(n_all - 1, F.lit(0))), none).alias("_after")))
    rows = cut.select("_row", "_doc", "_text_hash", "n_words", "_k", F.posexplode_outer(shifted).alias("_at", "_c")).select(
        "_row", "_doc", "_text_hash", "n_words", "_k", "_at", "_c.*")
    looked = rows.join(small(known), ["_k", "_chunk"], "left")
    # the first chunk of a document keeps its row, found or not
    looked = looked.filter(F.col("_known") | (F.coalesce("_at", F.lit(0)) == 0))
    around = F.when(F.col("_known"), F.concat_ws(" ", "_before", "_chunk", "_after"))
    around = looked.select("_row", "_doc", "_text_hash", "n_words", (F.greatest(F.col("_at") - 1, F.lit(0)) * F.col("_k")).alias("_from"),
                           "_k", around.alias("_around"))
    by_length = F.array(*[F.struct(F.lit(x).alias("length"), F.when(F.col("_k") == (x + 1) // 2, grams(F.col("_around"), x)).alias("w"))
                          for x in lengths or [n]])
    tried = around.select("_row", "_doc", "_text_hash", "n_words", "_from", F.explode(by_length).alias("_w"))
    tried = tried.select("_row", "_doc", "_text_hash", "n_words", "_from", "_w.length", F.posexplode_outer("_w.w").alias("_off", "window"))
    hits = tried.join(small(windows), ["length", "window"], "left")
    hits = hits.filter(F.col("items").isNotNull() | (F.coalesce(F.col("_from") + F.col("_off"), F.lit(0)) == 0))
    start = F.col("_from") + F.col("_off")
    span = F.when(F.col("items").isNotNull(), F.struct(start.cast("int").alias("from"), (start + F.col("length")).cast("int").alias("to")))
    per_doc = hits.groupBy("_row").agg(
        F.first("_doc").alias(doc), F.first("_text_hash").alias("_text_hash"), F.first("n_words").alias("n_words"), F.sort_array(F.collect_set(span)).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("spans", zero, lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["to"] - F.greatest(s["from"], a["end"]))).alias("n"),
        F.greatest(a["end"], s["to"]).alias("end")), lambda a: a["n"])
    return per_doc.select(doc, "n_words", covered.alias("n_hit"), "spans", "items", "_text_hash")


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one hit word in twenty."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def remove(docs: DataFrame, items: DataFrame, n: int = WINDOW, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns."""
    bad = scan(docs, items, n, doc, text).filter(contaminated(F.col("n_hit"), F.col("n_words"))).select(
        F.col(doc).alias("_d"), F.col("_text_hash").alias("_h")).distinct()
    same = docs[doc].eqNullSafe(bad["_d"]) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == bad["_h"])
    return docs.join(bad, same, "left_anti")
