"""Line dedup: hashes of lines, range-partitioned with a secondary sort by
document and position, streamed for first occurrences; the result is a sparse
bitmap per document, not text.

1. Each line's key (white space stripped at both ends, A-Z lower-cased) of at
   least ``min_chars`` code points becomes a 128-bit hash; with its document
   and position that is 44 bytes a line, whatever the line's length.
2. The hashes are range-partitioned by (hash, document descending, position).
   The range covers all three, so a line that a third of the documents share
   is split over several slices instead of landing in one task.
3. Inside a slice the rows of a key stream by: the first is the largest
   document that holds it, and a new document is counted when the id changes.
   Only the first and last key of a slice can go on in another; the totals of
   those (two a slice) come from a small aggregation and are broadcast.
4. Rows to drop are packed into 64-bit words per document (only words with a
   drop are stored).  ``kept`` applies the bitmaps to the texts.

Only built-in functions run.

Defined cases: a null or empty text is one empty line; documents are told apart
by ``doc_id`` - rows that share an id are one document for the counts, and null
ids together count as one document below all others; lines under ``min_chars``
are never dropped; in the largest document all occurrences stay, in the others
all go; a document may lose all its lines (its text is then empty); other
columns pass through untouched, columns named like the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WHITE, lower_ascii, partitions, stored

MIN_CHARS = 20
MIN_DOCS = 3
NO_ID = -(2**63)  # stands for a null id


def document(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID))


def text_hash(text: Column) -> Column:
    """Tells apart the texts under one document id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_hashes(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(_doc, _text_hash, _pos, _h1, _h2) of each line that has a key."""
    rows = docs.select(
        document(F.col(doc)).alias("_doc"), text_hash(F.col(text)).alias("_text_hash"), F.posexplode(F.split(lower_ascii(F.coalesce(F.col(text), F.lit(""))), "\n")).alias("_pos", "_line"))
    keyed = rows.withColumn("_key", F.btrim("_line", F.lit(WHITE))).filter(F.char_length("_key") >= min_chars)
    return keyed.select("_doc", "_text_hash", "_pos", F.xxhash64("_key").alias("_h1"),
                        F.xxhash64(F.lit("second"), "_key").alias("_h2"))


def keep_bitmaps(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """(_doc, _text_hash, _drops array<struct<word,bits>>) of documents that lose
    lines: bit ``p % 64`` of word ``p / 64`` is set when line p goes."""
    lines = stored(line_hashes(docs, doc, text, min_chars), "line-hashes")
    order = [F.col("_h1"), F.col("_h2"), F.desc("_doc"), F.col("_text_hash"), F.col("_pos")]
    ranged = lines.repartitionByRange(partitions(lines), *order).sortWithinPartitions(*order)
    ranged = stored(ranged.withColumn("_slice", F.spark_partition_id()), "line-slices")

    # keys at the ends of a slice may go on in the next one: two a slice
    ends = ranged.groupBy("_slice").agg(F.min(F.struct("_h1", "_h2")).alias("a"), F.max(F.struct("_h1", "_h2")).alias("b"))
    ends = ends.select(F.explode(F.array("a", "b")).alias("e")).select("e._h1", "e._h2").distinct()
    whole = ranged.join(F.broadcast(ends), ["_h1", "_h2"]).groupBy("_h1", "_h2").agg(
        F.count_distinct("_doc").alias("_n_all"), F.max("_doc").alias("_top_all"))

    stream = Window.partitionBy("_slice", "_h1", "_h2").orderBy(F.desc("_doc"), "_text_hash", "_pos")
    group = Window.partitionBy("_slice", "_h1", "_h2")
    new = (F.lag("_doc").over(stream).isNull() | (F.lag("_doc").over(stream) != F.col("_doc"))).cast("int")
    streamed = ranged.withColumn("_new", new).withColumn("_n", F.sum("_new").over(group)).withColumn(
        "_top", F.max("_doc").over(group))
    settled = streamed.join(F.broadcast(whole), ["_h1", "_h2"], "left")
    dropped = settled.filter((F.coalesce("_n_all", "_n") >= min_docs) & (F.coalesce("_top_all", "_top") != F.col("_doc")))
    words = dropped.groupBy("_doc", "_text_hash", F.expr("_pos div 64").cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_pos % 64 as int))")).alias("bits"))
    return words.groupBy("_doc", "_text_hash").agg(F.collect_list(F.struct("word", "bits")).alias("_drops"))


def kept(docs: DataFrame, bitmaps: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``n_lines`` (before), ``n_dropped``
    and ``kept_text``.  Texts move once; the bitmap side is the hash-table side
    of the join, and skewed ids are left to AQE."""
    # names that no table has, so that the documents may bring any column
    mine = {"_doc": "__line_doc", "_text_hash": "__line_text_hash", "_drops": "__line_drops"}
    left = docs.drop("n_lines", "n_dropped", "kept_text").withColumns(
        {mine["_doc"]: document(F.col(doc)), mine["_text_hash"]: text_hash(F.col(text))})
    right = bitmaps.select(*[F.col(c).alias(n) for c, n in mine.items()])
    joined = left.join(right.hint("shuffle_hash"), [mine["_doc"], mine["_text_hash"]], "left")
    lines, drops = F.split(F.coalesce(F.col(text), F.lit("")), "\n"), F.col(mine["_drops"])
    by_word = F.map_from_entries(drops)
    bit = lambda i: F.coalesce(F.try_element_at(by_word, F.floor(i / 64).cast("int")), F.lit(0).cast("long"))
    stays = lambda line, i: F.getbit(bit(i), i % 64) == 0
    gone = F.aggregate(drops, F.lit(0).cast("long"), lambda a, x: a + F.bit_count(x["bits"]))
    return joined.withColumns({
        "n_lines": F.size(lines).cast("long"), "n_dropped": F.coalesce(gone, F.lit(0).cast("long")),
        "kept_text": F.when(drops.isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.array_join(F.filter(lines, stays), "\n")),
    }).drop(*mine.values())


def dedup_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS) -> DataFrame:
    return kept(docs, keep_bitmaps(docs, doc, text, min_chars, min_docs), doc, text)
