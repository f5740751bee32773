"""Exact removal of lines that an earlier document has, as bitmaps of kept lines.

Line keys are hashed to 128 bits, dealt out by range of the hash with a secondary sort by document and
position, and first occurrences are streamed from each range. What comes back per document is a sparse
bitmap (64 lines to a word; words that keep every line are left out), so no line is shuffled as text. Whole texts
are joined with their bitmaps once. Everything is Spark SQL.

Keys that hold a large share of all lines are found on a hash sample of the documents. They are never
shuffled: a partial aggregate finds their first document, and the few results are broadcast. The sample
decides only how a key is computed, not what comes out.

Defined cases: a null text is one empty line; a row without doc_id takes no part and keeps all its lines;
rows that share a doc_id are one document, also with different texts: none of its lines is a repeat of another, and each row loses what a
smaller doc_id holds, by its own positions; very long texts are split whole; an empty table gives no row; other columns are
not looked at, whatever their names.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import stage

#: Characters stripped from both ends of a line before it is compared.
BLANKS = " \t\n\x0b\x0c\r"
#: A key with at least this share of the sampled lines is hot, so there are at most so many.
HOT_SHARE = 200
#: One document in so many is looked at to find hot keys.
SAMPLE = 64


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(BLANKS))
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, ascii_uppercase, ascii_lowercase))


def version(text: Column) -> Column:
    """Tells rows apart that share a doc_id but not the text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """Hashes, document, version and position of every line that takes part."""
    named = docs.where(F.col("doc_id").isNotNull())
    lines = named.select("doc_id", version(F.col("text")).alias("version"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keys = lines.select("doc_id", "version", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return keys.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"), "doc_id", "version", "pos"
    )


def hot_keys(found: DataFrame) -> DataFrame | None:
    """At most ``HOT_SHARE`` keys with a large share of the sampled lines."""
    sampled = found.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    counts = sampled.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "h1", "h2").limit(HOT_SHARE).collect()
    least = max(8, sampled.count() / HOT_SHARE)
    hot = [(r.h1, r.h2) for r in top if r.n >= least]
    return found.sparkSession.createDataFrame(hot, "h1 long, h2 long") if hot else None


def repeats(found: DataFrame) -> DataFrame:
    """Document, version and position of each line that a smaller doc_id holds too."""
    hot = hot_keys(found)
    cold = found if hot is None else found.join(F.broadcast(hot), ["h1", "h2"], "left_anti")
    so_far = Window.partitionBy("h1", "h2").orderBy("doc_id", "pos").rowsBetween(Window.unboundedPreceding, 0)
    first = cold.repartitionByRange("h1", "h2").withColumn("first_doc", F.first("doc_id").over(so_far))
    out = first.where(F.col("doc_id") > F.col("first_doc")).select("doc_id", "version", "pos")
    if hot is None:
        return out
    of_hot = found.join(F.broadcast(hot), ["h1", "h2"])
    first_hot = of_hot.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc"))
    known = found.join(F.broadcast(first_hot), ["h1", "h2"])
    return out.unionByName(known.where(F.col("doc_id") > F.col("first_doc")).select("doc_id", "version", "pos"))


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``doc_id, version, keep_bitmap array<struct<word, bits>>, n_dropped`` of each text that loses a line.

    Bit ``i`` of word ``w`` is line ``64 w + i``; 1 keeps it. Words that are not listed keep all their lines.
    """
    found = stage(occurrences(docs.select("doc_id", "text"), min_chars), "lines")
    drops = repeats(found).select("doc_id", "version", F.expr("pos div 64").alias("word"), F.expr("shiftleft(1L, cast(pos % 64 AS int))").alias("bit"))
    words = drops.groupBy("doc_id", "version", "word").agg(F.bit_or("bit").alias("bits"))
    return words.groupBy("doc_id", "version").agg(
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("keep_bitmap"),
        F.sum(F.bit_count("bits")).alias("n_dropped"),
    )


def kept_text(text: Column, bitmap: Column) -> Column:
    """The lines that ``bitmap`` keeps, joined by line breaks; all of them where it is null."""
    words = F.map_from_entries(bitmap)

    def stays(_, i):
        bits = F.try_element_at(words, F.expr("0L") + F.floor(i / 64))
        return F.coalesce(F.getbit(bits, (i % 64).cast("int")), F.lit(1)) == 1

    whole = F.coalesce(text, F.lit(""))
    return F.when(bitmap.isNull(), whole).otherwise(F.array_join(F.filter(lines_of(text), stays), "\n"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """All columns of ``docs`` with ``text`` reduced to its kept lines, and ``_line_count``, ``_line_drops``."""
    maps = keep_bitmaps(docs, min_chars).select(
        F.col("doc_id").alias("_line_doc"), F.col("version").alias("_line_version"), F.col("keep_bitmap").alias("_line_map"), F.col("n_dropped").alias("_line_drops")
    )
    same = (docs["doc_id"] == maps["_line_doc"]) & (version(docs["text"]) == maps["_line_version"])
    joined = docs.join(maps, same, "left")
    return joined.select(
        *[kept_text(docs["text"], F.col("_line_map")).alias("text") if c == "text" else docs[c] for c in docs.columns],
        F.size(lines_of(docs["text"])).cast("long").alias("_line_count"),
        F.coalesce(F.col("_line_drops"), F.lit(0)).cast("long").alias("_line_drops"),
    )


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeated_lines(docs).select(
        "doc_id",
        F.col("_line_count").alias("n_lines"),
        F.col("_line_drops").alias("n_dropped"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"),
    )


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
), firsts AS (
  SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= 10 GROUP BY key
), marked AS (
  SELECT l.doc_id, l.pos, l.line, coalesce(l.doc_id > f.first_doc, false) AS dropped
  FROM lines l LEFT JOIN firsts f ON l.key = f.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(dropped AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
