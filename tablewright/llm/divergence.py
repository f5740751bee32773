"""How far the sources of a language differ in their words.

Tasks count terms as Arrow columns: texts are lower-cased and split, terms become dictionary codes, and hash aggregation counts
occurrences and documents per language, source and term. These partial counts are merged by term. The terms that enough documents of a
language hold are put together in shards, columns of a bounded number of cells (terms by sources), and each shard gives what
its terms add to the distance of every pair of sources, and by how much a source exceeds its language in a term.

A share is ``1 + floor(10^9 (count + 5) / (N + 5 V))``, in whole numbers throughout, for any count up to 9 * 10^15. Two sources that
both lack a term differ in it by a constant, so a shard only adds what terms that occur change: its work follows the counts
that there are, not terms times pairs of sources.

Nothing is capped but the ranks of terms. A language or source with a third of all rows is summed in the tasks that read it; a word that
every text has is one row per task, source and language after that. Each row counts as a document.

Defined cases: null text, lang and source are empty strings; empty texts and those without a term hold none, their groups occur
all the same; a language without kept terms has distances of zero; rows that repeat a doc_id or have none are documents of their own;
long texts are read whole; equal values are ranked by the bytes of the item; an empty table has no groups; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stage

#: What stands between terms: ASCII without letters.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of a language that hold a kept term, what is added to each count, and parts of a share.
LEAST_DOCS, ADDED, WHOLE = 30, 5, 1_000_000_000
#: Terms listed per group.
TOP_TERMS = 50
#: Rows that are split at once, and partial counts that a task merges and then hands on.
SPLIT_ROWS, HELD_COUNTS = 256, 1 << 19
#: Cells (terms by sources) of a shard.
CELLS = 1 << 21
#: Groups of language and source up to which their table is broadcast.
SMALL_GROUPS = 50_000

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
PARTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])
KEYS = ["lang", "source", "term"]


def tally(batch: pa.RecordBatch) -> pa.Table:
    """Counts of a few rows; the empty term stands for the group itself."""
    split = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), SEPARATORS)
    coded = pc.list_flatten(split).dictionary_encode()
    said = pa.table({"row": pc.list_parent_indices(split), "code": coded.indices})
    blank = pc.index(coded.dictionary, pa.scalar("")).as_py()
    said = said.filter(pc.not_equal(said["code"], blank))
    per_row = said.group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    found = {
        "lang": batch.column("lang").take(per_row["row"]),
        "source": batch.column("source").take(per_row["row"]),
        "term": coded.dictionary.take(per_row["code"]),
        "n": per_row["count_all"],
        "docs": pa.array(np.ones(len(per_row), np.int64)),
    }
    groups = [batch.column("lang"), batch.column("source"), pa.array([""] * batch.num_rows, pa.string())]
    groups += [pa.array(np.zeros(batch.num_rows, np.int64)), pa.array(np.ones(batch.num_rows, np.int64))]
    return merged([pa.table(found, schema=COUNTS), pa.Table.from_arrays(groups, schema=COUNTS)])


def merged(tables: list[pa.Table]) -> pa.Table:
    summed = pa.concat_tables(tables).group_by(KEYS, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return pa.Table.from_arrays([summed[c] for c in [*KEYS, "n_sum", "docs_sum"]], schema=COUNTS)


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, SPLIT_ROWS):
            held.append(tally(batch.slice(at, SPLIT_ROWS)))
            size += len(held[-1])
            if size > 2 * HELD_COUNTS:
                held = [merged(held)]
                size = len(held[0])
                if size > HELD_COUNTS:
                    yield from held.pop().to_batches(1 << 16)
                    size = 0
    if held:
        yield from merged(held).combine_chunks().to_batches(1 << 16)


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, term, docs, found array<struct<source, n>>`` of every term; the empty term has all groups of the language."""
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    partial = read.mapInArrow(_partial_counts, "lang string, source string, term string, n long, docs long")
    # Dealt out once: both sums are taken where a term's rows meet.
    per_source = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return per_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("found"))


def languages(kept: DataFrame) -> DataFrame:
    """``lang, kept_terms, groups array<struct<source, total>>`` by source."""
    groups = kept.select("lang", F.inline("found")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    terms = kept.groupBy("lang").agg(F.count_if(F.col("term") != "").alias("kept_terms"))
    listed = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("groups"))
    return listed.join(terms, "lang")


def shares(counts: np.ndarray, totals: np.ndarray | int, terms: int) -> np.ndarray:
    """``1 + floor(WHOLE (counts + ADDED) / (totals + ADDED terms))`` by long division, three digits at a time."""
    total = np.asarray(totals, np.int64) + ADDED * terms
    out, rest = np.divmod(counts + ADDED, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digit
    return out + 1


class Distances:
    """What shards of one language add to the distances of its sources, on top of that of two that lack every term."""

    def __init__(self, lang: str, groups: pa.Array, terms: int):
        self.lang, self.terms = lang, terms
        self.sources = groups.field("source")
        self.totals = groups.field("total").to_numpy()
        self.absent = shares(np.zeros(len(self.totals), np.int64), self.totals, terms)
        self.sums = np.zeros((len(self.totals),) * 2, np.int64)

    def add(self, shard: pa.Array) -> pa.RecordBatch:
        """Take in a shard; terms in which a source exceeds the language come back."""
        found = shard.field("found")
        at = np.repeat(np.arange(len(shard)), np.diff(found.offsets.to_numpy()))
        who = pc.index_in(found.flatten().field("source"), self.sources).to_numpy()
        counts = np.zeros((len(shard), len(self.totals)), np.int64)
        counts[at, who] = found.flatten().field("n").to_numpy()
        own, there = shares(counts, self.totals, self.terms), counts > 0
        for a in range(len(self.totals)):
            rows = np.flatnonzero(there[:, a])
            apart = np.abs(own[rows] - own[rows, a][:, None]) - np.abs(self.absent - self.absent[a])
            once = ~there[rows]  # a term that both have counts where the first of them is looked at
            once[:, a + 1 :] = True
            once[:, a] = False
            self.sums[a] += (apart * once).sum(0)
        over = own - shares(counts.sum(1), int(self.totals.sum()), self.terms)[:, None]
        rows, a = np.nonzero(there & (over > 0))
        return self._batch(self.sources.take(pa.array(a)), "term", shard.field("term").take(pa.array(rows)), over[rows, a])

    def pairs(self) -> pa.RecordBatch:
        a, b = np.nonzero(~np.eye(len(self.totals), dtype=bool))
        return self._batch(self.sources.take(pa.array(a)), "pair", self.sources.take(pa.array(b)), (self.sums + self.sums.T)[a, b])

    def _batch(self, source: pa.Array, part: str, item: pa.Array, value: np.ndarray) -> pa.RecordBatch:
        n = len(value)
        return pa.RecordBatch.from_arrays([pa.array([self.lang] * n, pa.string()), source, pa.array([part] * n, pa.string()), item, pa.array(value)], schema=PARTS)


def _of_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: Distances | None = None
    for batch in batches:
        for i, (lang, terms) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("kept_terms").to_pylist())):
            if now is None or now.lang != lang:
                if now is not None:
                    yield now.pairs()
                now = Distances(lang, batch.column("groups").slice(i, 1).flatten(), terms)
            yield now.add(batch.column("shard").slice(i, 1).flatten())
    if now is not None:
        yield now.pairs()


def divergences(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, cells: int = CELLS) -> DataFrame:
    """``lang, source, part, item, value, rank``: every pair of sources, and the terms that a source uses most beyond its language."""
    kept = stage(term_counts(docs).where((F.col("docs") >= least_docs) | (F.col("term") == "")), "terms")
    langs = stage(languages(kept), "languages")
    n_groups = langs.agg(F.coalesce(F.sum(F.size("groups")), F.lit(0))).first()[0]
    side = F.broadcast if n_groups <= SMALL_GROUPS else (lambda df: df)

    n_shards = F.ceil(F.col("kept_terms") * F.size("groups") / F.lit(cells))
    placed = kept.where("term <> ''").join(side(langs.select("lang", n_shards.alias("n_shards"))), "lang")
    placed = placed.select("lang", F.pmod(F.xxhash64("term"), F.col("n_shards")).alias("at"), F.struct("term", "found").alias("entry"))
    shards = placed.groupBy("lang", "at").agg(F.collect_list("entry").alias("shard")).select("lang", "shard")
    columns = shards.join(side(langs), "lang").select("lang", "kept_terms", "groups", "shard").sortWithinPartitions("lang")
    found = columns.mapInArrow(_of_shards, "lang string, source string, part string, item string, value long")

    one, other = (langs.select("lang", "kept_terms", F.inline("groups").alias(f"{s}", f"{s}_total")) for s in ("source", "item"))
    absent = lambda total: F.expr(f"if(kept_terms = 0, 0L, {ADDED * WHOLE}L div ({total} + {ADDED} * kept_terms))")
    every = one.join(side(other.drop("kept_terms")), "lang").where("source <> item")
    lacking = every.select(
        "lang", "source", F.lit("pair").alias("part"), "item", (F.col("kept_terms") * F.abs(absent("source_total") - absent("item_total"))).alias("value")
    )
    summed = found.unionByName(lacking).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = summed.withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top_terms))


def op11_divergence(spark, sf_dir: str) -> DataFrame:
    return divergences(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "source", "text"))


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), said AS (
  SELECT lang, source, id, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term FROM said GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM said GROUP BY lang, source, term) c
    ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), of_source AS (
  SELECT lang, source, term, n,
         1 + (CAST(1000000000 AS HUGEINT) * (n + 5))
             // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p
  FROM counts
), of_lang AS (
  SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term)
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
             FROM of_source x JOIN of_source y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) d
    ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
), over AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item, s.p - l.q AS value
  FROM of_source s JOIN of_lang l ON s.lang = l.lang AND s.term = l.term WHERE s.n > 0 AND s.p > l.q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM over)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""
