"""Near duplicates by MinHash: many universal hash minima, bands, signatures, and an exact look at the sets.

A document is the set of its distinct shingles of four words. Each of 160 universal hashes ``a x + b`` has its smallest value over the set;
16 bits of each make the signature. Five of them make a band, and documents that agree in one of 32 bands are candidates. A pair
of similarity 0.8 meets in no band with a chance of 3 in a million, a more similar one with less. Candidates whose signatures
agree in fewer than 100 places are no pair (a similarity of 0.8 gives fewer with a chance of 1 in 100 million); the others are linked if their
full sets say so. Documents with one set are one node from the start.

Links are looked for in two rounds, so that no group of copies becomes all its pairs:

1. Buckets are cut into cells at random, differently in each band. A cell gives a spanning forest of its most similar
   candidates; these are compared by their sets, and those that hold make the first classes.
2. Only buckets that still hold several classes are looked at again, without gaps: every document outside the bucket's largest class meets every
   other in a grid of cells. Documents with a candidate left there, in another class and in no earlier band, bring their sets to the cell. It compares them all
   and gives a spanning forest of the links that hold.

Classes are connected components by alternating large-star and small-star steps. Only nodes, never pairs of a group, are counted in what is
shuffled; comparisons inside the cells of a group of versions that aren't linked do grow with the square of its size.

Defined cases: null, empty and blank texts have no shingle and are linked with nothing; fewer than four words are one shingle; a row without doc_id
is in no class, which is null, and kept; rows that share a doc_id are one document with the links of all of them; long texts are
taken whole; copies have the smallest doc_id of their class; an empty table has no rows; other columns are not read. 64-bit hashes stand for shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import pin_small, stage
from .components import components
from .hot import join_unique, likely_in
from .near_copies import shortest
from .simhash import pairs_of
from .words import WordHashes, mix, record_batches, rows

SHINGLE = 4
#: Least similarity of a link, in percent.
PERCENT = 80
#: Bands, minima in each, and places in which signatures of a link agree at least.
BANDS, ROWS, LEAST_EQUAL = 32, 5, 100
#: Candidates whose signatures are compared at once, and that a task holds before it keeps a forest of them.
AT_ONCE, HELD = 1 << 15, 1 << 19
#: Documents, and shingles of their sets, of a side of a cell.
CELL_DOCS, CELL_SHINGLES = 1024, 1 << 20

WIDTH = BANDS * ROWS
#: Fixed numbers of the universal hashes (odd factors, any addends) and of the words of a shingle.
FACTORS = mix(np.arange(1, WIDTH + 1, dtype=np.uint64))[:, None] | np.uint64(1)
ADDENDS = mix(np.arange(1001, WIDTH + 1001, dtype=np.uint64))[:, None]
GRAM = np.uint64(0xD1342543DE82EF95)

PRINTED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d0", pa.int64()), ("d1", pa.int64()), ("signature", pa.binary())])
DIGEST = ["d0", "d1"]
SETS = pa.schema([("d0", pa.int64()), ("d1", pa.int64()), ("shingles", pa.list_(pa.int64()))])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
LEFT = pa.schema([("key", pa.int64()), ("h", pa.int32()), ("v", pa.int32()), ("home", pa.bool_()), ("label", pa.int64()), ("node", pa.int64())])


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    words = hashes.of((text or "").encode().lower().split())
    n = min(SHINGLE, len(words))
    out = np.full(max(0, len(words) - n + 1) if n else 0, n, np.uint64)
    for i in range(n):
        out = mix(out * GRAM + words[i : len(words) - n + 1 + i])
    return np.unique(out)


def signature(shingles: np.ndarray) -> bytes:
    low = np.full(WIDTH, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 1024):
        np.minimum(low, (shingles[at : at + 1024] * FACTORS + ADDENDS).min(1), out=low)
    return mix(low).astype(np.uint16).tobytes()


def digest(shingles: np.ndarray) -> list[int]:
    return np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64).tolist()


def printed(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, d0, d1`` (digest of the set) and ``signature`` of every row."""

    def run(batches):
        def prints():
            hashes = WordHashes(12)
            for doc_id, text in rows(batches, "doc_id", "text"):
                found = shingle_set(text, hashes)
                yield doc_id, len(found), *digest(found), signature(found) if len(found) else None

        return record_batches(prints(), PRINTED)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, d0 long, d1 long, signature binary")


def sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, shingles`` of wanted nodes, each from a text that has it."""

    def run(batches):
        def sets():
            hashes = WordHashes(12)
            for (text,) in rows(batches, "text"):
                found = shingle_set(text, hashes)
                yield *digest(found), found.view(np.int64).tolist()

        return record_batches(sets(), SETS, 256)

    named = stage(nodes.select("node", "doc_id", *DIGEST).join(wanted, "node", "left_semi"), "wanted")
    texts = likely_in(docs.select(F.col("doc_id").cast("long"), "text"), named, "doc_id", named.count())
    # An inner join, as the optimizer puts a semi join before the filter.
    texts = texts.join(named.select("doc_id").distinct(), "doc_id")
    found = texts.select("text").mapInArrow(run, "d0 long, d1 long, shingles array<long>").join(named.select("node", *DIGEST), DIGEST)
    return stage(found.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")


def buckets(nodes: DataFrame) -> DataFrame:
    """``band, key, node, n`` where a band has the same minima for ``n > 1`` nodes."""
    size = 2 * ROWS
    keys = [F.xxhash64(F.lit(i), F.substring("signature", i * size + 1, size)) for i in range(BANDS)]
    members = nodes.select("node", F.posexplode(F.array(*keys)).alias("band", "key"))
    sizes = stage(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    rows_ = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = join_unique(members, sizes.withColumn("weight", F.col("n")), ["key"], "weight", rows_)
    return stage(found.select("band", "key", "node", "n"), "buckets")


def in_cells(batches: Iterator[pa.RecordBatch], keys: list[str], columns: list[str]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Whole cells of rows sorted by ``keys``: the columns, and where cells start; the last cell of a batch is carried on."""
    held: list[np.ndarray] | None = None

    def read(batch):
        for name in [*keys, *columns]:
            column = batch.column(name)
            if pa.types.is_binary(column.type):
                yield np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, WIDTH)
            else:
                yield column.to_numpy(zero_copy_only=False)

    def starts_of(now):
        new = np.zeros(len(now[0]), bool)
        new[:1] = True
        for key in now[: len(keys)]:
            new[1:] |= key[1:] != key[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if batch.num_rows:
            now = list(read(batch))
            held = now if held is None else [np.concatenate(pair) for pair in zip(held, now)]
            starts = starts_of(held)
            if len(starts) > 1:
                yield [c[: starts[-1]] for c in held], starts[:-1]
                held = [c[starts[-1] :] for c in held]
    if held is not None:
        yield held, np.zeros(1, np.int64)


def agreeing(left: np.ndarray, right: np.ndarray, signatures: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs have like signatures and meet first in this band, and in how many places they agree."""
    kept, equal = [], []
    for at in range(0, len(left), AT_ONCE):
        same = signatures[left[at : at + AT_ONCE]] == signatures[right[at : at + AT_ONCE]]
        n = np.count_nonzero(same, axis=1)
        near = np.flatnonzero(n >= LEAST_EQUAL)
        near = near[same[near].reshape(-1, BANDS, ROWS).all(2).argmax(1) == band[left[at + near]]]
        kept.append(at + near)
        equal.append(n[near])
    return (np.concatenate(kept), np.concatenate(equal)) if kept else (np.empty(0, np.int64),) * 2


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []

    def reduced():
        if held:
            a, b, length = (np.concatenate(c) for c in zip(*held))
            held.clear()
            best = shortest(a, b, length)
            yield pa.RecordBatch.from_arrays([pa.array(a[best]), pa.array(b[best])], schema=LINKS)

    for (_, _, band, node, signatures), starts in in_cells(batches, ["key", "cell"], ["band", "node", "signature"]):
        ends = np.append(starts[1:], len(node))
        at = np.arange(len(node))
        later = ends[np.searchsorted(starts, at, "right") - 1] - at - 1
        for left, right in pairs_of(at, at + 1, later):
            near, equal = agreeing(left, right, signatures, band)
            held.append((node[left[near]], node[right[near]], WIDTH - equal))
            if sum(len(h[0]) for h in held) >= HELD:
                yield from reduced()
    yield from reduced()


def first_candidates(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """Spanning forests ``a, b`` of like signatures in the cells of the first round."""
    cell = F.pmod(F.xxhash64("node", "band"), F.ceil(F.col("n") / CELL_DOCS)).cast("int")
    placed = found.select("key", cell.alias("cell"), "band", "node").join(nodes.select("node", "signature"), "node")
    return placed.repartition("key", "cell").sortWithinPartitions("key", "cell").mapInArrow(_forests, "a long, b long")


def linked(docs: DataFrame, nodes: DataFrame, found: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The candidates whose full sets are similar enough, and the sets."""
    found = stage(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
    sets = sets_of(docs, nodes, found.select(F.col("a").alias("node")).unionByName(found.select(F.col("b").alias("node"))).distinct())
    one, other = (sets.select(F.col("node").alias(s), F.col("shingles").alias(f"of_{s}")) for s in "ab")
    common = F.size(F.array_intersect("of_a", "of_b"))
    alike = 100 * common >= percent * (F.size("of_a") + F.size("of_b") - common)
    return stage(found.join(one, "a").join(other, "b").where(alike).select("a", "b"), "links"), sets


def _left_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = ["home", "band", "label", "node", "signature"]
    for (key, h, v, home, band, label, node, signatures), starts in in_cells(batches, ["key", "h", "v"], columns):
        ends = np.append(starts[1:], len(node))
        homes = np.flatnonzero(home)
        cell = np.searchsorted(starts, homes, "right") - 1
        wanted = np.zeros(len(node), bool)
        for left, right in pairs_of(homes, starts[cell], (ends - starts)[cell]):
            apart = ~home[right] & (label[left] != label[right])
            left, right = left[apart], right[apart]
            near, _ = agreeing(left, right, signatures, band)
            wanted[left[near]] = wanted[right[near]] = True
        at = np.flatnonzero(wanted)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(c[at]) for c in (key, h, v, home, label, node)], schema=LEFT)


def compared(home: list[bool], label: list[int], node: list[int], sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Links between homes and guests of a cell, as many as join their classes into one another."""
    homes, guests = np.flatnonzero(home), np.flatnonzero(np.logical_not(home))
    if not len(homes) or not len(guests):
        return
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate([sets[g] for g in guests])
    order = np.argsort(values, kind="stable")
    owners, values = np.repeat(np.arange(len(guests)), sizes[guests])[order], values[order]
    _, root = np.unique(label, return_inverse=True)
    for i in homes:
        if (root[guests] == root[i]).all():
            continue
        first = np.searchsorted(values, sets[i], "left")
        count = np.searchsorted(values, sets[i], "right") - first
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        common = np.bincount(owners[np.repeat(first, count) + within], minlength=len(guests))
        for g in guests[100 * common >= percent * (sizes[i] + sizes[guests] - common)]:
            if root[g] != root[i]:
                root[root == root[g]] = root[i]
                yield node[i], node[g]


def _confirmed(percent: int):
    def cells(batches):
        key, held = None, []
        for batch in batches:
            lists = batch.column("shingles")
            values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            for i, (*cell, home, label, node) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "h", "v", "home", "label", "node")))):
                if cell != key:
                    yield held
                    key, held = cell, []
                held.append((home, label, node, values[offsets[i] : offsets[i + 1]].copy()))
        yield held

    def run(batches):
        return record_batches((link for held in cells(batches) if held for link in compared(*map(list, zip(*held)), percent)), LINKS)

    return run


def second_links(docs: DataFrame, nodes: DataFrame, found: DataFrame, sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links between classes that still share a bucket, from all their candidates."""
    labelled = nodes.select("node", "n_shingles").join(classes, "node", "left").select("node", "n_shingles", F.coalesce("component", "node").alias("label"))
    members = stage(found.select("band", "key", "node").join(labelled, "node"), "members")
    each = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    whole = each.groupBy("key").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.max(F.struct("n", "label", "s")).alias("most"))

    def cut(n, s):
        return F.greatest(F.ceil(n / CELL_DOCS), F.ceil(s / CELL_SHINGLES)).cast("int")

    split = whole.where("most.n < n").select(
        "key", F.col("n").alias("weight"), F.col("most.label").alias("largest"),
        cut(F.col("n") - F.col("most.n"), F.col("s") - F.col("most.s")).alias("hs"), cut(F.col("n"), F.col("s")).alias("vs"),
    )
    split = stage(split, "split")
    total = split.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    met = join_unique(members, split, ["key"], "weight", total)
    columns = ["key", "band", "label", "node"]
    at = lambda k: F.pmod(F.xxhash64("node", "band"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    as_home = met.where("label <> largest").select(*columns, F.lit(True).alias("home"), at("hs").alias("h"), every("vs").alias("v"))
    as_guest = met.select(*columns, F.lit(False).alias("home"), at("vs").alias("v"), every("hs").alias("h"))
    cell = ["key", "h", "v"]
    cells = as_home.unionByName(as_guest).join(nodes.select("node", "signature"), "node").repartition(*cell).sortWithinPartitions(*cell)
    left = stage(cells.mapInArrow(_left_over, "key long, h int, v int, home boolean, label long, node long"), "left")
    new = left.select("node").distinct().join(sets.select("node"), "node", "left_anti")
    sets = sets.unionByName(sets_of(docs, nodes, new))
    placed = left.join(sets, "node").repartition(*cell).sortWithinPartitions(*cell)
    return stage(placed.mapInArrow(_confirmed(percent), "a long, b long"), "links")


def classes_of_documents(found: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    labelled = nodes.join(components(edges), "node", "left").select("node", "doc_id", "copies", *DIGEST, F.coalesce("component", "node").alias("label"))
    labelled = stage(labelled, "labelled")
    lowest = stage(labelled.groupBy("label").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("weight")), "lowest")
    n_nodes = lowest.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    lows = stage(join_unique(labelled, lowest, ["label"], "weight", n_nodes).select(*DIGEST, "low", "copies"), "lows")
    named = found.where("doc_id IS NOT NULL AND n_shingles > 0").select("doc_id", "n_shingles", *DIGEST)
    total = nodes.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    rows_ = join_unique(named, lows, DIGEST, "copies", total).select("doc_id", "n_shingles", "low")
    empty = found.where("doc_id IS NOT NULL AND n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("low"))
    rows_ = stage(rows_.unionByName(empty), "rows")
    # Rows that share a doc_id join the classes of their texts.
    several = rows_.groupBy("doc_id").agg(F.min("low").alias("a"), F.max("low").alias("high")).where("a <> high").select("doc_id", "a")
    joins = components(rows_.join(several, "doc_id").select("a", F.col("low").alias("b")))
    joined = rows_.join(pin_small(joins.select(F.col("node").alias("low"), "component")), "low", "left")
    out = joined.select("doc_id", "n_shingles", F.coalesce("component", "low").alias("component_id"))
    nameless = found.where("doc_id IS NULL").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(nameless)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; the document with the smallest doc_id of a class is kept."""
    found = stage(printed(docs), "printed")
    distinct = found.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy(*DIGEST)
    nodes = distinct.agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    met = buckets(nodes)
    first, sets = linked(docs, nodes, first_candidates(met, nodes), percent)
    second = second_links(docs, nodes, met, sets, stage(components(first), "classes"), percent)
    out = classes_of_documents(found, nodes, first.unionByName(second))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op12_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


OP12_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) AS s FROM words WHERE len(w) > 0)
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT x, y FROM common c JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c.n >= 80 * (p.n + q.n - c.n)
), both_ways AS MATERIALIZED (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reached r JOIN both_ways b ON r.y = b.x
), lowest AS (
  SELECT x, min(y) AS low FROM reached GROUP BY x
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.low, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(l.low, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN lowest l ON l.x = d.doc_id
"""
