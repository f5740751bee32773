"""Near-duplicates by SimHash, compared per anchor of a covering code.

A 64-bit fingerprint is three blocks of 22, 21 and 21 bits; fingerprints that differ in at most four bits
differ in at most one bit of some block. In each block the anchors are the words of a covering code: the
Hamming code of length 15 on the low bits (every value is within one bit of exactly one code word) times
all values of the other bits. A fingerprint is at home at its nearest anchor (radius one) and is copied to
every anchor within the radius plus the threshold of one bit, so a pair meets at the home of each of the
two. Only distinct fingerprints take part, copies are grouped before.

Tasks compare the fingerprints of an anchor in blocks and return a spanning forest of the links they find, never all pairs.
Anchors with many homes are cut into a grid of blocks. Classes come from ``components``.

Defined cases: a null or blank text has fingerprint zero; a row without doc_id gets its fingerprint and no
class; rows that share a doc_id are one document; very long texts are read whole; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import pin_small, stage
from .components import components
from .words import record_batches, rows

#: Seed of the shingle hash.
SEED = 42
#: First bit and width of each block; 15 bits of a block belong to the Hamming code.
BLOCKS = ((0, 22), (22, 21), (43, 21))
CODED = 15
#: Differing bits that link two fingerprints at most; a block then differs in one bit at most.
THRESHOLD = 4
#: Homes per block of the grid that a large anchor is cut into.
GRID = 16_384
#: Pairs that a task compares at once, links that it holds before it reduces them to a forest.
PAIRS = 1 << 20

FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
VISITS = pa.schema([("anchor", pa.int64()), ("home", pa.bool_()), ("fp", pa.int64()), ("node", pa.int64())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: str | None, size: int) -> int:
    """SimHash over ``size``-word shingles, repeats included, as an unsigned number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    whole, size = b" ".join(words), min(size, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    shingle = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), len(words) - size + 1
    for at in range(0, n, 32_768):
        to = min(n, at + 32_768)
        hashes = np.array([shingle(whole[s : e - 1], SEED) for s, e in zip(starts[at:to], ends[at + size - 1 : to + size - 1])], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, size: int = 5) -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` holds the 64 bits as a signed long."""

    def run(batches):
        return record_batches(((d, signed(fingerprint(t, size))) for d, t in rows(batches, "doc_id", "text")), FINGERPRINTS)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def code_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each 15-bit value: its code word, whether it differs from it, and by syndrome the pairs of bits to flip."""
    values = np.arange(1 << CODED)
    syndrome = np.zeros_like(values)
    for bit in range(CODED):
        syndrome ^= np.where(values >> bit & 1, bit + 1, 0)
    nearest = np.where(syndrome, values ^ (1 << np.maximum(syndrome - 1, 0)), values)
    flips = np.zeros((16, 7), np.int64)
    for s in range(1, 16):
        flips[s] = [1 << (i - 1) | 1 << (i ^ s) - 1 for i in range(1, 16) if i < i ^ s][:7]
    return nearest, syndrome, flips


def visits(fps: np.ndarray, nodes: np.ndarray, tables) -> Iterator[pa.RecordBatch]:
    """A row for each anchor that a fingerprint is copied to."""
    nearest, syndrome, flips = tables
    for table, (start, width) in enumerate(BLOCKS):
        block = (fps >> np.uint64(start)).astype(np.int64) & (1 << width) - 1
        low, high = block & (1 << CODED) - 1, block >> CODED
        word, s = nearest[low], syndrome[low]
        tagged = lambda code, free, t=table: t << 32 | free << CODED | code
        out = [(tagged(word, high), True, slice(None))]
        out += [(tagged(word, high ^ 1 << k), False, slice(None)) for k in range(width - CODED)]
        odd = np.flatnonzero(s)
        out += [(tagged(low[odd] ^ flips[s[odd], k], high[odd]), False, odd) for k in range(7)]
        for anchor, home, who in out:
            columns = [anchor, np.full(len(anchor), home), fps[who].view(np.int64), nodes[who]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=VISITS)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links with the smallest node that it reaches through them."""
    nodes, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, root = both[: len(a)], both[len(a) :], np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new, up := new[new]):
            new = up
        if np.array_equal(new, root):
            break
        root = new
    far = root != np.arange(len(nodes))
    return nodes[far], nodes[root[far]]


class Links:
    """Links found so far, reduced to a forest whenever many are held."""

    def __init__(self):
        self.a, self.b, self.n = [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.a.append(a)
            self.b.append(b)
            self.n += len(a)

    def reduced(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            a, b = forest(np.concatenate(self.a), np.concatenate(self.b))
            self.a, self.b, self.n = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=LINKS)


def pairs_of(homes: np.ndarray, first: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of each home row with the rows ``first .. first + count`` of its cell, a bounded number at once."""
    ends = np.cumsum(count)
    at = 0
    while at < len(homes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        for part in range(0, int(count[at]) if to == at + 1 else 1, PAIRS):
            n = np.minimum(count[at:to] - part, PAIRS) if to == at + 1 else count[at:to]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(homes[at:to], n), np.repeat(first[at:to] + part, n) + within
        at = to


def cells(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[dict[str, np.ndarray], Iterator]]:
    """Whole cells of a sorted grid, with the pairs to compare; a cell that reaches over batches is carried on."""
    names = ["anchor", "h", "v", "home", *columns]
    held: list[np.ndarray] = []

    def whole(rows: list[np.ndarray], last: bool):
        anchor, h, v, home = rows[:4]
        new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (h[1:] != h[:-1]) | (v[1:] != v[:-1])) + 1
        starts = np.concatenate([[0], new])
        sizes = np.diff(np.append(starts, len(anchor)))
        cut = len(anchor) if last else int(starts[-1])
        homes = np.flatnonzero(home[:cut])
        cell = np.searchsorted(starts, homes, "right") - 1
        return [c[cut:] for c in rows], (dict(zip(names, rows)), pairs_of(homes, starts[cell], sizes[cell]))

    for batch in batches:
        rows_ = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if held:
            rows_ = [np.concatenate(pair) for pair in zip(held, rows_)]
        if len(rows_[0]):
            held, found = whole(rows_, False)
            yield found
    if held and len(held[0]):
        yield whole(held, True)[1]


def _links_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    links = Links()
    for rows_, pairs in cells(batches, ["fp", "node"]):
        fps, nodes = rows_["fp"].view(np.uint64), rows_["node"]
        for left, right in pairs:
            near = np.bitwise_count(fps[left] ^ fps[right]) <= THRESHOLD
            a, b = nodes[left[near]], nodes[right[near]]
            links.add(a[a != b], b[a != b])
            if links.n >= PAIRS:
                yield from links.reduced()
    yield from links.reduced()


def links(distinct: DataFrame) -> DataFrame:
    """Links ``a, b`` that join the nodes of ``fp, node`` into the same classes as all near pairs do."""

    def copies(batches):
        tables = code_tables()
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                yield from visits(part.column("fp").to_numpy().view(np.uint64), part.column("node").to_numpy(), tables)

    copied = distinct.select("fp", "node").mapInArrow(copies, "anchor long, home boolean, fp long, node long")
    return in_grid(copied, ["fp", "node"]).mapInArrow(_links_of, "a long, b long")


def in_grid(copied: DataFrame, columns: list[str]) -> DataFrame:
    """Rows ``anchor, h, v, home, ...`` dealt out so that every home meets every row of its anchor in one cell.

    An anchor with many homes is a grid of cells. A home row is in its row of the grid, for all columns; every row is,
    as a guest, in its column, for all rows. A task gets its cells one after the other.
    """
    large = copied.where("home").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GRID)
    large = pin_small(large.select("anchor", F.ceil(F.col("n") / GRID).cast("int").alias("k")))
    dealt = copied.join(large, "anchor", "left").withColumn("k", F.coalesce("k", F.lit(1)))
    cell = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
    every = F.sequence(F.lit(0), F.col("k") - 1)
    as_home = dealt.where("home").select("anchor", F.lit(True).alias("home"), *columns, cell.alias("h"), F.explode(every).alias("v"))
    as_guest = dealt.select("anchor", F.lit(False).alias("home"), *columns, cell.alias("v"), F.explode(every).alias("h"))
    grid = as_home.unionByName(as_guest).repartition("anchor", "h", "v").sortWithinPartitions("anchor", "h", "v")
    return grid.select("anchor", "h", "v", "home", *columns)


def near_duplicates(docs: DataFrame, size: int = 5) -> DataFrame:
    """``doc_id, fp, component_id`` of each row: the smallest doc_id that near pairs lead to."""
    found = stage(fingerprints(docs, size), "fingerprints")
    distinct = stage(found.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")), "distinct")
    same = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high")
    ids = distinct.select(F.col("fp"), F.col("node"))
    twice = found.join(same.select("doc_id"), "doc_id", "left_semi").join(ids, "fp").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    classes = components(links(distinct).unionByName(twice))
    named = distinct.join(classes, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    with_class = found.join(named, "fp", "left")
    return with_class.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, 4).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
