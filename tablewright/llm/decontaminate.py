"""Benchmark decontamination: item-sized windows of documents, found by SimHash and verified exactly.

For an item of L words, the windows of L words of a document are fingerprinted over their five-word shingles,
weighted by their length. The fingerprints of the items are indexed by four blocks of 16 bits: fingerprints within
``RADIUS`` bits agree within ``RADIUS // 4`` bits in some block, so looking up each block loses none of them. The
pairs found are verified with the exact weighted similarity: the weight of the common shingles
(repeats counted) over the weight of all shingles of the larger side. A window that shares no shingle with an item of its size has similarity zero and
isn't fingerprinted.

At a similarity of 0.8 fingerprints differ in 13 bits on average; the radius of 23 is three standard deviations
above. It is wide because benchmarks are small next to a corpus.

Items are read in slices of at most about ``SLICE`` and each slice goes to all tasks; a benchmark of more items
takes several passes over the documents, which makes no difference to the rows.

Defined cases: items of fewer than five words say nothing and match nothing; a null text has no words; a
document shorter than an item is one window; rows without doc_id are searched like any other; equal items
are all reported; of equally similar windows the earliest is; rows that repeat are searched alike; very long texts are searched whole; without
documents or items there is no row.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import WordHashes, mix, record_batches, rows

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
PARTS = 4
SLICE = 20_000
#: Bits of the table that tells which shingles may be an item's.
TABLE = 22
#: Windows that are fingerprinted at once.
CHUNK = 4_096

GRAM = np.uint64(0x9E3779B97F4A7C15)
#: ASCII letters in lower case, other ASCII signs that are no digits to spaces.
PLAIN = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
FOUND = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()), ("distance", pa.int64()), ("similarity", pa.float64())]
)
FOUND_DDL = "doc_id long, item_id long, start long, n_words long, distance long, similarity double"


def plain_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(PLAIN).split()


def shingles(words: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and weight (its letters) of each five-word shingle."""
    n = len(words) - SHINGLE + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    own = hashes.of(words)
    gram = own[:n].copy()
    for j in range(1, SHINGLE):
        gram = gram * GRAM + own[j : j + n]
    length = np.cumsum([0, *map(len, words)])
    return mix(gram), length[SHINGLE:] - length[:-SHINGLE]


def fingerprints(grams: np.ndarray, weights: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the ``size`` shingles from each start."""
    bits = np.unpackbits(grams.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64)
    sums = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum((2 * bits - 1) * weights[:, None], axis=0)])
    return np.packbits(sums[starts + size] > sums[starts], axis=1, bitorder="little").view(np.uint64)[:, 0]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weight of the common shingles, repeats counted, over that of the larger side."""

    def counted(side):
        grams, at, n = np.unique(side[0], return_index=True, return_counts=True)
        return grams, side[1][at], n

    (ga, wa, na), (gb, _, nb) = counted(a), counted(b)
    _, i, j = np.intersect1d(ga, gb, assume_unique=True, return_indices=True)
    return float((wa[i] * np.minimum(na[i], nb[j])).sum() / max(a[1].sum(), b[1].sum(), 1))


class Index:
    """Items by size, with their fingerprints cut into blocks, and a table of their shingles."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        hashes, sizes = WordHashes(7), defaultdict(list)
        self.ids, self.sides, prints = [], [], []
        for item_id, text in items:
            side = shingles(plain_words(text), hashes)
            if len(side[0]):
                sizes[len(side[0])].append(len(self.ids))
                self.ids.append(item_id)
                self.sides.append(side)
                prints.append(fingerprints(*side, np.zeros(1, np.int64), len(side[0]))[0])
        self.prints = np.array(prints, np.uint64)
        self.of_size = {size: np.array(at) for size, at in sizes.items()}
        pairs = sorted({(int(g), len(side[0])) for side in self.sides for g in side[0]})
        self.grams = np.array([g for g, _ in pairs], np.uint64)
        self.sizes = np.array([s for _, s in pairs], np.int64)

    def table(self) -> np.ndarray:
        table = np.zeros(1 << TABLE, bool)
        table[self.grams >> np.uint64(64 - TABLE)] = True
        return table

    def near(self, prints: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
        """Window, item and distance of fingerprints within the radius among the items of a size."""
        items = self.of_size[size]
        own = self.prints[items]
        close = np.zeros((len(prints), len(own)), bool)
        for part in range(PARTS):
            bits = np.uint64(64 // PARTS)
            mask = (np.uint64(1) << bits) - np.uint64(1)
            values, at = np.unique(own >> bits * np.uint64(part) & mask, return_inverse=True)
            theirs = prints >> bits * np.uint64(part) & mask
            close |= (np.bitwise_count(theirs[:, None] ^ values[None, :]) <= RADIUS // PARTS)[:, at]
        w, i = np.nonzero(close)
        distance = np.bitwise_count(prints[w] ^ own[i])
        for x in np.flatnonzero(distance <= RADIUS):
            yield int(w[x]), int(items[i[x]]), int(distance[x])


class Searcher:
    """Finds items in documents; one for each task."""

    def __init__(self, index: Index, least: float):
        self.index, self.least = index, least
        self.table, self.hashes = index.table(), WordHashes(7)

    def windows(self, grams: np.ndarray) -> dict[int, np.ndarray]:
        """By window size the starts of all windows that share a shingle with an item of that size."""
        at = np.flatnonzero(self.table[grams >> np.uint64(64 - TABLE)])
        if not len(at):
            return {}
        low, high = (np.searchsorted(self.index.grams, grams[at], side) for side in ("left", "right"))
        reach: dict[int, list[int]] = defaultdict(list)
        for p, a, b in zip(at.tolist(), low.tolist(), high.tolist()):
            for size in self.index.sizes[a:b].tolist():
                reach[size].append(p)
        out = {}
        for size, hits in reach.items():
            last = max(0, len(grams) - size)
            edge = np.zeros(last + 2, np.int32)
            np.add.at(edge, np.clip(np.array(hits) - size + 1, 0, last), 1)
            np.add.at(edge, np.clip(np.array(hits), 0, last) + 1, -1)
            out[size] = np.flatnonzero(np.cumsum(edge)[:-1])
        return out

    def search(self, text: str | None) -> dict[int, tuple[float, int, int, int]]:
        """By item its best window: similarity, start, words, distance."""
        grams, weights = shingles(plain_words(text), self.hashes)
        best: dict[int, tuple[float, int, int, int]] = {}
        if not len(grams):
            return best
        for size, starts in self.windows(grams).items():
            own = min(size, len(grams))
            for at in range(0, len(starts), CHUNK):
                part = starts[at : at + CHUNK]
                # Runs of neighbouring starts are summed on their own, the text between them isn't looked at.
                for run in np.split(part, np.flatnonzero(np.diff(part) > own) + 1):
                    lo, hi = int(run[0]), int(run[-1]) + own
                    prints = fingerprints(grams[lo:hi], weights[lo:hi], run - lo, own)
                    for w, item, distance in self.index.near(prints, size):
                        s = int(run[w])
                        alike = similarity((grams[s : s + own], weights[s : s + own]), self.index.sides[item])
                        if alike >= self.least and (item not in best or (alike, -s) > (best[item][0], -best[item][1])):
                            best[item] = (alike, s, own + SHINGLE - 1, distance)
        return best


def slices(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of the items, each of a bounded number."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").where(F.col("text").isNotNull())
    count = items.count()
    parts = max(1, -(-2 * count // SLICE)) if count > SLICE else 1
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield Index([(r.item_id, r.text) for r in own.orderBy("item_id", "text").toLocalIterator()])


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """A row for each document and each item it holds: where its best window starts (in words), its words, the
    distance of the fingerprints and the similarity."""

    def searched(index: Index) -> DataFrame:
        def run(batches):
            searcher = Searcher(index, least)

            def found():
                for doc_id, text in rows(batches, "doc_id", "text"):
                    for item, (alike, start, words, distance) in sorted(searcher.search(text).items()):
                        yield doc_id, index.ids[item], start, words, distance, alike

            return record_batches(found(), FOUND)

        return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, FOUND_DDL)

    return reduce(DataFrame.unionByName, map(searched, slices(benchmark)))


def drop_leaking(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item."""
    schema = docs.schema

    def without(docs: DataFrame, index: Index) -> DataFrame:
        def run(batches):
            searcher = Searcher(index, least)
            for batch in batches:
                texts = batch.column("text")
                yield batch.filter(pa.array([not searcher.search(texts[i].as_py()) for i in range(batch.num_rows)], pa.bool_()))

        return docs.mapInArrow(run, schema)

    return reduce(without, slices(benchmark), docs)


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
