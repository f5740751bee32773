"""Repeated passages by relative Lempel-Ziv parsing against blocks of earlier documents.

Reference blocks are cut where the text itself says: each window of 20 words has an anchor, its smallest
5-word hash, and the windows that follow each other with one anchor form a block of the words they cover.
Equal windows have equal anchors wherever they stand, so a document is factored by looking its blocks up
in the index of all blocks: a block that stands earlier is copied whole, and neighbouring copies make one
long factor. Where a factor begins or ends, a block holds windows that stand earlier inside other
blocks of the same anchor. Such blocks are checked window by window, each content once. The result is
exact (up to collisions of 128-bit hashes): a window is a repeat if and only if its words start earlier
too, in a smaller doc_id or before it in the same document.

Only anchors that occur twice leave the first shuffle. Anchors with a large share of all blocks, found on
a hash sample of the documents, skip it: they occur twice for certain. Texts are shuffled once.

Defined cases: a null text has no words; a row without doc_id takes no part and keeps all its words; rows with the
same doc_id and text are one document; rows with one doc_id and different texts are documents of their own, in the order of a
hash of the text; texts of fewer than 20 words hold no window; very long texts are read in overlapping parts; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import stage
from .words import WordHashes, mix, record_batches, rows

#: Words of an anchor; with windows of ``ANCHOR - 1 + 2 ** STEPS`` words.
ANCHOR = 5
STEPS = 4
WINDOW = ANCHOR - 1 + 2**STEPS
#: Words of one document that are worked on at once, and words at which documents are no longer put together.
CHUNK = 1 << 17
BUNDLE = 1 << 15
#: An anchor with at least this share of the sampled blocks is hot, so there are at most so many.
HOT_SHARE = 2_000
#: One document in so many is looked at to find hot anchors.
SAMPLE = 64
#: Odd multipliers: of the words of an anchor, and of the two window hashes.
GRAM = np.uint64(0x9E3779B97F4A7C15)
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

BLOCKS = pa.schema([("anchor", pa.int64()), ("block", pa.int64()), ("doc_id", pa.int64()), ("version", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])
WINDOWS = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("doc_id", pa.int64()), ("version", pa.int64()), ("start", pa.int32())])
#: What a block is: a copy of an earlier one, the first of its content, or a first whose windows need a check.
COPY, FIRST, CHECK = 0, 1, 2


def powers(base: int) -> np.ndarray:
    out = np.full(CHUNK + BUNDLE + 2 * WINDOW, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Hashes of word sequences from prefix sums of powers, modulo 2**64."""

    def __init__(self):
        self.words = WordHashes(7)
        self.up = [powers(b) for b in BASES]
        self.down = [powers(pow(b, -1, 1 << 64)) for b in BASES]

    def sums(self, hashes: np.ndarray, which: int) -> np.ndarray:
        own = hashes if which == 0 else mix(hashes)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * self.up[which][: len(own)], dtype=np.uint64)])

    def spans(self, sums: np.ndarray, which: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (sums[ends] - sums[starts]) * self.down[which][starts]


def split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window its anchor hash, and where the anchor stands (the leftmost of equals)."""
    n = len(hashes) - ANCHOR + 1
    gram = hashes[:n].copy()
    for j in range(1, ANCHOR):
        gram = gram * GRAM + hashes[j : j + n]
    low, at = mix(gram), np.arange(n)
    for step in range(STEPS):
        reach = 1 << step
        left, right = low[:-reach], low[reach:]
        pick = right < left
        at = np.where(pick, at[reach:], at[:-reach])
        low = np.where(pick, right, left)
    return low, at


Document = tuple[int, int]  # doc_id, hash of the text
Part = tuple[Document, int, list[bytes]]  # document, position of the first word, words


def chunks(doc: Document, words: list[bytes]) -> Iterator[Part]:
    """Parts of a document that together hold every window once."""
    for start in range(0, len(words) - WINDOW + 1, CHUNK):
        yield doc, start, words[start : start + CHUNK + WINDOW - 1]


def bundles(parts: Iterable[Part]) -> Iterator[list[Part]]:
    """Parts put together, so that arrays are long enough to work on."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[2])
        if n >= BUNDLE:
            yield held
            held, n = [], 0
    if held:
        yield held


class Bundle:
    """The words of some parts one after the other, and which windows lie in one part."""

    def __init__(self, parts: list[Part], hasher: Hasher):
        sizes = np.array([len(words) for _, _, words in parts])
        self.at = np.cumsum(sizes) - sizes
        self.docs = np.array([d for d, _, _ in parts], np.int64).T
        self.offsets = np.array([o for _, o, _ in parts])
        self.hashes = hasher.words.of(list(chain.from_iterable(words for _, _, words in parts)))
        edge = np.zeros(len(self.hashes) + 1, np.int32)
        edge[self.at] += 1
        np.add.at(edge, self.at + sizes - WINDOW + 1, -1)
        self.inside = np.cumsum(edge)[: len(self.hashes) - WINDOW + 1] > 0

    def place(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, version and position of windows."""
        part = np.searchsorted(self.at, windows, "right") - 1
        return *self.docs[:, part], (windows - self.at[part] + self.offsets[part]).astype(np.int32)


def blocks_of(parts: list[Part], hasher: Hasher) -> list[np.ndarray]:
    own = Bundle(parts, hasher)
    low, at = anchors(own.hashes)
    new = own.inside.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~own.inside[:-1]
    first = np.flatnonzero(new)
    before = np.cumsum(own.inside) - own.inside
    n = np.diff(np.append(before[first], own.inside.sum()))
    block = mix(hasher.spans(hasher.sums(own.hashes, 0), 0, first, first + n + WINDOW - 1) + n.astype(np.uint64))
    return [low[first].view(np.int64), block.view(np.int64), *own.place(first), n.astype(np.int32)]


def _arrow(parts: Iterator[list[np.ndarray]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= 65_536:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], schema=schema)
            held, size = [], 0
    if size:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], schema=schema)


def _blocks(batches):
    hasher = Hasher()
    parts = (p for *d, t in rows(batches, "doc_id", "version", "text") for p in chunks(tuple(d), split(t)))
    return _arrow((blocks_of(b, hasher) for b in bundles(parts)), BLOCKS)


def blocks(docs: DataFrame) -> DataFrame:
    """All blocks of all documents: ``anchor, block, doc_id, version, start, n`` (windows)."""
    return docs.mapInArrow(_blocks, "anchor long, block long, doc_id long, version long, start int, n int")


def repeated_blocks(docs: DataFrame) -> DataFrame:
    """Blocks whose anchor occurs more than once."""
    found = blocks(docs)
    sample = stage(blocks(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)).groupBy("anchor").agg(F.count(F.lit(1)).alias("n")), "anchors")
    least = max(32, (sample.agg(F.sum("n")).first()[0] or 0) / HOT_SHARE)
    hot = [(r.anchor,) for r in sample.where(F.col("n") >= least).select("anchor").collect()]
    hot = F.broadcast(docs.sparkSession.createDataFrame(hot, "anchor long").withColumn("hot", F.lit(True)))
    found = found.join(hot, "anchor", "left")
    # A hot row gets a key of its own in place of its anchor and so is dealt out at random.
    own = F.when(F.col("hot"), F.xxhash64("doc_id", "version", "start", "block")).otherwise(F.col("anchor"))
    cold = found.withColumn("key", own).withColumn("is_hot", F.col("hot").isNotNull())
    twice = Window.partitionBy("is_hot", "key").orderBy("block").rowsBetween(-1, 1)
    kept = cold.withColumn("near", F.count(F.lit(1)).over(twice)).where((F.col("near") > 1) | F.col("is_hot"))
    return kept.select("anchor", "block", "doc_id", "version", "start", "n")


def marked_blocks(repeated: DataFrame) -> DataFrame:
    """``doc_id, version, marks``: per document its repeated blocks, each as one number (``unpacked`` tells them apart)."""
    firsts = repeated.groupBy("anchor", "block").agg(F.min(F.struct("doc_id", "version", "start", "n")).alias("first"))
    firsts = stage(firsts.select("anchor", "first.*"), "firsts")
    several = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1").select("anchor", F.lit(CHECK).alias("check"))
    kinds = firsts.join(several, "anchor", "left").select("doc_id", "version", "start", "n", F.coalesce("check", F.lit(FIRST)).alias("kind"))
    every = repeated.select("doc_id", "version", "start", "n", F.lit(COPY).alias("kind")).unionByName(kinds)
    mark = (F.col("start").cast("long") * 32 + F.col("n")) * 4 + F.col("kind")
    return every.groupBy("doc_id", "version").agg(F.collect_list(mark).alias("marks"))


def unpacked(marks: list[int] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, windows and kind of each block; one that is listed as a copy and as a first is a first."""
    packed = np.sort(np.array(marks or (), np.int64))
    start = packed >> 7
    last = np.flatnonzero(np.append(start[1:] != start[:-1], True)) if len(packed) else packed
    return start[last], packed[last] >> 2 & 31, packed[last] & 3


def checked(marks: list[int] | None) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last window of runs of blocks that need a check."""
    start, n, kind = unpacked(marks)
    start, end = start[kind == CHECK], (start + n)[kind == CHECK]
    joins = start[1:] == end[:-1]
    return start[np.append(True, ~joins)] if len(start) else start, end[np.append(~joins, True)] if len(start) else end


def run_parts(doc: Document, text: str | None, marks: list[int] | None) -> Iterator[Part]:
    """The words under each run of windows that need a check."""
    starts, ends = checked(marks)
    if len(starts):
        words = split(text)
        for start, end in zip(starts.tolist(), ends.tolist()):
            for d, offset, part in chunks(doc, words[start : end + WINDOW - 1]):
                yield d, start + offset, part


def windows_of(parts: list[Part], hasher: Hasher) -> list[np.ndarray]:
    own = Bundle(parts, hasher)
    at = np.flatnonzero(own.inside)
    hashes = [mix(hasher.spans(hasher.sums(own.hashes, k), k, at, at + WINDOW)).view(np.int64) for k in (0, 1)]
    return [*hashes, *own.place(at)]


def _windows(batches):
    hasher = Hasher()
    parts = (p for *d, t, m in rows(batches, "_doc", "_version", "text", "marks") for p in run_parts(tuple(d), t, m))
    return _arrow((windows_of(b, hasher) for b in bundles(parts)), WINDOWS)


def repeated_words(n_words: int, marks: list[int] | None, first_windows: list[int] | None) -> np.ndarray:
    """Which words are covered by a window that stands earlier too."""
    edge = np.zeros(n_words + 1, np.int32)
    start, n, kind = unpacked(marks)
    copies = kind == COPY
    np.add.at(edge, start[copies], 1)
    np.add.at(edge, start[copies] + n[copies] + WINDOW - 1, -1)
    starts, ends = checked(marks)
    if len(starts):
        sizes = ends - starts
        windows = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        windows = windows[~np.isin(windows, np.array(first_windows or (), np.int64))]
        np.add.at(edge, windows, 1)
        np.add.at(edge, windows + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def repeats(docs: DataFrame) -> DataFrame:
    """``_doc, text, marks, first_windows`` of every row; ``repeated_words`` turns the last two into a mask."""
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_version"), "text")
    named = texts.where("_doc IS NOT NULL").select(F.col("_doc").alias("doc_id"), F.col("_version").alias("version"), "text")
    marks = stage(marked_blocks(stage(repeated_blocks(named), "blocks")), "marks")
    same = [F.col("_doc") == F.col("doc_id"), F.col("_version") == F.col("version")]
    with_marks = texts.join(marks, same, "left").select("_doc", "_version", "text", "marks")
    windows = with_marks.mapInArrow(_windows, "w1 long, w2 long, doc_id long, version long, start int")
    firsts = windows.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "version", "start")).alias("first"))
    firsts = firsts.select("first.*").groupBy("doc_id", "version").agg(F.collect_list("start").alias("first_windows"))
    return with_marks.join(firsts, same, "left").select("_doc", "text", "marks", "first_windows")


def drop_repeated_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the words left, joined by single spaces)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def one(doc_id, text, marks, first_windows):
        words = split(text)
        gone = repeated_words(len(words), marks, first_windows) if marks else np.zeros(1, bool)
        kept = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
        return doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode()

    def run(batches):
        return record_batches((one(*r) for r in rows(batches, "_doc", "text", "marks", "first_windows")), schema, 256)

    return repeats(docs).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = drop_repeated_passages(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
