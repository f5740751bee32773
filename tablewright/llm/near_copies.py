"""Near copies by five-word similarity, with MinHash bands for finding them.

Two texts are near copies if the Jaccard index of their sets of five-word shingles is 0.8 or more; it is taken exactly,
from the sets. What may be alike is found by MinHash: in each of ``BANDS`` bands of ``ROWS`` hashes, texts with the same values
meet, with a chance of 0.8^5 at a similarity of 0.8. That all bands miss a pair has a chance of 3 in a million there and less above, for texts of
any length, as it depends on the similarity of the sets alone.

A first round joins most copies cheaply: anchors of a 128-bit SimHash over the distinct words of a text, six blocks as in
``simhash``. Where texts meet, a second 128-bit SimHash over the set of shingles says how near they are; of the links within
``REACH`` bits a task keeps spanning forests with the shortest links, which are verified. It need not be complete.
Then classes whose texts meet in a band are taken together, and all pairs of texts in different classes of such a
group are compared by their sets, in a grid of cells. Cells return spanning forests of links that hold, so the number of links stays
in proportion to that of the texts, and no pair is left out.

Defined cases: blank and null texts are equal; texts of fewer than five words are one shingle; rows without doc_id
have no class; rows that share a doc_id are one document; very long texts are read whole; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stage
from .components import components
from .simhash import BLOCKS, PAIRS, cells, code_tables, forest, in_grid, visits
from .words import mix, record_batches, rows

SHINGLE = 5
SIMILARITY = 0.8
#: Differing bits, of 128, of the shingle fingerprints of two texts that are verified. Texts alike to 0.8 differ in 19
#: on average, with a deviation of 4; other texts in 64, with a deviation of 6.
REACH = 34
#: Spanning forests that a task of the first round keeps, each of the shortest links that those before have left.
FORESTS = 2
PRINTS = ["w0", "w1", "s0", "s1"]
#: Of the set of shingles: texts with the same are copies.
DIGEST = ["d0", "d1"]
PRINTED = pa.schema([("doc_id", pa.int64()), *[(p, pa.int64()) for p in DIGEST + PRINTS], ("size", pa.int64()), ("bands", pa.list_(pa.int64()))])
VISITED = pa.schema([("anchor", pa.int64()), ("home", pa.bool_()), ("s0", pa.int64()), ("s1", pa.int64()), ("node", pa.int64()), ("label", pa.int64())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
SETS = pa.schema([("d0", pa.int64()), ("d1", pa.int64()), ("shingles", pa.list_(pa.int64()))])
#: Bands of MinHash and hashes in each.
BANDS, ROWS = 32, 5
#: Texts and shingles of the rows and of the columns of a cell in which sets are compared.
CELL_TEXTS, CELL_SHINGLES = 1024, 1 << 20


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(words: list[bytes]) -> list[bytes]:
    if len(words) <= SHINGLE:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


def print_of(features: Iterable[bytes]) -> np.ndarray:
    """128 bits, each set if more than half of the hashes of the features have it; two signed numbers."""
    counts, features = np.zeros(128, np.int64), list(features)
    for at in range(0, len(features), 16_384):
        part = b"".join(map(xxhash.xxh3_128_digest, features[at : at + 16_384]))
        counts += np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 16), axis=1).sum(0, dtype=np.int32)
    return np.packbits(2 * counts > len(features)).view(np.int64)


def hashes_of(features: Iterable[bytes]) -> np.ndarray:
    """The set of the features, as sorted hashes."""
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, features), np.uint64))


def digest_of(hashes: np.ndarray) -> list[int]:
    return np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), np.int64).tolist()


#: Two fixed numbers for each hash of the bands.
SALTS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64)).reshape(2, -1, 1)


def bands_of(hashes: np.ndarray) -> list[int]:
    """A number for each band, the same if all smallest hashes in it are the same."""
    if not len(hashes):
        return []
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 4096):
        low = np.minimum(low, ((hashes[at : at + 4096] ^ SALTS[0]) * (SALTS[1] | np.uint64(1))).min(1))
    key = np.arange(BANDS, dtype=np.uint64)
    for column in low.reshape(BANDS, ROWS).T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) ^ column)
    return key.view(np.int64).tolist()


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` of every row, with the digest, size and bands of its set of shingles and the fingerprints of the sets of words and of shingles."""

    def one(doc_id, text):
        words = words_of(text)
        parts = set(shingles(words))
        hashes = hashes_of(parts)
        return doc_id, *digest_of(hashes), *print_of(set(words)).tolist(), *print_of(parts).tolist(), len(hashes), bands_of(hashes)

    def run(batches):
        return record_batches((one(*r) for r in rows(batches, "doc_id", "text")), PRINTED)

    ddl = ", ".join(f"{p} long" for p in ["doc_id", *DIGEST, *PRINTS, "size"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"{ddl}, bands array<long>")


def shortest(a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which links to keep: a spanning forest with the shortest ones (each tree takes its shortest link outwards, again and again)."""
    nodes, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = both[: len(a)], both[len(a) :]
    rank = np.empty(len(a), np.int64)
    rank[np.argsort(length, kind="stable")] = np.arange(len(a))
    by_rank = np.argsort(rank)
    root, kept = np.arange(len(nodes)), []
    while True:
        out = np.flatnonzero(root[x] != root[y])
        if not len(out):
            return np.unique(np.concatenate(kept)) if kept else np.empty(0, np.int64)
        best = np.full(len(nodes), len(a))
        np.minimum.at(best, root[x[out]], rank[out])
        np.minimum.at(best, root[y[out]], rank[out])
        chosen = by_rank[np.unique(best[best < len(a)])]
        kept.append(chosen)
        far, near = forest(root[x[chosen]], root[y[chosen]])
        to = np.arange(len(nodes))
        to[far] = near
        root = to[root]


def _links_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    n = 0

    def reduced() -> Iterator[pa.RecordBatch]:
        if held:
            a, b, x, y, length = (np.concatenate(c) for c in zip(*held))
            held.clear()
            nodes, both = np.unique(np.concatenate([a, b]), return_inverse=True)
            low, high = np.minimum(both[: len(a)], both[len(a) :]), np.maximum(both[: len(a)], both[len(a) :])
            _, left = np.unique(low * len(nodes) + high, return_index=True)  # a pair may meet often
            for _ in range(FORESTS):
                kept = shortest(x[left], y[left], length[left])
                yield pa.RecordBatch.from_arrays([pa.array(a[left[kept]]), pa.array(b[left[kept]])], schema=LINKS)
                left = np.delete(left, kept)

    for found, pairs in cells(batches, ["s0", "s1", "node", "label"]):
        s0, s1, nodes, labels = found["s0"].view(np.uint64), found["s1"].view(np.uint64), found["node"], found["label"]
        for left, right in pairs:
            length = np.bitwise_count(s0[left] ^ s0[right]).astype(np.int64) + np.bitwise_count(s1[left] ^ s1[right])
            near = (length <= REACH) & (labels[left] != labels[right])
            if near.any():
                left, right = left[near], right[near]
                held.append((nodes[left], nodes[right], labels[left], labels[right], length[near]))
                n += len(left)
            if n >= PAIRS:
                yield from reduced()
                n = 0
    yield from reduced()


def links(distinct: DataFrame) -> DataFrame:
    """Links to verify, ``a, b``, between nodes of different labels, from a table of distinct fingerprints with ``node, label``."""

    def copies(batches):
        tables = code_tables()
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                s0, s1, node, label = (part.column(c).to_numpy() for c in ("s0", "s1", "node", "label"))
                for half, name in enumerate(("w0", "w1")):
                    for out in visits(part.column(name).to_numpy().view(np.uint64), np.arange(part.num_rows), tables):
                        who = out.column("node").to_numpy()
                        anchor = out.column("anchor").to_numpy() + (half * len(BLOCKS) << 32)
                        columns = [pa.array(anchor), out.column("home"), *[pa.array(c[who]) for c in (s0, s1, node, label)]]
                        yield pa.RecordBatch.from_arrays(columns, schema=VISITED)

    ddl = "anchor long, home boolean, s0 long, s1 long, node long, label long"
    copied = distinct.select(*PRINTS, "node", "label").mapInArrow(copies, ddl)
    return in_grid(copied, ["s0", "s1", "node", "label"]).mapInArrow(_links_of, "a long, b long")


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, shingles`` of each text of ``node, doc_id, d0, d1``, where doc_id is one that has it."""

    def run(batches):
        def sets():
            for text, in rows(batches, "text"):
                hashes = hashes_of(shingles(words_of(text)))
                yield *digest_of(hashes), hashes.view(np.int64).tolist()

        return record_batches(sets(), SETS, 256)

    texts = docs.select(F.col("doc_id").cast("long"), "text").join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = texts.select("text").mapInArrow(run, "d0 long, d1 long, shingles array<long>").join(wanted.select("node", *DIGEST), DIGEST)
    return stage(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "shingles")


def verified(docs: DataFrame, distinct: DataFrame, found: DataFrame, least: float) -> DataFrame:
    """The links whose texts have sets of shingles that are alike enough."""
    found = stage(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    wanted = found.select(F.col("a").alias("node")).unionByName(found.select(F.col("b").alias("node"))).distinct()
    sets = sets_of(docs, distinct.select("node", "doc_id", *DIGEST).join(wanted, "node", "left_semi"))
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    alike = common >= F.lit(least) * (F.size("x") + F.size("y") - common)
    return found.join(first, "a").join(second, "b").where(alike).select("a", "b")


def groups(labelled: DataFrame) -> DataFrame:
    """``label, root``: classes that bands lead to from one to the other, without those that meet no other."""
    met = labelled.select("label", F.explode("bands").alias("band")).distinct()
    low = met.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    edges = met.join(low, "band").where("label <> low").select(F.col("label").alias("a"), F.col("low").alias("b"))
    return components(edges).select(F.col("node").alias("label"), F.col("component").alias("root"))


def _alike_in(label: np.ndarray, node: np.ndarray, home: np.ndarray, sets: list[np.ndarray], least: float) -> Iterator[tuple[int, int]]:
    """A spanning forest, over labels, of the links between homes and guests of a cell that are alike."""
    at, guests = np.flatnonzero(home), np.flatnonzero(~home)
    if not len(at) or not len(guests):
        return
    sizes = np.array([len(x) for x in sets])
    held = np.concatenate([sets[g] for g in guests])
    order = np.argsort(held, kind="stable")
    owner = np.repeat(np.arange(len(guests)), sizes[guests])[order]
    values, first = np.unique(held[order], return_index=True)
    ends = np.append(first[1:], len(held))
    _, root = np.unique(label, return_inverse=True)
    for i in at:
        if (root[guests] == root[i]).all():
            continue
        where = np.searchsorted(values, sets[i])
        where = where[(where < len(values)) & (values[np.minimum(where, len(values) - 1)] == sets[i])]
        n = ends[where] - first[where]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        common = np.bincount(owner[np.repeat(first[where], n) + within], minlength=len(guests))
        for g in guests[common >= least * (sizes[i] + sizes[guests] - common)]:
            if root[g] != root[i]:
                root[root == root[g]] = root[i]
                yield int(node[i]), int(node[g])


def _alike_of(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    def found():
        key, held = None, []
        for *cell, label, node, home, shingles_ in rows_of_sets(batches):
            if cell != key:
                yield from compared(held)
                key, held = cell, []
            held.append((label, node, home, shingles_))
        yield from compared(held)

    def compared(held):
        if held:
            label, node, home, sets = zip(*held)
            yield from _alike_in(np.array(label), np.array(node), np.array(home), sets, least)

    return record_batches(found(), LINKS)


def rows_of_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of cells, each with its set as an array."""
    for batch in batches:
        lists = batch.column("shingles")
        values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        plain = zip(*(batch.column(c).to_pylist() for c in ("root", "h", "v", "label", "node", "home")))
        for i, row in enumerate(plain):
            yield *row, values[offsets[i] : offsets[i + 1]].copy()


def alike_between(docs: DataFrame, labelled: DataFrame, least: float) -> DataFrame:
    """Links ``a, b`` that join the labels of texts into the same classes as all pairs that are alike and meet in bands do.

    In each group the texts of its largest class are guests, all others are homes and guests; each home meets each guest in one cell.
    """
    rooted = stage(labelled.join(groups(labelled), "label").select("root", "label", "node", "doc_id", *DIGEST, "size"), "rooted")
    each = rooted.groupBy("root", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s"))
    whole = each.groupBy("root").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.max(F.struct("n", "label", "s")).alias("most"))

    def cut(n, s):
        return F.greatest(F.ceil(n / CELL_TEXTS), F.ceil(s / CELL_SHINGLES), F.lit(1)).cast("int")

    grid = whole.select(
        "root", F.col("most.label").alias("largest"), cut(F.col("n") - F.col("most.n"), F.col("s") - F.col("most.s")).alias("hs"), cut(F.col("n"), F.col("s")).alias("vs")
    )
    placed = rooted.join(stage(grid, "grid"), "root").join(sets_of(docs, rooted), "node")
    columns = ["root", "label", "node", "shingles"]
    at = lambda k: F.pmod(F.xxhash64("node"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    as_home = placed.where("label <> largest").select(*columns, F.lit(True).alias("home"), at("hs").alias("h"), every("vs").alias("v"))
    as_guest = placed.select(*columns, F.lit(False).alias("home"), at("vs").alias("v"), every("hs").alias("h"))
    cells_ = as_home.unionByName(as_guest).repartition("root", "h", "v").sortWithinPartitions("root", "h", "v")
    return cells_.mapInArrow(lambda batches: _alike_of(batches, least), "a long, b long")


def near_copies(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``doc_id, component_id`` of each doc_id: the smallest one that links of near copies lead to."""
    found = stage(fingerprints(docs).where("doc_id IS NOT NULL"), "fingerprints")
    others = [F.first(c).alias(c) for c in [*PRINTS, "size", "bands"]]
    distinct = found.groupBy(*DIGEST).agg(F.min("doc_id").alias("doc_id"), *others)
    distinct = stage(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct")

    def labelled(edges):
        classes = stage(components(edges), "classes")
        return distinct.join(classes, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")

    first = stage(verified(docs, distinct, links(distinct.withColumn("label", F.col("node"))), least), "verified")
    edges = first.unionByName(stage(alike_between(docs, labelled(first), least), "alike"))
    named = stage(labelled(edges).select(*DIGEST, "label", "doc_id"), "named")
    low = named.groupBy("label").agg(F.min("doc_id").alias("low"))
    lows = stage(named.join(low, "label").select(*DIGEST, "low"), "lows")
    pairs = found.select("doc_id", *DIGEST).join(lows, DIGEST).where("doc_id <> low")
    classes = components(pairs.select(F.col("doc_id").alias("a"), F.col("low").alias("b")))
    return found.select("doc_id").distinct().join(classes.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", F.coalesce("component", "doc_id").alias("component_id")
    )
