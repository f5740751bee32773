"""A manifest of a table of documents as a tree of hashes, with a proof for each document.

The documents of a language, in order of doc_id, are the leaves of a tree in which every eight neighbours become one node; the
roots of the languages are the leaves of one more tree of this kind, and its root stands for the whole table. Digests are SHA-256 in
lower-case hex text, and a node is the digest of the joined digests of its run.

Leaves are sorted by range partitions, which get their places from counts of rows per range. They are put together in parts of
4,096 neighbours, four levels of the tree, so that a part gives one node to the next round: two rounds serve 16 million leaves of a language,
three 68 thousand million. No language is too large for that, as its leaves are spread over its parts.

Proofs are made per part (an octopus multiproof). A part holds some leaves; the nodes it lacks on their ways to the root, each once, are
found from places alone and fetched with one join. All else is derived in the part, and every proof is read off the nodes it then has.
Where the whole table is proved, a part lacks no node below its own, so only few coordinates are fetched.

Defined cases: nulls are written as ``-``, also in doc_id and lang; a null lang is a language of its own, before all others; rows that
share a doc_id are leaves of their own, in order of their digests; a null doc_id comes first and is never tampered with; empty and very long texts are
hashed whole; a lone leaf is its language's root; an empty table has no leaves and no root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import pin_small, stage
from .words import record_batches

#: Nodes of a run, and levels that a part spans.
RUN, LEVELS = 8, 4
PART = RUN**LEVELS

NODES = pa.schema([("tree", pa.int64()), ("width", pa.int64()), ("level", pa.int32()), ("pos", pa.int64()), ("digest", pa.binary())])
LACKING = pa.schema([("tree", pa.int64()), ("part", pa.int64()), ("level", pa.int32()), ("pos", pa.int64())])
#: Steps of a proof from the leaf upwards: the joined digests of the neighbours to the left and to the right.
PROOF = "array<struct<left: string, right: string>>"


def field(value: Column) -> Column:
    """A value with its length in bytes before it, so that no two rows are written alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def document_leaf(text: Column | None = None) -> Column:
    """The leaf of a row of documents, with its own text or another."""
    return leaf(*map(F.col, ("doc_id", "source", "lang", "n_chars")), F.col("text") if text is None else text)


def parent_of(run: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(run).hex().encode()).digest()


def parents_of(digests: list[bytes]) -> list[bytes]:
    return [parent_of(digests[i : i + RUN]) for i in range(0, len(digests), RUN)]


def positioned(df: DataFrame, tree: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``pos``, the place of each row in its tree, without sorting a tree in one task."""
    dealt = df.repartitionByRange(*tree, *order).sortWithinPartitions(*tree, *order)
    placed = stage(dealt.withColumn("_at", F.monotonically_increasing_id()), "placed")
    keys = [F.col(c) for c in tree]
    runs = placed.groupBy(*keys, F.shiftright("_at", 33).alias("_range")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    starts = pin_small(runs.select(*[c.alias(f"_{n}") for c, n in zip(keys, tree)], "_range", (F.col("_first") - before).alias("_zero")))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in tree], F.shiftright("_at", 33) == F.col("_range"))
    return placed.join(starts, same).select(*df.columns, (F.col("_at") - F.col("_zero")).alias("pos"))


def in_parts(leaves: DataFrame) -> DataFrame:
    """``tree, width, part, leaves``: at most ``PART`` neighbours each, from ``tree, width, pos, digest`` and further columns of leaves."""
    part, own = F.expr(f"pos div {PART}").alias("part"), ["pos", "digest"]
    own += [c for c in leaves.columns if c not in ("tree", "width", *own)]
    return leaves.groupBy("tree", "width", part).agg(F.sort_array(F.collect_list(F.struct(*own))).alias("leaves"))


def _parts(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Parts with the named lists of structs as Arrow arrays."""
    for batch in batches:
        for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in ("tree", "width", "part")))):
            yield *key, *(batch.column(n).slice(i, 1).flatten() for n in names)


def climbed(level: int):
    """For each part the nodes above it, up to the one that stands for it."""

    def run(batches):
        def nodes():
            for tree, width, part, leaves in _parts(batches, "digests"):
                digests, at = leaves.to_pylist(), part * PART
                if width == 1:
                    yield tree, 1, level, 0, digests[0]
                for step in range(1, LEVELS + 1):
                    if width == 1:
                        break
                    digests, width, at = parents_of(digests), -(-width // RUN), at // RUN
                    for i, digest in enumerate(digests):
                        yield tree, width, level + step, at + i, digest

        return record_batches(nodes(), NODES)

    return run


@dataclass
class Forest:
    """Trees: their leaves in parts, all nodes above (``tree, width, level, pos, digest``), and the roots."""

    parts: DataFrame
    nodes: DataFrame
    roots: DataFrame


def forest(leaves: DataFrame) -> Forest:
    """Trees over ``tree, width, pos, digest``; other columns stay with the leaves."""
    parts = stage(in_parts(leaves), "parts")
    found, now, level = [], parts, 0
    while True:
        digests = now.select("tree", "width", "part", F.col("leaves.digest").alias("digests"))
        up = digests.mapInArrow(climbed(level), "tree long, width long, level int, pos long, digest binary")
        found.append(stage(up, "nodes"))
        level += LEVELS
        rest = found[-1].where((F.col("level") == level) & (F.col("width") > 1))
        if rest.isEmpty():
            break
        now = in_parts(rest)
    nodes = reduce(DataFrame.unionByName, found)
    return Forest(parts, nodes, nodes.where("width = 1").select("tree", "digest"))


def lacking(at: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per level the places of nodes that leaves ``at`` (ascending) need and cannot derive: the smallest union over all of them."""
    level = 0
    while width > 1:
        above = np.unique(at // RUN)
        run = (above[:, None] * RUN + np.arange(RUN)).ravel()
        yield level, np.setdiff1d(run[run < width], at, assume_unique=True)
        at, width, level = above, -(-width // RUN), level + 1


def _lacking_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found():
        for tree, width, part, at in _parts(batches, "at"):
            for level, places in lacking(at.to_numpy(), width):
                yield from ((tree, part, level, p) for p in places.tolist())

    return record_batches(found(), LACKING)


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tree, width, _, leaves, fetched in _parts(batches, "leaves", "fetched"):
        places = leaves.field("pos").to_pylist()
        known: dict[int, dict[int, bytes]] = {0: dict(zip(places, leaves.field("digest").to_pylist()))}
        for level, pos, digest in zip(*(fetched.field(c).to_pylist() for c in ("level", "pos", "digest"))):
            known.setdefault(level, {})[pos] = digest
        levels, at = [], places
        while width > 1:
            now, above = known[len(levels)], known.setdefault(len(levels) + 1, {})
            steps, at = {}, sorted({p // RUN for p in at})
            for p in at:
                run = [now[i] for i in range(p * RUN, min(width, (p + 1) * RUN))]
                above[p], text = parent_of(run), b"".join(run).hex()
                for i in range(len(run)):
                    steps[p * RUN + i] = text[: 64 * i], text[64 * i + 64 :]
            levels.append(steps)
            width = -(-width // RUN)
        of_all = [steps[p // RUN**i] for p in places for i, steps in enumerate(levels)]
        sides = [pa.array([s[k] for s in of_all], pa.string()) for k in (0, 1)]
        ends = pa.array(np.arange(len(places) + 1, dtype=np.int32) * len(levels))
        proof = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(sides, ["left", "right"]))
        own = dict(zip(leaves.type.names, leaves.flatten()))
        same = {"tree": pa.array([tree] * len(places)), "top": pa.array([known[len(levels)][0].hex()] * len(places))}
        yield pa.RecordBatch.from_pydict(same | own | {"proof": proof})


def proofs(trees: Forest, wanted: DataFrame | None = None) -> DataFrame:
    """``tree, top, pos, digest``, what the leaves carry and ``proof``, of all leaves or of those in ``wanted`` (``tree, pos``).

    ``top`` is the root as the part derives it.
    """
    nodes, parts = trees.nodes.select("tree", "level", "pos", "digest"), trees.parts
    if wanted is None:
        nodes = nodes.where(F.col("level") >= LEVELS)  # what is below, a whole part derives itself
    else:
        whole = parts.select("tree", "width", F.inline("leaves"))
        nodes = nodes.unionByName(whole.select("tree", F.lit(0).alias("level"), "pos", "digest"))
        parts = in_parts(whole.join(wanted.select("tree", "pos").distinct(), ["tree", "pos"], "left_semi"))
    needed = parts.select("tree", "width", "part", F.col("leaves.pos").alias("at"))
    needed = needed.mapInArrow(_lacking_of, "tree long, part long, level int, pos long")
    key, high = ["tree", "level", "pos"], F.col("level") >= 2 * LEVELS
    # Nodes near the root are wanted by very many parts, and there are few of them.
    fetched = needed.where(~high).join(nodes.where(~high), key).unionByName(needed.where(high).join(pin_small(nodes.where(high)), key))
    fetched = fetched.groupBy("tree", "part").agg(F.collect_list(F.struct("level", "pos", "digest")).alias("fetched"))
    none = F.array().cast("array<struct<level: int, pos: bigint, digest: binary>>")
    full = parts.join(fetched, ["tree", "part"], "left").withColumn("fetched", F.coalesce("fetched", none))
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema["leaves"].dataType.elementType)
    return full.mapInArrow(_expanded, f"tree long, top string, {own}, proof {PROOF}")


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, start, lambda now, step: F.sha2(F.concat(step["left"], now, step["right"]), 256))


@dataclass
class Manifest:
    """The trees of the languages, whose leaves have ``doc_id, lang`` and what was carried along, and the tree over their roots."""

    languages: Forest
    table: Forest


def manifest(docs: DataFrame, carried: dict[str, Column] | None = None) -> Manifest:
    """The tree of ``docs`` (``doc_id, source, lang, n_chars, text``); texts are read once and not shuffled."""
    more = [c.alias(n) for n, c in (carried or {}).items()]
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.unhex(document_leaf()).alias("digest"), *more)
    placed = positioned(rows, ["lang"], ["doc_id", "digest"])
    sizes = positioned(placed.groupBy("lang").agg(F.count(F.lit(1)).alias("width")), [], ["lang"])
    trees = stage(sizes.select(F.col("lang").alias("_lang"), "width", F.col("pos").alias("tree")), "trees")
    below = forest(placed.join(pin_small(trees), F.col("lang").eqNullSafe(F.col("_lang"))).drop("_lang"))
    n = F.lit(trees.count()).cast("long").alias("width")
    above = forest(below.roots.select(F.lit(0).cast("long").alias("tree"), n, F.col("tree").alias("pos"), "digest"))
    return Manifest(below, above)


def proved(made: Manifest) -> DataFrame:
    """The leaves with ``subroot, root`` and the ``proof`` of each, through its language's root to the root."""
    upper = proofs(made.table).select(F.col("pos").alias("tree"), F.col("top").alias("root"), F.col("proof").alias("_upper"))
    joined = proofs(made.languages).withColumnRenamed("top", "subroot").join(pin_small(upper), "tree")
    return joined.withColumn("proof", F.concat("proof", "_upper")).drop("_upper")


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = F.translate("text", ascii_uppercase, ascii_lowercase)
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    out = proved(manifest(docs, {"tampered": F.when(hit, document_leaf(plain))}))
    own = F.lower(F.hex("digest"))
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    out = out.select("doc_id", own.alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded(F.coalesce("tampered", own), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


OP13_SQL = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, text,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS plain,
         list_reduce(
           list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 1, 2, 3, 4, 5, 6, 7]),
             lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(head || coalesce(strlen(plain) || ':' || plain, '-')) END AS tampered
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS width FROM leaves
), nodes AS (
  SELECT lang, width, 0 AS level, pos, leaf AS h FROM placed
  UNION ALL
  SELECT lang, (width + 7) // 8, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE width > 1 GROUP BY lang, width, level, pos // 8
), subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS width FROM nodes WHERE width = 1
), tops AS (
  SELECT width, 0 AS level, pos, h FROM subroots
  UNION ALL
  SELECT (width + 7) // 8, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE width > 1 GROUP BY width, level, pos // 8
), sides AS (
  SELECT lang, level, pos,
         coalesce(string_agg(h, '') OVER (PARTITION BY lang, level, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (PARTITION BY lang, level, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM nodes WHERE width > 1
), top_sides AS (
  SELECT level, pos,
         coalesce(string_agg(h, '') OVER (PARTITION BY level, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (PARTITION BY level, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM tops WHERE width > 1
), steps AS (
  SELECT p.lang, p.pos, s.level, s.l, s.r
  FROM placed p JOIN sides s ON s.lang IS NOT DISTINCT FROM p.lang AND s.pos = p.pos // CAST(pow(8, s.level) AS BIGINT)
  UNION ALL
  SELECT p.lang, p.pos, 1000 + s.level, s.l, s.r
  FROM placed p JOIN subroots u ON u.lang IS NOT DISTINCT FROM p.lang JOIN top_sides s ON s.pos = u.pos // CAST(pow(8, s.level) AS BIGINT)
), proofs AS (
  SELECT lang, pos, list({'l': l, 'r': r} ORDER BY level) AS proof FROM steps GROUP BY lang, pos
), joined AS (
  SELECT p.*, u.h AS subroot, (SELECT h FROM tops WHERE width = 1) AS root, coalesce(f.proof, []) AS proof
  FROM placed p JOIN subroots u ON u.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN proofs f ON f.lang IS NOT DISTINCT FROM p.lang AND f.pos = p.pos
), folded AS (
  SELECT *, list_reduce(list_concat([{'l': coalesce(tampered, leaf), 'r': ''}], proof), lambda a, s: {'l': sha256(s.l || a.l || s.r), 'r': ''}).l AS folded_root
  FROM joined
)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_concat([''], list_transform(proof, lambda s: s.l || s.r)), 'string_agg', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
"""
