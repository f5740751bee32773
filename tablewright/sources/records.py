"""Records of CSV files whose cells may hold line breaks, read by many tasks.

A file is split at any byte, so a task can't know whether its range starts inside a quoted cell. A first scan counts the quotes
of every range; an odd number of them before a range means that it starts inside. With that each task puts its lines together to records. What
reaches over the border of a range, at most two pieces of it, is put together afterwards. Quotes inside quoted cells are written twice, so
they don't change the parity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import stage

#: Ranges that start inside a cell, at most; one row of a few bytes for each is sent to all tasks.
MOST_OPEN = 5_000_000

#: What a piece is: a record, or one that began in an earlier range (END), goes on in the next (BEGIN), or both (MIDDLE); the first of a file is its header.
RECORD, END, MIDDLE, BEGIN, HEADER = range(5)
PIECES = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("record", pa.string())])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.input_file_name().alias("file"), F.input_file_block_start().alias("start"), "value")


def _pieces(batches: Iterator[pa.RecordBatch], border: bool) -> Iterator[pa.RecordBatch]:
    """Pieces of ranges, one range after the other: those inside a range, or those at its borders."""
    at, inside, held = None, False, []  # the range, whether a cell is open, lines of a record that isn't whole
    kind = RECORD

    def out(records, kinds):
        n = len(records)
        wanted = [k in (END, MIDDLE, BEGIN) if border else k in (RECORD, HEADER) for k in kinds]
        columns = [pa.array([at[0]] * n), pa.array([at[1]] * n, pa.int64()), pa.array(kinds, pa.int32()), pa.array(records, pa.string())]
        return pa.RecordBatch.from_arrays(columns, schema=PIECES).filter(pa.array(wanted, pa.bool_()))

    def rest():
        return out(["\n".join(held)], [MIDDLE if kind == END else BEGIN]) if held else None

    for batch in batches:
        keys = list(zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()))
        new = [i for i in range(len(keys)) if keys[i] != (keys[i - 1] if i else at)]
        for first, last in zip(sorted({0, *new}), [*[i for i in new if i], len(keys)]):
            part = batch.slice(first, last - first)
            if not part.num_rows:
                continue
            if keys[first] != at:
                if (piece := rest()) is not None:
                    yield piece
                at, held = keys[first], []
                inside = bool(part.column("inside")[0].as_py())
                kind = END if inside else HEADER if at[1] == 0 else RECORD
            quotes = pc.count_substring(part.column("value"), '"').to_numpy() % 2
            after = (np.cumsum(quotes) + inside) % 2 == 1
            lines = part.column("value").to_pylist()
            records, kinds, begin = [], [], 0
            for end in np.flatnonzero(~after).tolist():
                records.append("\n".join([*held, *lines[begin : end + 1]]))
                kinds.append(kind)
                held, begin, kind = [], end + 1, RECORD
            held += lines[begin:]
            inside = bool(after[-1])
            yield out(records, kinds)
    if (piece := rest()) is not None:
        yield piece


def csv_records(spark: SparkSession, path: str) -> tuple[str | None, DataFrame]:
    """The header, and ``record`` of every other record of the files, as text; blank lines are no records.

    Files with ends of line of both kinds are read alike. Nothing is collected but the header.
    """
    lines = _lines(spark, path)
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"')))
    ranges = lines.groupBy("file", "start").agg(F.pmod(F.sum(quotes), F.lit(2)).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("file", "start", "odd", F.pmod(F.coalesce(F.sum("odd").over(before), F.lit(0)), F.lit(2)).alias("inside"))
    ranges = stage(ranges.where("odd + inside > 0"), "ranges")
    seen = ranges.agg(F.count_if(F.col("inside") == 1).alias("n"), F.count_if((F.col("odd") + F.col("inside")) % 2 == 1).alias("cut")).first()
    if seen["n"] > MOST_OPEN:
        raise ValueError("too many ranges start inside a cell: raise spark.sql.files.maxPartitionBytes")
    open_ = F.broadcast(ranges.where("inside = 1").select("file", "start", "inside"))
    placed = lines.join(open_, ["file", "start"], "left").select("file", "start", F.coalesce("inside", F.lit(0)).alias("inside"), "value")
    ddl = "file string, start long, kind int, record string"
    bare = F.rtrim(F.col("record"), F.lit("\r"))

    inner = placed.mapInArrow(lambda batches: _pieces(batches, False), ddl)
    header = _header(spark, path)
    records = inner.where(F.col("kind") == RECORD).select("record")
    if seen["cut"]:
        pieces = placed.mapInArrow(lambda batches: _pieces(batches, True), ddl)
        # A range gives its END or MIDDLE before its BEGIN, and all up to the next BEGIN belong together.
        order = Window.partitionBy("file").orderBy("start", "kind")
        numbered = pieces.withColumn("at", F.count_if(F.col("kind") == BEGIN).over(order))
        joined = numbered.groupBy("file", "at").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "record"))).alias("parts"))
        records = records.unionByName(joined.select(F.array_join("parts.record", "\n").alias("record")))
    return header, records.select(bare.alias("record")).where("record <> ''")


def _header(spark: SparkSession, path: str) -> str | None:
    """The first record of the files; a header is taken to lie in the first range of its file."""
    first = _lines(spark, path).where("start = 0").limit(1000).toLocalIterator()
    held: list[str] = []
    for row in first:
        held.append(row.value)
        if "\n".join(held).count('"') % 2 == 0:
            return "\n".join(held).removeprefix("﻿").rstrip("\r")
    return None
