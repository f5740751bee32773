"""Splits that depend on the row key only, not on partitioning or row order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import col
from ..storage import stage


def key_hash(key: str, seed: int | None = None) -> Column:
    """32 bits of the MD5 of the key, the same in every engine."""
    text = col(key).cast("string") if seed is None else F.concat_ws(":", F.lit(str(seed)), col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def with_validation(df: DataFrame, key: str, percent: int = 20, seed: int | None = None, name: str = "is_valid") -> DataFrame:
    """1 for the held-out share of the rows."""
    return df.withColumn(name, (F.pmod(key_hash(key, seed), F.lit(100)) < percent).cast("int"))


def with_fold(df: DataFrame, key: str, folds: int = 5, seed: int | None = None, name: str = "fold") -> DataFrame:
    """Shuffled folds 0..folds-1."""
    return df.withColumn(name, F.pmod(key_hash(key, seed), F.lit(folds)).cast("int"))


def fold_starts(rows: int, folds: int) -> list[int]:
    """First position of folds 1..folds-1 when the first ``rows % folds`` folds hold one row more."""
    sizes = [rows // folds + (1 if i < rows % folds else 0) for i in range(folds)]
    return [sum(sizes[:i]) for i in range(1, folds)]


def with_contiguous_fold(df: DataFrame, key: str, folds: int = 5, name: str = "fold") -> DataFrame:
    """Folds of consecutive keys of equal size, without sorting the table in one task.

    Keys of any type that has an order, taken as they are. They are dealt out by range and written with the number of
    their range; the sizes of the ranges tell which ones hold the borders, and only these are numbered.
    Each row then compares its key with the few borders. A null key is in fold 0.
    """
    keys = df.select(col(key).alias("key")).where("key IS NOT NULL").repartitionByRange("key")
    placed = stage(keys.withColumn("range", F.spark_partition_id()), "keys")
    sizes = {r["range"]: r["n"] for r in placed.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted, before = [], 0
    starts = fold_starts(sum(sizes.values()), folds)
    for number in sorted(sizes):
        wanted += [(number, s - before + 1) for s in starts if before <= s < before + sizes[number]]
        before += sizes[number]
    if not wanted:
        return df.withColumn(name, F.lit(0))
    place = F.row_number().over(Window.partitionBy("range").orderBy("key"))
    numbered = placed.where(F.col("range").isin([r for r, _ in wanted])).withColumn("place", place)
    at = reduce(lambda a, b: a | b, [(F.col("range") == r) & (F.col("place") == p) for r, p in wanted])
    found = {(r["range"], r["place"]): r["key"] for r in numbered.where(at).collect()}
    kind = df.select(col(key)).schema[0].dataType
    above = [F.coalesce(col(key) >= F.lit(found[w]).cast(kind), F.lit(False)).cast("int") for w in wanted]
    return df.withColumn(name, reduce(lambda a, b: a + b, above))
