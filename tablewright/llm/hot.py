"""Joins on keys of which some hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with at least one row in so many is hot, so there are at most so many.
HOT_SHARE = 200


def join_unique(many: DataFrame, unique: DataFrame, on: list[str], weight: str, total: int) -> DataFrame:
    """Inner join with a table of one row per key, where ``weight`` says how many of the ``total`` rows of ``many`` the key has.

    Rows of hot keys are not shuffled: what is known of these keys, at most ``HOT_SHARE`` rows, is broadcast. Both tables are read twice, so
    they should be written ones.
    """
    is_hot = F.col(weight) * HOT_SHARE >= total
    plain = unique.drop(weight)
    if total < HOT_SHARE or unique.where(is_hot).isEmpty():
        return many.join(plain, on)
    hot = F.broadcast(unique.where(is_hot).drop(weight))
    cold = many.join(F.broadcast(unique.where(is_hot).select(on)), on, "left_anti")
    return many.join(hot, on).unionByName(cold.join(unique.where(~is_hot).drop(weight), on))


#: Bits of the filter that ``likely_in`` broadcasts, at most (as 64-bit words).
FILTER_BITS = 1 << 25


def likely_in(rows: DataFrame, ids: DataFrame, name: str, n: int) -> DataFrame:
    """Rows whose ``name`` hashes like one of the ``n`` values in ``ids``: all that are in it and, up to two million values, few others.

    Goes before an exact semi join, so that rows with long texts aren't shuffled only to be dropped. The filter has a fixed size at most.
    """
    bits = min(FILTER_BITS, 1 << max(10, (16 * n).bit_length()))
    slot = F.pmod(F.xxhash64(name), F.lit(bits))
    place = (slot % 64).cast("int")
    words = ids.select(F.expr("0L") + F.floor(slot / 64).alias("_word"), F.expr("1L").alias("_one"), place.alias("_place"))
    words = words.toDF("_word", "_one", "_place").groupBy("_word").agg(F.bit_or(F.expr("shiftleft(_one, _place)")).alias("_bits"))
    tested = rows.withColumn("_word", F.expr("0L") + F.floor(slot / 64)).join(F.broadcast(words), "_word")
    return tested.where(F.getbit("_bits", place) == 1).drop("_word", "_bits")
