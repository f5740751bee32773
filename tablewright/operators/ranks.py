"""Average ranks and Spearman correlation without a global sort in one task.

Rows are reduced to counts of their distinct pairs of values first; only these are ranked, joined and shuffled, and the correlation is
one of pairs with weights.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clean_number, col, safe_ratio
from ..storage import stage
from .frequency import cut_points, positions, with_ranges
from .missing import missing_columns

#: Least value of ``hot_share``.
HOT_SHARE = 64


def hot_share(df: DataFrame) -> int:
    """A value is hot when it holds more than one in this many rows of its group, so a group has fewer hot values than this.

    It follows the number of shuffle partitions: what is not hot fills half a partition at most.
    """
    return max(HOT_SHARE, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def rank_table(pairs: DataFrame) -> DataFrame:
    """``(feature, side, value, rank, hot)``: average rank of every distinct value of both sides, and by how much it exceeds the mean rank.

    Written once, as the joins below read it several times. The mean rank is known, so that nothing cancels in the sums.
    """
    x = F.struct(F.lit("x").alias("side"), "feature", F.col("xr").alias("rng"), F.col("x").alias("value"))
    y = F.struct(F.lit("y").alias("side"), F.col("y_feature").alias("feature"), F.col("yr").alias("rng"), F.col("y").alias("value"))
    sides = F.when(F.col("ranks_y"), F.array(x, y)).otherwise(F.array(x))
    values = pairs.select("n", F.inline(sides)).groupBy("side", "feature", "rng", "value").agg(F.sum("n").alias("n"))
    rank = F.struct((F.col("before") + (F.col("n") + 1) / 2.0).alias("rank"), (F.col("before") + (F.col("n") - F.col("total")) / 2.0).alias("off"))
    ranked = positions(values, ["side"]).select(
        "feature",
        "side",
        "value",
        rank.alias("rank"),
        (F.col("n") * hot_share(pairs) > F.col("total")).alias("hot"),
    )
    return stage(ranked, "ranks")


def attach_average_ranks(pairs: DataFrame, ranked: DataFrame, side: str, feature: str, name: str) -> DataFrame:
    """Add the average rank of one side.

    Hot values, fewer than ``hot_share`` per feature by their definition, are broadcast; their
    rows are then spread over the shuffle of the others, where they match nothing, so that no
    task gets all rows of a hot value.
    """
    one = ranked.filter(F.col("side") == side).withColumnsRenamed({"value": side, "feature": feature})
    hot = F.broadcast(one.filter("hot").select(feature, side, F.col("rank").alias("hot_rank")))
    cold = one.filter(~F.col("hot")).select(
        feature, side, F.lit(0).cast("long").alias("slot"), F.col("rank").alias("cold_rank")
    )
    slot = F.when(F.col("hot_rank").isNull(), F.lit(0).cast("long")).otherwise(F.monotonically_increasing_id() % 1024 + 1)
    return (
        pairs.join(hot, [feature, side], "left")
        .withColumn("slot", slot)
        .join(cold, [feature, side, "slot"], "left")
        .withColumn(name, F.coalesce("hot_rank", "cold_rank"))
        .drop("slot", "hot_rank", "cold_rank")
    )


def rank_pairs(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``(feature, x, y, rx, ry)``: ranks over the complete pairs of each feature with the target, a row for each."""
    each = F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")
    ranked = ranked_pairs(df, features, target)
    return ranked.select("feature", "x", "y", F.col("rx.rank").alias("rx"), F.col("ry.rank").alias("ry"), each).drop("copy")


def ranked_pairs(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``(feature, x, y, n, rx, ry)``: the distinct complete pairs of each feature with the target, their rows, and the ranks of both sides
    (``rank``, and ``off``, its distance from the mean rank).

    Features without gaps share one ranking of the target.
    """
    names = [f"v{i}" for i in range(len(features))] + ["y"]
    narrow = df.select(
        *[clean_number(col(c)).alias(a) for c, a in zip([*features, target], names)]
    ).filter(F.col("y").isNotNull())
    gaps = set(missing_columns(narrow, names[:-1]))
    shared = [c for a, c in zip(names, features) if a not in gaps]
    ranged = with_ranges(narrow, names, cut_points(narrow, names))
    parts = [p for a, c in zip(names, features) for p in (F.lit(c), F.col(a), F.col(f"{a}__range").cast("int"))]
    in_shared = F.col("feature").isin(shared)
    pairs = (
        ranged.select(
            "y", F.col("y__range").cast("int").alias("yr"), F.stack(F.lit(len(features)), *parts).alias("feature", "x", "xr")
        )
        .filter(F.col("x").isNotNull())
        .withColumn("y_feature", F.when(in_shared, F.lit(shared[0] if shared else None)).otherwise(F.col("feature")))
        .withColumn("ranks_y", F.col("y_feature") == F.col("feature"))
    )
    pairs = stage(pairs.groupBy(*pairs.columns).agg(F.count(F.lit(1)).alias("n")), "pairs")
    ranked = rank_table(pairs)
    placed = attach_average_ranks(pairs, ranked, "x", "feature", "rx")
    return attach_average_ranks(placed, ranked, "y", "y_feature", "ry").select("feature", "x", "y", "n", "rx", "ry")


def spearman(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``(feature, n, spearman)``: Pearson correlation of the average ranks, nulls left out per pair."""
    ranked = ranked_pairs(df, features, target)
    x, y, n = F.col("rx.off"), F.col("ry.off"), F.col("n")
    spread = F.sqrt(F.sum(n * x * x)) * F.sqrt(F.sum(n * y * y))
    found = ranked.groupBy("feature").agg(F.sum("n").alias("n"), safe_ratio(F.sum(n * x * y), spread).alias("spearman"))
    listed = df.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    return listed.join(found, "feature", "left").select("feature", F.coalesce("n", F.lit(0)).alias("n"), "spearman")


def spearman_ranking(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``(feature, n, spearman)``, largest first, undefined ones last."""
    return spearman(df, features, target).orderBy(F.desc_nulls_last("spearman"), "feature")
