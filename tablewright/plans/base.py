"""The table most queries read: one row per order with its customer, nation and order-line summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import Catalog
from ..sources.readers import table
from ..storage import stage

KEY = "id"
TARGET = "sum_price"
NUMERIC = ["n_lines", "sum_qty", "avg_disc", "o_totalprice", "c_acctbal"]

CATALOG = Catalog(
    roles={
        "numeric continuous": ["o_totalprice", "c_acctbal", "sum_qty", "avg_disc"],
        "numeric count": ["n_lines"],
        "ordinal": ["o_orderpriority"],
        "nominal": ["n_name", "c_mktsegment", "o_orderstatus", "top_flag"],
        "binary": ["has_return"],
        "special": ["o_month", "o_year"],
        "target": [TARGET],
        "id": [KEY],
    },
    treatments={
        "numeric continuous": "standard scale",
        "numeric count": "standard scale",
        "ordinal": "ordinal codes",
        "nominal": "one column per level",
        "binary": "map to 0 and 1",
        "special": "text, then one column per level",
        "target": "log1p",
        "id": "dropped",
    },
    ordinal_levels={"o_orderpriority": ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]},
    binary_maps={"has_return": {"1": 1, "0": 0}},
)


def build_base(spark: SparkSession, folder: str) -> DataFrame:
    """Lines are summed per order before the join, so an order with very many lines is one row."""
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum("l_quantity").alias("sum_qty"),
            F.sum("l_extendedprice").alias("sum_price"),
            F.avg("l_discount").alias("avg_disc"),
            F.min("l_returnflag").alias("top_flag"),
            F.max((F.col("l_returnflag") == "R").cast("int")).alias("has_return"),
        )
    )
    orders, customer, nation = (table(spark, folder, t) for t in ("orders", "customer", "nation"))
    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    )
    return joined.select(
        F.col("o_orderkey").alias(KEY),
        "o_totalprice",
        "o_orderpriority",
        "o_orderstatus",
        "c_mktsegment",
        "n_name",
        "c_acctbal",
        F.year("o_orderdate").alias("o_year"),
        F.month("o_orderdate").alias("o_month"),
        "n_lines",
        "sum_qty",
        "sum_price",
        "avg_disc",
        "top_flag",
        F.coalesce("has_return", F.lit(0)).alias("has_return"),
    )


_staged: dict[tuple, DataFrame] = {}


def base(spark: SparkSession, folder: str) -> DataFrame:
    """The base table, joined and written once per application and set of source files, read by every diagnostic."""
    built = build_base(spark, folder)
    key = (spark.sparkContext.applicationId, folder, *sorted(built.inputFiles()))
    if key not in _staged:
        _staged[key] = stage(built, "base", even=True)
    return _staged[key]


def split_by_time(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train before 2000, test from 2000 on (two years that train has never seen)."""
    return df.filter(F.col("o_year") < 2000), df.filter(F.col("o_year") >= 2000).drop(TARGET)
