"""Summary of many result tables in one long table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import col
from ..operators.shaping import top_k, union_all


def summary_report(results: Mapping[str, tuple[DataFrame, str, str]], k: int = 10) -> DataFrame:
    """``(section, rank, key, value)``: the k largest values of each ``(table, key, value)``."""
    out = []
    for section, (df, key, value) in results.items():
        rows = df.select(col(key).cast("string").alias("key"), col(value).cast("double").alias("value"))
        out.append(top_k(rows, k, "value", "key").select(F.lit(section).alias("section"), "*"))
    order = Window.partitionBy("section").orderBy(F.desc_nulls_last("value"), "key")
    return union_all(out).select("section", F.row_number().over(order).alias("rank"), "key", "value")


def as_markdown(report: DataFrame, title: str, digits: int = 4) -> DataFrame:
    """``(line_no, line)``: the report as Markdown lines; write it with the text writer."""
    heading = F.when(F.col("rank") == 1, F.concat(F.lit("\n## "), F.col("section"), F.lit("\n\n"))).otherwise(F.lit(""))
    item = F.concat(heading, F.lit("- "), F.col("key"), F.lit(": "), F.coalesce(F.format_number("value", digits), F.lit("")))
    lines = report.select("section", "rank", item.alias("line"))
    first = report.sparkSession.createDataFrame([("", 0, f"# {title}")], "section string, rank int, line string")
    return first.unionByName(lines).orderBy("section", "rank")
