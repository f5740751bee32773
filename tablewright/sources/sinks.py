"""Table sinks. Each overwrites only the dataset it names."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import blank_to_null, col
from .readers import BLANK_ONLY, CSV_FORMAT, read_csv


def write_result(df: DataFrame, folder: str, name: str, fmt: str = "parquet") -> str:
    """Write one named result. Parquet keeps the text ``None`` apart from null; CSV does not."""
    path = f"{folder}/{name}.{fmt}"
    writer = df.write.mode("overwrite").format(fmt)
    (writer.options(**CSV_FORMAT) if fmt == "csv" else writer).save(path)
    return path


def write_results(results: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    return {name: write_result(df, folder, name, fmt) for name, df in results.items()}


def replace_table(df: DataFrame, table: str) -> None:
    """Replace a catalogue table; empty text becomes null, every other text stays.

    The rows are written aside first and the new table takes the name last, so the old one may be read while it is
    replaced, also by ``df`` itself, and stays whole if writing fails.
    """
    text = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    cleaned = df.select(*[(blank_to_null(col(c)) if c in text else col(c)).alias(c) for c in df.columns])
    spark, aside = df.sparkSession, f"{table}_{uuid4().hex}"
    cleaned.write.saveAsTable(aside)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")


def load_csv_into_table(spark: SparkSession, path: str, table: str) -> None:
    """CSV to table, keeping tokens such as ``NA`` as text."""
    replace_table(read_csv(spark, path, na_tokens=BLANK_ONLY), table)


def scored(df: DataFrame, key: str, prediction: Column | str, name: str = "prediction", log_scale: bool = True) -> DataFrame:
    """``(key, prediction)`` on the original scale."""
    p = col(prediction) if isinstance(prediction, str) else prediction
    return df.select(col(key), (F.expm1(p) if log_scale else p).alias(name))
