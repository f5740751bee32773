"""Table scans: CSV, parquet, ORC, JSON, catalogue tables, SQL text, JDBC and whole text files."""

from __future__ import annotations

import csv
import io
from collections import Counter
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import col, nan_to_null, tokens_to_null
from .records import csv_records

#: The tokens the usual CSV readers take as missing.
DEFAULT_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

#: Quoting of CSV files, read and written.
CSV_FORMAT = {"header": True, "quote": '"', "escape": '"'}

#: Cells are read as they are; what is null is decided afterwards.
CSV_CELLS = {"emptyValue": "", "nullValue": "\u0001", "maxCharsPerColumn": -1}

#: Tokens of a load that keeps ``NA`` and ``None`` as text.
BLANK_ONLY = ("",)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    na_tokens: Sequence[str] = DEFAULT_NA_TOKENS,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header. ``na_tokens`` decides what is null, in text and numeric columns alike.

    A quote in a quoted cell is written twice (RFC 4180). Cells may have line breaks: one more scan then finds where records start,
    so that large files are still read by many tasks. ``multi_line=False`` saves that scan where no cell has one.

    With a schema the file is read once, as text, and cast; a cell that does not parse is
    null. Without one, Spark infers the types of what is left after the tokens are removed.
    """
    if multi_line:
        raw = _parsed(spark, path, schema)
    else:
        reader = spark.read.options(**CSV_FORMAT, **CSV_CELLS)
        raw = (reader if schema is None else reader.schema(_as_text(f.name for f in schema))).csv(path)
    if schema is None:
        cleaned = raw.select(*[tokens_to_null(col(c), na_tokens).alias(c) for c in raw.columns])
        return _infer_numbers(cleaned)
    return raw.select(
        *[tokens_to_null(col(f.name), na_tokens).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def _as_text(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def _parsed(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    """Cells as text, of records that may have line breaks."""
    header, records = csv_records(spark, path)
    if header is None and schema is None:
        raise ValueError(f"no header in {path}")
    names = [f.name for f in schema] if schema is not None else _names(header)
    # The columns are numbered while they are parsed, so that any name will do.
    ddl = ", ".join(f"_c{i} string" for i in range(len(names)))
    options = {k: str(v) for k, v in (CSV_FORMAT | CSV_CELLS).items() if k != "header"}
    cells = records.select(F.from_csv("record", ddl, options).alias("cells"))
    return cells.select(*[F.col(f"cells._c{i}").alias(n) for i, n in enumerate(names)])


def _names(header: str) -> list[str]:
    """Column names as the plain reader gives them: with their number where they are blank or repeat."""
    cells = next(csv.reader(io.StringIO(header)))
    seen = Counter(c.lower() for c in cells)
    return [f"_c{i}" if not c else f"{c}{i}" if seen[c.lower()] > 1 else c for i, c in enumerate(cells)]


def _infer_numbers(df: DataFrame) -> DataFrame:
    """Long where every value is a whole number, double where every value is a number, else text."""
    checks = []
    for i, c in enumerate(df.columns):
        checks.append(F.count_if(col(c).isNotNull() & col(c).try_cast("double").isNull()).alias(f"d{i}"))
        whole = F.regexp_like(col(c), F.lit(r"^\s*[-+]?\d{1,18}\s*$"))
        checks.append(F.count_if(col(c).isNotNull() & ~whole).alias(f"l{i}"))
        checks.append(F.count(col(c)).alias(f"n{i}"))
    seen = df.agg(*checks).first()
    out = []
    for i, c in enumerate(df.columns):
        if seen[f"d{i}"] > 0:
            out.append(col(c))
        elif seen[f"l{i}"] == 0 and seen[f"n{i}"] > 0:
            out.append(F.trim(col(c)).cast("long").alias(c))
        else:
            out.append(nan_to_null(col(c).try_cast("double")).alias(c))
    return df.select(*out)


def read(
    spark: SparkSession,
    *,
    label: str = "table",
    table: str | None = None,
    query: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    path: str | None = None,
    schema: T.StructType | None = None,
    na_tokens: Sequence[str] = DEFAULT_NA_TOKENS,
) -> tuple[DataFrame, str]:
    """Load a table from SQL, else from files; returns the table and where it came from.

    ``query`` goes before ``table``; with ``jdbc`` options (``url``, and ``partitionColumn``,
    ``lowerBound``, ``upperBound``, ``numPartitions`` for a parallel read) they run in that
    database, otherwise in the session catalogue. Any failure there falls back to ``path``.
    """
    problem = None
    if query or table:
        text = query or f"SELECT * FROM {table}"
        try:
            if jdbc:
                options = dict(jdbc)
                options["dbtable"] = f"({query}) q" if query else table
                return spark.read.format("jdbc").options(**options).load(), f"SQL:{label} ({text})"
            return (spark.sql(query) if query else spark.table(table)), f"SQL:{label} ({text})"
        except (PySparkException, Py4JError) as error:
            problem = error
    if path is None:
        raise FileNotFoundError(f"no source left for {label}") from problem
    return read_files(spark, path, schema, na_tokens), f"{path.rsplit('.', 1)[-1].upper()}:{label} ({path})"


def read_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    na_tokens: Sequence[str] = DEFAULT_NA_TOKENS,
) -> DataFrame:
    """Files by extension. Only CSV needs ``na_tokens``; the other formats carry nulls."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "csv":
        return read_csv(spark, path, schema, na_tokens)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.format(kind if kind in ("parquet", "orc", "json") else "parquet").load(path)


def read_pair(spark: SparkSession, train: Mapping, test: Mapping) -> tuple[DataFrame, DataFrame, str]:
    """Train and test table with one joint source label."""
    train_df, train_source = read(spark, label="train", **train)
    test_df, test_source = read(spark, label="test", **test)
    return train_df, test_df, f"{train_source}; {test_source}"


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """``(text)``: one row per file, undecodable bytes dropped."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.expr("replace(make_valid_utf8(cast(content AS string)), '\\uFFFD', '')").alias("text"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
