import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

TABLES = "/root/testdata/sf0.001"

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
#: Nulls, empty and blank texts, very long ones, ties, repeated rows.
EDGES = [
    (None, "A row without an id, but with a line of its own.\nshared line of text"),
    (None, None),
    (1, None),
    (2, ""),
    (3, " \n\t \n"),
    (4, LONG),
    (5, LONG),
    (6, "one line only, shared by two\nOne Line Only, shared by two \nshort\nshort"),
    (7, "one line only, shared by two"),
    (7, "one line only, shared by two"),
    (8, "x"),
    (9, "Ünïcödé Straße ÉCOLE\n\n\tÜnïcödé Straße ÉCOLE\r"),
    (10, "Ünïcödé Straße éCOLE"),
]
#: Names that operators might use for columns of their own.
CLASHES = ("pos", "line", "key", "h1", "fp", "node", "anchor", "marks", "score", "spots", "n_chars", "kind", "_gone", "component_id", "first_doc")


@pytest.fixture(scope="session")
def sample():
    """``doc_id, text`` of the smallest tables."""
    return pq.read_table(f"{TABLES}/documents.parquet", columns=["doc_id", "text"]).to_pylist()


@pytest.fixture(scope="session")
def docs(spark):
    """A table of documents with clashing extra columns."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())] + [T.StructField(c, T.StringType()) for c in CLASHES])
    return lambda rows: spark.createDataFrame([(*r, *["extra"] * len(CLASHES)) for r in rows], schema)


@pytest.fixture(scope="session")
def edges():
    return list(EDGES)


@pytest.fixture
def folder(tmp_path):
    """A folder of tables from rows of documents, labels and benchmark."""

    def write(documents, labels=(), benchmark=()):
        kinds = {
            "documents": (documents, [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]),
            "labels": (labels, [("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())]),
            "benchmark": (benchmark, [("item_id", pa.int64()), ("text", pa.string())]),
        }
        for name, (rows, fields) in kinds.items():
            columns = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(fields)]
            pq.write_table(pa.table(columns, pa.schema(fields)), f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
