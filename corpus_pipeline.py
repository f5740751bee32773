"""From raw documents to token ids: five stages, each a table that the next one reads.

Each stage gets the table that the one before has written and decides on nothing else:
toxic documents go, lines that an earlier document has go, one document of each near-duplicate class stays, documents that hold a
benchmark item go, and what is left is encoded. All stages but the last return the columns of ``documents``;
``n_chars`` follows the text where lines went.

Defined cases: those of the operators; rows without doc_id pass the stages that compare documents; rows that share
a doc_id stay or go together; columns besides those of ``documents`` are carried along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import bpe, decontaminate, line_dedup, near_copies, toxicity
from tablewright.storage import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject_toxic(docs, toxicity.toxicity_model(docs, labels))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_repeated_lines(docs)
    count = F.char_length("text").cast("long")
    return out.select(*[count.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = near_copies.near_copies(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))
    digests = [F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256")]
    return out.select("doc_id", "n_tokens", "ids", *digests)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("encoding", encode),
]

#: SQL can express neither a fitted classifier nor the encoding; tests compare ``run`` with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
