"""Fit a text classifier on a bounded sample of labelled rows and score every text."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashed import Grams, Model, Row, ftrl
from .words import record_batches, rows

SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
MODEL = pa.schema([("features", pa.binary()), ("weights", pa.binary()), ("bias", pa.float64())])


def remainder(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``; 0 for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus, F.lit(0))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, most_rows: int) -> DataFrame:
    """At most ``most_rows`` rows ``doc_id, text, label``, the first by hash of doc_id.

    The ids are a top-k by hash, so the broadcast side has ``most_rows`` rows at most.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & usable)
    ids = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def fit(
    sample: DataFrame,
    shapes: bool,
    versions: Callable[[str], Iterable[str]] | None = None,
    **settings,
) -> Model:
    """One task reads the bounded sample in a fixed order and returns the weights that are not zero.

    Without rows of both labels the score is the share of label 1, or 0 without any row.
    """
    normed = settings["normed"]

    def run(batches):
        grams = Grams(shapes)
        read: list[Row] = []
        other: list[list[Row]] = []
        labels: list[int] = []
        for text, label in rows(batches, "text", "label"):
            read.append(grams(text))
            other.append([grams(v) for v in versions(text or "")] if versions else [])
            labels.append(label)
        if len(set(labels)) < 2:
            share = min(max(float(np.mean(labels)) if labels else 0.0, 1e-9), 1 - 1e-9)
            model = Model(np.empty(0, np.uint64), np.empty(0), float(np.log(share / (1 - share))), normed)
        else:
            model = ftrl(read, labels, other, **settings)
        return record_batches(iter([(model.features.tobytes(), model.weights.tobytes(), model.bias)]), MODEL)

    ordered = sample.select("doc_id", "text", "label").repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    found = ordered.mapInArrow(run, "features binary, weights binary, bias double").first()
    if found is None:
        return Model(np.empty(0, np.uint64), np.empty(0), float(np.log(1e-9)), normed)
    return Model(np.frombuffer(found.features, np.uint64), np.frombuffer(found.weights, np.float64), found.bias, normed)


def scores(docs: DataFrame, model: Model, shapes: bool) -> DataFrame:
    """``doc_id, score`` of every row."""

    def run(batches):
        grams = Grams(shapes)
        return record_batches(((d, model.score(grams(t))) for d, t in rows(batches, "doc_id", "text")), SCORES)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def digest(scored: DataFrame, modulus: int, held_out: int) -> DataFrame:
    return scored.select(
        "doc_id", (remainder(modulus) == held_out).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    )
