"""Text quality: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

A text becomes logarithmic counts of hashed n-grams of its words and of their shapes (capitals, punctuation
around a word, the same word again); the score is the logistic function of a sparse dot product.

``SAMPLE_ROWS`` bounds the labelled rows that the fit reads, at any size of the input. Every text is scored
whole. Defined cases: a null or blank text has no features and gets the score of the intercept; rows without
doc_id are scored and count as held out; labels without doc_id or value are passed over; of several labels of
one document the larger counts; without labels of both kinds the score is their share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .fitting import digest, fit, labelled_sample, remainder, scores
from .hashed import Model

SAMPLE_ROWS = 6_000
#: Documents with this remainder of crc32 are kept out of the fit.
FOLDS, HELD_OUT = 5, 0


def quality_model(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    usable = remainder(FOLDS) != HELD_OUT
    sample = labelled_sample(docs, labels, "quality", usable, sample_rows)
    return fit(sample, True, normed=True, l1=0.3, alpha=1.0)


def quality_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score``: how likely a text is of good quality."""
    return scores(docs, model, True)


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return digest(quality_scores(docs, quality_model(docs, labels)), FOLDS, HELD_OUT)
