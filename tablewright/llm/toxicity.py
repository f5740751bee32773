"""Toxicity by a classifier that is regularised with counterfactuals.

The model is a logistic regression on hashed word n-grams. For each labelled text whose sentences name a
group of people, versions are made in which the terms of these sentences are swapped for other terms of the same
kind, and half the squared change of the raw score times ``BALANCE`` is added to the loss. The score so
can't lean on who is mentioned, and neutral mentions of a group are not taken for attacks on it.

``SAMPLE_ROWS`` bounds the labelled rows that the fit reads, at any size of the input. Every text is scored
whole. Defined cases: a null or blank text gets the score of the intercept; rows without doc_id are scored;
labels without doc_id or value are passed over; of several labels of one document the larger counts; without
labels of both kinds the score is their share, 0 without any, and nothing is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .fitting import digest, fit, labelled_sample, remainder, scores
from .hashed import Grams, Model

SAMPLE_ROWS = 12_000
#: Documents with this remainder of crc32 are kept out of the fit.
FOLDS, HELD_OUT = 4, 2
#: Texts with at least this score are rejected.
REJECT = 0.3
#: Weight of the penalty on score changes.
BALANCE = 2.0

# Terms that name groups of people, by kind.
GROUPS = (
    ("women", "men", "girls", "boys", "females", "males"),
    ("woman", "man", "girl", "boy", "female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("disabled", "blind", "deaf", "autistic", "elderly", "young"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("mexican", "chinese", "indian", "american", "german", "french", "russian", "turkish"),
)
#: How far along its kind a term is swapped, one version each.
SHIFTS = (1, 3)

TERMS = {t: kind for kind in GROUPS for t in kind}
MENTION = re.compile(r"\b(" + "|".join(TERMS) + r")\b", re.IGNORECASE)
SENTENCES = re.compile(r"[^.!?\n]+|[.!?\n]+")


def counterfactuals(text: str) -> Iterator[str]:
    """The text with the group terms of its sentences swapped, a version for each shift; none without such terms."""
    if not MENTION.search(text):
        return
    parts = SENTENCES.findall(text)
    for shift in SHIFTS:

        def other(m: re.Match, shift=shift) -> str:
            kind = TERMS[m[0].lower()]
            return kind[(kind.index(m[0].lower()) + shift) % len(kind)]

        yield "".join(MENTION.sub(other, p) if MENTION.search(p) else p for p in parts)


def toxicity_model(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, balance: float = BALANCE) -> Model:
    usable = remainder(FOLDS) != HELD_OUT
    sample = labelled_sample(docs, labels, "toxic", usable, sample_rows)
    return fit(sample, False, counterfactuals, normed=False, l1=10.0, alpha=0.4, balance=balance)


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score``: how likely a text is toxic."""
    return scores(docs, model, False)


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text isn't rejected."""
    def run(batches):
        grams = Grams(False)
        for batch in batches:
            texts = batch.column("text")
            keep = [model.score(grams(texts[i].as_py())) < REJECT for i in range(batch.num_rows)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return digest(toxicity_scores(docs, toxicity_model(docs, labels)), FOLDS, HELD_OUT)
