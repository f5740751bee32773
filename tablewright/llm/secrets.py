"""Secrets: rules for known forms, and automata inferred from what the rules find for tokens of like format.

The rules label credentials of three kinds. From a bounded sample of each kind a probabilistic automaton is inferred
over classes of characters (digits, hexadecimal letters, other letters, each sign). Every other token that
may be a credential, at least ``LEAST_TOKEN`` credential characters with a digit among them and clear of the rules'
spans, is scored by all automata; it is added when its likelihood is at least that of all but ``TAIL``
of the labelled credentials of that kind.

Texts are read once: the first job writes the rules' spans and the candidates, which are few, and all later steps read that table.
``SAMPLE_SPANS`` bounds the strings of each kind that an automaton is inferred from, at any size of the input.

Defined cases: a null text is empty; a kind that never occurs has no automaton and adds nothing; rows without
doc_id are scanned like any other; rows that repeat are scanned alike; very long texts are scanned whole, in time that grows with their
length; an empty table gives no row; spans count code points, their end is exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stage
from .automata import Automaton
from .words import record_batches, rows

# The rules, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.ASCII)
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}", re.ASCII)
LEAST_VALUE, LEAST_ACCESS, LEAST_TOKEN = 12, 18, 16
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{16,}", re.ASCII)

#: Strings of each kind that an automaton is inferred from, and characters of the longest of them.
SAMPLE_SPANS = 1_000
LONGEST = 200
#: Share of the labelled credentials that are less likely than the threshold.
TAIL = 0.02

#: The class that stands for each character: 0 digits, a and A hexadecimal letters, g and G other letters.
CLASSES = str.maketrans({c: k for k, cs in {"0": "0123456789", "a": "abcdef", "A": "ABCDEF", "g": "ghijklmnopqrstuvwxyz", "G": "GHIJKLMNOPQRSTUVWXYZ"}.items() for c in cs})

SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])
SCANNED = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(SPAN)), ("candidates", pa.list_(SPAN))])
SPANS_DDL = "array<struct<kind: int, start: int, end: int, value: string>>"
Span = tuple[int, int, int, str]  # kind, start, end, value


def base_spans(text: str) -> list[Span]:
    """Spans of the rules, by start and then kind."""
    out = [(0, *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    out += [(1, *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [(2, *m.span(), m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Other tokens that may be credentials, clear of the spans of the rules (by start, as ``base_spans`` gives them)."""
    starts = [b[1] for b in base]
    reach = [0, *accumulate((b[2] for b in base), max)]  # how far the spans before each one go
    found = [(-1, *m.span(), m[0]) for m in TOKEN.finditer(text)]
    return [c for c in found if reach[bisect_left(starts, c[2])] <= c[1]]


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, base, candidates`` of every row."""

    def one(doc_id, text):
        base = base_spans(text or "")
        fields = ("kind", "start", "end", "value")
        return doc_id, *([dict(zip(fields, s)) for s in spans] for spans in (base, candidates(text or "", base)))

    def run(batches):
        return record_batches((one(*r) for r in rows(batches, "doc_id", "text")), SCANNED)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, base {SPANS_DDL}, candidates {SPANS_DDL}")


def infer(scanned: DataFrame) -> dict[int, tuple[Automaton, float]]:
    """For each kind that occurs its automaton and the likelihood that a token must have."""
    spans = scanned.select("doc_id", F.explode("base").alias("span")).select("doc_id", "span.*").where(F.length("value") <= LONGEST)
    order = [F.xxhash64("doc_id", "start", "value"), "doc_id", "start"]
    out = {}
    for kind in range(len(KINDS)):
        top = spans.where(F.col("kind") == kind).orderBy(*order).limit(SAMPLE_SPANS).select("value").collect()
        if top:
            known = [r.value.translate(CLASSES) for r in top]
            automaton = Automaton(known)
            scores = sorted(map(automaton.likelihood, known))
            out[kind] = automaton, scores[int(TAIL * len(scores))]
    return out


def format_spans(found: list[Span], automata: dict[int, tuple[Automaton, float]]) -> Iterator[Span]:
    """Candidates that are as likely as a labelled credential, with the kind that they are likeliest of."""
    for _, start, end, value in found:
        form = value.translate(CLASSES)
        over = [(automaton.likelihood(form) - least, -kind) for kind, (automaton, least) in automata.items()]
        best = max(over, default=(-1.0, 0))
        if best[0] >= 0:
            yield -best[1], start, end, value


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, base, added`` of every row: the spans of the rules and those of the automata."""
    scanned = stage(scan(docs), "secrets")
    automata = infer(scanned)
    schema = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(SPAN)), ("added", pa.list_(SPAN))])

    def run(batches):
        def found():
            for doc_id, base, other in rows(batches, "doc_id", "base", "candidates"):
                spans = [tuple(c.values()) for c in other]
                yield doc_id, base, [dict(zip(("kind", "start", "end", "value"), s)) for s in format_spans(spans, automata)]

        return record_batches(found(), schema)

    return scanned.mapInArrow(run, f"doc_id long, base {SPANS_DDL}, added {SPANS_DDL}")


def listed(spans: str):
    """``kind:start:end`` of the spans of an SQL expression, by start and then kind, joined by commas."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    sorted_ = f"array_sort(transform({spans}, s -> struct(s.start AS start, s.kind AS kind, s.end AS end)))"
    return F.expr(f"array_join(transform({sorted_}, s -> concat_ws(':', element_at(array({names}), s.kind + 1), s.start, s.end)), ',')")


def op6_secrets(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {i})) AS long)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return find_secrets(docs).select(
        "doc_id", *counts, F.sha2(F.encode(listed("base"), "UTF-8"), 256).alias("base_sha256"), listed("concat(base, added)").alias("spans")
    )
