"""Profiling and filling of missing values by meaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import col, mentions
from .catalog import is_missing, numeric_columns, present
from .frequency import medians, mode_values
from .shaping import first_per_group


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, missing_count, n_rows)`` for all columns, zero counts included, in one scan."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)],
    )
    parts = [p for i, c in enumerate(columns) for p in (F.lit(c), F.col(f"m{i}"))]
    return counted.select(F.stack(F.lit(len(columns)), *parts).alias("column", "missing_count"), "n_rows")


def missing_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, missing_count, missing_percent)`` of the columns with a gap, most first."""
    return (
        missing_counts(df, columns)
        .filter(F.col("missing_count") > 0)
        .select("column", "missing_count", (100.0 * F.col("missing_count") / F.col("n_rows")).alias("missing_percent"))
        .orderBy(F.desc("missing_count"), "column")
    )


def missing_before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(column, missing_before, missing_after)`` over the columns of both tables."""
    b = missing_counts(before).select("column", F.col("missing_count").alias("missing_before"))
    a = missing_counts(after).select("column", F.col("missing_count").alias("missing_after"))
    return b.join(a, "column", "full_outer")


def missing_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Columns with a gap, in table order."""
    columns = list(columns if columns is not None else df.columns)
    if not columns:
        return []
    row = df.agg(*[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if row[f"m{i}"]]


@dataclass(frozen=True)
class ImputePlan:
    """What a gap means per column: no such thing, none of it, or truly unknown."""

    absent: list[str] = field(default_factory=list)
    zero: list[str] = field(default_factory=list)
    median: list[str] = field(default_factory=list)
    mode: dict[str, str] = field(default_factory=dict)
    fallback: bool = True


@dataclass
class Imputer:
    """Fill values for both tables, and the steps that led to them."""

    train_fills: dict = field(default_factory=dict)
    test_fills: dict = field(default_factory=dict)
    steps: list = field(default_factory=list)


def fit_imputer(train: DataFrame, test: DataFrame, plan: ImputePlan, fit_scope: str = "train") -> Imputer:
    """Work out all fill values: at most two statistics jobs per table, whatever the number of columns.

    Columns still with gaps in ``test`` take the train statistic (``fit_scope="train"``)
    or, as does a column that train lacks, their own (``fit_scope="test"``).
    """
    if fit_scope not in ("train", "test"):
        raise ValueError("fit_scope is 'train' or 'test'")
    out = Imputer()

    def both(column, value, strategy, reason):
        if column in train.columns:
            out.train_fills[column] = value
        if column in test.columns:
            out.test_fills[column] = value
        out.steps.append((column, strategy, reason))

    for c in plan.absent:
        if c in train.columns or c in test.columns:
            both(c, "None", "fillna('None')", "No feature")
    for c in plan.zero:
        if c in train.columns or c in test.columns:
            both(c, 0, "fillna(0)", "No numeric feature")

    done = {*plan.absent, *plan.zero, *plan.median, *plan.mode}
    rest = missing_columns(train, [c for c in train.columns if c not in done]) if plan.fallback else []
    numbers = set(numeric_columns(train))
    middle = medians(train, present(train, plan.median) + [c for c in rest if c in numbers])
    common = mode_values(train, present(train, list(plan.mode)) + [c for c in rest if c not in numbers])

    for c in present(train, plan.median):
        value = middle[c] if middle[c] is not None else 0.0
        both(c, value, f"fillna(median={value:.4f})", "True missing numeric")
    for c in present(train, list(plan.mode)):
        value = common[c] if common[c] is not None else plan.mode[c]
        both(c, value, f"fillna(mode={value})", "True missing categorical")
    for c in rest:
        if c in numbers:
            value = middle[c] if middle[c] is not None else 0.0
            both(c, value, f"fallback fillna(median={value:.4f})", "Remaining numeric missing")
        else:
            value = common[c] if common[c] is not None else "None"
            both(c, value, f"fallback fillna(mode={value})", "Remaining categorical missing")

    left = [c for c in test.columns if c not in out.test_fills]
    for_test = missing_columns(test, left) if plan.fallback else []
    own = [c for c in for_test if fit_scope == "test" or c not in train.columns]
    shared = [c for c in for_test if c not in own]
    for source, columns, label in ((test, own, "test-only"), (train, shared, "train-fitted")):
        numbers = set(numeric_columns(source))
        middle = medians(source, [c for c in columns if c in numbers])
        common = mode_values(source, [c for c in columns if c not in numbers])
        reason = "Missing in test only"
        for c in columns:
            if c in numbers:
                value = middle[c] if middle[c] is not None else 0.0
                out.steps.append((c, f"{label} fillna(median={value:.4f})", reason))
            else:
                value = common[c] if common[c] is not None else "None"
                out.steps.append((c, f"{label} fillna(mode={value})", reason))
            out.test_fills[c] = value
    return out


def apply_fills(df: DataFrame, fills: Mapping) -> DataFrame:
    """Replace gaps by literals, so the fill costs no join. A fractional fill makes the column double."""
    out = []
    for f in df.schema.fields:
        if f.name not in fills:
            out.append(col(f.name))
            continue
        value, kind = fills[f.name], f.dataType
        if isinstance(value, float) and isinstance(kind, T.NumericType):
            kind = T.DoubleType()
        filled = F.when(is_missing(df, f.name), F.lit(value).cast(kind)).otherwise(col(f.name).cast(kind))
        out.append(filled.alias(f.name))
    return df.select(*out)


def impute(
    train: DataFrame, test: DataFrame, plan: ImputePlan, fit_scope: str = "train"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Filled train, filled test and the log of what was done."""
    fitted = fit_imputer(train, test, plan, fit_scope)
    log = strategy_log(train, fitted)
    return apply_fills(train, fitted.train_fills), apply_fills(test, fitted.test_fills), log


def strategy_log(df: DataFrame, fitted: Imputer) -> DataFrame:
    """``(step, column, strategy, reason)``, the first of equal (column, strategy) pairs."""
    rows = [(i, *step) for i, step in enumerate(fitted.steps)]
    steps = df.sparkSession.createDataFrame(rows, "step int, column string, strategy string, reason string")
    return first_per_group(steps, ["column", "strategy"], "step")


def fill_for_model(df: DataFrame, target: str) -> DataFrame:
    """Text gaps become ``'Missing'``, numeric gaps the column median; the target stays."""
    gaps = missing_columns(df, [c for c in df.columns if c != target])
    numbers = set(numeric_columns(df))
    fills: dict = {c: "Missing" for c in gaps if c not in numbers}
    fills.update({c: 0.0 if v is None else v for c, v in medians(df, [c for c in gaps if c in numbers]).items()})
    return apply_fills(df, fills)


def term_coverage(texts: DataFrame, text: str, terms: Sequence[str]) -> DataFrame:
    """``(term, n_texts)``: rows that mention each term, all terms in one scan of the whole texts."""
    counted = texts.agg(*[F.count_if(mentions(col(text), t)).alias(f"t{i}") for i, t in enumerate(terms)])
    parts = [p for i, t in enumerate(terms) for p in (F.lit(t), F.col(f"t{i}"))]
    return counted.select(F.stack(F.lit(len(terms)), *parts).alias("term", "n_texts"))


def term_coverage_many(texts: DataFrame, text: str, terms: Sequence[str]) -> DataFrame:
    """The same as ``term_coverage`` for thousands of terms: every task reads its texts once, with one automaton of all terms.

    A term that contains another counts for both; the empty term is in every text that is not null.
    """
    listed = list(dict.fromkeys(terms))

    def run(batches):
        automaton, counts = ahocorasick.Automaton(), np.zeros(len(listed), np.int64)
        for i, term in enumerate(listed):
            if term:
                automaton.add_word(term, i)
        automaton.make_automaton()
        blank = [i for i, term in enumerate(listed) if not term]
        for batch in batches:
            for value in batch.column(0).to_pylist():
                if value is not None:
                    found = {i for _, i in automaton.iter(value)} if len(automaton) else set()
                    counts[[*found, *blank]] += 1
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["at", "n"])

    counted = texts.select(col(text).cast("string").alias("value")).mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    rows = texts.sparkSession.createDataFrame(list(enumerate(listed)), "at long, term string")
    return rows.join(counted, "at", "left").select("term", F.coalesce("n", F.lit(0)).alias("n_texts"))


def na_semantics(
    df: DataFrame,
    meanings: Mapping[str, str],
    texts: DataFrame,
    text: str = "text",
    terms: Mapping[str, str] | None = None,
) -> DataFrame:
    """What a gap means per column, whether the table has it, how often, and who mentions it.

    The term looked for is the column name unless ``terms`` gives another.
    """
    term_of = {c: (terms or {}).get(c, c) for c in meanings}
    rows = [(c, m, term_of[c], int(c in df.columns)) for c, m in meanings.items()]
    listed = df.sparkSession.createDataFrame(rows, "column string, na_meaning string, term string, in_table int")
    coverage = term_coverage(texts, text, sorted(set(term_of.values())))
    gaps = missing_counts(df, present(df, list(meanings))).drop("n_rows")
    return (
        listed.join(coverage, "term", "left")
        .join(gaps, "column", "left")
        .withColumn("mentioned", (F.col("n_texts") > 0).cast("int"))
    )
