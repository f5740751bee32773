import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from tablewright.llm import divergence

SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("lang", "source", "text", "term", "n", "docs", "found", "part", "item", "value", "groups")]
)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    of_group, in_docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in ((a or "", b or "", c or "") for a, b, c in rows):
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))
        of_group[lang, source].update(terms)
        in_docs[lang].update(set(terms))
        langs[lang].add(source)
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in in_docs[lang].items() if n >= least]
        totals = {s: sum(of_group[lang, s][t] for t in kept) for s in sources}

        def share(n, total):
            return 1 + 1_000_000_000 * (n + 5) // (total + 5 * len(kept))

        p = {s: {t: share(of_group[lang, s][t], totals[s]) for t in kept} for s in sources}
        q = {t: share(sum(of_group[lang, s][t] for s in sources), sum(totals.values())) for t in kept}
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            over = [(t, p[s][t] - q[t]) for t in kept if of_group[lang, s][t] and p[s][t] > q[t]]
            for part, found, last in (("pair", pairs, None), ("term", over, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:last])]
    return sorted(out)


def found(spark, rows, least=2, top=3, **more):
    df = spark.createDataFrame([(*r, *["extra"] * 8) for r in rows], SCHEMA)
    out = divergence.divergences(df, least, top, **more)
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in out.collect())


def texts(n, seed=3):
    r = random.Random(seed)
    words = [f"{w}{chr(97 + i)}" for i in range(20) for w in ("wort", "Mot", "été", "ÉTÉ", "x-")]
    return [(r.choice(["en", "de", "fr"]), f"s{r.randrange(5)}", " ".join(r.choices(words, k=r.randrange(0, 40)))) for _ in range(n)]


EDGES = [
    (None, None, None),
    ("", "", ""),
    (None, "a", "one Two two"),
    ("", "b", "two one\x00one"),
    ("en", "a", "12 34 !?"),
    ("en", None, "word"),
    ("de", "only", "Größe größe GRÖSSE"),
    ("de", "only", "Größe größe GRÖSSE"),
    ("xx", "a", "lang " * 50_000),
    ("xx", "b", "lang[word]word`x{y}\x7fz  nbsp"),
    ("xx", "c", ""),
]


@pytest.mark.parametrize("rows", [EDGES, texts(200), texts(60, 9) + EDGES])
def test_equals_brute_force(spark, rows):
    assert found(spark, rows) == brute(rows, 2, 3)


def test_many_small_shards_and_partial_counts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_COUNTS", 50)
    monkeypatch.setattr(divergence, "SPLIT_ROWS", 7)
    rows = texts(300, 4)
    assert found(spark, rows, cells=16) == brute(rows, 2, 3)


def test_hot_source_and_word(spark):
    rows = [("en", "hot" if i % 3 else f"s{i % 50}", "same " * 20 + f"w{i % 7}") for i in range(600)]
    assert found(spark, rows) == brute(rows, 2, 3)


def test_nothing_kept_and_empty_table(spark):
    rows = [("en", "a", "one"), ("en", "b", "two")]
    assert found(spark, rows, least=30) == brute(rows, 30, 3) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert found(spark, []) == []


def test_shares_of_very_large_counts():
    counts, total, terms = np.array([0, 7, 10**14 + 3, 4 * 10**15]), 5 * 10**15, 1_000_003
    want = [1 + 10**9 * (int(n) + 5) // (total + 5 * terms) for n in counts]
    assert divergence.shares(counts, total, terms).tolist() == want
