import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import components, hot, minhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def brute(rows, percent=80):
    """``doc_id, n_shingles, component_id, kept`` of every row, from all pairs."""
    sets = [shingles(t) for _, t in rows]
    up = {d: d for d, _ in rows if d is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        if rows[i][0] is not None:
            for x in s:
                holders[x].append(i)
    for i, s in enumerate(sets):
        if rows[i][0] is None:
            continue
        common = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j < i:
                    common[j] += 1
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((top(rows[i][0]), top(rows[j][0])))
                up[b] = a
    out = []
    for (d, _), s in zip(rows, sets):
        c = None if d is None else top(d)
        out.append((d, len(s), c, True if d is None else d == c))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def versions(seed, n, words, low, high, start=0):
    """Texts that come from one another or a common one, with some words changed."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10_000)}" for _ in range(words)]
    out, texts = [], [base]
    for i in range(n):
        own = list(r.choice(texts[-3:] if r.random() < 0.5 else texts[:1]))
        for _ in range(int(len(own) * r.uniform(low, high))):
            own[r.randrange(len(own))] = f"v{r.randrange(10_000)}"
        texts.append(own)
        out.append((start + i, " ".join(own)))
    r.shuffle(out)
    return out


def test_versions_equal_brute_force(docs):
    rows = versions(1, 120, 200, 0, 0.05) + versions(2, 60, 30, 0, 0.1, 500) + [(900 + i, f"text {i} of its own here") for i in range(20)]
    assert found(minhash.near_duplicates(docs(rows))) == brute(rows)


def test_both_rounds_in_small_cells(docs, monkeypatch):
    monkeypatch.setattr(minhash, "CELL_DOCS", 8)
    rows = versions(3, 150, 120, 0.03, 0.06) + [(1000 + i, "the same text for a third of all rows " * 3) for i in range(80)]
    want = brute(rows)
    assert 10 < len({r[2] for r in want}) < 150
    assert found(minhash.near_duplicates(docs(rows))) == want


def test_second_round_finds_what_the_first_leaves(docs, monkeypatch):
    """Even if no first link holds, the classes are those of all pairs."""
    monkeypatch.setattr(minhash, "first_candidates", lambda found, nodes: found.sparkSession.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(minhash, "CELL_DOCS", 16)
    rows = versions(4, 100, 80, 0, 0.06)
    assert found(minhash.near_duplicates(docs(rows))) == brute(rows)


def test_edge_cases(docs, edges):
    assert found(minhash.near_duplicates(docs(edges))) == brute(edges)


def test_rows_that_share_an_id(docs):
    a, b, c = "one two three four five six", "seven eight nine ten eleven", "twelve thirteen fourteen fifteen"
    rows = [(4, a), (9, a), (9, b), (7, b), (5, c), (7, None), (3, ""), (3, c), (8, "")]
    assert found(minhash.near_duplicates(docs(rows))) == brute(rows)


def test_exactly_at_the_limit(docs):
    words = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(words[:12])), (2, " ".join(words[:11])), (3, " ".join(words[:9])), (4, " ".join(words[:7]))]
    rows += [(10, " ".join(words[50:150])), (11, " ".join(words[50:129])), (12, " ".join(words[70:150]))]
    assert found(minhash.near_duplicates(docs(rows))) == brute(rows)


def test_small_tables(docs, sample):
    rows = [(r["doc_id"], r["text"]) for r in sample]
    assert found(minhash.near_duplicates(docs(rows))) == brute(rows)


def test_empty_table(docs):
    assert minhash.near_duplicates(docs([])).collect() == []


def test_signatures_estimate_similarity():
    r = np.random.default_rng(5)
    pool = r.integers(0, 2**63, 1200).astype(np.uint64)
    one, other = np.unique(pool[:1000]), np.unique(pool[200:])
    same = np.frombuffer(minhash.signature(one), np.uint16) == np.frombuffer(minhash.signature(other), np.uint16)
    assert abs(same.mean() - 800 / 1200) < 0.12


def test_components_with_hubs(spark):
    r = random.Random(8)
    edges = [(0, i) for i in range(1, 400)] + [(900, i) for i in range(901, 1500)] + [(r.randrange(2000, 2600), r.randrange(2000, 2600)) for _ in range(400)]
    edges += [(i, i + 1) for i in range(3000, 3100)] + [(1450, 399)]
    up = list(range(4000))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    got = {x.node: x.component for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: top(n) for e in edges if e[0] != e[1] for n in e}


@pytest.mark.parametrize("n", [5, 1000])
def test_hot_keys_join_like_others(spark, n):
    many = spark.createDataFrame([(i % 3 if i % 2 else i, i) for i in range(n)], "k long, x long")
    unique = many.groupBy("k").count().withColumnRenamed("count", "n").withColumn("y", unique_y())
    got = sorted((r.k, r.x, r.y) for r in hot.join_unique(many, unique, ["k"], "n", n).collect())
    assert got == sorted((i % 3 if i % 2 else i, i, 2 * (i % 3 if i % 2 else i)) for i in range(n))


def unique_y():
    return F.col("k") * 2


def test_filter_keeps_what_is_in_and_drops_most_else(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    ids = rows.where("doc_id % 50 = 0")
    got = {r.doc_id for r in hot.likely_in(rows, ids, "doc_id", 400).collect()}
    assert got >= set(range(0, 20_000, 50)) and len(got) < 4_000
    assert hot.likely_in(rows, ids.where("false"), "doc_id", 0).count() == 0
