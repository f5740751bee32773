import numpy as np
import pytest
import xxhash

from tablewright.llm import simhash
from tablewright.llm.components import components


def brute_fingerprint(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [words] if len(words) < size else [words[i : i + size] for i in range(len(words) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps):
    """Smallest reachable id for each id, by comparing all pairs."""
    ids = sorted({d for d, _ in fps if d is not None})
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    known = [(d, f) for d, f in fps if d is not None]
    for i, (a, f) in enumerate(known):
        for b, g in known[:i]:
            if (f ^ g).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


@pytest.mark.parametrize("size", [4, 5])
def test_fingerprints(sample, edges, size):
    texts = [r["text"] for r in sample[:60]] + [t for _, t in edges] + ["a b c", "a A b B a A b B"]
    assert all(simhash.fingerprint(t, size) == brute_fingerprint(t, size) for t in texts)


def test_code_tables():
    nearest, syndrome, flips = simhash.code_tables()
    words = np.flatnonzero(syndrome == 0)
    assert len(words) == 2**11 and set(nearest) == set(words)
    for value in (0, 1, 77, 32_767, 20_123):
        within = {int(w) for w in words if int(value ^ w).bit_count() <= 2}
        listed = {int(nearest[value])} | ({int(value ^ f) for f in flips[syndrome[value]]} if syndrome[value] else set())
        assert within == listed


def near(seed, n, spread):
    """Fingerprints in clusters whose members differ in up to ``spread`` bits from the next."""
    r = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        fp = int(r.integers(0, 2**63)) * 2 + int(r.integers(0, 2))
        for _ in range(int(r.integers(1, 12))):
            out.append(fp)
            for bit in r.choice(64, int(r.integers(0, spread + 1)), replace=False):
                fp ^= 1 << int(bit)
    return out[:n]


def classes_of(spark, fps):
    rows = spark.createDataFrame([(d, simhash.signed(f)) for d, f in enumerate(fps)], "doc_id long, fp long")
    distinct = rows.groupBy("fp").agg({"doc_id": "min"}).withColumnRenamed("min(doc_id)", "node")
    found = {r.node: r.component for r in components(simhash.links(distinct)).collect()}
    first = {}
    for d, f in enumerate(fps):
        first.setdefault(f, d)
    return {d: found.get(first[f], first[f]) for d, f in enumerate(fps)}


def test_links_equal_all_pairs(spark):
    fps = near(1, 700, 6)
    assert classes_of(spark, fps) == brute_classes(list(enumerate(fps)))


def test_large_anchors_are_cut_into_a_grid(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GRID", 3)
    fps = near(2, 400, 4)
    assert classes_of(spark, fps) == brute_classes(list(enumerate(fps)))


def test_edge_cases(docs, edges):
    got = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(docs(edges), 4).collect()}
    want = brute_classes([(d, brute_fingerprint(t, 4)) for d, t in edges])
    assert {d: c for (d, _), c in got.items() if d is not None} == want
    assert all(c is None for (d, _), c in got.items() if d is None)
    assert want[5] == 4 and want[3] == want[2] == want[1] == 1


def test_rows_that_share_an_id_are_one_document(docs):
    rows = [(1, "some words of the first text"), (2, "quite other words stand here"), (2, "some words of the first text"), (3, "third")]
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(rows)).collect()} == {1: 1, 2: 1, 3: 3}


def test_small_tables(docs, sample):
    rows = [(r["doc_id"], r["text"]) for r in sample]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(rows), 4).collect()}
    assert got == brute_classes([(d, brute_fingerprint(t, 4)) for d, t in rows])


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).collect() == []


def test_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 200)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 300)}
