import random
from collections import defaultdict

import numpy as np

from tablewright.llm import near_copies as near_copies_module
from tablewright.llm import simhash
from tablewright.llm.near_copies import bands_of, links, near_copies, print_of, shingles, shortest, words_of


def brute_classes(rows, least=0.8):
    """Smallest reachable id of each id over all pairs of rows that are alike, or share an id."""
    known = [(d, set(shingles(words_of(t)))) for d, t in rows if d is not None]
    root = {d: d for d, _ in known}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    holds = defaultdict(list)
    for i, (_, s) in enumerate(known):
        for g in s or [None]:
            holds[g].append(i)
    for i, (d, s) in enumerate(known):
        for j in {j for g in s or [None] for j in holds[g] if j < i}:
            e, other = known[j]
            if len(s & other) >= least * len(s | other):
                x, y = sorted((find(d), find(e)))
                root[y] = x
    return {d: find(d) for d in root}


def copies(seed, groups=60, share=0.02, most=12):
    """Groups of copies in which a share of the words is changed."""
    r = random.Random(seed)
    out = []
    for _ in range(groups):
        words = [f"w{r.randrange(5000)}" if r.random() < 0.6 else r.choice("the of and to in".split()) for _ in range(r.randrange(30, 400))]
        for _ in range(r.randrange(1, most)):
            own = list(words)
            for _ in range(r.randrange(0, 1 + int(share * len(own)))):
                own[r.randrange(len(own))] = f"x{r.randrange(10**6)}"
            out.append(" ".join(own))
    r.shuffle(out)
    return list(enumerate(out))


def agreement(got, want):
    """Share of the linked pairs of ``want`` that ``got`` has; all of ``got``'s must be in ``want``."""
    groups = defaultdict(list)
    for d, c in got.items():
        groups[c].append(d)
    assert all(len({want[d] for d in ds}) == 1 for ds in groups.values())
    pairs = [(d, c) for d, c in want.items() if d != c]
    return np.mean([got[d] == got[c] for d, c in pairs])


def classes(df):
    return {r.doc_id: r.component_id for r in near_copies(df).collect()}


def test_groups_of_near_copies(docs):
    rows = copies(1)
    assert agreement(classes(docs(rows)), brute_classes(rows)) > 0.97


def test_one_large_group_in_a_grid(docs, monkeypatch):
    monkeypatch.setattr(simhash, "GRID", 40)
    rows = copies(2, groups=3, share=0.01, most=250)
    assert agreement(classes(docs(rows)), brute_classes(rows)) > 0.99


def test_links_stay_few(docs, spark):
    rows = copies(3, groups=2, share=0.01, most=300)
    prints = [(d, *print_of(set(words_of(t))).tolist(), *print_of(shingles(words_of(t))).tolist()) for d, t in rows]
    df = spark.createDataFrame(prints, "node long, w0 long, w1 long, s0 long, s1 long").dropDuplicates(["w0", "w1", "s0", "s1"]).selectExpr("*", "node AS label")
    # All pairs would be some hundred for each text.
    assert links(df).distinct().count() <= 20 * df.count()


def test_shortest_links():
    r = np.random.default_rng(5)
    a, b, length = r.integers(0, 40, 400), r.integers(40, 80, 400), r.integers(0, 30, 400)
    kept = shortest(a, b, length)
    root = list(range(80))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    total = n = 0
    for i in np.argsort(length, kind="stable"):
        x, y = find(int(a[i])), find(int(b[i]))
        if x != y:
            root[x] = y
            total, n = total + int(length[i]), n + 1
    assert (len(kept), int(length[kept].sum())) == (n, total)
    assert len(shortest(a[:0], b[:0], length[:0])) == 0


def test_edge_cases(docs, edges):
    assert classes(docs(edges)) == brute_classes(edges)
    assert near_copies(docs([])).collect() == []
    assert classes(docs([(1, "some words of the first text"), (2, "quite other words"), (2, "some words of the first text")])) == {1: 1, 2: 1}


def test_small_tables(docs, sample):
    rows = [(r["doc_id"], r["text"]) for r in sample]
    assert classes(docs(rows)) == brute_classes(rows)


def test_repeated_lines_count_once(docs):
    """Texts with the same set of shingles are copies, however often a line is repeated."""
    r = random.Random(7)
    line = " ".join(f"l{i}" for i in range(9))
    prose = " ".join(f"w{r.randrange(5000)}" for _ in range(500))
    assert classes(docs([(1, f"{prose} " + f"{line} " * 200), (2, f"{prose} " + f"{line} " * 5)])) == {1: 1, 2: 1}


def test_filler_hides_no_difference(docs):
    """Texts that differ in all but a repeated word aren't copies."""
    words = [f"w{i}" for i in range(30)]
    filler = "filler " * 300
    assert classes(docs([(1, filler + " ".join(words)), (2, filler + " ".join(words[::-1]))])) == {1: 1, 2: 2}


def substituted(r, words, share):
    """The words with a share of them, scattered, changed to new ones."""
    own = list(words)
    for i in r.sample(range(len(own)), round(share * len(own))):
        own[i] = f"x{r.randrange(10**9)}"
    return own


def zipf(seed, n, vocabulary):
    own = np.random.default_rng(seed)
    weights = 1 / np.arange(1, vocabulary + 1)
    return [f"w{i}" for i in own.choice(vocabulary, n, p=weights / weights.sum())]


def test_copies_of_long_texts(docs):
    """Long texts have few distinct words, so these differ in many; similarities just over 0.8."""
    r, rows = random.Random(8), []
    for k, (n, vocabulary) in enumerate([(5_000, 1_500), (10_000, 1_500), (20_000, 2_000)] * 8):
        words = zipf(k, n, vocabulary)
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(substituted(r, words, 0.019)))]
    want = brute_classes(rows)
    assert sum(d != c for d, c in want.items()) >= 16
    assert classes(docs(rows)) == want


def test_bands_meet_at_any_length():
    """At a similarity of 0.8 some band is the same, for sets of any size."""
    r = np.random.default_rng(9)
    for n in (9, 90, 900, 9000):
        for _ in range(40):
            h = r.integers(0, 1 << 63, 10 * n // 9, np.int64).view(np.uint64)
            cut = len(h) // 10
            x, y = np.sort(h[cut:]), np.sort(h[: len(h) - cut])
            assert set(bands_of(x)) & set(bands_of(y))


def test_large_group_of_versions(docs, monkeypatch):
    """Versions at similarities of about 0.7 to 0.85 have exactly the classes that all pairs give, in many cells too."""
    monkeypatch.setattr(near_copies_module, "CELL_TEXTS", 50)
    r = random.Random(11)
    words = [f"w{r.randrange(5000)}" for _ in range(250)]
    rows = [(i, " ".join(substituted(r, words, r.choice([0.008, 0.016, 0.02, 0.024])))) for i in range(400)]
    want = brute_classes(rows)
    assert 20 < len(set(want.values())) < 380
    assert classes(docs(rows)) == want
