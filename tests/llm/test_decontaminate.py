import random
from collections import Counter

from tablewright.llm import decontaminate
from tablewright.llm.decontaminate import SHINGLE, drop_leaking, leaks, plain_words


def grams(text):
    words = plain_words(text)
    return [tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


def weight(counts):
    return sum(n * sum(map(len, g)) for g, n in counts.items())


def brute(rows, items, least=0.8):
    """Best similarity of any window of each document for each item."""
    out = {}
    for d, text in rows:
        own = grams(text)
        for i, item in items:
            want = Counter(grams(item))
            size = min(sum(want.values()), len(own))
            for s in range(len(own) - size + 1) if want and own else ():
                window = Counter(own[s : s + size])
                alike = weight(want & window) / max(weight(want), weight(window))
                if alike >= least:
                    out[d, i] = max(alike, out.get((d, i), 0))
    return out


def planted(seed=1):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(r.randrange(5, 60)))) for i in range(30)]
    items += [(30, items[0][1]), (31, "four words are few"), (32, None), (None, " ".join(word() for _ in range(20))), (33, "again and again " * 8)]
    rows = []
    for d in range(150):
        words = [word() for _ in range(r.randrange(0, 80))]
        if d % 2:
            passage = plain_text(r.choice(items)[1]).split()
            for _ in range(r.randrange(0, 4)):
                if passage:
                    passage[r.randrange(len(passage))] = word()
            at = r.randrange(len(words) + 1)
            words[at:at] = passage[r.randrange(0, 3) :]
        rows.append((d, " ".join(words).title() + ("." if d % 3 else "!")))
    return rows, items


def plain_text(text):
    return text or ""


def frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_equal_to_brute_force(spark, docs):
    rows, items = planted()
    got = {(r.doc_id, r.item_id): r.similarity for r in leaks(docs(rows), frame(spark, items)).collect()}
    want = brute(rows, items)
    assert got.keys() == want.keys() and len(want) > 20
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_slices_make_no_difference(spark, docs, monkeypatch):
    rows, items = planted(2)
    df, benchmark = docs(rows), frame(spark, items)
    order = lambda r: [(x is not None, x) for x in r]
    whole = sorted(map(tuple, leaks(df, benchmark).collect()), key=order)
    kept = sorted(r.doc_id for r in drop_leaking(df, benchmark).collect())
    monkeypatch.setattr(decontaminate, "SLICE", 8)
    assert sorted(map(tuple, leaks(df, benchmark).collect()), key=order) == whole
    assert sorted(r.doc_id for r in drop_leaking(df, benchmark).collect()) == kept
    assert set(kept) == {d for d, _ in rows} - {r[0] for r in whole}


def test_edge_cases(spark, docs, edges):
    df = docs(edges)
    benchmark = frame(spark, [(1, edges[0][1]), (2, ""), (3, None), (4, "x")])
    assert [(r.doc_id, r.item_id, r.start) for r in leaks(df, benchmark).collect()] == [(None, 1, 0)]
    kept = drop_leaking(df, benchmark)
    assert kept.columns == df.columns and kept.count() == len(edges) - 1
    assert leaks(df, frame(spark, [])).collect() == []
    assert leaks(docs([]), benchmark).collect() == []


def test_small_tables(spark, docs, sample):
    import pyarrow.parquet as pq

    items = [tuple(r.values()) for r in pq.read_table("/root/testdata/sf0.001/benchmark.parquet").to_pylist()]
    rows = [(r["doc_id"], r["text"]) for r in sample]
    got = {(r.doc_id, r.item_id) for r in leaks(docs(rows), frame(spark, items)).collect()}
    shared = {g: i for i, t in items for g in grams(t)}
    some = [(d, t) for d, t in rows if any(g in shared for g in grams(t))]
    assert got == brute(some, items).keys()
