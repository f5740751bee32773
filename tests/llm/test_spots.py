import hashlib
import random
import re

from pyspark.sql import functions as F

from tablewright.llm.spots import ANCHORS, jaccard, near_pairs, op8_spots, with_next, with_spots


def chains(text):
    """Spots of a text as tuples of words."""
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    content = [(i, w) for i, w in enumerate(words) if w not in ANCHORS]
    out = {(words[i - 1], a, b) for (i, a), (_, b) in zip(content, content[1:]) if i and words[i - 1] in ANCHORS}
    if out or not words:
        return out
    return set(zip(words, words[1:])) or {tuple(words)}


def like(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_likeness_equals_that_of_the_chains(spark, sample, edges):
    rows = [(i, t) for i, t in enumerate([r["text"] for r in sample[:80]] + [t for _, t in edges] + ["the the the", "one", "of a cat and the dog ran"])]
    df = with_spots(spark.createDataFrame(rows, "doc_id long, text string"), "text", "spots")
    other = df.select((F.col("doc_id") + 1).alias("doc_id"), F.col("spots").alias("before"))
    got = {r.doc_id: (r.n, r.like) for r in df.join(other, "doc_id").select("doc_id", F.size("spots").alias("n"), jaccard("spots", "before").alias("like")).collect()}
    for (_, before), (i, text) in zip(rows, rows[1:]):
        assert got[i][0] == len(chains(text))
        assert abs(got[i][1] - like(chains(text), chains(before))) < 1e-9


def test_next_document(docs):
    r = random.Random(4)
    ids = r.sample(range(10_000), 300)
    rows = [(i, f"text {i}") for i in ids]
    got = {x.doc_id: x.next_text for x in with_next(docs(rows), ["text"]).collect()}
    ids.sort()
    assert got == {a: f"text {b}" for a, b in zip(ids, ids[1:] + ids[:1])}


def test_next_of_edge_cases(docs, edges):
    rows = with_next(docs(edges), ["text"]).collect()
    assert len(rows) == len(edges)
    by_id = {r.doc_id: r.next_text for r in rows if r.doc_id not in (None, 7)}
    assert by_id[2] == edges[4][1] and by_id[5] == edges[7][1]
    assert len(with_next(docs([(1, "a")]), ["text"]).collect()) == 1
    assert with_next(docs([(1, "a")]), ["text"]).first().next_text == "a"
    assert with_next(docs([]), ["text"]).collect() == []


def test_near_pairs_equal_all_pairs(docs):
    r = random.Random(6)
    rows = []
    for i in range(120):
        words = [f"w{r.randrange(30)}" for _ in range(r.randrange(3, 60))]
        rows.append((i, " the ".join(words)))
        if i % 3 == 0:
            words[r.randrange(len(words))] = "changed"
            rows.append((1000 + i, " the ".join(words)))
            rows.append((2000 + i, rows[-2][1]))
    for least in (0.8, 0.6):
        pairs, members = near_pairs(with_spots(docs(rows), "text", "spots"), least)
        named = {x.doc_id: x.named for x in members.collect()}
        sets = {i: chains(t) for i, t in rows}
        ids = sorted(set(named.values()))
        want = {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if like(sets[a], sets[b]) >= least}
        assert {(p.a, p.b) for p in pairs.collect()} == want and want
        assert all(named[2000 + i] == i for i in range(0, 120, 3))


def test_pruning_by_length(spark):
    df = spark.createDataFrame([([1, 2], [1, 2, 3, 4]), ([], []), ([1], [])], "a array<int>, b array<int>")
    assert [r[0] for r in df.select(jaccard("a", "b", 0.6)).collect()] == [0.0, 1.0, 0.0]
    assert [r[0] for r in df.select(jaccard("a", "b")).collect()] == [0.5, 1.0, 0.0]


def test_query(spark, folder, sample):
    rows = sorted(((r["doc_id"], r["text"]) for r in sample), key=lambda r: r[0])
    got = {r.doc_id: r for r in op8_spots(spark, folder([(d, t, "en", "s", 0) for d, t in rows])).collect()}
    for (d, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[d].n_chars == len(text)
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(got[d].near_edited - like(chains(text), chains(edited))) < 1e-9
        assert abs(got[d].near_next - like(chains(text), chains(after))) < 1e-9
    prints = {}
    assert all(prints.setdefault(t, got[d].fingerprint) == got[d].fingerprint for d, t in rows)


def test_query_without_python(spark, folder, sample, capsys):
    path = folder([(r["doc_id"], r["text"], "en", "s", 0) for r in sample])
    op8_spots(spark, path).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
