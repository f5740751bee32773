import hashlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from test_decontaminate import brute as brute_leaks
from test_decontaminate import grams
from test_line_dedup import brute as brute_lines
from test_near_copies import brute_classes
from tokenizers import Tokenizer

from tablewright.llm.hashed import Grams
from tablewright.llm.toxicity import REJECT, toxicity_model
from tablewright.storage import stage

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def order(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


def pairs(df):
    return order((r.doc_id, r.text) for r in df.collect())


def stages(spark, path):
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, step in corpus_pipeline.STAGES:
        before = docs
        docs = stage(step(spark, docs, path), name)
        out.append((before, docs))
    return out


def expected(spark, before, path, name):
    """What a stage should keep, worked out by brute force from what it was given."""
    rows = pairs(before)
    if name == "toxicity":
        model, features = toxicity_model(before, spark.read.parquet(f"{path}/labels.parquet")), Grams(False)
        return [r for r in rows if model.score(features(r[1])) < REJECT]
    if name == "line_dedup":
        return order((d, text) for d, _, _, text in brute_lines(rows))
    if name == "near_duplicates":
        classes = brute_classes(rows)
        return [r for r in rows if r[0] is None or classes[r[0]] == r[0]]
    items = [tuple(r.values()) for r in pq.read_table(f"{path}/benchmark.parquet").to_pylist()]
    shared = {g for _, t in items for g in grams(t)}
    hold = {t for _, t in rows if any(g in shared for g in grams(t)) and brute_leaks([(0, t)], items)}
    return [r for r in rows if r[1] not in hold]


def check(spark, path):
    done = stages(spark, path)
    for (name, _), (before, after) in zip(corpus_pipeline.STAGES[:-1], done):
        assert after.columns == before.columns
        assert pairs(after) == expected(spark, before, path, name), name
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    last, out = done[-1]
    want = {}
    for d, text in pairs(last):
        e = library.encode(text or "", add_special_tokens=False)
        want[d] = (len(e.ids), np.array(e.ids, "<u4").tobytes(), hashlib.sha256(library.decode(e.ids, skip_special_tokens=False).encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in out.collect()} == want
    return done


def test_stages_on_small_tables(spark):
    done = check(spark, "/root/testdata/sf0.001")
    counts = [b.count() for b, _ in done] + [done[-1][1].count()]
    assert counts[0] == 200 and counts == sorted(counts, reverse=True) and counts[-1] < 200
    got = sorted(map(tuple, corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()))
    assert got == sorted(map(tuple, done[-1][1].collect()))


def test_edge_cases(spark, folder, edges):
    rows = [(d, t, None if d == 1 else "en", None, None if t is None else len(t)) for d, t in edges]
    done = check(spark, folder(rows, [(6, 1, 0), (None, 1, 1)], [(1, edges[3][1]), (2, edges[0][1])]))
    assert {r.doc_id for r in done[2][1].collect()} >= {None, 1, 4, 6}
    lines = {r.doc_id: r for r in done[1][1].collect()}
    assert all(lines[d].n_chars == len(lines[d].text) for d in (4, 5, 6, 9, 10))


def test_empty_tables(spark, folder):
    assert corpus_pipeline.run(spark, folder([])).collect() == []


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "encoding"]
    assert corpus_pipeline.ORACLE_SQL is None
