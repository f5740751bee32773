import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        start = at // 8 * 8
        out.append((level[start : start + 8], at - start))
        at //= 8
    return out


def brute(rows):
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` from rows of ``doc_id, text, lang, source, n_chars``."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    order = lambda r: (r[0] is not None, r[0] or 0, leaf(r[0], r[3], r[2], r[4], r[1]))
    held = {lang: sorted((r for r in rows if r[2] == lang), key=order) for lang in langs}
    below = {lang: tree([order(r)[2] for r in held[lang]]) for lang in langs}
    above = tree([below[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (d, text, _, source, n) in enumerate(held[lang]):
            steps = path(below[lang], i) + path(above, k)
            siblings = "".join(x for run, at in steps for j, x in enumerate(run) if j != at)
            now = below[lang][0][i]
            if d is not None and zlib.crc32(str(d).encode()) % 3 == 0:
                now = leaf(d, source, lang, n, text if text is None else text.translate(LOWER))
            for run, at in steps:
                now = h("".join([*run[:at], now, *run[at + 1 :]]))
            root = above[-1][0]
            out.append((d, below[lang][0][i], below[lang][-1][0], root, h(siblings), now, now == root))
    return sorted(out, key=str)


def rows_of(n, langs, seed=1):
    r = random.Random(seed)
    ids = r.sample(range(10 * n), n)
    return [(i, f"Text {i} " * r.randrange(5), r.choice(langs), r.choice(["web", None, "books"]), r.choice([None, i])) for i in ids]


CASES = {
    "edges": [
        (None, None, None, None, None),
        (None, "B", None, "s", 1),
        (1, "", "", "", 0),
        (3, "ÄÖÜ Straße A", "de", "s", 3),
        (3, "other text, same id", "de", "s", 3),
        (3, "other text, same id", "de", "s", 3),
        (2, "X" * 300_000, "en", "s", 300_000),
        (12, "same id, other language", "fr", "s", None),
        (12, "same id, other language", "de", "s", None),
    ],
    "one": [(7, "lone LEAF", "en", "s", 9)],
    "nine": rows_of(9, ["en"]),
    "sixty-five": rows_of(65, ["en", "fr"]),
    "languages": rows_of(100, [f"l{i}" for i in range(23)] + [None]),
    "many": rows_of(700, ["en", "en", "de", None]),
}


def found(spark, folder, rows):
    return sorted((tuple(r) for r in merkle.op13_merkle(spark, folder(rows)).collect()), key=str)


@pytest.mark.parametrize("name", CASES)
def test_query_equals_brute_force(spark, folder, name):
    assert found(spark, folder, CASES[name]) == brute(CASES[name])


def test_more_rounds_with_small_parts(spark, folder, monkeypatch):
    """With parts of one run every level of the trees is a round of its own."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "PART", 8)
    rows = CASES["many"] + CASES["edges"]
    assert found(spark, folder, rows) == brute(rows)


def test_empty_table(spark, folder):
    assert found(spark, folder, []) == []


def test_extra_columns_do_not_clash(spark):
    names = ("tree", "pos", "part", "width", "level", "digest", "leaf", "proof", "root", "tampered")
    df = spark.createDataFrame(CASES["nine"], "doc_id long, text string, lang string, source string, n_chars long")
    out = merkle.proved(merkle.manifest(df.withColumns({n: F.lit("extra") for n in names})))
    assert {r.root for r in out.collect()} == {r[3] for r in brute(CASES["nine"])}


def test_some_leaves_only(spark):
    """Few leaves share what they fetch, and each proof leads to the root."""
    rows = CASES["many"]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    made = merkle.manifest(df)
    wanted = made.languages.parts.select("tree", F.inline("leaves")).where("doc_id % 50 = 0").select("tree", "pos")
    out = merkle.proofs(made.languages, wanted)
    out = out.withColumn("led_to", merkle.folded(F.lower(F.hex("digest")), F.col("proof"))).collect()
    subroots = {r[0]: r[2] for r in brute(rows)}
    assert len(out) == sum(r[0] % 50 == 0 for r in rows)
    assert all(r.top == r.led_to == subroots[r.doc_id] for r in out)


def test_lacking_is_the_smallest_union():
    r = random.Random(3)
    for width in (1, 2, 8, 9, 64, 65, 600):
        at = np.array(sorted(r.sample(range(width), r.randrange(1, min(width, 20) + 1))))
        needed, own = set(), [set(at.tolist())]
        n, level = width, 0
        while n > 1:
            own.append({p // 8 for p in own[-1]})
            needed |= {(level, q) for p in own[level] for q in range(p // 8 * 8, min(n, p // 8 * 8 + 8))}
            n, level = -(-n // 8), level + 1
        derived = {(k, p) for k, places in enumerate(own) for p in places}
        assert {(k, p) for k, places in merkle.lacking(at, width) for p in places.tolist()} == needed - derived
