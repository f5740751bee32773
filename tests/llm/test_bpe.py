import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from tablewright.llm.bpe import Tokenizer, encoded, op10_bpe

FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "",
    " ",
    "\n\t\x0b \x85\xa0",
    "İstanbul ΑΣ ΟΔΟΣ Σ ß ǅ ﬁ",
    "don't WE'LL i'M it's 'S ''s l'eau",
    "<|endoftext|>a<|startoftext|> b <|endoftext|",
    "é ́x Å ½ ² ٣ 42 一二三 😀👍🏽 a​b\x1cd\x1fe\x00f",
    "a" * 5000,
    "qzxj" * 400,
    "x" * 100 + "é" * 300 + "!?" * 90,
    "".join(map(chr, range(1, 0x370))),
]


@pytest.fixture(scope="module")
def library():
    return Library.from_file(FILE)


def of_library(library, text):
    e = library.encode(text or "", add_special_tokens=False)
    return e.ids, library.decode(e.ids, skip_special_tokens=False)


def test_ids_and_text_equal_the_library(library, sample, edges):
    own = Tokenizer(FILE)
    for text in ODD + [r["text"] for r in sample] + [t or "" for _, t in edges]:
        ids, decoded = own.encode(text)
        assert (np.frombuffer(ids, "<u4").tolist(), decoded) == of_library(library, text)


def test_random_texts(library):
    r = random.Random(8)
    own = Tokenizer(FILE)
    for _ in range(400):
        text = "".join(r.choice("abcdefghijklmnopqrstuvwxyzQZéñçßа我 '\n.,!?0123-_€") for _ in range(r.randrange(1, 120)))
        ids, decoded = own.encode(text)
        assert (np.frombuffer(ids, "<u4").tolist(), decoded) == of_library(library, text)


def test_no_token_reaches_over_a_forced_boundary():
    own = Tokenizer(FILE)
    for token in own.vocab:
        bare = token.removesuffix(own.end)
        assert all(bare[i : i + 2] in own.joined for i in range(len(bare) - 1))
    assert len(own.joined) < 256 * 256


def test_long_fragments_merge_as_short_ones():
    r = random.Random(9)
    own = Tokenizer(FILE)
    for _ in range(200):
        parts = [r.choice("etaoinsh") for _ in range(r.randrange(1, 60))]
        assert own.merged(list(parts)) == own.merged_long(list(parts))


def test_memory_is_bounded(monkeypatch, library):
    from tablewright.llm import bpe

    monkeypatch.setattr(bpe, "CACHED", 5)
    own = Tokenizer(FILE)
    text = " ".join(f"word{i % 9} other{i}" for i in range(60))
    assert np.frombuffer(own.encode(text)[0], "<u4").tolist() == of_library(library, text)[0]
    assert len(own.words) <= 5 and len(own.pieces) <= 5


def test_edge_cases_and_query(spark, docs, folder, edges, library):
    rows = edges + [(50 + i, t) for i, t in enumerate(ODD)]
    out = encoded(docs(rows), FILE)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    want = []
    for d, t in rows:
        ids, decoded = of_library(library, t)
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    got = [tuple(r) for r in op10_bpe(spark, folder([(d, t, "en", "s", 0) for d, t in rows])).collect()]
    order = lambda r: (r[0] is not None, r[0], r[1])
    assert sorted(got, key=order) == sorted(want, key=order)


def test_empty_table(docs):
    assert encoded(docs([]), FILE).collect() == []
