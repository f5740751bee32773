import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tablewright.llm import quality, toxicity
from tablewright.llm.fitting import fit, labelled_sample, remainder
from tablewright.llm.hashed import Grams, ftrl


def clean(r, n=40):
    return " ".join(f"w{r.randrange(400)}" for _ in range(n))


def corpus(n, seed=1):
    """Texts of which some are toxic (a bad word), some of bad quality (capitals)."""
    r = random.Random(seed)
    rows, labels = [], []
    for d in range(n):
        text, toxic, good = clean(r), d % 4 == 1, d % 5 != 2
        if toxic:
            text += " you utter vilething"
        if not good:
            text = " ".join(w.upper() + "!!" for w in text.split())
        rows.append((d, text))
        labels.append((d, int(good), int(toxic)))
    return rows, labels


def frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def corpus_():
    return corpus(500)


def test_grams_are_counts_of_whole_texts():
    features, counts = Grams(False)("A b a b")
    assert counts.sum() == 4 + 3 + 4  # words, pairs, first letters
    assert np.array_equal(features, np.sort(features))
    assert all(len(Grams(s)(t)[0]) == 0 for s in (True, False) for t in (None, "", " \n "))


def test_ftrl_learns_and_drops_rare_features():
    r = random.Random(2)
    rows, labels = corpus(400)
    grams = Grams(False)
    x, y = [grams(t) for _, t in rows], [l[2] for l in labels]
    model = ftrl(x, y, normed=False, l1=1.0)
    assert model.score(grams(clean(r) + " you utter vilething")) > 0.5 > model.score(grams(clean(r)))
    assert model.score(grams("unseen words only")) == model.score(grams(""))


def test_counterfactuals_swap_terms_of_one_kind():
    text = "The Women spoke. Nothing here. A muslim and a christian met."
    a, b = toxicity.counterfactuals(text)
    assert a == "The men spoke. Nothing here. A christian and a jewish met."
    assert b != a and "Nothing here." in b
    assert list(toxicity.counterfactuals("no such mention, manly womens")) == []


def test_penalty_reduces_the_change_of_scores():
    """Labels lean on who is mentioned; with the penalty the model does much less so."""
    r = random.Random(3)
    texts, labels = [], []
    for i in range(400):
        bad = i % 2
        text = clean(r, 12) + (" vilething" if bad and i % 3 else "")
        texts.append(text + (" muslim" if bad else " christian"))
        labels.append(bad)
    grams = Grams(False)
    x = [grams(t) for t in texts]
    versions = [[grams(v) for v in toxicity.counterfactuals(t)] for t in texts]
    change = {}
    for balance in (0.0, 2.0):
        m = ftrl(x, labels, versions, normed=False, l1=1.0, balance=balance)
        probe = clean(r, 12)
        change[balance] = abs(m.raw(grams(probe + " muslim")) - m.raw(grams(probe + " christian")))
        assert m.raw(grams(probe + " vilething")) > m.raw(grams(probe))
    assert change[2.0] < 0.3 * change[0.0]


def test_held_out_accuracy(spark, docs, corpus_):
    rows, labels = corpus_
    df, known = docs(rows), frame(spark, labels)
    for module, folds, held, column, scored in (
        (quality, quality.FOLDS, quality.HELD_OUT, 1, lambda: quality.quality_scores(df, quality.quality_model(df, known))),
        (toxicity, toxicity.FOLDS, toxicity.HELD_OUT, 2, lambda: toxicity.toxicity_scores(df, toxicity.toxicity_model(df, known))),
    ):
        out = [d for d in range(len(rows)) if zlib.crc32(str(d).encode()) % folds == held]
        score = {r.doc_id: r.score for r in scored().collect()}
        assert len(score) == len(rows) and all(0 <= s <= 1 for s in score.values())
        assert np.mean([(score[d] >= 0.3) == labels[d][column] for d in out]) > 0.95


def test_fit_never_sees_held_out_labels(spark, docs, corpus_):
    rows, labels = corpus_
    turned = [(d, q if zlib.crc32(str(d).encode()) % 5 else 1 - q, t if zlib.crc32(str(d).encode()) % 4 != 2 else 1 - t) for d, q, t in labels]
    df = docs(rows)
    a, b = (quality.quality_model(df, frame(spark, x)) for x in (labels, turned))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias
    a, b = (toxicity.toxicity_model(df, frame(spark, x)) for x in (labels, turned))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_sample_is_bounded(spark, docs, corpus_):
    rows, labels = corpus_
    sample = labelled_sample(docs(rows + rows[:50]), frame(spark, labels + labels[:9]), "toxic", remainder(4) != 2, 60).collect()
    assert len(sample) == 60 == len({r.doc_id for r in sample})


def test_edge_cases_are_scored(spark, docs, edges):
    labels = frame(spark, [(None, 1, 1), (6, None, None), (99, 1, 0), (1, 1, 0), (3, 0, 1), (7, 1, 0)])
    df = docs(edges)
    for scored in (quality.quality_scores(df, quality.quality_model(df, labels)), toxicity.toxicity_scores(df, toxicity.toxicity_model(df, labels))):
        assert len(scored.collect()) == len(edges)
        assert all(0 <= r.score <= 1 for r in scored.collect())
    kept = toxicity.reject_toxic(df, toxicity.toxicity_model(df, frame(spark, [])))
    assert kept.columns == df.columns and kept.count() == len(edges)


def test_labels_of_one_kind(spark, docs, corpus_):
    rows, labels = corpus_
    one = frame(spark, [(d, 1, 0) for d, _, _ in labels])
    df = docs(rows)
    assert {round(r.score, 6) for r in quality.quality_scores(df, quality.quality_model(df, one)).collect()} == {1.0}
    assert {round(r.score, 6) for r in toxicity.toxicity_scores(df, toxicity.toxicity_model(df, one)).collect()} == {0.0}


def test_empty_tables(spark, docs):
    df = docs([])
    assert quality.quality_scores(df, quality.quality_model(df, frame(spark, []))).collect() == []
    sample = labelled_sample(df, frame(spark, []), "toxic", remainder(4) != 2, 5)
    assert len(fit(sample, False, normed=False).weights) == 0


def test_queries(spark, folder):
    rows, labels = corpus(120)
    path = folder([(d, t, "en", "s", len(t)) for d, t in rows] + [(None, None, None, None, None)], labels)
    for query, folds, held in ((quality.op2_quality, 5, 0), (toxicity.op4_toxicity, 4, 2)):
        out = query(spark, path).collect()
        assert len(out) == 121
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in out if r.doc_id is not None)
        assert all(r.predicted == int(r.score >= 0.3) for r in out)


def plain_ftrl(rows, labels, swapped, normed, balance, least_rows=2, alpha=0.3, beta=1.0, l1=1.0, l2=1.0, epochs=4, seed=3):
    """The same model by loops over dictionaries, one weight at a time."""
    in_rows = Counter(f for features, _ in rows for f in features.tolist())
    kept = {f for f, n in in_rows.items() if n >= least_rows}

    def values(row):
        counts = dict(zip(row[0].tolist(), row[1].tolist()))
        if not normed:
            return {f: 1.0 for f in counts if f in kept}
        length = max(1.0, math.sqrt(sum((1 + math.log(c)) ** 2 for c in counts.values())))
        return {f: (1 + math.log(c)) / length for f, c in counts.items() if f in kept}

    z, n = defaultdict(float), defaultdict(float)

    def weight(f):
        penalty = 0.0 if f == "bias" else l1
        if abs(z[f]) <= penalty:
            return 0.0
        return -(z[f] - math.copysign(penalty, z[f])) / ((beta + math.sqrt(n[f])) / alpha + l2)

    def update(gradients):
        before = {f: weight(f) for f in gradients}
        for f, g in gradients.items():
            z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / alpha * before[f]
            n[f] += g * g

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            x = values(rows[i]) | {"bias": 1.0}
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weight(f) * v for f, v in x.items())))))
            update({f: (p - labels[i]) * v for f, v in x.items()})
            for version in swapped[i]:
                u = values(version)
                change = {f: x.get(f, 0.0) - u.get(f, 0.0) for f in (set(x) | set(u)) - {"bias"}}
                change = {f: c for f, c in change.items() if c}
                apart = balance * sum(weight(f) * c for f, c in change.items())
                update({f: apart * c for f, c in change.items()})
    return {f: weight(f) for f in kept if weight(f)}, weight("bias")


@pytest.mark.parametrize("normed,balance", [(False, 0.0), (True, 0.0), (True, 4.0), (False, 2.0)])
def test_ftrl_equals_plain_loops(normed, balance):
    r, grams = random.Random(9), Grams(True)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(r.choices(words[: 40 if i % 3 else 60], k=r.randrange(0, 30))) for i in range(150)]
    labels = [int("w45" in t or "w3 " in t) for t in texts]
    rows = [grams(t) for t in texts]
    swapped = [[grams(t.replace("w7", "w8")), grams(t.replace("w1 ", "w50 "))] if balance else [] for t in texts]
    model = ftrl(rows, labels, swapped, normed=normed, balance=balance, least_rows=2)
    weights, bias = plain_ftrl(rows, labels, swapped, normed, balance)
    assert dict(zip(model.features.tolist(), model.weights.tolist())) == pytest.approx(weights, rel=1e-9)
    assert model.bias == pytest.approx(bias, rel=1e-9) and len(weights) > 20
