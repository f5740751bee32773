import random

import xxhash

from tablewright.llm import substring


def brute(rows):
    """Words left of each document in the order of ids, and of ``version`` where they are equal."""
    seen, out = set(), {}
    for d, text in sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[0], version(r[1]))):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - 19):
            window = tuple(words[s : s + 20])
            if window in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(window)
        out.setdefault(d, []).append((len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return {d: sorted(rows) for d, rows in out.items()}


def version(text):
    """The hash of a text as Spark makes it: the seed for a null."""
    value = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (value >> 63 << 64)


def found(df):
    out = {}
    for r in df.collect():
        if r.doc_id is not None:
            out.setdefault(r.doc_id, set()).add((r.n_words, r.n_removed, r.kept))
    return {d: sorted(rows) for d, rows in out.items()}


def passages(seed, n):
    """Documents of a few words, many of them out of passages that others have too."""
    r = random.Random(seed)
    pool = [[f"p{i}q{r.randrange(50)}" for _ in range(r.randrange(15, 70))] for i in range(12)]
    out = []
    for d in range(n):
        words = []
        for _ in range(r.randrange(1, 8)):
            kind = r.random()
            if kind < 0.5:
                a = r.choice(pool)
                s = r.randrange(len(a))
                words += a[s : s + r.randrange(5, 70)]
            elif kind < 0.6:
                words += ["same"] * r.randrange(1, 60)
            else:
                words += [f"w{r.randrange(10_000)}" for _ in range(r.randrange(1, 40))]
        out.append((d, " ".join(words)))
    return out


def test_passages_equal_brute_force(docs):
    rows = passages(1, 250)
    assert found(substring.drop_repeated_passages(docs(rows))) == brute(rows)


def test_small_alphabet(docs):
    r = random.Random(5)
    rows = [(d, " ".join(r.choice("ab") for _ in range(r.randrange(0, 300)))) for d in range(60)]
    assert found(substring.drop_repeated_passages(docs(rows))) == brute(rows)


def test_edge_cases(docs, edges):
    df = substring.drop_repeated_passages(docs(edges))
    assert found(df) == brute(edges)
    without = [(r.n_words, r.n_removed) for r in df.collect() if r.doc_id is None]
    assert sorted(without) == [(0, 0), (16, 0)]
    assert sum(r.doc_id == 7 for r in df.collect()) == 2


def test_one_id_with_different_texts(docs):
    """Rows that share a doc_id are documents of their own."""
    r, u, v = (" ".join(f"{k}{i}" for i in range(25)) for k in "ruv")
    rows = [(1, r), (5, f"{u} {r}"), (5, f"{r} {v}"), (5, f"{r} {v}"), (6, f"{v} {u}"), (6, None), (6, f"{u} new")]
    got = found(substring.drop_repeated_passages(docs(rows)))
    assert got == brute(rows)
    assert [x[1] for x in got[5]] == [25, 25]


def test_small_tables(docs, sample):
    rows = [(r["doc_id"], r["text"]) for r in sample]
    assert found(substring.drop_repeated_passages(docs(rows))) == brute(rows)


def test_empty_table(docs):
    assert substring.drop_repeated_passages(docs([])).collect() == []


def test_parts_hold_every_window_once(monkeypatch):
    monkeypatch.setattr(substring, "CHUNK", 64)
    hasher = substring.Hasher()
    for n in (0, 19, 20, 64, 83, 84, 200):
        words = [b"%d" % i for i in range(n)]
        blocks = [substring.blocks_of([p], hasher) for p in substring.chunks((1, 1), words)]
        windows = [s + k for b in blocks for s, m in zip(b[4].tolist(), b[5].tolist()) for k in range(m)]
        assert windows == list(range(max(0, n - 19)))


def test_blocks_do_not_depend_on_neighbours():
    hasher = substring.Hasher()
    words = [b"%d" % (i * i % 701) for i in range(500)]
    alone = substring.blocks_of([((1, 5), 0, words)], hasher)
    bundled = substring.blocks_of([((7, 5), 0, words[:90]), ((1, 5), 0, words), ((8, 5), 0, words[50:])], hasher)
    own = bundled[2] == 1
    assert all((a == b[own]).all() for a, b in zip(alone, bundled))
