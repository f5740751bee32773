import hashlib

from tablewright.llm.line_dedup import drop_repeated_lines, keep_bitmaps, op1_line_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows):
    first = {}
    for d, text in rows:
        for line in (text or "").split("\n") if d is not None else ():
            if len(key(line)) >= 10:
                first[key(line)] = min(d, first.get(key(line), d))
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if d is None or len(key(x)) < 10 or first[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


def found(df):
    return order((r.doc_id, r._line_count, r._line_drops, r.text) for r in df.collect())


def test_edge_cases_equal_brute_force(docs, edges):
    assert found(drop_repeated_lines(docs(edges))) == order(brute(edges))


def test_one_id_with_different_texts(docs):
    """Rows that share a doc_id lose lines by their own positions."""
    rows = [
        (1, "aaaaaaaaaaaa\nkeep this line here"),
        (5, "unique first line xx\naaaaaaaaaaaa"),
        (5, "aaaaaaaaaaaa\nanother unique line"),
        (5, "another unique line\nline of 5 and 6"),
        (6, "another unique line\nline of 5 and 6\nan own line of six"),
        (6, "an own line of six"),
    ]
    got = found(drop_repeated_lines(docs(rows)))
    assert got == order(brute(rows))
    assert (5, 2, 1, "unique first line xx") in got and (5, 2, 1, "another unique line") in got


def test_extra_columns_are_kept(docs, edges):
    df = docs(edges)
    assert drop_repeated_lines(df).columns[: len(df.columns)] == df.columns


def test_small_tables_equal_brute_force(docs, sample):
    rows = [(r["doc_id"], r["text"]) for r in sample]
    assert found(drop_repeated_lines(docs(rows))) == order(brute(rows))


def test_hot_line_and_many_lines(docs):
    rows = [(i, "a line that every document has\n" + "\n".join(f"line {i % 7} {j} of a long text" for j in range(150))) for i in range(400)]
    assert found(drop_repeated_lines(docs(rows))) == order(brute(rows))


def test_bitmap_words(docs):
    rows = [(1, "\n".join(f"line number {j}" for j in range(130))), (2, "\n".join(f"line number {j}" if j in (0, 129) else f"own line {j}" for j in range(130)))]
    (row,) = keep_bitmaps(docs(rows)).collect()
    assert (row.doc_id, row.n_dropped) == (2, 2)
    assert [(w.word, w.bits) for w in row.keep_bitmap] == [(0, ~1), (2, ~2)]


def test_empty_table(docs):
    assert drop_repeated_lines(docs([])).collect() == []


def test_query(spark, folder, edges):
    path = folder([(d, t, "en", "s", 0) for d, t in edges])
    got = [tuple(r) for r in op1_line_dedup(spark, path).collect()]
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(edges)]
    assert order(got) == order(want)
