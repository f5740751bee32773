from tablewright.llm.licenses import KNOWN, licenses

MIT = KNOWN[0][1]


def found(df):
    return {(r.doc_id, r.license): (r.is_whole, r.n_paragraphs, r.n_lines) for r in df.collect()}


def test_whole_texts_paragraphs_and_lines(docs):
    rows = [
        (1, MIT),
        (2, "Copyright (c) 2020 Someone\n\n" + MIT.upper().replace(", ", " ,\n ")),
        (3, "Some text.\n\n" + MIT + "\n\nMore text."),
        (4, "Intro\nReleased under the MIT Licence\nOutro\nreleased under the mit license!"),
        (5, "Licensed under CC BY-NC 4.0.\nlicensed under the Apache License version 2.0"),
        (6, "This mentions the MIT license in passing."),
        (7, MIT[:-20]),
    ]
    assert found(licenses(docs(rows))) == {
        (1, "MIT"): (True, 1, 1),
        (2, "MIT"): (True, 1, 0),
        (3, "MIT"): (False, 1, 1),
        (4, "MIT"): (False, 0, 2),
        (5, "CC-BY-NC-4.0"): (False, 0, 1),
        (5, "Apache-2.0"): (False, 0, 1),
    }


def test_every_known_license_is_found_by_its_own_text(docs):
    rows = [(i, text) for i, (_, text) in enumerate(KNOWN)]
    got = found(licenses(docs(rows)))
    assert got == {(i, name): (True, 1, 1) for i, (name, _) in enumerate(KNOWN)}


def test_edge_cases(docs, edges):
    rows = edges + [(None, "Released under the MIT License."), (7, "Released under the MIT License.")]
    assert found(licenses(docs(rows))) == {(None, "MIT"): (True, 1, 1), (7, "MIT"): (True, 1, 1)}
    assert licenses(docs([])).collect() == []
