"""BPE encoding by forced boundaries.

Two bytes that stand next to each other inside no token of the vocabulary can never be merged into one,
so between them every encoding has a cut. Texts are cut at white space and by the split pattern, pieces are
cut at such byte pairs, and the fragments are merged independently and their ids put together. Fragments
and words repeat, so each task remembers a bounded number of them.

The vocabulary is read from a tokenizer file in JSON: BPE over byte characters with a suffix that marks the
end of a piece, a normalizer of composition, white space and lower case, no decoder.

Defined cases: a null text is an empty one, which has no ids; special tokens written in a text are their ids,
as in the library; rows that repeat are encoded alike; very long texts are encoded whole; an empty table gives no row; other columns are
not looked at.
"""

from __future__ import annotations

import heapq
import json
import struct
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import record_batches, rows

#: Words, and pieces of words, that a task remembers before it starts afresh, and characters of the longest.
CACHED = 400_000
LONGEST = 64
#: Fixed value: the split pattern of the tokenizer file.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SPACES = regex.compile(r"\p{White_Space}+")
ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if it is one, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(free)
            free += 1
    return [out[b] for b in range(256)]


class Tokenizer:
    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.ranks = {tuple(pair): i for i, pair in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.vocab | self.special).items()}
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.bytes = byte_characters()
        bare = (t.removesuffix(self.end) for t in self.vocab)
        self.joined = {t[i : i + 2] for t in bare for i in range(len(t) - 1)}
        self.words: dict[str, tuple[bytes, str]] = {}
        self.pieces: dict[str, tuple[bytes, str]] = {}

    def encode(self, text: str) -> tuple[bytes, str]:
        """The ids as little-endian 32-bit numbers, and the decoded text: the tokens joined by spaces."""
        found: list[tuple[bytes, str]] = []
        for i, part in enumerate(self.marks.split(text) if self.marks else [text]):
            if i % 2:
                found.append(self.tokens_of([self.special[part]]))
            elif part:
                found += map(self.word, words_of(normalized(part)))
        return b"".join([ids for ids, _ in found]), " ".join([tokens for _, tokens in found])

    def tokens_of(self, ids: list[int]) -> tuple[bytes, str]:
        return struct.pack(f"<{len(ids)}I", *ids), " ".join([self.tokens[i] for i in ids])

    def word(self, word: str) -> tuple[bytes, str]:
        """Ids and tokens of a word between white space."""
        known = self.words.get(word)
        if known is None:
            found = [self.piece(p) for p in PIECES.findall(word)]
            known = found[0] if len(found) == 1 else (b"".join([i for i, _ in found]), " ".join([t for _, t in found]))
            remember(self.words, word, known)
        return known

    def piece(self, piece: str) -> tuple[bytes, str]:
        """Ids and tokens of a piece: those of its fragments between forced boundaries, one after the other."""
        known = self.pieces.get(piece)
        if known is None:
            plain = piece.isascii() and piece.isprintable()
            signs = piece if plain else "".join([self.bytes[b] for b in piece.encode()])
            cuts = [i for i in range(1, len(signs)) if signs[i - 1 : i + 1] not in self.joined]
            ids: list[int] = []
            for start, end in zip([0, *cuts], [*cuts, len(signs)]):
                ids += self.fragment(signs[start:end], end == len(signs))
            known = self.tokens_of(ids)
            remember(self.pieces, piece, known)
        return known

    def fragment(self, signs: str, last: bool) -> list[int]:
        parts = [*signs[:-1], signs[-1] + self.end * last]
        merged = self.merged(parts) if len(parts) <= 48 else self.merged_long(parts)
        return [self.vocab[p] for p in merged]

    def merged(self, parts: list[str]) -> list[str]:
        """Merge the pair of the lowest rank, the leftmost of equals, until none is left."""
        get, none = self.ranks.get, len(self.ranks)
        ranks = [get(p, none) for p in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), none)
        return parts

    def merged_long(self, parts: list[str]) -> list[str]:
        """The same for a long fragment, with a heap over linked parts."""
        n, get = len(parts), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := get((a, b))) is not None]
        heapq.heapify(heap)
        parts = [*parts, None]
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j], after[i] = a + b, None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p in parts if p is not None]


def remember(known: dict, key: str, value) -> None:
    if len(key) <= LONGEST:
        if len(known) >= CACHED:
            known.clear()
        known[key] = value


def words_of(text: str) -> list[str]:
    """The parts between white space. str.split() also splits at four control characters that are none."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [w for w in SPACES.split(text) if w]
    return text.split()


def normalized(text: str) -> str:
    """Composed, in lower case character by character (so that no letter depends on its neighbours)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:
            return "".join([c.lower() for c in text])
    return text.lower()


def encoded(docs: DataFrame, file: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every row; ``ids`` are little-endian unsigned 32-bit numbers."""

    def run(batches):
        tokenizer = Tokenizer(file)

        def one(doc_id, text):
            ids, decoded = tokenizer.encode(text or "")
            return doc_id, len(ids) // 4, ids, decoded

        return record_batches((one(*r) for r in rows(batches, "doc_id", "text")), ENCODED, 256)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def digests(docs: DataFrame, file: str) -> DataFrame:
    return encoded(docs, file).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256")
    )


def op10_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(docs, public_tokenizers.path("word_bpe_49k.json"))
