"""Helpers for tasks that read texts as Arrow batches. Only small, bounded state is kept per task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Distinct words whose hashes a task remembers before it starts afresh.
CACHED_WORDS = 200_000


class WordHashes(dict):
    """64-bit hashes of words, remembered for a bounded number of distinct words."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, self.seed)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of the named columns as Python values, a few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)


def record_batches(items: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``size`` rows from tuples in the order of ``schema``."""
    held: list[tuple] = []
    for item in items:
        held.append(item)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(values, field.type) for values, field in zip(zip(*held), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)
