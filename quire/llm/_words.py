"""Words, their hashes and hashes of runs of words, vectorised with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def words_of(text: bytes | None) -> list[bytes]:
    """Runs without ASCII white space (space, \\t to \\r), A-Z lowered."""
    return text.lower().split() if text else []


class WordHash(dict):
    """Word to 64-bit hash, remembered for up to ``limit`` words at a time."""

    def __init__(self, seed: int = 0, limit: int = 1 << 17):
        super().__init__()
        self.seed, self.limit = seed, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up), 4096)
            cls.up = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, _BASE)])
            cls.down = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, _INVERSE)])
        return cls.up[:n], cls.down[:n]


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words, by one pass of prefix sums."""
    m = len(hashes)
    if m < n:
        return np.empty(0, np.uint64)
    up, down = _Powers.to(m)
    sums = np.zeros(m + 1, np.uint64)
    np.cumsum(hashes * up, out=sums[1:])
    return mix((sums[n:] - sums[: m - n + 1]) * down[: m - n + 1] + np.uint64(n))


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles; fewer words than n make one shingle."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(run_hashes(hashes, min(n, len(hashes))))


def window_minima(values: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Position of the first least value in values[s : s + width] for each start."""
    out = np.empty(len(starts), np.int64)
    view = sliding_window_view(values, width)
    for i in range(0, len(starts), 1 << 15):
        s = starts[i : i + (1 << 15)]
        out[i : i + len(s)] = s + view[s].argmin(axis=1)
    return out


def runs(indexes: np.ndarray, *same: np.ndarray) -> Iterator[tuple[int, int]]:
    """Maximal stretches of consecutive indexes over which ``same`` do not change,
    as pairs (first, last) of positions in ``indexes``."""
    if not len(indexes):
        return
    cut = np.diff(indexes) != 1
    for x in same:
        cut |= x[1:] != x[:-1]
    at = np.flatnonzero(cut)
    yield from zip(np.r_[0, at + 1].tolist(), np.r_[at, len(indexes) - 1].tolist(), strict=True)


def rows_in(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows as dicts, one at a time, so that a batch's texts are not copied at once."""
    names = batch.schema.names
    for i in range(batch.num_rows):
        yield {n: c[i].as_py() for n, c in zip(names, batch.columns, strict=True)}


def rows_out(schema: pa.Schema, columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
