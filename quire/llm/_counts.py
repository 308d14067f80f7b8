"""Counting many hashed keys, kept as a log-frequency Bloom filter.

Workers count the keys of their own rows, and send each distinct key once per
batch as four bytes (the segment number holds its leading bits).  A segment's
counts are added up in one task, quantised to levels ``1 + floor(log2 count)``,
and every level up to a key's own is set as bits of that segment's slice.  A key
that all rows hold arrives once per batch, so no segment is hot.  What is collected
and broadcast at once has at most ``MAX_BITS`` bits: a whole filter where its caller
bounds it, else a part of one, which covers a range of segments.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import partitions
from ._words import mix, rows_in

MAX_BITS = 1 << 30
_FLUSH = 1 << 19
_BLOB = pa.schema([("seg", pa.int32()), ("keys", pa.binary()), ("more", pa.binary())])


def bits_for(keys: int, most: int | None = MAX_BITS) -> int:
    """A power of two of bits near the number of keys, 1 Mbit at least and ``most`` at
    most (None: no bound)."""
    bits = 1 << max(20, (max(1, keys) - 1).bit_length())
    return bits if most is None else min(most, bits)


def segments_for(spark: SparkSession, keys: int = 0) -> int:
    """Enough segments for a task each, growing with the session's partitions, and for
    some 2**22 of the ``keys`` each, so that a segment fits a task at any size."""
    return 1 << max(min(14, max(6, (4 * partitions(spark) - 1).bit_length())), (keys >> 22).bit_length())


def pack(keys: np.ndarray, counts: np.ndarray, segments: int) -> pa.RecordBatch:
    """Sorted distinct keys with their counts, as a row for each segment."""
    shift = np.uint64(64 - (segments.bit_length() - 1))
    seg = (keys >> shift).astype(np.int64) if segments > 1 else np.zeros(len(keys), np.int64)
    rest = ((keys >> (shift - np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    at = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]]) if len(seg) else np.empty(0, np.int64)
    cols: tuple[list, list, list] = ([], [], [])
    for a, b in zip(at, np.r_[at[1:], len(seg)], strict=True):
        c = counts[a:b]
        many = np.flatnonzero(c > 1)
        cols[0].append(int(seg[a]))
        cols[1].append(rest[a:b].tobytes())
        cols[2].append(np.stack([many, c[many]]).astype(np.uint32).tobytes())
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(cols, _BLOB, strict=True)], schema=_BLOB)


def unpack(keys: Iterable[bytes], more: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of one segment and their counts."""
    ks, cs = [], []
    for k, m in zip(keys, more, strict=True):
        ks.append(np.frombuffer(k, np.uint32))
        c = np.ones(len(ks[-1]), np.int64)
        at, n = np.frombuffer(m, np.uint32).reshape(2, -1)
        c[at] = n
        cs.append(c)
    k, c = np.concatenate(ks), np.concatenate(cs)
    o = np.argsort(k, kind="stable")
    k, c = k[o], c[o]
    at = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    return k[at], np.add.reduceat(c, at)


class LogFilter:
    """Log-frequency Bloom filter: quantised counts read back by repeated probes.

    ``data`` holds the slices of the segments ``start`` to ``stop`` (all, if not given);
    only keys that lie in these may be probed.
    """

    def __init__(self, data: np.ndarray, segments: int, hashes: int, top: int, start: int = 0, stop: int | None = None):
        self.data, self.segments, self.hashes, self.top, self.start = data, segments, hashes, top, start
        self.slice = len(data) * 8 // ((segments if stop is None else stop) - start)

    def _slots(self, rest: np.ndarray, level: int) -> Iterator[np.ndarray]:
        h = mix(rest.astype(np.uint64) + np.uint64(level << 40))
        step = (h >> np.uint64(32)) | np.uint64(1)
        for i in range(self.hashes):
            yield (h + np.uint64(i) * step) & np.uint64(self.slice - 1)

    def split(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = np.uint64(64 - (self.segments.bit_length() - 1))
        return keys >> shift, (keys >> (shift - np.uint64(32))) & np.uint64(0xFFFFFFFF)

    def levels(self, keys: np.ndarray, first: int = 1) -> np.ndarray:
        """Level of each key, 0 where it misses the ``first`` level."""
        out = np.zeros(len(keys), np.uint8)
        if not len(keys):
            return out
        left = np.arange(len(keys))
        seg, rest = self.split(keys)
        base = (seg - np.uint64(self.start)) * np.uint64(self.slice)
        for level in range(first, self.top + 1):
            hit = np.ones(len(left), bool)
            for slot in self._slots(rest, level):
                p = base + slot
                hit &= (self.data[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 > 0
            left, base, rest = left[hit], base[hit], rest[hit]
            if not len(left):
                break
            out[left] = level
        return out


def key_blobs(docs: DataFrame, keys_of: Callable[[], Callable[[dict], np.ndarray]], segments: int, flush: int = _FLUSH) -> DataFrame:
    """Rows of packed keys.  ``keys_of()`` is called once in a worker and gives a
    function from a row (a dict of the columns) to an array of 64-bit keys."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, held, n = keys_of(), [], 0
        for batch in batches:
            for row in rows_in(batch):
                k = f(row)
                if len(k):
                    held.append(k)
                    n += len(k)
                if n >= flush:
                    yield pack(*np.unique(np.concatenate(held), return_counts=True), segments)
                    held, n = [], 0
        if n:
            yield pack(*np.unique(np.concatenate(held), return_counts=True), segments)

    return docs.mapInArrow(scan, "seg int, keys binary, more binary")


def filter_slices(blobs: DataFrame, segments: int, bits: int, hashes: int = 1, first: int = 1, top: int = 24) -> DataFrame:
    """(seg, bits, n, used): the filter's slices from ``key_blobs``, with the numbers of
    distinct keys and of bits that were set; levels below ``first`` set no bits."""
    empty = LogFilter(np.zeros(0, np.uint8), segments, hashes, top)
    empty.slice = max(8, bits) // segments

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        keys, counts = unpack((x.as_buffer() for x in rows["keys"]), (x.as_buffer() for x in rows["more"]))
        mine = np.zeros(empty.slice, np.uint8)
        level = np.minimum(top, np.floor(np.log2(counts)).astype(np.int64) + 1)
        for x in range(first, int(level.max()) + 1):
            for slot in empty._slots(keys[level >= x], x):
                mine[slot] = 1
        return pa.table({"seg": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(mine, bitorder="little").tobytes()], pa.binary()), "n": pa.array([len(keys)], pa.int64()), "used": pa.array([int(mine.sum())], pa.int64())})

    return blobs.groupBy("seg").applyInArrow(build, "seg int, bits binary, n long, used long")


def gathered(slices: DataFrame, segments: int, bits: int, hashes: int = 1, top: int = 24, start: int = 0, stop: int | None = None) -> tuple[LogFilter, dict]:
    """The filter's segments ``start`` to ``stop`` (all, if not given) on the driver, with
    the numbers of distinct keys and of bits that were set."""
    if stop is None:
        stop = segments
    else:
        slices = slices.where((F.col("seg") >= start) & (F.col("seg") < stop))
    got = slices.toArrow()
    per = bits // 8 // segments
    data = np.zeros(per * (stop - start), np.uint8)
    for seg, b in zip(got["seg"].to_pylist(), got["bits"], strict=True):
        data[(seg - start) * per : (seg - start + 1) * per] = np.frombuffer(b.as_buffer(), np.uint8)
    return LogFilter(data, segments, hashes, top, start, stop), {"keys": sum(got["n"].to_pylist()), "used": sum(got["used"].to_pylist()), "bits": len(data) * 8}


def log_filter(blobs: DataFrame, segments: int, bits: int, hashes: int = 1, first: int = 1, top: int = 24) -> tuple[LogFilter, dict]:
    """The whole filter from ``key_blobs``; levels below ``first`` set no bits.

    Returns it with the numbers of distinct keys and of bits that were set.
    """
    return gathered(filter_slices(blobs, segments, bits, hashes, first, top), segments, bits, hashes, top)


def total_chars(docs: DataFrame) -> int:
    return docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
