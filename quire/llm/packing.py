"""Conflict-constrained best-fit packing.

Whole texts, measured in words, are put into bins (training sequences) of
``capacity`` words.  A text longer than that fills whole bins with its first
pieces, and its rest is packed like a text.  Two pieces of one duplicate cluster,
or (``one_per_source``) of one source, never share a bin.

Rows are dealt by a hash of their id and text to cells of about ``cell`` rows, each
packed in one task: neither a hot source, a hot cluster nor an id of many rows makes
a cell large, and bins of different cells share nothing.  In a cell pieces come in the order of falling
length.  Open bins stand by residual; those with equal residual and equal source
bitmap stand together with their cluster bitmaps, so that a step of the successor
search passes over all bins that the source rules out.  The search goes from the
least residual that holds the piece upwards to the first compatible bin: the
tightest one.  If there is none a bin is opened.

Results for odd rows: null and blank texts have no words and no piece (bin null,
pieces 0).  Rows that repeat an id or a text are packed each, in different bins.
Null sources are one source of their own.  Ids come out as they went in, null ones
too.  An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY, CELL = 2048, 20_000


class Bins:
    """Open bins by residual, with the bitmaps of what they hold."""

    def __init__(self, capacity: int, one_per_source: bool = True):
        self.capacity, self.one_per_source = capacity, one_per_source
        self.residuals: list[int] = []  # sorted, those with open bins
        self.at: dict[int, dict[int, list[tuple[int, int]]]] = {}  # residual -> sources -> [(clusters, bin)]
        self.made = 0

    def _put(self, residual: int, sources: int, clusters: int, b: int) -> None:
        if residual <= 0:
            return
        if residual not in self.at:
            insort(self.residuals, residual)
            self.at[residual] = {}
        self.at[residual].setdefault(sources, []).append((clusters, b))

    def place(self, size: int, source: int, cluster: int) -> int:
        """The bin for a piece; source and cluster are one-bit masks."""
        for i in range(bisect_left(self.residuals, size), len(self.residuals)):
            residual = self.residuals[i]
            groups = self.at[residual]
            for sources, held in groups.items():
                if self.one_per_source and sources & source:
                    continue
                for j, (clusters, b) in enumerate(held):
                    if clusters & cluster:
                        continue
                    held[j] = held[-1]
                    held.pop()
                    if not held:
                        del groups[sources]
                    if not groups:
                        del self.at[residual]
                        self.residuals.pop(i)
                    self._put(residual - size, sources | source, clusters | cluster, b)
                    return b
        b, self.made = self.made, self.made + 1
        self._put(self.capacity - size, source, cluster, b)
        return b


def pack_cell(sizes: Iterable[int], sources: Iterable, clusters: Iterable, capacity: int, one_per_source: bool = True) -> list[tuple[int, int, int, int]]:
    """(row, piece, bin, words) for the rows of one cell, in the order packed."""
    pieces = []
    bins = Bins(capacity, one_per_source)
    out = []
    codes: dict = {}
    twice: dict = {}
    for row, (n, s, c) in enumerate(zip(sizes, sources, clusters, strict=True)):
        twice[c] = twice.get(c, 0) + 1
        full, rest = divmod(n, capacity)
        for piece in range(full):
            out.append((row, piece, bins.made, capacity))
            bins.made += 1
        if rest:
            pieces.append((rest, row, full, s, c))
    pieces.sort(key=lambda p: (-p[0], p[1]))
    bits: dict = {}  # only clusters with several rows need a bit
    for rest, row, piece, s, c in pieces:
        cluster = 1 << bits.setdefault(c, len(bits)) if twice[c] > 1 else 0
        out.append((row, piece, bins.place(rest, 1 << codes.setdefault(s, len(codes)), cluster), rest))
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, cell: int = CELL, one_per_source: bool = True, cluster: str | None = None, n_cells: int | None = None) -> DataFrame:
    """doc_id, source, n_words, piece, piece_words, bin, bin_slot for every piece.

    ``bin`` is a string that names the cell and the bin in it.  ``cluster`` names
    a column of duplicate clusters; by default equal texts, apart from case and
    white space, are one.
    """
    lowered = F.lower(F.coalesce(F.col("text"), F.lit("")))
    words = F.filter(F.split(lowered, r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    named = F.xxhash64(F.array_join(words, " ")) if cluster is None else F.xxhash64(F.col(cluster))
    known = docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), F.size(words).cast("long").alias("n_words"), named.alias("cluster"), F.xxhash64("doc_id", "text").alias("h"))
    cells = n_cells or max(1, -(-docs.count() // cell))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, source string, n_words long, piece int, piece_words long, bin string, bin_slot int"

    def fill(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("h", "ascending")])
        sizes, sources = rows["n_words"].to_pylist(), rows["source"].to_pylist()
        packed = pack_cell(sizes, sources, rows["cluster"].to_pylist(), capacity, one_per_source)
        packed += [(row, 0, None, 0) for row, n in enumerate(sizes) if n == 0]
        row, piece, bins, n = ([p[i] for p in packed] for i in range(4))
        used: Counter = Counter()
        at = []
        for b in bins:
            at.append(None if b is None else used[b])
            used[b] += 1
        kept = rows.select(["doc_id", "source", "n_words"]).take(pa.array(row, pa.int64()))
        named = [None if b is None else f"{key[0].as_py()}-{b}" for b in bins]
        more = {"piece": pa.array(piece, pa.int32()), "piece_words": pa.array(n, pa.int64()), "bin": pa.array(named, pa.string()), "bin_slot": pa.array(at, pa.int32())}
        return pa.table({**{c: kept[c] for c in kept.column_names}, **more})

    return known.withColumn("cell", F.pmod(F.xxhash64("h"), F.lit(cells)).cast("int")).groupBy("cell").applyInArrow(fill, schema)
