"""Benchmark decontamination: a prefix-filtered join for exact containment.

An item is cut into windows of ``window`` consecutive words (an item of fewer
words is one window).  Full containment needs every shingle of a window, so its
necessary prefix is its single rarest shingle: occurrences of all the benchmark's
shingles are counted over the whole corpus first, and each window is indexed
under its rarest one.  A document is probed with all of its shingles; a hit fixes
the alignment, so the window's start follows from the shingle's offset (positional
bound) and must leave room for the whole window (length bound).  Every alignment
is then verified word by word.

The benchmark is read to the driver in blocks of ``block_chars`` characters, and
one block at a time is broadcast.  A benchmark of several blocks means two passes over
the documents for each: a block's hits are written, its broadcast is freed, and only
then the next block is read; the hits are put together by row.

Results for odd rows: null or blank texts have no words and no hits; null and
blank items match nothing; items with a null id mark words as hit but are not
listed; repeated item ids count once; rows that repeat doc_id and text are each a
row of the result.  Empty tables give no rows, or rows without hits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import materialize, packed, text_key, unpacked, with_maybe
from ._words import mix, run_hashes

WINDOW = 13
SHINGLE = 3
BLOCK_CHARS = 8_000_000
#: A-Z become a-z; digits, a-z and all beyond ASCII stay; the rest divides words.
_TABLE = bytes(ord(chr(i).lower()) if chr(i).isalnum() and i < 128 or i >= 128 else 32 for i in range(128)) + bytes(range(128, 256))


def item_words(raw: bytes | None) -> list[bytes]:
    return raw.translate(_TABLE).split() if raw else []


class ItemIndex:
    """Windows of one block of items, each under its rarest shingle."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int = WINDOW, shingle: int = SHINGLE):
        self.vocabulary: dict[bytes, int] = {}
        seen: dict[tuple[int, ...], set] = {}
        for item, raw in items:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary)) for w in item_words(raw))
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                seen.setdefault(ids[i : i + window], set()).add(item)
        self.windows = [np.array(w, np.int64) for w in seen]
        self.items = [sorted(x for x in ids if x is not None) for ids in seen.values()]
        codes = mix(np.arange(len(self.vocabulary) + 1, dtype=np.uint64) + np.uint64(1))
        self.codes = codes
        #: shingle size -> for each window of that size: its number
        self.sizes: dict[int, list[int]] = {}
        for i, w in enumerate(self.windows):
            self.sizes.setdefault(min(shingle, len(w)), []).append(i)
        self.shingles = {k: np.unique(np.concatenate([run_hashes(codes[self.windows[i]], k) for i in of])) for k, of in self.sizes.items()}
        self.counts = {k: np.zeros(len(s), np.int64) for k, s in self.shingles.items()}

    def ids(self, words: list[bytes]) -> np.ndarray:
        missing = len(self.vocabulary)
        get = self.vocabulary.get
        return np.fromiter([get(w, missing) for w in words], np.int64, len(words))

    def found(self, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of known shingles in a document, and their numbers."""
        h = run_hashes(self.codes[ids], k)
        near = np.flatnonzero((ids[: len(h)] < len(self.vocabulary)) & (ids[k - 1 :] < len(self.vocabulary)))
        known = self.shingles[k]
        at = np.minimum(np.searchsorted(known, h[near]), len(known) - 1)
        ok = known[at] == h[near]
        return near[ok], at[ok]

    def compile(self) -> "ItemIndex":
        """Choose each window's rarest shingle by the counts."""
        self.under: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for k, of in self.sizes.items():
            lists = self.under[k] = {}
            for i in of:
                s = np.searchsorted(self.shingles[k], run_hashes(self.codes[self.windows[i]], k))
                o = int(np.lexsort((s, self.counts[k][s]))[0])
                lists.setdefault(int(s[o]), []).append((i, o))
        self.keyed = {k: np.isin(np.arange(len(self.shingles[k])), list(lists)) for k, lists in self.under.items()}
        return self

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Word ranges that windows cover, and ids of their items."""
        ranges: list[tuple[int, int]] = []
        items: set = set()
        if not words or not self.windows:
            return ranges, items
        ids = self.ids(words)
        for k, lists in self.under.items():
            if len(ids) < k:
                continue
            at, which = self.found(ids, k)
            keyed = self.keyed[k][which]
            for p, s in zip(at[keyed].tolist(), which[keyed].tolist(), strict=True):
                for i, o in lists[s]:
                    w = self.windows[i]
                    if p >= o and p - o + len(w) <= len(ids) and np.array_equal(ids[p - o : p - o + len(w)], w):
                        ranges.append((p - o, p - o + len(w)))
                        items.update(self.items[i])
        return ranges, items


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list]:
    """Items in blocks of bounded size, one at a time on the driver."""
    held, n = [], 0
    for row in benchmark.select(F.col("item_id"), F.col("text").cast("binary").alias("raw")).where("raw is not null").toLocalIterator():
        held.append((row["item_id"], bytes(row["raw"])))
        n += len(row["raw"])
        if n >= block_chars:
            yield held
            held, n = [], 0
    if held:
        yield held


def _count(base: DataFrame, index: ItemIndex) -> None:
    spark = base.sparkSession
    shared = spark.sparkContext.broadcast(index)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        sums = {k: np.zeros(len(c), np.int64) for k, c in own.counts.items()}
        for batch in batches:
            for raw in batch["raw"].to_pylist():
                ids = own.ids(item_words(raw))
                for k, c in sums.items():
                    if len(ids) >= k:
                        np.add.at(c, own.found(ids, k)[1], 1)
        for k, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int64)), pa.array(c[at])], ["k", "s", "n"])

    for k, s, n in base.select("raw").mapInArrow(scan, "k int, s long, n long").groupBy("k", "s").agg(F.sum("n").alias("n")).toLocalIterator():
        index.counts[k][s] = n  # a row for each shingle of the block at most
    shared.destroy()


_RANGE = pa.struct([("a", pa.int64()), ("b", pa.int64())])
_HITS = "n_words long, ranges array<struct<a: long, b: long>>, items array<string>"


def _scan(index: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """doc_id, row, n_words, ranges and items of every row by the block's index."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            n, ranges, items = [], [], []
            for raw in batch["raw"]:
                words = item_words(raw.as_py())
                r, i = own.hits(words)
                n.append(len(words))
                ranges.append([{"a": x, "b": y} for x, y in _union(r)])
                items.append(sorted(map(str, i)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row"], pa.array(n, pa.int64()), pa.array(ranges, pa.list_(_RANGE)), pa.array(items, pa.list_(pa.string()))], ["doc_id", "row", "n_words", "ranges", "items"])

    return scan


def _covered(ranges: str) -> Column:
    """Number of words that ranges cover, which may overlap."""
    longer = lambda s, x: F.struct(F.greatest(s["end"], x["b"]).alias("end"), (s["n"] + F.greatest(x["b"] - F.greatest(s["end"], x["a"]), F.lit(0))).cast("long").alias("n"))
    none = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.array_sort(ranges), none, longer)["n"]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS, percent: int = 5) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id"), text_key().alias("row"), F.col("text").cast("binary").alias("raw"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def searched(items: list) -> tuple[DataFrame, Broadcast]:
        index = ItemIndex(items, window)
        if items:
            _count(base, index)
        shared = spark.sparkContext.broadcast(index.compile())
        return base.mapInArrow(_scan(shared), f"doc_id {kind}, row long, {_HITS}"), shared

    blocks = _blocks(benchmark, block_chars)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        got, _ = searched(first)
    else:
        written = None
        for items in chain([first, second], blocks):
            hits, shared = searched(items)
            part = materialize(hits.where(F.size("ranges") > 0).groupBy("doc_id", "row").agg(F.first("ranges").alias("ranges"), F.first("items").alias("items")), "hits")
            shared.destroy()
            written = part if written is None else written.unionByName(part)
        found = written.groupBy(F.col("doc_id").alias("id2"), F.col("row").alias("row2")).agg(F.flatten(F.collect_list("ranges")).alias("ranges"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        counted = base.mapInArrow(_scan(spark.sparkContext.broadcast(ItemIndex([], window).compile())), f"doc_id {kind}, row long, {_HITS}").select("doc_id", "row", "n_words")
        none = [F.array().cast(t).alias(c) for c, t in (("ranges", "array<struct<a: long, b: long>>"), ("items", "array<string>"))]
        joined = counted.join(found, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("row") == F.col("row2")), "left")
        got = joined.select("doc_id", "row", "n_words", *[F.coalesce(c, x).alias(c) for c, x in zip(("ranges", "items"), none, strict=True)])
    out = got.withColumn("n_hit", _covered("ranges"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))).alias("contaminated"), "row",
    )


def _union(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = 0) -> DataFrame:
    """``docs`` without the rows of which windows of the benchmark cover ``percent`` of
    the words or more (0: any row that holds a window, however long it is).  A filter of
    fixed size lets clean rows pass without a shuffle; what it holds back is settled by
    an exact join."""
    bad = materialize(decontaminate(docs, benchmark, window, percent=percent).where("contaminated").select(F.col("doc_id").alias("id2"), F.col("row").alias("row2")).distinct().withColumn("key", F.xxhash64("id2", "row2")), "contaminated", docs.count())
    keyed = packed(docs, "doc_id", "text").withColumn("row", text_key()).withColumn("rowkey", F.xxhash64("doc_id", "row"))
    keyed = with_maybe(keyed, "rowkey", bad, "key")
    held = keyed.where("maybe").join(bad.select("id2", "row2"), F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("row") == F.col("row2")), "left_anti")
    return unpacked(keyed.where(~F.col("maybe")).unionByName(held))
