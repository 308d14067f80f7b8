"""N-gram Jaccard join by T-occurrence search.

A document is the set of its distinct n-word shingles; two documents link when
``den * |A & B| >= num * |A | B|``.  The rows are links between classes (one
class for each distinct set) and the class of every document.  Classes have numbers
of their own; only the result names them and their components by their least ids.

1. Shingles are counted over all documents into a log-frequency filter of fixed
   size (:mod:`._counts`).  It only orders shingles by rarity: a wrong level costs
   time, never a link.
2. Of each set only the rarest ``size - ceil(num/den * size) + 1`` shingles can
   be the first that two linked sets share, and of these only such as other rows
   hold can match.  Lists of equal ones join sets into cells: no link leaves a cell.
3. A cell is searched in one task, or in blocks of some ``block`` sets of like size (a
   count by cell and size tells where they begin, no task sorts a cell): each block
   within itself and against the cell's first block, then what is not in the cell's
   largest component by then against all blocks that sizes allow.  In a task each set is a
   T-occurrence query over inverted lists (DivideSkip): short lists are merged by a
   heap, the longest are probed by binary search for what is left.  Sets already
   linked are not compared again, so a task yields fewer links than it has sets.
4. Links are closed to components (:mod:`._graph`).

Results for odd rows: null and blank texts have no shingles (size 0) and link
with nothing, so their component is their own id.  Rows with equal ids and texts
are equal rows of the result; rows with equal ids and different texts are judged
each by its text (two components may then have the same name).  A null id takes
part in links; a component with no other id has a null root.  Ids are integers.  An
empty table gives an empty result.  Only ``doc_id`` and ``text`` are read, other
columns may have any names.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._counts import bits_for, key_blobs, log_filter, segments_for, total_chars
from ._graph import components
from ._store import KeyBits, materialize, packed, text_key, unpacked, with_maybe
from ._words import WordHash, mix, rows_in, rows_out, shingle_set, words_of

#: Sets in a block, and rows of ids that are broadcast at most (some 10 MB) rather than
#: joined by a shuffle of the sets.
BLOCK, NARROW = 1024, 200_000
_SALT = np.uint64(0x5851F42D4C957F2D)


def shingler(n: int) -> Callable[[], Callable[[dict], np.ndarray]]:
    def make() -> Callable[[dict], np.ndarray]:
        hashes = WordHash()
        return lambda row: shingle_set(hashes.of(words_of(row["raw"])), n)

    return make


def signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    return int(mix(s).sum(dtype=np.uint64).view(np.int64)), int(mix(s ^ _SALT).sum(dtype=np.uint64).view(np.int64))


def prefix_size(size: int, num: int, den: int) -> int:
    return size - -(-num * size // den) + 1


class _Sets:
    """Union-find over the sets of one task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def divide_skip(query: np.ndarray, lists: list[list[int]], t: int, enough: Callable[[int], int], skip: Callable[[int], bool]) -> Iterator[int]:
    """Members of at least ``t`` of the sorted ``lists`` (``enough(member)`` is the
    overlap that this member needs, at least ``t``); members that ``skip`` tells
    are passed over."""
    if len(lists) < t:
        return
    lists = sorted(lists, key=len)
    long = min(t - 1, int(t / (0.0085 * math.log(len(lists[-1]) + 1) + 1)))
    short, rest = lists[: len(lists) - long], lists[len(lists) - long :]
    seen, last = 0, -1
    for member in [*heapq.merge(*short), None]:
        if member == last:
            seen += 1
            continue
        if last >= 0 and seen >= t - long and not skip(last):
            need = enough(last)
            for i, probed in enumerate(rest):
                if seen >= need or seen + len(rest) - i < need:
                    break
                at = bisect_left(probed, last)
                seen += at < len(probed) and probed[at] == last
            if seen >= need:
                yield last
        seen, last = 1, member


def links_within(sets: list[np.ndarray], role: list[int], num: int, den: int) -> Iterator[tuple[int, int]]:
    """A forest of links over ``sets``.  Role 0 is indexed and probes, role 1 is
    only indexed, role 2 only probes.  Sets come in the order of their sizes, but
    for those of role 2, which follow."""
    index: dict[int, list[int]] = {}
    sizes = [len(s) for s in sets]
    group = _Sets(len(sets))
    for i, s in enumerate(sets):
        tokens = s.tolist()
        if role[i] != 1:
            t = -(-num * sizes[i] // den)
            lists = []
            for x in tokens:
                found = index.get(x)
                if found is not None:
                    lists.append(found)
            own = group.find(i)
            for j in divide_skip(s, lists, t, lambda j, n=sizes[i]: max(1, -(-num * (n + sizes[j]) // (num + den))), lambda j: group.find(j) == group.find(i)):
                group.up[group.find(j)] = own
                yield i, j
        if role[i] != 2:
            for x in tokens:
                index.setdefault(x, []).append(i)


def document_sets(docs: DataFrame, n: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(rows, base): for every row its set's size, 128-bit signature and those
    of its prefix shingles that others may hold; and the rows with raw texts."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("row"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw"))
    keys = total_chars(docs) // 6
    segments = segments_for(spark, keys)
    blobs = key_blobs(base.select("raw"), shingler(n), segments)
    rare, _ = log_filter(blobs, segments, bits_for(keys), first=2)
    shared = spark.sparkContext.broadcast(rare)
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("prefix", pa.list_(pa.int64()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets_of, known = shingler(n)(), shared.value
        for batch in batches:
            rows, size = [], 0
            for i, row in enumerate(rows_in(batch)):
                rows.append((row["doc_id"], row["row"], sets_of(row)))
                size += len(rows[-1][2])
                if size > 1 << 17 or i == batch.num_rows - 1:
                    yield described(rows, known)
                    rows, size = [], 0

    def described(rows: list, known) -> pa.RecordBatch:
        cols: dict[str, list] = {f.name: [] for f in schema}
        levels = known.levels(np.concatenate([s for _, _, s in rows]), 2)
        for (doc, key, s), level in zip(rows, np.split(levels, np.cumsum([len(s) for _, _, s in rows])[:-1]), strict=True):
            first = np.lexsort((s, level))[: prefix_size(len(s), num, den)] if len(s) else np.empty(0, np.int64)
            s1, s2 = signature(s)
            for k, v in (("doc_id", doc), ("row", key), ("n", len(s)), ("s1", s1), ("s2", s2), ("prefix", s[first][level[first] > 0].view(np.int64))):
                cols[k].append(v)
        return rows_out(schema, cols)

    rows = materialize(base.mapInArrow(scan, "doc_id long, row long, n long, s1 long, s2 long, prefix array<long>"), "sets")
    shared.destroy()
    return rows, base


def _first() -> Column:
    """The order in which rows stay: by id, null last, then by the hash of the text."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")


def narrow(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(NARROW + 1).count() <= NARROW else df


def _placed(sets: DataFrame, block: int, blk: str) -> DataFrame:
    """Add ``blk``: the sets of a cell in the order of their sizes, some ``block`` to
    each.  Sets of one size are dealt by a hash to quarters of a block; only counts of
    cells' sizes are added up in order."""
    sizes = sets.groupBy("cell", "n").agg(F.count("*").alias("sets"))
    before = F.sum("sets").over(Window.partitionBy("cell").orderBy("n")) - F.col("sets")
    sizes = sizes.select(F.col("cell").alias("cell2"), F.col("n").alias("n2"), before.alias("before"), "sets", F.ceil(F.col("sets") * 4 / block).alias("parts"))
    met = sets.join(narrow(sizes), (F.col("cell") == F.col("cell2")) & (F.col("n") == F.col("n2")))
    at = F.col("before") + F.floor(F.pmod(F.xxhash64("node"), "parts") * F.col("sets") / F.col("parts"))
    return met.withColumn(blk, F.floor(at / block).cast("int")).drop("cell2", "n2", "before", "sets", "parts")


def class_links(rows: DataFrame, base: DataFrame, n: int, num: int, den: int, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(classes, links): every class with its number ``node``, its least id ``rep`` (null
    if its rows have none) and its ``first`` row, and links (a, b) between classes."""
    spark = rows.sparkSession
    classes = rows.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.min(_first()).alias("first"), F.first("prefix").alias("prefix")).withColumn("node", F.monotonically_increasing_id())
    n_rows, listed_rows = rows.agg(F.count("*"), F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()
    classes = materialize(classes, "classes", n_rows)
    listed = classes.select("node", F.explode("prefix").alias("token"))
    hubs = listed.groupBy("token").agg(F.min("node").alias("hub"), F.max("node").alias("other")).where("hub <> other").select("token", "hub")
    met = listed.join(hubs, "token").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    cells = components(met, "cells", listed_rows).withColumnRenamed("root", "cell")
    members = materialize(cells.join(classes.select("node", "rep", "n", "s1", "s2"), "node"), "members", n_rows)

    # The sets themselves, made anew for members only.
    mine = spark.sparkContext.broadcast(KeyBits.of(members.select(F.coalesce("rep", F.lit(0)).alias("rep")), "rep"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets_of = shingler(n)()
        schema = pa.schema([("id", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("tokens", pa.binary())])
        for batch in batches:
            kept = batch.filter(pa.array(mine.value.has(batch["doc_id"].fill_null(0).to_numpy(zero_copy_only=False))))
            cols: dict[str, list] = {f.name: [] for f in schema}
            once = set()
            for row in rows_in(kept):
                s = sets_of(row)
                s1, s2 = signature(s)
                if len(s) and (row["doc_id"], s1, s2) not in once:
                    once.add((row["doc_id"], s1, s2))
                    cols["id"].append(row["doc_id"])
                    cols["s1"].append(s1)
                    cols["s2"].append(s2)
                    cols["tokens"].append(s.tobytes())
            yield rows_out(schema, cols)

    # Of a class the rows of its least id, which may be null.
    found = base.mapInArrow(scan, "id long, s1 long, s2 long, tokens binary").join(narrow(members.select("node", "rep", "s1", "s2")), ["s1", "s2"]).where(F.col("id").eqNullSafe(F.col("rep")))
    sets = materialize(found.dropDuplicates(["node"]).select("node", "tokens"), "tokens")
    mine.destroy()

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["role", "n", "node"])
        sets = [np.frombuffer(b, np.uint64) for b in pdf["tokens"]]
        ids = pdf["node"].tolist()
        found = list(links_within(sets, pdf["role"].tolist(), num, den))
        return pd.DataFrame({"a": [ids[i] for i, _ in found], "b": [ids[j] for _, j in found]}, dtype="int64")

    def searched(dealt: DataFrame) -> DataFrame:
        """Links of tasks: rows (node, n, cell, blk, blk2, role)."""
        return sets.join(narrow(dealt), "node").groupBy("cell", "blk", "blk2").applyInPandas(search, "a long, b long")

    # First each block is searched within itself, and all of a cell against its first
    # block.
    names = ["node", "n", "cell", "blk", "blk2", "role"]
    wide = materialize(members.groupBy("cell").count().where(F.col("count") > block).select(F.col("cell").alias("wide")), "wide", n_rows)
    if wide.isEmpty():
        return classes, searched(members.select("node", "n", "cell", F.lit(0).alias("blk"), F.lit(0).alias("blk2"), F.lit(0).alias("role")))
    small = members.join(narrow(wide), F.col("cell") == F.col("wide"), "left_anti").select("node", "n", "cell", F.lit(0).alias("blk"))
    large = materialize(_placed(members.join(narrow(wide), F.col("cell") == F.col("wide")).select("node", "n", "cell"), block, "blk"), "blocks", n_rows)
    own = small.unionByName(large).select("node", "n", "cell", "blk", F.col("blk").alias("blk2"), F.lit(0).alias("role"))
    last = large.groupBy(F.col("cell").alias("cell2")).agg(F.max("blk").alias("last"))
    heads = large.where("blk = 0").join(narrow(last), F.col("cell") == F.col("cell2")).where("last > 0").withColumn("blk2", F.explode(F.sequence(F.lit(1), F.col("last")))).withColumn("role", F.lit(1))
    tails = large.where("blk > 0").withColumn("blk2", F.col("blk")).withColumns({"blk": F.lit(0), "role": F.lit(2)})
    links = materialize(searched(own.unionByName(heads.select(names)).unionByName(tails.select(names))), "first-links")

    # Then what is not in a cell's largest component yet meets all of the cell's blocks.
    # In a group of near copies that is next to nothing, so its size costs no squares.
    roots = components(links, "first-roots")
    known = large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    most = known.groupBy("cell", "root").count().groupBy("cell").agg(F.max_by("root", F.struct("count", "root")).alias("main"))
    rest = materialize(known.join(narrow(most), "cell").where("root <> main").select("node", "n", "cell"), "outside", n_rows)
    rest = materialize(_placed(rest, block, "blk2"), "rest", n_rows)
    span = lambda df, blk, lo, hi: df.groupBy("cell", blk).agg(F.min("n").alias(lo), F.max("n").alias(hi))
    pairs = span(large, "blk", "lo", "hi").join(span(rest, "blk2", "lo2", "hi2"), "cell").where((F.col("lo2") * num <= F.col("hi") * den) & (F.col("lo") * num <= F.col("hi2") * den)).select("cell", "blk", "blk2")
    index = large.select("node", "n", "cell", "blk").join(pairs, ["cell", "blk"]).withColumn("role", F.lit(1))
    probe = rest.join(pairs, ["cell", "blk2"]).withColumn("role", F.lit(2))
    return classes, links.unionByName(searched(index.select(names).unionByName(probe.select(names))))


def joined(docs: DataFrame, n: int, num: int, den: int, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): the set of every row, and every class with its component's least
    id ``least`` and first row ``stays``."""
    rows, base = document_sets(docs, n, num, den)
    classes, links = class_links(rows, base, n, num, den, block)
    roots = components(links)  # searched in tasks of their own
    named = classes.select("s1", "s2", "n", "node", F.col("rep").alias("class_id"), "first")
    least = roots.join(named.select("node", "class_id", "first"), "node").groupBy("root").agg(F.min("class_id").alias("least"), F.min("first").alias("stays"))
    met = named.join(roots, "node", "left").join(narrow(materialize(least, "least")), "root", "left")
    return rows, met.select("s1", "s2", "n", "class_id", F.coalesce("least", "class_id").alias("least"), F.coalesce("stays", "first").alias("stays"))


def ngram_join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id for every row of ``docs``."""
    rows, classes = joined(docs, n, num, den, block)
    many = rows.select("doc_id", "n", "s1", "s2")
    out = many.where("n > 0").join(classes, ["s1", "s2", "n"]).select("doc_id", F.col("n").alias("n_shingles"), "class_id", F.col("least").alias("component_id"))
    blank = many.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))
    return out.unionByName(blank)


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` without near copies: of each component the row with the least id stays (a
    null id comes last; of rows that repeat the id, the one whose text has the least
    hash, once), and every row with a blank text."""
    rows, classes = joined(docs, n, num, den)
    met = rows.where("n > 0").join(classes.select("s1", "s2", "n", "stays"), ["s1", "s2", "n"])
    found = materialize(met.select("doc_id", "row", (_first() != F.col("stays")).alias("loses")).groupBy("doc_id", "row", "loses").agg(F.count("*").alias("rows")), "joined", docs.count())
    key = F.xxhash64("doc_id", "row").alias("lostkey")
    named = [F.col("doc_id").alias("id2"), F.col("row").alias("row2"), key]
    loses, twice = found.where("loses").select(named), found.where("not loses and rows > 1").select(named)
    same = F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("row") == F.col("row2"))
    # A filter of fixed size lets what surely stays pass without a shuffle of its text.
    keyed = packed(docs, "doc_id", "text").withColumn("row", text_key()).withColumn("idkey", F.xxhash64("doc_id", "row"))
    held = with_maybe(keyed, "idkey", loses, "lostkey")
    kept = held.where(~F.col("maybe")).drop("maybe").unionByName(held.where("maybe").drop("maybe").join(loses, same, "left_anti"))
    if twice.isEmpty():
        return unpacked(kept)
    held = with_maybe(kept, "idkey", twice, "lostkey")
    again = held.where("maybe").join(twice.withColumn("again", F.lit(True)), same, "left")
    once = again.where("again").groupBy("doc_id", "row").agg(F.min_by("doc", F.xxhash64(F.to_json("doc"))).alias("doc"))
    return unpacked(held.where(~F.col("maybe")).select("doc").unionByName(again.where("again is null").select("doc")).unionByName(once.select("doc")))
