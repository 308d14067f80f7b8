"""Order MinHash fingerprints, in native expressions only.

A text's k-mers are its runs of ``k`` words (the whole text if it has fewer),
numbered by occurrence.  A hash of (k-mer, number) deals them to ``buckets`` and
ranks them there; of each bucket the two least (where it holds one, that and the least
of the next bucket that holds any) are kept in their text order and hashed as a tuple.
A bucket's value thus changes when a k-mer goes, comes, or moves past another:
likeness, the share of equal buckets, follows edit distance.  One ranking for all
buckets stands for 64 rankings of all k-mers: it costs one sort, and its values are a
little less independent of each other.

Everything is array expressions in the JVM.  Numbers of occurrences come from a
sorted array: an element looks for the start of its run by halving steps, so a text
of one word repeated costs n log n.  Packed longs keep the sorts primitive: 36 bits
of hash and 28 of position, then 6 of bucket, 30 of rank and 28 of position.

The next document is found without one global sort: rows are dealt in the order of
``doc_id`` to blocks, each block leads in its own window, and a copy of the first row
of the next block stands behind its last row.  Where blocks begin is read off a sample
of the ids; any beginnings give the same result, these give blocks of like size.  An id
of very many rows (null, too) has several blocks, by a hash of the text.  Of the blocks,
a few for each task, only their first ids and hashes reach the driver.

Results for odd rows: null texts count as empty; empty texts have the empty
fingerprint, like to each other (1.0) and to nothing else (0.0); repeated ids are
neighbours in the order of a hash of their texts; null ids come before all others (ids
are integers); rows that repeat id and text share a task; a table of
one row is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._store import partitions

K, BUCKETS = 3, 64
#: Blocks at most, rows of a block at least, and sampled ids for a block.
BLOCKS, BLOCK_ROWS, SAMPLED = 4096, 256, 200
_SPACE = " \t\n\x0b\f\r"
_POS = (1 << 28) - 1


def _right(x: Column, n: int) -> Column:
    return F.shiftright(x, n)


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K) -> DataFrame:
    """Add ``out``: array<int> of bucket * 2**24 + 24 bits of its tuple's hash.

    Each step is a column used more than once by the next, which keeps the optimizer
    from working a step out again for every element.
    """
    w, h, s, t = (f"__{out}_{x}" for x in "whst")
    lowered = F.btrim(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(_SPACE))
    words = F.when(lowered == "", F.array().cast("array<string>")).otherwise(F.split(lowered, f"[{_SPACE}]+"))
    df = df.withColumn(w, F.transform(words, lambda x: F.xxhash64(x)))

    def kmer(x: Column, i: Column) -> Column:
        return F.xxhash64(x, *[F.col(w)[i + j] for j in range(1, k)])

    def packed(x: Column, i: Column) -> Column:
        return F.shiftleft(_right(x, 28), 28).bitwiseOR(i.cast("long").bitwiseAND(F.lit(_POS)))

    whole = F.array(F.aggregate(F.col(w), F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x)))
    df = df.withColumn(h, F.when(F.size(w) == 0, F.array().cast("array<long>")).when(F.size(w) < k, whole).otherwise(F.transform(F.slice(F.col(w), F.lit(1), F.size(w) - (k - 1)), lambda x, i: packed(kmer(x, i), i))))
    df = df.withColumn(s, F.sort_array(h))
    S = F.col(s)
    steps = F.array(*[F.lit(1 << b) for b in range(27, -1, -1)])

    def number(x: Column, j: Column) -> Column:
        same = lambda at: _right(S[at], 28) == _right(x, 28)
        start = F.aggregate(steps, j, lambda a, step: F.when(a >= step, F.when(same((a - step).cast("int")), a - step).otherwise(a)).otherwise(a))
        return F.when(j == 0, F.lit(0)).when(same(j - 1), j - start).otherwise(F.lit(0))

    def ranked(x: Column, j: Column) -> Column:
        key = F.xxhash64(_right(x, 28), number(x, j))
        return F.shiftleft(_right(key, 28), 28).bitwiseOR(x.bitwiseAND(F.lit(_POS)))

    df = df.withColumn(t, F.sort_array(F.transform(S, ranked)))
    T = F.col(t)
    bits = BUCKETS.bit_length() - 1
    bucket = lambda x: _right(x, 64 - bits)
    rank = lambda x: _right(x, 28)

    def tuple_of(x: Column, j: Column) -> Column:
        first = F.when(j == 0, F.lit(True)).otherwise(bucket(T[j - 1]) != bucket(x))
        y = F.when(j + 1 < F.size(T), T[j + 1]).otherwise(T[0])
        both = F.when(x.bitwiseAND(F.lit(_POS)) < y.bitwiseAND(F.lit(_POS)), F.xxhash64(rank(x), rank(y))).otherwise(F.xxhash64(rank(y), rank(x)))
        value = F.when(F.size(T) > 1, both).otherwise(F.xxhash64(rank(x)))
        number = (bucket(x) + BUCKETS // 2) * (1 << 24) + value.bitwiseAND(F.lit((1 << 24) - 1))
        return F.when(first, number.cast("int"))

    df = df.withColumn(out, F.filter(F.transform(T, tuple_of), lambda x: x.isNotNull()))
    return df.drop(w, h, s, t)


def likeness(a: str, b: str) -> Column:
    """Share of equal buckets among those that either text has."""
    either = F.size(F.array_union(F.transform(a, lambda x: _right(x, 24)), F.transform(b, lambda x: _right(x, 24))))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(either, F.lit(1)))


def as_text(signature: str) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x), 8, "0")), "")


def _beginnings(df: DataFrame, blocks: int, rows: int) -> tuple[list[int], dict[int, int], int]:
    """From a sample of the ids: where blocks begin, and how many bits of the text's hash
    divide the blocks of ids (and of null) that begin more than one."""
    sample = df.select("doc_id").where(F.rand(7) * rows <= blocks * SAMPLED).limit(4 * blocks * SAMPLED)
    ids = sorted((r[0] is not None, r[0] or 0) for r in sample.collect())
    quantiles = [ids[i * len(ids) // blocks] for i in range(1, blocks)] if ids else []
    often = Counter(quantiles)
    bits = {x: (4 * n - 1).bit_length() for x, n in often.items() if n > 1}
    return sorted({x for known, x in often if known}), {x: b for (known, x), b in bits.items() if known}, bits.get((False, 0), 0)


def with_blocks(df: DataFrame) -> DataFrame:
    """Add __h, a hash of the text, and __block, which follows (doc_id, __h)."""
    rows = df.count()
    begin, divided, of_null = _beginnings(df, max(1, min(BLOCKS, 4 * partitions(df.sparkSession), rows // BLOCK_ROWS)), max(1, rows))
    df = df.withColumn("__h", F.xxhash64("text"))
    begins = F.array(*map(F.lit, begin)).cast("array<long>")
    steps = F.array(*[F.lit(1 << b) for b in range(len(begin).bit_length() - 1, -1, -1)])
    id_ = F.col("doc_id").cast("long")
    below = F.aggregate(steps, F.lit(0), lambda a, step: F.when(F.get(begins, a + step - 1) < id_, a + step).otherwise(a))
    df = df.withColumn("__below", below)
    place = 2 * F.col("__below") + F.coalesce(F.get(begins, F.col("__below")) == id_, F.lit(False)).cast("int")
    bits = F.when(id_.isNull(), F.lit(of_null))
    if divided:
        bits = bits.otherwise(F.coalesce(F.try_element_at(F.create_map(*[F.lit(x).cast("long") if i == 0 else F.lit(x) for pair in divided.items() for i, x in enumerate(pair)]), id_), F.lit(0)))
    df = df.withColumn("__bits", F.coalesce(bits, F.lit(0)))
    part = F.expr("CASE WHEN __bits = 0 THEN 0L ELSE shiftright(__h, 64 - __bits) + shiftleft(1L, __bits - 1) END")
    return df.withColumn("__block", F.when(id_.isNull(), F.lit(-1)).otherwise(place) * F.lit(1 << 20).cast("long") + part).drop("__below", "__bits")


def with_guests(df: DataFrame) -> DataFrame:
    """Add __h, __block and __guest: after each block's own rows (guest 0) stands a copy
    of the first row of the block that follows it (guest 1; the last block is followed by
    the first).  Only these copies move before the one shuffle."""
    df = with_blocks(df)
    first = sorted((r["__block"], r["f"]["doc_id"], r["f"]["__h"]) for r in df.groupBy("__block").agg(F.min(F.struct("doc_id", "__h")).alias("f")).collect())  # a few rows a task
    ahead = json.dumps([{"b": b, "i": i, "x": h, "host": first[at - 1][0]} for at, (b, i, h) in enumerate(first)])
    known = df.sparkSession.range(1).select(F.inline(F.from_json(F.lit(ahead), "array<struct<b: long, i: long, x: long, host: long>>")))
    found = df.join(F.broadcast(known), (F.col("__block") == F.col("b")) & (F.col("__h") == F.col("x")) & F.col("doc_id").cast("long").eqNullSafe(F.col("i"))).dropDuplicates(["__block"])
    guests = found.select(*[F.col("host").alias(c) if c == "__block" else F.col(c) for c in df.columns], F.lit(1).alias("__guest"))
    return df.withColumn("__guest", F.lit(0)).unionByName(guests)


def with_next(df: DataFrame, carry: list[str]) -> DataFrame:
    """Own rows with ``next_<c>`` of the next row by doc_id (after the last: the first)."""
    order = [F.col("__guest"), F.col("doc_id").asc_nulls_first(), F.col("__h"), F.col("text")]
    led = df.withColumn("__lead", F.lead(F.struct(*carry)).over(Window.partitionBy("__block").orderBy(*order))).where("__guest = 0")
    return led.select(*[c for c in df.columns if c not in ("__block", "__guest", "__h")], *[F.col(f"__lead.{c}").alias(f"next_{c}") for c in carry])


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = with_next(with_fingerprint(with_guests(rows), "text", "sig", k), ["text", "sig"])
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "sig", "next_sig", edited.alias("edited"))
    rows = with_fingerprint(rows, "edited", "edited_sig", k)
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text("sig").alias("fingerprint"), as_text("edited_sig").alias("edited_fingerprint"),
        likeness("sig", "edited_sig").alias("near_edited"), likeness("sig", "next_sig").alias("near_next"),
    )
