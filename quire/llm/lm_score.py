"""Language-model scores from a log-frequency Bloom filter.

Training documents are counted twice over: their tokens exactly (for the base
score), and their tokens and pairs of neighbouring tokens into a log-frequency
Bloom filter (:mod:`._counts`), which keeps of each n-gram only the quantised count
``1 + floor(log2 c)`` as that many bits of membership.  The filter's bits follow
the corpus without a bound, so its rate of false bits does not.  At most ``MAX_BITS``
of them are broadcast at once: a larger filter is read in parts, each a range of
segments and a scan of the texts, and the levels read meet again by row.  The parts
change no result.  Scoring reads levels by repeated membership probes, takes the
middle of a level's range as the count, and smooths towards the single token:

    p(w | v) = (max(0, c(v, w) - d) + mu * p(w)) / (c(v) + mu),
    p(w)     = (c(w) + 0.1) / (N + 0.1 * (V + 1)).

Exact token counts are never broadcast whole.  The most frequent tokens (at most
``COMMON``, chosen by a histogram of counts) are; counts of the others meet the
documents that use them in a join on the token's hash, in which, by construction,
no key is hot.

Tokens are words without ASCII white space, A-Z lowered, then one end token for
each row.  Results for odd rows: a null or blank text is its end alone; repeated
rows are learnt from and scored each; a null id counts as the text ``null``; an
empty table gives an empty result, and where nothing is held for training all
counts are 0.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._counts import MAX_BITS, LogFilter, bits_for, filter_slices, gathered, key_blobs, segments_for, total_chars
from ._store import materialize
from ._words import WordHash, mix, rows_in, words_of

COMMON = 1 << 19
MU, DISCOUNT, FOLDS = 8.0, 0.4, 10
_END = b"\x00</s>"  # no word holds both a NUL and this; its hash stands for the end
_PAIR, _SINGLE = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def held_out(doc_id: int | None, folds: int) -> bool:
    return zlib.crc32(("null" if doc_id is None else str(doc_id)).encode()) % folds == 0


def pair_keys(tokens: np.ndarray, end: int) -> np.ndarray:
    """A key for each token with the one before it; the end stands before the first."""
    before = np.r_[np.uint64(end), tokens[:-1]]
    return mix(before * _PAIR + tokens)


def _tokens(hashes: WordHash, raw: bytes | None) -> np.ndarray:
    return hashes.of([*words_of(raw), _END])


def _levels(probed: LogFilter, keys: np.ndarray) -> np.ndarray:
    """Levels of keys that repeat: each distinct one is probed once, in their order."""
    once, back = np.unique(keys, return_inverse=True)
    return probed.levels(once)[back]


def _middle(level: np.ndarray) -> np.ndarray:
    """Middle of the counts that share a level: 2**(l-1) to 2**l - 1."""
    two = np.exp2(np.maximum(level.astype(np.float64), 1) - 1)
    return np.where(level > 0, (3 * two - 1) / 2, 0.0)


def _train(docs: DataFrame, folds: int) -> DataFrame:
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary"))
    return docs.withColumn("held_out", crc % folds == 0)


def _exact_counts(base: DataFrame) -> DataFrame:
    """(token, n) for every token of the training rows, hot ones pre-added."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sums = WordHash(), Counter()

        def rows() -> pa.RecordBatch:
            k = hashes.of(list(sums)).view(np.int64)
            out = pa.RecordBatch.from_arrays([pa.array(k), pa.array(list(sums.values()), pa.int64())], ["token", "n"])
            sums.clear()
            return out

        for batch in batches:
            for raw in batch["raw"].to_pylist():
                sums.update(words_of(raw))
                sums[_END] += 1
                if len(sums) > 1 << 17:
                    yield rows()
        yield rows()

    return base.where(~F.col("held_out")).select("raw").mapInArrow(scan, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def score(docs: DataFrame, folds: int = FOLDS, mu: float = MU, discount: float = DISCOUNT, common: int = COMMON, hashes_per_level: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = _train(docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw")), folds)
    counts = materialize(_exact_counts(base), "tokens")
    histogram = counts.groupBy(F.floor(F.log2("n") * 4).cast("int").alias("b")).agg(F.count("*").alias("v"), F.sum("n").alias("n")).orderBy(F.desc("b")).collect()
    n, v = sum(r["n"] for r in histogram), sum(r["v"] for r in histogram)
    room, cut = common, None
    for r in histogram:  # a bucket for each quarter of a power of two
        if r["v"] > room:
            break
        room, cut = room - r["v"], r["b"]
    bucket = F.floor(F.log2("n") * 4).cast("int")
    top = counts.where(bucket >= (cut if cut is not None else 1 << 30))
    table = top.toArrow()  # at most `common` rows
    order = np.argsort(table["token"].to_numpy())
    known, often = table["token"].to_numpy()[order], table["n"].to_numpy()[order]

    bits = bits_for(3 * (total_chars(docs) // 6), None)
    parts = max(1, bits // MAX_BITS)
    segments = max(segments_for(spark), bits >> 24, parts)
    per = segments // parts

    def keys_of():
        hashes = WordHash()
        end = int(hashes.of([_END])[0])

        def keys(row: dict) -> np.ndarray:
            t = _tokens(hashes, row["raw"])
            return np.concatenate([mix(t ^ _SINGLE), pair_keys(t, end)])

        return keys

    blobs = key_blobs(base.where(~F.col("held_out")).select("raw"), keys_of, segments, 1 << 20)
    slices = filter_slices(blobs, segments, bits, hashes_per_level)
    numbered = base.withColumn("row", F.monotonically_increasing_id())
    if parts > 1:
        slices, numbered = materialize(slices, "filter"), materialize(numbered, "numbered")

    def part(i: int):
        """Broadcast of the filter's i-th part."""
        return spark.sparkContext.broadcast(gathered(slices, segments, bits, hashes_per_level, start=i * per, stop=(i + 1) * per)[0])

    below = 0.1 * (v + 1) + n

    def keys_by_row(rows: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Single and pair key of every token of some rows, and where rows begin and end."""
        t = np.concatenate(rows)
        at = np.r_[0, np.cumsum([len(r) for r in rows])]
        before = np.r_[np.uint64(end), t[:-1]]
        before[at[:-1]] = end
        return mix(t ^ _SINGLE), mix(before * _PAIR + t), at

    def score_of(single: np.ndarray, pair: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Scores of rows from the levels of their tokens' keys."""
        single = _middle(single)
        ahead = np.r_[0.0, single[:-1]]
        ahead[at[:-1]] = single[at[1:] - 1]  # a row's last token is the end
        pair = np.maximum(0.0, np.minimum(_middle(pair), ahead) - discount)
        p = (pair + mu * (single + 0.1) / below) / (ahead + mu)
        return np.add.reduceat(np.log10(p), at[:-1])  # no row is without its end

    def part_of(keys: np.ndarray) -> np.ndarray:
        """Number of the part that holds each key."""
        return (keys >> np.uint64(64 - (parts.bit_length() - 1))).astype(np.uint16) if parts > 1 else np.zeros(len(keys), np.uint16)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], int]]:
        """Rows with their tokens, some 2**17 tokens at a time."""
        hashes = WordHash()
        end = int(hashes.of([_END])[0])
        for batch in batches:
            rows, first, size = [], 0, 0
            for i in range(batch.num_rows):
                rows.append(_tokens(hashes, batch["raw"][i].as_py()))
                size += len(rows[-1])
                if size > 1 << 17 or i == batch.num_rows - 1:
                    yield batch.slice(first, len(rows)), rows, end
                    rows, first, size = [], i + 1, 0

    whole = part(0) if parts == 1 else None
    table = spark.sparkContext.broadcast((known, often))
    names = ["doc_id", "row", "held_out", "n_tokens", "known", "base", "score", "parts", "rare"]
    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.int64())]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts and base scores, with the score if one part is the whole filter and else
        with the part of every key."""
        known, often = table.value
        for batch, rows, end in chunks(batches):
            single, pair, at = keys_by_row(rows, end)
            if whole is not None:
                got, dealt = score_of(_levels(whole.value, single), _levels(whole.value, pair), at), [None] * len(rows)
            else:
                a, b = part_of(single), part_of(pair)
                got, dealt = [None] * len(rows), [np.r_[a[i:j], b[i:j]].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]
            signed = np.concatenate(rows).view(np.int64)
            if len(known):
                where = np.minimum(np.searchsorted(known, signed), len(known) - 1)
                here = known[where] == signed
                exact = np.where(here, np.log10((often[where] + 0.1) / below), 0.0)
            else:
                here, exact = np.zeros(len(signed), bool), np.zeros(len(signed))
            rare = [signed[a:b][~here[a:b]] for a, b in zip(at[:-1], at[1:], strict=True)]
            cols = [np.diff(at), np.add.reduceat(here.astype(np.int64), at[:-1]), np.add.reduceat(exact, at[:-1]), got, dealt, rare]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row"], batch["held_out"], *[pa.array(x, y) for x, y in zip(cols, types, strict=True)]], names)

    seen = materialize(numbered.mapInArrow(scan, f"doc_id {kind}, row long, held_out boolean, n_tokens long, known long, base double, score double, parts binary, rare array<long>"), "scored")
    table.destroy()

    def levels_of(i: int, shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, rows, end in chunks(batches):
                single, pair, at = keys_by_row(rows, end)
                keys = np.concatenate([k[a:b] for a, b in zip(at[:-1], at[1:], strict=True) for k in (single, pair)])
                mine = part_of(keys) == i
                levels = _levels(shared.value, keys[mine])
                ends = np.r_[0, np.cumsum(mine)][2 * at]
                blobs = [levels[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch["row"], pa.array(np.full(len(rows), i, np.int32)), pa.array(blobs, pa.binary())], ["row", "part", "levels"])

        return scan

    def rejoined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in rows_in(batch):
                got = {x["part"]: x["levels"] for x in row["got"]}
                where = np.frombuffer(got.pop(-1), np.uint16)
                levels = np.zeros(len(where), np.uint8)
                for i, b in got.items():
                    levels[where == i] = np.frombuffer(b, np.uint8)
                half = len(levels) // 2
                out.append(score_of(levels[:half], levels[half:], np.array([0, half]))[0])
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(out, pa.float64())], ["row", "score"])

    if whole is not None:
        whole.destroy()
    else:
        read = seen.select("row", F.lit(-1).alias("part"), F.col("parts").alias("levels"))
        for i in range(parts):
            shared = part(i)
            read = read.unionByName(materialize(numbered.select("doc_id", "row", "raw").mapInArrow(levels_of(i, shared), "row long, part int, levels binary"), f"levels-{i}"))
            shared.destroy()
        scores = read.groupBy("row").agg(F.collect_list(F.struct("part", "levels")).alias("got")).mapInArrow(rejoined, "row long, score double")
        seen = seen.drop("score").join(scores, "row")
    rare = seen.where(F.size("rare") > 0).select("row", F.explode("rare").alias("token"))
    c = F.coalesce(F.col("n"), F.lit(0))
    met = rare.join(counts.where(bucket < (cut if cut is not None else 1 << 30)), "token", "left").select("row", (c > 0).cast("long").alias("k"), F.log10((c + 0.1) / below).alias("b"))
    sums = met.groupBy("row").agg(F.sum("k").alias("k"), F.sum("b").alias("b"))
    zero = F.lit(0.0)
    return seen.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("k", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", zero)).alias("base_score"), "score",
    )
