"""Substring deduplication with repeated-phrase automata.

A window is ``window`` consecutive words.  A document loses the words of every
window whose words also start in a document with a smaller id.

1. Every document's distinct windows are counted into a filter of fixed size
   (:mod:`._counts`); what two documents share passes it.  False passes cost time only.
2. All documents are read in batches.  A row none of whose windows passes is done with.
   Of the others a batch notes each distinct window that passes, by its hash, with the
   least id that holds it in the batch, and its phrase: the ``phrase`` words with the
   least hash in the window, so that equal windows have equal phrases.
3. The notes of all batches meet by segments of the hash, where a window is confirmed
   as recurring by its exact ids, and its first document is told to the batches that
   hold it in later ones.  A batch notes a window once, however many rows hold it, so no
   window, phrase or group of copies is hot.
4. A batch compiles the phrases of its confirmed windows to an Aho-Corasick automaton
   (a shard: all automata together hold all confirmed phrases) and streams its rows
   through it.  The automaton finds every occurrence of a phrase, word by word; only
   windows about these are looked up, and go if their first document is an earlier one.
   Two windows are thus equal by a phrase of equal words and by 64 bits of hash.

A batch has a bounded number of windows and of text, a segment some ``SEGMENT`` notes;
their numbers grow with the input.

Results for odd rows: null and blank texts have no words; rows with a null id keep
all their words and are nobody's first document; rows that repeat an id are one
document, each cut by documents with smaller ids only.  Ids are integers.  An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._counts import bits_for, key_blobs, log_filter, segments_for, total_chars
from ._store import materialize, partitions
from ._words import WordHash, run_hashes, window_minima

WINDOW, PHRASE = 50, 8
#: Windows and bytes of text of a batch, and windows of a segment.
BATCH, BATCH_BYTES, SEGMENT = 1 << 18, 1 << 23, 1 << 20
_DONE, _OPEN, _NOTES, _PHRASES, _FIRSTS = range(5)
_MANY = np.uint32(1 << 31)  # the batch holds the window in several documents
#: A batch's rows (raw is packed), notes (a: windows, b: least ids from doc on, c: numbers of
#: phrases) and phrases.
_CUT = {"kind": pa.int32(), "batch": pa.int64(), "seg": pa.int32(), "doc": pa.int64(), "raw": pa.binary(), "n_words": pa.int64(), "digest": pa.string(), "a": pa.binary(), "b": pa.binary(), "c": pa.binary()}
_CUT_SQL = "kind int, batch long, seg int, doc long, raw binary, n_words long, digest string, a binary, b binary, c binary"
_OUT = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "kept_text": pa.string()}


def plain_words(raw: bytes | None) -> list[bytes]:
    """Runs without ASCII white space, unchanged."""
    return raw.split() if raw else []


def _pack_ids(ids: np.ndarray) -> tuple[int | None, bytes]:
    """Ids as four bytes from their least one on where that does, else as they are."""
    least = int(ids.min())
    return (least, (ids - least).astype(np.uint32).tobytes()) if int(ids.max()) - least < 1 << 32 else (None, ids.tobytes())


def _ids(least: int | None, raw) -> np.ndarray:
    return np.frombuffer(raw, np.int64) if least is None else np.frombuffer(raw, np.uint32).astype(np.int64) + least


def _rows(cols: dict[str, list]) -> pa.RecordBatch:
    """Rows of a batch's table; columns that are not given are null."""
    n = len(next(iter(cols.values())))
    return pa.RecordBatch.from_arrays([pa.array(cols[c], t) if c in cols else pa.nulls(n, t) for c, t in _CUT.items()], list(_CUT))


class Notes:
    """Windows of a batch that may recur, with their least ids and phrases."""

    def __init__(self, segments: int):
        self.shift = np.uint64(64 - (segments.bit_length() - 1))
        self.clear()

    def clear(self) -> None:
        self.batch = secrets.randbits(63)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.phrases: dict[int, bytes] = {}
        self.windows = self.bytes = 0

    def add(self, doc: int, words: list[bytes], keys: np.ndarray, grams: np.ndarray, lows: np.ndarray, phrase: int) -> None:
        for p in np.unique(lows).tolist():
            self.phrases.setdefault(int(grams[p]), b" ".join(words[p : p + phrase]))
        self.held.append((keys, np.full(len(keys), doc, np.int64), grams[lows]))
        self.windows += len(keys)
        self.bytes += sum(map(len, words))

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        keys, docs, grams = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.lexsort((docs, keys))
        keys, docs = keys[order], docs[order]
        at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        last = np.r_[at[1:], len(keys)] - 1
        named = {g: i for i, g in enumerate(self.phrases)}
        number = np.fromiter(map(named.__getitem__, grams[order][at].tolist()), np.uint32, len(at)) | np.where(docs[last] > docs[at], _MANY, np.uint32(0))
        keys, docs = keys[at], docs[at]
        seg = (keys >> self.shift).astype(np.int32)
        cut = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
        cols: dict[str, list] = {c: [] for c in ("kind", "batch", "seg", "a", "doc", "b", "c")}
        for i, j in zip(cut.tolist(), np.r_[cut[1:], len(seg)].tolist(), strict=True):
            for c, x in zip(cols, (_NOTES, self.batch, int(seg[i]), keys[i:j].tobytes(), *_pack_ids(docs[i:j]), number[i:j].tobytes()), strict=True):
                cols[c].append(x)
        yield _rows(cols)
        yield _rows({"kind": [_PHRASES], "batch": [self.batch], "a": [b"\n".join(self.phrases.values())]})
        self.clear()


def first_documents(notes: pa.Table) -> pa.Table:
    """For each batch of a segment the windows that it holds in a document later than
    their first one, with that first document."""
    keys = [np.frombuffer(x.as_buffer(), np.uint64) for x in notes["a"]]
    sizes = [len(k) for k in keys]
    docs = np.concatenate([_ids(least, x.as_buffer()) for least, x in zip(notes["doc"].to_pylist(), notes["b"], strict=True)])
    number = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in notes["c"]])
    keys = np.concatenate(keys)
    order = np.lexsort((docs, keys))
    new = np.r_[True, keys[order][1:] != keys[order][:-1]]
    first = np.empty(len(keys), np.int64)
    first[order] = docs[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    told = (docs > first) | (number & _MANY > 0)
    ends = np.cumsum([0, *sizes])
    out: dict[str, list] = {c: [] for c in ("batch", "a", "doc", "b", "c")}
    for batch, i, j in zip(notes["batch"].to_pylist(), ends[:-1], ends[1:], strict=True):
        mine = np.flatnonzero(told[i:j]) + i
        if len(mine):
            for c, x in zip(out, (batch, keys[mine].tobytes(), *_pack_ids(first[mine]), (number[mine] & ~_MANY).tobytes()), strict=True):
                out[c].append(x)
    return pa.table({c: pa.array(x, _CUT[c]) for c, x in out.items()})


class Shard:
    """A batch's confirmed phrases as an automaton, and first documents of its windows."""

    def __init__(self, window: int, phrase: int, phrases: list[bytes], firsts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.window, self.phrase = window, phrase
        keys, docs, number = (np.concatenate(x) for x in zip(*firsts, strict=True)) if firsts else (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint32))
        order = np.argsort(keys)
        self.keys, self.first = keys[order], docs[order]
        # Words are bytes in the automaton's eyes: latin-1 maps each byte to a character.
        self.automaton = ahocorasick.Automaton()
        for i in np.unique(number).tolist():
            said = f" {phrases[i].decode('latin-1')} "
            self.automaton.add_word(said, len(said))
        self.automaton.make_automaton()

    def locate(self, words: list[bytes]) -> np.ndarray:
        """Word positions at which a phrase of the shard starts."""
        if not len(self.keys):
            return np.empty(0, np.int64)
        framed = b" " + b" ".join(words) + b" "
        begins = np.array([end - n + 1 for end, n in self.automaton.iter(framed.decode("latin-1"))], np.int64)
        return np.unique(np.searchsorted(np.flatnonzero(np.frombuffer(framed, np.uint8) == 32), begins))

    def repeated(self, doc: int, words: list[bytes], hashes: WordHash) -> list[tuple[int, int]]:
        """Word ranges of the windows that an earlier document holds."""
        at = self.locate(words)
        keys = run_hashes(hashes.of(words), self.window)
        if not len(at) or not len(keys):
            return []
        about = np.zeros(len(keys) + 1, np.int64)
        np.add.at(about, np.minimum(np.maximum(0, at + self.phrase - self.window), len(keys)), 1)
        np.add.at(about, np.minimum(at + 1, len(keys)), -1)
        near = np.flatnonzero(np.cumsum(about[:-1]) > 0)
        known = np.minimum(np.searchsorted(self.keys, keys[near]), len(self.keys) - 1)
        gone = near[(self.keys[known] == keys[near]) & (self.first[known] < doc)]
        return joined([(i, i + self.window) for i in gone.tolist()])


def joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without(words: list[bytes], gone: list[tuple[int, int]]) -> list[bytes]:
    kept, end = [], 0
    for a, b in gone:
        kept += words[end:a]
        end = b
    return kept + words[end:]


def drop_repeats(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text) for every row."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw"))

    def keys_of():
        hashes = WordHash()
        return lambda row: np.unique(run_hashes(hashes.of(plain_words(row["raw"])), window))

    windows = total_chars(docs) // 6
    bits, filtered = bits_for(windows), segments_for(spark, windows)
    blobs = key_blobs(base.where("doc is not null").select("raw"), keys_of, filtered)
    seen, _ = log_filter(blobs, filtered, bits, max(1, min(4, 4 * bits // max(1, windows))), first=2, top=2)
    shared = spark.sparkContext.broadcast(seen)
    segments = max(filtered, 1 << (windows // SEGMENT).bit_length())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known, notes = WordHash(), shared.value, Notes(segments)
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            cols: dict[str, list] = {c: [] for c in ("kind", "batch", "doc", "raw", "n_words", "digest")}
            for doc, raw in zip(batch["doc"].to_pylist(), batch["raw"], strict=True):
                raw = raw.as_py()
                words = plain_words(raw)
                at = np.empty(0, np.int64)
                if doc is not None and len(words) >= window:
                    h = hashes.of(words)
                    keys = run_hashes(h, window)
                    at = np.flatnonzero(known.levels(keys, 2))
                if len(at):
                    grams = run_hashes(h, phrase)
                    notes.add(doc, words, keys[at], grams, window_minima(grams, at, window - phrase + 1), phrase)
                    row = (_OPEN, notes.batch, doc, pack(raw), None, None)
                else:
                    kept = b" ".join(words)
                    row = (_DONE, None, doc, kept if texts else None, len(words), hashlib.sha256(kept).hexdigest())
                for c, x in zip(cols, row, strict=True):
                    cols[c].append(x)
                if notes.windows > BATCH or notes.bytes > BATCH_BYTES:
                    yield from notes.flush()
            yield _rows(cols)
        yield from notes.flush()

    table = materialize(base.mapInArrow(cut, _CUT_SQL), "windows")
    shared.destroy()

    told = table.where(f"kind = {_NOTES}").select("seg", "batch", "a", "doc", "b", "c").groupBy("seg").applyInArrow(first_documents, "batch long, a binary, doc long, b binary, c binary")
    firsts = told.select(F.lit(_FIRSTS).alias("kind"), "batch", "doc", F.lit(None).cast("binary").alias("raw"), "a", "b", "c")
    held = table.where(F.col("kind").isin(_OPEN, _PHRASES)).select("kind", "batch", "doc", "raw", "a", "b", "c").unionByName(firsts)
    met = held.repartition(partitions(spark), "batch").sortWithinPartitions("batch", F.desc("kind"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, current, phrases, told, shard = WordHash(), None, [], [], None
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            docs, cols = [], {c: [] for c in _OUT}
            for i in range(batch.num_rows):
                r = {c: x[i] for c, x in zip(batch.schema.names, batch.columns, strict=True)}
                if (number := r["batch"].as_py()) != current:
                    current, phrases, told, shard = number, [], [], None
                kind = r["kind"].as_py()
                if kind == _FIRSTS:
                    told.append((np.frombuffer(r["a"].as_py(), np.uint64), _ids(r["doc"].as_py(), r["b"].as_py()), np.frombuffer(r["c"].as_py(), np.uint32)))
                elif kind == _PHRASES:
                    phrases = r["a"].as_py().split(b"\n")
                else:
                    shard = shard or Shard(window, phrase, phrases, told)
                    words, doc = plain_words(unpack(r["raw"].as_py())), r["doc"].as_py()
                    left = without(words, shard.repeated(doc, words, hashes))
                    kept = b" ".join(left)
                    docs.append(doc)
                    for c, x in zip(_OUT, (len(words), len(words) - len(left), hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None), strict=True):
                        cols[c].append(x)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), *[pa.array(cols[c], t) for c, t in _OUT.items()]], ["doc_id", *_OUT])

    judged = met.mapInArrow(stream, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    done = table.where(f"kind = {_DONE}").select(F.col("doc").alias("doc_id"), "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("digest").alias("kept_sha256"), F.col("raw").cast("string").alias("kept_text"))
    out = judged.unionByName(done).withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    return out if texts else out.drop("kept_text")
