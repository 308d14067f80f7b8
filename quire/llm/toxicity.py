"""Toxicity by a factorization machine over hashed terms.

    score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f [(sum v_if x_i)^2 - sum v_if^2 x_i^2])

Terms are words (letters, lowered) and their beginnings of 4 to 7 letters, hashed to
``BUCKETS`` numbers; x is log(1 + count).  The factors v weigh pairs of terms, so an
insult beside a group term, or two parts of a threat, count for more or less than
the sum of both.

The machine is fitted on the driver on at most ``per_class`` labelled rows of either
class, those with the least hash of their id (a documented sample, bounded whatever
the input; sent there as counts of hashed terms).  Of rows that repeat an id the one
whose text has the least hash is learnt from; the others are cut before they are sent.
The machine's width is ``KEPT`` buckets, a parameter: those that tell most about the
label.  All rows are scored; the model is some
100 kB.  Labels are the only thing read beside texts, and those of held-out ids
(crc32 of the id mod ``folds`` is 0) are never read.

Results for odd rows: null, blank and letterless texts score as a text without
terms; repeated rows score each alike; a label that is null is not learnt from, and
of labels that repeat an id the greatest counts; a null id is held out like the text
``null``.  With labels of one class only, or none, the score is their share, or 0.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS, KEPT, FACTORS, PER_CLASS, FOLDS = 1 << 18, 1024, 6, 3000, 5
_LETTERS = re.compile(r"[^\W\d_]+")


def term_buckets(word: str) -> tuple[int, ...]:
    parts = {word, *(f"{word[:n]}^" for n in range(4, 8) if len(word) > n)}
    return tuple(xxhash.xxh32_intdigest(p) % BUCKETS for p in parts)


class Terms(dict):
    """Word to the columns it counts in, remembered for some 130,000 words at a time."""

    def __init__(self, columns: dict[int, int] | None):
        super().__init__()
        self.columns = columns

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 1 << 17:
            self.clear()
        found = term_buckets(word)
        if self.columns is not None:
            found = tuple(self.columns[b] for b in found if b in self.columns)
        self[word] = found
        return found

    def counts(self, text: str | None) -> Counter:
        out: Counter = Counter()
        if text:
            for word in _LETTERS.findall(text.lower()):
                for c in self[word]:
                    out[c] += 1
        return out


class Machine:
    """w0, w and v over chosen buckets."""

    def __init__(self, buckets: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.columns = {int(b): i for i, b in enumerate(buckets)}
        self.w0, self.w, self.v = w0, w, v

    def score(self, x: np.ndarray) -> np.ndarray:
        s = x @ self.v
        z = self.w0 + x @ self.w + 0.5 * ((s * s).sum(1) - (x * x) @ (self.v * self.v).sum(1))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(keys: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray, kept: int = KEPT, factors: int = FACTORS, epochs: int = 30, seed: int = 7) -> Machine:
    """Adam on the logistic loss, both classes weighing alike.  A row has distinct
    buckets (``keys``) with their counts."""
    y = labels.astype(np.float64)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Machine(np.empty(0, np.int64), 30.0 if share else -30.0, np.zeros(0), np.zeros((0, factors)))
    n1, n0 = y.sum(), len(y) - y.sum()
    row = np.repeat(np.arange(len(y)), [len(k) for k in keys])
    key = np.concatenate(keys).astype(np.int64)
    held = [np.bincount(key[y[row] == t], minlength=BUCKETS) for t in (0, 1)]
    seen = np.flatnonzero(held[0] + held[1] >= 3)
    a, b = held[1][seen] / n1, held[0][seen] / n0
    told = (a - b) ** 2 / (a * (1 - a) / n1 + b * (1 - b) / n0 + 1e-6)
    buckets = seen[np.argsort(-told, kind="stable")[:kept]]
    at = np.full(BUCKETS, -1)
    at[buckets] = np.arange(len(buckets))
    x = np.zeros((len(y), len(buckets)), np.float32)  # at most 2 * per_class by kept
    used = at[key] >= 0
    x[row[used], at[key[used]]] = np.log1p(np.concatenate(counts)[used])
    rng = np.random.default_rng(seed)
    p = [np.zeros(1, np.float32), np.zeros(len(buckets), np.float32), rng.normal(0, 0.02, (len(buckets), factors)).astype(np.float32)]
    m, s = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    weight = np.where(y > 0, len(y) / (2 * n1), len(y) / (2 * n0))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(y), 256):
            j = order[i : i + 256]
            xb = x[j]
            xv = xb @ p[2]
            z = p[0][0] + xb @ p[1] + 0.5 * ((xv * xv).sum(1) - (xb * xb) @ (p[2] * p[2]).sum(1))
            g = weight[j].astype(np.float32) * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[j]) / len(j)
            grads = [np.array([g.sum()]), xb.T @ g + 1e-4 * p[1], xb.T @ (g[:, None] * xv) - p[2] * ((xb * xb).T @ g)[:, None] + 1e-3 * p[2]]
            step += 1
            for k, grad in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * grad
                s[k] = 0.999 * s[k] + 0.001 * grad * grad
                p[k] -= 0.02 * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return Machine(buckets, float(p[0][0]), p[1].astype(np.float64), p[2].astype(np.float64))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, per_class: int) -> DataFrame:
    """doc_id, text and label of at most ``per_class`` rows of either class: one for
    each id, so that no id's rows are gathered in a task or on the driver."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    known = known.where(crc % folds != 0).groupBy("doc_id").agg(F.max("label").alias("label"))
    parts = [known.where(F.col("label") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for t in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # 2 * per_class rows
    found = docs.select("doc_id", "text").join(chosen, "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, per_class: int = PER_CLASS) -> Machine:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(None)
        for batch in batches:
            got = [terms.counts(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["label"], batch["doc_id"], pa.array([list(c) for c in got], pa.list_(pa.int32())), pa.array([list(c.values()) for c in got], pa.list_(pa.int32()))], ["label", "doc_id", "k", "n"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sample = labelled_sample(docs, labels, label, folds, per_class).mapInArrow(scan, f"label int, doc_id {kind}, k array<int>, n array<int>").toArrow()
    sample = sample.sort_by("doc_id").combine_chunks()  # 2 * per_class rows at most
    lists = lambda c: [x.values.to_numpy(zero_copy_only=False) for x in sample[c]]
    return fit(lists("k"), lists("n"), sample["label"].to_numpy())


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, label, folds, per_class))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        terms = Terms(own.columns)
        for batch in batches:
            out = []
            texts = batch["text"].to_pylist()
            for i in range(0, len(texts), 512):
                part = texts[i : i + 512]
                x = np.zeros((len(part), len(own.w)))
                for j, t in enumerate(part):
                    for c, n in terms.counts(t).items():
                        x[j, c] = np.log1p(n)
                out.append(own.score(x))
            p = np.concatenate(out) if out else np.zeros(0)
            held = [zlib.crc32(("null" if d is None else str(d)).encode()) % folds == 0 for d in batch["doc_id"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(held, pa.bool_()), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, held_out boolean, score double, predicted int")
