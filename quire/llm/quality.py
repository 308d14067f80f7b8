"""Quality by hierarchical empirical Bayes.

1. A logistic classifier on shape features of the text (shares of letters, capitals,
   digits, marks and bars, word lengths, repetition) gives each document its own
   evidence p.  It is fitted on the driver on at most ``per_class``
   labelled rows of either class, one for each id.
2. Evidence is added up for every host and every path of it (grouped aggregates that
   are combined before the shuffle, so a host with a third of all rows is one row).
   With a prior strength by the method of moments, a host's posterior mean shrinks
   to the global one, and a path's to its host's:

       host = (sum p + a * global) / (n + a),   path = (sum p + b * host) / (n + b).

3. A document's score is logit p + ``trust`` * (logit path - logit global).  Each
   site's weight is in its own evidence: sparse sites say nothing, and ``trust`` and
   ``swing`` bound what any site can, so a clean text of a bad host stays.

Rows meet their site's posterior by a broadcast of at most ``SITES`` sites, or by a
join beyond that.  The host of a plain source name is that name; of a URL, its host,
and the path is its first part, else the language.

Results for odd rows: null and blank texts have p of a text without words (their
quality is 0: nothing to learn from); null sources are one host; repeated rows score
alike; null labels are not learnt from.  With labels of one class only, or none, all
texts with words are kept.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import materialize, packed, unpacked
from .toxicity import labelled_sample

PER_CLASS, FOLDS, SITES = 3000, 5, 100_000
TRUST, SWING = 0.5, 1.0
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_MARKS = b"!#$%&*@^~<>{}[]\\/_=+"


def features(text: str | None) -> list[float]:
    raw = (text or "").encode()
    words = raw.split()
    n, w = max(1, len(raw)), max(1, len(words))
    of = lambda chars: (len(raw) - len(raw.translate(None, chars)))
    upper, lower, digit, marks, bars = of(_UPPER), of(_LOWER), of(_DIGIT), of(_MARKS), of(b"|")
    lines = [x for x in raw.split(b"\n") if x]
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        min(4.0, 10 * upper / max(1, upper + lower)), min(4.0, 20 * digit / n), min(4.0, 20 * marks / w), min(4.0, 10 * bars / w),
        min(4.0, 10 * (1 - len(set(words)) / w) if w > 20 else 0.0), min(4.0, 10 * (1 - len(set(lines)) / max(1, len(lines)))), min(4.0, 20 * same / w),
        min(4.0, n / w / 5), np.log1p(w) / 2, min(4.0, 20 * (raw.count(b".") + raw.count(b",")) / w), float(w < 5),
    ]


class Classifier:
    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, constant: float):
        self.mean, self.scale, self.weights, self.constant = mean, scale, weights, constant

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.weights + self.constant
        return 1 / (1 + np.exp(-np.clip(z, -12, 12)))


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> Classifier:
    """Newton steps on the penalised logistic loss, with squares and hinges of x."""
    k = x.shape[1]
    if not len(y) or y.min() == y.max():
        return Classifier(np.zeros(k), np.ones(k), np.zeros(k), 12.0)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    a = np.c_[(x - mean) / scale, np.ones(len(y))]
    wt = np.where(y > 0, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    b = np.zeros(k + 1)
    ridge = np.r_[np.full(k, penalty * len(y) / 100), 1e-6]
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        g = a.T @ (wt * (p - y)) + ridge * b
        h = (a * (wt * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ a + np.diag(ridge)
        b = b - np.linalg.solve(h, g)
    return Classifier(mean, scale, b[:k], float(b[k]))


def expand(x: np.ndarray) -> np.ndarray:
    return np.c_[x, x * x / 4]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, per_class: int = PER_CLASS) -> Classifier:
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"], "x": [features(t) for t in pdf["text"]]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = sorted((r["doc_id"], r["label"], *r["x"]) for r in labelled_sample(docs, labels, label, folds, per_class).mapInPandas(scan, f"doc_id {kind}, label int, x array<double>").collect())
    table = np.array([r[1:] for r in got], np.float64).reshape(-1, 1 + len(features("")))  # 2 * per_class rows at most
    return fit(expand(table[:, 1:]), table[:, 0])


def _site(docs: DataFrame) -> tuple[Column, Column]:
    names = docs.columns
    source = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in names else F.lit("")
    bare = F.regexp_replace(source, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.element_at(F.split(bare, "/"), 1))
    part = F.try_element_at(F.split(bare, "/"), F.lit(2))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in names else F.lit("")
    return host, F.coalesce(F.nullif(part, F.lit("")), lang)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(between: Column, mean: Column) -> Column:
    """Prior rows of a beta distribution with that mean and variance between sites."""
    return F.greatest(F.lit(1.0), F.least(F.lit(1000.0), mean * (1 - mean) / F.greatest(between, F.lit(1e-6)) - 1))


def scored(docs: DataFrame, labels: DataFrame, trust: float = TRUST, swing: float = SWING, **knobs) -> DataFrame:
    """doc (the whole row), doc_id, host, path, evidence, host_mean, path_mean, score, keep."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, **knobs))

    @F.pandas_udf("double")
    def evidence(text: pd.Series) -> pd.Series:
        if not len(text):
            return pd.Series([], dtype="float64")
        return pd.Series(shared.value.probability(expand(np.array([features(t) for t in text]))))

    host, path = _site(docs)
    # A row number would cost a shuffle; the evidence is worked out anew where it is
    # needed, which is a map over the text and moves nothing.
    judged = packed(docs, "doc_id", "text", host.alias("host"), path.alias("path")).withColumn("evidence", evidence(F.col("text")))
    paths = materialize(judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("evidence").alias("s")), "sites", docs.count())
    every = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    n, s = every["n"] or 0, every["s"] or 0.0
    mean = min(0.999, max(0.001, s / n)) if n else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    spread = hosts.agg(F.sum(F.col("hn") * (F.col("hs") / F.col("hn") - mean) ** 2) / F.sum("hn")).first()[0] or 0.0
    prior = _strength(F.lit(spread), F.lit(mean))
    hosts = hosts.withColumn("host_mean", (F.col("hs") + prior * mean) / (F.col("hn") + prior))
    both = paths.join(hosts, "host")
    within = both.agg(F.sum(F.col("n") * (F.col("s") / F.col("n") - F.col("host_mean")) ** 2) / F.sum("n")).first()[0] or 0.0
    prior = _strength(F.lit(within), F.col("host_mean"))
    sites = materialize(both.select(F.col("host").alias("host2"), F.col("path").alias("path2"), "host_mean", ((F.col("s") + prior * F.col("host_mean")) / (F.col("n") + prior)).alias("path_mean")), "posteriors", paths.count())
    small = sites.limit(SITES + 1).count() <= SITES
    met = judged.join(F.broadcast(sites) if small else sites, (F.col("host") == F.col("host2")) & (F.col("path") == F.col("path2")), "left")
    limit = lambda c: F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), c))
    site = trust * (_logit(limit(F.col("path_mean"))) - _logit(F.lit(mean)))
    site = F.greatest(F.lit(-swing), F.least(F.lit(swing), site))
    worded = F.coalesce(F.col("text").rlike(r"[^ \t-\r]"), F.lit(False))
    z = F.when(worded, _logit(limit(F.col("evidence"))) + site).otherwise(F.lit(-14.0))
    return met.withColumn("score", 1 / (1 + F.exp(-z))).withColumn("keep", F.col("score") >= 0.5)


def classify(docs: DataFrame, labels: DataFrame, **knobs) -> DataFrame:
    """doc_id, evidence, host and path posteriors, score and quality (0 or 1)."""
    few = docs.select(*[c for c in ("doc_id", "text", "source", "lang") if c in docs.columns])
    return scored(few, labels, **knobs).select("doc_id", "host", "path", "evidence", "host_mean", "path_mean", "score", F.col("keep").cast("int").alias("quality"))


def keep_good(docs: DataFrame, labels: DataFrame, **knobs) -> DataFrame:
    """``docs`` without the rows that are rejected."""
    return unpacked(scored(docs, labels, **knobs).where("keep"))
