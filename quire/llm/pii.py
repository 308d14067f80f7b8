"""Personal data, and the terms that give it away.

Base spans (e-mail, IP address, payment card, phone number) are found by their
patterns.  Their values are the protected entities.  Over the whole corpus the
operator estimates how much each term tells about each entity: with N rows,
n(e), n(t) and n(e, t) of them holding the entity, the term, and the term within
``reach`` words of the entity,

    PMI(e; t) = log2(N * n(e, t) / (n(e) * n(t))),    IC(e) = log2(N / n(e)).

A term with PMI(e; t) >= IC(e) / ``alpha``, seen beside the entity in two different
texts or more, exceeds the disclosure threshold: wherever a document holds the entity,
the term's occurrences become spans too.  A term is generalised
to its shape (``Aa``, ``a``, ``9``, ``a9``) as long as the shape itself stays
under the threshold for that entity, else it is removed.

Copies of one text are one text, so they alone support nothing.  A worker adds up what
it sees of an entity and a term (rows, least and greatest hash of their texts) before it
is sent, so no footer address is hot.  Terms counted over all documents are only those
near some entity often enough; a fixed-size filter (:func:`with_maybe`) picks them and
the counts behind it are exact.

Results for odd rows: null and empty texts have no spans (their digest is that of
the empty string); rows that repeat doc_id and text give equal rows; null ids
stay null.  Very long texts take time in proportion to their length: no pattern
tries a stretch twice.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import materialize, packed, text_key, unpacked, with_maybe
from ._words import rows_out

KINDS = ("email", "ip", "card", "phone")
REACH, ALPHA, TERM_BITS = 8, 1.25, 1 << 23
#: Pairs of entity and term that are broadcast at most, and parts of an entity's rows beyond.
FLAGGED, SALTS = 100_000, 64

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A digit run that fails fails from each of its digits, so tries begin at its first.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_WORD = re.compile(r"\w+")
Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[Span]:
    """Spans of the four kinds in code points, by kind, then start."""
    if not text:
        return []
    out: list[Span] = [("email", a, b) for a, b in _emails(text)]
    if not _DIGITS.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(q := p.lstrip("0")) < 4 and int(q or "0") <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m[0])) <= 15]
    return out


def entity(kind: str, value: str) -> int:
    """64-bit name of a protected value: case and separators do not matter."""
    plain = value.lower() if kind in ("email", "ip") else "".join(_DIGITS.findall(value))
    return int(np.uint64(xxhash.xxh3_64_intdigest(f"{kind}:{plain}")).view(np.int64))


def shape(term: str) -> str:
    """``a`` without digits, ``9`` of digits alone, ``a9`` of both."""
    if term.isalpha():
        return "a"
    if term.isdigit():
        return "9"
    return "a9" if any(map(str.isdigit, term)) else "a"


def _outside(spans: list[Span], text: str) -> list[tuple[str, int, int]]:
    """Lowered terms of three characters or more that touch no span."""
    ranges = sorted((a, b) for _, a, b in spans)
    out, i = [], 0
    for m in _WORD.finditer(text):
        a, b = m.span()
        while i < len(ranges) and ranges[i][1] <= a:
            i += 1
        if b - a >= 3 and not (i < len(ranges) and ranges[i][0] < b):
            out.append((m[0].lower(), a, b))
    return out


def _mentions(text: str, reach: int) -> Iterator[tuple[int, list[str]]]:
    """(entity, terms around it) for every base span."""
    spans = base_spans(text)
    if not spans:
        return
    terms = _outside(spans, text)
    starts = np.array([a for _, a, _ in terms], np.int64)
    for kind, a, b in spans:
        i, j = np.searchsorted(starts, [a, b])
        yield entity(kind, text[a:b]), [t for t, _, _ in terms[max(0, i - reach) : i]] + [t for t, _, _ in terms[j : j + reach]]


def _mark(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def disclosing_terms(docs: DataFrame, reach: int = REACH, alpha: float = ALPHA) -> tuple[DataFrame, DataFrame]:
    """(mentions, flagged): every row's entities, and for each entity the terms
    that exceed the threshold with what becomes of them (1 generalise, 2 remove)."""
    base = docs.select("doc_id", text_key().alias("row"), F.col("text"))
    schema = pa.schema([("e", pa.int64()), ("term", pa.string()), ("n", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("doc", pa.int64())])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, str], tuple[int, int, int]] = {}
        for batch in batches:
            cols: dict[str, list] = {f.name: [] for f in schema}

            def put(*values) -> None:
                for f, x in zip(schema, values, strict=True):
                    cols[f.name].append(x)

            for text, row, doc in zip(batch["text"].to_pylist(), batch["row"].to_pylist(), batch["k"].to_pylist(), strict=True):
                if not text:
                    continue
                once = set()
                for e, terms in _mentions(text, reach):
                    once.add((e, None))
                    once.update((e, t) for t in terms)
                    once.update((e, f"\x00{shape(t)}") for t in terms)
                for e, t in once:
                    if t is None:
                        put(e, None, 1, None, None, doc)
                    else:
                        n, lo, hi = sums.get((e, t), (0, row, row))
                        sums[e, t] = (n + 1, min(lo, row), max(hi, row))
            if len(sums) > 1 << 17:
                for (e, t), (n, lo, hi) in sums.items():
                    put(e, t, n, lo, hi, None)
                sums.clear()
            yield rows_out(schema, cols)
        cols = {"e": [e for e, _ in sums], "term": [t for _, t in sums], "doc": [None] * len(sums)}
        yield rows_out(schema, cols | {c: [x[i] for x in sums.values()] for i, c in enumerate(("n", "lo", "hi"))})

    seen = materialize(base.select("text", "row", F.xxhash64("doc_id", "row").alias("k")).mapInArrow(near, "e long, term string, n long, lo long, hi long, doc long"), "mentions")
    n_seen = seen.count()
    entities = seen.where("term is null").groupBy("e").agg(F.count("*").alias("n_e"))
    together = seen.where("term is not null").groupBy("e", "term").agg(F.sum("n").alias("n_et"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi")
    together = materialize(together.select("e", "term", "n_et").join(entities, "e"), "together", n_seen)

    # n(t), counted over all documents for the terms in question.
    wanted = together.select(F.xxhash64("term").alias("k"))
    kinds = [r["term"] for r in together.where(F.col("term").startswith("\x00")).select("term").distinct().collect()]  # three shapes at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        marked = {x: f"\x00{x}" for x in ("a", "9", "a9")}

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], ["term", "n"])
            sums.clear()
            return out

        for batch in batches:
            for text in batch["text"].to_pylist():
                if text:
                    terms = set(_WORD.findall(text.lower()))
                    sums.update(terms)
                    if kinds:
                        sums.update({marked[shape(t)] for t in terms if len(t) > 2})
            if len(sums) > 1 << 17:
                yield rows()
        yield rows()

    every = base.select("text").mapInArrow(count, "term string, n long").withColumn("k", F.xxhash64("term"))
    counted = with_maybe(every, "k", wanted, "k", TERM_BITS).where("maybe").groupBy("term").agg(F.sum("n").alias("n_t"))
    n = docs.count()  # rows, as are n_e, n_t and n_et
    scored = together.join(counted, "term").withColumn("pmi", F.log2(F.lit(float(n)) * F.col("n_et") / (F.col("n_e") * F.col("n_t"))))
    over = materialize(scored.where(F.col("pmi") >= F.log2(F.lit(float(n)) / F.col("n_e")) / alpha).where(F.lit(float(n)) > F.col("n_e")).select("e", "term"), "over", n_seen)
    shapes = over.where(F.col("term").startswith("\x00")).groupBy("e").agg(F.collect_set("term").alias("shapes"))
    flagged = over.where(~F.col("term").startswith("\x00")).groupBy("e").agg(F.collect_set("term").alias("terms")).join(shapes, "e", "left")
    return seen.where("term is null").select("e", "doc").distinct(), materialize(flagged, "flagged", n_seen)


def row_terms(docs: DataFrame, **knobs) -> DataFrame:
    """key (of doc_id and text), terms, shapes: what to hide beside base spans."""
    mentions, flagged = disclosing_terms(docs, **knobs)
    told = flagged.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    if told <= FLAGGED:
        met = mentions.join(F.broadcast(flagged), "e")
    else:  # rows of one entity meet its terms in many tasks
        parts = flagged.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = mentions.withColumn("salt", F.pmod("doc", F.lit(SALTS))).join(parts, ["e", "salt"])
    got = met.groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms"), F.array_distinct(F.flatten(F.collect_list(F.coalesce("shapes", F.array().cast("array<string>"))))).alias("shapes"))
    return materialize(got.withColumnRenamed("doc", "key2"), "terms", docs.count())


def _with_terms(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text and perhaps doc) with terms and shapes; those without any
    take no shuffle."""
    keyed = with_maybe(rows.withColumn("key", F.xxhash64("doc_id", text_key())), "key", terms, "key2")
    none = F.lit(None).cast("array<string>")
    met = keyed.where("maybe").join(terms, F.col("key") == F.col("key2"), "left").drop("key2")
    return met.unionByName(keyed.where(~F.col("maybe")).withColumns({"terms": none, "shapes": none})).drop("key", "maybe")


def all_spans(text: str | None, terms: list[str] | None) -> tuple[list[Span], list[Span]]:
    base = base_spans(text)
    if terms is None or not len(terms):
        return base, []
    hide = set(terms)
    return base, [("term", a, b) for t, a, b in _outside(base, text or "") if t in hide]


def find_personal(docs: DataFrame, **knobs) -> DataFrame:
    """doc_id, counts by kind, base_sha256, spans and n_term for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([*((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_term", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: dict[str, list] = {f.name: [] for f in schema}
            for text, terms in zip(batch["text"].to_pylist(), batch["terms"].to_pylist(), strict=True):
                base, more = all_spans(text, terms)
                for k in KINDS:
                    cols[f"n_{k}"].append(sum(s[0] == k for s in base))
                cols["base_sha256"].append(hashlib.sha256(_mark(base).encode()).hexdigest())
                cols["spans"].append(_mark(base + more))
                cols["n_term"].append(len(more))
            out = rows_out(schema, cols)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *out.columns], ["doc_id", *schema.names])

    joined = _with_terms(docs.select("doc_id", "text"), row_terms(docs, **knobs)).select("doc_id", "text", "terms")
    return joined.mapInArrow(scan, f"doc_id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string, n_term long")


def sanitise(text: str | None, terms: list[str] | None = None, shapes: list[str] | None = None) -> str | None:
    """The text with base spans named by kind and terms generalised or removed."""
    if not text:
        return text
    base, more = all_spans(text, terms)
    if not base and not more:
        return text
    out, end, barred = [], 0, set(() if shapes is None else shapes)
    for k, a, b in sorted(base + more, key=lambda s: (s[1], -s[2])):
        if b <= end:
            continue
        out.append(text[end : max(a, end)])
        if k != "term":
            out.append(f"[{k.upper()}]")
        elif f"\x00{shape(text[a:b])}" not in barred:
            out.append(f"[{shape(text[a:b])}]")
        end = b
    return "".join(out) + text[end:]


def sanitised(docs: DataFrame, **knobs) -> DataFrame:
    """``docs`` with their texts sanitised, all other columns as they were."""

    @F.pandas_udf("string")
    def clean(text: pd.Series, terms: pd.Series, shapes: pd.Series) -> pd.Series:
        return pd.Series([sanitise(t, x, s) for t, x, s in zip(text, terms, shapes, strict=True)], dtype=object)

    out = _with_terms(packed(docs, "doc_id", "text"), row_terms(docs, **knobs)).withColumn("clean", clean("text", "terms", "shapes"))
    return unpacked(out.select(F.col("doc").withField("text", F.col("clean")).alias("doc")))
