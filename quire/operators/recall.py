"""How much of a page's own text an extraction kept."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from ..functions import text as T
from ..functions.frames import keyed, with_once

THRESHOLD, SHOWN = 0.85, 30
_HELD = 200_000  # counts in a worker before they are sent back
_JUDGED = StructType([StructField("unique_recall", DoubleType()), StructField("missing", ArrayType(StringType()))])


def unique_recall(digital: set[str], extracted: set[str]) -> float:
    return len(digital & extracted) / len(digital) if digital else 1.0


def missing_words(digital: set[str], extracted: set[str], shown: int = SHOWN) -> list[str]:
    return sorted(digital - extracted)[:shown]


@F.pandas_udf(_JUDGED)
def _judged(digital: pd.Series, extracted: pd.Series) -> pd.DataFrame:
    sets = [(set(T.digital_words(d or "")), set(T.extracted_words(e or ""))) for d, e in zip(digital, extracted, strict=True)]
    return pd.DataFrame({"unique_recall": [unique_recall(*x) for x in sets], "missing": [missing_words(*x) for x in sets]})


def verify(pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, unique_recall, is_valid, missing of pairs of digital_text and
    extracted_text.  Blank digital text is valid."""
    df = with_once(pairs.select("doc_id", "digital_text", "extracted_text"), {"__j": _judged("digital_text", "extracted_text")})
    r = F.col("__j.unique_recall")
    return df.select("doc_id", r.alias("unique_recall"), (r >= threshold).alias("is_valid"), F.col("__j.missing").alias("missing"))


def _tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each word of an id, and one without a word: ids without words count, too.
    Pairs of one id are added up before they move, as far as they come together."""
    for b in batches:
        found: dict = {}  # id: place of its first pair, counts of either side
        held = 0

        def out() -> pa.RecordBatch:
            at, words, own, kept = [], [], [], []
            for i, mine, theirs in found.values():  # noqa: B023
                every = list(mine | theirs)
                at += [i] * (len(every) + 1)
                words += [None, *every]
                own += [0, *[mine[w] for w in every]]
                kept += [0, *[theirs[w] for w in every]]
            return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(words, pa.string()), pa.array(own, pa.int64()), pa.array(kept, pa.int64())], ["doc_id", "word", "own", "kept"])  # noqa: B023

        for i, (doc, d, e) in enumerate(zip(*b.columns, strict=True)):
            _, mine, theirs = found.setdefault(doc, (i, Counter(), Counter()))
            held -= len(mine) + len(theirs)
            mine.update(T.digital_words(d.as_py() or ""))
            theirs.update(T.extracted_words(e.as_py() or ""))
            held += len(mine) + len(theirs)
            if held >= _HELD:
                yield out()
                found, held = {}, 0
        if found:
            yield out()


def count_recall(pairs: DataFrame) -> DataFrame:
    """doc_id, count_recall: share of digital words, with repeats, that were kept."""
    kind = pairs.schema["doc_id"].dataType.simpleString()
    every = pairs.select("doc_id", "digital_text", "extracted_text").mapInArrow(_tallies, f"doc_id {kind}, word string, own long, kept long")
    words = keyed(every, "doc_id").groupBy("doc_id", "word").agg(F.sum("own").alias("own"), F.sum("kept").alias("kept"))
    sums = words.groupBy("doc_id").agg((F.sum(F.least("own", "kept")) / F.nullif(F.sum("own"), F.lit(0))).alias("count_recall"))
    return sums.select("doc_id", F.coalesce("count_recall", F.lit(1.0)).alias("count_recall"))


def batch_pages(pages: DataFrame, per_batch: int | None) -> DataFrame:
    """doc_id, batch_id, text: pages in batches, non-empty texts joined by lines."""
    size = per_batch if per_batch and per_batch > 0 else None
    batch = F.floor((F.col("page") - 1) / size).cast("int") if size else F.lit(0)
    text = F.when(F.coalesce(F.col("text"), F.lit("")) != "", F.struct("page", "text"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(text)), lambda x: x["text"]), "\n")
    return pages.withColumn("batch_id", batch).groupBy("doc_id", "batch_id").agg(joined.alias("text"), F.count("*").alias("n_pages"))
