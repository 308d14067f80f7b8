"""Noise removal and paragraph stitching over blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..functions.frames import with_once

# Phrases that mark noise, front-page clutter and logos.
NOISE_PHRASES = ("copyright", "all rights reserved")
NOISE_WHOLE = ("spine", "spine deformity", "global spine journal", "springer")
URL_MARKS = ("www.", "http://", "https://")
DOMAIN_MARKS = (".com", ".org", ".edu", ".cn", ".gov")
FRONT_WHOLE = ("original article", "review article", "case report", "editorial", "letter to the editor", "global spine journal", "spine deformity", "spine")
LOGO_MARKS = ("logo", "creative commons", "icon")
VOLUME = r"(?iU)^\d{4},?\s*vol\.?\s*\d+\(?\d+\)?\s+\d+[–-]\d+\z"
AUTHORS = r"(?iU)^©\s*the author\(s\)\s*\d{4}\z"


def _any(c: Column, marks: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for m in marks:
        out = out | c.contains(m)
    return out


def _noise(plain: Column) -> Column:
    low = F.lower(plain)
    return (
        (plain == "") | plain.rlike(r"^[*•·\-_=]{3,}\z") | plain.rlike(r"(?d)^(.)\1+\z")
        | (_any(low, URL_MARKS) & (F.length(low) < 30)) | (_any(low, DOMAIN_MARKS) & (F.length(low) < 10))
        | _any(low, NOISE_PHRASES) | plain.startswith("©") | low.isin(*NOISE_WHOLE)
    )


def is_noise(c: Column) -> Column:
    return T.let(T.strip_md(c), _noise)


def is_front_matter(c: Column) -> Column:
    """Clutter of a first page; an empty text is none."""
    return T.let(T.strip_md(c), _front_matter)


def _front_matter(plain: Column) -> Column:
    low = F.lower(plain)
    return (plain != "") & (low.isin(*FRONT_WHOLE) | plain.rlike(VOLUME) | plain.rlike(AUTHORS) | (low.contains("creative commons") & low.contains("license")) | _noise(plain))


def is_running_head(c: Column) -> Column:
    """May the text be a running header or footer?"""
    return T.let(T.strip_md(c), _running_head)


def _running_head(plain: Column) -> Column:
    journal = plain.rlike(r"(?idU)^(?=.*\d)(?=.*\bjournal\b)")
    numbered = plain.rlike(r"(?U)^\d+\b") & (F.size(F.split(plain, r"(?U)\s+")) <= 8)
    return _noise(plain) | journal | numbered | plain.rlike(r"(?U)^[A-Z][a-z]+\s+et\s+al\.?\s+\d+\z")


def is_logo(c: Column) -> Column:
    low = F.lower(c)
    return ~low.contains("<figcaption") & _any(low, LOGO_MARKS)


def drop_artifacts(blocks: DataFrame) -> DataFrame:
    df = with_once(blocks, {"__plain": T.strip_md(F.col("content"))})
    return df.where(~((F.col("type") == "paragraph") & _noise(F.col("__plain")))).drop("__plain")


def drop_logos(blocks: DataFrame) -> DataFrame:
    return blocks.where(~((F.col("type") == "figure") & is_logo(F.col("content"))))


def drop_running_heads(blocks: DataFrame, scan: int = 3, most_words: int = 10) -> DataFrame:
    """Front matter of first pages, then the outer paragraphs of every page that look
    like running heads.  The order is by page, then position."""
    paragraph = F.col("type") == "paragraph"
    df = blocks.where(~((F.col("page") == 1) & paragraph & is_front_matter(F.col("content"))))
    page = Window.partitionBy("doc_id", "page").orderBy("pos")
    upto, whole = page.rowsBetween(Window.unboundedPreceding, 0), page.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.when(paragraph, 0).otherwise(1)
    df = df.withColumns({"__other": F.sum(other).over(upto), "__others": F.sum(other).over(whole), "__nth": F.row_number().over(page), "__n": F.count(F.lit(1)).over(whole)})
    up = (F.col("__nth") <= scan) & (F.col("__other") == 0)
    down = (F.col("__n") - F.col("__nth") < scan) & (F.col("__others") - F.col("__other") + other == 0)  # the same from below
    short = lambda plain: _running_head(plain) & (T.plain_words(plain) < most_words)
    bad = (up | down) & T.let(T.strip_md(F.col("content")), short)
    return df.where(~bad).select(*blocks.columns)


def merge_paragraphs(blocks: DataFrame, least_words: int = 10) -> DataFrame:
    """Join paragraphs broken in two: each with the next one, pairs not overlapping.

    Greedy pairing in a chain of links takes every odd link of the chain, so it is a
    window, not a loop.  Paragraphs that open with emphasis take no part.
    """
    simple = (F.col("type") == "paragraph") & ~T.lstrip(F.col("content")).startswith("*")
    df = with_once(blocks, {"__s": simple, "__words": T.word_count(F.col("content"))})
    w = Window.partitionBy("doc_id", "__s").orderBy("page", "pos")
    long = F.col("__words") > least_words
    df = with_once(df, {"__end": F.coalesce(T.ends_broken(F.col("content")) & long, F.lit(False)), "__start": F.coalesce(T.starts_broken(F.col("content")) & long, F.lit(False))})
    df = df.withColumns({"__next": F.lead("content").over(w), "__link": F.col("__s") & F.col("__end") & F.coalesce(F.lead("__start").over(w), F.lit(False))})
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("__nth", F.row_number().over(w))
    chain = F.col("__nth") - F.coalesce(F.max(F.when(F.col("__link"), F.lit(None)).otherwise(F.col("__nth"))).over(upto), F.lit(0))
    df = df.withColumn("__fires", F.col("__link") & (chain % 2 == 1))
    df = df.withColumn("__gone", F.coalesce(F.lag("__fires").over(w), F.lit(False)))
    merged = F.when(F.col("__fires"), T.join_parts(F.col("content"), F.col("__next"))).otherwise(F.col("content"))
    return df.where(~F.col("__gone")).withColumn("content", merged).select(*blocks.columns)


def clean(blocks: DataFrame) -> DataFrame:
    """Running heads, artifacts, logos, then stitching."""
    return blocks.transform(drop_running_heads).transform(drop_artifacts).transform(drop_logos).transform(merge_paragraphs)
