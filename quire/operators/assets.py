"""Figures and tables: numbers, captions, and the files that show them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..functions.frames import with_once

#: Assets are a row for each figure or table of a document; up to this many are sent
#: to all workers, more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def latest_assets(assets: DataFrame) -> DataFrame:
    """One path for each (doc_id, category, number): the highest page's, then path's."""
    return assets.groupBy("doc_id", "category", "number").agg(F.max_by("rel_path", F.struct("page", "rel_path")).alias("rel_path"))


def numbered(blocks: DataFrame) -> DataFrame:
    """Add ``category``, ``number`` and ``caption_found`` to figures and tables: from
    their own markup, else from a paragraph just before."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    df = blocks.withColumn("__prev", F.lag(F.struct("type", "content")).over(w))
    c, prev = F.col("content"), F.col("__prev")

    def found(own: Column, before: Column) -> Column:
        return F.when(own["number"].isNotNull(), own).when(prev["type"] == "paragraph", before)

    figure = found(T.html_figure(c), T.figure_number(prev["content"]))
    table = found(T.html_table(c), T.table_number(prev["content"]))
    got = F.when(F.col("type") == "figure", figure).when(F.col("type") == "table", table)
    category = F.when(F.col("type") == "figure", "images").when(F.col("type") == "table", "tables")
    return with_once(df, {"category": category, "__x": got}).withColumns({"number": F.col("__x.number"), "caption_found": F.col("__x.caption")}).drop("__prev", "__x")


def join_assets(blocks: DataFrame, assets: DataFrame) -> DataFrame:
    """Blocks whose number has a file take its path as content, with caption and (for
    figures) alt text; the rest stay as they are."""
    one = latest_assets(assets)
    small = one.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    met = numbered(blocks).join(F.broadcast(one) if small else one, ["doc_id", "category", "number"], "left")
    hit = F.col("rel_path").isNotNull()
    return met.select(
        *[F.when(hit, F.col("rel_path")).otherwise(F.col("content")).alias("content") if c == "content" else F.col(c) for c in blocks.columns],
        F.when(hit, F.col("caption_found")).alias("caption"), F.when(hit & (F.col("type") == "figure"), T.alt_text(F.col("content"))).alias("alt_text"), hit.alias("matched"),
    )


def table_names(tables: DataFrame, cells: DataFrame) -> DataFrame:
    """doc_id, page, table_ord, identifier: from the linked caption, else the first
    cell that gives one, else the text before.  ``tables``: caption, prev_text (null
    unless the element before is a text)."""

    def named(c: Column) -> Column:
        x = T.table_number(c)
        return T.table_identifier(x["number"], x["caption"])

    ids = cells.select("doc_id", "page", "table_ord", "cell_ord", named(F.col("text")).alias("id")).where("id is not null")
    first = ids.groupBy("doc_id", "page", "table_ord").agg(F.min_by("id", "cell_ord").alias("cell_id"))
    met = tables.join(first, ["doc_id", "page", "table_ord"], "left")
    own = F.when(F.coalesce(F.col("caption"), F.lit("")) != "", named(F.col("caption")))
    return met.select("doc_id", "page", "table_ord", F.coalesce(own, "cell_id", named(F.col("prev_text"))).alias("identifier"))
