"""Which part of which page makes a chapter's document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G


def crop_plan(chapters: DataFrame, padding: float = 0.0, split: float = 0.5, narrow: float = 0.65) -> DataFrame:
    """doc_id, section, out_ord, src_page, rect, error.

    ``chapters``: doc_id, section, page_w, page_h, start_page, start_bbox, end_page,
    end_bbox.  Boundary pages are cropped, inner pages are whole; a chapter with a
    missing page or box, or an end before its start, is one row with an error.
    """
    w, h = F.col("page_w"), F.col("page_h")
    missing = F.col("start_page").isNull() | F.col("start_bbox").isNull() | F.col("end_page").isNull() | F.col("end_bbox").isNull()
    error = F.when(missing, "missing page or box").when(F.col("end_page") < F.col("start_page"), "end before start")
    df = chapters.withColumn("error", error)
    bad = df.where("error is not null").select("doc_id", "section", F.lit(None).cast("int").alias("out_ord"), F.lit(None).cast("int").alias("src_page"), F.lit(None).cast("struct<x0:double,y0:double,x1:double,y1:double>").alias("rect"), "error")
    pages = df.where("error is null").withColumn("src_page", F.explode(F.sequence("start_page", "end_page")))
    none = F.lit(None).cast("struct<l:double,t:double,r:double,b:double>")
    rects = lambda s, e: G.crop_rectangles(w, h, s, e, padding, split, narrow)
    whole = F.array(F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), w.cast("double").alias("x1"), h.cast("double").alias("y1")))
    first, last = F.col("src_page") == F.col("start_page"), F.col("src_page") == F.col("end_page")
    kept = F.when(first & last, rects(F.col("start_bbox"), F.col("end_bbox"))).when(first, rects(F.col("start_bbox"), none)).when(last, rects(none, F.col("end_bbox"))).otherwise(whole)
    good = pages.select("doc_id", "section", "src_page", F.posexplode(kept).alias("k", "rect"))
    out = good.groupBy("doc_id", "section").agg(F.array_sort(F.collect_list(F.struct("src_page", "k", "rect"))).alias("s")).select("doc_id", "section", F.posexplode("s").alias("out_ord", "x"))
    return out.select("doc_id", "section", "out_ord", F.col("x.src_page").cast("int").alias("src_page"), "x.rect", F.lit(None).cast("string").alias("error")).unionByName(bad)


def chapter_headings(blocks: DataFrame) -> DataFrame:
    return blocks.where("type = 'heading'")
