"""Documents of the older shape: rows (doc_id, pos, type, id, page, bbox array,
content, source)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G

CAPTION = r"(?iU)^\s*(?:Figure|Fig\.?)\s*([0-9]+)"
FIGURES = "figures/"


def drop_contained(blocks: DataFrame, share: float = 0.75) -> DataFrame:
    """Without paragraphs and lists that lie in an image of their page."""
    images = blocks.where("type = 'image' and bbox is not null").select("doc_id", "page", F.col("bbox").alias("image_bbox"))
    text = F.col("type").isin("paragraph", "list") & F.col("bbox").isNotNull()
    inside = blocks.where(text).join(images, ["doc_id", "page"]).where(G.mostly_inside(F.col("bbox"), F.col("image_bbox"), share)).select("doc_id", "pos").distinct()
    return blocks.join(inside, ["doc_id", "pos"], "left_anti").select(*blocks.columns)


def tables_to_images(blocks: DataFrame, heights: DataFrame) -> DataFrame:
    """Tables with page, box and id become images; ``crop`` is the clip in top-left
    coordinates.  ``heights``: doc_id, page, page_height."""
    met = blocks.join(heights, ["doc_id", "page"], "left")
    ok = (F.col("type") == "table") & F.col("page").isNotNull() & F.col("bbox").isNotNull() & F.col("id").isNotNull()
    h, b = F.col("page_height"), F.col("bbox")
    crop = F.when(ok, F.array(b[0], G.flip(b[3], h), b[2], G.flip(b[1], h)))
    source = F.concat(F.lit("figures/table_"), F.col("id").cast("string"), F.lit(".png"))
    changed = {"type": F.when(ok, "image").otherwise(F.col("type")), "source": F.when(ok, source).otherwise(F.col("source")), "content": F.when(~ok, F.col("content"))}
    return met.withColumn("crop", crop).select(*[changed[c].alias(c) if c in changed else F.col(c) for c in blocks.columns], "crop")


def reorder_figures(blocks: DataFrame) -> DataFrame:
    """Every caption 'Figure N' gets the N-th distinct figure just before it.

    Figures count by id, one for each source; repeats are dropped, and figures without
    a caption stay where they are.  ``pos`` is made dense again.
    """
    figure = (F.col("type") == "image") & F.coalesce(F.col("source"), F.lit("")).contains(FIGURES)
    once = Window.partitionBy("doc_id", "source").orderBy(F.coalesce("id", F.lit(0)), "pos")
    figures = blocks.where(figure).withColumn("__n", F.row_number().over(once))
    unique = figures.where("__n = 1").withColumn("number", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.coalesce("id", F.lit(0)), "pos"))).drop("__n")
    number = F.nullif(F.regexp_extract(F.coalesce("content", F.lit("")), CAPTION, 1), F.lit("")).try_cast("int")
    captions = blocks.where(F.col("type").isin("paragraph", "list")).withColumn("number", number).where("number is not null").select("doc_id", "number", F.col("pos").alias("cap_pos"))
    moved = unique.join(captions, ["doc_id", "number"])
    placed = moved.select(*[F.col(c) for c in blocks.columns], F.col("cap_pos").alias("__at"), F.lit(0).alias("__side"))
    gone = figures.where("__n > 1").select("doc_id", "pos").unionByName(moved.select("doc_id", "pos")).distinct()
    rest = blocks.join(gone, ["doc_id", "pos"], "left_anti").select(*blocks.columns, F.col("pos").alias("__at"), F.lit(1).alias("__side"))
    order = Window.partitionBy("doc_id").orderBy("__at", "__side", "pos")
    return rest.unionByName(placed).withColumn("__new", (F.row_number().over(order) - 1).cast("int")).withColumn("pos", F.col("__new")).select(*blocks.columns)


def clean_legacy(blocks: DataFrame, heights: DataFrame) -> DataFrame:
    return reorder_figures(tables_to_images(drop_contained(blocks), heights).drop("crop"))
