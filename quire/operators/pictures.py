"""Pictures of a page, put together with their captions.

All joins carry the key (doc_id, page) and a geometric condition: what meets is the
few pictures and captions of one page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from ..functions import text as T

LEAST_PIXELS = 150
KEY = ["doc_id", "page"]


def saveable(pictures: DataFrame, least: int = LEAST_PIXELS) -> DataFrame:
    return pictures.withColumn("saveable", (F.col("width") >= least) & (F.col("height") >= least))


def caption_candidates(texts: DataFrame) -> DataFrame:
    """Texts of a page that carry a figure number."""
    x = T.figure_number(F.col("text"))
    here = F.col("prov_page").isNull() | (F.col("prov_page") == F.col("page"))
    return texts.withColumn("number", x["number"]).where(F.col("number").isNotNull() & here)


def linked_captions(pictures: DataFrame, texts: DataFrame) -> DataFrame:
    """Number and text of the first child text, in order, that yields a number."""
    child = pictures.select(*KEY, "ord", F.posexplode("child_refs").alias("child_ord", "self_ref"))
    met = child.join(texts.select(*KEY, "self_ref", "text", F.col("ord").alias("text_ord")), [*KEY, "self_ref"])
    x = T.figure_number(F.col("text"))
    met = met.withColumns({"n": x["number"], "c": x["caption"]}).where("n is not null")
    return met.groupBy(*KEY, "ord").agg(F.min_by(F.struct("n", "c"), F.struct("child_ord", "text_ord")).alias("x")).select(*KEY, "ord", F.col("x.n").alias("caption_number"), F.col("x.c").alias("caption_text"))


def used_captions(pictures: DataFrame, captions: DataFrame) -> DataFrame:
    """Captions with ``used``: paired one to one, in order, with saveable pictures of
    the same number and text."""
    same = [*KEY, "number", "text"]
    place = Window.partitionBy(*same).orderBy("ord")
    mine = pictures.where("saveable and caption_number is not null").select(*KEY, F.col("caption_number").alias("number"), F.col("caption_text").alias("text"), "ord")
    taken = mine.withColumn("k", F.row_number().over(place)).select(*same, "k", F.lit(True).alias("used"))
    return captions.withColumn("k", F.row_number().over(place)).join(taken, [*same, "k"], "left").withColumn("used", F.coalesce("used", F.lit(False))).drop("k")


def nearest_captions(pictures: DataFrame, captions: DataFrame) -> DataFrame:
    """doc_id, page, ord, caption, placement, score: for every picture the unused
    caption with the least score below it or beside it; captions may serve twice."""
    c = captions.where("not used and bbox is not null").select(*KEY, F.col("ord").alias("cap_ord"), F.col("number").alias("cap_number"), F.col("text").alias("cap_text"), F.col("bbox").alias("cap_bbox"))
    a, b = F.col("bbox"), F.col("cap_bbox")
    met = pictures.where("bbox is not null").join(c, KEY)
    met = met.withColumns({"__b": G.gap_below(a, b), "__l": G.gap_left(a, b), "__r": G.gap_right(a, b), "__h": G.horizontal_overlap(a, b), "__v": G.vertical_overlap(a, b), "__d": G.center_distance(a, b)})
    below = F.when(F.col("__b").isNotNull() & (F.col("__h") >= 0.4), F.struct((F.col("__b") + 0.15 * F.col("__d")).alias("score"), F.lit(0).alias("way"), F.col("__b").alias("gap")))
    beside = lambda gap, way: F.when(F.col(gap).isNotNull() & (F.col("__v") >= 0.4), F.struct((F.col(gap) + 0.25 * F.col("__d") + 10).alias("score"), F.lit(way).alias("way"), F.col(gap).alias("gap")))
    met = met.withColumn("__best", F.array_min(F.array_compact(F.array(below, beside("__l", 1), beside("__r", 2)))))
    met = met.where(F.col("__best").isNotNull() & F.when(F.col("__best.way") == 0, F.col("__best.gap") <= 120).otherwise(F.col("__best.gap") <= 220))
    way = F.element_at(F.array(F.lit("below"), F.lit("left"), F.lit("right")), F.col("__best.way") + 1)
    best = met.groupBy(*KEY, "ord").agg(F.min_by(F.struct("cap_ord", "cap_number", "cap_text", way.alias("placement"), F.col("__best.score").alias("score")), F.struct("__best.score", "cap_ord")).alias("x"))
    return best.select(*KEY, "ord", "x.*")


def caption_donors(pictures: DataFrame, discarded: DataFrame) -> DataFrame:
    """The nearest too-small picture with a number, for every picture."""
    d = discarded.where("caption_number is not null and bbox is not null").select(*KEY, F.col("ord").alias("donor_ord"), F.col("caption_number").alias("donor_number"), F.col("caption_text").alias("donor_text"), F.col("bbox").alias("donor_bbox"))
    a, b = F.col("bbox"), F.col("donor_bbox")
    met = pictures.where("bbox is not null").join(d, KEY).withColumn("gap", G.edge_gap(a, b))
    met = met.where(~((G.horizontal_overlap(a, b) < 0.3) & (G.vertical_overlap(a, b) < 0.3) & (F.col("gap") > 120)))
    return met.groupBy(*KEY, "ord").agg(F.min_by(F.struct("donor_ord", "donor_number", "donor_text", "gap"), F.struct("gap", "donor_ord")).alias("x")).select(*KEY, "ord", "x.*")


def split_partners(unresolved: DataFrame, resolved: DataFrame) -> DataFrame:
    """doc_id, page, ord, target_ord, orientation: the first resolved picture of which
    an unresolved one is a panel."""
    r = resolved.select(*KEY, F.col("ord").alias("target_ord"), F.col("caption_number").alias("target_number"), F.col("bbox").alias("target_bbox"))
    met = unresolved.join(r, KEY).withColumn("orientation", G.split_orientation(F.col("bbox"), F.col("target_bbox"))).where("orientation is not null")
    return met.groupBy(*KEY, "ord").agg(F.min_by(F.struct("target_ord", "target_number", "orientation"), "target_ord").alias("x")).select(*KEY, "ord", "x.*")


def stitch_plan(partners: DataFrame, pictures: DataFrame) -> DataFrame:
    """Which picture comes first, and the size of the canvas; the last panel of a
    target wins."""
    last = partners.groupBy(*KEY, "target_ord").agg(F.max_by(F.struct("ord", "orientation", "target_number"), "ord").alias("x")).select(*KEY, "target_ord", "x.*")
    a = pictures.select(*KEY, F.col("ord"), F.col("bbox").alias("ab"), F.col("width").alias("aw"), F.col("height").alias("ah"))
    b = pictures.select(*KEY, F.col("ord").alias("target_ord"), F.col("bbox").alias("bb"), F.col("width").alias("bw"), F.col("height").alias("bh"))
    met = last.join(a, [*KEY, "ord"]).join(b, [*KEY, "target_ord"])
    flat = F.col("orientation") == "horizontal"
    target_first = F.when(flat, F.col("bb.l") <= F.col("ab.l")).otherwise(F.col("bb.t") >= F.col("ab.t"))
    return met.select(
        *KEY, "target_ord", "ord", "target_number", "orientation", F.when(target_first, F.col("target_ord")).otherwise(F.col("ord")).alias("first_ord"),
        F.when(flat, F.col("aw") + F.col("bw")).otherwise(F.greatest("aw", "bw")).alias("out_width"), F.when(flat, F.greatest("ah", "bh")).otherwise(F.col("ah") + F.col("bh")).alias("out_height"),
    )


def reconcile(pictures: DataFrame, captions: DataFrame) -> DataFrame:
    """What becomes of every picture of a page: doc_id, page, ord, outcome, number.

    Panels merge with a resolved picture; the others take the nearest unused caption,
    else a too-small picture's; what is left has no number.
    """
    p = saveable(pictures)
    good = p.where("saveable")
    resolved, unresolved = good.where("caption_number is not null"), good.where("caption_number is null")
    merged = split_partners(unresolved, resolved).select(*KEY, "ord", "target_ord", "target_number")
    near = nearest_captions(unresolved, used_captions(p, captions)).select(*KEY, "ord", "cap_number")
    donor = caption_donors(unresolved, p.where("not saveable")).select(*KEY, "ord", "donor_number")
    targets = merged.select(*KEY, F.col("target_ord").alias("ord"), F.lit(True).alias("is_target")).distinct()
    met = p.join(merged, [*KEY, "ord"], "left").join(near, [*KEY, "ord"], "left").join(donor, [*KEY, "ord"], "left").join(targets, [*KEY, "ord"], "left")
    outcome = (
        F.when(~F.col("saveable"), "discarded").when(F.col("is_target"), "stitched").when(F.col("caption_number").isNotNull(), "own").when(F.col("target_ord").isNotNull(), "merged")
        .when(F.col("cap_number").isNotNull(), "nearby").when(F.col("donor_number").isNotNull(), "donor").otherwise("no_caption")
    )
    number = F.when(outcome == "merged", F.col("target_number")).when(outcome == "discarded", F.lit(None)).otherwise(F.coalesce("caption_number", "cap_number", "donor_number"))
    return met.select(*KEY, "ord", outcome.alias("outcome"), number.cast("int").alias("number"))


def saved_files(outcomes: DataFrame) -> DataFrame:
    """doc_id, page, file, ord: the picture behind each file; the later write wins."""
    step = F.when(F.col("outcome") == "stitched", 1).when(F.col("outcome") == "own", 2).when(F.col("outcome").isin("nearby", "donor"), 3).otherwise(4)
    kept = outcomes.where("outcome not in ('discarded', 'merged')").withColumn("step", step)
    name = F.coalesce(F.col("number").cast("string"), F.concat(F.lit("no_cap_"), F.col("ord").cast("string")))
    return kept.withColumn("file", F.concat(F.lit("images/"), name, F.lit(".png"))).groupBy(*KEY, "file").agg(F.max_by("ord", F.struct("step", "ord")).alias("ord"))


def page_stats(pictures: DataFrame) -> DataFrame:
    ok, has = F.col("saveable"), F.col("caption_number").isNotNull()
    return saveable(pictures).groupBy(*KEY).agg(F.count_if(ok).alias("n_valid"), F.count_if(ok & has).alias("n_resolved"), F.count_if(ok & ~has).alias("n_unresolved"), F.count_if(~ok).alias("n_discarded"))
