"""Heading levels, and headings met with the layout's boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from ..functions import text as T
from ..functions.frames import with_once
from ..sources import files

MAX_LEVEL = 5


def weak_levels(blocks: DataFrame, delta: int = -1) -> DataFrame:
    """Paragraphs that are nothing but bold become headings of the level of the last
    strong heading plus ``delta``, or 1 if none came before."""
    before = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    level = F.col("level").try_cast("int")
    last = F.last(F.when(F.col("type") == "heading", F.struct(level.alias("v"))), ignorenulls=True).over(before)
    weak = (F.col("type") == "paragraph") & F.coalesce(T.standalone_bold(F.col("content")) != "", F.lit(False))
    df = blocks.withColumns({"__w": weak, "__l": F.coalesce(last["v"] + delta, F.lit(1))})
    return df.withColumns({
        "type": F.when(F.col("__w"), "heading").otherwise(F.col("type")),
        "level": F.when(F.col("__w"), F.col("__l")).otherwise(F.col("level")),
        "content": F.when(F.col("__w"), T.standalone_bold(F.col("content"))).otherwise(F.col("content")),
        "converted_from": F.when(F.col("__w"), "paragraph"),
    }).drop("__w", "__l")


def page_reset_levels(blocks: DataFrame, section: str = "section", max_level: int = MAX_LEVEL, skip_section_title: bool = True, reset_on_page: bool = True) -> DataFrame:
    """Levels of strong and weak headings in each section, by a state machine that
    starts anew on each page: doc_id, section, pos, assigned_level, reported_level,
    is_title.  Rows that are no headings have no level; the section's own title is
    left out if ``skip_section_title``.

    Levels depend on what was assigned before, so this is a fold over a section's
    headings (an aggregate in the JVM).
    """
    weak = (F.col("type") == "paragraph") & F.coalesce(T.bold_lead(F.col("content")) != "", F.lit(False))
    strong = F.col("type") == "heading"
    norm, title = T.normalize(F.col("content")), T.normalize(F.col(section))
    # A page change resets before any block, so every block takes part in the fold.
    item = F.struct("pos", "page", strong.alias("strong"), weak.alias("weak"), F.when(strong, F.col("level").try_cast("int")).alias("v"), (strong & (norm == title) & (norm != "")).alias("title"), (strong & (norm == title)).alias("skip"))
    rows = blocks.groupBy("doc_id", section).agg(F.array_sort(F.collect_list(item)).alias("s"))
    kind = "struct<anchored:boolean,cur:int,verb:int,page:int,weak:boolean,last:int,seen:boolean,out:array<struct<pos:int,level:int,skip:boolean>>>"
    null = F.lit(None).cast("int")

    def state(anchored, cur, verb, page, was_weak, last, seen, out) -> Column:
        named = zip(("anchored", "cur", "verb", "page", "weak", "last", "seen", "out"), (anchored, cur, verb, page, was_weak, last, seen, out), strict=True)
        return F.struct(*[x.alias(n) for n, x in named]).cast(kind)

    yes, no = F.lit(True), F.lit(False)

    def on_page(a: Column, x: Column) -> Column:
        if not reset_on_page:
            return a
        moved = a["seen"] & ~a["page"].eqNullSafe(x["page"])
        keep = a["weak"] & a["last"].isNotNull()
        fresh = state(no, F.when(keep, a["last"]).otherwise(F.lit(1)), null, x["page"], keep, a["last"], yes, a["out"])
        first = state(a["anchored"], a["cur"], a["verb"], x["page"], a["weak"], a["last"], yes, a["out"])
        return F.when(~a["seen"], first).when(moved, fresh).otherwise(a)

    def put(a: Column, x: Column, level: Column, anchored: Column, cur: Column, verb: Column, was_weak: Column) -> Column:
        out = F.concat(a["out"], F.array(F.struct(x["pos"].alias("pos"), level.cast("int").alias("level"), x["skip"].alias("skip"))))
        return state(anchored, cur.cast("int"), verb, a["page"], was_weak, level.cast("int"), a["seen"], out)

    def step(a0: Column, x: Column) -> Column:
        def act(a: Column) -> Column:
            v = x["v"]
            p = F.when(v == 1, 2).otherwise(v)
            after_weak = F.when(a["weak"], a["cur"]).otherwise(F.least(F.coalesce(a["last"], a["cur"]) + 1, F.lit(max_level)))
            first = F.when(p.isNull(), 2).otherwise(F.greatest(p, F.lit(2)))
            stay = F.least(F.greatest(a["cur"], F.lit(2)), F.lit(max_level))
            move = F.least(F.greatest(a["cur"] + p - a["verb"], F.lit(2)), F.lit(max_level))
            return (
                F.when(~x["strong"] & ~x["weak"], a)
                .when(x["weak"], put(a, x, after_weak, a["anchored"], after_weak, a["verb"], yes))
                .when(x["title"], put(a, x, F.lit(1), yes, F.lit(1), v, no))
                .when(~a["anchored"], put(a, x, first, yes, first, p, no))
                .when(v.isNull() | a["verb"].isNull(), put(a, x, stay, yes, stay, a["verb"], no))
                .otherwise(put(a, x, move, yes, move, p, no))
            )

        return F.transform(F.array(on_page(a0, x)), act)[0]

    start = state(no, F.lit(1), null, null, no, null, no, F.array())
    levels = rows.select("doc_id", section, F.explode(F.aggregate("s", start, step, lambda a: a["out"])).alias("x")).select("doc_id", section, "x.pos", F.col("x.level").alias("assigned_level"), F.col("x.skip").alias("__skip"))
    out = blocks.join(levels, ["doc_id", section, "pos"], "left")
    if skip_section_title:
        out = out.where(~F.coalesce("__skip", F.lit(False)))
    made = F.col("assigned_level").isNotNull()
    return out.withColumns({
        "reported_level": F.when(made & (F.col("type") == "heading"), F.col("level")),
        "converted_from": F.when(made & (F.col("type") == "paragraph"), "paragraph"),
        "type": F.when(made, "heading").otherwise(F.col("type")),
    }).drop("__skip", "level")


def layout_order(layout: DataFrame) -> DataFrame:
    """Section headers of the layout in reading order: doc_id, ord, page, norm, bbox."""
    place = Window.partitionBy("doc_id").orderBy("page", -F.coalesce("bbox.t", F.lit(0.0)), "text_ord")
    heads = layout.where("label = 'section_header'")
    return heads.withColumn("ord", F.row_number().over(place)).select("doc_id", "ord", F.col("page").alias("layout_page"), T.normalize(F.col("text")).alias("norm"), "bbox")


def match_boxes(headings: DataFrame, layout: DataFrame) -> DataFrame:
    """``headings`` (doc_id, pos, page, content) with bbox and bbox_page: equal text,
    the same page before others, else the first in reading order."""
    key = with_once(headings, {"norm": T.normalize(F.col("content"))})
    met = key.join(layout, ["doc_id", "norm"], "left")
    best = met.groupBy("doc_id", "pos").agg(F.min_by(F.struct("bbox", "layout_page"), F.struct((F.col("layout_page") != F.col("page")).alias("far"), "ord")).alias("x"))
    return headings.join(best, ["doc_id", "pos"]).withColumns({"bbox": F.col("x.bbox"), "bbox_page": F.col("x.layout_page")}).drop("x")


def earliest_boxes(layout: DataFrame) -> DataFrame:
    """First appearance of every heading text: doc_id, norm, bbox, layout_page."""
    return layout.groupBy("doc_id", "norm").agg(F.min_by(F.struct("bbox", "layout_page"), "ord").alias("x")).select("doc_id", "norm", "x.bbox", "x.layout_page")


def section_ends(headings: DataFrame, layout: DataFrame, widths: DataFrame) -> DataFrame:
    """End box and page of every heading of a chapter.

    ``headings``: doc_id, chapter_ord, pos, page, content, bbox, bbox_page.  The end
    is the next heading of the chapter; for its last, the first heading of the next
    chapter (where its text appears first in the layout, else its own match); for the
    last of all, the foot of its page.  ``widths``: doc_id, page, width.
    """
    chapter = Window.partitionBy("doc_id", "chapter_ord").orderBy("pos")
    df = headings.withColumn("__next", F.lead(F.struct(F.col("bbox"), F.col("page").cast("int").alias("page"))).over(chapter))
    firsts = headings.withColumn("__n", F.row_number().over(chapter)).where("__n = 1").withColumn("norm", T.normalize(F.col("content")))
    early = earliest_boxes(layout).select("doc_id", "norm", F.struct(F.col("bbox"), F.col("layout_page").cast("int").alias("page")).alias("__early"))
    peek = firsts.join(early, ["doc_id", "norm"], "left").select("doc_id", F.col("chapter_ord"), F.coalesce("__early", F.struct(F.col("bbox"), F.col("page").cast("int").alias("page"))).alias("__peek"))
    order = Window.partitionBy("doc_id").orderBy("chapter_ord")
    after = peek.select("doc_id", "chapter_ord", F.lead("__peek").over(order).alias("__after"))
    df = df.join(after, ["doc_id", "chapter_ord"], "left").join(widths.withColumnRenamed("width", "__w"), ["doc_id", "page"], "left")
    foot = F.struct(G.page_bottom(F.col("__w")).alias("bbox"), F.col("page").cast("int").alias("page"))
    end = F.coalesce("__next", "__after", foot)
    return df.withColumns({"section_end_bbox": end["bbox"], "section_end_page": end["page"]}).drop("__next", "__after", "__w")


def first_heading_check(headings: DataFrame) -> DataFrame:
    """doc_id, chapter, heading_matches: does one of the first three words of a
    chapter's first heading name the chapter or its section?

    ``headings``: doc_id, chapter, section, pos, content.
    """
    words = lambda c: F.filter(F.split(T.normalize(c), " "), lambda w: w != "")
    first = headings.groupBy("doc_id", "chapter").agg(F.min_by(F.struct("content", "section"), "pos").alias("x"))
    known = F.array_union(words(F.col("chapter")), words(F.coalesce(F.col("x.section"), F.lit(""))))
    return first.select("doc_id", "chapter", F.arrays_overlap(F.slice(words(F.col("x.content")), 1, 3), known).alias("heading_matches"))


def chapters_without_headings(blocks: DataFrame) -> DataFrame:
    """doc_id, chapter, error for chapters that hold no heading: an error row each,
    where others go on."""
    return blocks.groupBy("doc_id", "chapter").agg(F.max(F.col("type") == "heading").alias("has")).where("not has").select("doc_id", "chapter", F.lit("no headings").alias("error"))


def requested_chapters(chapters: DataFrame, blocks: DataFrame, names: list[str]) -> DataFrame:
    """doc_id, requested, stem, n_headings, error: what becomes of every chapter asked
    for in every document.

    ``chapters``: doc_id, stem of the files that exist; ``blocks``: doc_id, stem, type.
    A name stands for the first stem that contains it.  A name without a file is one row
    with an error, and so is a file without headings; the others go on.
    """
    found = files.find_by_keyword(chapters, "stem", names).select("doc_id", F.col("keyword").alias("requested"), F.col("found").alias("stem"))
    counts = blocks.groupBy("doc_id", "stem").agg(F.count_if(F.col("type") == "heading").alias("n_headings"))
    n = F.coalesce("n_headings", F.lit(0))
    error = F.when(F.col("stem").isNull(), "no chapter file").when(n == 0, "no headings")
    return found.join(counts, ["doc_id", "stem"], "left").select("doc_id", "requested", "stem", n.alias("n_headings"), error.alias("error"))
