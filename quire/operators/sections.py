"""Article sections: where they start, and the blocks of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..functions.frames import with_once

# Sections in their order, and the words that name them.
ORDER = {"abstract": 0, "introduction": 1, "methods": 2, "results": 3, "discussion": 4, "conclusion": 5, "references": 6}
WORDS = {"methods": ["method", "methods", "methodology"], "results": ["result", "results"], "discussion": ["discussion"], "conclusion": ["conclusion", "conclusions"], "references": ["references", "bibliography"]}
ABSTRACT_LEADS = ["abstract", "purpose", "background", "objective", "objectives", "study design", "materials and methods", "methods", "results", "conclusion", "conclusions"]
KEYWORD_LEADS = ["key words", "keywords"]


def section_of(kind: Column, page: Column, level: Column, content: Column, abstract: Column) -> Column:
    """Section that a block starts, or null.  ``abstract`` is struct(page, level) of
    the document's first abstract heading, or null."""
    norm = T.normalize(content)
    under = abstract.isNotNull() & page.eqNullSafe(abstract["page"]) & (F.coalesce(level, F.lit(0)) > F.coalesce(abstract["level"], F.lit(0))) & (norm != "abstract")
    named = F.when(norm == "abstract", "abstract").when(norm.isin("intro", "introduction"), "introduction")
    for section, words in WORDS.items():
        named = named.when(T.has_leading_word(norm, words), section)
    lead = T.normalize(T.bold_lead(content))
    said = F.when(lead.isin(*ABSTRACT_LEADS), "abstract").when(lead.isin(*KEYWORD_LEADS), "introduction")
    return F.when(T.is_blank(content), F.lit(None)).when(kind == "heading", F.when(~under, named)).when((kind == "paragraph") & (page == 1), said)


def with_abstract(blocks: DataFrame) -> DataFrame:
    """Add ``abstract``: struct(page, level) of the first abstract heading."""
    here = (F.col("type") == "heading") & (T.normalize(F.col("content")) == "abstract")
    meta = F.struct("page", F.coalesce("level", F.lit(0)).alias("level"))
    return blocks.withColumn("abstract", F.min_by(F.when(here, meta), F.when(here, F.col("pos"))).over(Window.partitionBy("doc_id")))


def explicit_starts(blocks: DataFrame) -> DataFrame:
    """doc_id, pos, section of blocks that start a section by their own words."""
    found = with_once(with_abstract(blocks), {"section": section_of(F.col("type"), F.col("page"), F.col("level"), F.col("content"), F.col("abstract"))})
    return found.where("section is not null").select("doc_id", "pos", "section")


def candidate_starts(blocks: DataFrame) -> DataFrame:
    """Explicit starts and those that stand in for missing front sections
    (``injected``): doc_id, pos, section, injected."""
    found = with_once(with_abstract(blocks), {"section": section_of(F.col("type"), F.col("page"), F.col("level"), F.col("content"), F.col("abstract"))})
    first = lambda s: F.min(F.when(F.col("section") == s, F.col("pos")))
    facts = found.groupBy("doc_id").agg(
        first("abstract").alias("a"), first("introduction").alias("i"), first("methods").alias("m"), F.count("section").alias("n"),
        F.min(F.when(F.col("page") == 1, F.col("pos"))).alias("p1"), F.min(F.when(F.col("page") > 1, F.col("pos"))).alias("p2"),
    )
    none = F.col("a").isNull() & F.col("i").isNull()
    start = lambda when, pos, name: F.when(when, F.struct(pos.cast("int").alias("pos"), F.lit(name).alias("section")))
    nothing = (F.col("n") == 0) & F.col("p1").isNull()
    added = F.array(
        start(none & F.col("p1").isNotNull(), F.col("p1"), "abstract"),
        start(none & (F.col("p2") < F.col("m")), F.col("p2"), "introduction"),
        start(F.col("a").isNotNull() & F.col("i").isNull() & (F.col("a") + 1 < F.col("m")), F.col("a") + 1, "introduction"),
        start(nothing, F.lit(0), "introduction"),
    )
    extra = facts.select("doc_id", F.explode(F.filter(added, lambda x: x.isNotNull())).alias("x")).select("doc_id", "x.pos", "x.section", F.lit(1).alias("injected"))
    return found.where("section is not null").select("doc_id", "pos", "section", F.lit(0).alias("injected")).unionByName(extra)


def section_starts(blocks: DataFrame) -> DataFrame:
    """doc_id, section_ord, section, start_pos: the accepted starts.

    Of starts at one block the first counts.  In order, a start is dropped if its
    section was accepted before, or if it comes late in an article (results or
    after) while the last accepted one comes before methods.
    """
    names = F.create_map(*[x for k, v in ORDER.items() for x in (F.lit(k), F.lit(v))])
    once = candidate_starts(blocks).groupBy("doc_id", "pos").agg(F.min_by("section", "injected").alias("section"))
    starts = once.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "section", names[F.col("section")].alias("rank")))).alias("s"))
    kind = "struct<last:int,kept:array<struct<pos:int,section:string>>>"

    def step(a: Column, x: Column) -> Column:
        seen = F.exists(a["kept"], lambda k: k["section"] == x["section"])
        early = (x["rank"] >= ORDER["results"]) & (a["last"] < ORDER["methods"])
        taken = F.struct(x["rank"].alias("last"), F.concat(a["kept"], F.array(F.struct(x["pos"].alias("pos"), x["section"].alias("section")))).alias("kept"))
        return F.when(seen | early, a).otherwise(taken.cast(kind))

    start = F.struct(F.lit(-1).alias("last"), F.array().alias("kept")).cast(kind)
    kept = F.aggregate("s", start, step, lambda a: a["kept"])
    return starts.select("doc_id", F.posexplode(kept).alias("section_ord", "x")).select("doc_id", "section_ord", "x.section", F.col("x.pos").alias("start_pos"))


def split_sections(blocks: DataFrame) -> DataFrame:
    """``blocks`` with section_ord and section; what precedes the first start is
    dropped.  Starts are at most seven to a document; they join on document."""
    marks = section_starts(blocks).withColumnRenamed("start_pos", "pos")
    here = blocks.join(marks, ["doc_id", "pos"], "left")
    upto = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    filled = here.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in ("section_ord", "section")})
    return filled.where("section is not null").select(*blocks.columns, "section_ord", "section")


def document_title(blocks: DataFrame, fallback: str) -> DataFrame:
    """doc_id, title: the first title block with text, else column ``fallback``."""
    here = (F.col("type") == "title") & ~T.is_blank(F.col("content"))
    return blocks.groupBy("doc_id").agg(F.coalesce(T.strip(F.min_by(F.when(here, F.col("content")), F.when(here, F.col("pos")))), F.min(F.col(fallback).cast("string"))).alias("title"))
