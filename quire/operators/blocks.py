"""Markdown pages to an ordered relation of typed blocks.

Pages are rows (doc_id, page, text); blocks are rows (doc_id, pos, page, type,
level, content).  ``pos`` is dense and 0-based in a document: order is always a
column.  A page's lines are scanned in one fold over its array of lines, so the only
shuffle is the one that numbers blocks by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..functions.frames import keyed, spread

_HTML = r"(?U)^[\s\x1c-\x1f]*<([a-zA-Z][a-zA-Z0-9]*)\b[^>]*>"
_HEADING = r"(?dU)^(#{1,6})\s+(.*)\z"
_LIST = (r"(?dU)^[-+*]\s+.+\z", r"(?dU)^\d+[.)]\s+.+\z")
_STATE = "struct<tag:string,held:array<string>,out:array<struct<html:boolean,text:string>>>"


def is_html_start(line: Column) -> Column:
    return line.rlike(_HTML)


def is_list_line(line: Column) -> Column:
    s = T.lstrip(line)
    return s.rlike(_LIST[0]) | s.rlike(_LIST[1])


def scan_lines(lines: Column) -> Column:
    """array<struct(html, text)>: the page's raw blocks in order.

    A blank line ends a block; an unindented line starts one; markup runs to the
    line with its closing tag, or to the end of the page.
    """

    def state(tag: Column, held: Column, out: Column) -> Column:
        return F.struct(tag.alias("tag"), held.alias("held"), out.alias("out")).cast(_STATE)

    none = F.array().cast("array<string>")
    null = F.lit(None).cast("string")

    def emit(html: bool, text: Column) -> Column:
        return F.array(F.struct(F.lit(html).alias("html"), text.alias("text")))

    def flushed(a: Column) -> Column:
        """``out`` with the held lines as a block, unless they are blank."""
        text = T.strip(F.array_join(a["held"], "\n"))
        return F.when(text == "", a["out"]).otherwise(F.concat(a["out"], emit(False, text)))

    def step(a: Column, line: Column) -> Column:
        tag = F.lower(F.regexp_extract(line, _HTML, 1))
        closes = line.rlike(r"(?U)/>[\s\x1c-\x1f]*\z") | F.lower(line).contains(F.concat(F.lit("</"), tag, F.lit(">")))
        inside = F.concat(a["held"], F.array(line))
        ended = F.lower(line).contains(F.concat(F.lit("</"), a["tag"], F.lit(">")))
        return (
            F.when(a["tag"].isNotNull() & ended, state(null, none, F.concat(a["out"], emit(True, F.array_join(inside, "\n")))))
            .when(a["tag"].isNotNull(), state(a["tag"], inside, a["out"]))
            .when(T.is_blank(line), state(null, none, flushed(a)))
            .when(is_html_start(line) & closes, state(null, none, F.concat(flushed(a), emit(True, line))))
            .when(is_html_start(line), state(tag, F.array(line), flushed(a)))
            .when((F.size(a["held"]) > 0) & line.rlike(r"(?U)^[^\s\x1c-\x1f]"), state(null, F.array(line), flushed(a)))
            .otherwise(state(null, inside, a["out"]))
        )

    def finish(a: Column) -> Column:
        open_html = F.concat(a["out"], emit(True, F.array_join(a["held"], "\n")))
        return F.when(a["tag"].isNotNull(), open_html).otherwise(flushed(a))

    start = state(null, none, F.array())
    return F.aggregate(lines, start, step, finish)


def classify(block: Column) -> Column:
    """struct(type, level, content) of a raw block, null if it has no line."""

    def typed(text: Column, lines: Column, first: Column) -> Column:
        low = F.lower(first)
        heading = (F.size(lines) == 1) & first.rlike(_HEADING)
        kind = (
            F.when(heading, "heading").when(low.startswith("<figure"), "figure").when(low.startswith("<table"), "table")
            .when(is_html_start(first), "html").when(F.forall(lines, is_list_line), "list").otherwise("paragraph")
        )
        level = F.when(heading, F.length(F.regexp_extract(first, _HEADING, 1)))
        content = F.when(heading, F.regexp_extract(first, _HEADING, 2)).otherwise(text)
        return F.when(F.size(lines) > 0, F.struct(kind.alias("type"), level.alias("level"), content.alias("content")))

    full = lambda text: F.filter(T.split_lines(text), lambda x: ~T.is_blank(x))
    return T.let(block, lambda text: T.let(full(text), lambda lines: T.let(T.strip(F.try_element_at(lines, F.lit(1))), lambda first: typed(text, lines, first))))


def parse_pages(pages: DataFrame) -> DataFrame:
    """Blocks of all documents.  Null and empty pages have none."""
    raw = pages.where("text is not null").select("doc_id", "page", F.posexplode(scan_lines(T.split_lines(F.col("text")))).alias("ord", "raw"))
    return number_blocks(spread(raw, ["doc_id", "page", "ord"], classify(F.col("raw.text"))), "page", "ord")


def number_blocks(df: DataFrame, *order: str) -> DataFrame:
    """Dense 0-based ``pos`` by document; columns used for the order are dropped
    but for page."""
    place = Window.partitionBy("doc_id").orderBy(*order)
    out = keyed(df, "doc_id").withColumn("pos", (F.row_number().over(place) - 1).cast("int"))
    rest = [c for c in df.columns if c not in ("doc_id", "pos", "page", *[o for o in order if o != "page"])]
    return out.select("doc_id", "pos", "page", *rest)


def promote_title(blocks: DataFrame, least_words: int = 3) -> DataFrame:
    """The first level-1 heading of three words or more becomes the document's title
    and moves to the front of its page."""
    every = Window.partitionBy("doc_id")
    fits = (F.col("type") == "heading") & (F.col("level") == 1) & (T.word_count(F.col("content")) >= least_words)
    df = blocks.withColumn("__t", F.min(F.when(fits, F.col("pos"))).over(every))
    df = df.withColumn("__is", F.coalesce(F.col("pos") == F.col("__t"), F.lit(False)))
    df = df.withColumns({"type": F.when(F.col("__is"), "title").otherwise(F.col("type")), "level": F.when(~F.col("__is"), F.col("level")), "__last": (~F.col("__is")).cast("int"), "__pos": F.col("pos")})
    return number_blocks(df.drop("__t", "__is", "pos"), "page", "__last", "__pos")


def word_count(block: Column) -> Column:
    return T.word_count(block)
