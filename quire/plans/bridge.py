"""Views of the driver's tables as papers, pages, lines, blocks and boxes.

The tables hold no paper markup, so lines of ``documents`` are dressed by arithmetic
on their place.  Expressions that both engines read alike are shared as text; the
rest is written twice, for Spark and (as CTEs) for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocks as B
from ..functions import text as T
from ..functions.frames import dealt, spread

_N = "CAST((d + n) % 5 + 1 AS STRING)"
#: d: doc_id, n: line number, raw: the line.
DRESS = f"""CASE (d * 7 + n * 3) % 31
 WHEN 0 THEN concat('## ', CASE (d + n) % 7 WHEN 0 THEN 'Abstract' WHEN 1 THEN 'Introduction' WHEN 2 THEN 'Materials and Methods' WHEN 3 THEN 'Results' WHEN 4 THEN '4 Discussion' WHEN 5 THEN 'Conclusions' ELSE 'References' END)
 WHEN 1 THEN concat('### ', substr(raw, 1, 30))
 WHEN 2 THEN concat('**', CASE (d + n) % 4 WHEN 0 THEN 'Purpose' WHEN 1 THEN 'Key words' ELSE substr(raw, 1, 12) END, '.** ', raw)
 WHEN 3 THEN concat('**', substr(raw, 1, 20), '**')
 WHEN 4 THEN concat('- ', raw)
 WHEN 5 THEN concat('<figure><img src="a.png" alt=" A &amp; ', substr(raw, 1, 8), '"><figcaption>Figure ', {_N}, '. <i>', substr(raw, 1, 30), '</i></figcaption></figure>')
 WHEN 6 THEN concat('<table><caption>Table ', {_N}, ' ', substr(raw, 1, 30), '</caption></table>')
 WHEN 7 THEN concat('Figure ', {_N}, ': ', raw)
 WHEN 8 THEN '<figure><img src="b.png"></figure>'
 WHEN 9 THEN concat('Copyright 2020 ', raw)
 WHEN 10 THEN regexp_replace(raw, '[.]+$', '')
 WHEN 11 THEN lower(raw)
 WHEN 12 THEN 'Spine Journal 2020'
 WHEN 13 THEN 'www.example.org'
 WHEN 14 THEN '-----'
 WHEN 15 THEN '12 Smith et al'
 WHEN 16 THEN '<figure>silicon logo</figure>'
 WHEN 17 THEN concat('# ', substr(raw, 1, 40))
 WHEN 18 THEN concat('#### ', substr(raw, 1, 15))
 WHEN 19 THEN '![x](y.png) [link](u) snake_case __z__'
 WHEN 20 THEN concat('Table ', {_N}, ' ', raw)
 WHEN 21 THEN '<table></table>'
 WHEN 22 THEN regexp_replace(raw, '[.]+$', '-')
 WHEN 23 THEN '<div>'
 WHEN 24 THEN concat(raw, ' </div>')
 WHEN 25 THEN concat('  ', raw)
 WHEN 26 THEN ''
 WHEN 27 THEN lower(regexp_replace(raw, '[.]+$', ''))
 ELSE raw END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return dealt(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """paper, page, n (line number from 0), line."""
    docs = table(spark, sf_dir, "documents").where("text is not null").select(F.col("doc_id").alias("d"), F.posexplode(F.split("text", "\n")).alias("n", "raw"))
    return docs.select((F.expr("d div 10")).alias("doc_id"), (F.col("d") % 10 + 1).cast("int").alias("page"), "n", F.expr(DRESS).alias("line"))


SQL_LINES = f"""
raw_lines AS (
    SELECT doc_id AS d, unnest(string_split(text, chr(10))) AS raw, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS n FROM documents WHERE text IS NOT NULL
), lines AS (
    SELECT d // 10 AS doc_id, CAST(d % 10 + 1 AS INTEGER) AS page, n, {DRESS} AS line FROM raw_lines
)"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, page, text: dressed pages."""
    grouped = lines(spark, sf_dir).groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("s"))
    return grouped.select("doc_id", "page", F.array_join(F.transform("s", lambda x: x["line"]), "\n").alias("text"))


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of one line each: doc_id, pos, page, type, level, content."""
    return B.number_blocks(spread(lines(spark, sf_dir), ["doc_id", "page", "n"], B.classify(T.strip(F.col("line")))), "page", "n")


# ---- the same in SQL -------------------------------------------------------------


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def strip_md(x: str) -> str:
    x = rf"regexp_replace({x}, '!\[.*?\]\(.*?\)', ' ', 'g')"
    x = rf"regexp_replace({x}, '\[([^\]]+)\]\([^)]+\)', '\1', 'g')"
    return strip(rf"regexp_replace(translate({x}, '*_', ''), '\s+', ' ', 'g')")


def normalize(x: str) -> str:
    return f"trim(regexp_replace(lower({strip_md(x)}), '[^a-z0-9]+', ' ', 'g'))"


def word_count(plain: str) -> str:
    """Words of a text that is stripped of marks already."""
    return rf"len(list_filter(regexp_split_to_array({plain}, '[^\p{{L}}\p{{N}}_]+'), lambda w: w <> ''))"


def first_group(x: str, pattern: str, flags: str = "", index: int = 1) -> str:
    return f"CASE WHEN regexp_matches({x}, '{pattern}', '{flags or 'c'}') THEN regexp_extract({x}, '{pattern}', {index}, '{flags or 'c'}') END"


def number(x: str, pattern: str, flags: str = "i") -> str:
    return f"TRY_CAST(nullif(regexp_extract({x}, '{pattern}', 1, '{flags}'), '') AS INTEGER)"


# Caption patterns, and below the phrases of noise and clutter, as in the operators.
FIGURE = r"^\s*(?:fig(?:ure)?)\.?\s*[:.]?\s*([0-9]+)\b"
TABLE = r"^\s*table\s+([0-9]+)\b"

SQL_BLOCKS = rf"""{SQL_LINES}, typed AS (
    SELECT doc_id, page, n, s,
        regexp_matches(s, '^(#{{1,6}})\s+(.*)$') AS is_heading,
        CASE WHEN regexp_matches(s, '^(#{{1,6}})\s+(.*)$') THEN 'heading' WHEN starts_with(lower(s), '<figure') THEN 'figure' WHEN starts_with(lower(s), '<table') THEN 'table'
             WHEN regexp_matches(s, '^\s*<([a-zA-Z][a-zA-Z0-9]*)\b[^>]*>') THEN 'html'
             WHEN regexp_matches(s, '^[-+*]\s+.+$') OR regexp_matches(s, '^\d+[.)]\s+.+$') THEN 'list' ELSE 'paragraph' END AS type
    FROM (SELECT doc_id, page, n, {strip("line")} AS s FROM lines) WHERE s <> ''
), blocks AS (
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page, n) - 1 AS INTEGER) AS pos, page, type,
        CAST(CASE WHEN is_heading THEN length(regexp_extract(s, '^(#{{1,6}})\s+', 1)) END AS INTEGER) AS level,
        CASE WHEN is_heading THEN regexp_extract(s, '^(#{{1,6}})\s+(.*)$', 2) ELSE s END AS content
    FROM typed
)"""


def noise(plain: str) -> str:
    return rf"""({plain} = '' OR regexp_full_match({plain}, '[*•·\-_=]{{3,}}') OR (length({plain}) >= 2 AND replace({plain}, {plain}[1], '') = '')
        OR ((contains(lower({plain}), 'www.') OR contains(lower({plain}), 'http://') OR contains(lower({plain}), 'https://')) AND length({plain}) < 30)
        OR (regexp_matches(lower({plain}), '\.com|\.org|\.edu|\.cn|\.gov') AND length({plain}) < 10)
        OR contains(lower({plain}), 'copyright') OR contains(lower({plain}), 'all rights reserved') OR starts_with({plain}, '©')
        OR lower({plain}) IN ('spine', 'spine deformity', 'global spine journal', 'springer'))"""


#: Blocks with their stripped text and number of words.
SQL_PLAIN = rf"""{SQL_BLOCKS}, plain0 AS (SELECT *, {strip_md("content")} AS plain FROM blocks), plain AS (SELECT *, {word_count("plain")} AS words FROM plain0)"""

SQL_CLEAN = rf"""{SQL_PLAIN}, kept1 AS (
    SELECT * FROM plain WHERE NOT (page = 1 AND type = 'paragraph' AND plain <> '' AND (lower(plain) IN ('original article', 'review article', 'case report', 'editorial', 'letter to the editor', 'global spine journal', 'spine deformity', 'spine')
        OR regexp_matches(plain, '^\d{{4}},?\s*vol\.?\s*\d+\(?\d+\)?\s+\d+[–-]\d+$', 'i') OR regexp_matches(plain, '^©\s*the author\(s\)\s*\d{{4}}$', 'i')
        OR (contains(lower(plain), 'creative commons') AND contains(lower(plain), 'license')) OR {noise("plain")}))
), edges AS (
    SELECT *, (row_number() OVER up <= 3 AND sum(CASE WHEN type = 'paragraph' THEN 0 ELSE 1 END) OVER up = 0)
           OR (row_number() OVER down <= 3 AND sum(CASE WHEN type = 'paragraph' THEN 0 ELSE 1 END) OVER down = 0) AS edge
    FROM kept1 WINDOW up AS (PARTITION BY doc_id, page ORDER BY pos ROWS UNBOUNDED PRECEDING), down AS (PARTITION BY doc_id, page ORDER BY pos DESC ROWS UNBOUNDED PRECEDING)
), kept2 AS (
    SELECT * FROM edges WHERE NOT (edge AND words < 10 AND ({noise("plain")}
        OR (regexp_matches(plain, '\d') AND list_contains(regexp_split_to_array(lower(plain), '[^\p{{L}}\p{{N}}_]+'), 'journal'))
        OR (regexp_matches(plain, '^\d+([^\p{{L}}\p{{N}}_]|$)') AND len(regexp_split_to_array(plain, '\s+')) <= 8)
        OR regexp_matches(plain, '^[A-Z][a-z]+\s+et\s+al\.?\s+\d+$')))
)"""

SQL_MERGED = rf"""{SQL_CLEAN}, kept3 AS (
    SELECT * FROM kept2 WHERE NOT (type = 'paragraph' AND {noise("plain")})
        AND NOT (type = 'figure' AND NOT contains(lower(content), '<figcaption') AND (contains(lower(content), 'logo') OR contains(lower(content), 'creative commons') OR contains(lower(content), 'icon')))
), simple AS (
    SELECT *, type = 'paragraph' AND NOT starts_with(ltrim(content), '*') AS s,
        words > 10 AND CASE WHEN regexp_matches(content, '[-,]$') THEN true WHEN regexp_matches(content, '[.!?]$') THEN false ELSE words > 3 END AS e,
        words > 10 AND regexp_matches(content, '^\s*\p{{Ll}}') AS b
    FROM kept3
), linked AS (
    SELECT *, s AND e AND coalesce(lead(b) OVER w, false) AS link, lead(content) OVER w AS nxt FROM simple WINDOW w AS (PARTITION BY doc_id, s ORDER BY page, pos)
), isles AS (
    SELECT *, sum(CASE WHEN link THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, s ORDER BY page, pos ROWS UNBOUNDED PRECEDING) AS isle FROM linked
), fired AS (
    SELECT *, link AND sum(CASE WHEN link THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, s, isle ORDER BY page, pos ROWS UNBOUNDED PRECEDING) % 2 = 1 AS fires FROM isles
), merged AS (
    SELECT doc_id, pos, page, type, level,
        CASE WHEN fires THEN CASE WHEN ends_with(content, '-') THEN left(content, -1) || nxt ELSE content || ' ' || nxt END ELSE content END AS content
    FROM (SELECT *, coalesce(lag(fires) OVER (PARTITION BY doc_id, s ORDER BY page, pos), false) AS gone FROM fired) WHERE NOT gone
)"""


# ---- boxes -----------------------------------------------------------------------

#: k: an id; integer-valued sides, so that both engines agree to the last bit.
_J = "(k - CASE WHEN k % 6 = 1 THEN 1 ELSE 0 END)"  # every sixth box is a panel beside the one before
_W = f"(20 + ({_J} * 53) % 260)"
_BOX = {"l": f"({_J} * 37) % 400 + CASE WHEN k % 6 = 1 THEN {_W} + 5 ELSE 0 END", "w": _W, "b": f"({_J} * 91) % 500", "h": f"15 + ({_J} * 29) % 280"}


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, page, ord, bbox, width, height, caption_number, kind (by id)."""
    k = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"))
    x = {n: F.expr(e).cast("double") for n, e in _BOX.items()}
    bbox = F.struct(x["l"].alias("l"), (x["b"] + x["h"]).alias("t"), (x["l"] + x["w"]).alias("r"), x["b"].alias("b"))
    return k.select(F.expr("k div 24").alias("doc_id"), F.expr("cast((k div 12) % 2 + 1 as int)").alias("page"), F.expr("cast(k % 12 as int)").alias("ord"), bbox.alias("bbox"), F.expr("cast(100 + (k * 17) % 300 as int)").alias("width"), F.expr("cast(120 + (k * 31) % 300 as int)").alias("height"), F.expr("cast(if(k % 3 = 0, k % 4 + 1, null) as int)").alias("number"), F.expr("k % 12 >= 8").alias("is_caption"))


SQL_BOXES = f"""
box0 AS (SELECT doc_id AS k, CAST({_BOX["l"]} AS DOUBLE) AS l, CAST({_BOX["w"]} AS DOUBLE) AS w, CAST({_BOX["b"]} AS DOUBLE) AS b, CAST({_BOX["h"]} AS DOUBLE) AS h FROM documents),
boxes AS (SELECT k // 24 AS doc_id, CAST((k // 12) % 2 + 1 AS INTEGER) AS page, CAST(k % 12 AS INTEGER) AS ord, l, b + h AS t, l + w AS r, b,
    CAST(100 + (k * 17) % 300 AS INTEGER) AS width, CAST(120 + (k * 31) % 300 AS INTEGER) AS height, CASE WHEN k % 3 = 0 THEN CAST(k % 4 + 1 AS INTEGER) END AS number, k % 12 >= 8 AS is_caption FROM box0)"""


def pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes(spark, sf_dir).where("not is_caption").select("doc_id", "page", "ord", "bbox", "width", "height", F.col("number").alias("caption_number"), F.when(F.col("number").isNotNull(), F.concat(F.lit("Figure "), F.col("number").cast("string"))).alias("caption_text"))


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("ord") % 4 + 1
    return boxes(spark, sf_dir).where("is_caption").select("doc_id", "page", "ord", n.alias("number"), F.concat(F.lit("Figure "), n.cast("string")).alias("text"), "bbox")


def recall_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text against itself with each third word gone."""
    words = F.split("text", " ")
    kept = F.array_join(F.transform(words, lambda w, i: F.when(i % 3 == 1, F.lit("x")).otherwise(w)), " ")
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("digital_text"), kept.alias("extracted_text"))


def talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as sections of blocks: doc_id, section, pos, type, level, content, tok."""
    c = table(spark, sf_dir, "conversations")
    kind = F.expr("CASE WHEN role = 'system' OR turn % 5 = 3 THEN 'heading' WHEN turn % 7 = 2 THEN 'list' WHEN turn % 11 = 5 THEN 'figure' ELSE 'paragraph' END")
    return c.select(F.col("conv_id").alias("doc_id"), F.lit("talk").alias("section"), F.col("turn").cast("int").alias("pos"), kind.alias("type"), F.expr("cast(turn % 4 + 1 as int)").alias("level"), F.coalesce("text", F.lit("")).alias("content"), F.expr("cast(5 + (conv_id * 7 + turn * 13) % 90 as int)").alias("tok"))


SQL_TALK = """
talk AS (SELECT conv_id AS doc_id, 'talk' AS section, CAST(turn AS INTEGER) AS pos,
    CASE WHEN role = 'system' OR turn % 5 = 3 THEN 'heading' WHEN turn % 7 = 2 THEN 'list' WHEN turn % 11 = 5 THEN 'figure' ELSE 'paragraph' END AS type,
    CAST(turn % 4 + 1 AS INTEGER) AS level, coalesce(text, '') AS content, CAST(5 + (conv_id * 7 + turn * 13) % 90 AS INTEGER) AS tok FROM conversations)"""
