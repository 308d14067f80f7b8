"""Queries of parsing, cleaning, sections, headings and assets, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import assets, blocks, cleanup, cropping, headings, layout, pictures, sections
from ..sources import files
from . import bridge as V

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(oracle: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return put



# The page scanner as a recursion over line numbers: each line gets its block.
_SCAN = rf"""WITH RECURSIVE {V.SQL_LINES}, l AS (
    SELECT doc_id, page, n, line, trim(regexp_replace(line, '\s+', ' ', 'g')) = '' AS blank, regexp_matches(line, '^\s*<([a-zA-Z][a-zA-Z0-9]*)\b[^>]*>') AS html,
        lower(regexp_extract(line, '^\s*<([a-zA-Z][a-zA-Z0-9]*)\b[^>]*>', 1)) AS tag, regexp_matches(line, '^\S') AS flush FROM (SELECT *, max(n) OVER (PARTITION BY doc_id, page) AS last_n FROM lines) WHERE NOT (n = last_n AND line = '')
), s AS (
    SELECT doc_id, page, -1 AS n, CAST(NULL AS VARCHAR) AS tag, 0 AS blk, false AS held, CAST(NULL AS VARCHAR) AS line, false AS is_html, false AS has FROM (SELECT DISTINCT doc_id, page FROM l)
    UNION ALL
    SELECT l.doc_id, l.page, l.n,
        CASE WHEN s.tag IS NOT NULL THEN CASE WHEN contains(lower(l.line), '</' || s.tag || '>') THEN NULL ELSE s.tag END
             WHEN l.html AND NOT l.blank AND NOT (regexp_matches(l.line, '/>\s*$') OR contains(lower(l.line), '</' || l.tag || '>')) THEN l.tag END AS tag,
        CASE WHEN s.tag IS NOT NULL THEN s.blk WHEN l.blank OR l.html OR (s.held AND l.flush) OR NOT s.held THEN s.blk + 1 ELSE s.blk END AS blk,
        s.tag IS NULL AND NOT l.blank AND NOT l.html AS held,
        l.line, s.tag IS NOT NULL OR (l.html AND NOT l.blank) AS is_html, s.tag IS NOT NULL OR NOT l.blank AS has
    FROM s JOIN l ON l.doc_id = s.doc_id AND l.page = s.page AND l.n = s.n + 1
), raw AS (
    SELECT doc_id, page, blk, bool_or(is_html) AS is_html, string_agg(line, chr(10) ORDER BY n) AS text, min(n) AS n FROM s WHERE has GROUP BY doc_id, page, blk
), cut AS (
    SELECT doc_id, page, n, CASE WHEN is_html THEN text ELSE {V.strip("text")} END AS text FROM raw
), f AS (
    SELECT *, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS ls FROM cut
), g AS (
    SELECT *, {V.strip("ls[1]")} AS first FROM f WHERE len(ls) > 0
), parsed AS (
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page, n) - 1 AS INTEGER) AS pos, page,
        CASE WHEN len(ls) = 1 AND regexp_matches(first, '^(#{{1,6}})\s+(.*)$') THEN 'heading' WHEN starts_with(lower(first), '<figure') THEN 'figure' WHEN starts_with(lower(first), '<table') THEN 'table'
             WHEN regexp_matches(first, '^\s*<([a-zA-Z][a-zA-Z0-9]*)\b[^>]*>') THEN 'html'
             WHEN len(list_filter(ls, lambda x: NOT (regexp_matches(ltrim(x), '^[-+*]\s+.+$') OR regexp_matches(ltrim(x), '^\d+[.)]\s+.+$')))) = 0 THEN 'list' ELSE 'paragraph' END AS type,
        CASE WHEN len(ls) = 1 THEN nullif(length(regexp_extract(first, '^(#{{1,6}})\s+(.*)$', 1)), 0) END AS level0, first, text
    FROM g
), out AS (
    SELECT doc_id, pos, page, type, CAST(CASE WHEN type = 'heading' THEN level0 END AS INTEGER) AS level, CASE WHEN type = 'heading' THEN regexp_extract(first, '^(#{{1,6}})\s+(.*)$', 2) ELSE text END AS content FROM parsed
)"""


@register(f"{_SCAN} SELECT * FROM out")
def parse_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.parse_pages(V.pages(spark, sf_dir))


@register(rf"""{_SCAN}, w AS (SELECT *, {V.word_count(V.strip_md("content"))} AS words FROM out), t AS (SELECT doc_id, min(pos) AS t FROM w WHERE type = 'heading' AND level = 1 AND words >= 3 GROUP BY doc_id),
    r AS (SELECT out.*, out.pos = coalesce(t, -1) AS is_t FROM out LEFT JOIN t USING (doc_id))
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page, is_t DESC, pos) - 1 AS INTEGER) AS pos, page, CASE WHEN is_t THEN 'title' ELSE type END AS type, CASE WHEN NOT is_t THEN level END AS level, content FROM r""")
def title_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.promote_title(parse_blocks(spark, sf_dir))


@register(f"WITH {V.SQL_PLAIN} SELECT doc_id, page, type, count(*) AS n_blocks, CAST(sum(words) AS BIGINT) AS n_words FROM plain WHERE NOT (type = 'paragraph' AND {V.noise('plain')}) GROUP BY ALL")
def noise_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleanup.drop_artifacts(V.blocks(spark, sf_dir))
    return kept.groupBy("doc_id", "page", "type").agg(F.count("*").alias("n_blocks"), F.sum(T.word_count(F.col("content"))).alias("n_words"))


@register(f"WITH {V.SQL_CLEAN} SELECT doc_id, pos, page, type, level, content FROM kept2")
def header_footer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanup.drop_running_heads(V.blocks(spark, sf_dir))


@register(f"WITH {V.SQL_BLOCKS} SELECT * FROM blocks WHERE NOT (type = 'figure' AND NOT contains(lower(content), '<figcaption') AND (contains(lower(content), 'logo') OR contains(lower(content), 'creative commons') OR contains(lower(content), 'icon')))")
def logo_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanup.drop_logos(V.blocks(spark, sf_dir))


@register(f"WITH {V.SQL_MERGED} SELECT * FROM merged")
def merge_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanup.clean(V.blocks(spark, sf_dir))


# The words that name sections, as in the operators.
_WORDS3 = "list_has_any(string_split(norm, ' ')[1:3], [{0}])"
_STARTS = rf"""{V.SQL_BLOCKS}, nb AS (SELECT *, {V.normalize("content")} AS norm, {V.normalize(V.first_group("content", r"^\s*\*\*(.+?)\*\*"))} AS lead FROM blocks),
    meta AS (SELECT doc_id, arg_min(page, pos) AS ap, arg_min(coalesce(level, 0), pos) AS al FROM nb WHERE type = 'heading' AND norm = 'abstract' GROUP BY doc_id),
    cls AS (SELECT nb.*, CASE
        WHEN type = 'heading' THEN CASE WHEN ap IS NOT NULL AND page = ap AND coalesce(level, 0) > al AND norm <> 'abstract' THEN NULL
            WHEN norm = 'abstract' THEN 'abstract' WHEN norm IN ('intro', 'introduction') THEN 'introduction' WHEN {_WORDS3.format("'method', 'methods', 'methodology'")} THEN 'methods'
            WHEN {_WORDS3.format("'result', 'results'")} THEN 'results' WHEN {_WORDS3.format("'discussion'")} THEN 'discussion' WHEN {_WORDS3.format("'conclusion', 'conclusions'")} THEN 'conclusion'
            WHEN {_WORDS3.format("'references', 'bibliography'")} THEN 'references' END
        WHEN type = 'paragraph' AND page = 1 THEN CASE WHEN lead IN ('abstract', 'purpose', 'background', 'objective', 'objectives', 'study design', 'materials and methods', 'methods', 'results', 'conclusion', 'conclusions') THEN 'abstract'
            WHEN lead IN ('key words', 'keywords') THEN 'introduction' END END AS section FROM nb LEFT JOIN meta USING (doc_id)),
    ex AS (SELECT doc_id, pos, section FROM cls WHERE section IS NOT NULL)"""


@register(f"WITH {_STARTS} SELECT doc_id, pos, section FROM ex")
def section_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.explicit_starts(V.blocks(spark, sf_dir))


_ACCEPT = f"""{_STARTS}, facts AS (SELECT doc_id, min(pos) FILTER (WHERE section = 'abstract') AS a, min(pos) FILTER (WHERE section = 'introduction') AS i, min(pos) FILTER (WHERE section = 'methods') AS m,
        count(section) AS k, min(pos) FILTER (WHERE page = 1) AS p1, min(pos) FILTER (WHERE page > 1) AS p2 FROM cls GROUP BY doc_id),
    cand AS (SELECT doc_id, pos, section, 0 AS src FROM ex
        UNION ALL SELECT doc_id, p1, 'abstract', 1 FROM facts WHERE a IS NULL AND i IS NULL AND p1 IS NOT NULL
        UNION ALL SELECT doc_id, p2, 'introduction', 1 FROM facts WHERE a IS NULL AND i IS NULL AND p2 < m
        UNION ALL SELECT doc_id, a + 1, 'introduction', 1 FROM facts WHERE a IS NOT NULL AND i IS NULL AND a + 1 < m
        UNION ALL SELECT doc_id, 0, 'introduction', 1 FROM facts WHERE k = 0 AND p1 IS NULL),
    ord0 AS (SELECT doc_id, pos, arg_min(section, src) AS section FROM cand GROUP BY doc_id, pos),
    ord1 AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS rn, list_position(['abstract', 'introduction', 'methods', 'results', 'discussion', 'conclusion', 'references'], section) - 1 AS rk FROM ord0),
    fold AS (SELECT doc_id, 0::BIGINT AS rn, -1 AS last, []::VARCHAR[] AS seen, false AS took, 0 AS pos, '' AS section FROM (SELECT DISTINCT doc_id FROM ord1)
        UNION ALL SELECT o.doc_id, o.rn, CASE WHEN ok THEN rk ELSE last END, CASE WHEN ok THEN list_append(seen, o.section) ELSE seen END, ok, o.pos, o.section
        FROM (SELECT o.*, f.last, f.seen, NOT list_contains(f.seen, o.section) AND NOT (o.rk >= 3 AND f.last < 2) AS ok FROM fold f JOIN ord1 o ON o.doc_id = f.doc_id AND o.rn = f.rn + 1) o),
    acc AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS section_ord, section, pos AS start_pos FROM fold WHERE took)"""


@register(f"WITH RECURSIVE {_ACCEPT} SELECT doc_id, section_ord, section, CAST(start_pos AS INTEGER) AS start_pos FROM acc")
def section_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.section_starts(V.blocks(spark, sf_dir))


@register(f"""WITH RECURSIVE {_ACCEPT}, j AS (SELECT b.doc_id, b.pos, b.type, last_value(a.section_ord IGNORE NULLS) OVER w AS section_ord, last_value(a.section IGNORE NULLS) OVER w AS section
    FROM blocks b LEFT JOIN acc a ON a.doc_id = b.doc_id AND a.start_pos = b.pos WINDOW w AS (PARTITION BY b.doc_id ORDER BY b.pos ROWS UNBOUNDED PRECEDING)) SELECT * FROM j WHERE section IS NOT NULL""")
def section_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.split_sections(V.blocks(spark, sf_dir)).select("doc_id", "pos", "type", "section_ord", "section")


@register(rf"""WITH {V.SQL_BLOCKS}, w AS (SELECT *, type = 'paragraph' AND coalesce({V.strip(V.first_group("content", r"^\s*\*\*(.+?)\*\*\s*$"))} <> '', false) AS weak, {V.strip(V.first_group("content", r"^\s*\*\*(.+?)\*\*\s*$"))} AS alone,
    last_value(CASE WHEN type = 'heading' THEN level END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM blocks)
    SELECT doc_id, pos, page, CASE WHEN weak THEN 'heading' ELSE type END AS type, CAST(CASE WHEN weak THEN coalesce(last - 1, 1) ELSE level END AS INTEGER) AS level, CASE WHEN weak THEN alone ELSE content END AS content, CASE WHEN weak THEN 'paragraph' END AS converted_from FROM w""")
def weak_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headings.weak_levels(V.blocks(spark, sf_dir))


# One row at a time per document: the level machine.
_LEVELS = rf"""WITH RECURSIVE {V.SQL_BLOCKS}, x AS (
    SELECT *, 'Results' AS section, type = 'heading' AS strong, type = 'paragraph' AND coalesce({V.strip(V.first_group("content", r"^\s*\*\*(.+?)\*\*"))} <> '', false) AS weak,
        {V.normalize("content")} = 'results' AS same FROM blocks
), m AS (
    SELECT doc_id, -1 AS pos, false AS anchored, 1 AS cur, NULL::INTEGER AS verb, NULL::INTEGER AS page, false AS was, NULL::INTEGER AS last, NULL::INTEGER AS lvl, false AS skip FROM (SELECT DISTINCT doc_id FROM x)
    UNION ALL
    SELECT doc_id, pos,
        CASE WHEN strong THEN true ELSE anchored END,
        CASE WHEN strong OR weak THEN lvl ELSE cur END,
        CASE WHEN NOT strong THEN verb WHEN title THEN v WHEN NOT anchored THEN p WHEN v IS NULL OR verb IS NULL THEN verb ELSE p END,
        page, CASE WHEN weak THEN true WHEN strong THEN false ELSE was END, CASE WHEN strong OR weak THEN lvl ELSE last END,
        CASE WHEN strong OR weak THEN lvl END, title
    FROM (
        SELECT *, CASE WHEN weak THEN CASE WHEN was THEN cur ELSE least(coalesce(last, cur) + 1, 5) END WHEN NOT strong THEN NULL WHEN title THEN 1 WHEN NOT anchored THEN CASE WHEN p IS NULL THEN 2 ELSE greatest(p, 2) END
            WHEN v IS NULL OR verb IS NULL THEN least(greatest(cur, 2), 5) ELSE least(greatest(cur + p - verb, 2), 5) END AS lvl
        FROM (
            SELECT x.doc_id, x.pos, x.page, x.strong, x.weak, x.strong AND x.same AS title, CASE WHEN x.strong THEN x.level END AS v, CASE WHEN x.strong THEN CASE WHEN x.level = 1 THEN 2 ELSE x.level END END AS p,
                CASE WHEN moved THEN false ELSE m.anchored END AS anchored, CASE WHEN moved THEN NULL ELSE m.verb END AS verb, CASE WHEN moved THEN CASE WHEN m.was AND m.last IS NOT NULL THEN m.last ELSE 1 END ELSE m.cur END AS cur,
                CASE WHEN moved THEN m.was AND m.last IS NOT NULL ELSE m.was END AS was, m.last
            FROM (SELECT m.*, m.page IS NOT NULL AND m.page <> y.page AS moved FROM m JOIN x y ON y.doc_id = m.doc_id AND y.pos = m.pos + 1) m JOIN x ON x.doc_id = m.doc_id AND x.pos = m.pos + 1
        )
    )
)"""


@register(f"{_LEVELS} SELECT m.doc_id, m.pos, CASE WHEN lvl IS NOT NULL THEN 'heading' ELSE x.type END AS type, CAST(lvl AS INTEGER) AS assigned_level, CAST(CASE WHEN lvl IS NOT NULL AND x.type = 'heading' THEN x.level END AS INTEGER) AS reported_level FROM m JOIN x ON x.doc_id = m.doc_id AND x.pos = m.pos WHERE NOT m.skip")
def page_reset_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.blocks(spark, sf_dir).withColumn("section", F.lit("Results"))
    return headings.page_reset_levels(rows).select("doc_id", "pos", "type", "assigned_level", "reported_level")


def _layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every block seen by the layout up to a page on, with a box by arithmetic; it takes
    some headings, and all that is none, for text."""
    b = V.blocks(spark, sf_dir)
    label = F.when((F.col("type") == "heading") & (F.col("pos") % 4 != 1), "section_header").otherwise("text")
    t = F.expr("cast(100 + (pos * 37) % 700 as double)")
    bbox = F.struct(F.expr("cast(pos % 300 as double)").alias("l"), t.alias("t"), F.expr("cast(pos % 300 + 100 as double)").alias("r"), (t - 12).alias("b"))
    rows = b.select("doc_id", (F.col("page") + F.col("pos") % 2).cast("int").alias("page"), F.col("pos").alias("text_ord"), label.alias("label"), F.concat(F.lit("**"), F.col("content"), F.lit("**")).alias("text"), bbox.alias("bbox"))
    return headings.layout_order(rows)


_LAYOUT = rf"""lay0 AS (SELECT doc_id, CAST(page + pos % 2 AS INTEGER) AS layout_page, pos AS text_ord, {V.normalize("content")} AS norm, CAST(pos % 300 AS DOUBLE) AS l, CAST(100 + (pos * 37) % 700 AS DOUBLE) AS t FROM blocks WHERE type = 'heading' AND pos % 4 <> 1),
    lay AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY layout_page, -t, text_ord) AS ord FROM lay0),
    hd AS (SELECT doc_id, pos, page, content, {V.normalize("content")} AS norm, CAST(page // 4 AS INTEGER) AS chapter_ord FROM blocks WHERE type = 'heading'),
    mt0 AS (SELECT hd.*, lay.l, lay.t, lay.layout_page, row_number() OVER (PARTITION BY hd.doc_id, hd.pos ORDER BY CASE WHEN lay.ord IS NULL THEN 1 ELSE 0 END, layout_page <> hd.page, lay.ord) AS k FROM hd LEFT JOIN lay ON lay.doc_id = hd.doc_id AND lay.norm = hd.norm),
    mt AS (SELECT * FROM mt0 WHERE k = 1)"""


def _headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.blocks(spark, sf_dir).where("type = 'heading'").select("doc_id", "pos", "page", "content", F.expr("cast(page div 4 as int)").alias("chapter_ord"))


@register(f"WITH {V.SQL_BLOCKS}, {_LAYOUT} SELECT doc_id, pos, page, l AS box_l, t AS box_t, layout_page AS bbox_page FROM mt")
def heading_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = headings.match_boxes(_headings(spark, sf_dir), _layout(spark, sf_dir))
    return got.select("doc_id", "pos", "page", F.col("bbox.l").alias("box_l"), F.col("bbox.t").alias("box_t"), "bbox_page")


@register(f"""WITH {V.SQL_BLOCKS}, {_LAYOUT}, early AS (SELECT doc_id, norm, arg_min(l, ord) AS l, arg_min(t, ord) AS t, arg_min(layout_page, ord) AS p FROM lay GROUP BY ALL),
    nx AS (SELECT *, lead(pos) OVER w AS np, lead(l) OVER w AS nl, lead(t) OVER w AS nt, lead(page) OVER w AS npage, row_number() OVER w AS rn FROM mt WINDOW w AS (PARTITION BY doc_id, chapter_ord ORDER BY pos)),
    fi AS (SELECT nx.doc_id, nx.chapter_ord, CASE WHEN e.p IS NOT NULL THEN e.l ELSE nx.l END AS l, CASE WHEN e.p IS NOT NULL THEN e.t ELSE nx.t END AS t, coalesce(e.p, nx.page) AS p FROM nx LEFT JOIN early e ON e.doc_id = nx.doc_id AND e.norm = nx.norm WHERE rn = 1),
    af AS (SELECT doc_id, chapter_ord, lead(l) OVER w AS al, lead(t) OVER w AS att, lead(p) OVER w AS ap FROM fi WINDOW w AS (PARTITION BY doc_id ORDER BY chapter_ord))
    SELECT nx.doc_id, nx.pos, CASE WHEN np IS NOT NULL THEN nl WHEN ap IS NOT NULL THEN al ELSE 0.0 END AS end_l, CASE WHEN np IS NOT NULL THEN nt WHEN ap IS NOT NULL THEN att ELSE 0.0 END AS end_t,
        CASE WHEN np IS NULL AND ap IS NULL THEN CAST(500 + page AS DOUBLE) END AS foot_r, CAST(CASE WHEN np IS NOT NULL THEN npage ELSE coalesce(ap, page) END AS INTEGER) AS end_page FROM nx JOIN af USING (doc_id, chapter_ord)""")
def section_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _layout(spark, sf_dir)
    got = headings.match_boxes(_headings(spark, sf_dir), layout)
    widths = V.blocks(spark, sf_dir).select("doc_id", "page").distinct().withColumn("width", (F.col("page") + 500).cast("double"))
    end = headings.section_ends(got, layout, widths)
    foot = F.when((F.col("section_end_bbox.t") == 0) & (F.col("section_end_bbox.b") == 0), F.col("section_end_bbox.r"))
    return end.select("doc_id", "pos", F.col("section_end_bbox.l").alias("end_l"), F.col("section_end_bbox.t").alias("end_t"), foot.alias("foot_r"), F.col("section_end_page").alias("end_page"))


_NUM = rf"""nums AS (SELECT b.*, lag(type) OVER w AS pt, lag(content) OVER w AS pc FROM blocks b WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    own AS (SELECT *, CASE WHEN type = 'figure' THEN {V.number("content", "<figcaption" + chr(92) + "b[^>]*>.*?" + chr(92) + "b(?:fig(?:ure)?)" + chr(92) + ".?" + chr(92) + "s*[:.]?" + chr(92) + "s*([0-9]+)" + chr(92) + "b", "is")}
            WHEN type = 'table' THEN {V.number("content", "<caption" + chr(92) + "b[^>]*>.*?" + chr(92) + "btable" + chr(92) + "s+([0-9]+)" + chr(92) + "b", "is")} END AS o,
        CASE WHEN pt = 'paragraph' THEN CASE WHEN type = 'figure' THEN {V.number(V.strip_md("pc"), V.FIGURE)} WHEN type = 'table' THEN {V.number(V.strip_md("pc"), V.TABLE)} END END AS p FROM nums),
    num AS (SELECT *, coalesce(o, p) AS number, CASE type WHEN 'figure' THEN 'images' WHEN 'table' THEN 'tables' END AS category FROM own),
    ast AS (SELECT doc_id // 10 AS doc_id, CASE WHEN doc_id % 2 = 0 THEN 'images' ELSE 'tables' END AS category, CAST(doc_id % 3 + 1 AS INTEGER) AS number, CAST(doc_id % 10 + 1 AS INTEGER) AS page FROM documents),
    la AS (SELECT doc_id, category, number, max(page) AS page FROM ast GROUP BY ALL)"""


@register(f"""WITH {V.SQL_BLOCKS}, {_NUM} SELECT num.doc_id, num.pos, num.type, num.number, la.page IS NOT NULL AS matched, CASE WHEN la.page IS NOT NULL THEN la.page || '/' || num.category || '/' || num.number || '.png' ELSE num.content END AS content
    FROM num LEFT JOIN la ON la.doc_id = num.doc_id AND la.category = num.category AND la.number = num.number""")
def asset_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    files = V.table(spark, sf_dir, "documents").select(F.expr("doc_id div 10").alias("doc_id"), F.when(d % 2 == 0, "images").otherwise("tables").alias("category"), (d % 3 + 1).cast("int").alias("number"), (d % 10 + 1).cast("int").alias("page"))
    files = files.withColumn("rel_path", F.concat_ws("/", F.col("page").cast("string"), "category", F.concat(F.col("number").cast("string"), F.lit(".png"))))
    rows = V.blocks(spark, sf_dir)
    met = assets.join_assets(rows, files)
    numbers = assets.numbered(rows).select("doc_id", "pos", "number")
    return met.join(numbers, ["doc_id", "pos"]).select("doc_id", "pos", "type", "number", "matched", "content")


@register(f"""WITH {V.SQL_BLOCKS}, k AS (SELECT doc_id, page, pos, CASE WHEN type IN ('figure', 'table') THEN type ELSE 'text' END AS kind, content FROM blocks)
    SELECT doc_id, page, pos, kind, CAST(row_number() OVER (PARTITION BY doc_id, page, kind ORDER BY pos) AS INTEGER) AS counter, CASE WHEN lag(kind) OVER w = 'text' THEN lag(content) OVER w END AS prev_text FROM k WINDOW w AS (PARTITION BY doc_id, page ORDER BY pos)""")
def layout_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("type").isin("figure", "table"), F.col("type")).otherwise("text")
    items = V.blocks(spark, sf_dir).select("doc_id", "page", F.col("pos").alias("ord"), kind.alias("kind"), F.col("content").alias("text"))
    return layout.with_counters(items).select("doc_id", "page", F.col("ord").alias("pos"), "kind", "counter", "prev_text")


@register(f"""WITH {V.SQL_BLOCKS}, h AS (SELECT doc_id, 'chapter ' || page AS chapter, arg_min(content, pos) AS c FROM blocks WHERE type = 'heading' GROUP BY ALL)
    SELECT doc_id, chapter, coalesce(list_has_any(list_filter(string_split({V.normalize("c")}, ' '), lambda w: w <> '')[1:3], list_concat(string_split(chapter, ' '), ['results'])), false) AS heading_matches FROM h""")
def heading_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.blocks(spark, sf_dir).where("type = 'heading'").select("doc_id", F.concat(F.lit("chapter "), F.col("page").cast("string")).alias("chapter"), F.lit("Results").alias("section"), "pos", "content")
    return headings.first_heading_check(rows)


@register(f"""WITH {V.SQL_BLOCKS} SELECT doc_id, 'p' || page AS chapter, 'no headings' AS error FROM blocks GROUP BY ALL HAVING NOT bool_or(type = 'heading')""")
def chapters_without_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.blocks(spark, sf_dir).select("doc_id", F.concat(F.lit("p"), F.col("page").cast("string")).alias("chapter"), "type")
    return headings.chapters_without_headings(rows)


@register(f"""WITH {V.SQL_BLOCKS}, st AS (SELECT doc_id, 'chapter_' || page AS stem, count(*) FILTER (WHERE type = 'heading') AS n FROM blocks GROUP BY ALL),
    fo AS (SELECT a.doc_id, a.requested, min(st.stem) AS stem FROM (SELECT doc_id, unnest(['Chapter_1', 'chapter_3', 'methods']) AS requested FROM (SELECT DISTINCT doc_id FROM blocks)) a
        LEFT JOIN st ON st.doc_id = a.doc_id AND contains(st.stem, lower(a.requested)) GROUP BY ALL)
    SELECT fo.doc_id, requested, fo.stem, coalesce(n, 0) AS n_headings, CASE WHEN fo.stem IS NULL THEN 'no chapter file' WHEN n = 0 THEN 'no headings' END AS error FROM fo LEFT JOIN st ON st.doc_id = fo.doc_id AND st.stem = fo.stem""")
def requested_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.blocks(spark, sf_dir).select("doc_id", F.concat(F.lit("chapter_"), F.col("page").cast("string")).alias("stem"), "type")
    return headings.requested_chapters(rows.select("doc_id", "stem").distinct(), rows, ["Chapter_1", "chapter_3", "methods"])


@register(f"""WITH {V.SQL_BLOCKS}, pg AS (SELECT doc_id, page, max(page) OVER (PARTITION BY doc_id) AS last FROM (SELECT DISTINCT doc_id, page FROM blocks))
    SELECT doc_id, page, NULL AS error FROM pg WHERE last >= 10 AND page BETWEEN 2 AND 10
    UNION ALL SELECT DISTINCT doc_id, NULL, 'page 10 is beyond the last page ' || last FROM pg WHERE last < 10""")
def page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.page_range(V.blocks(spark, sf_dir).select("doc_id", "page").distinct(), 2, 10)


@register(f"""WITH {V.SQL_BLOCKS} SELECT doc_id, page, pos, number FROM (SELECT doc_id, page, pos, {V.number(V.strip_md("content"), V.FIGURE)} AS number, CASE WHEN pos % 7 = 0 THEN NULL WHEN pos % 5 = 0 THEN page + 1 ELSE page END AS prov FROM blocks)
    WHERE number IS NOT NULL AND coalesce(prov, page) = page""")
def caption_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pos = F.col("pos")
    prov = F.when(pos % 7 == 0, F.lit(None)).when(pos % 5 == 0, F.col("page") + 1).otherwise(F.col("page"))
    texts = V.blocks(spark, sf_dir).select("doc_id", "page", "pos", F.col("content").alias("text"), prov.cast("int").alias("prov_page"))
    return pictures.caption_candidates(texts).select("doc_id", "page", "pos", "number")


@register(f"""WITH {V.SQL_BLOCKS} SELECT doc_id, pos, page, level, content FROM blocks WHERE type = 'heading'""")
def chapter_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cropping.chapter_headings(V.blocks(spark, sf_dir)).select("doc_id", "pos", "page", "level", "content")


@register(rf"""WITH {V.SQL_BLOCKS}, w AS (SELECT *, {V.word_count(V.strip_md("content"))} AS words FROM blocks),
    t AS (SELECT doc_id, arg_min({V.strip("content")}, pos) AS title FROM w WHERE type = 'heading' AND level = 1 AND words >= 3 GROUP BY doc_id)
    SELECT DISTINCT b.doc_id, coalesce(title, 'paper ' || b.doc_id) AS title FROM blocks b LEFT JOIN t USING (doc_id)""")
def document_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = blocks.promote_title(V.blocks(spark, sf_dir)).withColumn("name", F.concat(F.lit("paper "), F.col("doc_id").cast("string")))
    return sections.document_title(rows, "name")
