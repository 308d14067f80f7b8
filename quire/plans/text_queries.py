"""Queries of text functions, recall and ordering, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..operators import recall
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


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.lines(spark, sf_dir).select("doc_id", "page", "n", T.strip(F.col("line")).alias("s"))


_L = f"WITH {V.SQL_LINES}, s AS (SELECT doc_id, page, n, {V.strip('line')} AS s FROM lines)"


@register(f"{_L} SELECT doc_id, page, n, plain, {V.normalize('s')} AS norm, {V.word_count('plain')} AS words FROM (SELECT *, {V.strip_md('s')} AS plain FROM s)")
def strip_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s")
    return _lines(spark, sf_dir).select("doc_id", "page", "n", T.strip_md(s).alias("plain"), T.normalize(s).alias("norm"), T.word_count(s).cast("long").alias("words"))


@register(f"{_L} SELECT doc_id, page, n, {V.number('plain', V.FIGURE)} AS figure, {V.number('plain', V.TABLE)} AS tab, nullif(plain, '') AS caption FROM (SELECT *, {V.strip_md('s')} AS plain FROM s)")
def caption_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s")
    return _lines(spark, sf_dir).select("doc_id", "page", "n", T.figure_number(s)["number"].alias("figure"), T.table_number(s)["number"].alias("tab"), T.figure_number(s)["caption"].alias("caption"))


_CAP = r"nullif(replace(regexp_replace(regexp_replace(regexp_extract(s, '<{0}\b[^>]*>(.*?)</{0}>', 1, 'is'), '<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g'), '&amp;', '&'), '')"


@register(rf"""{_L} SELECT doc_id, page, n, {V.number('s', '<figcaption' + chr(92) + 'b[^>]*>.*?' + chr(92) + 'b(?:fig(?:ure)?)' + chr(92) + '.?' + chr(92) + 's*[:.]?' + chr(92) + 's*([0-9]+)' + chr(92) + 'b', 'is')} AS figure,
    {_CAP.format('figcaption')} AS figure_caption, {V.number('s', '<caption' + chr(92) + 'b[^>]*>.*?' + chr(92) + 'btable' + chr(92) + 's+([0-9]+)' + chr(92) + 'b', 'is')} AS tab, {_CAP.format('caption')} AS table_caption,
    nullif(trim(replace(regexp_extract(s, '<img\b[^>]*\balt="([^"]*)"', 1, 'i'), '&amp;', '&')), '') AS alt_text FROM s WHERE starts_with(s, '<')""")
def html_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s")
    rows = _lines(spark, sf_dir).where(s.startswith("<"))
    return rows.select("doc_id", "page", "n", T.html_figure(s)["number"].alias("figure"), T.html_figure(s)["caption"].alias("figure_caption"), T.html_table(s)["number"].alias("tab"), T.html_table(s)["caption"].alias("table_caption"), T.alt_text(s).alias("alt_text"))


@register(rf"""{_L} SELECT doc_id, page, n, {V.strip(V.first_group('s', r'^\s*\*\*(.+?)\*\*'))} AS lead, {V.strip(V.first_group('s', r'^\s*\*\*(.+?)\*\*\s*$'))} AS alone,
    {V.strip("regexp_replace(s, '^[*_]+|[*_]+$', '', 'g')")} AS bare FROM s WHERE contains(s, '*')""")
def bold_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s")
    return _lines(spark, sf_dir).where(s.contains("*")).select("doc_id", "page", "n", T.bold_lead(s).alias("lead"), T.standalone_bold(s).alias("alone"), T.strip_emphasis(s).alias("bare"))


@register(rf"""{_L}, f AS (SELECT *, {V.word_count(V.strip_md('s'))} AS words FROM s), g AS (SELECT *, lead(s) OVER (PARTITION BY doc_id, page ORDER BY n) AS nxt FROM f)
    SELECT doc_id, page, n, CASE WHEN s = '' THEN false WHEN regexp_matches(s, '[-,]$') THEN true WHEN regexp_matches(s, '[.!?]$') THEN false ELSE words > 3 END AS ends, regexp_matches(s, '^\s*\p{{Ll}}') AS starts,
    CASE WHEN ends_with(s, '-') THEN left(s, -1) || nxt ELSE s || ' ' || nxt END AS joined FROM g""")
def broken_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s")
    w = Window.partitionBy("doc_id", "page").orderBy("n")
    return _lines(spark, sf_dir).select("doc_id", "page", "n", T.ends_broken(s).alias("ends"), T.starts_broken(s).alias("starts"), T.join_parts(s, F.lead("s").over(w)).alias("joined"))


@register(rf"""{_L}, t AS (SELECT *, {V.strip_md('s')} AS plain FROM s) SELECT doc_id, page, n,
    coalesce(CAST({V.number('plain', V.TABLE)} AS VARCHAR), CASE WHEN plain <> '' THEN regexp_replace(substr(regexp_replace(plain, '[\\/*?:"<>| ]', '_', 'g'), 1, 50), '^_+|_+$', '', 'g') END) AS identifier FROM t""")
def table_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = T.table_number(F.col("s"))
    return _lines(spark, sf_dir).select("doc_id", "page", "n", T.table_identifier(x["number"], x["caption"]).alias("identifier"))


def _base(x: str) -> str:
    x = rf"translate(lower({x}), '–—−“”', '---""')"
    for p, to in ((r"\$[^$]*\$", " "), (r"\\[a-zA-Z]+", " "), (r"\$", " "), (r'<img\b[^>]*\balt="([^"]*)"[^>]*>', r" \1 "), (r"<[^>]+>", " ")):
        x = f"regexp_replace({x}, '{p}', '{to}', 'g')"
    return x


_BOILER = r"""array_to_string(list_filter(list_transform(string_split({0}, chr(10)), lambda l: regexp_replace(l, '^\s+|\s+$', '', 'g')), lambda l: NOT (starts_with(lower(l), 'https://doi.org/') OR lower(l) = 'springer'
    OR contains(lower(l), 'extended author information available on the last page of the article') OR starts_with(lower(l), 'received:') OR contains(lower(l), 'published online:') OR starts_with(lower(l), '© the author'))), chr(10))"""


def _digital(x: str) -> str:
    return rf"translate(regexp_replace(regexp_replace({x}, '([a-z]{{2,}})-\s*\n\s*([a-z]{{2,}})', '\1\2', 'g'), '\s+', ' ', 'g'), '-', ' ')"


def _extracted(x: str) -> str:
    return rf"translate(regexp_replace({x}, '\s+', ' ', 'g'), '-', ' ')"


def _long(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '[^\p{{L}}\p{{N}}_]+'), lambda w: regexp_full_match(w, '[a-z]{{6,}}'))"


@register(f"WITH t AS (SELECT doc_id, {_BOILER.format(_base('text'))} AS t FROM documents) SELECT doc_id, {_digital('t')} AS digital, {_extracted('t')} AS extracted FROM t")
def normalized_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return V.table(spark, sf_dir, "documents").select("doc_id", T.normalize_digital(t).alias("digital"), T.normalize_extracted(t).alias("extracted"))


_PAIRS = rf"""p AS (SELECT doc_id, text AS d, array_to_string(list_transform(string_split(text, ' '), lambda w, i: CASE WHEN (i - 1) % 3 = 1 THEN 'x' ELSE w END), ' ') AS e FROM documents),
    q AS (SELECT doc_id, {_BOILER.format(_base('d'))} AS d, {_BOILER.format(_base('e'))} AS e FROM p), w AS (SELECT doc_id, {_long(_digital('d'))} AS d, {_long(_extracted('e'))} AS e FROM q)"""


@register(f"""WITH {_PAIRS}, r AS (SELECT doc_id, CASE WHEN len(d) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(list_distinct(d), list_distinct(e))) / len(list_distinct(d)) END AS unique_recall,
    array_to_string(list_sort(list_filter(list_distinct(d), lambda x: NOT list_contains(e, x)))[1:30], ' ') AS missing FROM w) SELECT doc_id, round(unique_recall, 9) AS unique_recall, unique_recall >= 0.85 AS is_valid, missing FROM r""")
def unique_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = recall.verify(V.recall_pairs(spark, sf_dir))
    return out.select("doc_id", F.round("unique_recall", 9).alias("unique_recall"), "is_valid", F.array_join("missing", " ").alias("missing"))


@register(f"""WITH {_PAIRS}, a AS (SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(d) AS x FROM w) GROUP BY ALL), b AS (SELECT doc_id, x, count(*) AS k FROM (SELECT doc_id, unnest(e) AS x FROM w) GROUP BY ALL),
    s AS (SELECT doc_id, sum(least(c, coalesce(k, 0)))::DOUBLE / sum(c)::DOUBLE AS r FROM a LEFT JOIN b USING (doc_id, x) GROUP BY doc_id) SELECT doc_id, round(coalesce(r, 1.0), 9) AS count_recall FROM w LEFT JOIN s USING (doc_id)""")
def count_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recall.count_recall(V.recall_pairs(spark, sf_dir)).select("doc_id", F.round("count_recall", 9).alias("count_recall"))


@register("""SELECT doc_id // 10 AS doc_id, CAST((doc_id % 10) // 4 AS INTEGER) AS batch_id, string_agg(text, chr(10) ORDER BY doc_id) FILTER (WHERE text <> '') AS text, count(*) AS n_pages FROM documents GROUP BY 1, 2""")
def batch_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = V.table(spark, sf_dir, "documents").select(F.expr("doc_id div 10").alias("doc_id"), (F.col("doc_id") % 10 + 1).alias("page"), "text")
    return recall.batch_pages(pages, 4)



@register(r"""WITH f AS (SELECT doc_id // 100 AS doc_id, doc_id AS d, CASE WHEN doc_id % 7 = 0 THEN 'notes' || chr(CAST(97 + doc_id % 26 AS INTEGER)) ELSE 'p' || (doc_id % 3) || '_' || (doc_id % 50) END || CASE WHEN doc_id % 11 = 0 THEN '.failed' ELSE '' END || '.md' AS name FROM documents),
    k AS (SELECT *, TRY_CAST(regexp_extract(regexp_replace(name, '\.md$', ''), '([0-9]+)[^0-9]*$', 1) AS INTEGER) AS num FROM f)
    SELECT doc_id, d, name, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY num NULLS LAST, name, d) AS INTEGER) AS page, contains(name, '.failed.') AS is_failed FROM k""")
def page_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    stem = F.when(d % 7 == 0, F.concat(F.lit("notes"), F.char(97 + d % 26))).otherwise(F.concat(F.lit("p"), (d % 3).cast("string"), F.lit("_"), (d % 50).cast("string")))
    name = F.concat(stem, F.when(d % 11 == 0, ".failed").otherwise(""), F.lit(".md"))
    rows = V.table(spark, sf_dir, "documents").select(F.expr("doc_id div 100").alias("doc_id"), d.alias("d"), name.alias("name"))
    return files.order_pages(rows, "name", "d").select("doc_id", "d", "name", "page", "is_failed")


@register(r"""WITH f AS (SELECT doc_id // 50 AS doc_id, doc_id AS d, CASE WHEN doc_id % 5 = 0 THEN '' ELSE lpad(CAST(doc_id % 20 AS VARCHAR), 2, '0') || '_' END || ['methods', 'Results', 'intro_methods', 'other'][CAST(doc_id % 4 AS INTEGER) + 1] AS stem FROM documents),
    o AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY TRY_CAST(nullif(regexp_extract(stem, '^([0-9]+)', 1), '') AS INTEGER) NULLS LAST, stem, d) AS INTEGER) AS chapter_ord FROM f),
    m AS (SELECT doc_id, k.keyword, min(stem) FILTER (WHERE contains(lower(stem), k.keyword)) AS found, count(*) FILTER (WHERE contains(lower(stem), k.keyword)) AS n FROM f, (SELECT unnest(['methods', 'results', 'nothing']) AS keyword) k GROUP BY 1, 2)
    SELECT o.doc_id, o.d, o.stem, o.chapter_ord, m.keyword, m.found, m.n > 1 AS ambiguous FROM o JOIN m ON m.doc_id = o.doc_id""")
def chapter_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    stem = F.concat(F.when(d % 5 == 0, "").otherwise(F.concat(F.lpad((d % 20).cast("string"), 2, "0"), F.lit("_"))), F.element_at(F.array(*map(F.lit, ("methods", "Results", "intro_methods", "other"))), (d % 4 + 1).cast("int")))
    rows = V.table(spark, sf_dir, "documents").select(F.expr("doc_id div 50").alias("doc_id"), d.alias("d"), stem.alias("stem"))
    return files.order_chapters(rows, "stem", "d").join(files.find_by_keyword(rows, "stem", ["methods", "results", "nothing"]), "doc_id").select("doc_id", "d", "stem", "chapter_ord", "keyword", "found", "ambiguous")
