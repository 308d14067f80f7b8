"""Files of papers: markdown pages, block arrays, layout pages, assets, chapters.

Readers take a path or glob that Spark can open; the document's name is the folder
(or the part of the path) that ``doc`` picks with a regular expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK = "struct<type:string,page:int,level:int,content:string,id:bigint,caption:string,alt_text:string,tokens:map<string,int>,meta:struct<style_name:string,tokens:map<string,int>>,assigned_level:string>"
CHAPTER = f"struct<document:struct<title:string,source:string,sections:array<struct<heading:string,kids:array<{BLOCK}>,blocks:array<{BLOCK}>>>>>"
LAYOUT = "struct<texts:array<struct<self_ref:string,label:string,text:string,prov:array<struct<page_no:int,bbox:struct<l:double,t:double,r:double,b:double>>>>>,dimension:struct<width:double>,size:struct<width:double>>"
LEGACY = "struct<kids:array<struct<type:string,id:bigint,`page number`:int,`bounding box`:array<double>,content:string,source:string>>>"
_PARENT = r"([^/]+)/[^/]+$"


def legacy_columns() -> list[Column]:
    """Columns of a legacy kid ``k``."""
    return [F.col("k.type"), F.col("k.id"), F.col("k.`page number`").alias("page"), F.col("k.`bounding box`").alias("bbox"), F.col("k.content"), F.col("k.source")]


def _stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def _whole(spark: SparkSession, path: str, doc: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", pattern)
    df = (reader.option("recursiveFileLookup", True) if recursive else reader).text(path, wholetext=True)
    return df.select(F.regexp_extract("_metadata.file_path", doc, 1).alias("doc_id"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))


def order_pages(files: DataFrame, name: str, *ties: str) -> DataFrame:
    """Add ``page``, the rank of a file by the last number in its stem (files without
    one last), and ``is_failed`` for extractions that did not verify."""
    stem = F.regexp_replace(F.col(name), r"\.md$", "")
    number = F.try_element_at(F.regexp_extract_all(stem, F.lit(r"[0-9]+"), 0), F.lit(-1)).try_cast("int")
    w = Window.partitionBy("doc_id").orderBy(number.asc_nulls_last(), name, *ties)
    return files.withColumns({"page": F.row_number().over(w).cast("int"), "is_failed": F.col(name).contains(".failed.")})


def read_markdown(spark: SparkSession, path: str, doc: str = _PARENT) -> DataFrame:
    """doc_id, page, name, is_failed, text."""
    return order_pages(_whole(spark, path, doc, "*.md"), "name").select("doc_id", "page", "name", "is_failed", "text")


def read_blocks(spark: SparkSession, path: str, doc: str = r"([^/]+)\.json$") -> DataFrame:
    """Arrays of blocks, one file for each document, with their positions."""
    rows = _whole(spark, path, doc, "*.json").select("doc_id", F.posexplode(F.from_json("text", f"array<{BLOCK}>")).alias("pos", "b"))
    return rows.select("doc_id", "pos", "b.*")


def read_chapters(spark: SparkSession, path: str, doc: str = _PARENT) -> DataFrame:
    """Chapter files: doc_id, stem, chapter_ord, title, section, section_ord, pos, block columns."""
    rows = _whole(spark, path, doc, "*.json").select("doc_id", _stem(F.col("name")).alias("stem"), F.from_json("text", CHAPTER).alias("c"))
    rows = order_chapters(rows, "stem").select("doc_id", "stem", "chapter_ord", F.col("c.document.title").alias("title"), F.col("c.document.source").alias("doc_source"), F.posexplode("c.document.sections").alias("section_ord", "s"))
    kids = rows.select("doc_id", "stem", "chapter_ord", "title", "doc_source", "section_ord", F.col("s.heading").alias("section"), F.posexplode(F.coalesce("s.kids", "s.blocks")).alias("pos", "b"))
    return kids.select("doc_id", "stem", "chapter_ord", "title", "doc_source", "section_ord", "section", "pos", "b.*")


def order_chapters(files: DataFrame, stem: str, *ties: str) -> DataFrame:
    """Add ``chapter_ord`` by the number a stem starts with (others last)."""
    number = F.nullif(F.regexp_extract(stem, r"^([0-9]+)", 1), F.lit("")).try_cast("int")
    return files.withColumn("chapter_ord", F.row_number().over(Window.partitionBy("doc_id").orderBy(number.asc_nulls_last(), stem, *ties)).cast("int"))


def find_by_keyword(files: DataFrame, stem: str, keywords: list[str]) -> DataFrame:
    """doc_id, keyword, found, ambiguous: the first stem that contains each keyword."""
    asked = files.select("doc_id").distinct().withColumn("keyword", F.explode(F.array(*map(F.lit, keywords))))
    hit = files.select("doc_id", F.col(stem).alias("found"), F.explode(F.filter(F.array(*map(F.lit, keywords)), lambda k: F.lower(F.col(stem)).contains(F.lower(k)))).alias("keyword"))
    best = hit.groupBy("doc_id", "keyword").agg(F.min("found").alias("found"), (F.count("*") > 1).alias("ambiguous"))
    return asked.join(best, ["doc_id", "keyword"], "left").withColumn("ambiguous", F.coalesce("ambiguous", F.lit(False)))


def read_layout(spark: SparkSession, path: str, doc: str = r"([^/]+)/[0-9]+/page_[0-9]+\.json$") -> DataFrame:
    """Layout pages ``<n>/page_<n>.json``: doc_id, page, width, layout."""
    rows = _whole(spark, path, doc, "page_*.json", recursive=True)
    part = lambda i: F.regexp_extract("path", r"/([0-9]+)/page_([0-9]+)\.json$", i).try_cast("int")
    rows = rows.withColumns({"page": part(1), "n": part(2)}).where("page = n").withColumn("layout", F.from_json("text", LAYOUT))
    return rows.select("doc_id", "page", F.coalesce("layout.dimension.width", "layout.size.width").alias("width"), "layout")


def layout_page(pages: DataFrame, page: int) -> DataFrame:
    return pages.where(F.col("page") == page)


def layout_texts(pages: DataFrame) -> DataFrame:
    """doc_id, page, text_ord, label, text, self_ref, prov_page, bbox."""
    rows = pages.select("doc_id", "page", F.posexplode("layout.texts").alias("text_ord", "t"))
    prov = F.try_element_at(F.col("t.prov"), F.lit(1))
    return rows.select("doc_id", "page", "text_ord", "t.label", "t.text", "t.self_ref", prov["page_no"].alias("prov_page"), prov["bbox"].alias("bbox"))


def read_assets(spark: SparkSession, path: str, doc: str = r"([^/]+)/[0-9]+/(?:tables|images)/[0-9]+\.png$") -> DataFrame:
    """PNG files ``<page>/{tables|images}/<n>.png``: doc_id, category, number, page, rel_path.
    Only paths are read."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").option("recursiveFileLookup", True).load(path).select("path")
    return parse_assets(df, doc)


def parse_assets(paths: DataFrame, doc: str = r"([^/]+)/[0-9]+/(?:tables|images)/[0-9]+\.png$") -> DataFrame:
    pattern = r"([^/]+)/(tables|images)/([0-9]+)\.png$"
    return paths.where(F.col("path").rlike(r"(^|/)[0-9]+/(tables|images)/[0-9]+\.png$")).select(
        F.regexp_extract("path", doc, 1).alias("doc_id"), F.regexp_extract("path", pattern, 2).alias("category"), F.regexp_extract("path", pattern, 3).try_cast("int").alias("number"),
        F.regexp_extract("path", pattern, 1).try_cast("int").alias("page"), F.regexp_extract("path", r"([^/]+/(?:tables|images)/[0-9]+\.png)$", 1).alias("rel_path"),
    )


def read_legacy(spark: SparkSession, path: str, doc: str = r"([^/]+)\.json$") -> DataFrame:
    """Older documents: doc_id, pos, type, id, page, bbox, content, source."""
    rows = _whole(spark, path, doc, "*.json").select("doc_id", F.posexplode(F.from_json("text", LEGACY)["kids"]).alias("pos", "k"))
    return rows.select("doc_id", "pos", *legacy_columns())


def page_range(pages: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Pages from start to end of every document, with a column ``error``.

    A start below 1 or after the end raises.  Each document is judged by its own last
    page: one that ends before ``end`` is one row with its error and no page.
    """
    if (start is not None and start < 1) or (start is not None and end is not None and start > end):
        raise ValueError(f"no such page range: {start} to {end}")
    none = F.lit(None).cast("string")
    if end is None:
        return pages.where(F.col("page") >= (start or 1)).withColumn("error", none)
    last = F.max("page").over(Window.partitionBy("doc_id"))
    known = pages.withColumn("__last", last)
    good = known.where((F.col("__last") >= end) & F.col("page").between(start or 1, end)).drop("__last").withColumn("error", none)
    said = F.concat(F.lit(f"page {end} is beyond the last page "), F.col("__last").cast("string"))
    bad = known.where(F.col("__last") < end).groupBy("doc_id").agg(F.first("__last").alias("__last"))
    return good.unionByName(bad.select("doc_id", said.alias("error")), allowMissingColumns=True)


def page_counts(pages: DataFrame) -> DataFrame:
    return pages.groupBy("doc_id").agg(F.count("*").alias("n_pages"))
