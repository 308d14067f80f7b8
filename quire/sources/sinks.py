"""What leaves the engine: nested documents, file names, files.

Tables are written as Parquet; JSON, markdown and images are for export.  What is to
be a file is a row (``path``, ``content``), so that one job writes all of a corpus:
``write_files`` puts every row under a folder that the workers share.  ``export_json``
makes lines instead.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from ..functions import png


def safe_name(c: Column, empty: str = "section") -> Column:
    name = F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9_-]+", "_"), r"^_+|_+\z", "")
    return F.when(F.coalesce(name, F.lit("")) == "", empty).otherwise(name)


def section_name(order: Column, section: Column) -> Column:
    return F.concat(F.lpad((order + 1).cast("string"), 2, "0"), F.lit("_"), safe_name(section), F.lit(".json"))


def chunk_name(heading: Column, number: Column) -> Column:
    return F.concat(safe_name(heading), F.lit("_"), F.lpad((number + 1).cast("string"), 3, "0"), F.lit(".json"))


def nest(rows: DataFrame, keys: list[str], heading: str, order: str, title: Column | None = None, source: Column | None = None) -> DataFrame:
    """One row for each key: document struct(title, source, sections[heading, kids])."""
    skip = {*keys, heading, order, "__title", "__source"}
    kid = F.struct(order, *[c for c in rows.columns if c not in skip])
    df = rows.withColumns({"__title": title if title is not None else F.lit(None).cast("string"), "__source": source if source is not None else F.lit(None).cast("string")})
    grouped = df.groupBy(*keys, heading).agg(F.array_sort(F.collect_list(kid)).alias("kids"), F.first("__title").alias("__title"), F.first("__source").alias("__source"))
    section = F.struct(F.col(heading).alias("heading"), F.transform("kids", lambda k: k.dropFields(order)).alias("kids"))
    return grouped.select(*keys, heading, F.struct(F.col("__title").alias("title"), F.col("__source").alias("source"), F.array(section).alias("sections")).alias("document"))


def pretty_json(c: Column) -> Column:
    return F.to_json(c, {"pretty": "true"})


def export_json(nested: DataFrame, path: str, *keys: str) -> None:
    """Documents as JSON lines, in folders by ``keys``."""
    out = nested.select(*keys, F.to_json(F.struct("document")).alias("value"))
    (out.write.partitionBy(*keys) if keys else out.write).text(path)


def image_path(kind: Column, identifier: Column, counter: Column) -> Column:
    """``tables/<id>.png`` or ``images/<id>.png``; without an id, no_cap_<counter>."""
    return F.concat(kind, F.lit("/"), F.coalesce(identifier.cast("string"), F.concat(F.lit("no_cap_"), counter.cast("string"))), F.lit(".png"))


def write_files(files: DataFrame, root: str) -> tuple[int, int]:
    """Write every row's ``content`` (text or bytes) to its ``path`` under ``root``, a
    folder or URI that workers share; returns the numbers of files and bytes.

    A file is written under another name first and then moved, so a task that is run
    again leaves whole files.  Rows without content are passed over; paths that lead
    out of ``root`` raise.  Paths should be distinct: of rows with equal ones any wins.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import posixpath
        import uuid

        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
        made: set[str] = set()
        for batch in batches:
            n = size = 0
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                raw = content.as_py()
                if raw is None or path is None:
                    continue
                if path.startswith("/") or ".." in path.split("/"):
                    raise ValueError(f"a path outside the folder: {path}")
                place = posixpath.join(top, path)
                if (folder := posixpath.dirname(place)) not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                part = f"{folder}/.{uuid.uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write(raw)
                store.move(part, place)
                n, size = n + 1, size + len(raw)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([size], pa.int64())], ["n", "size"])

    done = files.select("path", F.col("content").cast("binary").alias("content")).mapInArrow(scan, "n long, size long")
    return tuple(done.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first())


@F.pandas_udf(StringType())
def indented(text: pd.Series) -> pd.Series:
    """JSON with an indent of two, all letters as they are."""
    return text.map(lambda t: None if t is None else json.dumps(json.loads(t), indent=2, ensure_ascii=False))


def document_files(nested: DataFrame, path: Column) -> DataFrame:
    """Nested documents as pretty JSON files."""
    return nested.select(path.alias("path"), indented(F.to_json(F.struct("document"))).alias("content"))


def _folder(doc: str = "doc_id") -> Column:
    return F.concat(F.col(doc).cast("string"), F.lit("/"))


def section_files(nested: DataFrame, order: str = "section_ord", section: str = "section") -> DataFrame:
    """``<doc_id>/NN_<section>.json`` for each section of :func:`nest`."""
    return document_files(nested, F.concat(_folder(), section_name(F.col(order), F.col(section))))


def chunk_files(nested: DataFrame, number: str = "chunk_no", section: str = "section") -> DataFrame:
    """``<doc_id>/<section>_NNN.json`` for each chunk of :func:`nest`."""
    return document_files(nested, F.concat(_folder(), chunk_name(F.col(section), F.col(number))))


def chapter_files(nested: DataFrame, stem: str = "stem") -> DataFrame:
    """``<doc_id>/<stem>.json``: adjusted chapters, in a folder of their own or, if that
    is where they came from, in place."""
    return document_files(nested, F.concat(_folder(), F.col(stem), F.lit(".json")))


def page_files(verified: DataFrame) -> DataFrame:
    """``<doc_id>/<n>.md``, or ``.failed.md`` for what did not verify; nothing for
    pages without an answer."""
    said = F.when(F.length("markdown") > 0, F.col("markdown"))
    return verified.select(F.concat(_folder(), F.col("file_name")).alias("path"), said.alias("content"))


def layout_files(pages: DataFrame) -> DataFrame:
    """``<doc_id>/<page>/page_<page>.json`` for layout pages (doc_id, page, layout)."""
    page = F.col("page").cast("string")
    return pages.select(F.concat(_folder(), page, F.lit("/page_"), page, F.lit(".json")).alias("path"), indented(F.to_json("layout")).alias("content"))


def image_files(images: DataFrame) -> DataFrame:
    """``<doc_id>/<page>/<file>`` for rows (doc_id, page, file, png): tables, pictures
    and stitched pictures, named by :func:`image_path`."""
    return images.select(F.concat(_folder(), F.col("page").cast("string"), F.lit("/"), F.col("file")).alias("path"), F.col("png").alias("content"))


@F.pandas_udf(BinaryType())
def cropped(image: pd.Series, x0: pd.Series, y0: pd.Series, x1: pd.Series, y1: pd.Series, scale: pd.Series) -> pd.Series:
    """The part of a page's PNG in a rectangle from the top left; null where there is
    none."""

    def cut(row: tuple) -> bytes | None:
        if any(v is None or v != v for v in row):
            return None
        try:
            return png.encode(png.crop(png.decode(bytes(row[0])), row[1:5], row[5]))
        except ValueError:
            return None

    return pd.Series([cut(r) for r in zip(image, x0, y0, x1, y1, scale, strict=True)], dtype=object)


@F.pandas_udf(BinaryType())
def stitched(first: pd.Series, second: pd.Series, orientation: pd.Series) -> pd.Series:
    """Two PNGs on one white canvas."""
    both = lambda a, b, way: None if a is None or b is None else png.encode(png.stitch(png.decode(bytes(a)), png.decode(bytes(b)), way))
    return pd.Series([both(*r) for r in zip(first, second, orientation, strict=True)], dtype=object)


def stitched_images(plan: DataFrame, pictures: DataFrame) -> DataFrame:
    """doc_id, page, file, png for a stitch plan and pictures with ``png``."""
    key = ["doc_id", "page"]
    png_of = lambda name, ord_: pictures.select(*key, F.col("ord").alias(ord_), F.col("png").alias(name))
    other = F.when(F.col("first_ord") == F.col("ord"), F.col("target_ord")).otherwise(F.col("ord"))
    met = plan.withColumn("second_ord", other).join(png_of("a", "first_ord"), [*key, "first_ord"]).join(png_of("b", "second_ord"), [*key, "second_ord"])
    return met.select(*key, image_path(F.lit("images"), F.col("target_number"), F.col("target_ord")).alias("file"), stitched("a", "b", "orientation").alias("png"))


def table_images(tables: DataFrame, pages: DataFrame, scale: Column | float = 1.0) -> DataFrame:
    """doc_id, page, file, png: tables (doc_id, page, source, crop as four numbers from
    the top left) cut from page images (doc_id, page, png) of ``scale`` pixels a point."""
    x = [F.col("crop")[i].cast("double") for i in range(4)]
    size = scale if isinstance(scale, Column) else F.lit(float(scale))
    met = tables.where("crop is not null").join(pages.select("doc_id", "page", "png"), ["doc_id", "page"])
    return met.select("doc_id", "page", F.col("source").alias("file"), cropped("png", *x, size).alias("png"))


@F.pandas_udf(BinaryType())
def outlined(image: pd.Series, boxes: pd.Series, scale: pd.Series) -> pd.Series:
    """A page's PNG with the frames of boxes (arrays of four numbers from the top left)
    drawn, to see what a layout model found."""

    def draw(raw, rects, size) -> bytes | None:
        if raw is None:
            return None
        px = png.decode(bytes(raw))
        for r in () if rects is None else rects:
            px = png.outline(px, tuple(r), size)
        return png.encode(px)

    return pd.Series([draw(*r) for r in zip(image, boxes, scale, strict=True)], dtype=object)
