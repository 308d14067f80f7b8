"""Models outside Spark, behind plain callables.

A renderer gives (page, png, text) for a file, an extractor gives markdown for page
images.  Both run in Arrow batches of a partition; a failure becomes a row with a
status and an error, never a lost batch.  Their answers may differ from call to
call: write the result before using it twice.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import recall
from .files import LEGACY, legacy_columns
from .sinks import safe_name

#: (list of PNG bytes) -> markdown
Extractor = Callable[[list[bytes]], str]
#: bytes of a file -> [(page, png, text)]
Renderer = Callable[[bytes], list[tuple[int, bytes, str]]]
SAME_LEVEL_TEMPLATE = {"same_level_headings": ["string"]}


def render_pdf(content: bytes, dpi: int = 170) -> list[tuple[int, bytes, str]]:
    """The default renderer, where its library is installed."""
    try:
        import fitz
    except ImportError as e:
        raise RuntimeError("rendering PDF files needs the PyMuPDF package") from e
    with fitz.open(stream=content, filetype="pdf") as pdf:
        return [(i + 1, p.get_pixmap(dpi=dpi).tobytes("png"), p.get_text()) for i, p in enumerate(pdf)]


def read_pages(spark: SparkSession, path: str, renderer: Renderer = render_pdf) -> DataFrame:
    """doc_id, page, png, text, error for the pages of PDF files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select(F.regexp_extract("path", r"([^/]+)\.pdf$", 1).alias("doc_id"), "content")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for doc, content in zip(pdf["doc_id"], pdf["content"], strict=True):
                try:
                    rows = [(doc, p, png, text, None) for p, png, text in renderer(bytes(content))]
                except Exception as e:  # one bad file is one row
                    rows = [(doc, None, None, None, repr(e)[:500])]
                yield pd.DataFrame(rows, columns=["doc_id", "page", "png", "text", "error"]).astype({"page": "Int64"})

    return files.mapInPandas(scan, "doc_id string, page long, png binary, text string, error string")


#: (bytes of a PDF file, [(page, (x0, y0, x1, y1))]) -> bytes of a PDF file
Cropper = Callable[[bytes, list[tuple[int, tuple[float, float, float, float]]]], bytes]
#: bytes of a PDF file -> JSON of the older document shape
Parser = Callable[[bytes], str]


def crop_pdf(content: bytes, plan: list[tuple[int, tuple[float, float, float, float]]]) -> bytes:
    """The default cropper, where its library is installed: one page for each rectangle."""
    try:
        import fitz
    except ImportError as e:
        raise RuntimeError("cropping PDF files needs the PyMuPDF package") from e
    with fitz.open(stream=content, filetype="pdf") as pdf, fitz.open() as out:
        for page, rect in plan:
            out.insert_pdf(pdf, from_page=page - 1, to_page=page - 1)
            out[-1].set_cropbox(fitz.Rect(*rect) & out[-1].rect)
        return out.tobytes()


def crop_chapters(plan: DataFrame, pdfs: DataFrame, cropper: Cropper = crop_pdf) -> DataFrame:
    """doc_id, section, path, content, error: a cropped PDF for each chapter of a crop
    plan (:func:`quire.operators.cropping.crop_plan`).  ``pdfs``: doc_id, content.
    Errors of the plan and of the cropper, pages that the file lacks among them, are
    rows without content."""
    name = F.concat(F.col("doc_id").cast("string"), F.lit("/"), safe_name(F.col("section")), F.lit(".pdf"))
    rect = F.array(*[F.col(f"rect.{c}") for c in ("x0", "y0", "x1", "y1")])
    step = F.struct("out_ord", F.col("src_page").alias("page"), rect.alias("rect"))
    steps = plan.where("error is null").groupBy("doc_id", "section").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    met = steps.join(pdfs.select("doc_id", "content"), "doc_id", "left").withColumn("path", name)
    kind = plan.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, section, path, content, todo in zip(batch["doc_id"], batch["section"], batch["path"], batch["content"], batch["steps"], strict=True):
                try:
                    if content is None:
                        raise FileNotFoundError("no PDF file")
                    rows.append((doc, section, path, cropper(bytes(content), [(int(s["page"]), tuple(s["rect"])) for s in todo]), None))
                except Exception as e:  # one bad chapter is one row
                    rows.append((doc, section, path, None, repr(e)[:500]))
            yield pd.DataFrame(rows, columns=["doc_id", "section", "path", "content", "error"])

    made = met.select("doc_id", "section", "path", "content", "steps").mapInPandas(scan, f"doc_id {kind}, section string, path string, content binary, error string")
    failed = plan.where("error is not null").select("doc_id", "section", name.alias("path"), F.lit(None).cast("binary").alias("content"), "error")
    return made.unionByName(failed)


def parse_legacy(pdfs: DataFrame, parser: Parser) -> DataFrame:
    """doc_id, pos, type, id, page, bbox, content, source, error: PDF files (doc_id,
    content) through an older parser.  It is called once a file and a worker keeps it, so
    one that starts a process of its own can keep that running; a file that fails is one
    row with its error."""
    kind = pdfs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, content in zip(batch["doc_id"], batch["content"], strict=True):
                try:
                    rows.append((doc, parser(bytes(content)), None))
                except Exception as e:  # one bad file is one row
                    rows.append((doc, None, repr(e)[:500]))
            yield pd.DataFrame(rows, columns=["doc_id", "said", "error"])

    got = pdfs.select("doc_id", "content").mapInPandas(scan, f"doc_id {kind}, said string, error string")
    return got.select("doc_id", F.posexplode_outer(F.from_json("said", LEGACY)["kids"]).alias("pos", "k"), "error").select("doc_id", "pos", *legacy_columns(), "error")


def data_url(png: Column) -> Column:
    return F.concat(F.lit("data:image/png;base64,"), F.base64(png))


def extract_markdown(pages: DataFrame, extractor: Extractor, per_batch: int | None = 1, tries: int = 3, threshold: float = recall.THRESHOLD, pause: float = 1.0) -> DataFrame:
    """doc_id, batch_id, text, markdown, tries, error: pages in batches sent to the
    extractor, anew while too few words of the text layer come back."""
    size = per_batch if per_batch and per_batch > 0 else None
    batch = F.floor((F.col("page") - 1) / size).cast("long") if size else F.lit(0).cast("long")
    parts = pages.withColumn("batch_id", batch).groupBy("doc_id", "batch_id").agg(F.array_sort(F.collect_list(F.struct("page", "png", "text"))).alias("s"))
    text = F.array_join(F.transform(F.filter("s", lambda x: F.coalesce(x["text"], F.lit("")) != ""), lambda x: x["text"]), "\n")
    parts = parts.select("doc_id", "batch_id", text.alias("text"), F.transform("s", lambda x: x["png"]).alias("pngs"))
    kind = pages.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, b, t, pngs in zip(pdf["doc_id"], pdf["batch_id"], pdf["text"], pdf["pngs"], strict=True):
                said, error, n = None, None, 0
                for n in range(1, tries + 1):  # noqa: B007
                    try:
                        said, error = extractor([bytes(p) for p in pngs if p is not None]), None
                        if quick_recall(t, said) >= threshold:
                            break
                    except Exception as e:  # the model's fault, or the network's
                        error = repr(e)[:500]
                        time.sleep(pause)
                rows.append((doc, b, t, said, n, error))
            yield pd.DataFrame(rows, columns=["doc_id", "batch_id", "text", "markdown", "tries", "error"])

    got = parts.mapInPandas(scan, f"doc_id {kind}, batch_id long, text string, markdown string, tries int, error string")
    return got.withColumn("status", F.when(F.col("error").isNotNull(), "error").otherwise("done"))


def quick_recall(text: str, markdown: str | None) -> float:
    """Share of the text's long ASCII words that are in the markdown; the exact
    measure is :func:`recall.verify`, this one decides on another try."""
    words = lambda t: set(re.findall(r"\b[a-z]{6,}\b", (t or "").lower()))
    own = words(text)
    return len(own & words(markdown)) / len(own) if own else 1.0


def verified(extracted: DataFrame) -> DataFrame:
    """Add unique_recall, is_valid and the file each batch would be written to."""
    pairs = extracted.withColumn("__id", F.struct("doc_id", "batch_id"))
    judged = recall.verify(pairs.select(F.col("__id").alias("doc_id"), F.col("text").alias("digital_text"), F.col("markdown").alias("extracted_text")))
    met = pairs.join(judged.withColumnRenamed("doc_id", "__id"), "__id").drop("__id")
    name = F.concat(F.col("batch_id").cast("string"), F.when(F.col("is_valid"), ".md").otherwise(".failed.md"))
    return met.withColumn("file_name", name)


def same_level_prompt(anchor: str) -> str:
    return f"Find all headings at the same level as: {anchor}\nAnswer with JSON of this shape: {json.dumps(SAME_LEVEL_TEMPLATE)}"


def parse_same_level(response: Column) -> Column:
    """Headings of an answer; null if it is no such JSON."""
    return F.from_json(response, "same_level_headings array<string>")["same_level_headings"]



def convert_layout(pages: DataFrame, converter: Callable[[bytes], list[tuple[str, str | None]]]) -> DataFrame:
    """doc_id, page, ord, kind, text, error: a layout model's items of page images in
    reading order; a page that fails is one row with its error."""
    kind = pages.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, page, png in zip(pdf["doc_id"], pdf["page"], pdf["png"], strict=True):
                try:
                    rows += [(doc, page, i, k, t, None) for i, (k, t) in enumerate(converter(bytes(png)))]
                except Exception as e:  # one bad page is one row
                    rows.append((doc, page, None, None, None, repr(e)[:500]))
            yield pd.DataFrame(rows, columns=["doc_id", "page", "ord", "kind", "text", "error"]).astype({"ord": "Int64"})

    return pages.select("doc_id", F.col("page").cast("long").alias("page"), "png").mapInPandas(scan, f"doc_id {kind}, page long, ord long, kind string, text string, error string")


def same_level_headings(chapters: DataFrame, model: Callable[[str, list[bytes]], str], tries: int = 3) -> DataFrame:
    """doc_id, chapter, response, headings, status: a model's list of the headings at
    the level of ``anchor``, asked again while it is no JSON.  ``chapters``: doc_id,
    chapter, anchor, pngs."""
    kind = chapters.schema["doc_id"].dataType.simpleString()

    def valid(said: str | None) -> bool:
        try:
            return isinstance(json.loads(said or "")["same_level_headings"], list)
        except (ValueError, KeyError, TypeError):
            return False

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, chapter, anchor, pngs in zip(pdf["doc_id"], pdf["chapter"], pdf["anchor"], pdf["pngs"], strict=True):
                said = None
                for _ in range(tries):
                    try:
                        said = model(same_level_prompt(anchor), [bytes(p) for p in pngs])
                    except Exception as e:  # the model's fault, or the network's
                        said = repr(e)[:500]
                    if valid(said):
                        break
                rows.append((doc, chapter, said))
            yield pd.DataFrame(rows, columns=["doc_id", "chapter", "response"])

    got = chapters.select("doc_id", "chapter", "anchor", "pngs").mapInPandas(scan, f"doc_id {kind}, chapter string, response string")
    got = got.withColumn("headings", parse_same_level(F.col("response")))
    return got.withColumn("status", F.when(F.col("headings").isNull(), "failed").otherwise("done"))
