"""Files, sinks, connectors and streams."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quire.sources import connectors, files, sinks
from quire.streaming import pages as stream


def test_markdown_files_in_numeric_order(spark, tmp_path):
    d = tmp_path / "paper"
    d.mkdir()
    for n in ("10.md", "2.md", "x.md", "1.failed.md"):
        (d / n).write_text(f"text of {n}\n")
    got = files.read_markdown(spark, str(d)).orderBy("page").collect()
    assert [(r["doc_id"], r["page"], r["name"], r["is_failed"]) for r in got] == [("paper", 1, "1.failed.md", True), ("paper", 2, "2.md", False), ("paper", 3, "10.md", False), ("paper", 4, "x.md", False)]
    assert got[1]["text"] == "text of 2.md\n"


def test_json_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"type": "heading", "page": 1, "level": 2, "content": "X", "other": 1}, {"type": "paragraph", "page": 1, "content": "y"}]))
    got = files.read_blocks(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r["doc_id"], r["pos"], r["type"], r["level"]) for r in got] == [("a", 0, "heading", 2), ("a", 1, "paragraph", None)]
    ch = tmp_path / "chapters"
    ch.mkdir()
    for n in ("10_results", "2_methods", "other"):
        (ch / f"{n}.json").write_text(json.dumps({"document": {"title": "T", "sections": [{"heading": n, "blocks": [{"type": "paragraph", "content": "c"}]}]}}))
    got = files.read_chapters(spark, str(ch)).orderBy("chapter_ord").collect()
    assert [(r["chapter_ord"], r["section"], r["content"]) for r in got] == [(1, "2_methods", "c"), (2, "10_results", "c"), (3, "other", "c")]
    (tmp_path / "legacy").mkdir()
    (tmp_path / "legacy" / "z.json").write_text(json.dumps({"kids": [{"type": "image", "id": 3, "page number": 2, "bounding box": [1, 2, 3, 4], "source": "figures/x"}]}))
    r = files.read_legacy(spark, str(tmp_path / "legacy")).first()
    assert (r["doc_id"], r["page"], r["bbox"]) == ("z", 2, [1.0, 2.0, 3.0, 4.0])


def test_layout_pages_and_assets(spark, tmp_path):
    top = tmp_path / "paper"
    for n in (2, 10):
        (top / str(n) / "tables").mkdir(parents=True)
        (top / str(n) / f"page_{n}.json").write_text(json.dumps({"size": {"width": 600 + n}, "texts": [{"self_ref": "#/texts/0", "label": "section_header", "text": "Results", "prov": [{"page_no": n, "bbox": {"l": 1, "t": 9, "r": 5, "b": 3}}]}, {"label": "text", "text": "no box"}]}))
        (top / str(n) / "tables" / "4.png").write_bytes(b"png")
    (top / "notes").mkdir()
    (top / "notes" / "page_7.json").write_text("{}")
    (top / "2" / "page_3.json").write_text("{}")
    p = files.read_layout(spark, str(tmp_path))
    assert sorted((r["doc_id"], r["page"], r["width"]) for r in p.collect()) == [("paper", 2, 602.0), ("paper", 10, 610.0)]
    t = files.layout_texts(p).orderBy("page", "text_ord").collect()
    assert t[0]["bbox"]["t"] == 9.0 and t[1]["bbox"] is None
    assert files.layout_page(p, 10).count() == 1 and files.page_counts(p).first()["n_pages"] == 2
    assert sorted(r["rel_path"] for r in files.read_assets(spark, str(tmp_path)).collect()) == ["10/tables/4.png", "2/tables/4.png"]


def test_page_range(spark):
    p = spark.createDataFrame([(1, i) for i in range(1, 6)], "doc_id bigint, page int")
    assert files.page_range(p, 2, 4).count() == 3 and files.page_range(p).count() == 5
    for bad in ((0, 2), (4, 2)):
        with pytest.raises(ValueError):
            files.page_range(p, *bad)
    more = p.unionByName(spark.createDataFrame([(2, i) for i in range(1, 10)], "doc_id bigint, page int"))
    got = files.page_range(more, 6, 9).collect()
    assert sorted((r["doc_id"], r["page"] or 0, bool(r["error"])) for r in got) == [(1, 0, True), (2, 6, False), (2, 7, False), (2, 8, False), (2, 9, False)]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "methods", 1, "b"), (1, "methods", 0, "a"), (1, "re sults!", 0, "c")], "doc_id bigint, section string, pos int, content string")
    n = sinks.nest(rows, ["doc_id"], "section", "pos", title=F.lit("T"))
    d = {r["section"]: r["document"] for r in n.collect()}
    assert d["methods"]["title"] == "T" and [k["content"] for k in d["methods"]["sections"][0]["kids"]] == ["a", "b"]
    sinks.export_json(n, str(tmp_path / "out"), "doc_id", "section")
    assert spark.read.text(str(tmp_path / "out")).count() == 2
    names = rows.select(sinks.section_name(F.lit(0), F.lit("re sults!")), sinks.chunk_name(F.lit("!!"), F.lit(4)), sinks.image_path(F.lit("tables"), F.lit(None).cast("int"), F.lit(3))).first()
    assert tuple(names) == ("01_re_sults.json", "section_005.json", "tables/no_cap_3.png")
    assert json.loads(rows.limit(1).select(sinks.pretty_json(F.struct("content"))).first()[0]) is not None


def test_extraction_is_tried_anew_and_judged(spark):
    def _extract(pngs):
        if not pngs or pngs[0] == b"bad":
            raise RuntimeError("no answer")
        return b" ".join(pngs).decode()

    p = spark.createDataFrame([(1, 1, bytearray(b"wonderful things"), "wonderful things"), (1, 2, bytearray(b"elsewhere"), "something different"), (1, 3, bytearray(b"bad"), "x")], "doc_id bigint, page int, png binary, text string")
    got = {r["batch_id"]: r for r in connectors.extract_markdown(p, _extract, 1, tries=2, pause=0.0).collect()}
    assert (got[0]["tries"], got[1]["tries"], got[2]["status"]) == (1, 2, "error")
    v = {r["batch_id"]: r["file_name"] for r in connectors.verified(connectors.extract_markdown(p.where("page < 3"), _extract, 1, tries=1)).collect()}
    assert v == {0: "0.md", 1: "1.failed.md"}
    whole = connectors.extract_markdown(p.where("page < 3"), _extract, None, tries=1).first()
    assert whole["text"] == "wonderful things\nsomething different"


def test_renderer_failures_are_rows(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"ok")
    (tmp_path / "b.pdf").write_bytes(b"broken")

    def render(content):
        if content == b"broken":
            raise ValueError("not a PDF")
        return [(1, b"p1", "t1"), (2, b"p2", "t2")]

    got = connectors.read_pages(spark, str(tmp_path), render).orderBy("doc_id", "page").collect()
    assert [(r["doc_id"], r["page"]) for r in got] == [("a", 1), ("a", 2), ("b", None)] and "not a PDF" in got[2]["error"]
    assert connectors.read_pages(spark, str(tmp_path), render).select(connectors.data_url(F.col("png"))).where("png is not null").first()[0].startswith("data:image/png;base64,")
    assert spark.range(1).select(connectors.parse_same_level(F.lit('{"same_level_headings": ["a"]}')), connectors.parse_same_level(F.lit("oops"))).first()[:] == (["a"], None)


def test_layout_and_heading_models(spark):
    def convert(png):
        if png == b"bad":
            raise RuntimeError("model failed")
        return [("text", "Figure 1"), ("figure", None)]

    p = spark.createDataFrame([(1, 1, bytearray(b"ok")), (1, 2, bytearray(b"bad"))], "doc_id bigint, page int, png binary")
    got = connectors.convert_layout(p, convert).orderBy("page", "ord").collect()
    assert [(r["page"], r["kind"], bool(r["error"])) for r in got] == [(1, "text", False), (1, "figure", False), (2, None, True)]

    def model(prompt, pngs):
        return '{"same_level_headings": ["B", "C"]}' if "anchor A" in prompt else "no idea"

    ch = spark.createDataFrame([(1, "one", "anchor A", [bytearray(b"x")]), (1, "two", "other", [bytearray(b"x")])], "doc_id bigint, chapter string, anchor string, pngs array<binary>")
    got = {r["chapter"]: (r["headings"], r["status"]) for r in connectors.same_level_headings(ch, model).collect()}
    assert got == {"one": (["B", "C"], "done"), "two": (None, "failed")}


def test_token_counts(spark):
    from quire.functions import tokens

    df = spark.createDataFrame([("One, two three.",), (None,)], "t string")
    counters = {"pieces": tokens.count_pieces, "letters": lambda t: len(t)}
    assert [r[0] for r in df.select(tokens.token_counts(F.col("t"), counters)).collect()] == [{"pieces": 5, "letters": 15}, {"pieces": 0, "letters": 0}]


def test_streams(spark, tmp_path):
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    schema = "doc_id bigint, page int, text string"
    spark.createDataFrame([(1, 1, "# A\n\n-----"), (2, 1, "x")], schema).write.parquet(source)
    df = spark.readStream.schema(schema).parquet(source)
    q = stream.line_blocks(df).writeStream.format("memory").queryName("seen_blocks").start()
    q.processAllAvailable()
    q.stop()
    assert {(r["type"], r["is_noise"]) for r in spark.table("seen_blocks").collect()} == {("heading", True), ("paragraph", True), ("paragraph", False)} or spark.table("seen_blocks").count() == 3
    counts = []
    q = stream.on_documents(df, store, lambda d, n: counts.append((n, d.count())), str(tmp_path / "cp"))
    q.processAllAvailable()
    spark.createDataFrame([(1, 2, "more")], schema).write.mode("append").parquet(source)
    q.processAllAvailable()
    q.stop()
    assert counts == [(0, 2), (1, 2)]
    assert all("/bucket=" in f for f in spark.read.parquet(store).inputFiles())


def test_files_of_sections_chunks_chapters_and_pages(spark, tmp_path):
    rows = spark.createDataFrame([("d", "methods", 1, 0, "b é"), ("d", "methods", 1, 1, "a"), ("d", "re sults!", 2, 0, "c")], "doc_id string, section string, section_ord int, pos int, content string")
    n = sinks.nest(rows.withColumnRenamed("section_ord", "k"), ["doc_id", "k"], "section", "pos", title=F.lit("T"))
    root = str(tmp_path / "out")
    assert sinks.write_files(sinks.section_files(n, "k"), root)[0] == 2
    said = (tmp_path / "out" / "d" / "02_methods.json").read_text()
    assert said == json.dumps({"document": {"title": "T", "sections": [{"heading": "methods", "kids": [{"content": "b é"}, {"content": "a"}]}]}}, indent=2, ensure_ascii=False)
    assert sinks.write_files(sinks.chunk_files(n, "k"), f"file://{root}")[0] == 2 and (tmp_path / "out" / "d" / "re_sults_003.json").exists()
    assert sinks.write_files(sinks.chapter_files(n.withColumn("stem", F.lit("07_x")).where("k = 1")), root)[0] == 1
    assert files.read_chapters(spark, f"{root}/d").where("stem = '07_x'").count() == 2
    pages = spark.createDataFrame([("d", "0.md", "text ü"), ("d", "1.failed.md", "bad"), ("d", "2.failed.md", None), ("d", "3.failed.md", "")], "doc_id string, file_name string, markdown string")
    assert sinks.write_files(sinks.page_files(pages), root) == (2, 10)
    assert (tmp_path / "out" / "d" / "0.md").read_text() == "text ü" and not (tmp_path / "out" / "d" / "2.failed.md").exists()
    assert not [f for f in (tmp_path / "out" / "d").iterdir() if f.name.startswith(".")]
    with pytest.raises(Exception, match="outside"):
        sinks.write_files(spark.createDataFrame([("../x", "y")], "path string, content string"), root)
    assert sinks.write_files(pages.select(F.col("file_name").alias("path"), F.col("markdown").alias("content")).limit(0), root) == (0, 0)


def test_layout_pages_are_written_and_read_back(spark, tmp_path):
    top = tmp_path / "in" / "paper" / "3"
    top.mkdir(parents=True)
    (top / "page_3.json").write_text(json.dumps({"size": {"width": 600}, "texts": [{"self_ref": "#/texts/0", "label": "text", "text": "x"}]}))
    p = files.read_layout(spark, str(tmp_path / "in"))
    assert sinks.write_files(sinks.layout_files(p), str(tmp_path / "out"))[0] == 1
    assert files.read_layout(spark, str(tmp_path / "out")).collect() == p.collect()


def _png(kind, pixels, filters):
    """A PNG of colour type ``kind`` with the given line filters, made by the rules of the format."""
    import struct
    import zlib

    height, width, channels = pixels.shape
    data, up = b"", [0] * (width * channels)
    for y in range(height):
        line = [int(v) for v in pixels[y].reshape(-1)]
        out = []
        for x, v in enumerate(line):
            a, b, c = (line[x - channels] if x >= channels else 0), up[x], (up[x - channels] if x >= channels else 0)
            guess = a + b - c
            paeth = min(((abs(guess - q), i, q) for i, q in enumerate((a, b, c))))[2]
            out.append((v - (0, a, b, (a + b) // 2, paeth)[filters[y % len(filters)]]) % 256)
        data += bytes([filters[y % len(filters)], *out])
        up = line
    part = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    palette = part(b"PLTE", bytes(range(256)) * 3) if kind == 3 else b""
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)) + palette + part(b"IDAT", zlib.compress(data)) + part(b"IEND", b"")


def test_png_images():
    import numpy as np

    from quire.functions import png

    r = np.random.default_rng(3)
    for kind, channels in ((0, 1), (2, 3), (4, 2), (6, 4), (3, 1)):
        px = r.integers(0, 256, (11, 7, channels), dtype=np.uint8)
        if kind in (4, 6):
            px[..., -1] = 255
        got = png.decode(_png(kind, px, [0, 1, 2, 3, 4]))
        want = px if kind == 2 else px[..., :3] if kind == 6 else np.array([[3 * v % 256, (3 * v + 1) % 256, (3 * v + 2) % 256] for v in px.reshape(-1).tolist()]).reshape(11, 7, 3) if kind == 3 else np.repeat(px[..., :1], 3, axis=2)
        assert (got == want).all(), kind
        assert (png.decode(png.encode(got)) == got).all()
    a, b = np.zeros((4, 3, 3), np.uint8), np.full((2, 5, 3), 9, np.uint8)
    flat, tall = png.stitch(a, b, "horizontal"), png.stitch(b, a, "vertical")
    assert flat.shape == (4, 8, 3) and (flat[2:, 3:] == 255).all() and (flat[:2, 3:] == 9).all()
    assert tall.shape == (6, 5, 3) and (tall[2:, :3] == 0).all() and (tall[2:, 3:] == 255).all()
    assert png.crop(flat, (1.5, 0, 4, 1), 2).shape == (2, 5, 3)
    assert (png.outline(b, (0, 0, 5, 2), line=1)[0, 0] == [255, 0, 0]).all()
    for bad in (lambda: png.decode(b"x"), lambda: png.crop(a, (9, 9, 12, 12)), lambda: png.stitch(a, b, "slanted")):
        with pytest.raises(ValueError):
            bad()


def test_image_files(spark, tmp_path):
    import numpy as np

    from quire.functions import png
    from quire.operators import legacy, pictures

    dot = lambda w, h, v: bytearray(png.encode(np.full((h, w, 3), v, np.uint8)))
    box = "struct<l:double,t:double,r:double,b:double>"
    pics = spark.createDataFrame([("d", 1, 0, (0.0, 9.0, 5.0, 0.0), 20, 30, dot(20, 30, 7)), ("d", 1, 1, (6.0, 9.0, 9.0, 0.0), 10, 25, dot(10, 25, 8))], f"doc_id string, page int, ord int, bbox {box}, width int, height int, png binary")
    partners = spark.createDataFrame([("d", 1, 1, 0, 4, "horizontal")], "doc_id string, page int, ord int, target_ord int, target_number int, orientation string")
    made = sinks.stitched_images(pictures.stitch_plan(partners, pics), pics)
    assert sinks.write_files(sinks.image_files(made), str(tmp_path))[0] == 1
    px = png.decode((tmp_path / "d" / "1" / "images" / "4.png").read_bytes())
    assert px.shape == (30, 30, 3) and px[0, 0, 0] == 7 and px[0, 29, 0] == 8 and px[29, 29, 0] == 255

    page = np.zeros((200, 100, 3), np.uint8)
    page[20:40, 10:60] = 200  # 10 to 20 points from the top, 5 to 30 from the left
    pages = spark.createDataFrame([("d", 2, bytearray(png.encode(page)))], "doc_id string, page int, png binary")
    kids = spark.createDataFrame([("d", 0, "table", 3, 2, [5.0, 80.0, 30.0, 90.0], None, None), ("d", 1, "table", None, 2, [0.0, 0.0, 9.0, 9.0], None, None), ("d", 2, "table", 4, 2, [70.0, 0.0, 70.0, 5.0], None, None)], "doc_id string, pos int, type string, id bigint, page int, bbox array<double>, content string, source string")
    cut = legacy.tables_to_images(kids, spark.createDataFrame([("d", 2, 100.0)], "doc_id string, page int, page_height double"))
    tables = {r["file"]: r["png"] for r in sinks.table_images(cut, pages, 2.0).collect()}
    assert set(tables) == {"figures/table_3.png", "figures/table_4.png"} and tables["figures/table_4.png"] is None
    assert png.decode(bytes(tables["figures/table_3.png"])).shape == (20, 50, 3) and (png.decode(bytes(tables["figures/table_3.png"])) == 200).all()
    seen = pages.select(sinks.outlined("png", F.array(F.array(*map(F.lit, (5.0, 10.0, 30.0, 20.0)))), F.lit(2.0))).first()[0]
    assert (png.decode(bytes(seen))[20, 10] == [255, 0, 0]).all()


def test_chapters_are_cropped(spark):
    from quire.operators import cropping

    box = "struct<l:double,t:double,r:double,b:double>"
    full = lambda t: (0.0, t, 590.0, t - 10)
    rows = [("a", "one", 600.0, 800.0, 1, full(700.0), 3, full(300.0)), ("a", "two", 600.0, 800.0, 3, full(300.0), 3, None), ("b", "one", 600.0, 800.0, 1, full(700.0), 9, full(300.0)), ("c", "one", 600.0, 800.0, 1, full(700.0), 1, full(300.0))]
    plan = cropping.crop_plan(spark.createDataFrame(rows, f"doc_id string, section string, page_w double, page_h double, start_page int, start_bbox {box}, end_page int, end_bbox {box}"))

    def crop(content, todo):
        if any(page > 3 for page, _ in todo):
            raise ValueError("no such page")
        return content + repr([p for p, _ in todo]).encode()

    pdfs = spark.createDataFrame([("a", bytearray(b"A")), ("b", bytearray(b"B"))], "doc_id string, content binary")
    got = {(r["doc_id"], r["section"]): r for r in connectors.crop_chapters(plan, pdfs, crop).collect()}
    assert bytes(got["a", "one"]["content"]) == b"A[1, 2, 3]" and got["a", "one"]["path"] == "a/one.pdf" and got["a", "one"]["error"] is None
    assert "missing" in got["a", "two"]["error"] and "no such page" in got["b", "one"]["error"] and "no PDF" in got["c", "one"]["error"]


def test_an_older_parser(spark):
    def parse(content):
        if content == b"bad":
            raise RuntimeError("parser failed")
        return json.dumps({"kids": [{"type": "image", "id": 3, "page number": 2, "bounding box": [1, 2, 3, 4], "source": "figures/x"}, {"type": "paragraph", "content": "p"}]})

    got = connectors.parse_legacy(spark.createDataFrame([(1, bytearray(b"ok")), (2, bytearray(b"bad"))], "doc_id bigint, content binary"), parse).orderBy("doc_id", "pos").collect()
    assert [(r["doc_id"], r["pos"], r["type"], r["page"], bool(r["error"])) for r in got] == [(1, 0, "image", 2, False), (1, 1, "paragraph", None, False), (2, None, None, None, True)]


def test_public_tokenizers(spark):
    from pathlib import Path

    from quire.functions import tokens

    folder = Path("/opt/tokenizers")
    names = [n for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model") if (folder / n).exists()]
    if not names:
        pytest.skip("no tokenizer files")
    df = spark.createDataFrame([("One, two three.",), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(tokens.token_counts(F.col("t"), {n: tokens.from_file(str(folder / n)) for n in names})).collect()]
    assert all(3 <= got[0][n] <= 8 for n in names) and got[1] == got[2] == dict.fromkeys(names, 0)


def test_requested_chapters(spark):
    from quire.operators import headings

    ch = spark.createDataFrame([(1, "02_methods"), (1, "03_results"), (2, "01_methods")], "doc_id bigint, stem string")
    b = spark.createDataFrame([(1, "02_methods", "heading"), (1, "02_methods", "paragraph"), (2, "01_methods", "paragraph")], "doc_id bigint, stem string, type string")
    got = {(r["doc_id"], r["requested"]): (r["stem"], r["n_headings"], r["error"]) for r in headings.requested_chapters(ch, b, ["Methods", "discussion"]).collect()}
    assert got == {(1, "Methods"): ("02_methods", 1, None), (1, "discussion"): (None, 0, "no chapter file"), (2, "Methods"): ("01_methods", 0, "no headings"), (2, "discussion"): (None, 0, "no chapter file")}
