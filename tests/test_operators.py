"""Operators on small tables, and closed forms against plain loops."""

from __future__ import annotations

import html
import random
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.functions.frames import keyed
from quire.operators import assets, blocks, chunking, cleanup, headings, legacy, pictures, recall, sections
from quire.plans.pipeline import Papers

BLOCKS = "doc_id bigint, pos int, page int, type string, level int, content string"


def test_title_moves_to_the_front(spark):
    rows = [(1, 0, 1, "paragraph", None, "x"), (1, 1, 1, "heading", 1, "Too short"), (1, 2, 1, "heading", 1, "A long enough one"), (1, 3, 2, "heading", 1, "Another long heading here")]
    got = blocks.promote_title(spark.createDataFrame(rows, BLOCKS)).orderBy("pos").collect()
    assert [(r["type"], r["content"]) for r in got][:2] == [("title", "A long enough one"), ("paragraph", "x")]
    assert got[0]["level"] is None and got[3]["type"] == "heading"


def test_pairs_merge_greedily(spark):
    r = random.Random(1)
    docs, want = [], {}
    for d in range(60):
        n = r.randint(1, 14)
        ends, starts = [r.random() < 0.7 for _ in range(n)], [r.random() < 0.7 for _ in range(n)]
        text = [f"{'low' if starts[i] else 'Up'} {i} " + "w " * 12 + ("open" if ends[i] else "shut.") for i in range(n)]
        kinds = ["heading" if r.random() < 0.2 else "paragraph" for _ in range(n)]
        docs += [(d, i, i // 4 + 1, kinds[i], None, text[i]) for i in range(n)]
        simple = [i for i in range(n) if kinds[i] == "paragraph"]
        out, k = {i: text[i] for i in range(n)}, 0
        while k < len(simple):
            if k + 1 < len(simple) and ends[simple[k]] and starts[simple[k + 1]]:
                out[simple[k]] = text[simple[k]].rstrip() + " " + text[simple[k + 1]]
                del out[simple[k + 1]]
                k += 1
            k += 1
        want |= {(d, i): t for i, t in out.items()}
    got = cleanup.merge_paragraphs(spark.createDataFrame(docs, BLOCKS)).collect()
    assert {(x["doc_id"], x["pos"]): x["content"] for x in got} == want


def test_running_heads_leave_page_edges(spark):
    kinds = "pphpppp"
    rows = [(1, i, 2, {"p": "paragraph", "h": "heading"}[k], None, f"{i} Smith") for i, k in enumerate(kinds)]
    got = {r["pos"] for r in cleanup.drop_running_heads(spark.createDataFrame(rows, BLOCKS)).collect()}
    assert got == {2, 3}


def test_a_task_of_merging_does_not_grow_with_the_table(spark, tmp_path):
    def table(n):
        text = F.concat(F.lit("Open "), F.expr("array_join(transform(sequence(1, 20), i -> sha2(concat(id, ' ', i), 256)), ' ')"), F.lit(" and"))
        rows = spark.range(n).select((F.col("id") % 500).alias("doc_id"), F.lit(1).alias("page"), F.col("id").alias("n"), F.lit("paragraph").alias("type"), F.lit(None).cast("int").alias("level"), text.alias("content"))
        rows.write.parquet(f"{tmp_path}/{n}")
        return spark.read.parquet(f"{tmp_path}/{n}")

    small, large = table(20_000), table(80_000)
    dealt = [keyed(df, "doc_id", mb=1).rdd.getNumPartitions() for df in (small, large)]
    assert dealt[0] > 4 and 3.5 < dealt[1] / dealt[0] < 4.5
    cleaned = cleanup.clean(blocks.number_blocks(large, "page", "n"))
    assert cleaned.rdd.getNumPartitions() >= -(-sum(f.stat().st_size for f in (tmp_path / "80000").glob("*.parquet")) // (8 << 20)) > 4
    plan = cleaned._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("- Sort [") <= 3 and plan.count("Exchange hashpartitioning") == 1


def test_weak_levels(spark):
    def run(*items):
        rows = [(1, i, 1, "heading" if k == "h" else "paragraph", v, "H" if k == "h" else "**W**") for i, (k, v) in enumerate(items)]
        got = headings.weak_levels(spark.createDataFrame(rows, BLOCKS)).orderBy("pos").collect()
        return [r["level"] for r in got if r["converted_from"]]

    assert run(("h", 2), ("w", None), ("w", None), ("h", None), ("w", None)) == [1, 1, 1]
    assert run(("h", 1), ("w", None)) == [0]
    assert run(("w", None)) == [1]
    assert run(("h", 4), ("w", None), ("w", None)) == [3, 3]


def test_page_reset_levels(spark):
    items = [("heading", 1, "Methods"), ("heading", 1, "A"), ("heading", 3, "B"), ("paragraph", None, "**w** x"), ("paragraph", None, "**w** y"), ("heading", 2, "C")]
    rows = [(1, i, 1, k, v, c, "methods") for i, (k, v, c) in enumerate(items)]
    got = headings.page_reset_levels(spark.createDataFrame(rows, BLOCKS + ", section string")).orderBy("pos").collect()
    assert [(r["pos"], r["assigned_level"]) for r in got] == [(1, 2), (2, 3), (3, 4), (4, 4), (5, 3)]


@pytest.mark.parametrize(("starts", "want"), [
    ([(3, "Abstract"), (9, "Introduction"), (20, "Methods"), (40, "Results"), (60, "Discussion"), (80, "References")], ["abstract", "introduction", "methods", "results", "discussion", "references"]),
    ([(2, "Abstract"), (5, "Results"), (10, "Introduction"), (20, "Methods"), (30, "Results")], ["abstract", "introduction", "methods", "results"]),
    ([(1, "Introduction"), (9, "Results")], ["introduction"]), ([(1, "Introduction"), (5, "Methods"), (7, "Abstract"), (9, "Results")], ["introduction", "methods", "abstract"]),
    ([], ["abstract"]), ([(4, "Abstract"), (20, "Methods")], ["abstract", "introduction", "methods"]),
])
def test_sections(spark, starts, want):
    said = dict(starts)
    rows = [(1, i, 1, "heading" if i in said else "paragraph", 1 if i in said else None, said.get(i, "text")) for i in range(90)]
    df = spark.createDataFrame(rows, BLOCKS)
    got = sections.section_starts(df).orderBy("section_ord").collect()
    assert [r["section"] for r in got] == want
    split = sections.split_sections(df)
    assert split.count() == 90 - (got[0]["start_pos"] if got else 0)
    assert sections.document_title(df.withColumn("stem", F.lit("file")), "stem").first()["title"] == "file"


def test_heading_boxes_and_ends(spark):
    box = lambda t: (0.0, t, 100.0, t - 10)
    layout = spark.createDataFrame([(1, 4, 0, "section_header", "Results", box(700.0)), (1, 6, 1, "section_header", "Results", box(780.0)), (1, 2, 2, "section_header", "Methods", box(500.0)), (1, 2, 3, "text", "Methods", box(1.0))], "doc_id bigint, page int, text_ord int, label string, text string, bbox struct<l:double,t:double,r:double,b:double>")
    lay = headings.layout_order(layout)
    rows = [(1, 0, 2, "Methods", 1), (1, 5, 6, "**Results**", 2), (1, 9, 6, "Unknown", 2)]
    got = headings.match_boxes(spark.createDataFrame(rows, "doc_id bigint, pos int, page int, content string, chapter_ord int"), lay)
    assert [(r["pos"], r["bbox_page"]) for r in got.orderBy("pos").collect()] == [(0, 2), (5, 6), (9, None)]
    ends = headings.section_ends(got, lay, spark.createDataFrame([(1, 6, 600.0)], "doc_id bigint, page int, width double")).orderBy("pos").collect()
    assert [(r["section_end_page"], r["section_end_bbox"] and r["section_end_bbox"]["t"]) for r in ends] == [(4, 700.0), (6, None), (6, 0.0)]
    assert ends[2]["section_end_bbox"]["r"] == 600.0


def test_assets(spark):
    paths = ["d/8/tables/4.png", "d/9/tables/4.png", "d/3/images/no_cap_1.png", "d/3/images/2.png", "d/3/other/2.png", "d/a/b/images/1.png"]
    from quire.sources import files

    found = files.parse_assets(spark.createDataFrame([(p,) for p in paths], "path string"), r"^([^/]+)/").withColumn("doc_id", F.lit(1).cast("bigint"))
    assert {(r["category"], r["number"], r["rel_path"]) for r in assets.latest_assets(found).collect()} == {("tables", 4, "9/tables/4.png"), ("images", 2, "3/images/2.png")}
    rows = [(1, 0, 1, "paragraph", None, "Fig. 2: x"), (1, 1, 1, "figure", None, '<img src="q" alt="Alt">'), (1, 2, 1, "list", None, "- Fig. 2"), (1, 3, 1, "figure", None, "<figure></figure>")]
    got = assets.join_assets(spark.createDataFrame(rows, BLOCKS), found).orderBy("pos").collect()
    assert (got[1]["content"], got[1]["caption"], got[1]["alt_text"]) == ("3/images/2.png", "Fig. 2: x", "Alt")
    assert not got[3]["matched"] and got[3]["content"] == "<figure></figure>"


def test_caption_beyond_bounds_is_refused(spark):
    p = spark.createDataFrame([(1, 1, 0, (100.0, 500.0, 300.0, 300.0))], "doc_id bigint, page int, ord int, bbox struct<l:double,t:double,r:double,b:double>")
    cap = lambda t: spark.createDataFrame([(1, 1, 0, 7, "Figure 7", (100.0, t, 300.0, t - 20), False)], "doc_id bigint, page int, ord int, number int, text string, bbox struct<l:double,t:double,r:double,b:double>, used boolean")
    r = pictures.nearest_captions(p, cap(290.0)).first()
    assert (r["placement"], r["score"]) == ("below", 28.0)
    assert pictures.nearest_captions(p, cap(170.0)).count() == 0


def test_older_documents(spark):
    rows = [(1, 0, "image", 1, 1, [0.0, 0.0, 100.0, 100.0], None, "figures/a.png"), (1, 1, "paragraph", None, 1, [10.0, 10.0, 50.0, 50.0], "inside", None), (1, 2, "paragraph", None, 1, [200.0, 0.0, 300.0, 50.0], "Figure 1 here", None), (1, 3, "image", 5, 1, [0.0, 0.0, 1.0, 1.0], None, "figures/a.png"), (1, 4, "table", 9, 1, [0.0, 10.0, 5.0, 30.0], "t", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, pos int, type string, id bigint, page int, bbox array<double>, content string, source string")
    heights = spark.createDataFrame([(1, 1, 100.0)], "doc_id bigint, page int, page_height double")
    crop = legacy.tables_to_images(df, heights).where("pos = 4").first()
    assert crop["type"] == "image" and crop["crop"] == [0.0, 70.0, 5.0, 90.0]
    got = legacy.clean_legacy(df, heights).orderBy("pos").collect()
    assert [(r["type"], r["source"] or r["content"]) for r in got] == [("image", "figures/a.png"), ("paragraph", "Figure 1 here"), ("image", "figures/table_9.png")]


CHUNK = "doc_id bigint, section string, pos int, type string, level int, content string, tok int"


def _chunks(spark, items):
    rows = [(1, "s", i, k, v, f"{k} {i}", t) for i, (k, v, t) in enumerate(items)]
    got = chunking.build_chunks(spark.createDataFrame(rows, CHUNK), 10, 0.1).orderBy("chunk_no", "ord").collect()
    out: dict = {}
    for r in got:
        out.setdefault(r["chunk_no"], []).append(r["pos"])
    return list(out.values())


def test_chunk_cases(spark):
    p = lambda t: ("paragraph", None, t)
    assert _chunks(spark, [("heading", 1, 2), p(5), ("heading", 2, 2), ("figure", None, 4), p(6), ("list", None, 3), p(9)]) == [[0, 1], [0, 2, 4, 5], [0, 2, 6]]
    assert _chunks(spark, [p(8), ("list", None, 5), p(4), p(9)]) == [[0], [2, 1, 2], [3]]
    assert _chunks(spark, [p(50)]) == [[0]]


def test_chunks_against_a_loop(spark):
    r = random.Random(9)
    rows, want = [], {}
    for d in range(80):
        n = r.randint(1, 25)
        seq = [(r.choice(["paragraph", "paragraph", "heading", "figure", "list"]), r.randint(1, 4), r.randint(0, 9)) for _ in range(n)]
        rows += [(d, "s", i, k, v, "c", t) for i, (k, v, t) in enumerate(seq)]
        cur, chunk, have = 0, 0, False
        for i, (k, _, t) in enumerate(seq):
            if k == "figure":
                continue
            full = have and cur + t > 22
            if k == "heading" and i < n - 1:
                j = i + 1
                while j < n - 1 and seq[j][0] == "heading":
                    j += 1
                full = have and cur + sum(x[2] for x in seq[i : j + 1]) >= 22
            if full:
                cur, chunk = 0, chunk + 1
            cur, have = cur + t, True
            want[d, i] = chunk
    got = {(x["doc_id"], x["pos"]): x["chunk_no"] for x in chunking.assign_chunks(spark.createDataFrame(rows, CHUNK), 20, 0.1).collect()}
    assert got == want


def test_recall(spark):
    pairs = spark.createDataFrame([(1, "alphas alphas betass gammas", "alphas betass deltas"), (2, " ", None), (3, "abc def", "")], "doc_id bigint, digital_text string, extracted_text string")
    got = {r["doc_id"]: r for r in recall.verify(pairs).collect()}
    assert got[1]["unique_recall"] == pytest.approx(2 / 3) and not got[1]["is_valid"] and got[1]["missing"] == ["gammas"]
    assert got[2]["is_valid"] and got[3]["unique_recall"] == 1.0
    assert {r["doc_id"]: r["count_recall"] for r in recall.count_recall(pairs).collect()}[1] == 0.5


def odd_pairs():
    """Pairs of texts, and the words of both by the rules written out one after the other."""

    def words(t, digital):
        t = unicodedata.normalize("NFKC", html.unescape(t).lower()).replace("\u00ad", "")
        for a, b in zip("–—−“”", '---""', strict=True):
            t = t.replace(a, b)
        t = re.sub(r"\\[a-zA-Z]+", " ", re.sub(r"\$[^$]*\$", " ", t)).replace("$", " ")
        t = re.sub(r"<[^>]+>", " ", re.sub(r'<img\b[^>]*\balt="([^"]*)"[^>]*>', r" \1 ", t))
        bad = lambda x: x == "springer" or x.startswith(("https://doi.org/", "received:", "© the author")) or "published online:" in x or "extended author information available on the last page of the article" in x
        t = "\n".join(x.strip() for x in t.splitlines() if not bad(x.strip().lower()))
        t = re.sub(r"([a-z]{2,})-\s*\n\s*([a-z]{2,})", r"\1\2", t) if digital else t
        return re.findall(r"\b[a-z]{6,}\b", re.sub(r"\s+", " ", t).replace("-", " "))

    r = random.Random(5)
    parts = ["alphas", "betass", "multi-\n", "centric", "ab-\r\n\x0b", "cd-\n", "\n", "\x1c", "Received: 1", "springer", "\n© The Authors", "$x<y$", "&amp;", "<b>", '<img src="i" alt="picture">', "\\alpha", "abcdefg\u0489", "éabcdef", "ﬁgures", "\xad", "a–b", " ", "\x85", "\u2028"]
    texts = ["", None, " \n", *["".join(r.choices([*parts, " "], k=r.randint(1, 30))) for _ in range(300)]]
    return [(d, e, words(d or "", True), words(e or "", False)) for d, e in zip(texts, r.sample(texts, len(texts)), strict=True)]


def test_recall_counts_in_one_pass(spark):
    odd = odd_pairs()
    pairs = spark.createDataFrame([(i // 2, d, e) for i, (d, e, _, _) in enumerate(odd)], "doc_id bigint, digital_text string, extracted_text string")
    want = {}
    for i in range(0, len(odd), 2):  # words of one id are pooled
        own, kept = (Counter(w for x in odd[i : i + 2] for w in x[side]) for side in (2, 3))
        want[i // 2] = (own & kept).total() / own.total() if own else 1.0
    got = recall.count_recall(pairs)
    assert {r["doc_id"]: r["count_recall"] for r in got.collect()} == pytest.approx(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and not re.search("regexp|transform|Generate", plan)


def test_verifying_is_one_pass_too(spark):
    odd = odd_pairs()
    judged = recall.verify(spark.createDataFrame([(i, d, e) for i, (d, e, _, _) in enumerate(odd)], "doc_id bigint, digital_text string, extracted_text string"))
    want = [(i, len(set(d) & set(e)) / len(set(d)) if d else 1.0, sorted(set(d) - set(e))[:30]) for i, (_, _, d, e) in enumerate(odd)]
    assert sorted((r["doc_id"], r["unique_recall"], r["missing"]) for r in judged.collect()) == want
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and not re.search("regexp|transform|array_", plan)


def test_pages_to_chunks(spark):
    page = "# A Study Of Many Things\n\n## Abstract\nshort text of it\n\n## Methods\n**Setup.** we did things\nmore words here\n## Results\nit was good\n"
    pages = spark.createDataFrame([(1, 1, page), (2, 1, None)], "doc_id bigint, page int, text string")
    for level in ("assigned_level", "level"):
        got = Papers(token_limit=12, level=level).run(pages)
        # an introduction is put in after the abstract's heading, so that text is its own
        assert {r["section"] for r in got.collect()} >= {"introduction", "methods", "results"}
