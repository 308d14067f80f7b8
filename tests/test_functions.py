"""Literal cases of text and geometry functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.functions import text as T
from quire.operators import blocks, cleanup


@pytest.fixture(scope="module")
def one(spark):
    def run(expr, *values):
        names = [f"v{i}" for i in range(len(values))]
        df = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
        return df.select(expr(*[F.col(n) for n in names]).alias("x")).first()["x"]

    return run


@pytest.mark.parametrize(("f", "value", "want"), [
    (T.strip_md, "![a](b.png) **Bold** [link](u) snake_case", "Bold link snakecase"), (T.strip_md, "__x__  y\n z", "x y z"),
    (T.normalize, "**2.1 Étude-Design:**", "2 1 tude design"), (T.bold_lead, "**Patient Selection.**", "Patient Selection."), (T.standalone_bold, "**Patient Selection.**", "Patient Selection."),
    (T.bold_lead, "**Lead.** body", "Lead."), (T.standalone_bold, "**Lead.** body", None), (T.standalone_bold, "**A** mid **B**", "A** mid **B"), (T.bold_lead, "****", None), (T.standalone_bold, "****", None),
    (T.ends_broken, "foo bar-", True), (T.ends_broken, "one two three four", True), (T.ends_broken, "one two three", False), (T.ends_broken, "done.", False), (T.ends_broken, "  ", False),
    (T.starts_broken, "  and", True), (T.starts_broken, "The", False), (T.starts_broken, "élan", True), (T.starts_broken, "3 of", False), (T.starts_broken, "", False), (T.starts_broken, "ª", True),
    (T.alt_text, '<img src="x" alt=" A &amp; B ">', "A & B"), (T.alt_text, "<img alt=''>", None), (T.alt_text, '<img alt="">', None), (T.word_count, "été où x_1", 3),
    (T.drop_boilerplate, "https://doi.org/x\nSpringer\nReceived: 1\nx Published online: y\n© The Author(s)\nkeep\n\n", "keep\n"),
    (T.strip_emphasis, "**_x y_**", "x y"), (T.split_lines, "a\r\nb\x0bc\n", ["a", "b", "c"]),
    (cleanup.is_noise, "-----", True), (cleanup.is_noise, "--", True), (cleanup.is_noise, "aaaa", True), (cleanup.is_noise, "www.x.org", True), (cleanup.is_noise, "copyright 2020 us", True), (cleanup.is_noise, "", True), (cleanup.is_noise, "12 Smith et al", False),
    (cleanup.is_front_matter, "", False), (cleanup.is_front_matter, "2021, Vol. 11(4) 123–130", True), (cleanup.is_front_matter, "2021 vol 11 5-9", True), (cleanup.is_front_matter, "2021 vol 1 5-9", False),
    (cleanup.is_running_head, "12 Smith et al", True), (cleanup.is_running_head, "Smith et al 12", True), (cleanup.is_running_head, "Spine Journal 2020", True), (cleanup.is_running_head, "Results were good", False),
    (cleanup.is_logo, "<figure>silicon</figure>", True), (cleanup.is_logo, "<figure>logo<figcaption>x</figcaption></figure>", False),
])
def test_text(one, f, value, want):
    assert one(f, value) == want


@pytest.mark.parametrize(("value", "figure", "table"), [("Figure 3. Caption", 3, None), ("**Fig. 12:** text", 12, None), ("FIG.: 4", 4, None), ("Figures 3", None, None), ("See Figure 3", None, None), ("Figure 3a", None, None), ("Table 2. X", None, 2), ("table  7", None, 7), ("TABLE 10", None, 10), ("Table: 2", None, None), ("Table 2b", None, None), ("Figure 99999999999", None, None)])
def test_numbers(one, value, figure, table):
    assert one(T.figure_number, value)["number"] == figure
    assert one(T.table_number, value)["number"] == table


def test_captions_joins_and_names(one):
    x = one(T.html_figure, "<figure><figcaption>A &lt;b&gt; <i>see</i></figcaption></figure><p>Fig 9</p>")
    assert (x["number"], x["caption"]) == (9, "A <b> see")
    assert one(T.join_parts, "multi-", "centric x") == "multicentric x"
    assert one(T.join_parts, "a ", " b") == "a b"
    name = lambda c: T.table_identifier(F.lit(None).cast("int"), c)
    assert one(name, "Variable / Name") == "Variable___Name"
    assert one(name, "???") == "" and one(name, None) is None
    assert one(T.normalize_digital, "multi-\ncentric a-\nb") == "multicentric a  b"  # white space collapses before hyphens go
    assert one(lambda c: T.long_words(c), "éeauxmentre abcdefg multi centric") == ["abcdefg", "centric"]
    assert one(T.base_normalize, 'Ａ­b $x<y$ \\alpha <img src="i" alt="Pic"> <b>z</b> “q”').split() == ["ab", "pic", "z", '"q"']


def test_words_end_where_the_sql_ends_them(one):
    assert one(T.long_words, "abcdefg\u0489 hijklm\u0301n_ opqrst") == ["abcdefg", "hijklm", "opqrst"]  # marks are no letters
    assert one(T.normalize_digital, " ab-\n\ncd-\nef  x\n") == "abcd  ef x" and one(T.normalize_extracted, "") == "" and one(T.normalize_digital, None) is None


def test_classification(one):
    kind = lambda c: blocks.classify(c)["type"]
    cases = {"## A": "heading", "## A\n  b": "paragraph", "<br/>": "html", "</p>": "paragraph", "- a\n  - b": "list", "1) x": "list", "<FIGURE>x</FIGURE>": "figure", "<table>\n</table>": "table", "text": "paragraph"}
    assert {v: one(kind, v) for v in cases} == cases


def test_scanner(one):
    page = "# Deep Learning Of Spines\n\nPara one\n  continued\nPara two\n- a\n  - b\n<table>\n\n<tr></tr>\n</table>\ntail"
    got = [b["text"] for b in one(lambda c: blocks.scan_lines(T.split_lines(c)), page)]
    assert got == ["# Deep Learning Of Spines", "Para one\n  continued", "Para two", "- a\n  - b", "<table>\n\n<tr></tr>\n</table>", "tail"]
    assert [b["text"] for b in one(lambda c: blocks.scan_lines(T.split_lines(c)), "<div>\na\n\nb")] == ["<div>\na\n\nb"]


def _boxes(spark, *boxes):
    return spark.createDataFrame([tuple(boxes)], ", ".join(f"{n} struct<l:double,t:double,r:double,b:double>" for n in "abc"[: len(boxes)]))


def test_geometry(spark):
    df = _boxes(spark, (100.0, 500.0, 300.0, 300.0), (100.0, 290.0, 300.0, 270.0), (0.0, 1.0, 0.0, 1.0))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    r = df.select(G.gap_below(a, b), G.horizontal_overlap(a, b), G.center_distance(a, b), G.horizontal_overlap(a, c), G.gap_left(a, b), G.metrics(a)["w"]).first()
    assert tuple(r) == (10.0, 1.0, 120.0, 0.0, None, 200.0)
    df = _boxes(spark, (0.0, 400.0, 200.0, 200.0), (210.0, 400.0, 410.0, 200.0))
    assert df.select(G.split_orientation(a, b)).first()[0] == "horizontal"
    df = spark.createDataFrame([([0.0, 0.0, 10.0, 10.0], [0.0, 2.5, 10.0, 30.0], [10.0, 0.0, 20.0, 10.0])], "a array<double>, b array<double>, c array<double>")
    assert tuple(df.select(G.mostly_inside(a, b, 0.75), G.mostly_inside(a, b, 0.76), G.mostly_inside(a, c, 0.0)).first()) == (True, False, False)
    df = _boxes(spark, (50.0, 600.0, 250.0, 580.0)).select(G.crop_rectangles(F.lit(600.0), F.lit(800.0), a, F.lit(None).cast("struct<l:double,t:double,r:double,b:double>")).alias("x"))
    assert [tuple(x) for x in df.first()["x"]] == [(0.0, 200.0, 300.0, 800.0), (300.0, 0.0, 600.0, 800.0)]
