"""Boxes: struct(l, t, r, b), origin at the bottom left, so t is above b."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(left: Column, top: Column, right: Column, bottom: Column) -> Column:
    return F.struct(*[x.cast("double").alias(n) for x, n in ((left, "l"), (top, "t"), (right, "r"), (bottom, "b"))])


def metrics(a: Column) -> Column:
    """struct(l, r, t, b, w, h)."""
    return F.struct(a["l"].alias("l"), a["r"].alias("r"), a["t"].alias("t"), a["b"].alias("b"), (a["r"] - a["l"]).alias("w"), (a["t"] - a["b"]).alias("h"))


def dimensions(a: Column) -> Column:
    """struct(height, width) to three places, null if a side is missing."""
    return F.struct(F.round(a["t"] - a["b"], 3).alias("height"), F.round(a["r"] - a["l"], 3).alias("width"))


def _share(overlap: Column, least: Column) -> Column:
    return F.when(least > 0, F.greatest(F.lit(0.0), overlap) / F.when(least > 0, least)).otherwise(F.lit(0.0))


def vertical_overlap(a: Column, b: Column) -> Column:
    return _share(F.least(a["t"], b["t"]) - F.greatest(a["b"], b["b"]), F.least(a["t"] - a["b"], b["t"] - b["b"]))


def horizontal_overlap(a: Column, b: Column) -> Column:
    return _share(F.least(a["r"], b["r"]) - F.greatest(a["l"], b["l"]), F.least(a["r"] - a["l"], b["r"] - b["l"]))


def gap_below(image: Column, text: Column, slack: float = 20.0) -> Column:
    return F.when(text["t"] <= image["b"] + slack, F.greatest(F.lit(0.0), image["b"] - text["t"]))


def gap_left(image: Column, text: Column, slack: float = 20.0) -> Column:
    return F.when(text["r"] <= image["l"] + slack, F.greatest(F.lit(0.0), image["l"] - text["r"]))


def gap_right(image: Column, text: Column, slack: float = 20.0) -> Column:
    return F.when(text["l"] >= image["r"] - slack, F.greatest(F.lit(0.0), text["l"] - image["r"]))


def center_distance(a: Column, b: Column) -> Column:
    dx = (a["l"] + a["r"]) / 2 - (b["l"] + b["r"]) / 2
    dy = (a["t"] + a["b"]) / 2 - (b["t"] + b["b"]) / 2
    return F.sqrt(dx * dx + dy * dy)


def caption_gaps(image: Column, caption: Column) -> Column:
    """struct(vertical gap, horizontal distance of centres)."""
    return F.struct(F.abs(image["b"] - caption["t"]).alias("vertical"), F.abs((image["l"] + image["r"]) / 2 - (caption["l"] + caption["r"]) / 2).alias("horizontal"))


def edge_gap(a: Column, b: Column) -> Column:
    """Least distance of facing edges."""
    return F.least(F.abs(a["b"] - b["t"]), F.abs(b["b"] - a["t"]), F.abs(a["r"] - b["l"]), F.abs(b["r"] - a["l"]))


def split_orientation(a: Column, b: Column) -> Column:
    """'horizontal', 'vertical' or null: are two pictures panels of one figure?"""

    def ratio(x: Column, y: Column) -> Column:
        most = F.greatest(x, y)
        return F.when(most > 0, F.least(x, y) / F.when(most > 0, most)).otherwise(F.lit(0.0))

    ha, hb, wa, wb = a["t"] - a["b"], b["t"] - b["b"], a["r"] - a["l"], b["r"] - b["l"]
    across = F.least(F.abs(a["r"] - b["l"]), F.abs(b["r"] - a["l"]))
    up = F.least(F.abs(a["b"] - b["t"]), F.abs(b["b"] - a["t"]))
    beside = (vertical_overlap(a, b) > 0.8) & (ratio(ha, hb) > 0.85) & (across < 40)
    stacked = (horizontal_overlap(a, b) > 0.8) & (ratio(wa, wb) > 0.85) & (up < 40)
    return F.when(beside, "horizontal").when(stacked, "vertical")


def mostly_inside(inner: Column, outer: Column, share: float = 0.85) -> Column:
    """Is at least ``share`` of the first box inside the second?  Both are arrays
    [x0, y0, x1, y1] that may be inverted; touching is no overlap."""
    def sides(a: Column) -> tuple[Column, ...]:
        return F.least(a[0], a[2]), F.greatest(a[0], a[2]), F.least(a[1], a[3]), F.greatest(a[1], a[3])

    l1, r1, b1, t1 = sides(inner)
    l2, r2, b2, t2 = sides(outer)
    w, h = F.least(r1, r2) - F.greatest(l1, l2), F.least(t1, t2) - F.greatest(b1, b2)
    area = (r1 - l1) * (t1 - b1)
    return (w > 0) & (h > 0) & (area > 0) & (w * h >= share * area)


def flip(y: Column, page_height: Column) -> Column:
    return page_height - y


def page_bottom(width: Column) -> Column:
    """Box at the foot of a page; the right side is null if the width is unknown."""
    return box(F.lit(0), F.lit(0), width, F.lit(0))


def is_narrow(a: Column, page_width: Column, share: float = 0.65) -> Column:
    return F.coalesce(a["r"], page_width) - F.coalesce(a["l"], F.lit(0.0)) < share * page_width


def column_side(a: Column, page_width: Column, split: float = 0.5) -> Column:
    center = (F.coalesce(a["l"], F.lit(0.0)) + F.coalesce(a["r"], page_width)) / 2
    return F.when(center < page_width * split, "left").otherwise("right")


def crop_rectangles(w: Column, h: Column, start: Column, end: Column, padding: float = 0.0, split: float = 0.5, narrow: float = 0.65) -> Column:
    """Rectangles (top-left origin) of a boundary page that belong to a chapter.

    ``start`` and ``end`` are boxes or null.  A null result means both are missing.
    """
    m = w * split
    zero = F.lit(0.0)
    ys = F.greatest(zero, h - F.coalesce(start["t"], h) - padding)
    ye = F.least(h, h - F.coalesce(end["t"], zero) + padding)

    def rects(*corners: tuple[Column, Column, Column, Column]) -> Column:
        return F.array(*[F.struct(*[x.cast("double").alias(n) for x, n in zip(c, ("x0", "y0", "x1", "y1"), strict=True)]) for c in corners])

    def kind(a: Column) -> Column:
        return F.when(a.isNull(), "none").when(is_narrow(a, w, narrow), column_side(a, w, split)).otherwise("full")

    s, e = kind(start), kind(end)
    cases = [
        ("full", "none", rects((zero, ys, w, h))), ("left", "none", rects((zero, ys, m, h), (m, zero, w, h))), ("right", "none", rects((m, ys, w, h))),
        ("none", "full", rects((zero, zero, w, ye))), ("none", "left", rects((zero, zero, m, ye))), ("none", "right", rects((zero, zero, m, h), (m, zero, w, ye))),
        ("full", "full", rects((zero, ys, w, ye))), ("left", "left", rects((zero, ys, m, ye))), ("left", "right", rects((zero, ys, m, h), (m, zero, w, ye))),
        ("right", "right", rects((m, ys, w, ye))), ("right", "left", rects((m, ys, w, h))), ("left", "full", rects((zero, ys, m, ye), (m, zero, w, ye))),
        ("right", "full", rects((m, ys, w, ye))), ("full", "left", rects((zero, ys, m, ye))), ("full", "right", rects((zero, ys, m, h), (m, ys, w, ye))),
    ]
    out = F.when((s == "none") & (e == "none"), F.lit(None).cast("array<struct<x0:double,y0:double,x1:double,y1:double>>"))
    for a, b, r in cases:
        out = out.when((s == a) & (e == b), r)
    return out
