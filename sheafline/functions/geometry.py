"""Boxes: struct<l, t, r, b: double>, nullable, from the top left."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafline.plans import schema as S


def box(left: Column, top: Column, right: Column, bottom: Column) -> Column:
    parts = zip("ltrb", (left, top, right, bottom))
    return F.struct(*[c.cast("double").alias(n) for n, c in parts])


def sized_box(left: Column, top: Column, width: Column, height: Column) -> Column:
    return box(left, top, left + width, top + height)


def area(b: Column) -> Column:
    """Negative extents count as none; a null box has no area."""
    sides = F.greatest(F.lit(0.0), b["r"] - b["l"]) * F.greatest(F.lit(0.0), b["b"] - b["t"])
    return F.coalesce(sides, F.lit(0.0))


def coverage(part: Column, whole: Column) -> Column:
    """Share of the page, at most 1; none of a page without area."""
    return F.when(whole > 0, F.least(F.lit(1.0), part / whole)).otherwise(0.0)


def total_area(boxes: Column) -> Column:
    return F.aggregate(boxes, F.lit(0.0), lambda a, b: a + area(b))


def largest_area(boxes: Column) -> Column:
    return F.aggregate(boxes, F.lit(0.0), lambda a, b: F.greatest(a, area(b)))


def normalized(b: Column, width: Column, height: Column) -> Column:
    """Coordinates in parts of the page, kept between 0 and 1; null for null."""
    part = lambda x, whole: F.least(F.greatest(x / whole, F.lit(0.0)), F.lit(1.0))
    inside = box(part(b["l"], width), part(b["t"], height), part(b["r"], width), part(b["b"], height))
    return F.when(b.isNotNull(), inside)


def from_top(b: Column, origin: Column, page_height: Column) -> Column:
    """An engine's box counted from the top, whichever corner the engine counts from."""
    up = origin == "BOTTOMLEFT"
    flip = lambda y: F.when(up, page_height - y).otherwise(y)
    return F.when(b.isNotNull(), box(b["l"], flip(b["t"]), b["r"], flip(b["b"])))


def top_key(b: Column) -> Column:
    return F.coalesce(F.round(b["t"], S.BOX_DECIMALS), F.lit(0.0))


def left_key(b: Column) -> Column:
    return F.coalesce(F.round(b["l"], S.BOX_DECIMALS), F.lit(0.0))


def reading_key(page: Column, b: Column, order: Column) -> list[Column]:
    """page, top, left, order; a null box stands at the page's corner."""
    return [page, top_key(b), left_key(b), order]


def shares_a_line(a: Column, b: Column) -> Column:
    """Two vertical extents that overlap by more than half of the shorter one."""
    overlap = F.least(a["b"], b["b"]) - F.greatest(a["t"], b["t"])
    shorter = F.least(a["b"] - a["t"], b["b"] - b["t"])
    return (shorter > 0) & (overlap > shorter / 2)


def union(b: Column) -> Column:
    """Aggregate: the box around all boxes that aren't null; null if none is."""
    whole = box(F.min(b["l"]), F.min(b["t"]), F.max(b["r"]), F.max(b["b"]))
    return F.when(F.count(b) > 0, whole)


def at_the_edge(b: Column, width: Column, height: Column) -> Column:
    return (
        (b["l"] <= S.EDGE_PX) | (b["t"] <= S.EDGE_PX) | (b["r"] >= width - S.EDGE_PX) | (b["b"] >= height - S.EDGE_PX)
    )
