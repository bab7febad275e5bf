"""Rectangles of page images: clipped, cut out of each other, painted over, and pages in halves.

Boxes are arrays [left, top, right, bottom]; everything is done on arrays in the row of the page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .layout import LEAST_HALF, WIDE

BOX, BOXES = "array<double>", "array<array<double>>"
LEFT_RIGHT, RIGHT_LEFT = "left-right", "right-left"


def box(*sides: Column) -> Column:
    return F.array(*sides).cast(BOX)


def clipped(b: Column, width: Column, height: Column) -> Column:
    """A box in whole pixels within the image, one pixel wide and high at least."""
    whole = lambda i: F.when(b[i] < 0, F.ceil(b[i])).otherwise(F.floor(b[i])).cast("double")
    left, top = F.greatest(F.lit(0.0), F.least(whole(0), width - 1)), F.greatest(F.lit(0.0), F.least(whole(1), height - 1))
    return box(left, top, F.greatest(left + 1, F.least(whole(2), width)), F.greatest(top + 1, F.least(whole(3), height)))


def without(base: Column, hole: Column) -> Column:
    """What is left of a box outside another one: a strip above, one below, and what is beside it."""
    left, right = F.greatest(base[0], hole[0]), F.least(base[2], hole[2])
    top, bottom = F.greatest(base[1], hole[1]), F.least(base[3], hole[3])
    strips = F.array(box(base[0], base[1], base[2], top), box(base[0], bottom, base[2], base[3]), box(base[0], top, left, bottom), box(right, top, base[2], bottom))
    return F.when((left >= right) | (top >= bottom), F.array(base)).otherwise(F.filter(strips, lambda b: (b[0] < b[2]) & (b[1] < b[3]))).cast(BOXES)


def painted(regions: Column, width: Column, height: Column) -> Column:
    """The boxes of an image that are painted over: those of masked regions less those of kept ones. regions: array<struct<bbox,action>>."""
    of = lambda kind: F.transform(F.filter(regions, lambda r: r["action"] == kind), lambda r: clipped(r["bbox"], width, height))
    cut = lambda rest, keep: F.flatten(F.transform(rest, lambda b: without(b, keep))).cast(BOXES)
    return F.flatten(F.transform(of("mask"), lambda m: F.aggregate(of("keep"), F.array(m).cast(BOXES), cut)))


def around(points: Column) -> Column:
    """The box around a polygon, or the box itself: points is an array of [x, y] or of one [left, top, right, bottom]."""
    side = lambda f, i: f(F.transform(points, lambda p: p[i]))
    polygon = box(side(F.array_min, 0), side(F.array_min, 1), side(F.array_max, 0), side(F.array_max, 1))
    return F.when(F.size(points[0]) == 4, points[0].cast(BOX)).otherwise(polygon)


def moved(b: Column, left: Column, top: Column) -> Column:
    """A box of a part of a page on the whole page."""
    return box(b[0] + left, b[1] + top, b[2] + left, b[3] + top)


def is_wide(width: Column, height: Column, ratio: float = WIDE) -> Column:
    return F.coalesce((height > 0) & (width / height >= ratio), F.lit(False))


def split_pages(pages: DataFrame, ratio: float = WIDE, order: str = LEFT_RIGHT) -> DataFrame:
    """Wide pages as two, others as they are: `clip` is the part of the page, `part` its place in the order."""
    w, h = F.col("width").cast("double"), F.col("height").cast("double")
    zero = F.lit(0.0)
    left, right = box(zero, zero, w / 2, h), box(w / 2, zero, w, h)
    both = F.array(left, right) if order == LEFT_RIGHT else F.array(right, left)
    return pages.select("*", F.posexplode(F.when(is_wide(w, h, ratio), both).otherwise(F.array(box(zero, zero, w, h)))).alias("part", "clip"))


def split_summary(pages: DataFrame, book: list[str], ratio: float = WIDE) -> DataFrame:
    """Of each book: pages before and after wide ones are split, pages split, and pages copied."""
    wide = F.sum(is_wide(F.col("width"), F.col("height"), ratio).cast("bigint"))
    n = F.count("*")
    return pages.groupBy(*book).agg(n.alias("input_pages"), (n + wide).alias("output_pages"), wide.alias("split_pages"), (n - wide).alias("copied_pages"))


__all__ = ["LEAST_HALF", "around", "box", "clipped", "is_wide", "moved", "painted", "split_pages", "split_summary", "without"]
