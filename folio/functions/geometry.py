"""Rectangles as struct<x0, y0, x1, y1> columns: points, y downwards. All built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rect(x0, y0, x1, y1) -> Column:
    c = lambda v: (F.col(v) if isinstance(v, str) else v).cast("double")
    return F.struct(c(x0).alias("x0"), c(y0).alias("y0"), c(x1).alias("x1"), c(y1).alias("y1"))


def width(a: Column) -> Column:
    return a["x1"] - a["x0"]


def height(a: Column) -> Column:
    return a["y1"] - a["y0"]


def area(a: Column) -> Column:
    return F.greatest(F.lit(0.0), width(a)) * F.greatest(F.lit(0.0), height(a))


def union(a: Column, b: Column) -> Column:
    return rect(F.least(a["x0"], b["x0"]), F.least(a["y0"], b["y0"]), F.greatest(a["x1"], b["x1"]), F.greatest(a["y1"], b["y1"]))


def common(a: Column, b: Column) -> Column:
    return rect(F.greatest(a["x0"], b["x0"]), F.greatest(a["y0"], b["y0"]), F.least(a["x1"], b["x1"]), F.least(a["y1"], b["y1"]))


def grown(a: Column, by: float) -> Column:
    return rect(a["x0"] - by, a["y0"] - by, a["x1"] + by, a["y1"] + by)


def intersects(a: Column, b: Column) -> Column:
    """Touching edges do not count."""
    return (a["x0"] < b["x1"]) & (b["x0"] < a["x1"]) & (a["y0"] < b["y1"]) & (b["y0"] < a["y1"])


def contains(a: Column, b: Column) -> Column:
    return (a["x0"] <= b["x0"]) & (a["y0"] <= b["y0"]) & (a["x1"] >= b["x1"]) & (a["y1"] >= b["y1"])


def gap(a: Column, b: Column) -> Column:
    """The larger of the horizontal and the vertical distance; 0 where they overlap."""
    return F.greatest(F.lit(0.0), F.greatest(a["x0"], b["x0"]) - F.least(a["x1"], b["x1"]), F.greatest(a["y0"], b["y0"]) - F.least(a["y1"], b["y1"]))


def iou(a: Column, b: Column) -> Column:
    """Shared area over the area of either; 0 if neither has any."""
    shared = area(common(a, b))
    both = area(a) + area(b) - shared
    return F.when(both > 0, shared / both).otherwise(0.0)


def vertical_overlap(a: Column, b: Column) -> Column:
    return F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])


def same_level(a: Column, b: Column) -> Column:
    """Overlap vertically by more than half of the lower one's height."""
    return vertical_overlap(a, b) > 0.5 * F.greatest(F.lit(1.0), F.least(height(a), height(b)))


def beside_bottom(figure: Column, caption: Column) -> Column:
    """Distance of the lower edges if the caption stands beside the figure; else null."""
    across = F.greatest(figure["x0"] - caption["x1"], caption["x0"] - figure["x1"])
    return F.when((vertical_overlap(figure, caption) > 0.5 * F.least(height(caption), height(figure))) & (across < 60), F.abs(figure["y1"] - caption["y1"]))


def caption_distance(figure: Column, caption: Column) -> Column:
    """How far a caption is from a figure it may belong to: top-aligned, below, above, or beside at the bottom; null from 40 on."""
    d = F.least(F.abs(figure["y0"] - caption["y0"]), F.abs(caption["y0"] - figure["y1"]), F.abs(figure["y0"] - caption["y1"]), beside_bottom(figure, caption))
    return F.when(d < 40, d)


def minus(a: Column, b: Column) -> Column:
    """What of a lies outside b: up to four rectangles above, below, left and right."""
    top, bottom = F.greatest(a["y0"], b["y0"]), F.least(a["y1"], b["y1"])
    parts = F.array(rect(a["x0"], a["y0"], a["x1"], b["y0"]), rect(a["x0"], b["y1"], a["x1"], a["y1"]), rect(a["x0"], top, b["x0"], bottom), rect(b["x1"], top, a["x1"], bottom))
    rest = F.filter(parts, lambda p: (width(p) > 0) & (height(p) > 0))
    none = F.slice(parts, 1, 0)
    return F.when((width(a) <= 0) | (height(a) <= 0), none).when(~intersects(a, b), F.array(a)).otherwise(rest)
