"""Rectangles in normalised coordinates, as structs (x, y, width, height), and points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def make_box(x: Column, y: Column, width: Column, height: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), width.alias("width"), height.alias("height"))


def quad_to_box(points: Column, width: int, height: int) -> Column:
    """From four corners in pixels: clamped, and one pixel wide and high at least."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    clamp = lambda v, size: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v / size))
    x0, x1, y0, y1 = clamp(F.array_min(xs), width), clamp(F.array_max(xs), width), clamp(F.array_min(ys), height), clamp(F.array_max(ys), height)
    return make_box(x0, y0, F.greatest(x1 - x0, F.lit(1.0 / width)), F.greatest(y1 - y0, F.lit(1.0 / height)))


def area(box: Column) -> Column:
    return box["width"] * box["height"]


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 where they are apart or only touch."""
    w = F.least(a["x"] + a["width"], b["x"] + b["width"]) - F.greatest(a["x"], b["x"])
    h = F.least(a["y"] + a["height"], b["y"] + b["height"]) - F.greatest(a["y"], b["y"])
    return F.when((w <= 0) | (h <= 0), 0.0).otherwise(w * h / (area(a) + area(b) - w * h))


def visible_share(first: Column, last: Column, start: Column, end: Column) -> Column:
    """The share of [start, end] during which something is there; 0 of an empty interval."""
    overlap = F.greatest(F.least(last, end) - F.greatest(first, start), F.lit(0.0))
    return F.when(end <= start, 0.0).otherwise(overlap / (end - start))


def center(box: Column) -> Column:
    return F.struct((box["x"] + box["width"] / 2).alias("x"), (box["y"] + box["height"] / 2).alias("y"))


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def distance_to_box(x: Column, y: Column, box: Column) -> Column:
    """0 inside, else to the nearest edge or corner."""
    dx = F.greatest(box["x"] - x, F.lit(0.0), x - box["x"] - box["width"])
    dy = F.greatest(box["y"] - y, F.lit(0.0), y - box["y"] - box["height"])
    return F.sqrt(dx * dx + dy * dy)


def display_window(first: Column, last: Column, start: Column, end: Column) -> Column:
    """Presence clamped to a segment, relative to its start; nulls where it covers all."""
    whole = (first <= start) & (last >= end)
    lo, hi = F.round(F.greatest(first, start) - start, 3), F.round(F.least(last, end) - start, 3)
    return F.struct(F.when(~whole, lo).alias("start_offset"), F.when(~whole, hi).alias("end_offset"))


def resolve_window(start: Column, end: Column, duration: Column, strict: bool = True) -> Column:
    """Offsets with defaults, clamped to [0, duration]; an empty window raises, or is null."""
    lo = F.greatest(F.coalesce(start, F.lit(0.0)), F.lit(0.0))
    hi = F.least(F.coalesce(end, duration), duration)
    bad = F.raise_error(F.lit("empty window")).cast("struct<start:double,end:double>") if strict else F.lit(None).cast("struct<start:double,end:double>")
    return F.when(hi > lo, F.struct(lo.alias("start"), hi.alias("end"))).otherwise(bad)


def always_on(start: Column, end: Column, duration: Column) -> Column:
    """An open end lasts; an end needs a known duration to reach."""
    return (start <= 0) & (end.isNull() | F.coalesce(end >= duration, F.lit(False)))


def fade_span(fade: Column, start: Column, end: Column) -> Column:
    """Half the window at most; none with an open end."""
    return F.when(end.isNull() | (fade <= 0), 0.0).otherwise(F.least(fade, (end - start) / 2))


def even(v: Column) -> Column:
    whole = v.cast("int")
    return whole - whole % 2


def interpolate(a: Column, b: Column, start: Column, end: Column, t: Column) -> Column:
    """Position inside a moving span; a span without length stays at its start."""
    return F.when(end > start, a + (b - a) * (t - start) / (end - start)).otherwise(a)
