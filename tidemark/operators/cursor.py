"""Pointer tracks: spans, held positions and hovers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Cursor, Hover
from ..functions.geometry import area, interpolate
from .space import near_boxes
from .temporal import KEY, islands, nearest, overlap_join


def spans(track: DataFrame, cursor: Cursor = Cursor(), c: Hover = Hover(), keys=KEY) -> DataFrame:
    """(keys, start, end, x0, y0, x1, y1): between close samples the pointer moves; else it stays, for
    max_hold at most (W07)."""
    w = W.partitionBy(*keys).orderBy("timestamp")
    t = track.withColumns({"_t": F.lead("timestamp").over(w), "_x": F.lead("x").over(w), "_y": F.lead("y").over(w)})
    moving = F.coalesce(F.col("_t") - F.col("timestamp") <= c.contiguous / cursor.fps, F.lit(False))
    hold = F.col("timestamp") + c.max_hold
    end = F.when(moving, F.col("_t")).otherwise(F.least(F.coalesce("_t", hold), hold))
    return t.select(*keys, F.col("timestamp").alias("start"), end.alias("end"), F.col("x").alias("x0"), F.col("y").alias("y0"), F.when(moving, F.col("_x")).otherwise(F.col("x")).alias("x1"), F.when(moving, F.col("_y")).otherwise(F.col("y")).alias("y1"))


def held_positions(s: DataFrame, step: float) -> DataFrame:
    """Instants start + i * step of each span, the first at least (G01), as ts, x, y."""
    n = F.greatest(F.lit(1), ((F.col("end") - F.col("start")) / step).cast("int"))
    out = s.withColumn("_i", F.explode(F.sequence(F.lit(0), n - 1))).withColumn("ts", F.col("start") + F.col("_i") * step)
    at = lambda a, b: interpolate(F.col(a), F.col(b), F.col("start"), F.col("end"), F.col("ts"))
    return out.withColumns({"x": at("x0", "x1"), "y": at("y0", "y1")}).drop("_i")


def hovers(track: DataFrame, elements: DataFrame, cursor: Cursor = Cursor(), c: Hover = Hover(), keys=KEY) -> DataFrame:
    """(keys, element_id, start, end, box): the pointer stays by one small element."""
    small = elements.where((area(F.col("box")) <= c.max_area) & (F.col("box.width") <= c.max_width) & (F.length("text") <= c.max_chars))
    small = small.select(*keys, F.col("id").alias("element_id"), "box", "first_seen", "last_seen")
    points = held_positions(spans(track, cursor, c, keys), c.step).select(*keys, "ts", "x", "y")
    met = near_boxes(points, small, c.distance, keys, c.cell, ts="ts")
    hits = nearest(met, "dist", c.distance, [*keys, "ts"], ["element_id"])
    runs = islands(hits, "element_id", "ts", c.join_seconds, keys).groupBy(*keys, "element_id", "island").agg(F.min("ts").alias("start"), F.max("ts").alias("last"), F.first("box").alias("box"))
    return runs.where(F.col("last") - F.col("start") >= c.min_seconds).select(*keys, "element_id", "start", (F.col("last") + c.tail).alias("end"), "box")


def hovers_in_pieces(h: DataFrame, plan: DataFrame, c: Hover = Hover(), keys=KEY) -> DataFrame:
    """Hovers clipped to the pieces that show them, from each piece's start."""
    p = plan.select(*keys, F.col("ord").alias("piece"), F.col("start").alias("p_start"), F.col("end").alias("p_end"))
    met = overlap_join(h, p, 60.0, keys, ("start", "end"), ("p_start", "p_end"))
    out = met.withColumns({"start": F.round(F.greatest(F.col("start") - F.col("p_start"), F.lit(0.0)), 3), "end": F.round(F.least(F.col("end"), F.col("p_end")) - F.col("p_start"), 3)})
    return out.where(F.col("end") - F.col("start") >= c.min_seconds).drop("p_start", "p_end")
