"""Points near rectangles, by a grid of cells and dyadic nodes of time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import distance_to_box
from .scan import group_begins
from .temporal import KEY, cover, cover_levels, holding

#: What rounding may shift a border by.
EDGE = 1e-9


def _cells(lo: Column, hi: Column, cell: float) -> Column:
    place = lambda c: F.floor(c / cell).cast("long")
    return F.sequence(place(lo), place(hi))


def candidates(points: DataFrame, boxes: DataFrame, radius: float, cell: float, keys=KEY, ts: str | None = None, shown=("first_seen", "last_seen"), width: float = 60.0) -> DataFrame:
    """Pairs of a point (x, y) and a rectangle (box) that may lie within the radius, each once: a point is in
    one cell of the grid, and a rectangle, widened by the radius, in those that it touches. With ts,
    also of a point's time and an interval that holds it, by buckets of `width`."""
    b = boxes.withColumn("_cell_x", F.explode(_cells(F.col("box.x") - radius - EDGE, F.col("box.x") + F.col("box.width") + radius + EDGE, cell)))
    b = b.withColumn("_cell_y", F.explode(_cells(F.col("box.y") - radius - EDGE, F.col("box.y") + F.col("box.height") + radius + EDGE, cell)))
    place = lambda c: F.floor(F.col(c) / cell).cast("long")
    a, on = points.withColumns({"_cell_x": place("x"), "_cell_y": place("y")}), [*keys, "_cell_x", "_cell_y"]
    if ts is not None:
        whole = cover(F.col(shown[0]), F.col(shown[1]), width)
        levels = cover_levels(boxes.where(F.col(shown[1]) >= F.col(shown[0])).select(whole.alias("_iv_own")))
        b = b.where(F.col(shown[1]) >= F.col(shown[0])).withColumn("_iv_n", F.explode(whole))
        a, on = a.withColumn("_iv_n", F.explode(holding(F.col(ts), width, levels))), [*on, "_iv_n"]
    met = a.join(b, on).drop("_cell_x", "_cell_y", "_iv_n")
    return met if ts is None else met.where(F.col(ts).between(F.col(shown[0]), F.col(shown[1])))


def near_boxes(points: DataFrame, boxes: DataFrame, radius: float, keys=KEY, cell: float | None = None, **when) -> DataFrame:
    """Pairs of a point and a rectangle within the radius, with `dist` (J12, P11, M02). The cells are as
    wide as the radius unless `cell` is given: larger ones where rectangles are much larger than it."""
    met = candidates(points, boxes, radius, cell or radius, keys, **when).withColumn("dist", distance_to_box(F.col("x"), F.col("y"), F.col("box")))
    return met.where(F.col("dist") <= radius)


#: A cell's boxes go to so many tasks at most; pairs of a box and a point that a task looks at together.
SLICES, PAIRS = 8, 2**19


def nearest_points(points: DataFrame, boxes: DataFrame, radius: float, own: list[str], order: str, keys=KEY, cell: float | None = None) -> DataFrame:
    """(own, order, dist): for each rectangle of boxes(own, keys, box) the nearest of points(keys, x, y, order) within
    the radius, of equally near ones that of the least order (J12). No table of pairs is made: a task reads a
    cell's points, of each place the one of the least order, then its boxes, and keeps the best of each box."""
    size = cell or radius
    place = lambda c: F.floor(c / size).cast("long")
    own_row, left, top = F.struct(*own), F.col("box.x"), F.col("box.y")
    places = points.where("x IS NOT NULL AND y IS NOT NULL").groupBy(*keys, "x", "y").agg(F.min(order).alias("_o"))
    ends = places.groupBy(*keys).agg(*[f(c).alias(f"_{f.__name__}_{c}") for c in "xy" for f in (F.min, F.max)])

    def reach(c: str, lo: Column, hi: Column) -> Column:
        """The cells along an axis that a box reaches, of those between the key's points."""
        a, z = F.greatest(place(lo - radius - EDGE), place(F.col(f"_min_{c}"))), F.least(place(hi + radius + EDGE), place(F.col(f"_max_{c}")))
        return F.explode(F.when(a <= z, F.sequence(a, z)))

    b = boxes.join(ends, list(keys)).withColumn("_cx", reach("x", left, left + F.col("box.width")))
    b = b.withColumn("_cy", reach("y", top, top + F.col("box.height"))).withColumn("_slice", F.pmod(F.xxhash64(*own), F.lit(SLICES)).cast("int"))
    number = lambda c: F.col(c).cast("double")
    group = [*keys, "_cx", "_cy", "_slice"]
    b = b.select(*group, F.lit(1).alias("_box"), *[number(f"box.{c}").alias(f"_{c}") for c in ("x", "y", "width", "height")], F.lit(None).cast(places.schema["_o"].dataType).alias("_o"), own_row.alias("_own"))
    zero = F.lit(0.0)
    a = places.withColumns({"_cx": place(F.col("x")), "_cy": place(F.col("y")), "_slice": F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1)))})
    a = a.select(*group, F.lit(0).alias("_box"), number("x").alias("_x"), number("y").alias("_y"), zero.alias("_width"), zero.alias("_height"), "_o", F.lit(None).cast(b.schema["_own"].dataType).alias("_own"))
    dealt = a.unionByName(b).repartition(*group).sortWithinPartitions(*group, "_box", "_o")
    best = dealt.mapInArrow(_best_of_cells(group, radius), dealt.select("_own", F.col("_x").alias("dist"), "_o").schema)
    found = best.groupBy("_own").agg(F.min(F.struct("dist", "_o")).alias("_m"))
    return found.select("_own.*", F.col("_m._o").alias(order), "_m.dist")


def _best_of_cells(group: list[str], radius: float):
    """For mapInArrow: rows in order by group, points before boxes; the nearest point of the group for each box."""

    def run(batches):
        before, here = None, []  # the last row; the group's points, as tables
        for batch in batches:
            if not len(batch):
                continue
            t = pa.Table.from_batches([batch])
            new = group_begins(t if before is None else pa.concat_tables([before, t]), group)[-len(t) :]
            before = t.slice(len(t) - 1)
            is_box = t["_box"].to_numpy() == 1
            cut = np.flatnonzero(new | np.append(True, is_box[1:] != is_box[:-1]))
            for start, end in zip(cut.tolist(), [*cut[1:].tolist(), len(t)]):
                part = t.slice(start, end - start)
                if new[start]:
                    here = []
                if not is_box[start]:
                    here.append(part)
                elif here:
                    here = [pa.concat_tables(here).combine_chunks()]
                    yield from _nearest(here[0], part, radius)

    return run


def _nearest(points: pa.Table, boxes: pa.Table, radius: float):
    px, py = points["_x"].to_numpy(), points["_y"].to_numpy()
    x, y, w, h = (boxes[c].to_numpy()[:, None] for c in ("_x", "_y", "_width", "_height"))
    n = max(1, PAIRS // len(px))
    for i in range(0, len(boxes), n):
        s = slice(i, i + n)
        dx = np.maximum(np.maximum(x[s] - px, 0.0), px - x[s] - w[s])
        dy = np.maximum(np.maximum(y[s] - py, 0.0), py - y[s] - h[s])
        dist = np.sqrt(dx * dx + dy * dy)
        pick = dist.argmin(axis=1)  # the first of equals: points are in order
        least = dist[np.arange(len(pick)), pick]
        good = np.flatnonzero(least <= radius)
        if len(good):
            own = boxes["_own"].combine_chunks().take(pa.array(good + i))
            yield pa.RecordBatch.from_arrays([own, pa.array(least[good]), points["_o"].combine_chunks().take(pa.array(pick[good]))], names=["_own", "dist", "_o"])
