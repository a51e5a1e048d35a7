"""Rules over pixels, on long tables (keys, frame, row, col, value), and selections over frames."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Crop, Cursor, ScreenText
from ..storage import kept
from .scan import group_begins
from .temporal import KEY, first_run


def changed_ratio(before: DataFrame, after: DataFrame, delta: int = 25, keys=KEY) -> DataFrame:
    """The share of pixels that changed by more than delta."""
    own = [*keys, "frame", "row", "col"]
    met = before.select(*own, F.col("value").alias("_v")).join(after, own)
    return met.groupBy(*keys, "frame").agg(F.avg((F.abs(F.col("value") - F.col("_v")) > delta).cast("int")).alias("ratio"))


def greedy_keep(values: Column, threshold: Column) -> Column:
    """Of an ordered array of structs (at, v): those whose v differs from the last kept one's by the
    threshold or more; the first always (Q01)."""

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        return F.when((F.size(acc) == 0) | (F.abs(x["v"] - last["v"]) >= threshold), F.concat(acc, F.array(x))).otherwise(acc)

    return F.aggregate(values, F.slice(values, F.lit(1), F.lit(0)), step)


def capped_keep(values: Column, threshold: float, most: int, highest: float = 1.0) -> Column:
    """(threshold, kept): the first doubled threshold at which at most so many are kept; the last
    one's are cut off to so many. All thresholds are tried at once, no loop (Q02, T06)."""
    steps = [threshold]
    while steps[-1] < highest:
        steps.append(steps[-1] * 2)
    tried = F.transform(F.array(*map(F.lit, steps)), lambda t: F.struct(t.alias("threshold"), greedy_keep(values, t).alias("kept")))
    pick = F.coalesce(F.get(F.filter(tried, lambda s: F.size(s["kept"]) <= most), F.lit(0)), F.element_at(tried, -1))
    return F.struct(pick["threshold"].alias("threshold"), F.slice(pick["kept"], 1, most).alias("kept"))


def row_variation(frames: DataFrame, keys=KEY) -> DataFrame:
    """(keys, row, variation): each pixel's deviation over frames, averaged over its row."""
    return frames.groupBy(*keys, "row", "col").agg(F.stddev_pop("value").alias("s")).groupBy(*keys, "row").agg(F.avg("s").alias("variation"))


def row_coverage(frames: DataFrame, rgb: tuple[int, int, int], tolerance: int, keys=KEY) -> DataFrame:
    """(keys, frame, row, coverage): pixels (r, g, b) close to a colour in every channel."""
    gap = F.greatest(*[F.abs(F.col(c) - v) for c, v in zip("rgb", rgb)])
    return frames.groupBy(*keys, "frame", "row").agg(F.avg((gap <= tolerance).cast("int")).alias("coverage"))


def anchor_height(coverage: DataFrame, c: Crop = Crop(), keys=KEY) -> DataFrame:
    """(keys, height, spread): the median start of the coloured band, if enough frames have one. With
    a column `color`, a frame's band is the topmost of its colours (W09, A05)."""
    each = (*keys, "frame", *(["color"] if "color" in coverage.columns else []))
    starts = first_run(coverage, F.col("coverage") >= c.anchor_coverage, "row", c.anchor_min_rows, each)
    starts = starts.groupBy(*keys, "frame").agg(F.min("start").alias("start"))
    n = coverage.groupBy(*keys).agg(F.countDistinct("frame").alias("n"))
    met = starts.groupBy(*keys).agg(F.count(F.lit(1)).alias("k"), F.percentile("start", 0.5).cast("int").alias("height"), (F.max("start") - F.min("start")).alias("spread"))
    return met.join(n, list(keys)).where(F.col("k") >= F.greatest(F.lit(1), F.rint(F.col("n") * c.anchor_min_frames))).select(*keys, "height", "spread")


def variation_height(variation: DataFrame, height: int, c: Crop = Crop(), keys=KEY) -> DataFrame:
    """(keys, height): the first run of rows that vary half as much as the lower two thirds do, or
    more; none where these don't vary (A06, W09)."""
    least = variation.where(F.col("row") >= height // 3).groupBy(*keys).agg((F.avg("variation") / 2).alias("_least"))
    met = variation.join(least, list(keys))
    return first_run(met, (F.col("_least") > 0) & (F.col("variation") >= F.col("_least")), "row", c.run_rows, keys).select(*keys, F.col("start").alias("height"))


def crop_height(videos: DataFrame, anchor: DataFrame, variation: DataFrame, c: Crop = Crop(), keys=KEY) -> DataFrame:
    """(keys, height, reason) for videos(keys, frame_height): imposed, by the anchor, by variation;
    what passes the cap is refused, unless it is imposed (P19, M07)."""
    mode = str(c.top).lower()
    if mode != "auto":
        top = 0 if mode in ("off", "none", "0") else int(mode)
        return videos.select(*keys, F.lit(top).alias("height"), F.lit("off" if top == 0 else "imposed").alias("reason"))
    met = videos.join(anchor.select(*keys, F.col("height").alias("_a")), list(keys), "left").join(variation.select(*keys, F.col("height").alias("_v")), list(keys), "left")
    found = F.coalesce("_a", "_v", F.lit(0))
    over = found > F.col("frame_height") * c.max_fraction
    reason = F.when(over, "refused").when(F.col("_a").isNotNull(), "anchor").when(F.coalesce("_v", F.lit(0)) > 0, "variation").otherwise("none")
    return met.select(*keys, F.when(over, 0).otherwise(found).alias("height"), reason.alias("reason"))


def _touching(runs: DataFrame, own: list[str], cell: int = 64) -> DataFrame:
    """(own, u, v): pairs of runs of adjacent rows that touch, corners included. Columns are cut into cells, so a
    run meets what lies near it; a pair counts in the cell of its first common column."""
    cells = lambda a, z: F.explode(F.sequence(F.floor(a / cell).cast("int"), F.floor(z / cell).cast("int")))
    upper = runs.select(*own, (F.col("row") + 1).alias("row"), F.col("node").alias("v"), (F.col("a") - 1).alias("_a"), (F.col("z") + 1).alias("_z"))
    upper = upper.withColumn("_c", cells(F.col("_a"), F.col("_z")))
    lower = runs.select(*own, "row", F.col("node").alias("u"), "a", "z").withColumn("_c", cells(F.col("a"), F.col("z")))
    here = F.floor(F.greatest("a", "_a") / cell) == F.col("_c")
    return lower.join(upper, [*own, "row", "_c"]).where((F.col("a") <= F.col("_z")) & (F.col("_a") <= F.col("z")) & here).select(*own, "u", "v")


def components(edges: DataFrame, own: list[str]) -> DataFrame:
    """(own, u, v): each node u of edges(own, u, v) that isn't the least of its component, with that one. Nodes are
    hung on the least neighbour of all and of the lesser ones in turn, which takes few rounds however long a
    component is; a round is one table in the shared folder."""

    def least(e: DataFrame) -> Column:
        return F.min("v").over(W.partitionBy(*own, "u"))

    e, before = kept(edges.where("u <> v").distinct()), None
    while True:
        both = e.unionByName(e.select(*own, F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.withColumn("m", F.least("u", least(both))).where("v > u").select(*own, F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.withColumn("m", least(large))
        hung = small.select(*own, "u", F.col("m").alias("v")).unionByName(small.select(*own, F.col("v").alias("u"), F.col("m").alias("v")))
        e = kept(hung.where("u <> v").distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*own, "u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e
        before = now


#: Areas of frames of so many pixels at most are found in one task a frame; tasks hold so many changed pixels, or one frame's.
LARGE, HELD = 2**23, 2**20


def _areas(starts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(frame, n, sx, sy) of each area: its frame, pixels, and the sums of their columns, twice, and rows. The
    pixels (row << 32 + col) are in order by frame, which begin at starts; repeated ones count once."""
    frame = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(codes))))
    new = np.ones(len(codes), dtype=bool)
    new[1:] = (codes[1:] != codes[:-1]) | (frame[1:] != frame[:-1])
    frame, codes = frame[new], codes[new]
    new = np.ones(len(codes), dtype=bool)  # a run of neighbouring pixels of a row begins
    new[1:] = (codes[1:] != codes[:-1] + 1) | (frame[1:] != frame[:-1])
    first = np.flatnonzero(new)
    frame, a = frame[first], codes[first].astype(np.int32).astype(np.int64)
    row, n = (codes[first] - a) >> 32, np.diff(np.append(first, len(codes)))
    z = a + n - 1
    # rows are numbered; the runs of the row above that touch a run are neighbours in order
    new = np.ones(len(a), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (frame[1:] != frame[:-1])
    no, at = np.cumsum(new) - 1, np.flatnonzero(new)
    above = np.zeros(len(at), dtype=bool)
    above[1:] = (row[at[1:]] == row[at[:-1]] + 1) & (frame[at[1:]] == frame[at[:-1]])
    least = a.min()
    span = z.max() - least + 4
    low = np.flatnonzero(above[no])
    begin = np.searchsorted(no * span + z - least, (no[low] - 1) * span + a[low] - 1 - least, "left")
    end = np.searchsorted(no * span + a - least, (no[low] - 1) * span + z[low] + 1 - least, "right")
    k = np.maximum(end - begin, 0)
    u, v = np.repeat(low, k), np.repeat(begin - np.cumsum(k) + k, k) + np.arange(k.sum())
    # roots are hung on the least neighbour, or the greatest, in turn
    root, least = np.arange(len(a)), True
    while len(u):
        u, v = root[u], root[v]
        apart = u != v
        u, v = u[apart], v[apart]
        lesser, greater = np.minimum(u, v), np.maximum(u, v)
        np.minimum.at(root, greater, lesser) if least else np.maximum.at(root, lesser, greater)
        least = not least
        while not np.array_equal(up := root[root], root):
            root = up
    total = lambda x: np.bincount(root, x, len(root)).astype(np.int64)  # noqa: E731 (below 2**53)
    size, roots = total(n), np.unique(root)
    return frame[roots], size[roots], total((a + z) * n)[roots], total(row * n)[roots]


def _framewise(changes: DataFrame, own: list[str], least: int, most: int, width: int, height: int) -> DataFrame:
    """(own, x, y), by frame: a task reads its pixels in order and finds the areas of some frames at once."""
    code = F.shiftleft(F.col("row").cast("long"), 32) + F.col("col")
    dealt = changes.where("row IS NOT NULL AND col IS NOT NULL").select(*own, code.alias("_code")).repartition(*own).sortWithinPartitions(*own, "_code")

    def found(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        frame, n, sx, sy = _areas(starts, t["_code"].to_numpy())
        good = (n >= least) & (n <= most)
        frame, n, sx, sy = frame[good], n[good], sx[good], sy[good]
        keys = [t[c].take(pa.array(starts[frame])).combine_chunks() for c in own]
        return pa.RecordBatch.from_arrays([*keys, pa.array(sx / 2 / n / width), pa.array(sy / n / height)], names=[*own, "x", "y"])

    def run(batches):
        held, rows, wait = [], 0, HELD
        for b in batches:
            if not len(b):
                continue
            held.append(b)
            rows += len(b)
            if rows < wait:
                continue
            t = pa.Table.from_batches(held)
            starts = np.flatnonzero(group_begins(t, own))
            if len(starts) > 1:  # the last frame may go on
                yield found(t.slice(0, starts[-1]), starts[:-1])
            held = t.slice(starts[-1]).to_batches()
            rows = len(t) - int(starts[-1])
            wait = max(HELD, 2 * rows)
        if held:
            t = pa.Table.from_batches(held)
            yield found(t, np.flatnonzero(group_begins(t, own)))

    kinds = dealt.select(*own).schema.add("x", "double").add("y", "double")
    return dealt.mapInArrow(run, kinds)


def blobs(changes: DataFrame, width: int, height: int, c: Cursor = Cursor(), keys=KEY) -> DataFrame:
    """(keys, step, x, y): centres, normalised, of the 8-connected areas of changed pixels
    (keys, step, row, col) that are as large as a pointer (A09). A row's neighbouring pixels are one run, and
    runs of adjacent rows that touch are linked; repeated pixels count once. A frame is a group of one task,
    unless frames are LARGE: then its runs are linked by joins."""
    least = max(1, int(c.min_area * width * height))
    most = max(least + 1, int(c.max_area * width * height))
    own = [*keys, "step"]
    if width * height <= LARGE:
        return _framewise(changes, own, least, most, width, height)
    gap = F.col("col") - F.dense_rank().over(W.partitionBy(*own, "row").orderBy("col"))
    runs = changes.withColumn("_g", gap).groupBy(*own, "row", "_g").agg(F.min("col").alias("a"), F.max("col").alias("z"))
    runs = kept(runs.select(*own, "row", "a", "z", (F.shiftleft(F.col("row").cast("long"), 32) + F.col("a")).alias("node")))
    root = components(_touching(runs, own), own).select(*own, F.col("u").alias("node"), F.col("v").alias("root"))
    n = F.col("z") - F.col("a") + 1
    sums = [F.sum(n).alias("n"), F.sum((F.col("a") + F.col("z")) * n).alias("sx"), F.sum(F.col("row") * n).alias("sy")]
    met = runs.join(root, [*own, "node"], "left").groupBy(*own, F.coalesce("root", "node").alias("root")).agg(*sums)
    return met.where(F.col("n").between(least, most)).select(*own, (F.col("sx") / 2 / F.col("n") / width).alias("x"), (F.col("sy") / F.col("n") / height).alias("y"))


def select_frames(frames: DataFrame, c: ScreenText = ScreenText(), keys=KEY) -> DataFrame:
    """(keys, threshold, kept) over frames(keys, ts, v): few enough for the costly model (Q01, Q02)."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("ts").alias("at"), F.col("v"))))
    return frames.groupBy(*keys).agg(ordered.alias("_f")).select(*keys, capped_keep(F.col("_f"), c.change_ratio, c.max_frames).alias("s")).select(*keys, "s.*")
