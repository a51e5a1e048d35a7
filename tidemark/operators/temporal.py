"""Joins and runs over time. Every operator takes key columns (video_id by default) and shuffles by
them; where one key holds much, joins bucket time too, so no plan falls back to a nested loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scan import scan

KEY = ("video_id",)


def _sides(left: DataFrame, right: DataFrame, keys, skip=()) -> None:
    clash = (set(left.columns) & set(right.columns)) - set(keys) - set(skip)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")


def _bucket(c: Column, width: float) -> Column:
    return F.floor(c / width).cast("long")


#: A node of level k covers 2 ** k buckets; intervals beyond a node of this level take several of them.
TOP_LEVEL = 20


def _node(level: Column | int, no: Column) -> Column:
    return F.struct((F.lit(level) if isinstance(level, int) else level).alias("level"), no.alias("no"))


def _shift(c: Column, k: Column) -> Column:
    return F.call_function("shiftright", c, k)


def _cover(lo: Column, hi: Column) -> Column:
    """The fewest dyadic nodes (level, no) that cover the buckets lo to hi: two a level at most."""
    odd = lambda c: c.bitwiseAND(F.lit(1)) == 1

    def whole(k: Column) -> Column:
        """Of the nodes of a level that lie inside, those whose parents don't."""
        begin, end = -_shift(-lo, k), _shift(hi + 1, k)
        first = F.when(odd(begin) & (begin < end), _node(k, begin))
        last = F.when(odd(end) & (begin + begin.bitwiseAND(F.lit(1)) < end), _node(k, end - 1))
        top = F.when(begin < end, F.transform(F.sequence(begin, end - 1), lambda no: _node(k, no)))
        return F.when(k < TOP_LEVEL, F.array_compact(F.array(first, last))).otherwise(F.coalesce(top, F.array().cast("array<struct<level:int,no:bigint>>")))

    highest = F.least(F.lit(TOP_LEVEL), F.floor(F.log2((hi - lo + 1).cast("double"))).cast("int") + 1)
    short = F.when(lo == hi, F.array(_node(0, lo)))  # most intervals, without lambdas
    short = short.when((hi == lo + 1) & ~odd(lo), F.array(_node(1, F.shiftright(lo, 1)))).when(hi == lo + 1, F.array(_node(0, lo), _node(0, hi)))
    return short.otherwise(F.flatten(F.transform(F.sequence(F.lit(0), highest), whole)))


def _above(cover: str, lo: Column, hi: Column, levels: list[int]) -> Column:
    """The nodes of some levels that hold a smaller node of the cover: these lie at its ends."""
    nodes = []
    for k in levels:
        for end in (lo, hi):
            no = F.shiftright(end, k)
            inside = F.exists(cover, lambda o: (o["level"] < k) & (_shift(o["no"], F.lit(k) - o["level"]) == no))  # noqa: B023
            nodes.append(F.when(inside, _node(k, no)))
    return F.array_distinct(F.array_compact(F.array(*nodes))) if nodes else F.array().cast("array<struct<level:int,no:bigint>>")


def cover(start: Column, end: Column, width: float) -> Column:
    """The nodes of an interval's cover."""
    return _cover(_bucket(start, width), _bucket(end, width))


def holding(ts: Column, width: float, levels: list[int]) -> Column:
    """The nodes of some levels that hold an instant."""
    nodes = [_node(k, F.shiftright(_bucket(ts, width), k)) for k in levels]
    return F.array(*nodes) if nodes else F.array().cast("array<struct<level:int,no:bigint>>")


def cover_levels(covered: DataFrame) -> list[int]:
    """The levels that the covers _iv_own have: some small numbers."""
    return list(covered.select(F.explode("_iv_own").alias("n")).agg(F.sort_array(F.collect_set("n.level"))).first()[0])


def overlap_join(left: DataFrame, right: DataFrame, width: float, keys=KEY, l=("start", "end"), r=("first_seen", "last_seen"), margin: float = 0.0) -> DataFrame:
    """Pairs whose intervals overlap strictly, the left one widened by margin.

    Time is cut into buckets of `width`, and an interval is covered by dyadic nodes of buckets: a
    few rows, however long it is. Two intervals overlap where a node of one's cover is, or holds, a
    node of the other's. So the left covers meet the right covers and the nodes above them, and
    the right covers meet the nodes above the left ones, both by equality. A pair counts at the node
    that holds its first common bucket, which is in one of the two joins, once."""
    _sides(left, right, keys)
    lo, hi = F.col(l[0]) - margin, F.col(l[1]) + margin
    a = left.where(hi > lo).withColumns({"_iv_a": _bucket(lo, width), "_iv_z": _bucket(hi, width)}).withColumn("_iv_own", _cover(F.col("_iv_a"), F.col("_iv_z")))
    b = right.where(F.col(r[1]) >= F.col(r[0])).withColumns({"_iv_c": _bucket(F.col(r[0]), width), "_iv_y": _bucket(F.col(r[1]), width)})
    b = b.withColumn("_iv_own", _cover(F.col("_iv_c"), F.col("_iv_y")))
    at = lambda df, nodes: df.withColumn("_iv_n", F.explode(nodes)).drop("_iv_own")
    above_a, above_b = _above("_iv_own", F.col("_iv_a"), F.col("_iv_z"), cover_levels(b)), _above("_iv_own", F.col("_iv_c"), F.col("_iv_y"), cover_levels(a))
    met = at(a, F.col("_iv_own")).join(at(b, F.array_union("_iv_own", above_b)), [*keys, "_iv_n"])
    met = met.unionByName(at(a, above_a).join(at(b, F.col("_iv_own")), [*keys, "_iv_n"]))
    here = _shift(F.greatest("_iv_a", "_iv_c"), F.col("_iv_n.level")) == F.col("_iv_n.no")
    return met.where((F.col(r[1]) > lo) & (F.col(r[0]) < hi) & here).drop("_iv_n", "_iv_a", "_iv_z", "_iv_c", "_iv_y")


def point_join(points: DataFrame, intervals: DataFrame, width: float, keys=KEY, ts: str = "timestamp", iv=("start", "end"), margin: float = 0.0) -> DataFrame:
    """Pairs of a point and an interval that holds it, both ends included (J02, J03): the dyadic nodes of
    the interval's cover meet those that hold the point, one of each level that covers have."""
    _sides(points, intervals, keys)
    lo, hi = F.col(iv[0]) - margin, F.col(iv[1]) + margin
    b = intervals.where(hi >= lo).withColumn("_iv_own", cover(lo, hi, width))
    met = points.withColumn("_iv_n", F.explode(holding(F.col(ts), width, cover_levels(b)))).join(b.withColumn("_iv_n", F.explode("_iv_own")).drop("_iv_own"), [*keys, "_iv_n"])
    return met.where(F.col(ts).between(lo, hi)).drop("_iv_n")


def asof_join(probes: DataFrame, facts: DataFrame, values: list[str], keys=KEY, probe_ts: str = "ts", fact_ts: str = "timestamp", hold: float | None = None, slack: float = 0.0, spread: bool = False) -> DataFrame:
    """Each probe with the values of the latest fact at or before its time (+ slack), null after
    `hold` (J04, J05). One shuffle: the union of both sides, and a running last. Facts of one time:
    the greater values win. An empty value is a value. spread: for keys that hold much of the rows;
    the running last is carried from block to block of a key (see scan), and no task sorts a key."""
    fact = facts.select(*keys, (F.col(fact_ts) - slack).alias("_t"), F.lit(0).alias("_probe"), F.struct(F.col(fact_ts).alias("_at"), *values).alias("_fact"), F.lit(None).cast(probes.select(F.struct("*")).schema[0].dataType).alias("_row"))
    ask = probes.select(*keys, F.col(probe_ts).alias("_t"), F.lit(1).alias("_probe"), F.lit(None).cast(fact.schema["_fact"].dataType).alias("_fact"), F.struct("*").alias("_row"))
    both, order = fact.unionByName(ask), ("_t", "_probe", "_fact")
    if spread:
        last = scan(both, keys, order, lasts={"_last": F.col("_fact")}).where("_probe = 1")
    else:
        w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        last = both.withColumn("_last", F.last("_fact", ignorenulls=True).over(w)).where("_probe = 1")
    fresh = F.lit(True) if hold is None else F.col("_t") - F.col("_last._at") <= hold
    held = [F.when(fresh, F.col(f"_last.{v}")).alias(v) for v in values]
    return last.select("_row.*", *held, F.when(fresh, F.col("_last._at")).alias("fact_ts"))


def range_or_asof(segments: DataFrame, samples: DataFrame, width: float, margin: float, hold: float, keys=KEY) -> DataFrame:
    """segments(key, id, start, end) with `positions`: all samples(key, timestamp, x, y) inside, ends
    and margin included; else the one held at the start; else none (J06)."""
    own = [*keys, "id"]
    inside = point_join(samples, segments.select(*own, "start", "end"), width, keys, margin=margin)
    many = inside.groupBy(*own).agg(F.array_sort(F.collect_list(F.struct("timestamp", "x", "y"))).alias("_many"))
    held = asof_join(segments.select(*own, "start"), samples, ["x", "y"], keys, "start", hold=hold)
    one = held.select(*own, F.when(F.col("fact_ts").isNotNull(), F.array(F.struct(F.col("fact_ts").alias("timestamp"), "x", "y"))).alias("_one"))
    none = F.array().cast("array<struct<timestamp:double,x:double,y:double>>")
    return segments.join(many, own, "left").join(one, own, "left").withColumn("positions", F.coalesce("_many", "_one", none)).drop("_many", "_one")


def frame_grid(videos: DataFrame, interval: float, keys=KEY, n: str = "n_frames") -> DataFrame:
    """A row for each of n frames: frame, ts = round(frame * interval, 3)."""
    return videos.where(F.col(n) > 0).select(*keys, F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int"))).alias("frame")).withColumn("ts", F.round(F.col("frame") * interval, 3))


def overlaps(df: DataFrame, start: str = "source_start", end: str = "source_end", keys=KEY, order=("ord",), slack: float = 0.0, spread: bool = False) -> DataFrame:
    """Rows that start before the end of the row just before them; touching is fine (W01). spread: as
    in asof_join."""
    if spread:
        met = scan(df, keys, (start, *order), lags={"previous_end": F.col(end)})
    else:
        met = df.withColumn("previous_end", F.lag(end).over(W.partitionBy(*keys).orderBy(start, *order)))
    return met.where(F.col(start) < F.col("previous_end") - slack)


def exclusive_sum(value: Column, keys, *order) -> Column:
    """The sum of all rows before, 0 for the first."""
    return F.coalesce(F.sum(value).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))


def running_sum(df: DataFrame, value: Column, name: str, keys, order) -> DataFrame:
    """df with the sum of all rows before, 0 for the first, as exclusive_sum, for keys that hold much of
    the rows (W02 to W05)."""
    return scan(df, keys, order, sums={name: value})


def islands(df: DataFrame, value: str, ts: str, gap: float, keys=KEY, order=(), spread: bool = False) -> DataFrame:
    """df with `island`: a new one where the value changes or a gap opens (W08). spread: as in
    asof_join."""
    before = F.col("_before")
    new = before.isNull() | ~before["value"].eqNullSafe(F.col(value)) | before["ts"].isNull() | (F.col(ts) - before["ts"] > gap)
    one = F.struct(F.col(value).alias("value"), F.col(ts).alias("ts"))
    if spread:
        marked = scan(df, keys, (ts, *order), lags={"_before": one}).withColumn("_new", new.cast("long"))
        found = scan(marked, keys, (ts, *order), sums={"island": F.col("_new")}).withColumn("island", F.col("island") + F.col("_new"))
    else:
        w = W.partitionBy(*keys).orderBy(ts, *order)
        marked = df.withColumn("_before", F.lag(one).over(w)).withColumn("_new", new.cast("long"))
        found = marked.withColumn("island", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return found.drop("_new", "_before")


def first_run(df: DataFrame, good: Column, row: str, least: int, keys=KEY) -> DataFrame:
    """(keys, start, length) of the first run of so many consecutive rows that are good."""
    w = W.partitionBy(*keys).orderBy(row)
    runs = df.where(good).withColumn("_g", F.col(row) - F.row_number().over(w))
    found = runs.groupBy(*keys, "_g").agg(F.min(row).alias("start"), F.count(F.lit(1)).alias("length")).where(F.col("length") >= least)
    return found.groupBy(*keys).agg(F.min(F.struct("start", "length")).alias("_r")).select(*keys, "_r.start", "_r.length")


def nearest(pairs: DataFrame, dist: str, radius: float, keys, order) -> DataFrame:
    """Of each key the nearest partner within a radius, the first among equals."""
    w = W.partitionBy(*keys).orderBy(dist, *order)
    return pairs.where(F.col(dist) <= radius).withColumn("_no", F.row_number().over(w)).where("_no = 1").drop("_no")


def unique_pairs(before: DataFrame, after: DataFrame, tolerance: float, keys) -> DataFrame:
    """Where exactly one pair of blobs is within the square tolerance: the earlier blob's place."""
    b = after.select(*keys, F.col("x").alias("_x"), F.col("y").alias("_y"))
    met = before.join(b, list(keys)).where((F.abs(F.col("x") - F.col("_x")) <= tolerance) & (F.abs(F.col("y") - F.col("_y")) <= tolerance))
    return met.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("x"), F.min("y").alias("y")).where("n = 1").drop("n")


def moving_pointer(blobs: DataFrame, tolerance: float, keys=KEY) -> DataFrame:
    """The pointer in each frame, from blobs of changes: those between a frame and the one before,
    matched with those between it and the next (W14). blobs(keys, step, x, y): step i lies between
    frames i and i + 1."""
    return unique_pairs(blobs.withColumn("frame", F.col("step") + 1), blobs.withColumn("frame", F.col("step")), tolerance, [*keys, "frame"])


def stride_sample(df: DataFrame, most: int, order, keys=KEY) -> DataFrame:
    """Every max(1, n div most)-th row, the first `most` of them."""
    w = W.partitionBy(*keys)
    step = F.greatest(F.lit(1), F.expr(f"_n DIV {most}"))
    return df.withColumn("_n", F.count(F.lit(1)).over(w)).withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).where((F.col("_i") % step == 0) & (F.col("_i") < step * most)).drop("_n", "_i")


def last_wins(df: DataFrame, keys, order: str = "ord") -> DataFrame:
    """Of rows with one key the last."""
    return df.withColumn("_no", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(order)))).where("_no = 1").drop("_no")


def upsert(existing: DataFrame, new: DataFrame, keys) -> DataFrame:
    """Rows of the same key replaced, others added."""
    return existing.join(new, list(keys), "left_anti").unionByName(new)
