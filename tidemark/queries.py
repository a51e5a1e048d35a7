"""Queries over the test tables: each stands for one or more operators, with its SQL beside it.

conversations stand for narrated segments, events for samples over time, lineitem for boxes and
intervals, orders for shots, documents for texts, parts for labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .config import Layout, Retiming, ScreenText
from .functions import geometry as G
from .functions import text as T
from .operators import checks, segmentation, space, subtitles, temporal, timeline, tracking, vision
from .schemas import violations

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _seconds(c: str = "ts") -> Column:
    return F.unix_micros(F.col(c).cast("timestamp")) / 1e6


def _segments(spark: SparkSession, d: str) -> DataFrame:
    """conversations as decisions: 0.4 s a word, and the narration's length."""
    n = F.size(T.tokens(F.col("text"))).cast("double")
    c = _t(spark, d, "conversations").select("conv_id", "turn", "role", "text", F.greatest(n, F.lit(1.0)).alias("n"))
    said = F.col("n") * ((28 + 3 * ((7 * F.col("conv_id") + 3 * F.col("turn")) % 8)) / 100.0)  # the SQL's decimals, exact until they meet n
    return c.withColumns({"d": F.col("n") * 0.4, "said": said, "t": said + 0.4})


_SEG = r"""seg AS (SELECT *, n * 0.4 AS d, n * (0.28 + 0.03 * ((7 * conv_id + 3 * turn) % 8)) + 0.4 AS t FROM (
  SELECT conv_id, turn, role, text, CAST(greatest(len(list_filter(regexp_split_to_array(trim(text), '\s+'), lambda x: x <> '')), 1) AS DOUBLE) AS n FROM conversations))"""
_PLAN = """planned AS (SELECT *, CASE WHEN t <= d AND d - t <= 0.8 THEN d WHEN t <= d THEN least(d, greatest(t + 0.8, 1.2)) WHEN t / d <= 1.08 THEN d ELSE t / 1.08 END AS planned,
  CASE WHEN t <= d AND d - t <= 0.8 THEN 'kept' WHEN t <= d THEN 'shortened' WHEN t / d <= 1.08 THEN 'sped_up' ELSE 'extended' END AS outcome FROM seg)"""


@query(f"""WITH {_SEG}, {_PLAN}, at AS (SELECT *, coalesce(sum(d) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s,
  coalesce(sum(planned - d) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS shift FROM planned)
SELECT conv_id, turn, round(s + shift, 6) AS new_start, round(planned, 6) AS planned, outcome FROM at""".replace(" at AS", " moved AS").replace("FROM at", "FROM moved"))  # fmt: skip
def retime_segments(spark, d):
    s = _segments(spark, d)
    start = temporal.exclusive_sum(F.col("d"), ["conv_id"], "turn")
    zero = F.struct(F.lit("v").alias("voice"), F.lit(150).alias("pause_before_ms"), F.lit(250).alias("pause_after_ms"))
    decisions = s.select(F.col("conv_id").alias("video_id"), F.col("turn").alias("ord"), F.col("turn").cast("string").alias("id"), start.alias("source_start"), F.col("d").alias("length"), zero.alias("narration"))
    decisions = decisions.withColumn("source_end", F.col("source_start") + F.col("length"))
    said = s.select(F.col("conv_id").alias("video_id"), F.col("turn").cast("string").alias("segment_id"), F.col("said").alias("duration"))
    out = timeline.retime(decisions, said, length=F.col("length"))
    return out.select(F.col("video_id").alias("conv_id"), F.col("ord").alias("turn"), F.round("new_start", 6).alias("new_start"), F.round(F.col("new_end") - F.col("new_start"), 6).alias("planned"), "outcome")


@query("SELECT DISTINCT conv_id FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM conversations a WHERE a.conv_id = c.conv_id AND a.role = 'assistant')")
def retime_missing_narration(spark, d):
    c = _t(spark, d, "conversations").select(F.col("conv_id").alias("video_id"), "role")
    decisions = c.select("video_id", F.lit("answer").alias("id")).distinct()
    said = c.where("role = 'assistant'").select("video_id", F.lit("answer").alias("segment_id")).distinct()
    timeline_ = said.select("video_id", F.col("segment_id").alias("id"), F.lit("kept").alias("outcome"))
    warned = timeline.retime_warnings(decisions, said, timeline_)
    return warned.where("code = 'no_narration'").select(F.col("video_id").alias("conv_id"))


_IV = "iv AS (SELECT l_suppkey, l_orderkey, l_linenumber, epoch_us(l_shipdate) / 86400e6 AS s, epoch_us(l_shipdate) / 86400e6 + l_quantity AS e FROM lineitem)"


def _intervals(spark, d):
    s = _seconds("l_shipdate") / 86400
    return _t(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", s.alias("s"), (s + F.col("l_quantity")).alias("e"))


@query(f"""WITH {_IV}, p AS (SELECT *, lag(e) OVER (PARTITION BY l_suppkey ORDER BY s, l_orderkey, l_linenumber) AS pe FROM iv)
SELECT l_suppkey, count(*) AS n_overlaps, round(sum(pe - s), 4) AS days FROM p WHERE s < pe GROUP BY 1""")
def source_overlaps(spark, d):
    o = temporal.overlaps(_intervals(spark, d), "s", "e", ["l_suppkey"], ["l_orderkey", "l_linenumber"])
    return o.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_overlaps"), F.round(F.sum(F.col("previous_end") - F.col("s")), 4).alias("days"))


_SHOTS = "shots AS (SELECT o_custkey, o_orderkey, CAST(epoch_us(o_orderdate) // 86400000000 AS DOUBLE) - 8000 AS s FROM orders)"


def _shots(spark, d):
    day = F.floor(_seconds("o_orderdate") / 86400).cast("double") - 8000
    return _t(spark, d, "orders").select(F.col("o_custkey").alias("video_id"), F.col("o_orderkey").alias("ord"), F.col("o_orderkey").cast("string").alias("id"), day.alias("source_start"), (day + 20).alias("source_end"))


@query(f"""WITH {_SHOTS}, q AS (SELECT *, lag(s + 20, 1, 0.0) OVER (PARTITION BY o_custkey ORDER BY s, o_orderkey) AS c FROM shots),
ends AS (SELECT o_custkey, max_by(s + 20, (s, o_orderkey)) AS c FROM shots GROUP BY 1)
SELECT o_custkey, 'gap' AS kind, c AS start_day, s AS end_day, 0.0 AS extension FROM q WHERE s > c
UNION ALL SELECT o_custkey, 'segment', s, s + 20, CAST(o_orderkey % 3 AS DOUBLE) FROM shots
UNION ALL SELECT o_custkey, 'gap', c, 12000.0, 0.0 FROM ends WHERE 12000 > c""")
def gap_fill_pieces(spark, d):
    p = _pieces(spark, d)
    return p.select(F.col("video_id").alias("o_custkey"), "kind", F.col("start").alias("start_day"), F.col("end").alias("end_day"), "extension")


def _pieces(spark, d):
    s = _shots(spark, d)
    t = s.select("video_id", "id", F.lit(0.0).alias("new_start"), (F.lit(20.0) + F.col("ord") % 3).alias("new_end"))
    return timeline.pieces(s, t, s.select("video_id").distinct().withColumn("duration", F.lit(12000.0)))


@query(f"""WITH p AS ({ORACLE["gap_fill_pieces"]}), w AS (SELECT *, coalesce(sum(end_day - start_day + extension) OVER (PARTITION BY o_custkey ORDER BY start_day, kind, end_day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS piece_at FROM p)
SELECT o_custkey, count(*) AS n, sum(end_day - start_day + extension) AS total, max(piece_at) AS last_at FROM w GROUP BY 1""")
def piece_starts(spark, d):
    p = _pieces(spark, d)
    last = p.groupBy("video_id").agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("last_at"))
    return timeline.total_duration(p).join(last, "video_id").withColumnRenamed("video_id", "o_custkey")


@query(f"""WITH {_SEG}, s AS (SELECT *, sum(d) OVER w0 AS total, count(*) OVER w0 AS k, coalesce(sum(d) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM seg WINDOW w0 AS (PARTITION BY conv_id)),
f AS (SELECT *, least(6, CAST(round_even(total / 35, 0) AS INT)) AS parts FROM s), g AS (SELECT *, least(parts - 1, CAST(floor((b + d / 2) / total * parts) AS INT)) AS bucket FROM f WHERE parts >= 2 AND k >= 2 * parts)
SELECT conv_id, turn, dense_rank() OVER (PARTITION BY conv_id ORDER BY bucket) - 1 AS slice FROM g""")
def duration_slices(spark, d):
    s = _segments(spark, d)
    return timeline.duration_slices(s, F.col("d"), ["turn"], Layout(chapter_seconds=35.0), ["conv_id"]).select("conv_id", "turn", F.col("slice").cast("long").alias("slice"))


@query("""WITH e AS (SELECT user_id, event_type, epoch_us(ts) / 1e6 AS s FROM events), f AS (SELECT user_id, event_type, min(s) AS a FROM e GROUP BY 1, 2), x AS (SELECT user_id, max(s) AS total FROM e GROUP BY 1),
n AS (SELECT f.*, total, row_number() OVER w AS no, count(*) OVER (PARTITION BY user_id) AS k FROM f JOIN x USING (user_id) WINDOW w AS (PARTITION BY user_id ORDER BY event_type)),
z AS (SELECT *, CASE WHEN no = 1 THEN 0.0 ELSE a END AS b FROM n), y AS (SELECT *, coalesce(lead(b) OVER (PARTITION BY user_id ORDER BY no), total) AS e FROM z)
SELECT user_id, event_type, b AS start_s, e AS end_s, no || '/' || k AS label FROM y WHERE e > b""")
def chapter_windows(spark, d):
    e = _t(spark, d, "events").select(F.col("user_id").alias("video_id"), "event_type", _seconds().alias("s"))
    first = e.groupBy("video_id", "event_type").agg(F.min("s").alias("at")).withColumnsRenamed({"event_type": "id"}).withColumn("kind", F.lit("segment"))
    chapters = first.select("video_id", F.col("id").alias("ord"), F.col("id").alias("title"), F.col("id").alias("first_segment"))
    w = timeline.chapter_windows(chapters, first, e.groupBy("video_id").agg(F.max("s").alias("total")))
    return w.select(F.col("video_id").alias("user_id"), F.col("title").alias("event_type"), F.col("start").alias("start_s"), F.col("end").alias("end_s"), "label")


def _events(spark, d):
    return _t(spark, d, "events").select("user_id", "event_id", "event_type", "value", _seconds().alias("s"))


def _track(spark, d, y: float):
    """events as pointer tracks: a video for each user, a sample for each event, two a second in order of time."""
    at = (F.row_number().over(W.partitionBy("user_id").orderBy("s", "event_id")) - 1) * 0.5
    return _events(spark, d).select(F.col("user_id").cast("long").alias("video_id"), at.alias("timestamp"), F.abs(F.col("value") % 1).alias("x"), F.lit(y).alias("y"))


def _part_video() -> Column:
    """The video that shows a part: 16 parts each, so that videos grow with the table."""
    return F.floor(F.col("p_partkey") / 16).cast("long").alias("video_id")


@query("""WITH e AS (SELECT *, epoch_us(ts) / 1e6 AS s FROM events), v AS (SELECT user_id, s AS vs, value FROM e WHERE event_type = 'view' QUALIFY row_number() OVER (PARTITION BY user_id, s ORDER BY value DESC) = 1)
SELECT p.user_id, p.event_id, CASE WHEN p.s - v.vs <= 86400 THEN v.value END AS held FROM (SELECT * FROM e WHERE event_type = 'purchase') p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.s >= v.vs""")
def asof_hold(spark, d):
    e = _events(spark, d)
    views = e.where("event_type = 'view'").select("user_id", F.col("s").alias("timestamp"), F.col("value").alias("held"))
    return temporal.asof_join(e.where("event_type = 'purchase'").select("user_id", "event_id", "s"), views, ["held"], ["user_id"], "s", hold=86400.0).select("user_id", "event_id", "held")


@query("""WITH e AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS s FROM events), b AS (SELECT user_id, floor(min(s)) AS s0 FROM e GROUP BY 1), g AS (SELECT user_id, CAST(i AS INT) AS frame, s0 + i * 21600 AS s FROM b, range(120) r(i)),
f AS (SELECT user_id, s AS fs, max(event_id) AS event_id FROM e GROUP BY 1, 2)
SELECT g.user_id, g.frame, f.event_id AS latest FROM g ASOF LEFT JOIN f ON g.user_id = f.user_id AND g.s + 1e-9 >= f.fs""")
def asof_fill_grid(spark, d):
    e = _events(spark, d)
    grid = temporal.frame_grid(e.groupBy("user_id").agg(F.floor(F.min("s")).cast("double").alias("s0")).withColumn("n_frames", F.lit(120)), 21600.0, ["user_id"])
    grid = grid.join(e.groupBy("user_id").agg(F.floor(F.min("s")).cast("double").alias("s0")), "user_id").withColumn("ts", F.col("s0") + F.col("ts"))
    facts = e.select("user_id", F.col("s").alias("timestamp"), F.col("event_id").alias("latest"))
    return temporal.asof_join(grid, facts, ["latest"], ["user_id"], slack=1e-9).select("user_id", "frame", "latest")


_HOT = "CASE WHEN user_id % 10 = 0 THEN user_id ELSE 0 END"


def _hot_events(spark, d):
    """events with one key for nine tenths of them."""
    return _events(spark, d).withColumn("hot", F.expr(_HOT).cast("long"))


@query(f"""WITH e AS (SELECT *, {_HOT} AS hot, epoch_us(ts) / 1e6 AS s FROM events), v AS (SELECT hot, s AS vs, value FROM e WHERE event_type = 'view' QUALIFY row_number() OVER (PARTITION BY hot, s ORDER BY value DESC) = 1)
SELECT p.hot, p.event_id, CASE WHEN p.s - v.vs <= 60 THEN v.value END AS held FROM (SELECT * FROM e WHERE event_type = 'purchase') p ASOF LEFT JOIN v ON p.hot = v.hot AND p.s >= v.vs""")
def hot_hold(spark, d):
    e = _hot_events(spark, d)
    views = e.where("event_type = 'view'").select("hot", F.col("s").alias("timestamp"), F.col("value").alias("held"))
    asks = e.where("event_type = 'purchase'").select("hot", "event_id", "s")
    return temporal.asof_join(asks, views, ["held"], ["hot"], "s", hold=60.0, spread=True).select("hot", "event_id", "held")


@query(f"""WITH e AS (SELECT {_HOT} AS hot, event_id, event_type, epoch_us(ts) / 1e6 AS s FROM events), f AS (SELECT *, CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type OR s - lag(s) OVER w > 600 OR lag(s) OVER w IS NULL THEN 1 ELSE 0 END AS n FROM e WINDOW w AS (PARTITION BY hot ORDER BY s, event_id)),
i AS (SELECT *, sum(n) OVER (PARTITION BY hot ORDER BY s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM f)
SELECT hot, event_type, min(s) AS start_s, max(s) AS end_s, count(*) AS n FROM i GROUP BY hot, event_type, island""")
def hot_islands(spark, d):
    i = temporal.islands(_hot_events(spark, d), "event_type", "s", 600.0, ["hot"], ["event_id"], spread=True)
    return i.groupBy("hot", "event_type", "island").agg(F.min("s").alias("start_s"), F.max("s").alias("end_s"), F.count(F.lit(1)).alias("n")).drop("island")


_LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(f"""WITH iv AS (SELECT l_returnflag, {", ".join(_LINE)}, epoch_us(l_shipdate) / 86400e6 AS s, epoch_us(l_shipdate) / 86400e6 + l_quantity AS e FROM lineitem),
p AS (SELECT *, lag(e) OVER (PARTITION BY l_returnflag ORDER BY s, {", ".join(_LINE)}, e) AS pe FROM iv)
SELECT l_returnflag, l_orderkey, l_linenumber, round(pe - s, 6) AS days FROM p WHERE s < pe""")
def hot_overlaps(spark, d):
    s = _seconds("l_shipdate") / 86400
    iv = _t(spark, d, "lineitem").select("l_returnflag", *_LINE, s.alias("s"), (s + F.col("l_quantity")).alias("e"))
    o = temporal.overlaps(iv, "s", "e", ["l_returnflag"], [*_LINE, "e"], spread=True)
    return o.select("l_returnflag", "l_orderkey", "l_linenumber", F.round(F.col("previous_end") - F.col("s"), 6).alias("days"))


@query(f"""SELECT l_returnflag, l_orderkey, l_linenumber, CAST(coalesce(sum(l_quantity) OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, {", ".join(_LINE)}, l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS starts FROM lineitem""")
def hot_starts(spark, d):
    li = _t(spark, d, "lineitem").select("l_returnflag", "l_shipdate", *_LINE, "l_quantity")
    out = temporal.running_sum(li, F.col("l_quantity").cast("double"), "starts", ["l_returnflag"], ["l_shipdate", *_LINE, "l_quantity"])
    return out.select("l_returnflag", "l_orderkey", "l_linenumber", "starts")


@query(f"""WITH {_IV}, o AS (SELECT o_orderkey, epoch_us(o_orderdate) / 86400e6 AS a FROM orders)
SELECT l.l_suppkey, l.l_orderkey, l.l_linenumber, r.l_linenumber AS other, round(greatest(least(r.e, l.e) - greatest(r.s, l.s), 0) / (l.e - l.s), 6) AS visible
FROM iv l JOIN iv r ON l.l_orderkey = r.l_orderkey AND l.l_linenumber <> r.l_linenumber AND r.e > l.s - 1 AND r.s < l.e + 1""")
def interval_overlap_join(spark, d):
    a = _intervals(spark, d)
    b = a.select("l_orderkey", F.col("l_linenumber").alias("other"), F.col("s").alias("first_seen"), F.col("e").alias("last_seen"))
    met = temporal.overlap_join(a, b, 64.0, ["l_orderkey"], ("s", "e"), margin=1.0).where("l_linenumber <> other")
    return met.select("l_suppkey", "l_orderkey", "l_linenumber", "other", F.round(G.visible_share(F.col("first_seen"), F.col("last_seen"), F.col("s"), F.col("e")), 6).alias("visible"))


@query("""WITH e AS (SELECT *, epoch_us(ts) / 1e6 AS s FROM events)
SELECT p.event_id AS purchase, count(*) AS n, round(sum(x.value), 6) AS total FROM e p JOIN e x ON x.user_id = p.user_id AND x.s BETWEEN p.s - 43200 AND p.s + 43200 WHERE p.event_type = 'purchase' GROUP BY 1""")
def point_in_interval(spark, d):
    e = _events(spark, d)
    windows = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase"), F.col("s").alias("start"), F.col("s").alias("end"))
    met = temporal.point_join(e.select("user_id", "s", "value"), windows, 86400.0, ["user_id"], "s", margin=43200.0)
    return met.groupBy("purchase").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))


@query("""WITH p AS (SELECT c_custkey, s_suppkey, greatest(c_acctbal / 10000 - s_acctbal / 10000, 0, s_acctbal / 10000 - c_acctbal / 10000 - 0.05) AS dx FROM customer JOIN supplier ON c_nationkey = s_nationkey)
SELECT c_custkey, s_suppkey, round(sqrt(dx * dx), 6) AS dist FROM p WHERE sqrt(dx * dx) <= 0.2 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY sqrt(dx * dx), s_suppkey) = 1""")
def nearest_in_radius(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n"), G.make_box(F.col("c_acctbal") / 10000, F.lit(0.0), F.lit(0.05), F.lit(1.0)).alias("box"))
    s = _t(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n"), (F.col("s_acctbal") / 10000).alias("x"), F.lit(0.5).alias("y"))
    met = space.nearest_points(s, c, 0.2, ["c_custkey"], "s_suppkey", ["n"])
    return met.select("c_custkey", "s_suppkey", F.round("dist", 6).alias("dist"))


@query("""WITH b AS (SELECT user_id, event_id, value / 1000 AS x, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM events), g AS (SELECT user_id, (no - 1) // 3 AS f, x FROM b)
SELECT a.user_id, a.f AS frame, round(min(a.x), 9) AS x FROM g a JOIN g b ON a.user_id = b.user_id AND a.f + 1 = b.f AND abs(a.x - b.x) <= 0.01 GROUP BY 1, 2 HAVING count(*) = 1""")
def unique_pair_match(spark, d):
    w = W.partitionBy("user_id").orderBy("s", "event_id")
    b = _events(spark, d).select("user_id", F.floor((F.row_number().over(w) - 1) / 3).cast("long").alias("f"), (F.col("value") / 1000).alias("x"), F.lit(0.0).alias("y"))
    met = temporal.unique_pairs(b.withColumnRenamed("f", "frame"), b.withColumn("frame", F.col("f") - 1).drop("f"), 0.01, ["user_id", "frame"])
    return met.select("user_id", "frame", F.round("x", 9).alias("x"))


@query("""WITH e AS (SELECT user_id, event_id, event_type, epoch_us(ts) / 1e6 AS s FROM events), f AS (SELECT *, CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type OR s - lag(s) OVER w > 86400 OR lag(s) OVER w IS NULL THEN 1 ELSE 0 END AS n FROM e WINDOW w AS (PARTITION BY user_id ORDER BY s, event_id)),
i AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM f)
SELECT user_id, event_type, min(s) AS start_s, max(s) AS end_s, count(*) AS n FROM i GROUP BY user_id, event_type, island HAVING count(*) >= 2""")
def hover_islands(spark, d):
    i = temporal.islands(_events(spark, d), "event_type", "s", 86400.0, ["user_id"], ["event_id"])
    return i.groupBy("user_id", "event_type", "island").agg(F.min("s").alias("start_s"), F.max("s").alias("end_s"), F.count(F.lit(1)).alias("n")).where("n >= 2").drop("island")


@query("""WITH e AS (SELECT user_id, epoch_us(ts) / 1e6 AS s, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) = 1), n AS (SELECT *, lead(s) OVER w AS ns, lead(value) OVER w AS nv FROM e WINDOW w AS (PARTITION BY user_id ORDER BY s)),
p AS (SELECT user_id, s, value, CASE WHEN ns - s <= 20000 THEN ns ELSE least(coalesce(ns, s + 60000), s + 60000) END AS e, CASE WHEN ns - s <= 20000 THEN nv ELSE value END AS v1 FROM n)
SELECT user_id, count(*) AS n, round(sum(CASE WHEN e > s THEN value + (v1 - value) * (i * 7200) / (e - s) ELSE value END), 3) AS total FROM (SELECT *, unnest(range(greatest(1, CAST(trunc((e - s) / 7200) AS INT)))) AS i FROM p) GROUP BY 1""")
def spans_and_grid(spark, d):
    from .config import Cursor, Hover
    from .operators import cursor

    w = W.partitionBy("user_id", "s").orderBy("event_id")
    e = _events(spark, d).withColumn("no", F.row_number().over(w)).where("no = 1").select(F.col("user_id").alias("video_id"), F.col("s").alias("timestamp"), F.col("value").alias("x"), F.lit(0.0).alias("y"))
    s = cursor.spans(e, Cursor(fps=1.0), Hover(contiguous=20000.0, max_hold=60000.0))
    return cursor.held_positions(s, 7200.0).groupBy(F.col("video_id").alias("user_id")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("x"), 3).alias("total"))


@query("""WITH e AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM events), g AS (SELECT *, no - row_number() OVER (PARTITION BY user_id ORDER BY no) AS k FROM e WHERE value > 20), r AS (SELECT user_id, min(no) AS s, count(*) AS n FROM g GROUP BY user_id, k HAVING count(*) >= 3)
SELECT user_id, min(s) AS start_no, min_by(n, s) AS length FROM r GROUP BY 1""")
def first_run(spark, d):
    e = _events(spark, d).withColumn("no", F.row_number().over(W.partitionBy("user_id").orderBy("s", "event_id")))
    return temporal.first_run(e, F.col("value") > 20, "no", 3, ["user_id"]).withColumnRenamed("start", "start_no")


_KEEP = """r AS (SELECT user_id, no, value, value AS last FROM e WHERE no = 1
  UNION ALL SELECT e.user_id, e.no, e.value, CASE WHEN abs(e.value - r.last) >= 100 THEN e.value ELSE r.last END FROM r JOIN e ON e.user_id = r.user_id AND e.no = r.no + 1)"""


@query(f"""WITH RECURSIVE e AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM events), {_KEEP},
k AS (SELECT *, lag(last) OVER (PARTITION BY user_id ORDER BY no) AS p FROM r) SELECT user_id, count(*) FILTER (no = 1 OR abs(value - p) >= 100) AS kept, round(sum(value) FILTER (no = 1 OR abs(value - p) >= 100), 6) AS total FROM k GROUP BY 1""")
def greedy_change_select(spark, d):
    e = _events(spark, d).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct(F.struct("s", "event_id").alias("at"), F.col("value").alias("v")))).alias("v"))
    kept = e.select("user_id", vision.greedy_keep(F.col("v"), F.lit(100.0)).alias("k"))
    return kept.select("user_id", F.size("k").cast("long").alias("kept"), F.round(F.aggregate("k", F.lit(0.0), lambda a, x: a + x["v"]), 6).alias("total"))


@query("""WITH v AS (SELECT user_id, list({'last': value / 1000, 'k': 1} ORDER BY ts, event_id) AS vs FROM events GROUP BY 1), t AS (SELECT unnest(range(8)) AS i),
tried AS (SELECT user_id, i, 0.01 * 2.0 ** i AS threshold, list_reduce(vs, lambda a, x: CASE WHEN abs(x.last - a.last) >= 0.01 * 2.0 ** i THEN {'last': x.last, 'k': a.k + 1} ELSE a END).k AS k FROM v, t)
SELECT user_id, coalesce(min(threshold) FILTER (k <= 20), max(threshold)) AS threshold, least(20, coalesce(max(k) FILTER (k <= 20), min(k))) AS kept FROM tried GROUP BY 1""")
def capped_select(spark, d):
    e = _events(spark, d).select("user_id", F.struct("s", "event_id").alias("ts"), (F.col("value") / 1000).alias("v"))
    s = vision.select_frames(e, ScreenText(change_ratio=0.01, max_frames=20), ["user_id"])
    return s.select("user_id", "threshold", F.size("kept").alias("kept"))


@query("""WITH RECURSIVE e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS no,
  list_transform(range(32), lambda j: CAST(floor(abs(value) / (j + 1)) AS BIGINT) * 37 % 256) AS px FROM events),
steps(threshold) AS (VALUES (0.0625), (0.125), (0.25), (0.5), (1.0)),
r AS (
  SELECT user_id, threshold, no, px AS ref, true AS hit FROM e, steps WHERE no = 0
  UNION ALL
  SELECT user_id, threshold, no, CASE WHEN hit THEN px ELSE ref END, hit FROM (
    SELECT e.user_id, r.threshold, e.no, e.px, r.ref, list_sum(list_transform(range(32), lambda j: CASE WHEN abs(e.px[j + 1] - r.ref[j + 1]) > 25 THEN 1 ELSE 0 END)) / 32.0 >= r.threshold AS hit
    FROM r JOIN e ON e.user_id = r.user_id AND e.no = r.no + 1)),
k AS (SELECT user_id, threshold, list(no ORDER BY no) FILTER (hit) AS kept FROM r GROUP BY 1, 2)
SELECT user_id, CAST(threshold AS DOUBLE) AS threshold, array_to_string(kept[1:20], ',') AS kept FROM k
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY len(kept) > 20, CASE WHEN len(kept) > 20 THEN -threshold ELSE threshold END) = 1""")
def pixel_select(spark, d):
    from .operators import frames

    shade = lambda j: F.floor(F.abs("value") / (j + 1)).cast("long") * 37 % 256
    no = F.row_number().over(W.partitionBy("user_id").orderBy("s", "event_id")) - 1
    shown = _events(spark, d).select("user_id", no.alias("frame"), frames.pack(F.transform(F.sequence(F.lit(0), F.lit(31)), shade)).alias("pixels"))
    out = frames.choose(shown, ScreenText(change_ratio=0.0625, max_frames=20), ["user_id"], block=16)
    return out.select("user_id", "threshold", F.array_join("kept", ",").alias("kept"))


@query(r"""WITH w AS (SELECT conv_id, turn, unnest(regexp_split_to_array(trim(text), '\s+')) AS word, generate_subscripts(regexp_split_to_array(trim(text), '\s+'), 1) AS i FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, i) AS pos FROM w WHERE word <> ''), s AS (SELECT *, coalesce(sum(CAST(regexp_matches(lag_word, '[.!?…]$') AS INT)) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS sentence
 FROM (SELECT *, lag(word) OVER (PARTITION BY conv_id ORDER BY pos) AS lag_word FROM n)) SELECT conv_id, CAST(sentence AS BIGINT) AS sentence, count(*) AS n_words, min(pos) AS first_pos FROM s GROUP BY 1, 2""")
def sentence_ids(spark, d):
    words = F.transform(T.tokens(F.col("text")), lambda w: F.struct(w.alias("text"), F.lit(0.0).alias("start"), F.lit(0.0).alias("end")))
    c = _t(spark, d, "conversations").select("conv_id", F.col("turn").alias("ord"), words.alias("words"))
    s = segmentation.sentence_ids(segmentation.word_table(c, ["conv_id"]), ["conv_id"])
    return s.groupBy("conv_id", F.col("sentence").cast("long").alias("sentence")).agg(F.count(F.lit(1)).alias("n_words"), F.min("pos").cast("long").alias("first_pos"))


@query()
def split_segments(spark, d):
    w = F.transform(T.tokens(F.col("text")), lambda x, i: F.struct(x.alias("text"), (F.col("turn") * 100 + i * 0.4).alias("start"), (F.col("turn") * 100 + i * 0.4 + 0.32).alias("end")))
    c = _t(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("video_id"), F.col("turn").alias("ord"), F.lit("s").alias("id"), F.lit(0.0).alias("start"), F.lit(1.0).alias("end"), F.col("text").alias("text_fr"), w.alias("words"))
    return segmentation.split_transcript(c)


@query(r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(trim(text), '\s+'), lambda x: x <> '') AS ws FROM documents),
l AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN '' ELSE list_reduce(ws, lambda a, x: a || CASE WHEN length(split_part(a, chr(10), -1)) + 1 + length(x) <= 42 THEN ' ' ELSE chr(10) END || x) END AS t FROM w)
SELECT doc_id, CASE WHEN t = '' THEN 0 ELSE length(t) - length(replace(t, chr(10), '')) + 1 END AS n_lines, md5(t) AS digest FROM l""")
def wrap_lines(spark, d):
    out = _t(spark, d, "documents").select("doc_id", subtitles.wrap_lines(T.tokens(F.col("text")), 42).alias("lines"))
    return out.select("doc_id", F.size("lines").alias("n_lines"), F.md5(F.array_join("lines", "\n").cast("binary")).alias("digest"))


@query(r"""WITH w AS (SELECT conv_id, turn, len(list_filter(regexp_split_to_array(trim(text), '\s+'), lambda x: x <> '')) AS n FROM conversations), c AS (SELECT conv_id, turn, n, unnest(range((n + 11) // 12)) AS cue FROM w WHERE n > 0),
k AS (SELECT *, least(12, n - 12 * cue) AS k FROM c), t AS (SELECT *, 20.0 * (12 * cue) / n AS s, 20.0 * (12 * cue + k) / n AS e FROM k)
SELECT conv_id, turn, CAST(cue AS INT) AS cue, round(s, 6) AS start_s, round(e, 6) AS end_s, printf('%02d:%02d:%02d,%03d', CAST(round_even(s * 1000, 0) AS BIGINT) // 3600000, CAST(round_even(s * 1000, 0) AS BIGINT) // 60000 % 60, CAST(round_even(s * 1000, 0) AS BIGINT) // 1000 % 60, CAST(round_even(s * 1000, 0) AS BIGINT) % 1000) AS stamp FROM t""")
def cue_timing(spark, d):
    c = _t(spark, d, "conversations").select("conv_id", "turn", F.size(T.tokens(F.col("text"))).alias("words")).where("words > 0")
    split = c.withColumn("cue", F.explode(F.sequence(F.lit(0), F.floor((F.col("words") - 1) / 12).cast("int")))).withColumn("n", F.least(F.lit(12), F.col("words") - 12 * F.col("cue")))
    split = split.select("conv_id", F.col("turn").alias("id"), F.lit(0.0).alias("new_start"), F.lit(20.0).alias("new_end"), "cue", F.array(F.col("cue").cast("string")).alias("lines"), "n")
    t = subtitles.cue_times(split, ["conv_id"])
    return t.select("conv_id", F.col("id").alias("turn"), F.col("lines")[0].cast("int").alias("cue"), F.round("start", 6).alias("start_s"), F.round("end", 6).alias("end_s"), T.srt_time(F.col("start")).alias("stamp"))


@query(r"""WITH RECURSIVE w AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(trim(text), '\s+'), lambda x: x <> '') AS ws FROM conversations),
sums AS (SELECT *, len(ws) AS n, list_transform(range(len(ws) + 1), lambda i: i + coalesce(list_sum(list_transform(ws[:i], lambda x: length(x))), 0)) AS ends,
  list_transform(ws, lambda x: CASE WHEN right(x, 1) IN ('.', '!', '?', '…') THEN 2 WHEN right(x, 1) IN (',', ';', ':') THEN 1 ELSE 0 END) AS marks FROM w),
cue AS (
  SELECT conv_id, turn, 0 AS no, CAST(0 AS BIGINT) AS start, CAST(0 AS BIGINT) AS stop, CAST([] AS VARCHAR[]) AS lines FROM sums WHERE n > 0
  UNION ALL
  SELECT conv_id, turn, no, start, stop, list_filter([array_to_string(ws[start + 1 : least(one, stop)], ' '), array_to_string(ws[one + 1 : stop], ' ')], lambda x: x <> '')
  FROM (SELECT *, CASE WHEN two < n AND best // 1000000 > 0 THEN best % 1000000 ELSE two END AS stop
    FROM (SELECT *, list_max(list_transform(range(start + greatest(1, CAST(trunc((two - start) * 0.5) AS BIGINT)), two + 1), lambda i: marks[i] * 1000000 + i)) AS best
      FROM (SELECT *, CASE WHEN one < n THEN greatest(one + 1, len(list_filter(ends, lambda x: x <= ends[one + 1] + 43)) - 1) ELSE one END AS two
        FROM (SELECT s.*, c.no + 1 AS no, c.stop AS start, greatest(c.stop + 1, len(list_filter(s.ends, lambda x: x <= s.ends[c.stop + 1] + 43)) - 1) AS one
          FROM cue c JOIN sums s USING (conv_id, turn) WHERE c.stop < s.n))))),
timed AS (SELECT c.conv_id, c.turn, c.no, c.lines, turn * 20.0 + 20.0 * c.start / s.n AS a, turn * 20.0 + 20.0 * c.stop / s.n AS b FROM cue c JOIN sums s USING (conv_id, turn) WHERE c.no > 0),
ms AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, no) AS idx, CAST(round_even(a * 1000, 0) AS BIGINT) AS x, CAST(round_even(b * 1000, 0) AS BIGINT) AS y FROM timed)
SELECT conv_id AS video_id, idx AS "index", round(a, 6) AS start_s, round(b, 6) AS end_s, printf('%d' || chr(10) || '%02d:%02d:%02d,%03d --> %02d:%02d:%02d,%03d', idx, x // 3600000, x // 60000 % 60, x // 1000 % 60, x % 1000,
  y // 3600000, y // 60000 % 60, y // 1000 % 60, y % 1000) || chr(10) || array_to_string(lines, chr(10)) AS block FROM ms""")
def split_cues(spark, d):
    c = _t(spark, d, "conversations").select(F.col("conv_id").alias("video_id"), F.col("turn").cast("string").alias("id"), F.col("text").alias("text_en"), (F.col("turn") * 20.0).alias("new_start"), (F.col("turn") * 20.0 + 20).alias("new_end"))
    out = subtitles.srt_blocks(subtitles.cues(c.select("video_id", "id", "text_en"), c.select("video_id", "id", "new_start", "new_end")))
    return out.select("video_id", "index", F.round("start", 6).alias("start_s"), F.round("end", 6).alias("end_s"), "block")


@query(r"""SELECT doc_id, md5(regexp_replace(lower(strip_accents(trim(text))), '\s+', ' ', 'g')) AS norm FROM documents""")
def normalize_keys(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.md5(T.normalize(F.col("text")).cast("binary")).alias("norm"))


@query("""SELECT p_partkey, CASE WHEN replace(n, ' ', '') = 'azure' THEN 1.0 WHEN contains(replace(n, ' ', ''), 'azure') THEN round(0.5 + 0.5 * least(1.0, 5.0 / length(replace(n, ' ', ''))), 4) ELSE 0.0 END AS score FROM (SELECT p_partkey, lower(trim(p_name)) AS n FROM part)""")
def label_score(spark, d):
    return _t(spark, d, "part").select("p_partkey", T.label_score(F.lit("azure"), T.normalize(F.col("p_name"))).alias("score"))


_TERMS = [("les", "the"), ("la tion", "the tion"), ("mentoi", "mention")]


@query(r"""WITH n AS (SELECT doc_id, regexp_replace(lower(strip_accents(trim(text))), '\s+', ' ', 'g') AS t FROM documents)
SELECT doc_id, regexp_matches(t, '\bles[sx]?\b') AS has_les, regexp_matches(t, '\bmentoi[sx]?\b') AS has_mentoi FROM n""")
def glossary_terms(spark, d):
    has = lambda fr: F.exists("terms", lambda t: t["fr"] == fr)
    found = _t(spark, d, "documents").select("doc_id", T.relevant_terms(F.col("text"), _TERMS).alias("terms"))
    return found.select("doc_id", has("les").alias("has_les"), has("mentoi").alias("has_mentoi"))


@query(r"""WITH n AS (SELECT doc_id, regexp_replace(lower(strip_accents(trim(text))), '\s+', ' ', 'g') AS t FROM documents),
r AS (SELECT doc_id, t, regexp_replace(regexp_replace(regexp_replace(t, '\bla\s+tion[sx]?\b', 'the tion', 'g'), '\bmentoi[sx]?\b', 'mention', 'g'), '\bles[sx]?\b', 'the', 'g') AS u FROM n)
SELECT doc_id, md5(nullif(u, t)) AS digest FROM r""")
def term_translate(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.md5(T.translate_terms(T.normalize(F.col("text")), _TERMS).cast("binary")).alias("digest"))


def _glossary(spark, d):
    """A glossary from the tables: words of conversations as terms of one to three words."""
    ws = F.filter(F.split(F.trim(F.regexp_replace(T.normalize(F.col("text")), "[^a-z0-9]+", " ")), " "), lambda x: x != "")
    w = _t(spark, d, "conversations").where("turn < 2").select(ws.alias("ws"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n")).where("size(ws) >= 2 * n")
    return w.select(F.array_join(F.slice("ws", F.col("n") + 1, F.col("n")), " ").alias("fr")).distinct().select("fr", F.upper("fr").alias("en"))


@query()
def glossary_join(spark, d):
    from .operators import glossary

    c = _t(spark, d, "conversations").select("conv_id", "turn", "text")
    found = glossary.relevant(c, _glossary(spark, d), ["conv_id", "turn"])
    names = F.transform("terms", lambda t: t["fr"])
    long = F.size(F.filter(names, lambda x: F.contains(x, F.lit(" "))))
    return found.select("conv_id", "turn", F.size("terms").cast("long").alias("n_terms"), long.cast("long").alias("n_long"), F.md5(F.array_join(names, "|").cast("binary")).alias("digest"))


@query(r"""WITH n AS (SELECT doc_id, list_distinct(list_transform(regexp_extract_all(text, '[0-9](?:[0-9\s.,  ]*[0-9])?'), lambda x: regexp_replace(x, '[^0-9]', '', 'g'))) AS ns FROM documents),
p AS (SELECT doc_id, ns, lead(ns) OVER (ORDER BY doc_id) AS nx FROM n) SELECT doc_id, len(list_filter(ns, lambda x: NOT list_contains(coalesce(nx, []), x))) AS n_missing FROM p""")
def number_diff(spark, d):
    n = _t(spark, d, "documents").select("doc_id", "text")
    nxt = n.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("next"))  # ids have no holes
    return n.join(nxt, "doc_id", "left").select("doc_id", F.size(F.array_except(T.numbers(F.col("text")), T.numbers(F.coalesce("next", F.lit(""))))).cast("long").alias("n_missing"))


@query(r"""WITH n AS (SELECT conv_id, turn, len(list_filter(regexp_split_to_array(trim(text), '\s+'), lambda x: x <> '')) AS k FROM conversations)
SELECT a.conv_id, a.turn, a.k >= 12 AND b.k / greatest(a.k, 1) < 0.4 AS condensed FROM n a JOIN n b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""")
def over_condensed(spark, d):
    c = _t(spark, d, "conversations").select("conv_id", "turn", "text")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return c.join(nxt, ["conv_id", "turn"]).select("conv_id", "turn", T.over_condensed(F.col("text"), F.col("answer")).alias("condensed"))


@query()
def translation_review(spark, d):
    c = _t(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("text_fr"), F.lead("text").over(W.partitionBy("conv_id").orderBy("turn")).alias("text_en"))
    out = checks.review(c.where("text_en IS NOT NULL"), _TERMS, keys=["conv_id"], order="turn")
    return out.select("conv_id", "turn", F.array_join("issues", "|").alias("issues"))


_BOXES = "b AS (SELECT l_orderkey, l_linenumber, (l_partkey % 50) / 100.0 AS x, (l_suppkey % 10) / 20.0 AS y, l_quantity / 100 AS w, 0.1 + l_discount AS h FROM lineitem)"


def _boxes(spark, d):
    li = _t(spark, d, "lineitem")
    box = G.make_box((F.col("l_partkey") % 50) / 100.0, (F.col("l_suppkey") % 10) / 20.0, F.col("l_quantity") / 100, F.lit(0.1) + F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_tax", box.alias("box"))


@query(f"""WITH {_BOXES}, p AS (SELECT a.l_orderkey, a.l_linenumber, c.l_linenumber AS other, least(a.x + a.w, c.x + c.w) - greatest(a.x, c.x) AS iw, least(a.y + a.h, c.y + c.h) - greatest(a.y, c.y) AS ih, a.w * a.h + c.w * c.h AS s
 FROM b a JOIN b c ON a.l_orderkey = c.l_orderkey AND a.l_linenumber < c.l_linenumber) SELECT l_orderkey, l_linenumber, other, round(CASE WHEN iw <= 0 OR ih <= 0 THEN 0 ELSE iw * ih / (s - iw * ih) END, 6) AS iou FROM p""")
def box_iou_pairs(spark, d):
    a = _boxes(spark, d).select("l_orderkey", "l_linenumber", "box")
    b = a.select("l_orderkey", F.col("l_linenumber").alias("other"), F.col("box").alias("box2"))
    return a.join(b, "l_orderkey").where("l_linenumber < other").select("l_orderkey", "l_linenumber", "other", F.round(G.iou(F.col("box"), F.col("box2")), 6).alias("iou"))


@query("""WITH RECURSIVE b AS (
  SELECT l_orderkey // 256 AS video_id, epoch_us(l_shipdate) / 1e6 AS ts, l_orderkey * 10 + l_linenumber AS det_ord, 'label ' || l_returnflag AS text,
         (l_partkey % 50) / 100.0::DOUBLE AS x, (l_suppkey % 10) / 20.0::DOUBLE AS y, (l_quantity / 100)::DOUBLE AS w, (0.1 + l_discount)::DOUBLE AS h, (1 - l_tax)::DOUBLE AS c FROM lineitem),
d AS (SELECT *, row_number() OVER (PARTITION BY video_id, text ORDER BY ts, det_ord) AS no FROM b),
s AS (
  SELECT video_id, text, no, [{'last': ts, 'x': x, 'y': y, 'w': w, 'h': h, 'c': c}] AS tracks, 1::BIGINT AS track FROM d WHERE no = 1
  UNION ALL
  SELECT video_id, text, no, CASE WHEN pick IS NULL THEN tracks || [now] ELSE tracks[: pick - 1] || [CASE WHEN c > tracks[pick].c THEN now ELSE {'last': ts, 'x': tracks[pick].x, 'y': tracks[pick].y, 'w': tracks[pick].w, 'h': tracks[pick].h, 'c': tracks[pick].c} END] || tracks[pick + 1 :] END,
         coalesce(pick, len(tracks) + 1)
  FROM (SELECT *, CASE WHEN list_max(ious) >= 0.3 THEN list_position(ious, list_max(ious)) END AS pick, {'last': ts, 'x': x, 'y': y, 'w': w, 'h': h, 'c': c} AS now
    FROM (SELECT *, list_transform(sides, lambda z: CASE WHEN z.iw <= -1 THEN -1.0::DOUBLE WHEN z.iw <= 0 OR z.ih <= 0 THEN 0.0::DOUBLE ELSE z.iw * z.ih / (z.areas - z.iw * z.ih) END) AS ious
      FROM (SELECT d.*, s.tracks, list_transform(s.tracks, lambda t: {'iw': CASE WHEN t.last < d.ts AND d.ts - t.last <= 2592000.0 THEN least(t.x + t.w, d.x + d.w) - greatest(t.x, d.x) ELSE -2.0::DOUBLE END,
          'ih': least(t.y + t.h, d.y + d.h) - greatest(t.y, d.y), 'areas': t.w * t.h + d.w * d.h}) AS sides
        FROM s JOIN d ON d.video_id = s.video_id AND d.text = s.text AND d.no = s.no + 1)))),
e AS (
  SELECT video_id, text, track, min(ts) AS first_seen, greatest(max(ts), min(ts) + 0.5) AS last_seen, round(least(1.0, avg(c)), 4) AS confidence, CAST(count(*) AS INT) AS occurrences,
         arg_max({'y': y, 'x': x}, {'c': c, 't': -ts, 'o': -det_ord}) AS best FROM s JOIN d USING (video_id, text, no) GROUP BY ALL)
SELECT video_id, 'scr-' || printf('%04d', row_number() OVER (PARTITION BY video_id ORDER BY first_seen, best.y, best.x, text, track)) AS id, text, first_seen, last_seen, confidence, occurrences FROM e""")
def track_boxes(spark, d):
    video = F.floor(F.col("l_orderkey") / 256).cast("long")  # videos grow with the table
    b = _boxes(spark, d).select(video.alias("video_id"), _seconds("l_shipdate").alias("ts"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("det_ord"), F.concat(F.lit("label "), "l_returnflag").alias("text"), "box.*", (1 - F.col("l_tax")).alias("confidence"))
    c = ScreenText(max_gap=30 * 86400.0, merge_iou=0.3)
    return tracking.elements(tracking.track(b, c), 0.5).select("video_id", "id", "text", "first_seen", "last_seen", "confidence", "occurrences")


_STOP = "[" + ", ".join(f"'{w}'" for w in T.STOP_WORDS) + "]"


@query(rf"""WITH p AS (SELECT p_partkey // 16 AS video_id, CAST(p_partkey AS VARCHAR) AS id, p_partkey % 16 * 2.0::DOUBLE AS s, p_partkey % 16 * 2.0::DOUBLE + 10 AS e, p_name AS text, lower(trim(p_name)) AS n, p_size FROM part),
forms AS (SELECT video_id, id, s, e, unnest(list_distinct([n, regexp_replace(n, '\bsmall[sx]?\b', 'hot', 'g')])) AS n FROM p),
labels AS (SELECT *, replace(n, ' ', '') AS k, list_filter(regexp_extract_all(n, '[a-z0-9]+'), lambda w: NOT list_contains({_STOP}, w)) AS ws FROM forms),
shown AS (SELECT video_id, id AS element_id, text, replace(n, ' ', '') AS o, p_size / 100.0::DOUBLE AS bx, s + p_size % 7 AS f, s + 9 AS z FROM p),
met AS (
  SELECT l.video_id, l.id, l.s, l.e, element_id, text, o, bx, f, z, greatest(least(z, l.e) - greatest(f, l.s), 0) / (l.e - l.s) AS visible,
    max(CASE WHEN length(k) = 0 OR length(o) = 0 THEN 0 WHEN k = o THEN 1 WHEN len(ws) = 0 THEN 0 WHEN len(list_filter(ws, lambda w: contains(o, w))) < len(ws) THEN round(0.5 * len(list_filter(ws, lambda w: contains(o, w))) / len(ws), 4)
      ELSE round(0.5 + 0.5 * least(1.0, length(k) / length(o)), 4) END::DOUBLE) AS score
  FROM labels l JOIN shown x ON x.video_id = l.video_id AND z > l.s - 1 AND f < l.e + 1 GROUP BY ALL HAVING score > 0),
heads AS (
  SELECT video_id, id, o, list_reduce(list([bx + 0.05::DOUBLE] ORDER BY f, element_id), lambda acc, i: CASE WHEN len(list_filter(acc, lambda h: sqrt((h - i[1]) * (h - i[1])) <= 0.015)) > 0 THEN acc ELSE acc || i END) AS hs FROM met GROUP BY ALL),
merged AS (
  SELECT video_id, id, s, e, o, list_filter(hs, lambda h: sqrt((h - bx - 0.05::DOUBLE) * (h - bx - 0.05::DOUBLE)) <= 0.015)[1] AS head, min(f) AS f, max(score) AS score, least(1.0, sum(visible)) AS visible,
    arg_min({{'element_id': element_id, 'text': text, 'bx': bx}}, {{'v': -visible, 'f': f, 'i': element_id}}) AS best FROM met JOIN heads USING (video_id, id, o) GROUP BY ALL),
pool AS (SELECT *, score >= 0.75 AS good, max(score) FILTER (score >= 0.75) OVER (PARTITION BY video_id, id) AS top FROM merged),
contend AS (SELECT *, good AND score >= top - 0.1 AS inside, count(*) FILTER (good AND score >= top - 0.1) OVER (PARTITION BY video_id, id) AS n_in, count(*) FILTER (good) OVER (PARTITION BY video_id, id) AS n_good FROM pool),
track AS (SELECT CAST(user_id AS BIGINT) AS video_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) * 0.5::DOUBLE AS ts, abs(value % 1) AS x FROM events),
within AS (SELECT p.video_id, p.id, t.x FROM p JOIN track t ON t.video_id = p.video_id AND t.ts BETWEEN p.s - 1 AND p.e + 1),
held AS (SELECT p.video_id, p.id, t.x FROM p ASOF JOIN track t ON t.video_id = p.video_id AND p.s >= t.ts WHERE p.s - t.ts <= 2 AND (p.video_id, p.id) NOT IN (SELECT (video_id, id) FROM within)),
points AS (SELECT * FROM within UNION ALL SELECT * FROM held),
far AS (SELECT c.video_id, c.id, best.element_id AS element_id, min(sqrt(pow(greatest(best.bx - x, 0, x - best.bx - 0.1::DOUBLE), 2))) AS dist FROM contend c JOIN points USING (video_id, id) WHERE inside AND n_in > 1 GROUP BY ALL),
near AS (SELECT c.*, coalesce(inside AND dist <= 0.02, false) AS near, count(*) FILTER (coalesce(inside AND dist <= 0.02, false)) OVER (PARTITION BY c.video_id, c.id) AS n_near
  FROM contend c LEFT JOIN far ON far.video_id = c.video_id AND far.id = c.id AND far.element_id = c.best.element_id),
ranked AS (SELECT *, n_in > 1 AND n_near = 1 AS settled, row_number() OVER (PARTITION BY video_id, id ORDER BY CASE WHEN n_in > 1 AND n_near = 1 AND NOT near THEN 1 ELSE 0 END, score DESC, visible DESC, f, best.element_id) AS no FROM near),
rivals AS (SELECT video_id, id, list(best.text ORDER BY no) FILTER (inside AND no > 1) AS rivals FROM ranked GROUP BY ALL),
coded AS (SELECT r.*, rivals, CASE WHEN n_good = 0 THEN 'no_candidate' WHEN n_in > 1 AND NOT settled THEN 'ambiguous' WHEN visible < 0.5 THEN 'too_brief' ELSE 'accepted' END AS code FROM ranked r JOIN rivals USING (video_id, id) WHERE no = 1)
SELECT p.video_id, p.id AS segment_id, CASE WHEN code = 'accepted' THEN 'accepted' ELSE 'refused' END AS verdict, coalesce(code, 'no_candidate') AS reason_code, coalesce(score, 0.0) AS score,
  coalesce(array_to_string(CASE code WHEN 'ambiguous' THEN rivals[1:4] WHEN 'accepted' THEN rivals ELSE [] END, '|'), '') AS rivals,
  round(CASE WHEN code IN ('too_brief', 'accepted') THEN visible ELSE 0 END, 6) AS visible FROM p LEFT JOIN coded USING (video_id, id)""")
def match_verdicts(spark, d):
    from .config import Matching
    from .operators import matching

    p = _t(spark, d, "part")
    video, start = _part_video(), F.col("p_partkey") % 16 * 2.0
    ref = F.struct(F.lit("named_control").alias("kind"), F.col("p_name").alias("label"))
    decisions = p.select(video, F.col("p_partkey").cast("string").alias("id"), start.alias("source_start"), (start + 10).alias("source_end"), ref.alias("ui_reference"))
    box = G.make_box(F.col("p_size") / 100.0, F.lit(0.2), F.lit(0.1), F.lit(0.05))
    elements = p.select(video, F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("text"), box.alias("box"), (start + F.col("p_size") % 7).alias("first_seen"), (start + 9).alias("last_seen"), F.lit(0.9).alias("confidence"), F.lit(3).alias("occurrences"))
    return matching.match(decisions, elements, _track(spark, d, 0.2), [("small", "hot")], Matching()).select("video_id", "segment_id", "verdict", "reason_code", "score", F.array_join("rivals", "|").alias("rivals"), F.round("visible", 6).alias("visible"))


@query("SELECT user_id, median(value) AS med, round(stddev_pop(value), 6) AS sd FROM events GROUP BY 1")
def median_and_variation(spark, d):
    e = _t(spark, d, "events").select("user_id", "event_id", "value")
    frames = e.select("user_id", F.col("event_id").alias("frame"), F.lit(0).alias("row"), F.lit(0).alias("col"), "value")
    sd = vision.row_variation(frames, ["user_id"]).select("user_id", F.round("variation", 6).alias("sd"))
    return e.groupBy("user_id").agg(F.percentile("value", 0.5).alias("med")).join(sd, "user_id")


@query("SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'new' ELSE c_name END AS c_name FROM customer")
def manifest_upsert(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    return temporal.upsert(c, c.where("c_custkey % 10 = 0").withColumn("c_name", F.lit("new")), ["c_custkey"])


@query("SELECT o_custkey, max_by(o_orderkey, o_orderkey) AS o_orderkey FROM orders GROUP BY 1")
def last_wins(spark, d):
    return temporal.last_wins(_t(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey")


@query("""SELECT 'quantity' AS rule, count(*) AS n FROM lineitem WHERE NOT (l_quantity <= 45) UNION ALL SELECT 'discount', count(*) FROM lineitem WHERE NOT (l_discount < 0.1) """)
def dq_checks(spark, d):
    v = violations(_t(spark, d, "lineitem"), {"quantity": F.col("l_quantity") <= 45, "discount": F.col("l_discount") < 0.1})
    return v.select(F.explode("violated").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH s AS (SELECT user_id, min(epoch_us(ts) / 1e6) AS a, max(epoch_us(ts) / 1e6) AS b FROM events GROUP BY 1), f AS (SELECT *, least(0.25, (b - a) / 2) / 3 AS p FROM s)
SELECT user_id, alpha, round(lo - a, 6) AS from_s, round(hi - a, 6) AS to_s FROM (SELECT user_id, a, 0.25 AS alpha, a + p * 0 AS lo, a + p AS hi FROM f UNION ALL SELECT user_id, a, 0.5, a + p, a + p * 2 FROM f UNION ALL SELECT user_id, a, 0.75, a + p * 2, a + p * 3 FROM f
 UNION ALL SELECT user_id, a, 1.0, a + p * 3, b - p * 3 FROM f UNION ALL SELECT user_id, a, 0.75, b - p * 3, b - p * 2 FROM f UNION ALL SELECT user_id, a, 0.5, b - p * 2, b - p FROM f UNION ALL SELECT user_id, a, 0.25, b - p, b FROM f)""")
def fade_steps(spark, d):
    s = _events(spark, d).groupBy("user_id").agg(F.min("s").alias("start"), F.max("s").alias("end"))
    return timeline.fade_steps(s).select("user_id", "alpha", F.round(F.col("from") - F.col("start"), 6).alias("from_s"), F.round(F.col("to") - F.col("start"), 6).alias("to_s"))


@query("SELECT substr(sha1(text), 1, 16) AS name, count(*) AS n FROM documents GROUP BY 1")
def text_files(spark, d):
    return _t(spark, d, "documents").groupBy(T.content_name(F.col("text")).alias("name")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT user_id, event_id FROM e WHERE i % greatest(1, n // 10) = 0 AND i < greatest(1, n // 10) * 10""")
def stride_sample(spark, d):
    return temporal.stride_sample(_events(spark, d), 10, ["s", "event_id"], ["user_id"]).select("user_id", "event_id")


@query("""WITH s AS (SELECT p_partkey, 100.0 + p_size * 40 AS w, 100.0 + p_partkey % 40 * 30 AS h FROM part), f AS (SELECT *, least(1920 / w, 1080 / h) AS fit FROM s),
r AS (SELECT *, CASE WHEN fit < 1 THEN fit ELSE least(fit, greatest(1.0, 906.0 / h)) END AS ratio FROM f),
x AS (SELECT *, CASE WHEN abs(ratio - 1) < 1e-9 THEN CAST(w AS INT) ELSE CAST(trunc(w * ratio) AS INT) - CAST(trunc(w * ratio) AS INT) % 2 END AS width, CASE WHEN abs(ratio - 1) < 1e-9 THEN CAST(h AS INT) ELSE CAST(trunc(h * ratio) AS INT) - CAST(trunc(h * ratio) AS INT) % 2 END AS height FROM r)
SELECT p_partkey, width, height, CASE WHEN 1080 - height >= 174 THEN 64 ELSE 0 END AS top, CASE WHEN 1080 - height >= 174 THEN 1080 - height - 64 WHEN 1080 - height >= 110 THEN 1080 - height ELSE 0 END AS bottom FROM x""")
def layout_fit(spark, d):
    from .operators.layout import compute_layout

    p = _t(spark, d, "part").select("p_partkey", compute_layout(F.lit(100.0) + F.col("p_size") * 40, F.lit(100.0) + F.col("p_partkey") % 40 * 30).alias("l"))
    return p.select("p_partkey", "l.width", "l.height", "l.top", "l.bottom")


@query("""SELECT event_id, printf('%d:%02d:%02d.%02d', cs // 360000, cs // 6000 % 60, cs // 100 % 60, cs % 100) AS stamp, '&H00' || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2) AS color
FROM (SELECT event_id, CAST(round_even(greatest(value, 0) * 100, 0) AS BIGINT) AS cs, upper(printf('%06x', event_id)) AS h FROM events)""")
def ass_stamps(spark, d):
    color = T.ass_color(F.concat(F.lit("#"), F.lower(F.lpad(F.hex("event_id"), 6, "0"))))
    return _t(spark, d, "events").select("event_id", T.ass_time(F.col("value")).alias("stamp"), color.alias("color"))


@query(f"""WITH {_SEG}, {_PLAN}, c AS (SELECT DISTINCT conv_id FROM seg)
SELECT conv_id, 'error' AS severity, 'no_video' AS code, NULL AS detail FROM c WHERE conv_id % 7 = 0 UNION ALL SELECT conv_id, 'error', 'no_audio', NULL FROM c WHERE conv_id % 5 = 0
UNION ALL SELECT conv_id, 'error', 'duration_gap', printf('%.3f', (conv_id % 11) * 0.05) FROM c WHERE conv_id % 11 > 4 UNION ALL SELECT conv_id, 'warning', 'level', 'too_quiet' FROM c WHERE conv_id % 3 = 0
UNION ALL SELECT conv_id, 'warning', 'needs_review', CAST(turn AS VARCHAR) FROM planned WHERE outcome = 'extended' AND t / 1.08 / d > 1.2""")
def output_checks(spark, d):
    s = _segments(spark, d)
    plan = timeline.plan_shot(F.col("d"), F.col("t"), Retiming())
    rows = s.select("conv_id", F.col("turn").cast("string").alias("id"), "turn", plan.alias("p"))
    start = temporal.exclusive_sum(F.col("p.planned"), ["conv_id"], "turn")
    line = rows.select("conv_id", "id", start.alias("new_start"), (start + F.col("p.planned")).alias("new_end"), F.col("p.needs_review").alias("needs_review"))
    v = F.col("conv_id")
    log = F.when(v % 3 == 0, "mean_volume: -61.5 dB max_volume: -20.0 dB").otherwise("mean_volume: -20.0 dB max_volume: -3.0 dB")
    outputs = s.select("conv_id").distinct().select("conv_id", (v % 7 != 0).alias("has_video"), (v % 5 != 0).alias("has_audio"), F.lit(0.0).alias("video_duration"), (v % 11 * 0.05).alias("audio_duration"), log.alias("volume_log"))
    return checks.validate(outputs, line, keys=["conv_id"]).where("code <> 'overlap'")


@query("""WITH e AS (SELECT *, epoch_us(ts) / 1e6 AS s FROM events), v AS (SELECT user_id, s, value FROM e QUALIFY row_number() OVER (PARTITION BY user_id, s ORDER BY value DESC) = 1),
asks AS (SELECT user_id, event_id, s + 1800 AS a, s + 2400 AS b FROM e WHERE event_type = 'purchase'),
inside AS (SELECT k.event_id, count(*) AS n, sum(e.value) AS total FROM asks k JOIN e ON k.user_id = e.user_id AND e.s BETWEEN k.a - 600 AND k.b + 600 GROUP BY 1),
held AS (SELECT k.user_id, k.event_id, CASE WHEN k.a - v.s <= 86400 THEN v.value END AS x FROM asks k ASOF LEFT JOIN v ON k.user_id = v.user_id AND k.a >= v.s)
SELECT h.user_id AS video_id, h.event_id AS id, CAST(coalesce(n, CASE WHEN x IS NULL THEN 0 ELSE 1 END) AS INT) AS n, round(coalesce(total, x, 0.0), 6) AS total FROM held h LEFT JOIN inside i ON h.event_id = i.event_id""")
def pointer_positions(spark, d):
    e = _events(spark, d).select(F.col("user_id").alias("video_id"), F.col("s").alias("timestamp"), F.col("value").alias("x"), F.lit(0.0).alias("y"), "event_id", "event_type")
    asks = e.where("event_type = 'purchase'").select("video_id", F.col("event_id").alias("id"), (F.col("timestamp") + 1800).alias("start"), (F.col("timestamp") + 2400).alias("end"))
    out = temporal.range_or_asof(asks, e.select("video_id", "timestamp", "x", "y"), 86400.0, 600.0, 86400.0)
    return out.select("video_id", "id", F.size("positions").alias("n"), F.round(F.aggregate("positions", F.lit(0.0), lambda a, p: a + p["x"]), 6).alias("total"))


@query("""WITH t AS (SELECT CAST(user_id AS BIGINT) AS video_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) * 0.5::DOUBLE AS s, abs(value % 1) AS x FROM events),
n AS (SELECT *, least(coalesce(lead(s) OVER (PARTITION BY video_id ORDER BY s), s + 6), s + 6) AS e FROM t),
points AS (SELECT video_id, s + i * 0.125::DOUBLE AS ts, x FROM (SELECT *, unnest(range(greatest(1, CAST(trunc((e - s) / 0.125) AS BIGINT)))) AS i FROM n)),
boxes AS (SELECT p_partkey // 16 AS video_id, CAST(p_partkey AS VARCHAR) AS element_id, p_size / 60.0::DOUBLE AS bx FROM part WHERE length(p_name) <= 30),
hits AS (
  SELECT video_id, ts, element_id FROM (SELECT *, greatest(bx - x, 0, x - bx - 0.15::DOUBLE) AS dx FROM points JOIN boxes USING (video_id)) WHERE sqrt(dx * dx) <= 0.012
  QUALIFY row_number() OVER (PARTITION BY video_id, ts ORDER BY sqrt(dx * dx), element_id) = 1),
marked AS (SELECT *, CASE WHEN lag(element_id) OVER w IS DISTINCT FROM element_id OR ts - lag(ts) OVER w > 0.5 THEN 1 ELSE 0 END AS new FROM hits WINDOW w AS (PARTITION BY video_id ORDER BY ts)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY video_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM marked)
SELECT video_id, element_id, round(min(ts), 3) AS start_s, round(max(ts) + 0.4, 3) AS end_s FROM runs GROUP BY video_id, element_id, island HAVING max(ts) - min(ts) >= 0.35""")
def pointer_hovers(spark, d):
    from .config import Cursor, Hover
    from .operators import cursor

    track = _track(spark, d, 0.21)
    ends = track.groupBy("video_id").agg((F.max("timestamp") + Hover().max_hold).alias("last_seen"))
    box = G.make_box(F.col("p_size") / 60.0, F.lit(0.2), F.lit(0.15), F.lit(0.05))
    elements = _t(spark, d, "part").select(_part_video(), F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("text"), box.alias("box"), F.lit(0.0).alias("first_seen"))
    elements = elements.join(ends, "video_id")  # shown for as long as the track goes
    return cursor.hovers(track, elements, Cursor(), Hover()).select("video_id", "element_id", F.round("start", 3).alias("start_s"), F.round("end", 3).alias("end_s"))


@query(r"""WITH c AS (SELECT p_partkey, trim(regexp_replace(p_name, '\s+', ' ', 'g'), ' .:;"''-') AS c FROM part)
SELECT p_partkey, CASE WHEN length(c) <= 12 THEN c ELSE trim(regexp_replace(left(c, 12), ' [^ ]*$', ''), ' .:;-') END AS title FROM c""")
def short_titles(spark, d):
    return _t(spark, d, "part").select("p_partkey", T.shorten(F.col("p_name"), 12).alias("title"))


@query(r"""WITH e AS (SELECT event_id, event_id % 7 - 1.0 AS a, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 7 + 1.5 END AS b, CASE WHEN event_id % 2 = 0 THEN 1.0 ELSE 1.0625 END AS speed FROM events)
SELECT event_id, CASE WHEN b IS NULL THEN CASE WHEN a > 0 THEN printf(':enable=''gte(t,%.3f)''', a) ELSE '' END ELSE printf(':enable=''between(t,%.3f,%.3f)''', a, b) END AS gate,
 CASE WHEN b IS NULL THEN '0.500' ELSE printf('''if(lt(t,%.3f),0.500*(t-%.3f)/0.250,if(lt(t,%.3f),0.500,0.500*(%.3f-t)/0.250))''', a + 0.25, a, b - 0.25, b) END AS alpha,
 CASE WHEN speed = 1 THEN '' ELSE 'atempo=1.0625,' END || 'adelay=delays=' || CAST((event_id % 100) * 1000 + 150 AS VARCHAR) || ':all=1' AS audio, replace(replace('C:\clips\' || event_id || '.wav', '\', '/'), ':', '\:') AS path FROM e""")
def render_clauses(spark, d):
    e = _t(spark, d, "events").select("event_id")
    a = (F.col("event_id") % 7 - 1).cast("double")
    b = F.when(F.col("event_id") % 3 != 0, a + 2.5)
    fade = G.fade_span(F.lit(0.25), a, b)
    speed = F.when(F.col("event_id") % 2 == 0, 1.0).otherwise(1.0625)
    audio = T.audio_clause((F.col("event_id") % 100).cast("double"), F.lit(150), speed)
    path = T.escape_path(F.concat(F.lit("C:\\clips\\"), F.col("event_id").cast("string"), F.lit(".wav")))
    return e.select("event_id", T.enable_clause(a, b).alias("gate"), T.text_alpha(a, b, fade, F.lit(0.5)).alias("alpha"), audio.alias("audio"), path.alias("path"))


@query("""WITH b AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 64 ELSE 0 END AS top, CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE 20 + p_size * 3 END AS bottom FROM part)
SELECT p_partkey, CASE WHEN top > 0 THEN top - 4 WHEN bottom > 0 THEN 1080 - 4 END AS progress, greatest(12, CASE WHEN bottom > 0 THEN least(40, CAST(floor(bottom * 0.85 / 2.4) AS INT)) ELSE 40 END) AS font FROM b""")
def band_marks(spark, d):
    from .operators.layout import progress_y, subtitle_font_size

    top, bottom = F.when(F.col("p_partkey") % 3 == 0, 64).otherwise(0), F.when(F.col("p_partkey") % 4 == 0, 0).otherwise(20 + F.col("p_size") * 3)
    c = Layout(progress=4, subtitle_size=40)
    p = _t(spark, d, "part").select("p_partkey", F.struct(top.alias("top"), bottom.alias("bottom")).alias("l"))
    return p.select("p_partkey", progress_y(F.col("l"), c).alias("progress"), subtitle_font_size(F.col("l"), 2, c).alias("font"))


@query(r"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS no FROM conversations)
SELECT conv_id, left(string_agg(coalesce(text, ''), ' ' ORDER BY turn), 1500) AS excerpt FROM n WHERE no <= 8 GROUP BY 1""")
def intro_excerpts(spark, d):
    return timeline.excerpt(_t(spark, d, "conversations"), "text", "turn", keys=["conv_id"])


@query(f"""WITH sl AS ({ORACLE["duration_slices"]}), p AS (SELECT conv_id, slice, 'Part ' || (slice + 1) || ':' || chr(10) || string_agg(left(coalesce(text, ''), 160), chr(10) ORDER BY turn) AS part
 FROM sl JOIN conversations USING (conv_id, turn) GROUP BY 1, 2) SELECT conv_id, string_agg(part, chr(10) || chr(10) ORDER BY slice) AS digest FROM p GROUP BY 1""")  # fmt: skip
def title_digests(spark, d):
    s = _segments(spark, d)
    return timeline.title_digest(timeline.duration_slices(s, F.col("d"), ["turn"], keys=["conv_id"]), "text", "turn", keys=["conv_id"])


@query(f"""WITH p AS ({ORACLE["gap_fill_pieces"]}), c AS (SELECT o_custkey, CASE WHEN o_custkey % 3 > 0 THEN 'shots of ' || o_custkey END AS intro, CASE WHEN o_custkey % 4 > 0 THEN 'end' END AS outro FROM p GROUP BY 1),
w AS (SELECT *, row_number() OVER q AS ord, coalesce(sum(end_day - start_day + extension) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS piece_at FROM p JOIN c USING (o_custkey) WINDOW q AS (PARTITION BY o_custkey ORDER BY start_day, kind, end_day, extension)),
m AS (SELECT o_custkey, kind, ord + CASE WHEN intro IS NULL THEN 0 ELSE 1 END AS ord, piece_at + CASE WHEN intro IS NULL THEN 0 ELSE 5 END AS piece_at, end_day - start_day + extension AS length, intro, outro FROM w)
SELECT o_custkey, kind, ord, piece_at, length, NULL AS title FROM m UNION ALL SELECT o_custkey, 'intro', 1, 0.0, 5.0, intro FROM c WHERE intro IS NOT NULL
UNION ALL SELECT o_custkey, 'outro', max(ord) + 1, max(piece_at + length), 4.0, max(outro) FROM m WHERE outro IS NOT NULL GROUP BY 1""")
def card_pieces(spark, d):
    p, v = _pieces(spark, d), F.col("video_id")
    card = F.struct(F.when(v % 3 > 0, F.concat(F.lit("shots of "), v.cast("string"))).alias("intro"), F.when(v % 4 > 0, F.lit("end")).alias("outro"))
    out = timeline.with_cards(p, p.select("video_id").distinct().select("video_id", card.alias("card")))
    return out.select(v.alias("o_custkey"), "kind", "ord", F.col("at").alias("piece_at"), (F.col("end") - F.col("start") + F.col("extension")).alias("length"), "title")


@query(r"""WITH q AS (SELECT l_partkey, list({'x': CAST(trunc(l_quantity / 64 * 1920) AS INT), 'y': CAST(trunc(l_linenumber / 8 * 1080) AS INT)} ORDER BY l_orderkey, l_linenumber, l_quantity) AS ps FROM lineitem GROUP BY 1)
SELECT CAST(p_partkey AS VARCHAR) AS segment_id, printf('sample_%05d.jpg', CAST(round_even((p_partkey % 16 * 2.0 + 5) * 2, 0) AS INT) + 1) AS frame,
 CAST(trunc(p_size / 64 * 1920) AS INT) - 4 AS x0, 270 - 4 AS y0, CAST(trunc((p_size / 64 + 0.125) * 1920) AS INT) + 4 AS x1, 270 + 135 + 4 AS y1,
 CASE WHEN p_partkey % 2 = 0 AND ps IS NOT NULL THEN list_aggregate(list_transform(ps, lambda p: p.x || ',' || p.y), 'string_agg', ' ') ELSE '' END AS points,
 p_partkey || '  "' || p_name || '" -> "' || upper(p_name) || '"  score ' || printf('%.2f', p_size / 64) || '  visible ' || (25 * (p_size % 5)) || '%  [' || CASE WHEN p_partkey % 2 = 0 THEN 'ocr+cursor' ELSE 'ocr' END || ']' AS caption
FROM part LEFT JOIN q ON l_partkey = p_partkey WHERE p_size % 3 > 0""".replace("printf('%.2f', p_size / 64)", "printf('%.2f', p_size // 8 / 8 + 0.001)"))  # fmt: skip
def review_sheet(spark, d):
    from .operators import matching

    p = _t(spark, d, "part").withColumns({"segment_id": F.col("p_partkey").cast("string"), "video_id": F.lit("v")})
    evidence = F.when(F.col("p_partkey") % 2 == 0, F.array(F.lit("ocr"), F.lit("cursor"))).otherwise(F.array(F.lit("ocr")))
    box = G.make_box(F.col("p_size") / 64, F.lit(0.25), F.lit(0.125), F.lit(0.125))
    verdict = F.when(F.col("p_size") % 3 > 0, "accepted").otherwise("refused")
    score, visible = F.floor(F.col("p_size") / 8) / 8 + 0.001, F.col("p_size") % 5 / 4
    verdicts = p.select("video_id", "segment_id", F.col("p_name").alias("label"), F.upper("p_name").alias("text"), verdict.alias("verdict"), score.alias("score"), visible.alias("visible"), evidence.alias("evidence"), box.alias("box"))
    decisions = p.select("video_id", F.col("segment_id").alias("id"), (F.col("p_partkey") % 16 * 2.0).alias("source_start"), (F.col("p_partkey") % 16 * 2.0 + 10).alias("source_end"))
    at = F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", (F.col("l_quantity") / 64).cast("double").alias("x"), (F.col("l_linenumber") / 8).alias("y"))))
    positions = _t(spark, d, "lineitem").groupBy(F.lit("v").alias("video_id"), F.col("l_partkey").cast("string").alias("id")).agg(at.alias("positions"))
    points = F.array_join(F.transform("points", lambda q: F.concat_ws(",", q["x"].cast("string"), q["y"].cast("string"))), " ")
    return matching.review_rows(verdicts, decisions, positions, 1920, 1080).select("segment_id", "frame", "x0", "y0", "x1", "y1", points.alias("points"), "caption")


@query("""WITH RECURSIVE px AS (SELECT DISTINCT l_orderkey // 300 AS step, l_partkey * 7 % 64 AS r, (l_suppkey * 5 + l_orderkey) % 64 AS c FROM lineitem),
reach AS (SELECT step, r, c, r AS r2, c AS c2 FROM px UNION SELECT a.step, a.r, a.c, b.r, b.c FROM reach a JOIN px b ON a.step = b.step AND b.r BETWEEN a.r2 - 1 AND a.r2 + 1 AND b.c BETWEEN a.c2 - 1 AND a.c2 + 1),
own AS (SELECT step, r, c, min(r2 * 64 + c2) AS root FROM reach GROUP BY 1, 2, 3), areas AS (SELECT step, root, avg(c) / 64 AS x, avg(r) / 64 AS y, count(*) AS n FROM own GROUP BY 1, 2)
SELECT step, round(x, 6) AS x, round(y, 6) AS y FROM areas WHERE n BETWEEN 2 AND 8""")
def changed_areas(spark, d):
    from .config import Cursor

    step, row, col = F.floor(F.col("l_orderkey") / 300), F.col("l_partkey") * 7 % 64, (F.col("l_suppkey") * 5 + F.col("l_orderkey")) % 64
    px = _t(spark, d, "lineitem").select(F.lit("v").alias("video_id"), step.alias("step"), row.cast("int").alias("row"), col.cast("int").alias("col"))
    return vision.blobs(px, 64, 64, Cursor(min_area=2 / 4096, max_area=8 / 4096)).select("step", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))
