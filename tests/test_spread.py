"""Operators whose groups may hold most of the rows: scans, dyadic covers, the grid, sessions of tracks."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.config import ScreenText
from tidemark.functions.geometry import make_box
from tidemark.operators import scan, space, temporal, tracking


@pytest.fixture(scope="module")
def hot(spark):
    """2,000 rows, nine tenths of one key, some values and keys null."""
    rng = random.Random(5)
    rows = [(None if i % 97 == 0 else 0 if i % 10 else i % 7, rng.randrange(1500), i, None if i % 5 == 0 else i % 11, i % 3) for i in range(2000)]
    return spark.createDataFrame(rows, "k int, t int, no int, v int, w int").repartition(6)


def test_scan_equals_windows(spark, hot):
    w = W.partitionBy("k").orderBy("t", "no")
    want = hot.select("no", F.coalesce(F.sum("w").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("s"), F.last("v", True).over(w).alias("l"), F.lag("v").over(w).alias("p"))
    got = scan.scan(hot, ["k"], ["t", "no"], sums={"s": F.col("w")}, lasts={"l": F.col("v")}, lags={"p": F.col("v")})
    assert got.columns == [*hot.columns, "s", "l", "p"]
    assert sorted(map(str, got.select("no", "s", "l", "p").collect())) == sorted(map(str, want.collect()))
    assert scan.scan(hot.where("no < 0"), ["k"], ["t"], sums={"s": F.col("w")}).count() == 0


def test_a_hot_key_is_many_blocks(spark, hot):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one block
    sizes = [r.n for r in scan.in_blocks(hot, ["k"], ["t", "no"]).groupBy("k", "_block").agg(F.count(F.lit(1)).alias("n")).where("k = 0").collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 4 and max(sizes) < 0.4 * 2000


def test_spread_forms_equal_plain_ones(spark, hot):
    facts = hot.where("no % 3 = 0").select("k", F.col("t").cast("double").alias("timestamp"), F.col("no").alias("fact"))
    asks = hot.where("no % 3 = 1 AND k IS NOT NULL").select("k", F.col("t").cast("double").alias("ts"), "no")
    both = [sorted(map(str, temporal.asof_join(asks, facts, ["fact"], ["k"], hold=3.0, spread=s).select("k", "no", "fact", "fact_ts").collect())) for s in (True, False)]
    assert both[0] == both[1]
    both = [sorted(map(str, temporal.islands(hot, "w", "t", 2, ["k"], ["no"], spread=s).select("no", "island").collect())) for s in (True, False)]
    assert both[0] == both[1]
    iv = hot.withColumn("e", F.col("t") + F.col("no") % 4)
    both = [sorted(map(str, temporal.overlaps(iv, "t", "e", ["k"], ["no"], spread=s).select("no", "previous_end").collect())) for s in (True, False)]
    assert both[0] == both[1]


def covers(spark, intervals):
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(intervals)], "i int, a double, b double")
    return {r.i: [(n.level, n.no) for n in r.c] for r in df.select("i", temporal.cover(F.col("a"), F.col("b"), 60.0).alias("c")).collect()}


def test_covers_are_small_and_exact(spark):
    rng = random.Random(2)
    some = [(0, 86_400), (7, 7), (-3_600, 59), (60 * 3, 60 * 8)] + [(a := rng.randrange(-10**5, 10**5), a + rng.randrange(10 ** rng.randrange(1, 7))) for _ in range(60)]
    for i, nodes in covers(spark, some).items():
        whole = sorted(b for k, no in nodes for b in range(no << k, (no + 1) << k))
        assert whole == list(range(some[i][0] // 60, some[i][1] // 60 + 1))
        assert all(sum(k == level for k, _ in nodes) <= 2 for level in range(21))
    assert len(covers(spark, [(0, 86_400)])[0]) <= 20


def test_overlaps_of_short_and_long_intervals(spark):
    rng = random.Random(3)

    def some(n):
        out = []
        for i in range(n):
            a = rng.uniform(-5_000, 5_000)
            out.append((i % 2, i, a, a + rng.choice([0.0, 1.0, 50.0, 700.0, 9_000.0, -5.0])))
        return out

    left, right = some(120), some(150)
    a = spark.createDataFrame(left, "video_id int, i int, start double, end double")
    b = spark.createDataFrame(right, "video_id int, j int, first_seen double, last_seen double")
    for width in (10.0, 1_000.0):
        got = sorted((r.i, r.j) for r in temporal.overlap_join(a, b, width, margin=2.0).collect())
        assert got == sorted((i, j) for v, i, s, e in left for u, j, f, z in right if u == v and e + 2 > s - 2 and z >= f and z > s - 2 and f < e + 2)
        points = b.select("video_id", "j", F.col("first_seen").alias("timestamp"))
        got = sorted((r.i, r.j) for r in temporal.point_join(points, a, width).collect())
        assert got == sorted((i, j) for v, i, s, e in left for u, j, f, _ in right if u == v and s <= f <= e)
    assert temporal.overlap_join(a.where("i < 0"), b, 10.0).count() == temporal.point_join(points, a.where("i < 0"), 10.0).count() == 0


def test_the_grid_finds_all_that_is_near_and_little_else(spark):
    rng = random.Random(4)
    points = [(0, i, rng.uniform(0, 100), rng.random(), rng.random()) for i in range(400)]
    boxes = [(0, i, rng.random(), rng.random(), rng.uniform(0, 0.2), rng.uniform(0, 0.1), t := rng.uniform(0, 100), t + rng.uniform(-1, 40)) for i in range(200)]
    p = spark.createDataFrame(points, "video_id int, p int, ts double, x double, y double")
    b = spark.createDataFrame(boxes, "video_id int, e int, bx double, by double, w double, h double, first_seen double, last_seen double")
    b = b.select("video_id", "e", make_box(F.col("bx"), F.col("by"), F.col("w"), F.col("h")).alias("box"), "first_seen", "last_seen")
    near = lambda x, y, bx, by, w, h: max(bx - x, 0, x - bx - w) ** 2 + max(by - y, 0, y - by - h) ** 2 <= 0.02**2
    want = sorted((i, e) for _, i, t, x, y in points for _, e, bx, by, w, h, f, z in boxes if f <= t <= z and near(x, y, bx, by, w, h))
    assert sorted((r.p, r.e) for r in space.near_boxes(p, b, 0.02, ts="ts", width=5.0).collect()) == want
    assert sorted((r.p, r.e) for r in space.near_boxes(p, b, 0.02, cell=0.1, ts="ts").collect()) == want
    everywhere = sorted((i, e) for _, i, _, x, y in points for _, e, bx, by, w, h, _, _ in boxes if near(x, y, bx, by, w, h))
    assert sorted((r.p, r.e) for r in space.near_boxes(p, b, 0.02).collect()) == everywhere
    pairs = space.candidates(p, b, 0.02, 0.02)
    assert pairs.count() == pairs.distinct().count() < 0.04 * 400 * 200


def plain_tracks(rows, c):
    """One list of sightings of one label, one after the other."""
    tracks, out = [], []
    for t, box, conf in rows:
        open_ = [(tracking._iou(k["box"], box), -i) for i, k in enumerate(tracks) if k["last"] < t and t - k["last"] <= c.max_gap]
        best = max(open_, default=(-1.0, 0))
        if best[0] < c.merge_iou:
            tracks.append({"last": t, "box": box, "conf": conf})
            out.append(len(tracks) - 1)
            continue
        k = tracks[-best[1]]
        k["last"] = t
        if conf > k["conf"]:
            k |= {"box": box, "conf": conf}
        out.append(-best[1])
    return out


@pytest.mark.parametrize("spread", [False, True])
def test_sessions_of_a_hot_label_track_as_one_group(spark, spread):
    rng, c = random.Random(6), ScreenText(max_gap=1.0, merge_iou=0.5)
    rows, t = [], 0.0
    for i in range(600):
        t += rng.choice([0.0, 0.25, 0.5, 0.5, 1.5])
        rows.append(("v", t, i, "menu" if i % 10 else "file", rng.randrange(3) / 10, 0.1, 0.12, 0.1, rng.random()))
    d = spark.createDataFrame(rows, "video_id string, ts double, det_ord int, text string, x double, y double, width double, height double, confidence double")
    out = tracking.track(d, c, spread=spread)
    got = {r.det_ord: r.track for r in out.collect()}
    for label in ("menu", "file"):
        mine = [r for r in rows if r[3] == label]
        assert [got[r[2]] for r in mine] == plain_tracks([(r[1], r[4:8], r[8]) for r in mine], c)
    sessions = temporal.islands(d.where("text = 'menu'"), "text", "ts", c.max_gap, ["video_id", "text"], ["det_ord"])
    assert sessions.select("island").distinct().count() > 50


def test_sessions_followed_together_as_one_by_one(spark, monkeypatch):
    """Keys and sessions that go on from one batch to the next, many open tracks, sightings of one time; no group of Python a session."""
    rng, c = random.Random(9), ScreenText(max_gap=1.0, merge_iou=0.3)
    rows, t = [], 0.0
    for i in range(3_000):
        t += rng.choice([0.0, 0.0, 0.25, 0.5, 0.5, 1.5])
        rows.append((rng.choice(["v", "w", None]), t, i, rng.choice(["menu", "file", "edit"]), rng.randrange(12) / 10, rng.randrange(3) / 10, 0.12, 0.1, rng.random()))
    d = spark.createDataFrame(rows, "video_id string, ts double, det_ord int, text string, x double, y double, width double, height double, confidence double").repartition(3)
    assert "FlatMapGroups" not in tracking.track(d, c)._jdf.queryExecution().executedPlan().toString()
    whole = {r.det_ord: r.track for r in tracking.track(d, c).collect()}
    run = tracking._in_order(["video_id", "text"], c)  # as a task runs it, with little held at a time
    monkeypatch.setattr(tracking, "HELD", 40)
    monkeypatch.setattr(tracking, "LONG", 0)
    import pyarrow as pa

    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[3], r[1], r[2]))
    table = pa.Table.from_pylist([dict(zip(d.columns, r)) for r in ordered])
    parts = {x["det_ord"]: x["track"] for b in run(iter(table.to_batches(max_chunksize=7))) for x in b.to_pylist()}
    want = {}
    for key in {(r[0], r[3]) for r in rows}:
        mine = [r for r in rows if (r[0], r[3]) == key]
        want |= {r[2]: k for r, k in zip(mine, plain_tracks([(r[1], r[4:8], r[8]) for r in mine], c))}
    assert whole == want and parts == want


def test_the_nearest_point_of_each_box_without_a_table_of_pairs(spark, monkeypatch):
    """Against all pairs: ties go to the least id; a box with nothing near has none; cells over many batches."""
    rng = random.Random(12)
    points = [(rng.randrange(3), i, rng.randrange(-5, 40) / 20, rng.randrange(20) / 20) for i in range(300)]
    boxes = [(rng.randrange(4), i, rng.randrange(-40, 80) / 20, rng.randrange(20) / 20, rng.choice([0.0, 0.05, 0.5]), rng.choice([0.0, 0.1])) for i in range(300)]
    p = spark.createDataFrame(points, "k int, p int, x double, y double").repartition(3)
    b = spark.createDataFrame(boxes, "k int, e int, bx double, by double, w double, h double").select("k", "e", make_box(F.col("bx"), F.col("by"), F.col("w"), F.col("h")).alias("box"))
    far = lambda x, y, bx, by, w, h: (max(bx - x, 0.0, x - bx - w) ** 2 + max(by - y, 0.0, y - by - h) ** 2) ** 0.5
    want = {}
    for k, e, *box in boxes:
        near = min(((far(x, y, *box), i) for q, i, x, y in points if q == k), default=(9.0, 0))
        if near[0] <= 0.1:
            want[e] = (near[1], round(near[0], 9))
    monkeypatch.setattr(space, "PAIRS", 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for cell in (None, 0.35):
            out = space.nearest_points(p, b, 0.1, ["e"], "p", ["k"], cell)
            assert {r.e: (r.p, round(r.dist, 9)) for r in out.collect()} == want and 50 < len(want) < 300
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert space.nearest_points(p.limit(0), b, 0.1, ["e"], "p", ["k"]).isEmpty()


def test_nearest_in_radius_makes_no_pairs(spark):
    from tidemark.queries import QUERIES

    plan = QUERIES["nearest_in_radius"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "s_suppkey" in plan
