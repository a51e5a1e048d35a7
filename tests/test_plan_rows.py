"""Digests for titles, cards around a plan, rows for review, areas of changed pixels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.config import Cards, Cursor
from tidemark.operators import matching, timeline, vision


def test_excerpt(spark):
    rows = [("v", i, t) for i, t in enumerate(["a" * 900, None, "", "b" * 500, "c" * 400, "d"])] + [("w", 9, "z" * 4000), *[("x", i, str(i)) for i in range(20)], ("e", 0, None)]
    df = spark.createDataFrame(rows, "video_id string, ord int, text_fr string")
    got = {r.video_id: r.excerpt for r in timeline.excerpt(df, "text_fr", "ord").collect()}
    assert got == {"v": " ".join(t or "" for _, _, t in rows[:6])[:1500], "w": "z" * 1500, "x": "0 1 2 3 4 5 6 7", "e": ""}
    assert timeline.excerpt(df.limit(0), "text_fr", "ord").isEmpty()


def test_excerpt_ends_with_the_space_before_a_row_without_room(spark):
    for n in (1497, 1498, 1499, 1500, 1501):
        texts = ["a" * (n - 200), "b" * 199, "c", "d"]
        df = spark.createDataFrame([("v", i, t) for i, t in enumerate(texts)], "video_id string, ord int, text_fr string")
        assert timeline.excerpt(df, "text_fr", "ord").first().excerpt == " ".join(texts)[:1500]


def test_title_digest(spark):
    df = spark.createDataFrame([("v", 0, 1, "b" * 200), ("v", 0, 0, "a"), ("v", 1, 2, None), ("v", 1, 3, "c")], "video_id string, slice int, ord int, text_en string")
    assert timeline.title_digest(df, "text_en", "ord").first().digest == "Part 1:\na\n" + "b" * 160 + "\n\nPart 2:\n\nc"


def test_cards(spark):
    plan = spark.createDataFrame([(v, k, 0.0, 3.0, e, None, o, a) for v in "abc" for k, e, o, a in (("gap", 0.0, 1, 0.0), ("segment", 1.0, 2, 3.0))], "video_id string, kind string, start double, end double, extension double, id string, ord int, at double")
    titles = spark.createDataFrame([("a", ("T", "U")), ("b", (None, "U")), ("d", ("T", None))], "video_id string, card struct<intro:string,outro:string>")
    got = {v: [] for v in "abc"}
    for r in timeline.with_cards(plan, titles, Cards()).orderBy("ord").collect():
        got[r.video_id].append((r.ord, r.kind, r["at"], r.title))
    assert got["a"] == [(1, "intro", 0, "T"), (2, "gap", 5, None), (3, "segment", 8, None), (4, "outro", 12, "U")]
    assert got["b"] == [(1, "gap", 0, None), (2, "segment", 3, None), (3, "outro", 7, "U")]
    assert got["c"] == [(1, "gap", 0, None), (2, "segment", 3, None)]


def test_review_rows(spark):
    kind = "video_id string, segment_id string, label string, text string, verdict string, score double, visible double, evidence array<string>, box struct<x:double,y:double,width:double,height:double>"
    box = (0.5, 0.25, 0.1, 0.1)
    rows = [("v", "s1", "Send", "SEND", "accepted", 0.9, 1.0, ["ocr", "cursor"], box), ("v", "s2", "A", "B", "accepted", 0.9, 0.5, ["ocr"], box), ("v", "s3", "A", "B", "refused", 0.9, 0.5, ["ocr"], box), ("v", "s4", "A", "B", "accepted", 0.9, 0.5, None, None)]
    decisions = spark.createDataFrame([("v", f"s{i}", 1.0, 3.0) for i in range(1, 5)], "video_id string, id string, source_start double, source_end double")
    seen = spark.createDataFrame([("v", f"s{i}", [(1.0, 0.5, 0.5)]) for i in (1, 2)], "video_id string, id string, positions array<struct<timestamp:double,x:double,y:double>>")
    got = matching.review_rows(spark.createDataFrame(rows, kind), decisions, seen, 1000, 400).orderBy("segment_id").collect()
    assert [r.segment_id for r in got] == ["s1", "s2"] and [tuple(p) for p in got[0].points] == [(500, 200)] and got[1].points == []
    assert got[0].frame == "sample_00005.jpg" and (got[0].x0, got[0].y0, got[0].x1, got[0].y1) == (496, 96, 604, 144)
    assert got[0].caption == 's1  "Send" -> "SEND"  score 0.90  visible 100%  [ocr+cursor]'


def flooded(pixels):
    """Areas by filling, as lists of (row, col)."""
    left, out = set(pixels), []
    while left:
        todo, area = [left.pop()], []
        while todo:
            r, q = todo.pop()
            area.append((r, q))
            for p in [(r + i, q + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]:
                if p in left:
                    left.remove(p)
                    todo.append(p)
        out.append(area)
    return out


def spiral(n):
    """One long area that winds inwards, with a row of free pixels between."""
    out, r, q, d, length = [(0, 0)], 0, 0, 0, n
    while length > 2:
        for _ in range(2):
            for _ in range(length):
                r, q = r + (0, 1, 0, -1)[d], q + (1, 0, -1, 0)[d]
                out.append((r, q))
            d = (d + 1) % 4
        length -= 2
    return out


@pytest.mark.parametrize("share", [0.05, 0.3, 0.5])
def test_areas_of_random_pixels(spark, share):
    rng = np.random.default_rng(5)
    grids = [rng.random((40, 200)) < share for _ in range(3)]
    px = [("v", s, int(r), int(q)) for s, g in enumerate(grids) for r, q in zip(*np.nonzero(g))]
    df = spark.createDataFrame([*px, *px[:100]], "video_id string, step int, row int, col int")
    got = vision.blobs(df, 200, 40, Cursor(min_area=2 / 8000, max_area=1.0)).collect()
    want = sorted((s, round(sum(q for _, q in a) / len(a) / 200, 9), round(sum(r for r, _ in a) / len(a) / 40, 9)) for s, g in enumerate(grids) for a in flooded(zip(*map(lambda x: x.tolist(), np.nonzero(g)))) if len(a) >= 2)
    assert sorted((r.step, round(r.x, 9), round(r.y, 9)) for r in got) == want


def test_long_areas_are_one(spark):
    px = spiral(60)
    df = spark.createDataFrame([("v", 0, r, q) for r, q in px], "video_id string, step int, row int, col int")
    got = vision.blobs(df, 61, 61, Cursor(min_area=0.0, max_area=1.0)).collect()
    assert len(got) == len(flooded(px)) == 1
    assert vision.blobs(df.limit(0), 61, 61).isEmpty()
    chain = spark.range(1, 3000).select(F.lit("v").alias("k"), F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
    got = vision.components(chain, ["k"])
    assert got.count() == 2999 and got.where("v <> 0").isEmpty()


def test_areas_by_frame_and_by_joins_agree(spark, monkeypatch):
    """Small and large frames; a null key, and one frame over many batches, are frames too."""
    rng = np.random.default_rng(8)
    px = [(k, s, int(r), int(q)) for k in ("v", None) for s in range(4) for r, q in rng.integers(0, 30, (300, 2))] + [("w", 0, r, q) for r, q in spiral(30)]
    df = spark.createDataFrame(px, "video_id string, step int, row int, col int").repartition(3)
    run = lambda d: sorted((str(r.video_id), r.step, round(r.x, 9), round(r.y, 9)) for r in vision.blobs(d, 30, 30, Cursor(min_area=1 / 900, max_area=1.0)).collect())
    plan = vision.blobs(df, 30, 30)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan  # no table of edges, no rounds
    with monkeypatch.context() as m:
        m.setattr(vision, "HELD", 50)
        got = run(df)
    assert got and len([x for x in got if x[0] == "w"]) == len(flooded(spiral(30)))
    want = sorted((str(k), s, round(sum(q for _, q in a) / len(a) / 30, 9), round(sum(r for r, _ in a) / len(a) / 30, 9)) for k, s in {x[:2] for x in px} for a in flooded([x[2:] for x in px if x[:2] == (k, s)]))
    assert got == want
    monkeypatch.setattr(vision, "LARGE", 0)
    known = df.where("video_id IS NOT NULL")
    assert run(known) == [x for x in want if x[0] != "None"]
