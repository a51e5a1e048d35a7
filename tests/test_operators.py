"""Hand fixtures for the operators."""

import hashlib
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.config import Config, Cursor, Hover, Matching, Retiming, ScreenText, Segmentation, hardware_tier, load_config
from tidemark.functions import geometry as G
from tidemark.functions import text as T
from tidemark.operators import checks, cursor, layout, matching, segmentation, subtitles, temporal, timeline, tracking, vision
from tidemark.plans import plug, stages
from tidemark.schemas import constraints, schema, split_valid

BOX = "struct<x:double,y:double,width:double,height:double>"


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_config(tmp_path):
    f = tmp_path / "c.yaml"
    f.write_text("retiming: {max_speed: 1.2}\n")
    assert load_config(f).retiming == Retiming(max_speed=1.2) and Config().subtitles.max_chars == 42
    with pytest.raises(FileNotFoundError):
        load_config(tmp_path / "none.yaml")


def test_shots(spark):
    rows = spark.createDataFrame([(10.0, 4.0), (10.0, 0.1), (10.0, 10.5), (10.0, 12.0), (10.0, 20.0)], "d double, t double")
    got = [r.p for r in rows.select(timeline.plan_shot(F.col("d"), F.col("t")).alias("p")).collect()]
    assert [round(g.planned, 6) for g in got] == [4.8, 1.2, 10.0, round(12 / 1.08, 6), round(20 / 1.08, 6)]
    assert [g.outcome for g in got] == ["shortened", "shortened", "sped_up", "extended", "extended"]
    assert got[2].speed == 1.05 and not got[3].needs_review and got[4].needs_review


def decisions(spark, rows):
    d = spark.createDataFrame([("v", i, f"seg-{i:03d}", float(a), float(b)) for i, (a, b) in enumerate(rows)], "video_id string, ord long, id string, source_start double, source_end double")
    return d.withColumn("narration", F.struct(F.lit("x").alias("voice"), F.lit(0).alias("pause_before_ms"), F.lit(0).alias("pause_after_ms")))


def test_retime_moves_what_follows_and_skips_unspoken(spark):
    d = decisions(spark, [(0, 10), (10, 20), (20, 30)])
    n = spark.createDataFrame([("v", "seg-000", 4.0), ("v", "seg-002", 10.0)], "video_id string, segment_id string, duration double")
    t = timeline.retime(d, n)
    assert [(r.id, round(r.new_start, 6)) for r in t.orderBy("ord").collect()] == [("seg-000", 0.0), ("seg-002", 14.8)]
    assert {(r.id, r.code) for r in timeline.retime_warnings(d, n, t).collect()} == {("seg-001", "no_narration"), ("seg-000", "shortened")}


def test_overlaps(spark):
    assert temporal.overlaps(decisions(spark, [(0, 10), (8, 20)])).count() == 1
    assert temporal.overlaps(decisions(spark, [(0, 10), (10, 20)])).count() == 0


def test_pieces_and_chapters(spark):
    d = decisions(spark, [(2, 10), (15, 20)])
    t = spark.createDataFrame([("v", "seg-000", 2.0, 13.0), ("v", "seg-001", 18.0, 23.0)], "video_id string, id string, new_start double, new_end double")
    total = spark.createDataFrame([("v", 30.0)], "video_id string, duration double")
    p = timeline.pieces(d, t, total)
    got = [(r.kind, r.start, r.end, r.extension, r["at"]) for r in p.orderBy("ord").collect()]
    assert got == [("gap", 0.0, 2.0, 0.0, 0.0), ("segment", 2.0, 10.0, 3.0, 2.0), ("gap", 10.0, 15.0, 0.0, 13.0), ("segment", 15.0, 20.0, 0.0, 18.0), ("gap", 20.0, 30.0, 0.0, 23.0)]
    chapters = spark.createDataFrame([("v", 0, "A", "seg-000"), ("v", 1, "B", "seg-001"), ("v", 2, "C", "none")], "video_id string, ord long, title string, first_segment string")
    w = timeline.chapter_windows(chapters, p, timeline.total_duration(p))
    assert [(r.title, r.start, r.end, r.label) for r in w.orderBy("start").collect()] == [("A", 0.0, 18.0, "1/2"), ("B", 18.0, 33.0, "2/2")]


def test_slices(spark):
    def sizes(lengths):
        rows = spark.createDataFrame([("v", i, float(x)) for i, x in enumerate(lengths)], "video_id string, ord long, d double")
        got = timeline.duration_slices(rows, F.col("d"), ["ord"]).groupBy("slice").count().orderBy("slice").collect()
        return [r["count"] for r in got]

    assert sizes([10] * 14) == [3, 4, 3, 4] and sizes([30, 5, 5, 30]) == [2, 2] and sizes([10, 10]) == []


def test_fades(spark):
    one = spark.createDataFrame([(0.0, 4.0)], "start double, end double")
    assert timeline.fade_steps(one).count() == 7


def test_joins(spark):
    s = spark.createDataFrame([("v", "a", 10.0, 20.0)], "video_id string, id string, start double, end double")
    e = spark.createDataFrame([("v", i, f, l) for i, f, l in [("x", 0.0, 10.0), ("y", 15.0, 300.0), ("z", 20.0, 30.0), ("w", -50.0, 500.0)]], "video_id string, el string, first_seen double, last_seen double")
    assert {r.el for r in temporal.overlap_join(s, e, 7.0).collect()} == {"y", "w"}
    assert sorted(r.el for r in temporal.overlap_join(s, e, 7.0, margin=1.0).collect()) == ["w", "x", "y", "z"]
    pts = spark.createDataFrame([("v", t) for t in (9.9, 10.0, 20.0, 20.1)], "video_id string, timestamp double")
    assert sorted(r.timestamp for r in temporal.point_join(pts, s, 7.0).collect()) == [10.0, 20.0]


def test_asof(spark):
    facts = spark.createDataFrame([("v", 0.0, ["A"]), ("v", 1.0, [])], "video_id string, timestamp double, seen array<string>")
    grid = temporal.frame_grid(spark.createDataFrame([("v", 4)], "video_id string, n_frames int"), 0.5)
    got = temporal.asof_join(grid, facts, ["seen"], slack=1e-9).orderBy("frame").collect()
    assert [r.seen for r in got] == [["A"], ["A"], [], []]
    held = temporal.asof_join(grid, facts.limit(1), ["seen"], hold=0.5).orderBy("frame").collect()
    assert [r.seen for r in held] == [["A"], ["A"], None, None]


def test_geometry(spark):
    box = lambda *v: G.make_box(*[F.lit(float(x)) for x in v])
    assert value(spark, G.iou(box(0, 0, 1, 1), box(1, 0, 1, 1))) == 0.0
    assert value(spark, G.iou(box(0, 0, 0.5, 1), box(0.25, 0, 0.5, 1))) == pytest.approx(1 / 3)
    assert value(spark, G.visible_share(F.lit(10.0), F.lit(14.0), F.lit(12.0), F.lit(16.0))) == 0.5
    assert value(spark, G.visible_share(F.lit(1.0), F.lit(9.0), F.lit(5.0), F.lit(5.0))) == 0.0
    assert value(spark, G.distance_to_box(F.lit(0.5), F.lit(0.5), box(0, 0, 1, 1))) == 0.0
    pts = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((10, 10), (30, 10), (30, 20), (10, 20))])
    assert value(spark, G.quad_to_box(pts, 100, 100)).width == pytest.approx(0.2)


def test_text(spark):
    lit = lambda s: F.lit(s)
    assert value(spark, T.normalize_latin(lit("  Prévisions   À jour "))) == "previsions a jour"
    score = lambda a, b: value(spark, T.label_score(T.normalize_latin(lit(a)), T.normalize_latin(lit(b))))
    assert score("Prévisions de ventes", "previsionsdeventes") == 1.0 and score("Menu", "Menu") == 1.0 and score("le bouton", "la zone") == 0.0 and score("revenue growth", "revenue") == 0.25
    assert value(spark, T.missing_numbers(lit("1 234 et 56"), lit("1,234"))) == ["56"]
    assert value(spark, T.srt_time(F.lit(3723.456))) == "01:02:03,456" and value(spark, T.srt_time(F.lit(9.9999))) == "00:00:10,000"
    assert value(spark, T.ass_time(F.lit(-1.0))) == "0:00:00.00" and value(spark, T.ass_color(lit("#112233"))) == "&H00332211" and value(spark, T.ass_color(lit("yellow"))) == "&H0000FFFF"
    names = lambda s: value(spark, T.proper_names(lit(s)))
    assert names("Hier Marie Curie et SAP. Ensuite Paul") == ["Marie Curie", "SAP", "Paul"] and names("Chez SAP. APAC suit") == ["SAP APAC"]
    assert names("(la fin.) Nordic Tech et [Nordic] puis Nordic Tech") == ["Nordic Tech", "Nordic Tech"] and names("") == []
    assert value(spark, T.missing_names(F.array(lit("A B"), lit("A B"), lit("C")), lit("only c"))) == ["A B"]
    assert value(spark, T.translate_terms(lit("les revenus du mois"), [("revenu", "Revenue")])) == "les revenue du mois"
    assert value(spark, T.translate_terms(lit("rien"), [("revenu", "Revenue")])) is None
    assert value(spark, T.repeated_passage(lit("x a b c d e f y"), lit("a b c d e f"))) == "a b c d e f"
    assert value(spark, T.shorten(lit("  hello   world - "), 32)) == "hello world" and [value(spark, T.shorten(lit("aaaa bbbb cccc"), n)) for n in (10, 9, 3)] == ["aaaa bbbb", "aaaa", "aaa"]
    assert value(spark, T.repeated_passage(lit("so it's a b c d e, f"), lit("It's a b c d e g"))) == "it's a b c d e"
    assert value(spark, T.escape_path(lit("C:\\a\\b"))) == "C\\:/a/b" and value(spark, T.translate_terms(lit("le mot"), [("mot", "a\\b$c")])) == "le a\\b$c"
    num = lambda x: F.lit(x).cast("double")
    assert [value(spark, T.enable_clause(num(a), num(b))) for a, b in ((0, None), (1, None), (1, 2.5))] == ["", ":enable='gte(t,1.000)'", ":enable='between(t,1.000,2.500)'"]
    assert value(spark, T.text_alpha(num(1), num(3), num(0.25), num(0.9))) == "'if(lt(t,1.250),0.900*(t-1.000)/0.250,if(lt(t,2.750),0.900,0.900*(3.000-t)/0.250))'"
    assert value(spark, T.text_alpha(num(1), num(None), num(0.25), num(0.9))) == "0.900"
    assert value(spark, T.audio_clause(num(2), num(150), num(1.05))) == "atempo=1.0500,adelay=delays=2150:all=1"
    assert value(spark, G.always_on(num(0), num(None), num(None))) and not value(spark, G.always_on(num(0), num(3), num(None))) and value(spark, G.fade_span(num(0.3), num(0), num(None))) == 0.0
    assert value(spark, T.frame_rate(lit("30000/1001"))) == pytest.approx(29.97, abs=0.01) and value(spark, T.frame_rate(lit("25"))) == 25.0
    assert value(spark, T.resolve_ui_reference(lit("named_control"), lit("le menu"))).kind == "spatial"


def test_subtitles(spark):
    assert value(spark, subtitles.wrap_lines(F.array(*map(F.lit, "aa bb cccc d".split())), 5)) == ["aa bb", "cccc", "d"]
    got = subtitles.split_cues("one " * 40)
    assert len(got) > 1 and all(len(c) <= 2 for c in got) and sum(len(x.split()) for c in got for x in c) == 40
    d = spark.createDataFrame([("v", "a", "w " * 40), ("v", "b", "gone")], "video_id string, id string, text_en string")
    t = spark.createDataFrame([("v", "a", 0.0, 20.0)], "video_id string, id string, new_start double, new_end double")
    rows = subtitles.srt_blocks(subtitles.cues(d, t)).orderBy("index").collect()
    assert rows[0]["index"] == 1 and rows[0].start == 0.0 and rows[-1].end == 20.0 and all(a.end == b.start for a, b in zip(rows, rows[1:]))


def test_segmentation(spark):
    words = [("v", i, w, i * 0.4, i * 0.4 + 0.32) for i, w in enumerate("one two three. four five six seven eight.".split(), 1)]
    w = spark.createDataFrame(words, "video_id string, pos int, text string, start double, end double")
    got = segmentation.segments(w, Segmentation(max_seconds=2.5, min_seconds=0.5)).orderBy("ord").collect()
    assert [r.text for r in got] == ["one two three.", "four five six seven eight."] and got[0].id == "seg-001"
    at = np.arange(50) * 0.4
    cuts = segmentation.fit(at, at + 0.32, np.arange(50) == 20, Segmentation(max_seconds=6.0))
    assert len(cuts) > 2 and cuts[0][0] == 0 and cuts[-1][1] == 50 and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:])) and 21 in [b for _, b in cuts]
    assert segmentation.packed([(0, 5), (5, 10), (10, 30), (30, 32)], at, at + 0.32, Segmentation(max_seconds=4.0)) == [(0, 10), (10, 30), (30, 32)]
    whole = F.array(*[F.struct(F.lit(t).alias("text"), F.lit(float(i)).alias("start"), F.lit(i + 1.0).alias("end")) for i, t in enumerate(["so ", " it goes.  ", "On", "and on"])])
    assert [r.text for r in value(spark, segmentation.merge_into_sentences(whole, 10.0))] == ["so it goes.  ", "On and on"]
    late = spark.createDataFrame([("v", 1, 0.0, [("b", 0.0, 1.0)]), ("v", 0, 5.0, [("a", 5.0, 6.0)])], "video_id string, ord int, start double, words array<struct<text:string,start:double,end:double>>")
    assert [r.text for r in segmentation.word_table(late).orderBy("pos").collect()] == ["b", "a"]


def detections(spark, rows):
    return spark.createDataFrame([("v", float(t), i, s, x, 0.2, 0.1, 0.05, c) for i, (t, s, x, c) in enumerate(rows)], "video_id string, ts double, det_ord long, text string, x double, y double, width double, height double, confidence double")


def test_tracking(spark):
    run = lambda rows: tracking.elements(tracking.track(detections(spark, rows)), 0.5).orderBy("id").collect()
    one = run([(i * 0.5, "Save", 0.1, 0.9) for i in range(6)])
    assert len(one) == 1 and one[0].occurrences == 6 and (one[0].first_seen, one[0].last_seen) == (0.0, 2.5)
    assert len(run([(0, "Save", 0.1, 0.9), (0, "Save", 0.6, 0.9)])) == 2
    assert len(run([(0, "Save", 0.1, 0.9), (5, "Save", 0.1, 0.9)])) == 2
    analysed = spark.createDataFrame([("v", 0.0, [("A", (0.1, 0.1, 0.1, 0.1), 0.9)]), ("v", 1.0, [])], f"video_id string, timestamp double, detections array<struct<text:string,box:{BOX},confidence:double>>")
    e = tracking.regroup(analysed, spark.createDataFrame([("v", 4)], "video_id string, n_frames int"), ScreenText(min_length=1)).collect()
    assert len(e) == 1 and e[0].occurrences == 2


def elements(spark, rows):
    return spark.createDataFrame([("v", i, t, (x, 0.3, 0.08, 0.03), float(a), float(b), 0.95, 10) for i, t, x, a, b in rows], f"video_id string, id string, text string, box {BOX}, first_seen double, last_seen double, confidence double, occurrences int")


def test_match(spark):
    d = spark.createDataFrame([("v", "s1", 10.0, 20.0, ("named_control", "Revenue"))], "video_id string, id string, source_start double, source_end double, ui_reference struct<kind:string,label:string>")
    empty = spark.createDataFrame([], "video_id string, timestamp double, x double, y double")
    at = lambda x: spark.createDataFrame([("v", 12.0, x, 0.31)], empty.schema)
    run = lambda e, t=empty, **c: matching.match(d, elements(spark, e), t, [], Matching(**c)).first()
    r = run([("e1", "Revenue", 0.2, 5, 40)])
    assert r.verdict == "accepted" and r.score == 1.0 and r.window.start_offset is None
    twice = [("e1", "Revenue", 0.2, 5, 40), ("e2", "Revenue", 0.6, 5, 40)]
    r = run(twice)
    assert r.reason_code == "ambiguous" and len(r.rivals) == 1 and r.element_id is None
    r = run(twice, at(0.62))
    assert r.verdict == "accepted" and r.element_id == "e2" and r.evidence == ["ocr", "cursor"] and r.rivals == ["Revenue"]
    assert r.cursor_distance == 0.0 and r.label == "Revenue" and run(twice).cursor_distance is None
    many = [(f"e{i}", "Revenue", 0.1 * i, 5, 40) for i in range(1, 8)]
    assert len(run(many).rivals) == 4 and len(run(many, at(0.42)).rivals) == 6 and run([("e1", "Revenue", 0.2, 10, 11)]).rivals == []
    assert run([("e1", "Revenue", 0.2, 10, 11)]).reason_code == "too_brief"
    assert run([("e1", "Else", 0.2, 5, 40)]).reason_code == "no_candidate"
    r = run([("e1", "Revenue", 0.2, 10, 14), ("e2", "Revenue", 0.201, 15, 20)])
    assert r.verdict == "accepted" and r.visible == pytest.approx(0.9)
    assert matching.match_counts(matching.match(d, elements(spark, twice), empty), d).first().named == 1


def test_cursor(spark):
    t = spark.createDataFrame([("v", 0.0, 0.2, 0.31), ("v", 30.0, 0.9, 0.9)], "video_id string, timestamp double, x double, y double")
    s = cursor.spans(t).orderBy("start").collect()
    assert (s[0].start, s[0].end) == (0.0, 6.0)
    h = cursor.hovers(t, elements(spark, [("e1", "Revenue", 0.15, 0, 100)])).collect()
    assert len(h) == 1 and h[0].element_id == "e1" and h[0].start == 0.0
    still = spark.createDataFrame([("v", 0.0, 1.0, 0.0, 0.0, 0.0, 0.0)], "video_id string, start double, end double, x0 double, y0 double, x1 double, y1 double")
    assert [r.ts for r in cursor.held_positions(still, 0.25).orderBy("ts").collect()] == [0, 0.25, 0.5, 0.75]
    assert Cursor().fps == 8 and Hover().max_hold == 6


def test_pointer(spark):
    px = [("v", s, r, c) for s, cols in ((0, (30, 80)), (1, (80, 130))) for base in cols for r in range(100, 106) for c in range(base, base + 6)]
    b = vision.blobs(spark.createDataFrame(px, "video_id string, step int, row int, col int"), 200, 200)
    got = temporal.moving_pointer(b, 0.01).collect()
    assert len(got) == 1 and got[0].frame == 1 and got[0].x == pytest.approx(0.41, abs=0.01)


def test_vision(spark):
    vals = lambda xs: F.array(*[F.struct(F.lit(i).alias("at"), F.lit(float(x)).alias("v")) for i, x in enumerate(xs)])
    assert [r["at"] for r in value(spark, vision.greedy_keep(vals([0, 0, 0.5, 0.5, 0.9]), F.lit(0.05)))] == [0, 2, 4]
    capped = value(spark, vision.capped_keep(vals([i % 2 for i in range(60)]), 0.05, 10))
    assert len(capped.kept) <= 10 and capped.threshold > 0.05
    var = spark.createDataFrame([("v", r, 0.0 if r < 80 else 5.0) for r in range(400)], "video_id string, row int, variation double")
    assert vision.variation_height(var, 400).first().height == 80
    assert vision.variation_height(var.withColumn("variation", F.lit(0.0)), 400).isEmpty()
    band = spark.createDataFrame([("v", f, c, r, float(r >= at)) for f in range(2) for c, at in (("blue", 30), ("green", 12)) for r in range(50)], "video_id string, frame int, color string, row int, coverage double")
    assert vision.anchor_height(band).first().height == 12


def test_layout_checks_plans(spark):
    got = value(spark, layout.compute_layout(F.lit(1920), F.lit(1080)))
    assert (got.width, got.height, got.top, got.bottom) == (1920, 1080, 0, 0)
    shape = lambda top, bottom: F.struct(F.lit(top).alias("top"), F.lit(bottom).alias("bottom"))
    assert value(spark, layout.progress_y(shape(0, 0))) is None and value(spark, layout.progress_y(shape(0, 90))) == Config().layout.height - Config().layout.progress
    assert value(spark, layout.subtitle_font_size(shape(0, 60))) == 21 and value(spark, layout.subtitle_font_size(shape(0, 0))) == Config().layout.subtitle_size
    assert [hardware_tier(v) for v in (0, 8, 12)] == ["cpu-16gb", "gpu-8vram", "gpu-12vram-plus"]
    assert value(spark, checks.audio_levels(F.lit("mean_volume: -60.0 dB max_volume: -3.0 dB"))).warning == "too_quiet"
    assert stages.plan_steps("match") == ["match"] and stages.plan_steps(start_from="render") == ["render", "validate"]
    with pytest.raises(ValueError):
        stages.plan_steps("match", "render")
    with pytest.raises(RuntimeError, match="resume"):
        stages.run_steps(["x"], lambda _: 1 / 0)
    answers = iter([{"t": 1}, {"t": 2}])
    assert plug.with_retry(lambda _: next(answers), lambda a: ["bad"] * (3 - a["t"]), "p") == {"t": 2}


def test_constraints(spark):
    rows = spark.createDataFrame([("v", 0.0, 0.5, 0.5), ("v", -1.0, 2.0, 0.5)], schema("cursor"))
    good, bad = split_valid(rows, constraints()["cursor"])
    assert good.count() == 1 and bad.first().violated == ["ts_not_negative", "inside"]


def test_plain_form_of_every_character(spark):
    """Alone and among letters, as Python has it; short and long way agree."""
    rows = [(c, f" {chr(c)}", f"a\u00c9{chr(c)}\u0301 b\t\n") for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["c", "x", "y"])).repartition(4)
    got = df.select("c", T.normalize(F.col("x")).alias("x"), T.normalize(F.col("y")).alias("y")).toPandas().sort_values("c")
    want = [(c, T._normalize(x), T._normalize(y)) for c, x, y in rows]
    wrong = [(hex(c), g, w) for (c, *w), g in zip(want, got[["x", "y"]].values.tolist()) if w != g]
    assert not wrong, (len(wrong), wrong[:5])


def test_plain_form_of_texts(spark):
    texts = [None, "", " \u00a0 ", "\u039f\u0394\u039f\u03a3 \u03a3\u0391\u03a3. \u03a3", "\u0391\u03a3'\u0391 \u0391\u03a3'", "\ufb01n \u2460 \uac00\uac01", "e\u0301\u0323 \u1e9e \u0130I", "\U0001d54f\U0001f600 a\x1cb\x85c", "Pr\u00e9visions  \u00c0\tjour"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(T.normalize(F.col("t"))).collect()] == [T._normalize(t) for t in texts]


def test_plain_form_takes_few_passes(spark):
    """Texts with some letters that aren't Latin are replaced as a whole: a megabyte takes less than ten looked-up ones did;
    terms look at a text's plain form once."""
    import time

    text = ("Der große Weg … ½ und \ufb01n, Москва. " * 25_000)[:1_000_000]
    df = spark.createDataFrame([(i, text + str(i)) for i in range(10)], "i int, t string").repartition(1)
    T_ = [(f"weg{i}", "x") for i in range(9)] + [("weg", "way")]
    df.limit(1).select(T.relevant_terms(F.col("t"), T_)).collect()
    began = time.time()
    got = df.select("i", F.size(T.relevant_terms(F.col("t"), T_)).alias("n"), F.md5(T.normalize(F.col("t")).cast("binary")).alias("h")).collect()
    assert time.time() - began < 60 and {r.n for r in got} == {1}
    assert {r.i: r.h for r in got} == {i: hashlib.md5(T._normalize(text + str(i)).encode()).hexdigest() for i in range(10)}


def test_confidence_rounds_halves_up_as_sql_does(spark):
    """Their mean is 0.96125 but for the last bit of a sum."""
    sure = [0.95, 1.0, 0.94, 0.97, 0.99, 0.93, 0.92, 0.99]
    one = tracking.elements(tracking.track(detections(spark, [(i * 0.5, "Save", 0.1, x) for i, x in enumerate(sure)])), 0.5).first()
    assert one.occurrences == 8 and one.confidence == 0.9613
