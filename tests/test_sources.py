"""Readers and writers: round trips, empty and missing files; stream forms against batch rules."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.temporal import upsert
from tidemark.sources import readers, sinks
from tidemark.streaming import state

BOX = {"x": 0.1, "y": 0.1, "width": 0.1, "height": 0.1}


def write(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(value), encoding="utf-8")
    return str(path)


def test_readers(spark, tmp_path):
    t = readers.load_transcript(spark, write(tmp_path / "v1/transcript.json", [{"id": "a", "start": 0, "end": 1, "text_fr": "é", "words": [{"text": "é", "start": 0, "end": 1}]}]))
    assert t.first().video_id == "v1" and t.first().words[0].text == "é"
    d = readers.load_detections(spark, write(tmp_path / "v1/d.json", {"frames_sampled": 2, "analysed": [{"timestamp": 0, "detections": [{"text": "A", "box": BOX, "confidence": 0.9}]}, {"timestamp": 1, "detections": []}]}))
    assert sorted(len(r.detections) for r in d.collect()) == [0, 1]
    n = readers.load_narration(spark, write(tmp_path / "v1/n.json", [{"segment_id": "s", "audio_file": "1", "duration": 1}, {"segment_id": "s", "audio_file": "2", "duration": 2}]))
    assert [r.audio_file for r in n.collect()] == ["2"]
    assert readers.load_track(spark, write(tmp_path / "v1/c.json", {"sample_fps": 8, "samples": [{"timestamp": 0, "x": 0.5, "y": 0.5}]})).first().x == 0.5
    assert readers.load_elements(spark, write(tmp_path / "v1/e.json", {"elements": [{"id": "scr-0001", "text": "A", "box": BOX, "first_seen": 0, "last_seen": 1, "confidence": 1, "occurrences": 1}]})).first().box.x == 0.1
    assert readers.load_timeline(spark, write(tmp_path / "v1/t.json", {"entries": [{"id": "s", "new_start": 0, "new_end": 1}]})).count() == 1
    assert readers.load_glossary(spark, str(tmp_path / "none.yaml")).count() == 0
    assert readers.load_chapters(spark, str(tmp_path / "none.json")).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.load_decisions(spark, str(tmp_path / "none.yaml"))


def test_probe(spark):
    probe = json.dumps({"streams": [{"codec_type": "audio", "duration": "9.5"}, {"codec_type": "video", "width": 4, "height": 3, "r_frame_rate": "30/1", "codec_name": "h264"}], "format": {"duration": "10"}})
    r = spark.createDataFrame([(probe,)], "p string").select(readers.probe_row(F.col("p")).alias("r")).first().r
    assert r.has_video and r.has_audio and r.fps == 30.0 and r.video_duration == 10.0 and r.audio_duration == 9.5


def test_frames(spark, tmp_path):
    for i in range(3):
        (tmp_path / "v").mkdir(exist_ok=True)
        (tmp_path / f"v/f{i}.jpg").write_bytes(b"x%d" % i)
    assert [r.ts for r in readers.frames(spark, str(tmp_path), 0.5).orderBy("frame").collect()] == [0.0, 0.5, 1.0]


def test_decisions_round_trip(spark, tmp_path):
    (tmp_path / "v").mkdir()
    rows = [("v", 0, "s", 0.0, 1.0, "é", "e", ["t"], ("point", None), None, ("x", 1, 2))]
    from tidemark.schemas import schema

    d = spark.createDataFrame(rows, schema("decisions"))
    sinks.save_decisions_yaml(d, str(tmp_path / "v/d.yaml"))
    assert readers.load_decisions(spark, str(tmp_path / "v/d.yaml")).collect() == d.collect()


def test_subtitle_files(spark, tmp_path):
    cues = spark.createDataFrame([("v", 2, "b", 1.0, 2.0, ["two"]), ("v", 1, "a", 0.0, 1.0, ["one", "more"])], "video_id string, index int, id string, start double, end double, lines array<string>")
    sinks.save_srt(cues, str(tmp_path / "srt"))
    text = next((tmp_path / "srt/video_id=v").glob("*.txt")).read_text()
    assert text == "1\n00:00:00,000 --> 00:00:01,000\none\nmore\n\n2\n00:00:01,000 --> 00:00:02,000\ntwo\n\n"
    sinks.save_ass(cues, str(tmp_path / "ass"))
    text = next((tmp_path / "ass/video_id=v").glob("*.txt")).read_text()
    assert text.startswith("[Script Info]") and text.index("one\\Nmore") < text.index("two") and ",2,0,2,32,32,54,1\n" in text and "pos(" not in text


def test_a_whole_subtitle_file(spark, tmp_path):
    """In a band of 110 rows below the picture two lines of 40 don't fit, so the letters are smaller."""
    cues = spark.createDataFrame([("v", 1, "a", 0.0, 1.5, ["one", "{more}"])], "video_id string, index int, id string, start double, end double, lines array<string>")
    layouts = spark.createDataFrame([("v", (64, 110)), ("w", (0, 0))], "video_id string, layout struct<top:int,bottom:int>")
    sinks.save_ass(cues, str(tmp_path / "ass"), layouts, color="yellow")
    text = next((tmp_path / "ass/video_id=v").glob("*.txt")).read_text()
    want = """[Script Info]
ScriptType: v4.00+
PlayResX: 1920
PlayResY: 1080
WrapStyle: 2
ScaledBorderAndShadow: yes

[V4+ Styles]
Format: Name, Fontname, Fontsize, PrimaryColour, SecondaryColour, OutlineColour, BackColour, Bold, Italic, Underline, StrikeOut, ScaleX, ScaleY, Spacing, Angle, BorderStyle, Outline, Shadow, Alignment, MarginL, MarginR, MarginV, Encoding
Style: Default,Arial,38,&H0000FFFF,&H000000FF,&H00000000,&H80000000,0,0,0,0,100,100,0,0,1,0,0,5,32,32,0,1

[Events]
Format: Layer, Start, End, Style, Name, MarginL, MarginR, MarginV, Effect, Text
"""
    assert text.startswith(want)
    event = text[len(want) :]
    assert event.startswith("Dialogue: 0,0:00:00.00,0:00:01.50,Default,,0,0,0,,{\\an5\\pos(960,1025)}one\\N") and event.count("\n") == 1


def test_upsert(spark):
    a = spark.createDataFrame([("a", 1), ("b", 2)], "name string, v int")
    assert sorted(map(tuple, upsert(a, spark.createDataFrame([("b", 3)], a.schema), ["name"]).collect())) == [("a", 1), ("b", 3)]


def test_stream_keeps_what_batch_keeps(spark, tmp_path):
    rows = [("v", float(i), v) for i, v in enumerate([0.0, 0.0, 0.5, 0.5, 0.9])]
    spark.createDataFrame(rows, "video_id string, ts double, v double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("video_id string, ts double, v double").parquet(str(tmp_path / "in"))
    q = state.greedy_keep_stream(stream, 0.05).writeStream.format("memory").queryName("kept").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r.ts for r in spark.table("kept").collect()) == [0.0, 2.0, 4.0]
