"""Readers. Schemas are declared, never inferred; a row that doesn't fit fails."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import frame_rate
from ..operators.temporal import last_wins
from ..schemas import SCHEMAS, schema

_BOX = "struct<x:double,y:double,width:double,height:double>"


def _json(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).option("multiLine", True).option("mode", "FAILFAST").json(path).withColumn("video_id", _video(F.input_file_name()))


def _video(path: Column) -> Column:
    """A video's files lie in a folder of its own; the folder's name is its id."""
    return F.element_at(F.split(path, "/"), -2)


def _array(spark: SparkSession, path: str, element: str, root: str | None = None) -> DataFrame:
    """Elements of a JSON array, or of a field of a JSON object, with `ord`."""
    text = spark.read.option("wholetext", True).text(path).withColumn("video_id", _video(F.input_file_name()))
    kind = f"array<struct<{element}>>"
    parsed = F.from_json("value", kind, {"mode": "FAILFAST"}) if root is None else F.from_json("value", f"{root} {kind}", {"mode": "FAILFAST"})[root]
    return text.select("video_id", F.posexplode(parsed).alias("ord", "e")).select("video_id", F.col("ord").cast("long").alias("ord"), "e.*")


def load_transcript(spark: SparkSession, path: str) -> DataFrame:
    """S04."""
    return _array(spark, path, "id:string,start:double,end:double,text_fr:string,words:array<struct<text:string,start:double,end:double>>")


def load_elements(spark: SparkSession, path: str) -> DataFrame:
    """S05."""
    return _array(spark, path, f"id:string,text:string,box:{_BOX},first_seen:double,last_seen:double,confidence:double,occurrences:int", "elements").drop("ord")


def load_track(spark: SparkSession, path: str) -> DataFrame:
    """S06."""
    return _array(spark, path, "timestamp:double,x:double,y:double", "samples").drop("ord")


def load_detections(spark: SparkSession, path: str) -> DataFrame:
    """(video_id, timestamp, detections): a frame without detections keeps its empty array."""
    return _array(spark, path, f"timestamp:double,detections:array<struct<text:string,box:{_BOX},confidence:double>>", "analysed").drop("ord")


def load_narration(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of a segment wins."""
    return last_wins(_array(spark, path, "segment_id:string,audio_file:string,duration:double,provider:string,voice:string"), ["video_id", "segment_id"])


def load_timeline(spark: SparkSession, path: str) -> DataFrame:
    """S09."""
    e = _array(spark, path, "id:string,source_start:double,source_end:double,new_start:double,new_end:double,narration_duration:double,audio_speed_factor:double,extended:boolean,needs_review:boolean", "entries")
    return last_wins(e, ["video_id", "id"])


def load_decisions(spark: SparkSession, path: str) -> DataFrame:
    """From YAML on the driver, one file a video; a missing file says what to do, an empty one has no rows."""
    import yaml

    p = Path(path)
    if not p.exists():
        raise FileNotFoundError(f"{path}: no decision list; run the translation step first")
    rows = yaml.safe_load(p.read_text(encoding="utf-8")) or []
    kind = schema("decisions")
    out = [{**{f: r.get(f) for f in kind.fieldNames()}, "video_id": p.parent.name, "ord": i} for i, r in enumerate(rows)]
    return spark.createDataFrame(out, kind)


def load_glossary(spark: SparkSession, path: str) -> DataFrame:
    """(fr, en); a missing file is an empty glossary."""
    import yaml

    p = Path(path)
    raw = (yaml.safe_load(p.read_text(encoding="utf-8")) or {}) if p.exists() else {}
    return spark.createDataFrame([(t["fr"], t["en"]) for t in raw.get("terms", [])], SCHEMAS["glossary"])


def load_chapters(spark: SparkSession, path: str, enabled: bool = True) -> DataFrame:
    """Empty where chapters are off or the file is missing."""
    if not enabled or not Path(path).exists():
        return spark.createDataFrame([], SCHEMAS["chapters"])
    return _array(spark, path, "title:string,first_segment:string", "chapters")


def load_inspection(spark: SparkSession, path: str) -> DataFrame:
    """One row a video."""
    return _json(spark, path, "path string, sha256 string, duration double, width int, height int, fps double")


def probe_row(probe_json: Column) -> Column:
    """The first video and audio streams of a probe's report."""
    p = F.from_json(probe_json, "streams array<struct<codec_type:string,codec_name:string,width:int,height:int,r_frame_rate:string,duration:string>>, format struct<duration:string>")
    first = lambda kind: F.get(F.filter(p["streams"], lambda s: s["codec_type"] == kind), F.lit(0))
    v, a = first("video"), first("audio")
    number = lambda c: c.try_cast("double")
    return F.struct(
        v.isNotNull().alias("has_video"), a.isNotNull().alias("has_audio"), v["width"].alias("width"), v["height"].alias("height"), frame_rate(v["r_frame_rate"]).alias("fps"), v["codec_name"].alias("codec"),
        F.coalesce(number(v["duration"]), number(p["format"]["duration"])).alias("video_duration"), number(a["duration"]).alias("audio_duration"),
    )


def frames(spark: SparkSession, path: str, interval: float) -> DataFrame:
    """Frames that were extracted before, in order, with their times and digests."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").option("recursiveFileLookup", True).load(path)
    no = F.row_number().over(W.partitionBy("video_id").orderBy("path")) - 1
    return files.withColumn("video_id", _video(F.col("path"))).withColumn("frame", no).select("video_id", "frame", F.round(F.col("frame") * interval, 3).alias("ts"), "path", F.sha2("content", 256).alias("sha256"), "content")

