"""Writers: Parquet as the system of record, and the text formats that players and renderers read."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Layout
from ..operators.subtitles import ass_events, ass_header, ass_position, srt_blocks
from ..operators.temporal import upsert


def save(df: DataFrame, path: str, partition_by: str = "video_id") -> None:
    """Replaced as a whole once it is complete; a costly stage is saved so and read again."""
    df.write.mode("overwrite").partitionBy(partition_by).parquet(path)


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_decisions_yaml(df: DataFrame, path: str, video_id=None) -> None:
    """One video's decision list, in order, on the driver; several videos raise."""
    import yaml

    own = df if video_id is None else df.where(F.col("video_id") == F.lit(video_id))
    if own.select("video_id").distinct().limit(2).count() > 1:
        raise ValueError("several videos: name the one to save")
    rows = [r.asDict(recursive=True) for r in own.orderBy("ord").drop("video_id", "ord").collect()]  # one video's segments
    Path(path).write_text(yaml.safe_dump(rows, allow_unicode=True, sort_keys=False), encoding="utf-8")


def _write_lines(df: DataFrame, line: str, path: str, sep: str) -> None:
    """df(video_id, index, line): one text file a video, in order."""
    df.repartition("video_id").sortWithinPartitions("video_id", "index").select("video_id", F.col(line).alias("value")).write.mode("overwrite").partitionBy("video_id").option("lineSep", sep).text(path)


def save_srt(cues: DataFrame, path: str) -> None:
    """K05."""
    _write_lines(srt_blocks(cues), "block", path, "\n\n")


def save_ass(cues: DataFrame, path: str, layouts: DataFrame | None = None, c: Layout = Layout(), **style) -> None:
    """A header, then events, for each video, as its layout(video_id, layout) has it; without layouts, below
    the picture (K06)."""
    videos = cues.select("video_id").distinct()
    met = videos.join(layouts, "video_id", "left") if layouts is not None else videos.withColumn("layout", F.lit(None).cast("struct<top:int,bottom:int>"))
    met = met.select("video_id", F.coalesce(F.col("layout.bottom"), F.lit(0)).alias("bottom")).select("video_id", F.struct("bottom").alias("l"))
    events = ass_events(cues.join(met, "video_id"), ass_position(F.col("l"), c)).select("video_id", "index", "event")
    head = met.select("video_id", F.lit(0).alias("index"), ass_header(F.col("l"), c, **style).alias("event"))
    _write_lines(head.unionByName(events), "event", path, "\n")


def save_texts(texts: DataFrame, path: str) -> None:
    """texts(name, text): a file for each content, equal ones once."""
    texts.dropDuplicates(["name"]).select("name", F.col("text").alias("value")).write.mode("overwrite").partitionBy("name").text(path)


def save_manifest(existing: DataFrame, new: DataFrame, path: str) -> None:
    """Rows of the same name replaced (K08). path is not where existing is read from."""
    upsert(existing, new, ["name"]).write.mode("overwrite").parquet(path)
