"""Declared schemas of the tables, and their constraints as predicates. Every table has video_id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_BOX = "struct<x:double,y:double,width:double,height:double>"
SCHEMAS = {
    "transcript": "video_id string, ord long, id string, start double, end double, text_fr string, words array<struct<text:string,start:double,end:double>>",
    "words": "video_id string, ord long, text string, start double, end double",
    "decisions": "video_id string, ord long, id string, source_start double, source_end double, text_fr string, text_en string, sap_terms array<string>, ui_reference struct<kind:string,label:string>, "
        "visual_action struct<type:string,x:double,y:double,width:double,height:double,start_offset:double,end_offset:double>, narration struct<voice:string,pause_before_ms:int,pause_after_ms:int>",
    "narration": "video_id string, ord long, segment_id string, audio_file string, duration double, provider string, voice string",
    "timeline": "video_id string, ord long, id string, source_start double, source_end double, new_start double, new_end double, narration_duration double, audio_speed_factor double, extended boolean, needs_review boolean",
    "detections": f"video_id string, timestamp double, detections array<struct<text:string,box:{_BOX},confidence:double>>",
    "elements": f"video_id string, id string, text string, box {_BOX}, first_seen double, last_seen double, confidence double, occurrences int",
    "cursor": "video_id string, timestamp double, x double, y double",
    "glossary": "fr string, en string",
    "chapters": "video_id string, ord long, title string, first_segment string",
}


def schema(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


def _in01(c: str) -> Column:
    return F.col(c).between(0, 1)


def _box(prefix: str) -> Column:
    return _in01(f"{prefix}.x") & _in01(f"{prefix}.y") & (F.col(f"{prefix}.width") > 0) & (F.col(f"{prefix}.width") <= 1) & (F.col(f"{prefix}.height") > 0) & (F.col(f"{prefix}.height") <= 1)


def constraints() -> dict[str, dict[str, Column]]:
    """table: {rule: what a good row satisfies}."""
    col, ref = F.col, F.col("ui_reference")
    return {
        "transcript": {"start_not_negative": col("start") >= 0, "end_after_start": col("end") > col("start")},
        "words": {"start_not_negative": col("start") >= 0, "end_after_start": col("end") > col("start")},
        "decisions": {
            "end_after_start": col("source_end") > col("source_start"),
            "pauses_not_negative": (col("narration.pause_before_ms") >= 0) & (col("narration.pause_after_ms") >= 0),
            "label_iff_named": ref.isNull() | ((ref["kind"] == "named_control") == (ref["label"].isNotNull() & (F.trim(ref["label"]) != ""))),
            "action_box": col("visual_action").isNull() | _box("visual_action"),
            "action_offsets": col("visual_action.start_offset").isNull() | col("visual_action.end_offset").isNull() | (col("visual_action.end_offset") > col("visual_action.start_offset")),
        },
        "narration": {"duration_positive": col("duration") > 0},
        "elements": {"box": _box("box"), "seen_in_order": col("last_seen") >= col("first_seen"), "confidence": _in01("confidence"), "occurrences": col("occurrences") > 0},
        "cursor": {"ts_not_negative": col("timestamp") >= 0, "inside": _in01("x") & _in01("y")},
        "chapters": {"title": F.trim("title") != ""},
    }


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """df with `violated`: the names of the rules that a row breaks (a null verdict counts as broken)."""
    return df.withColumn("violated", F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])))


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with `violated`)."""
    good = reduce(lambda a, b: a & b, [F.coalesce(ok, F.lit(False)) for ok in rules.values()])
    return df.where(good), violations(df.where(~good), rules)
