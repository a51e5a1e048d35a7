"""Quality of translations and of delivered files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Checks
from ..functions import text as T
from .temporal import KEY, overlaps


def review(df: DataFrame, glossary: list[tuple[str, str]], c: Checks = Checks(), keys=KEY, order: str = "ord") -> DataFrame:
    """df(text_fr, text_en) with `issues`, in order: terms, names, numbers, condensed, repeated."""
    previous = F.lag("text_en", 1, "").over(W.partitionBy(*keys).orderBy(order))
    df = df.withColumns({"_previous": previous, "_names": T.proper_names(F.col("text_fr"))})
    fr, en = F.col("text_fr"), F.col("text_en")
    each = lambda name, xs: F.transform(xs, lambda x: F.concat(F.lit(name + ":"), x))
    one = lambda name, cond: F.when(F.coalesce(cond, F.lit(False)), F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    issues = F.concat(
        each("term", T.missing_terms(fr, en, glossary)), each("name", T.missing_names(F.col("_names"), en)), each("number", T.missing_numbers(fr, en)),
        one("condensed", T.over_condensed(fr, en, c.condensed_ratio, c.condensed_words)), one("repeated", T.repeated_passage(en, F.col("_previous"), c.shingle).isNotNull()),
    )
    return df.withColumn("issues", issues).drop("_previous", "_names")


def better_retry(first: Column, second: Column) -> Column:
    """The second answer (a struct with `issues`) if it has strictly fewer; a failed one is null."""
    return F.when(second.isNotNull() & (F.size(second["issues"]) < F.size(first["issues"])), second).otherwise(first)


def audio_levels(log: Column, c: Checks = Checks()) -> Column:
    """(mean_db, max_db, warning) from a volume report's text."""
    db = lambda what: F.regexp_extract(log, rf"{what}_volume:\s*(-?[0-9.]+) dB", 1).try_cast("double")
    mean, peak = db("mean"), db("max")
    return F.struct(mean.alias("mean_db"), peak.alias("max_db"), F.when(mean < c.quiet_db, "too_quiet").when(peak > c.clip_db, "clipping").alias("warning"))


def validate(outputs: DataFrame, timeline: DataFrame, c: Checks = Checks(), keys=KEY) -> DataFrame:
    """(keys, severity, code, detail): errors of streams and durations; warnings of levels, overlaps
    and shots to review (M06, P21, P22). outputs(keys, has_video, has_audio, video_duration, audio_duration, volume_log)."""
    gap = F.abs(F.col("video_duration") - F.col("audio_duration"))
    none = F.lit(None).cast("string")
    row = lambda severity, code, detail: F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), detail.alias("detail"))
    warn = audio_levels(F.col("volume_log"), c)["warning"]
    found = F.array_compact(F.array(
        F.when(~F.col("has_video"), row("error", "no_video", none)), F.when(~F.col("has_audio"), row("error", "no_audio", none)),
        F.when(gap > c.av_gap, row("error", "duration_gap", F.format_string("%.3f", gap))), F.when(warn.isNotNull(), row("warning", "level", warn)),
    ))
    files = outputs.select(*keys, F.explode(found).alias("f")).select(*keys, "f.*")
    over = overlaps(timeline, "new_start", "new_end", keys, ("id",), 1e-6).select(*keys, F.lit("warning").alias("severity"), F.lit("overlap").alias("code"), F.col("id").alias("detail"))
    look = timeline.where("needs_review").select(*keys, F.lit("warning").alias("severity"), F.lit("needs_review").alias("code"), F.col("id").alias("detail"))
    return files.unionByName(over).unionByName(look)
