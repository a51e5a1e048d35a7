"""Subtitles: wrapped lines, cues and their times, SRT and ASS rows."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, pairwise

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Layout, Subtitles
from ..functions.text import ass_color, ass_text, ass_time, srt_time
from .layout import subtitle_font_size
from .segmentation import SOFT, STRONG
from .temporal import KEY


def wrap_lines(words: Column, most: int) -> Column:
    """Greedy lines of at most so many characters; a longer word has a line of its own (Q03). The line
    that grows is carried apart from those that are done."""

    def step(acc: Column, w: Column) -> Column:
        line = acc["line"]
        fits = F.length(line) + 1 + F.length(w) <= most
        done = F.when(line.isNull() | fits, acc["done"]).otherwise(F.concat(acc["done"], F.array(line)))
        return F.struct(done.alias("done"), F.when(fits, F.concat(line, F.lit(" "), w)).otherwise(w).alias("line"))

    zero = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("line"))
    return F.aggregate(words, zero, step, lambda acc: F.when(acc["line"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["line"]))))


def split_cues(text: str, c: Subtitles = Subtitles()) -> list[list[str]]:
    """The lines of each cue (Q04). Lines end where the sums of the words' widths pass the width; a cue
    that is full goes back to its last strong, else soft mark, if half of its words stay."""
    words = (text or "").split()
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))  # of the first i words, each with a space
    mark = [2 if w.endswith(STRONG) else int(w.endswith(SOFT)) for w in words]
    at, out = 0, []
    while at < len(words):
        breaks = [at]
        while breaks[-1] < len(words) and len(breaks) <= c.max_lines:
            breaks.append(max(breaks[-1] + 1, bisect_right(ends, ends[breaks[-1]] + c.max_chars + 1) - 1))
        stop = breaks[-1]
        if stop < len(words):
            need = at + max(1, int((stop - at) * c.min_fill))
            strength, last = max((mark[i - 1], i) for i in range(need, stop + 1))
            stop = last if strength else stop
        out.append([" ".join(words[a : min(b, stop)]) for a, b in pairwise(breaks) if a < stop])
        at = stop
    return out


def cues(decisions: DataFrame, timeline: DataFrame, c: Subtitles = Subtitles(), keys=KEY) -> DataFrame:
    """(keys, index, start, end, lines): each segment's cues share its new span by their words."""
    met = decisions.select(*keys, "id", "text_en").join(timeline.select(*keys, "id", "new_start", "new_end"), [*keys, "id"])
    kinds = {f.name: f.dataType.simpleString() for f in met.schema}
    schema = ", ".join(f"{k} {kinds[k]}" for k in (*keys, "id")) + ", new_start double, new_end double, cue int, lines array<string>, n int"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.to_dict("records"):
                base = {k: r[k] for k in (*keys, "id", "new_start", "new_end")}
                rows += [base | {"cue": i, "lines": x, "n": sum(len(y.split()) for y in x)} for i, x in enumerate(split_cues(r["text_en"], c))]
            yield pd.DataFrame(rows, columns=[*keys, "id", "new_start", "new_end", "cue", "lines", "n"])

    return cue_times(met.mapInPandas(run, schema), keys)


def cue_times(split: DataFrame, keys=KEY) -> DataFrame:
    """split(keys, id, new_start, new_end, cue, lines, n) with times by cumulative words (W11), and
    index from 1 (K05)."""
    w = W.partitionBy(*keys, "id").orderBy("cue")
    done, total = F.sum("n").over(w), F.sum("n").over(W.partitionBy(*keys, "id"))
    at = lambda n: F.col("new_start") + (F.col("new_end") - F.col("new_start")) * n / total
    timed = split.withColumns({"start": at(done - F.col("n")), "end": at(done)})
    no = F.row_number().over(W.partitionBy(*keys).orderBy("new_start", "id", "cue"))
    return timed.select(*keys, no.alias("index"), "id", "start", "end", "lines")


def srt_blocks(c: DataFrame) -> DataFrame:
    """c with `block`: number, times and lines."""
    return c.withColumn("block", F.concat_ws("\n", F.col("index").cast("string"), F.concat(srt_time(F.col("start")), F.lit(" --> "), srt_time(F.col("end"))), F.array_join("lines", "\n")))


def ass_events(c: DataFrame, position: Column | str = "") -> DataFrame:
    """c with `event`: a Dialogue row, its text at a position."""
    text = F.array_join(F.transform("lines", ass_text), "\\N")
    at = F.lit(position) if isinstance(position, str) else position
    return c.withColumn("event", F.concat(F.lit("Dialogue: 0,"), ass_time(F.col("start")), F.lit(","), ass_time(F.col("end")), F.lit(",Default,,0,0,0,,"), at, text))


def ass_position(l: Column, c: Layout = Layout()) -> Column:
    """The middle of a layout's lower band; nothing where there is none."""
    y = F.lit(c.height) - l["bottom"] + F.floor(l["bottom"] / 2).cast("int")
    return F.when(l["bottom"] > 0, F.format_string(f"{{\\an5\\pos({c.width // 2},%d)}}", y)).otherwise("")


def ass_header(l: Column, c: Layout = Layout(), subtitles: Subtitles = Subtitles(), color: str = "white", font: str = "Arial") -> Column:
    """All before the events: size of the canvas, the style, centred in the layout's band or outlined at the
    bottom, and what the fields of both kinds of rows are (K06)."""
    band = l["bottom"] > 0
    fields = "Name, Fontname, Fontsize, PrimaryColour, SecondaryColour, OutlineColour, BackColour, Bold, Italic, Underline, StrikeOut, ScaleX, ScaleY, Spacing, Angle, BorderStyle, Outline, Shadow, Alignment, MarginL, MarginR, MarginV, Encoding"
    kind = F.when(band, "0,0,5").otherwise("2,0,2")  # outline, shadow, alignment
    below = F.when(band, 0).otherwise(round(c.height * 0.05)).cast("string")
    style = F.concat_ws(",", F.lit(f"Style: Default,{font}"), subtitle_font_size(l, subtitles.max_lines, c).cast("string"), ass_color(F.lit(color)), F.lit("&H000000FF,&H00000000,&H80000000,0,0,0,0,100,100,0,0,1"), kind, F.lit(f"{c.padding},{c.padding}"), below, F.lit("1"))
    script = f"[Script Info]\nScriptType: v4.00+\nPlayResX: {c.width}\nPlayResY: {c.height}\nWrapStyle: 2\nScaledBorderAndShadow: yes\n\n[V4+ Styles]\nFormat: {fields}"
    return F.concat_ws("\n", F.lit(script), style, F.lit("\n[Events]\nFormat: Layer, Start, End, Style, Name, MarginL, MarginR, MarginV, Effect, Text"))


def register_udtfs(spark) -> None:
    """split_cues(text) for SQL: a row (cue, lines) for each cue (§2.16)."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="cue int, lines array<string>")
    class SplitCues:
        def eval(self, text: str):
            yield from enumerate(split_cues(text))

    spark.udtf.register("split_cues", SplitCues)
