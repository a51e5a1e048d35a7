"""Sentences and segments from timed words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import StructType

from ..config import Segmentation
from .temporal import KEY

STRONG, SOFT = (".", "!", "?", "…"), (",", ";", ":")


def word_table(transcript: DataFrame, keys=KEY) -> DataFrame:
    """(keys, pos, text, start, end): the words of all segments, by their start where they have one,
    else by ord, without blank ones (G04)."""
    first = [F.col("start").alias("_at")] if "start" in transcript.columns else [F.lit(0.0).alias("_at")]
    w = transcript.select(*keys, *first, "ord", F.posexplode("words").alias("_i", "w")).where(F.trim("w.text") != "")
    no = F.row_number().over(W.partitionBy(*keys).orderBy("_at", "ord", "_i"))
    return w.select(*keys, no.alias("pos"), F.trim("w.text").alias("text"), "w.start", "w.end")


def sentence_ids(words: DataFrame, keys=KEY, order: str = "pos") -> DataFrame:
    """words with `sentence`, from 0: a new one after a word that ends one."""
    ends = F.col("text").rlike(r"[.!?…]$")
    w = W.partitionBy(*keys).orderBy(order)
    return words.withColumn("sentence", F.coalesce(F.sum(F.lag(ends).over(w).cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)), F.lit(0)))


def glue(parts: Column, joins, trim: bool = False) -> Column:
    """Of an ordered array of structs (text, start, end): runs in which joins(run so far, next) holds
    are one part (Q05, Q06, Q07). What is done is carried apart, so a step costs no more than a part."""
    kind = "struct<text:string,start:double,end:double>"
    left = (lambda c: F.regexp_replace(c, r"(?U)\s+$", "")) if trim else (lambda c: c)
    right = (lambda c: F.regexp_replace(c, r"(?U)^\s+", "")) if trim else (lambda c: c)

    def step(acc: Column, x: Column) -> Column:
        run = acc["run"]
        both = F.struct(F.concat_ws(" ", left(run["text"]), right(x["text"])).alias("text"), run["start"].alias("start"), x["end"].alias("end"))
        on = run.isNotNull() & joins(run, x)
        done = F.when(on | run.isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(run)))
        return F.struct(done.alias("done"), F.when(on, both).otherwise(x).alias("run"))

    plain = F.transform(parts, lambda x: F.struct(x["text"].alias("text"), x["start"].cast("double").alias("start"), x["end"].cast("double").alias("end")).cast(kind))
    zero = F.struct(F.array().cast(f"array<{kind}>").alias("done"), F.lit(None).cast(kind).alias("run"))
    return F.aggregate(plain, zero, step, lambda acc: F.when(acc["run"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["run"]))))


def pack(parts: Column, longest: float) -> Column:
    """Consecutive parts glued while they last no longer (Q06)."""
    return glue(parts, lambda a, b: b["end"] - a["start"] <= longest)


def merge_short(parts: Column, shortest: float, longest: float) -> Column:
    """A part is glued to the one before it when that one is too short and both fit; at last a short
    final one to its predecessor (Q07)."""
    merged = glue(parts, lambda a, b: (a["end"] - a["start"] < shortest) & (b["end"] - a["start"] <= longest))

    def tail(m: Column) -> Column:
        a, b = F.try_element_at(m, F.lit(-2)), F.try_element_at(m, F.lit(-1))
        both = F.struct(F.concat_ws(" ", a["text"], b["text"]).alias("text"), a["start"].alias("start"), b["end"].alias("end"))
        short = (F.size(m) > 1) & (b["end"] - b["start"] < shortest) & (b["end"] - a["start"] <= longest)
        return F.when(short, F.concat(F.slice(m, F.lit(1), F.greatest(F.size(m) - 2, F.lit(0))), F.array(both))).otherwise(m)

    return F.transform(F.array(merged), tail)[0]


def merge_into_sentences(parts: Column, longest: float) -> Column:
    """For transcripts without words: a segment goes on while the text before doesn't end a sentence;
    spaces where two meet don't count (Q05)."""
    return glue(parts, lambda a, b: ~a["text"].rlike(r"(?U)[.!?…:]\s*$") & (b["end"] - a["start"] <= longest), trim=True)


def fit(start: np.ndarray, end: np.ndarray, soft: np.ndarray, c: Segmentation) -> list[tuple[int, int]]:
    """Ranges of a sentence's words: it is cut where a pause or soft mark is best, until its parts fit;
    a part that has no valid cut stays long (Q08, A10)."""
    open_, out = [(0, len(start))], []
    while open_:
        lo, hi = open_.pop()
        length = end[hi - 1] - start[lo]
        if length <= c.max_seconds or hi - lo < 2:
            out.append((lo, hi))
            continue
        left, right = end[lo : hi - 1] - start[lo], end[hi - 1] - start[lo + 1 : hi]
        pause = np.maximum(start[lo + 1 : hi] - end[lo : hi - 1], 0.0)
        score = pause + c.soft_bonus * soft[lo : hi - 1] - c.balance * np.abs(left - right) / max(length, 1e-6)
        score[np.minimum(left, right) < c.min_seconds / 2] = -np.inf
        at = lo + 1 + int(score.argmax())
        if np.isneginf(score.max()):
            out.append((lo, hi))
        else:
            open_ += [(at, hi), (lo, at)]
    return out


def packed(parts: list[tuple[int, int]], start: np.ndarray, end: np.ndarray, c: Segmentation) -> list[tuple[int, int]]:
    """Neighbouring ranges joined up to the first that would make them too long (Q06)."""
    first, last, at, out = np.array([p[0] for p in parts]), np.array([p[1] for p in parts]), 0, []
    while at < len(parts):
        over = np.flatnonzero(end[last[at:] - 1] - start[first[at]] > c.max_seconds)
        n = max(1, int(over[0])) if len(over) else len(parts) - at
        out.append((int(first[at]), int(last[at + n - 1])))
        at += n
    return out


def segments(words: DataFrame, c: Segmentation = Segmentation(), keys=KEY) -> DataFrame:
    """(keys, ord, id, start, end, text) from words(keys, pos, text, start, end): sentences, cut and
    packed to the longest duration, short ones merged, numbered seg-001 and so on (Q11, F22, W12)."""
    tagged = sentence_ids(words, keys)
    kinds = {f.name: f.dataType.simpleString() for f in tagged.schema if f.name in keys}
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", sentence int, part int, text string, start double, end double"

    words_of = F.array_sort(F.collect_list(F.struct("pos", "text", "start", "end"))).alias("ws")
    sentences = tagged.groupBy(*keys, "sentence").agg(words_of)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for own, sentence, ws in zip(f[list(keys)].to_dict("records"), f.sentence, f.ws):
                text, start, end = [w["text"] for w in ws], np.array([w["start"] for w in ws], float), np.array([w["end"] for w in ws], float)
                soft = np.array([t.endswith(SOFT) for t in text])
                for i, (lo, hi) in enumerate(packed(fit(start, end, soft, c), start, end, c)):
                    rows.append(own | {"sentence": sentence, "part": i, "text": " ".join(text[lo:hi]), "start": start[lo], "end": end[hi - 1]})
            yield pd.DataFrame(rows, columns=[*keys, "sentence", "part", "text", "start", "end"])

    parts = sentences.mapInPandas(cut, schema)
    item = F.struct("sentence", "part", F.struct("text", "start", "end").alias("p"))
    ordered = parts.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["p"]).alias("ps"))
    out = ordered.select(*keys, F.posexplode(merge_short(F.col("ps"), c.min_seconds, c.max_seconds)).alias("_i", "p"))
    return out.select(*keys, F.col("_i").cast("long").alias("ord"), F.format_string("seg-%03d", F.col("_i") + 1).alias("id"), "p.start", F.greatest("p.end", F.col("p.start") + 0.05).alias("end"), "p.text")


def split_transcript(transcript: DataFrame, c: Segmentation = Segmentation(), keys=KEY) -> DataFrame:
    """Segments from words; for videos in which any segment lacks words, from whole segments (Q11)."""
    lacking = transcript.groupBy(*keys).agg(F.max((F.coalesce(F.size("words"), F.lit(0)) <= 0).cast("int")).alias("_lacks"))
    met = transcript.join(lacking, list(keys))
    item = F.struct("start", "ord", F.struct(F.col("text_fr").alias("text"), "start", "end").alias("p"))
    whole = met.where("_lacks = 1").groupBy(*keys).agg(merge_into_sentences(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["p"]), c.max_seconds).alias("ps"))
    whole = whole.select(*keys, F.posexplode("ps").alias("_i", "p")).select(*keys, F.col("_i").cast("long").alias("ord"), F.format_string("seg-%03d", F.col("_i") + 1).alias("id"), "p.start", "p.end", "p.text")
    return segments(word_table(met.where("_lacks = 0"), keys), c, keys).unionByName(whole)


def register_udtfs(spark: SparkSession, c: Segmentation = Segmentation()) -> None:
    """cut_sentences for SQL, as SELECT * FROM cut_sentences(TABLE(words) PARTITION BY video_id ORDER BY pos): the rows
    of `segments`, a partition at a time. All columns beside pos, text, start and end are keys. No more than a
    sentence and two parts are held (Q08, Q11; §2.16)."""

    class CutSentences:
        @staticmethod
        def analyze(words: AnalyzeArgument) -> AnalyzeResult:
            lacking = {"pos", "text", "start", "end"} - set(words.dataType.fieldNames()) if words.isTable else {"a table"}
            if lacking:
                raise ValueError(f"cut_sentences lacks {sorted(lacking)}")
            own = [f for f in words.dataType.fields if f.name not in ("pos", "text", "start", "end")]
            out = StructType(own).add("ord", "long").add("id", "string").add("start", "double").add("end", "double").add("text", "string")
            return AnalyzeResult(out)

        def __init__(self):
            self.sentence, self.own, self.done, self.run, self.n = [], (), None, None, 0

        def numbered(self, part):
            text, start, end = part
            self.n += 1
            return (*self.own, self.n - 1, f"seg-{self.n:03d}", start, max(end, start + 0.05), text)

        def cut(self):
            ws, self.sentence = self.sentence, []
            start, end = np.array([w["start"] for w in ws], float), np.array([w["end"] for w in ws], float)
            soft = np.array([w["text"].endswith(SOFT) for w in ws])
            for lo, hi in packed(fit(start, end, soft, c), start, end, c):
                part, run = (" ".join(w["text"] for w in ws[lo:hi]), float(start[lo]), float(end[hi - 1])), self.run
                if run and run[2] - run[1] < c.min_seconds and part[2] - run[1] <= c.max_seconds:
                    self.run = (f"{run[0]} {part[0]}", run[1], part[2])
                    continue
                if self.done:
                    yield self.numbered(self.done)
                self.done, self.run = run, part

        def eval(self, words: Row):
            if not self.own:
                self.own = tuple(v for k, v in words.asDict(False).items() if k not in ("pos", "text", "start", "end"))
            self.sentence.append(words)
            if words["text"].endswith(STRONG):
                yield from self.cut()

        def terminate(self):
            if self.sentence:
                yield from self.cut()
            a, b = self.done, self.run
            if a and b[2] - b[1] < c.min_seconds and b[2] - a[1] <= c.max_seconds:
                a, b = None, (f"{a[0]} {b[0]}", a[1], b[2])
            for part in (a, b):
                if part:
                    yield self.numbered(part)

    spark.udtf.register("cut_sentences", udtf(CutSentences))
