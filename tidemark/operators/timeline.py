"""Retiming, pieces, chapters and windows of an edited timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Cards, Config, Layout, Overlays, Retiming
from ..functions.geometry import resolve_window
from .temporal import KEY, exclusive_sum


def plan_shot(d: Column, t: Column, c: Retiming = Retiming()) -> Column:
    """(planned, speed, outcome, needs_review) of a shot of d seconds with t seconds of audio."""
    ratio = t / d
    slack = F.least(d, F.greatest(t + c.max_slack, F.lit(c.min_shot)))
    long_ = t / c.max_speed
    out = lambda planned, speed, name, review: F.struct(planned.alias("planned"), speed.alias("speed"), F.lit(name).alias("outcome"), review.alias("needs_review"))
    one, no = F.lit(1.0), F.lit(False)
    return (
        F.when((t <= d) & (d - t <= c.max_slack), out(d, one, "kept", no))
        .when(t <= d, out(slack, one, "shortened", no))
        .when(ratio <= c.max_speed, out(d, F.round(ratio, 4), "sped_up", no))
        .otherwise(out(long_, F.lit(c.max_speed), "extended", long_ / d > c.review_ratio))
    )


def retime(decisions: DataFrame, narration: DataFrame, c: Retiming = Retiming(), keys=KEY, length: Column | None = None) -> DataFrame:
    """The timeline: each decision with narration, moved by all changes before it (J07, W02). A shot is as
    long as its ends are apart; length gives it where ends were made by adding lengths up, whose rounding may
    move a shot across a limit."""
    said = narration.select(*keys, F.col("segment_id").alias("id"), F.col("duration").alias("narration_duration"))
    pause = (F.col("narration.pause_before_ms") + F.col("narration.pause_after_ms")) / 1000.0
    met = decisions.join(said, [*keys, "id"]).withColumn("d", F.col("source_end") - F.col("source_start") if length is None else length)
    met = met.withColumn("plan", plan_shot(F.col("d"), F.col("narration_duration") + pause, c))
    shift = exclusive_sum(F.col("plan.planned") - F.col("d"), keys, "source_start", "ord")
    start = F.col("source_start") + shift
    return met.select(
        *keys, "ord", "id", "source_start", "source_end", start.alias("new_start"), (start + F.col("plan.planned")).alias("new_end"), "narration_duration",
        F.col("plan.speed").alias("audio_speed_factor"), (F.col("plan.outcome") == "extended").alias("extended"), F.col("plan.needs_review").alias("needs_review"), F.col("plan.outcome").alias("outcome"),
    )


def retime_warnings(decisions: DataFrame, narration: DataFrame, timeline: DataFrame, keys=KEY) -> DataFrame:
    """(keys, id, code): decisions without narration, and shots that got shorter or longer."""
    said = narration.select(*keys, F.col("segment_id").alias("id"))
    none = decisions.join(said, [*keys, "id"], "left_anti").select(*keys, "id", F.lit("no_narration").alias("code"))
    return none.unionByName(timeline.where("outcome IN ('shortened', 'extended')").select(*keys, "id", F.col("outcome").alias("code")))


def pieces(decisions: DataFrame, timeline: DataFrame, source_duration: DataFrame, keys=KEY) -> DataFrame:
    """Gaps and segments in the order of the source, with extensions (W05, E02). A gap lies before a
    segment that starts after the previous one's source end, and after the last. `at` is a piece's
    start in the output (W03)."""
    planned = timeline.select(*keys, "id", (F.col("new_end") - F.col("new_start")).alias("planned"))
    w = W.partitionBy(*keys).orderBy("source_start", "ord")
    seg = decisions.join(planned, [*keys, "id"]).withColumn("cursor", F.lag("source_end", 1, 0.0).over(w))
    d = F.col("source_end") - F.col("source_start")
    none = F.lit(None).cast("string")
    gaps = seg.where("source_start > cursor").select(*keys, F.lit("gap").alias("kind"), F.col("cursor").alias("start"), F.col("source_start").alias("end"), F.lit(0.0).alias("extension"), none.alias("id"))
    shots = seg.select(*keys, F.lit("segment").alias("kind"), F.col("source_start").alias("start"), (F.col("source_start") + F.least("planned", d)).alias("end"), F.greatest(F.lit(0.0), F.col("planned") - d).alias("extension"), "id")
    ends = seg.groupBy(*keys).agg(F.max_by("source_end", F.struct("source_start", "ord")).alias("cursor"))
    tail = source_duration.join(ends, list(keys), "left").withColumn("cursor", F.coalesce("cursor", F.lit(0.0))).where("duration > cursor")
    tail = tail.select(*keys, F.lit("gap").alias("kind"), F.col("cursor").alias("start"), F.col("duration").alias("end"), F.lit(0.0).alias("extension"), none.alias("id"))
    every = gaps.unionByName(shots).unionByName(tail)
    return every.withColumn("ord", F.row_number().over(W.partitionBy(*keys).orderBy("start", "kind", "end", "extension", "id"))).withColumn("at", exclusive_sum(F.col("end") - F.col("start") + F.col("extension"), keys, "ord"))


def total_duration(plan: DataFrame, keys=KEY) -> DataFrame:
    return plan.groupBy(*keys).agg(F.sum(F.col("end") - F.col("start") + F.col("extension")).alias("total"))


def duration_slices(rows: DataFrame, length: Column, order, c: Layout = Layout(), keys=KEY) -> DataFrame:
    """rows with `slice`, numbered from 0 without holes: parts of about equal duration (W04). Videos
    that make fewer than two parts, or have fewer than two rows a part, have none."""
    w = W.partitionBy(*keys)
    s = rows.withColumns({"_len": length}).withColumns({"_total": F.sum("_len").over(w), "_rows": F.count(F.lit(1)).over(w), "_before": exclusive_sum(F.col("_len"), keys, *order)})
    s = s.withColumn("_n", F.least(F.lit(c.max_chapters), F.rint(F.col("_total") / c.chapter_seconds).cast("int"))).where("_n >= 2 AND _rows >= 2 * _n")
    bucket = F.least(F.col("_n") - 1, F.floor((F.col("_before") + F.col("_len") / 2) / F.col("_total") * F.col("_n")).cast("int"))
    return s.withColumn("_b", bucket).withColumn("slice", F.dense_rank().over(w.orderBy("_b")) - 1).drop("_len", "_total", "_rows", "_before", "_n", "_b")


def assemble_chapters(slices: DataFrame, titles: DataFrame, keys=KEY) -> DataFrame:
    """(keys, slice, title) if every slice has a title, nothing otherwise; more titles are dropped."""
    met = slices.select(*keys, "slice").distinct().join(titles, [*keys, "slice"], "left")
    good = F.every(F.coalesce(F.trim("title") != "", F.lit(False))).over(W.partitionBy(*keys))
    return met.withColumn("_good", good).where("_good").drop("_good")


def chapter_windows(chapters: DataFrame, plan: DataFrame, total: DataFrame, keys=KEY) -> DataFrame:
    """(keys, title, start, end, label): chapters in plan order; the first starts at 0, each ends at the
    next one's start; numbered before empty ones are dropped (J11, W06)."""
    at = plan.where("kind = 'segment'").select(*keys, F.col("id").alias("first_segment"), "at")
    w = W.partitionBy(*keys).orderBy("ord")
    met = chapters.join(at, [*keys, "first_segment"]).join(total, list(keys)).withColumn("no", F.row_number().over(w))
    met = met.withColumn("start", F.when(F.col("no") == 1, 0.0).otherwise(F.col("at")))
    met = met.withColumns({"end": F.coalesce(F.lead("start").over(w), "total"), "of": F.count(F.lit(1)).over(W.partitionBy(*keys))})
    return met.where("end > start").select(*keys, "title", "start", "end", F.concat_ws("/", F.col("no").cast("string"), F.col("of").cast("string")).alias("label"))


def progress_ticks(windows: DataFrame) -> DataFrame:
    """One for each chapter after the first."""
    return windows.where("start > 0").select(*[c for c in windows.columns if c not in ("end",)])


def apply_matches(decisions: DataFrame, accepted: DataFrame, keys=KEY) -> DataFrame:
    """Decisions with the action of their accepted match; others as they were."""
    new = accepted.where("verdict = 'accepted'").select(*keys, F.col("segment_id").alias("id"), F.col("action").alias("_new"))
    return decisions.join(new, [*keys, "id"], "left").withColumn("visual_action", F.coalesce("_new", "visual_action")).drop("_new")


def echo_windows(plan: DataFrame, decisions: DataFrame, keys=KEY) -> DataFrame:
    """When each action shows in the output; freezes don't count and bad windows are skipped."""
    act = decisions.where("visual_action IS NOT NULL").select(*keys, "id", "visual_action")
    met = plan.where("kind = 'segment'").join(act, [*keys, "id"])
    win = resolve_window(F.col("visual_action.start_offset"), F.col("visual_action.end_offset"), F.col("end") - F.col("start"), strict=False)
    return met.withColumn("w", win).where("w IS NOT NULL").select(*keys, "id", "visual_action", (F.col("at") + F.col("w.start")).alias("shown_from"), (F.col("at") + F.col("w.end")).alias("shown_to"))


def fade_steps(windows: DataFrame, start: str = "start", end: str = "end", c: Overlays = Overlays()) -> DataFrame:
    """A row for each step of alpha: k - 1 rising, the core, k - 1 falling; one where nothing fades."""
    k, s, e = c.steps, F.col(start), F.col(end)
    step = lambda alpha, a, b: F.struct(F.lit(float(alpha)).alias("alpha"), a.alias("from"), b.alias("to"))
    if c.fade <= 0 or k < 2:
        return windows.withColumn("step", F.explode(F.array(step(1.0, s, e)))).select("*", "step.*").drop("step")
    part = F.least(F.lit(c.fade), (e - s) / 2) / (k - 1)
    rows = [step(i / k, s + part * (i - 1), s + part * i) for i in range(1, k)] + [step(1.0, s + part * (k - 1), e - part * (k - 1))] + [step(i / k, e - part * i, e - part * (i - 1)) for i in range(k - 1, 0, -1)]
    return windows.withColumn("step", F.explode(F.array(*rows))).select("*", "step.*").drop("step")


def render_plan(plan: DataFrame, timeline: DataFrame, narration: DataFrame, keys=KEY) -> DataFrame:
    """What a renderer needs of each piece. Every retimed segment must have narration."""
    said = narration.select(*keys, F.col("segment_id").alias("id"), "audio_file")
    times = timeline.select(*keys, "id", "new_start", "audio_speed_factor").join(said, [*keys, "id"], "left")
    times = times.withColumn("audio_file", F.coalesce("audio_file", F.raise_error(F.concat(F.lit("no narration: "), F.col("id")))))
    return plan.join(times, [*keys, "id"], "left")


def join_fragments(df: DataFrame, fragment: str, order: str, keys=KEY, sep: str = ";") -> DataFrame:
    """A graph's text from its fragments, in order."""
    return df.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, fragment))), lambda x: x[fragment]), sep).alias("script"))


def cards(c: Config, generated_title: Column) -> Column:
    """Titles of the intro and outro cards; null: no card."""
    intro = F.coalesce(F.nullif(F.lit(c.cards.intro_title).cast("string"), F.lit("")), F.nullif(generated_title, F.lit("")))
    return F.struct(intro.alias("intro"), F.coalesce(F.nullif(F.lit(c.cards.outro_title).cast("string"), F.lit("")), intro).alias("outro"))


def excerpt(rows: DataFrame, text: str, order: str, most_rows: int = 8, most_chars: int = 1500, keys=KEY) -> DataFrame:
    """(keys, excerpt): the first rows' texts with spaces between, cut after so many characters; a null text is
    empty (T05). Rows beyond, and what is beyond of a row, are dropped before texts are gathered; a row with no room
    left may still give its space."""
    w = W.partitionBy(*keys).orderBy(order)
    first = rows.withColumn("_no", F.row_number().over(w)).where(F.col("_no") <= most_rows).withColumn("_t", F.coalesce(F.substring(text, 1, most_chars), F.lit("")))
    room = F.lit(most_chars) - exclusive_sum(F.char_length("_t") + 1, keys, "_no")
    first = first.withColumn("_room", room.cast("int")).where("_room >= 0 OR _no = 1").withColumn("_t", F.expr("left(_t, _room)"))
    return join_fragments(first, "_t", "_no", keys, " ").select(*keys, F.substring("script", 1, most_chars).alias("excerpt"))


def title_digest(slices: DataFrame, text: str, order: str, most_chars: int = 160, keys=KEY) -> DataFrame:
    """(keys, digest): what titles are made from: each slice's number and the beginning of its texts, a line each;
    a null text is an empty line (T05)."""
    line = slices.select(*keys, "slice", F.col(order).alias("_o"), F.coalesce(F.substring(text, 1, most_chars), F.lit("")).alias("_t"))
    part = join_fragments(line, "_t", "_o", [*keys, "slice"], "\n").select(*keys, "slice", F.concat(F.format_string("Part %d:\n", F.col("slice") + 1), "script").alias("_p"))
    return join_fragments(part, "_p", "slice", keys, "\n\n").withColumnRenamed("script", "digest")


def with_cards(plan: DataFrame, titles: DataFrame, c: Cards = Cards(), keys=KEY) -> DataFrame:
    """The pieces with a card before and one after, of kind `intro` and `outro` and with a `title`, where
    titles(keys, card<intro, outro>) has one; everything after the first is later by its length (E05). Pieces are
    numbered anew; a video without pieces has no cards."""
    head = F.when(F.col("_card.intro").isNotNull(), c.intro_seconds).otherwise(0.0)
    met = plan.join(titles.select(*keys, F.col("card").alias("_card")), list(keys), "left").withColumn("at", F.col("at") + head)
    none = F.lit(None).cast("string")
    body = met.select(*keys, "kind", "start", "end", "extension", "id", (F.col("ord") + F.col("_card.intro").isNotNull().cast("int")).alias("ord"), "at", none.alias("title"))
    last = met.groupBy(*keys).agg(F.max(F.col("at") + F.col("end") - F.col("start") + F.col("extension")).alias("_end"), F.max("ord").alias("_last"), F.first("_card").alias("_card"))

    def card(kind: str, seconds: float, no: Column, at: Column) -> DataFrame:
        title = F.col(f"_card.{kind}")
        return last.where(title.isNotNull()).select(*keys, F.lit(kind).alias("kind"), F.lit(0.0).alias("start"), F.lit(seconds).alias("end"), F.lit(0.0).alias("extension"), none.alias("id"), no.alias("ord"), at.alias("at"), title.alias("title"))

    after = F.col("_last") + 1 + F.col("_card.intro").isNotNull().cast("int")
    return body.unionByName(card("intro", c.intro_seconds, F.lit(1), F.lit(0.0))).unionByName(card("outro", c.outro_seconds, after, F.col("_end")))
