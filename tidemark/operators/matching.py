"""What a narrator names, matched with what the screen shows; every refusal has its reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Cursor, Matching, ScreenText
from ..functions.geometry import area, center, display_window, distance, distance_to_box, visible_share
from ..functions.text import identifying_tokens, key_score, match_key, normalize, translate_terms
from .temporal import KEY, overlap_join, range_or_asof


def candidates(decisions: DataFrame, elements: DataFrame, glossary: list[tuple[str, str]], c: Matching = Matching(), keys=KEY) -> DataFrame:
    """Elements that are there near a named segment and fit its label, or its translation."""
    named = decisions.where("ui_reference.kind = 'named_control'").select(*keys, F.col("id").alias("segment_id"), F.col("source_start").alias("start"), F.col("source_end").alias("end"), F.col("ui_reference.label").alias("label"))
    named = named.withColumn("_n", normalize(F.col("label"))).withColumn("_t", translate_terms(F.col("_n"), glossary))
    keys_of = lambda c: F.when(F.col(c).isNotNull(), F.struct(match_key(F.col(c)).alias("key"), identifying_tokens(F.col(c)).alias("tokens")))
    named = named.withColumns({"_n": keys_of("_n"), "_t": keys_of("_t")})
    seen = elements.select(*keys, F.col("id").alias("element_id"), "text", "box", "first_seen", "last_seen", "confidence", "occurrences", match_key(normalize(F.col("text"))).alias("match_key"))
    met = overlap_join(named, seen, 60.0, keys, margin=c.time_margin)
    fits = lambda c: F.when(F.col(c).isNull(), 0.0).otherwise(key_score(F.col(c)["key"], F.col(c)["tokens"], F.col("match_key")))
    score = F.greatest(fits("_n"), fits("_t"))
    met = met.withColumns({"score": score, "visible": visible_share(F.col("first_seen"), F.col("last_seen"), F.col("start"), F.col("end"))})
    return met.where("score > 0").drop("_n", "_t")


def merge_same(cands: DataFrame, c: Matching = Matching(), keys=KEY) -> DataFrame:
    """Candidates of one key whose centres lie by a group's first one are one control."""
    own = [*keys, "segment_id", "match_key"]
    item = F.struct("first_seen", "element_id", center(F.col("box")).alias("at"))
    heads = F.aggregate(
        F.array_sort(F.collect_list(item)), F.array().cast("array<struct<id:string,x:double,y:double>>"),
        lambda acc, i: F.when(F.exists(acc, lambda h: distance(h["x"], h["y"], i["at"]["x"], i["at"]["y"]) <= c.same_control), acc).otherwise(F.concat(acc, F.array(F.struct(i["element_id"].alias("id"), i["at"]["x"].alias("x"), i["at"]["y"].alias("y"))))),
    )
    met = cands.join(cands.groupBy(*own).agg(heads.alias("_heads")), own)
    mine = center(F.col("box"))
    met = met.withColumn("_head", F.get(F.filter("_heads", lambda h: distance(h["x"], h["y"], mine["x"], mine["y"]) <= c.same_control), F.lit(0))["id"])
    best = F.min_by(F.struct("element_id", "text", "box"), F.struct(-F.col("visible"), "first_seen", "element_id"))  # of equals, the first
    out = met.groupBy(*own, "_head", "start", "end", "label").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("occurrences").alias("occurrences"), F.max("confidence").alias("confidence"),
        F.max("score").alias("score"), F.least(F.lit(1.0), F.sum("visible")).alias("visible"), best.alias("_best"),
    )
    return out.select("*", "_best.*").drop("_best", "_head")


def judge(merged: DataFrame, positions: DataFrame, c: Matching = Matching(), keys=KEY) -> DataFrame:
    """One verdict a segment, by the first rule that fails (P17, W15, J14): no candidate, ambiguous,
    too brief, too small or large; accepted otherwise. An ambiguous one names max_rivals rivals at
    most, an accepted one all that it beat, and how far off the pointer was if it asked. The pointer may settle an ambiguity, nothing
    else. positions(keys, segment_id, positions)."""
    own = [*keys, "segment_id"]
    w = W.partitionBy(*own)
    met = merged.join(positions, own, "left")
    good = F.col("score") >= c.min_score
    met = met.withColumn("_top", F.max(F.when(good, F.col("score"))).over(w)).withColumn("_in", good & (F.col("score") >= F.col("_top") - c.ambiguity))
    met = met.withColumn("_n_in", F.count_if("_in").over(w))
    far = F.array_min(F.transform("positions", lambda p: distance_to_box(p["x"], p["y"], F.col("box"))))
    met = met.withColumn("_dist", F.when(F.col("_in") & (F.col("_n_in") > 1), far))  # nothing else asks for it
    near = F.col("_in") & (F.col("_dist") <= c.cursor_distance) & F.lit(c.cursor_distance > 0)
    met = met.withColumns({"_near": F.coalesce(near, F.lit(False)), "_n_near": F.count_if(F.coalesce(near, F.lit(False))).over(w), "_n_good": F.count_if(good).over(w)})
    settled = (F.col("_n_in") > 1) & (F.col("_n_near") == 1)
    met = met.withColumn("_no", F.row_number().over(w.orderBy(F.when(settled, (~F.col("_near")).cast("int")).otherwise(0), F.desc("score"), F.desc("visible"), "first_seen", "element_id")))
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rivals = F.array_sort(F.collect_list(F.when(F.col("_in") & (F.col("_no") > 1), F.struct("_no", "text"))).over(whole))
    met = met.withColumn("rivals", F.transform(rivals, lambda r: r["text"])).where("_no = 1")
    size = area(F.col("box"))
    code = (
        F.when(F.col("_n_good") == 0, "no_candidate").when((F.col("_n_in") > 1) & ~settled, "ambiguous").when(F.col("visible") < c.min_visible, "too_brief")
        .when(~size.between(c.min_area, c.max_area), "bad_size").otherwise("accepted")
    )
    chosen = ~F.col("reason_code").isin("no_candidate", "ambiguous")
    accepted, code_ = F.col("reason_code") == "accepted", F.col("reason_code")
    none = F.array().cast("array<string>")
    named = F.when(code_ == "ambiguous", F.slice("rivals", 1, c.max_rivals)).when(accepted, F.col("rivals")).otherwise(none)
    evidence = F.when(code_ == "no_candidate", none).when(settled & chosen, F.array(F.lit("ocr"), F.lit("cursor"))).otherwise(F.array(F.lit("ocr")))
    win = display_window(F.col("first_seen"), F.col("last_seen"), F.col("start"), F.col("end"))
    return met.withColumn("reason_code", code).select(
        *own, F.when(accepted, "accepted").otherwise("refused").alias("verdict"), "reason_code", "score", F.when(chosen, F.col("visible")).otherwise(0.0).alias("visible"), "text",
        F.when(chosen, F.col("element_id")).alias("element_id"), named.alias("rivals"), F.when(settled & accepted, F.round("_dist", 4)).alias("cursor_distance"),
        evidence.alias("evidence"), F.when(accepted, win).alias("window"), F.when(accepted, F.col("box")).alias("box"),
    )


def match(decisions: DataFrame, elements: DataFrame, track: DataFrame, glossary: list[tuple[str, str]] = (), c: Matching = Matching(), cursor: Cursor = Cursor(), keys=KEY) -> DataFrame:
    """A verdict for each named segment (M01). Without any candidate: refused, with score and share 0, no
    evidence and no rivals."""
    named = decisions.where("ui_reference.kind = 'named_control'").select(*keys, "id", F.col("source_start").alias("start"), F.col("source_end").alias("end"))
    positions = range_or_asof(named, track, 60.0, c.time_margin, cursor.hold, keys).select(*keys, F.col("id").alias("segment_id"), "positions")
    judged = judge(merge_same(candidates(decisions, elements, list(glossary), c, keys), c, keys), positions, c, keys)
    labels = decisions.where("ui_reference.kind = 'named_control'").select(*keys, F.col("id").alias("segment_id"), F.col("ui_reference.label").alias("label"))
    every = labels.join(judged, [*keys, "segment_id"], "left").fillna({"verdict": "refused", "reason_code": "no_candidate", "score": 0.0, "visible": 0.0})
    nothing = F.array().cast("array<string>")
    return every.withColumns({x: F.coalesce(x, nothing) for x in ("rivals", "evidence")})


def match_counts(verdicts: DataFrame, decisions: DataFrame, keys=KEY) -> DataFrame:
    """Accepted, named, total."""
    total = decisions.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("ui_reference.kind") == "named_control").alias("named"))
    return total.join(verdicts.groupBy(*keys).agg(F.count_if(F.col("verdict") == "accepted").alias("accepted")), list(keys), "left").fillna(0, ["accepted"])


def review_rows(verdicts: DataFrame, decisions: DataFrame, positions: DataFrame, width: int, height: int, c: ScreenText = ScreenText(), keys=KEY) -> DataFrame:
    """(keys, segment_id, frame, x0, y0, x1, y1, points, caption): what a reviewer sees of each accepted match with
    a box: the sampled frame nearest to the segment's middle, the box in pixels and four around, the pointer's places
    where they decided, else none, and a caption (K11). positions(keys, id, positions)."""
    middle = (F.col("source_start") + F.col("source_end")) / 2
    shown = decisions.select(*keys, F.col("id").alias("segment_id"), middle.alias("_middle"))
    seen = positions.select(*keys, F.col("id").alias("segment_id"), "positions")
    met = verdicts.where("verdict = 'accepted' AND box IS NOT NULL").join(shown, [*keys, "segment_id"]).join(seen, [*keys, "segment_id"], "left")
    pixel = lambda share, size: (share * size).cast("int")
    b = F.col("box")
    point = lambda p: F.struct(pixel(p["x"], width).alias("x"), pixel(p["y"], height).alias("y"))
    points = F.when(F.array_contains("evidence", "cursor"), F.transform("positions", point))
    caption = F.format_string("%s  \"%s\" -> \"%s\"  score %.2f  visible %.0f%%  [%s]", "segment_id", "label", "text", "score", F.col("visible") * 100, F.array_join("evidence", "+"))
    return met.select(
        *keys, "segment_id", F.format_string("sample_%05d.jpg", F.rint(F.col("_middle") * c.fps).cast("int") + 1).alias("frame"),
        (pixel(b["x"], width) - 4).alias("x0"), (pixel(b["y"], height) - 4).alias("y0"),
        (pixel(b["x"] + b["width"], width) + 4).alias("x1"), (pixel(b["y"] + b["height"], height) + 4).alias("y1"),
        F.coalesce(points, F.array().cast("array<struct<x:int,y:int>>")).alias("points"), caption.alias("caption"),
    )
