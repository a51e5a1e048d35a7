"""Choice of frames by their pixels: those that differ enough from the last one chosen.

The choice is a fold: what is chosen depends on the last frame chosen before. A long video is still not
one task. It is cut into blocks of frames, and each block begins with a guess of the frame that the
block before hands on: the fold over the blocks' first frames alone. All blocks run at once. Then
each block's guess is held against what the one before did hand on; units of 1, 2, 4, ... blocks
that began wrongly run again, from their first wrong block on. A block soon chooses the same frame
whatever it began with, so few runs are needed; after as many rounds as the number of blocks has
binary digits the unit is the whole video, and all is decided as by one fold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..config import ScreenText
from ..storage import kept
from .temporal import KEY


def pack(values: Column) -> Column:
    """An array of grey values, 0 to 255, as bytes."""
    return F.unhex(F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v.cast("int")), 2, "0")), ""))


def changed_share(before: np.ndarray, after: np.ndarray, delta: int) -> float:
    """The share of pixels that differ by more than delta (A08); frames of two sizes differ wholly."""
    if len(before) != len(after) or not len(after):
        return float(len(before) != len(after))
    return float(np.mean(np.abs(before.astype(np.int16) - after) > delta))


def thresholds(c: ScreenText) -> list[float]:
    """The threshold, doubled until it reaches 1 (Q02)."""
    steps = [c.change_ratio]
    while steps[-1] < 1.0:
        steps.append(steps[-1] * 2)
    return steps


class _Fold:
    """The last chosen frame for each threshold; most thresholds share theirs."""

    def __init__(self, steps: list[float], delta: int):
        self.steps, self.delta = steps, delta
        self.last: list[tuple[int, np.ndarray] | None] = [None] * len(steps)

    def step(self, frame: int, pixels: np.ndarray) -> list[int]:
        """The thresholds for which the frame is chosen."""
        shares = {one[0]: changed_share(one[1], pixels, self.delta) for one in {x[0]: x for x in self.last if x}.values()}
        chosen = [i for i, (last, t) in enumerate(zip(self.last, self.steps, strict=True)) if last is None or shares[last[0]] >= t]
        for i in chosen:
            self.last[i] = (frame, pixels)
        return chosen

    def at(self) -> list[int | None]:
        return [x and x[0] for x in self.last]


_BLOCK = "block long, came array<int>, went array<int>, chosen array<array<int>>"


def _run(steps: list[float], delta: int, size: int, keys: list[pa.Field]):
    """Over one unit's rows (keys, frame, uses, pixels), by order: first the frames handed on, with the
    thresholds that use them, then its own frames. A row comes out for each block: what each threshold
    came with, went with, and chose."""
    kind = pa.list_(pa.int32())
    schema = pa.schema([*keys, ("block", pa.int64()), ("came", kind), ("went", kind), ("chosen", pa.list_(kind))])

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, block, came, chosen, own, seen = _Fold(steps, delta), None, None, None, None, -1

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([own | {"block": block, "came": came, "went": fold.at(), "chosen": chosen}], schema)

        for batch in batches:
            own = own or {f.name: batch.column(f.name)[0].as_py() for f in keys}
            for frame, uses, pixels in zip(batch.column("frame").to_pylist(), batch.column("uses").to_pylist(), batch.column("pixels"), strict=True):
                image = np.frombuffer(pixels.as_buffer(), np.uint8) if pixels.is_valid else np.zeros(0, np.uint8)
                if uses is not None:
                    for i in uses:
                        fold.last[i] = (frame, image)
                    continue
                if frame <= seen:
                    raise ValueError("two frames of one number, or frames out of order")
                seen = frame
                if frame // size != block:
                    if block is not None:
                        yield row()
                    block, came, chosen = frame // size, fold.at(), [[] for _ in steps]
                for i in fold.step(frame, image.copy()):
                    chosen[i].append(frame)
        if block is not None:
            yield row()

    return one


def choose(frames: DataFrame, c: ScreenText = ScreenText(), keys=KEY, block: int = 256) -> DataFrame:
    """(keys, threshold, kept) over frames(keys, frame int, pixels binary): the numbers of the frames to
    read, at the first threshold that keeps c.max_frames at most; the last threshold's are cut (Q01,
    Q02, A08). Frames are numbered from 0, with holes if need be; null pixels are a frame of no
    pixels; videos without frames give nothing."""
    own, steps = list(keys), thresholds(c)
    rows = frames.select(*own, F.col("frame").cast("int").alias("frame"), F.lit(None).cast("array<int>").alias("uses"), "pixels")
    number = F.floor(F.col("frame") / block).cast("long")
    fields = [pa.field(k, to_arrow_type(frames.schema[k].dataType)) for k in own]
    schema = ", ".join(f"{k} {frames.schema[k].dataType.simpleString()}" for k in own) + f", {_BLOCK}"

    def run(df: DataFrame, by: list[str]) -> DataFrame:
        ordered = df.repartition(*by).sortWithinPartitions(*by, F.col("uses").isNull(), "frame")
        return ordered.groupBy(*by).applyInArrow(_run(steps, c.pixel_delta, block, fields), schema)

    def run_from(begin: DataFrame, unit: int) -> DataFrame:
        """The units that begin(keys, block, starts) names, from these blocks on."""
        begin = begin.select(*own, F.floor(F.col("block") / unit).cast("long").alias("unit"), F.col("block").alias("from"), "starts")
        mine = rows.withColumn("unit", F.floor(number / unit).cast("long")).join(begin.drop("starts"), [*own, "unit"]).where(number >= F.col("from")).drop("from")
        uses = begin.select(*own, "unit", F.posexplode("starts").alias("i", "frame")).where("frame IS NOT NULL")
        uses = uses.groupBy(*own, "unit", "frame").agg(F.collect_list("i").alias("uses"))
        handed = rows.drop("uses").join(uses, [*own, "frame"])
        return run(mine.unionByName(handed), [*own, "unit"])

    # the guesses: a fold over the first frame of each block
    first = rows.groupBy(*own, number.alias("b")).agg(F.min("frame").alias("frame")).drop("b")
    guessed = run(rows.join(first, [*own, "frame"]), own).select(*own, "block", F.col("came").alias("starts"))
    state, unit = kept(run_from(kept(guessed), 1)), 1
    while True:
        handed_on = state.withColumn("starts", F.lag("went").over(W.partitionBy(*own).orderBy("block")))
        wrong = handed_on.where(F.col("starts").isNotNull() & ~F.col("starts").eqNullSafe(F.col("came")))
        first = F.min(F.struct("block", "starts")).alias("s")
        begin = kept(wrong.groupBy(*own, F.floor(F.col("block") / unit).alias("unit")).agg(first).select(*own, "s.block", "s.starts"))
        if begin.isEmpty():
            break
        again = kept(run_from(begin, unit))
        state = kept(state.join(again.select(*own, "block"), [*own, "block"], "left_anti").unionByName(again))
        unit *= 2
    parts = F.array_sort(F.collect_list(F.struct("block", "chosen")))
    every = state.groupBy(*own).agg(parts.alias("parts"))
    tried = F.transform(F.sequence(F.lit(0), F.lit(len(steps) - 1)), lambda i: F.flatten(F.transform("parts", lambda p: p["chosen"][i])))
    picked = every.select(*own, tried.alias("tried"))
    fits = F.get(F.filter(F.sequence(F.lit(0), F.lit(len(steps) - 1)), lambda i: F.size(F.get(F.col("tried"), i)) <= c.max_frames), F.lit(0))
    at = F.coalesce(fits, F.lit(len(steps) - 1))
    return picked.select(*own, F.get(F.array(*map(F.lit, steps)), at).alias("threshold"), F.slice(F.get(F.col("tried"), at), 1, c.max_frames).alias("kept"))
