"""The choice of frames by their pixels, against the fold it stands for."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.config import ScreenText
from tidemark.operators import frames


def picture(value: int, changed: float = 0.0) -> bytes:
    img = np.full((20, 50), value, dtype=np.uint8)
    img[: round(changed * 20)] = 255
    return img.tobytes()


def fold(pictures, c):
    """One threshold after the other, one frame after the other."""
    t = c.change_ratio
    while True:
        last, kept = None, []
        for i, p in pictures:
            p = np.frombuffer(p, np.uint8).astype(int)
            if last is None or len(p) != len(last) or np.mean(np.abs(p - last) > c.pixel_delta) >= t:
                last, kept = p, [*kept, i]
        if len(kept) <= c.max_frames or t >= 1.0:
            return t, kept[: c.max_frames]
        t *= 2


def chosen(spark, videos: dict, c: ScreenText, block: int):
    rows = [(v, i, bytearray(p)) for v, ps in videos.items() for i, p in ps]
    df = spark.createDataFrame(rows, "video_id string, frame int, pixels binary")
    return {r.video_id: (r.threshold, r.kept) for r in frames.choose(df, c, block=block).collect()}


def test_frames_that_change(spark):
    some = lambda *ps: list(enumerate(ps))
    videos = {
        "changes": some(picture(0), picture(0), picture(0, 0.5), picture(0, 0.5), picture(0, 0.9)),
        "still": some(*[picture(0)] * 5),
        "slow": some(*[picture(0, f / 100) for f in range(0, 40, 4)]),
    }
    c = ScreenText(change_ratio=0.05, max_frames=100)
    got = chosen(spark, videos, c, 2)
    assert got["changes"] == (0.05, [0, 2, 4]) and got["still"] == (0.05, [0])
    assert len(chosen(spark, videos, ScreenText(change_ratio=0.1), 3)["slow"][1]) > 1
    lively = {"lively": some(*[picture(0, f % 2 * 0.9) for f in range(60)]), "calm": some(picture(0), picture(0, 0.5))}
    got = chosen(spark, lively, ScreenText(change_ratio=0.001, max_frames=10), 8)
    assert len(got["lively"][1]) <= 10 and got["lively"][0] > 0.001
    assert got["calm"] == (0.001, [0, 1])


@pytest.mark.parametrize("block", [1, 4, 1000])
def test_blocks_choose_as_one_fold(spark, block):
    """Long stretches without change, slow drifts and noise: blocks begin with wrong guesses."""
    rng = np.random.default_rng(block)
    videos = {}
    for v in range(6):
        state, ps = rng.integers(0, 256, 64), []
        for i in range(60):
            if rng.random() < (0.03, 0.1, 0.3, 0.9, 0.0, 1.0)[v]:
                state = np.where(rng.random(64) < (0.5, 0.1, 0.05, 0.3, 0, 0.02)[v], rng.integers(0, 256, 64), state)
            ps.append((i * (1 + v % 2), np.clip(state + rng.integers(-3, 4, 64), 0, 255).astype(np.uint8).tobytes()))
        videos[f"v{v}"] = ps
    for c in (ScreenText(change_ratio=0.06, max_frames=200), ScreenText(change_ratio=0.02, max_frames=8)):
        assert chosen(spark, videos, c, block) == {v: fold(ps, c) for v, ps in videos.items()}


def test_odd_frames(spark):
    videos = {"sizes": [(0, picture(0)), (1, b""), (2, b""), (3, picture(0))]}
    assert chosen(spark, videos, ScreenText(), 2)["sizes"][1] == [0, 1, 3]
    assert chosen(spark, {"none": []}, ScreenText(), 2) == {}
    packed = spark.range(1).select(frames.pack(F.array(F.lit(0), F.lit(7), F.lit(255))))
    assert bytes(packed.first()[0]) == b"\x00\x07\xff"
