"""Hooks for models (X01 to X06): schemas and the way rows reach them; no model is shipped.

A factory makes the model once for each task; it is called with batches, so executors lost
meanwhile only repeat their own batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..schemas import SCHEMAS

#: What each hook returns.
RESULTS = {
    "speech_to_text": SCHEMAS["transcript"],
    "translate": "video_id string, ord long, id string, text_en string, kind string, target string, terms array<string>",
    "titles": "video_id string, slice int, title string",
    "ocr": SCHEMAS["detections"],
    "text_to_speech": SCHEMAS["narration"],
}


def per_batch(df: DataFrame, factory: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], kind: str) -> DataFrame:
    """Rows independent of each other: speech, OCR, voice."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for f in frames:
            yield model(f)

    return df.mapInPandas(run, RESULTS[kind])


def in_order(df: DataFrame, factory: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], kind: str, keys=("video_id",), order: str = "ord") -> DataFrame:
    """A video's rows together and in order: translation, whose review reads the row before."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        return factory()(g.sort_values(order))

    return df.groupBy(*keys).applyInPandas(run, RESULTS[kind])


def with_retry(answer: Callable[[str], dict | None], issues: Callable[[dict], list[str]], prompt: str, tries: int = 3) -> dict | None:
    """The first answer that parses, within so many tries; if it has issues, one more is asked for and
    kept if it has strictly fewer (X03, F21)."""
    first = next((a for _ in range(tries) if (a := answer(prompt)) is not None), None)
    if first is None or not (bad := issues(first)):
        return first
    second = answer(prompt + "\n\nIssues:\n" + "\n".join(bad))
    return second if second is not None and len(issues(second)) < len(bad) else first
