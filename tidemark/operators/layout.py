"""Where the picture, the bands, the progress bar and the subtitles go."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Layout
from ..functions.geometry import even


def compute_layout(w: Column, h: Column, c: Layout = Layout()) -> Column:
    """(width, height, y, top, bottom): fitted into the canvas, enlarged only while both bands fit;
    without room for both the top band goes first (P16)."""
    fit = F.least(F.lit(float(c.width)) / w, F.lit(float(c.height)) / h)
    ratio = F.when(fit < 1, fit).otherwise(F.least(fit, F.greatest(F.lit(1.0), F.lit(float(c.height - c.top - c.min_bottom)) / h)))
    same = F.abs(ratio - 1) < 1e-9
    width, height = F.when(same, w).otherwise(even(w * ratio)), F.when(same, h).otherwise(even(h * ratio))
    slack = F.lit(c.height) - height
    both, lower = slack >= c.top + c.min_bottom, slack >= c.min_bottom
    return F.struct(
        width.cast("int").alias("width"), height.cast("int").alias("height"), F.when(both, F.lit(c.top)).when(lower, 0).otherwise(even(slack / 2)).cast("int").alias("y"),
        F.when(both, F.lit(c.top)).otherwise(0).alias("top"), F.when(both, slack - c.top).when(lower, slack).otherwise(0).cast("int").alias("bottom"),
    )


def progress_y(layout: Column, c: Layout = Layout()) -> Column:
    """Under the top band, else along the lower edge of the bottom band; null without bands."""
    return F.when(layout["top"] > 0, layout["top"] - c.progress).when(layout["bottom"] > 0, F.lit(c.height - c.progress))


def subtitle_font_size(layout: Column, lines: int = 2, c: Layout = Layout()) -> Column:
    """Smaller where 85 % of the band can't hold the lines at 1.2 of the size each; 12 at least."""
    fitting = F.floor(layout["bottom"] * 0.85 / (lines * 1.2)).cast("int")
    size = F.when(layout["bottom"] > 0, F.least(F.lit(c.subtitle_size), fitting)).otherwise(F.lit(c.subtitle_size))
    return F.greatest(F.lit(12), size)
