"""Thresholds, as frozen values on the driver; they enter plans as literals, never as a join."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class Inspection:
    thumbnail_interval: float = 2.0


@dataclass(frozen=True)
class Crop:
    top: str = "auto"
    max_fraction: float = 0.25
    anchor_color: str = "354a5f"
    anchor_tolerance: int = 24
    anchor_coverage: float = 0.6
    anchor_min_rows: int = 6
    anchor_min_frames: float = 0.5
    run_rows: int = 20
    sample_fps: float = 1.0
    sample_frames: int = 120


@dataclass(frozen=True)
class ScreenText:
    fps: float = 2.0
    min_confidence: float = 0.6
    min_length: int = 2
    pixel_delta: int = 25
    change_ratio: float = 0.0005
    max_frames: int = 200
    merge_iou: float = 0.6
    max_gap: float = 1.0


@dataclass(frozen=True)
class Segmentation:
    max_seconds: float = 14.0
    min_seconds: float = 2.5
    soft_bonus: float = 0.6
    balance: float = 0.05


@dataclass(frozen=True)
class Retiming:
    max_speed: float = 1.08
    max_slack: float = 0.8
    min_shot: float = 1.2
    review_ratio: float = 1.2


@dataclass(frozen=True)
class Subtitles:
    max_chars: int = 42
    max_lines: int = 2
    min_fill: float = 0.5


@dataclass(frozen=True)
class Cursor:
    fps: float = 8.0
    pixel_delta: int = 25
    min_area: float = 0.00002
    max_area: float = 0.002
    tolerance: float = 0.01
    hold: float = 2.0


@dataclass(frozen=True)
class Hover:
    max_hold: float = 6.0
    step: float = 0.125
    distance: float = 0.012
    cell: float = 0.05  # of the grid that finds elements near the pointer
    max_area: float = 0.05
    max_width: float = 0.22
    max_chars: int = 30
    min_seconds: float = 0.35
    join_seconds: float = 0.5
    tail: float = 0.4
    padding: float = 0.004
    contiguous: float = 2.5  # of a sample's length


@dataclass(frozen=True)
class Matching:
    min_score: float = 0.75
    ambiguity: float = 0.1
    cursor_distance: float = 0.02
    same_control: float = 0.015
    min_visible: float = 0.5
    min_area: float = 0.0002
    max_area: float = 0.25
    time_margin: float = 1.0
    max_rivals: int = 4


@dataclass(frozen=True)
class Overlays:
    fade: float = 0.25
    steps: int = 4
    line_width: int = 4


@dataclass(frozen=True)
class Cards:
    intro_seconds: float = 5.0
    outro_seconds: float = 4.0
    fade: float = 0.6
    intro_title: str | None = None
    outro_title: str | None = None


@dataclass(frozen=True)
class Layout:
    width: int = 1920
    height: int = 1080
    top: int = 64
    min_bottom: int = 110
    padding: int = 32
    subtitle_size: int = 40
    chapter_seconds: float = 35.0
    max_chapters: int = 6
    title_chars: int = 32
    progress: int = 4


@dataclass(frozen=True)
class Checks:
    condensed_ratio: float = 0.4
    condensed_words: int = 12
    shingle: int = 6
    av_gap: float = 0.2
    quiet_db: float = -50.0
    clip_db: float = -0.1


@dataclass(frozen=True)
class Config:
    inspection: Inspection = field(default_factory=Inspection)
    crop: Crop = field(default_factory=Crop)
    screen_text: ScreenText = field(default_factory=ScreenText)
    segmentation: Segmentation = field(default_factory=Segmentation)
    retiming: Retiming = field(default_factory=Retiming)
    subtitles: Subtitles = field(default_factory=Subtitles)
    cursor: Cursor = field(default_factory=Cursor)
    hover: Hover = field(default_factory=Hover)
    matching: Matching = field(default_factory=Matching)
    overlays: Overlays = field(default_factory=Overlays)
    cards: Cards = field(default_factory=Cards)
    layout: Layout = field(default_factory=Layout)
    checks: Checks = field(default_factory=Checks)


def load_config(path: str | Path) -> Config:
    """From YAML; a missing file, an unknown section or an unknown field raises."""
    import yaml

    raw = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    kinds = {f.name: f.default_factory for f in dataclasses.fields(Config)}
    if unknown := set(raw) - set(kinds):
        raise ValueError(f"unknown sections: {sorted(unknown)}")
    return Config(**{name: kinds[name](**(values or {})) for name, values in raw.items()})


def hardware_tier(vram_gb: float) -> str:
    """A profile by the graphics memory: none, under 12 GB, more."""
    return "cpu-16gb" if vram_gb <= 0 else "gpu-8vram" if vram_gb < 12 else "gpu-12vram-plus"
