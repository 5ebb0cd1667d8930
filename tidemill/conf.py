"""The study's settings, and where a run reads and writes."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace
from datetime import date, timedelta


@dataclass(frozen=True)
class Study:
    """What the rules depend on."""

    #: The study's dates, limits, words and patterns.
    start: date = date(2026, 1, 8)
    days: int = 28
    offset: str = "-05:00"
    minutes_per_day: int = 1440
    complete_pct: float = 99.9
    stuck_minutes: int = 60
    end_tolerance_s: int = 60
    stage_tolerance_min: float = 0.5
    heart_rate_range: tuple[float, float] = (20, 250)
    steps_sentinels: tuple[int, ...] = (-1, 1_000_000)
    steps_most: int = 600
    unit_columns: tuple[str, ...] = ("unit", "_unit", "units", "_units")
    unit_divisors: dict[str, int] = field(default_factory=lambda: {"steps_per_minute": 1, "steps": 1, "steps_per_hour": 60})
    documented: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "steps": ("timestamp", "steps", "participant_id"),
            "heart_rate": ("timestamp", "heart_rate_bpm", "participant_id"),
        }
    )
    stages: tuple[str, ...] = ("light", "deep", "rem", "awake")
    awake: tuple[str, ...] = ("awake",)
    stage_order: str = "light->deep->rem->light->awake"
    score_ranges: dict[str, tuple[int, int]] = field(
        default_factory=lambda: {"fatigue_score": (1, 5), "stress_score": (1, 5), "readiness_score": (0, 10), "sleep_quality_score": (1, 5)}
    )
    participant_pattern: str = r"^P\d{3}$"
    device_pattern: str = r"^FBT-\d{4}-[0-9A-F]{8}$"
    firmware_pattern: str = r"fw(\d+\.\d+\.\d+)"

    @property
    def end(self) -> date:
        return self.start + timedelta(days=self.days - 1)


@dataclass(frozen=True)
class Settings:
    """One run: the source and target folders, as any Hadoop path, and how it goes about them."""

    source: str
    target: str
    study: Study = field(default_factory=Study)
    compression: str = "zstd"
    participants: tuple[str, ...] | None = None

    @property
    def remote(self) -> bool:
        return "://" in self.target and not self.target.startswith("file:")

    @property
    def mode(self) -> str:
        near = "remote" if "://" in self.source and not self.source.startswith("file:") else "local"
        return f"{near} -> {'remote' if self.remote else 'local'}"


def load_settings(source: str | None = None, target: str | None = None, online: bool = False, env: dict[str, str] | None = None, **more) -> Settings:
    """Arguments first, then the environment, then defaults."""
    env = dict(os.environ if env is None else env)
    kind = "REMOTE" if online else "LOCAL"
    get = lambda name, default: (env.get(name) or "").strip().strip("'\"") or default
    source = source or get(f"SOURCE_URI_{kind}", None if online else "data")
    target = target or get(f"TARGET_URI_{kind}", None if online else get("OUTPUT_DIR", "lake"))
    if not source or not target:
        raise ValueError(f"SOURCE_URI_{kind} and TARGET_URI_{kind} are needed")
    made = Settings(source.rstrip("/"), target.rstrip("/"), compression=get("PARQUET_COMPRESSION", "zstd"))
    return replace(made, **more)
