"""Settings of a run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

#: Daily aggregates of each variable.
AGGREGATES = {"t2m": ("mean", "max", "min"), "d2m": ("mean",), "tp": ("sum",), "u10": ("mean",), "v10": ("mean",), "sp": ("mean",), "ssrd": ("sum",)}
#: Variables that come as running totals.
ACCUMULATED = ("tp", "ssrd")


@dataclass(frozen=True)
class Settings:
    variables: Sequence[str] = ("t2m", "tp")
    period: tuple[str, str] = ("1991-01-01", "2020-12-31")
    baseline: tuple[int, int] | None = None
    indices: Sequence[str] = ("spi",)
    scales: Sequence[int] = (1, 3, 6, 12)
    smoothing_days: int = 5
    boundary_buffer: float = 0.15
    rain_day_mm: float = 2.5
    rain_hour_mm: float = 0.1
    wet_rh: float = 90.0
    windy_ms: float = 8.0
    aggregates: dict[str, Sequence[str]] = field(default_factory=lambda: dict(AGGREGATES))

    @property
    def baseline_years(self) -> tuple[int, int]:
        """The data period, unless a baseline is set."""
        return self.baseline or (int(self.period[0][:4]), int(self.period[1][:4]))

    @classmethod
    def from_mapping(cls, values: dict) -> Settings:
        unknown = set(values) - set(cls.__dataclass_fields__)
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        return cls(**values)

    @classmethod
    def from_yaml(cls, text: str) -> Settings:
        import yaml

        return cls.from_mapping(yaml.safe_load(text) or {})
