"""Settings of a run."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class EngineConfig:
    """Where the lake is and how much is done at a time."""

    lake: str = "lake"
    warehouse: str = "warehouse"
    first_year: int = 2000
    batch: dict[str, int] = field(default_factory=lambda: {"embedding": 64, "small": 100, "medium": 1000, "large": 10_000})
    seeds_per_area: int = 16
    requests_per_second: int = 12
