"""Settings of a run: defaults that the environment can replace, one variable each, named STRANDLINE_ and the field in capitals."""

from __future__ import annotations

import os
from collections.abc import Mapping
from typing import NamedTuple


def listed(text: str) -> list[str]:
    """The parts of a comma-separated list, without blanks and empty parts."""
    return [x.strip() for x in text.split(",") if x.strip()]


class Settings(NamedTuple):
    version: str = "0.1"
    root: str = "output"
    first_year: int = 1999
    last_year: int = 2025
    period_lengths: tuple[int, ...] = (1, 3)
    hotspot_radii: tuple[float, ...] = (15_000.0, 5_000.0, 1_000.0)
    countries: tuple[str, ...] = ()


def settings(env: Mapping[str, str] | None = None) -> Settings:
    """Settings with what the environment says. A list is split at commas; a value of the wrong kind is an error."""
    env = os.environ if env is None else env
    made = {}
    for name, default in Settings()._asdict().items():
        text = env.get(f"STRANDLINE_{name.upper()}")
        if text is not None:
            kind = type(default[0]) if isinstance(default, tuple) and default else str
            made[name] = tuple(kind(x) for x in listed(text)) if isinstance(default, tuple) else type(default)(text)
    return Settings(**made)
