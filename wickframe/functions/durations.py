"""Window lengths as text ("5 minutes") and as microseconds."""

from __future__ import annotations

import math
import re

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
_TERM = re.compile(r"(\d+)\s+([a-z]+?)s?(?:\s+|$)")


def micros(duration: str) -> int:
    """Length of a fixed-size interval such as ``"1 day 6 hours"``."""
    text = duration.strip().lower()
    total, at = 0, 0
    while at < len(text):
        term = _TERM.match(text, at)
        if term is None or term[2] not in _UNIT_MICROS:
            raise ValueError(f"not a fixed-length duration: {duration!r}")
        total += int(term[1]) * _UNIT_MICROS[term[2]]
        at = term.end()
    if total <= 0:
        raise ValueError(f"duration must be positive: {duration!r}")
    return total


def pane_micros(size: str, slide: str) -> int:
    """Widest tumbling pane that tiles every ``size``/``slide`` window exactly."""
    return math.gcd(micros(size), micros(slide))
