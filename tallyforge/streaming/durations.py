"""Lengths of time, as texts."""

from __future__ import annotations

import re

_UNITS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def millis(duration: str) -> int:
    """Milliseconds of a text such as ``'90 seconds'``."""
    found = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", duration.lower())
    if not found or found[2] not in _UNITS or not int(found[1]):
        raise ValueError(f"no duration: {duration!r}")
    return int(found[1]) * _UNITS[found[2]]
