"""Retry arithmetic (M5, M6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def backoff(attempt: Column, most: float = 60.0) -> Column:
    """Seconds to wait after a rate limit, without jitter."""
    return F.least(F.lit(most), F.pow(F.lit(2.0), attempt))


def cooldown(strikes: Column, first: float = 300.0, most: float = 1800.0) -> Column:
    return F.least(F.lit(most), F.lit(first) * F.pow(F.lit(2.0), strikes))


def due(last: Column, now: Column, wait: float = 6 * 3600.0) -> Column:
    """Never tried, or longer ago than ``wait`` seconds."""
    return last.isNull() | (now - last > wait)
