"""Counts, rate and time left of running jobs (K16, A13), from metrics that a plan gathers as its rows go by: nothing is read twice."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def counts(status: str | None = None, values: tuple[str, ...] = ()) -> dict[str, Column]:
    """rows, and how many of them have each of ``values`` in column ``status``; a null status counts as ``none``."""
    out = {"rows": F.count(F.lit(1))}
    if status:
        out |= {v: F.count_if(F.coalesce(F.col(status), F.lit("none")) == v) for v in values}
    return out


def watched(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` and what holds its metrics once an action on it has run; ``.get`` waits for that. Rows that a limit above it doesn't ask for aren't counted."""
    seen = Observation()
    return df.observe(seen, *(c.alias(n) for n, c in metrics.items())), seen


@dataclass
class Progress:
    """Sums of the metrics so far. ``total`` is the number of rows to do, if it is known; ``clock`` gives seconds."""

    total: int | None = None
    clock: Callable[[], float] = time.time
    done: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.began = self.clock()

    def add(self, metrics: dict[str, int]) -> None:
        for name, n in metrics.items():
            self.done[name] = self.done.get(name, 0) + int(n or 0)

    @property
    def rate(self) -> float:
        """Rows a second since the start."""
        return self.done.get("rows", 0) / max(self.clock() - self.began, 1e-9)

    @property
    def left_s(self) -> float | None:
        """Seconds left at this rate; None while it or the total is unknown, 0 once all is done."""
        if self.total is None or not self.done.get("rows"):
            return None
        return max(0, self.total - self.done["rows"]) / self.rate

    def line(self) -> str:
        n, left = self.done.get("rows", 0), self.left_s
        of = f"/{self.total}" if self.total is not None else ""
        rest = " ".join(f"{k} {v}" for k, v in self.done.items() if k != "rows")
        return f"{n}{of} {rest} {self.rate:.2f}/s".replace("  ", " ") + (f" {left / 60:.1f} min left" if left is not None else "")


class StreamProgress(StreamingQueryListener):
    """Feeds ``progress`` with what the streams' plans observe under ``name``; batches that Spark reports twice count once."""

    def __init__(self, name: str, progress: Progress, say: Callable[[str], None] | None = None):
        self.name, self.progress, self.say, self.seen = name, progress, say, set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        found, batch = p.observedMetrics.get(self.name), (str(p.id), p.batchId)
        if found is None or batch in self.seen:
            return
        self.seen.add(batch)
        self.progress.add(found.asDict())
        if self.say:
            self.say(self.progress.line())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
