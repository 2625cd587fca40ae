"""What writers spend their time on, summed over tasks."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

STATES = ("initializing", "collecting", "uploading", "server", "committing")


class StateTimes:
    """Milliseconds in each state, rows and uploads of one task; starts in ``initializing``."""

    def __init__(self, clock=time.perf_counter_ns):
        self.clock = clock
        self.spent = dict.fromkeys(STATES, 0)
        self.rows = self.uploads = 0
        self.state: str | None = STATES[0]
        self.since = clock()

    def enter(self, state: str) -> None:
        if state not in self.spent:
            raise ValueError(f"unknown state {state!r}")
        self.leave()
        self.state = state

    def leave(self) -> None:
        now = self.clock()
        if self.state:
            self.spent[self.state] += now - self.since
        self.state, self.since = None, now

    def totals(self) -> dict[str, int]:
        """Metrics by name; the total is the sum of the states."""
        out = {f"millis_{s}": n // 1_000_000 for s, n in self.spent.items()}
        return out | {"millis_total": sum(self.spent.values()) // 1_000_000, "upload_count": self.uploads, "row_count": self.rows}


def summed(each: Iterable[Mapping[str, int]]) -> dict[str, int]:
    out: dict[str, int] = {}
    for one in each:
        for k, v in one.items():
            out[k] = out.get(k, 0) + v
    return out


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` and an observation of the rows that pass through it; no extra job."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("row_count")), seen
