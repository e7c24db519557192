"""Progress of stages: counts taken while a job runs, at no extra pass."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Progress:
    """Rows that pass through a DataFrame, with sums of some of its columns, known once an action has run over it."""

    def __init__(self, label: str, total: int | None = None, clock: Callable[[], float] = time.monotonic):
        self.label, self.total, self._clock, self._began = label, total, clock, clock()
        self._seen: Observation | None = None

    def watch(self, df: DataFrame, **sums: Column) -> DataFrame:
        self._seen = Observation()
        return df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in sums.items()])

    def counts(self) -> dict:
        return dict(self._seen.get) if self._seen is not None else {"rows": 0}

    def line(self) -> str:
        """``[label] done/total``, minutes since the start and minutes left at this rate."""
        done, spent = self.counts()["rows"], self._clock() - self._began
        left = "" if not self.total else f"/{self.total}  eta {max(0, self.total - done) * max(spent, 1.0) / max(done, 1) / 60:.0f}m"
        return f"[{self.label}] {done}{left}  {spent / 60:.1f}m elapsed"
