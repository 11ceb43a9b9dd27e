"""How many rows a step may make of those it gets, checked while a job runs.

Rows before and after the step are counted as observed metrics of the plan that runs anyway, so
nothing is computed twice. A step that maps is 1:1, one that filters 1:0..1, one that splits
0..N of each; a window or an aggregate may give any number, down to a bound the caller states.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

#: Whether so many rows out are right for so many rows in.
RULES: dict[str, Callable[[int, int], bool]] = {
    "1:1": lambda before, after: after == before,
    "1:0..1": lambda before, after: after <= before,
    "1:1..N": lambda before, after: after >= before,
    "N:M": lambda before, after: after == 0 if before == 0 else True,
}


class RowContractBroken(Exception):
    """A step gave a number of rows that its contract rules out."""


def _verdict(step: str, rule: str, before: int, after: int) -> str | None:
    return None if RULES[rule](before, after) else f"{step}: {before} rows in, {after} rows out breaks {rule}"


@dataclass
class RowContract:
    """The contract of one step; :meth:`check` after the job, or :meth:`watch` for a stream."""

    step: str
    rule: str
    before: Observation | None = None
    after: Observation | None = None
    breaches: list[str] = field(default_factory=list)
    counted: list[tuple[int, int]] = field(default_factory=list)

    def check(self) -> tuple[int, int]:
        """(rows in, rows out) of the action that has run on the step's result; raises on a breach."""
        rows = self.before.get["rows"], self.after.get["rows"]
        if found := _verdict(self.step, self.rule, *rows):
            raise RowContractBroken(found)
        return rows

    def watch(self, query: StreamingQuery, spark: SparkSession | None = None) -> RowWatch:
        """Check each micro-batch of a started stream; the first breach stops it. A context manager."""
        return RowWatch(self, query, spark or SparkSession.active())


class RowWatch(StreamingQueryListener):
    """Looks at the counts of each micro-batch, from the progress that Spark reports."""

    def __init__(self, contract: RowContract, query: StreamingQuery, spark: SparkSession):
        self.contract, self.query, self.spark = contract, query, spark
        self.seen: set[int] = set()

    def __enter__(self) -> RowWatch:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def to_end(self) -> None:
        """Wait for the stream to end; raises if a micro-batch broke the contract, seen at once or by now."""
        self.query.awaitTermination()
        for progress in self.query.recentProgress:
            self._look(progress.batchId, progress.observedMetrics)
        if self.contract.breaches:
            raise RowContractBroken(self.contract.breaches[0])

    def _look(self, number: int, found: dict) -> None:
        names = [f"{self.contract.step} in", f"{self.contract.step} out"]
        if number in self.seen or not all(n in found for n in names):
            return
        self.seen.add(number)
        before, after = (int(found[n]["rows"]) for n in names)
        self.contract.counted.append((before, after))
        if breach := _verdict(self.contract.step, self.contract.rule, before, after):
            self.contract.breaches.append(f"{breach} in micro-batch {number}")

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        if event.progress.id == self.query.id:
            self._look(event.progress.batchId, event.progress.observedMetrics)
            if self.contract.breaches:
                self.query.stop()

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...


def with_row_contract(df: DataFrame, step: Callable[[DataFrame], DataFrame], name: str, rule: str) -> tuple[DataFrame, RowContract]:
    """(``step`` of ``df``, the contract that its row counts are checked by). ``rule`` is one of :data:`RULES`.

    On a bounded frame run one action on the result, then :meth:`RowContract.check`. On a stream
    start it and :meth:`RowContract.watch` it.
    """
    if rule not in RULES:
        raise ValueError(f"no such rule: {rule!r}")
    rows = F.count(F.lit(1)).alias("rows")
    if df.isStreaming:
        out = step(df.observe(f"{name} in", rows)).observe(f"{name} out", rows)
        return out, RowContract(name, rule)
    before, after = Observation(f"{name} in"), Observation(f"{name} out")
    return step(df.observe(before, rows)).observe(after, rows), RowContract(name, rule, before, after)
