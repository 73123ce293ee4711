"""When a group's report may be published: once its workbooks are complete and no more are coming in, or it has waited long.

A drop of workbooks may be split over several batches, a bank statement from the dictionary that maps it. The gate keeps a
state for each group: the kinds of workbooks it has ever had, the reports that an arrival concerns, and the times of the
first and the last arrival that no publication has followed yet. Timers let a report through when nothing has arrived
for ``settle`` seconds and the group has every kind that the report reads, and, complete or not, ``patience`` seconds
after the first arrival.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "kinds array<string>, waiting array<string>, first long, last long"
DUE = "grp string, report string, complete boolean"


def decide(
    needs: Mapping[str, Sequence[str]], kinds: set[str], waiting: set[str], first: int, last: int, now: int, settle: int, patience: int
) -> tuple[set[str], int | None]:
    """The waiting reports that are due now, and when to look again (milliseconds) if others still wait."""
    late = now >= first + patience
    quiet = now >= last + settle
    due = {r for r in waiting if late or (quiet and set(needs[r]) <= kinds)}
    if due == waiting:
        return due, None
    return due, first + patience if quiet else min(last + settle, first + patience)


def due_reports(arrivals: DataFrame, needs: Mapping[str, Sequence[str]], settle: float, patience: float) -> DataFrame:
    """grp, report, complete of the reports that are due, from a stream of arrivals (grp, kind)."""
    needs = {r: list(k) for r, k in needs.items()}
    settle_ms, patience_ms = round(settle * 1000), round(patience * 1000)

    def step(key: tuple[str], rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = round(time.time() * 1000)
        old = state.get if state.exists else ([], [], 0, 0)
        kinds, waiting, first, last = set(old[0]), set(old[1]), old[2], old[3]
        if not state.hasTimedOut:
            came = {k for frame in rows for k in frame["kind"]}
            concerned = {r for r, own in needs.items() if came & set(own)}
            if concerned:
                kinds, first, last = kinds | came, first if waiting else now, now
                waiting |= concerned
            kinds |= came
        due, again = decide(needs, kinds, waiting, first, last, now, settle_ms, patience_ms) if waiting else (set(), None)
        state.update((sorted(kinds), sorted(waiting - due), first, last))
        if again is not None:
            state.setTimeoutDuration(max(1, again - now))
        if due:
            yield pd.DataFrame([(key[0], r, set(needs[r]) <= kinds) for r in sorted(due)], columns=["grp", "report", "complete"])

    return arrivals.groupBy("grp").applyInPandasWithState(step, DUE, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)
