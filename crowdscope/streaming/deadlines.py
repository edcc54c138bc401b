"""Runs of jobs as keyed stream state with a deadline.

Events name a job and say that it was asked for (``request``) or that its
work ended (``done``). The first request of a job opens a run; the run ends
``SUCCESS`` with the first ``done`` before its deadline, else ``EXPIRED`` at
the deadline. A request during a run is the same request delivered again: it
is counted and starts nothing. A request from the deadline on opens the next run.

Jobs are dealt over groups by a hash of their id. A group's state is a row of
its open runs; a call of the group's function serves all of its jobs. A
finished run stays until its deadline, so that a re-delivery finds it; then an
event-time timer, set to the group's earliest deadline, removes it. What is
still delivered later lies behind the watermark and is dropped, so state is
bounded by the runs of one deadline, however many jobs have finished.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# --- Fixed values: seconds until a run expires -----------------------------
DEADLINE_SECONDS = 72_000
#: Groups that jobs are dealt over; a checkpoint is read with the number it was written with.
GROUPS = 1024
# ---------------------------------------------------------------------------

STATE = "jobs array<long>, started array<long>, finished array<long>, again array<int>"
RUNS = "job_id long, status string, started_at timestamp, finished_at timestamp, redelivered int"


def job_runs(events: DataFrame, deadline_seconds: int = DEADLINE_SECONDS, lateness: str = "0 seconds",
             groups: int = GROUPS) -> DataFrame:
    """Transitions of all runs: ``EXECUTING`` when a run opens, ``SUCCESS`` or
    ``EXPIRED`` once its deadline has passed in event time.

    ``events`` is a stream of (``job_id`` long, ``kind``, ``at`` timestamp).
    Rows without job or time are left out; of events at one moment, requests
    count first; a ``done`` without an open run is nothing. Events of one job
    may arrive in any order within ``lateness``; a run is not opened earlier
    by a request that arrives after the one that opened it.
    """
    length = deadline_seconds * 1_000_000

    def ended(job, started, finished, again):
        return (job, "EXPIRED" if finished is None else "SUCCESS", started, started + length if finished is None else finished, again)

    def deadline_ms(run):
        return -(-(run[0] + length) // 1000)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        runs = {job: run for job, *run in zip(*state.get)} if state.exists else {}
        out, met = [], set()
        parts = [] if state.hasTimedOut else list(frames)
        if parts:
            jobs, last = (np.concatenate([f[c].to_numpy() for f in parts]) for c in ("job_id", "last"))
            at = np.concatenate([f["at"].to_numpy().astype("datetime64[us]").astype("int64") for f in parts])
            order = np.lexsort((last, at, jobs))
            for job, us, later in zip(jobs[order].tolist(), at[order].tolist(), last[order].tolist()):
                run = runs.get(job)
                if run and us >= run[0] + length:
                    out.append(ended(job, *runs.pop(job)))
                    run = None
                if not later and run is None:
                    runs[job] = [us, None, 0]
                    out.append((job, "EXECUTING", us, None, 0))
                elif not later:
                    run[2] += 1
                elif run and run[1] is None and us >= run[0]:
                    run[1] = us
                met.add(job)
        # a timer passes when the watermark is beyond it; a job that is met needs none at the watermark itself
        watermark = state.getCurrentWatermarkMs()
        for job in [j for j, run in runs.items() if deadline_ms(run) < watermark + (j in met)]:
            out.append(ended(job, *runs.pop(job)))
        if runs:
            state.update(([*runs], *([run[i] for run in runs.values()] for i in range(3))))
            state.setTimeoutTimestamp(max(min(map(deadline_ms, runs.values())), watermark + 1))
        elif state.exists:
            state.remove()
        if out:
            job, status, started, finished, again = zip(*out)
            yield pd.DataFrame({"job_id": job, "status": status, "started_at": pd.to_datetime(list(started), unit="us"),
                                "finished_at": pd.to_datetime(pd.array(finished, "Int64"), unit="us"), "redelivered": np.array(again, "int32")})

    known = events.filter("job_id IS NOT NULL AND at IS NOT NULL AND kind IN ('request', 'done')")
    group = F.pmod(F.xxhash64("job_id"), F.lit(groups)).cast("int").alias("group")
    return (known.select(group, "job_id", (F.col("kind") != "request").alias("last"), "at").withWatermark("at", lateness).groupBy("group")
            .applyInPandasWithState(step, RUNS, STATE, "append", GroupStateTimeout.EventTimeTimeout))


def run_until(query: StreamingQuery, deadline_seconds: float = DEADLINE_SECONDS) -> bool:
    """Let a polling stream run until its deadline, then stop it; the batch in
    hand is repeated when it starts again. True if it ended by itself before."""
    ended = query.awaitTermination(deadline_seconds)
    if not ended:
        query.stop()
    return bool(ended)
