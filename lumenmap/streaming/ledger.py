"""Streaming runs of the evidence ledger and of feature memory: the same state as in batch, whatever the order of arrival.

State is keyed by point (or feature) and holds its sessions (or its last events); a session's evidence is a
union, so a batch that is processed again changes nothing and a late match corrects an earlier miss.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import ship

LEDGER = "point_id long, stability double, consistency double, unmatched_streak long, sessions long, state string"
LEDGER_STATE = "sessions array<string>, matched array<boolean>"


def ledger_of(sessions: dict[str, bool], decay: float = 0.5, retire_after: int = 2) -> tuple[float, float, int, int, str]:
    """Stability, consistency, streak without a match, sessions and state, from each session's match."""
    weight = hit = 0.0
    streak, open_ = 0, True
    for age, name in enumerate(sorted(sessions, reverse=True)):
        w = decay**age
        weight += w
        if sessions[name]:
            hit += w
            open_ = False
        elif open_:
            streak += 1
    state = "RETIRED" if streak >= retire_after else "AGING" if streak else "ACTIVE"
    return min(1.0, hit), hit / weight if weight else 0.0, streak, len(sessions), state


def stream_ledger(events: DataFrame, decay: float = 0.5, retire_after: int = 2) -> DataFrame:
    """A stream (point_id, session as text that sorts, visible, matched) to updates of the ledger."""
    ship(events.sparkSession)
    columns = [c.split()[0] for c in LEDGER.split(", ")]

    def step(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names, hits = state.get if state.exists else ([], [])
        known = dict(zip(names, map(bool, hits)))
        for rows in batches:
            for session, visible, matched in zip(rows["session"], rows["visible"], rows["matched"]):
                if visible or matched:
                    known[session] = known.get(session, False) or bool(matched)
        state.update((list(known), list(known.values())))
        if known:
            yield pd.DataFrame([(int(key[0]), *ledger_of(known, decay, retire_after))], columns=columns)

    return events.select("point_id", "session", "visible", "matched").groupBy("point_id").applyInPandasWithState(step, LEDGER, LEDGER_STATE, "update", GroupStateTimeout.NoTimeout)


MEMORY = "feature_id long, score double, last_ts double, events long"
MEMORY_STATE = "ts array<double>, event array<string>"


def memory_of(events: list[tuple[float, str]], start: float = 0.5, rate: float = 0.1, low: float = 0.0, high: float = 1.0) -> tuple[float, float]:
    from ..operators.evolution import EVENT_VALUES

    score = start
    for _, e in sorted(events):
        score = min(high, max(low, score + rate * EVENT_VALUES.get(e, 0.0)))
    return score, max(t for t, _ in events)


def stream_memory(events: DataFrame, start: float = 0.5, rate: float = 0.1) -> DataFrame:
    """A stream (feature_id, ts, event) to updates of feature scores. Clamping depends on order, so the events of a feature are its state."""
    ship(events.sparkSession)

    def step(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ts, names = state.get if state.exists else ([], [])
        seen = list(zip(ts, names))
        for rows in batches:
            seen += list(zip(rows["ts"].astype(float), rows["event"]))
        state.update(([t for t, _ in seen], [e for _, e in seen]))
        if seen:
            score, last = memory_of(seen, start, rate)
            yield pd.DataFrame([(int(key[0]), score, last, len(seen))], columns=["feature_id", "score", "last_ts", "events"])

    return events.select("feature_id", "ts", "event").groupBy("feature_id").applyInPandasWithState(step, MEMORY, MEMORY_STATE, "update", GroupStateTimeout.NoTimeout)


def stream_windows(events: DataFrame, ts: str, by: str, length: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts of failures by tumbling window and key, events more than `late` behind being left out."""
    from pyspark.sql import functions as F

    w = F.window(ts, length)
    return events.withWatermark(ts, late).groupBy(w, by).agg(F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("failures")).select(F.col("window.start").alias("start"), by, "n", "failures")
