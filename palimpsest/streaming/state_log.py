"""Page states from a stream of events: each page's current and last successful state, kept across batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..functions import patterns as P

OUT = "page string, current_state string, last_success_state string, n_moves long, n_illegal long"
STATE = "current string, last string, moves long, illegal long"


def move(current: str, last: str, to: str) -> tuple[str, str, bool, bool]:
    """(current, last, moved, illegal) after an event: a failed page goes on from its last successful state."""
    at = last if current == P.FAILED else current
    if to == current != P.FAILED:
        return current, last, False, False
    if to == P.FAILED:
        return to, at, True, False
    if to == at or to in P.MOVES.get(at, ()):
        return to, to, True, False
    return current, last, False, True


def tracked(events: DataFrame, page: str, order: str) -> DataFrame:
    """A streaming DataFrame of the states of pages after each batch of events (page, order, to_state); events of a batch are taken in order."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        current, last, moves, illegal = state.get if state.exists else ("NEW", "NEW", 0, 0)
        rows = pd.concat(list(batches)).sort_values("at", kind="stable")
        for to in rows["to_state"]:
            current, last, moved, bad = move(current, last, to)
            moves, illegal = moves + moved, illegal + bad
        state.update((current, last, moves, illegal))
        yield pd.DataFrame([(str(key[0]), current, last, moves, illegal)], columns=["page", "current_state", "last_success_state", "n_moves", "n_illegal"])

    keyed = events.selectExpr(f"CAST({page} AS string) AS page", f"{order} AS at", "to_state")
    return keyed.groupBy("page").applyInPandasWithState(update, OUT, STATE, "update", "NoTimeout")
