"""Pairing over a stream of good reads: the two waiting slots of a query name as keyed state."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "qname string, line1 long, line2 long"
STATE = "side int, line long"


def _pair(key, chunks: Iterator[pd.DataFrame], state: GroupState, waits: int) -> Iterator[pd.DataFrame]:
    side, line = state.get if state.exists else (-1, -1)
    if state.hasTimedOut:  # nothing came for this name: its read stays without a mate
        state.remove()
        yield pd.DataFrame([(key[0], line, None)], columns=["qname", "line1", "line2"]).astype({"line1": "Int64", "line2": "Int64"})
        return
    out = []
    for pdf in chunks:
        for one, at in pdf.sort_values("line_no")[["is_read1", "line_no"]].itertuples(index=False):
            mine = int(bool(one))
            if side in (-1, mine):
                if side == mine:
                    out.append((key[0], line, None))  # replaced: dumped
                side, line = mine, at
            else:
                out.append((key[0], at if mine else line, line if mine else at))
                side, line = -1, -1
    if side == -1 and state.exists:
        state.remove()
    elif side != -1:
        state.update((side, int(line)))
        if waits:
            state.setTimeoutDuration(waits)
    frame = pd.DataFrame(out, columns=["qname", "line1", "line2"])
    yield frame.astype({"line1": "Int64", "line2": "Int64"})


def pair_stream(good: DataFrame, waits: float | None = 3600.0) -> DataFrame:
    """(qname, line1, line2) as pairs close; line2 is null for a read that a later one replaced.

    Records of a name are taken in record order within a micro-batch.  A read waits ``waits`` seconds for its
    mate; after that it leaves the state as one without a mate, so the state does not grow for ever.  Spark runs
    batches without data for this; None, for bounded input, lets reads wait without end.
    """
    pair = functools.partial(_pair, waits=int((waits or 0) * 1000))
    timeout = GroupStateTimeout.NoTimeout if waits is None else GroupStateTimeout.ProcessingTimeTimeout
    return good.groupBy("qname").applyInPandasWithState(pair, OUTPUT, STATE, "append", timeout)
