"""Spending by document over a stream of calls, as keyed state that survives restarts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "doc_id string, call_id long, spent double, over_cap boolean"


def guard(calls: DataFrame, cap: float) -> DataFrame:
    """(doc_id, call_id, spent, over_cap) of calls (doc_id, call_id, cost), in order of call_id within a micro-batch; a null cost is 0."""

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        spent = state.get[0] if state.exists else 0.0
        frame = pd.concat(list(chunks)).sort_values("call_id")
        total = spent + frame["cost"].fillna(0.0).cumsum()
        state.update((float(total.iloc[-1]),))
        yield pd.DataFrame({"doc_id": key[0], "call_id": frame["call_id"], "spent": total, "over_cap": total >= cap})

    return calls.groupBy("doc_id").applyInPandasWithState(step, OUT, "spent double", "append", GroupStateTimeout.NoTimeout)
