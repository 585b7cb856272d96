"""Predictions over a stream that never see their own day.

State per content is the label counts of closed days and the open day's rows. A day closes once the watermark passes it:
its rows are then predicted from the earlier days, and only afterwards added to the counts. Rows that are later than the
watermark are dropped by it, so that no emitted prediction can change.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupStateTimeout

OUTPUT = "id long, content string, label string, pred string, hist_n long"
STATE = "counts map<string,long>, last map<string,string>, days array<string>, ids array<long>, labels array<string>"


def _advance(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    counts, last, days, ids, labels = ({}, {}, [], [], []) if not state.exists else [x or d for x, d in zip(state.get, ({}, {}, [], [], []), strict=True)]
    counts, last = dict(counts), dict(last)
    rows = list(zip(days, ids, labels, strict=True))
    for b in batches:
        rows += [(str(d)[:10], int(i), l) for d, i, l in zip(b["day"], b["id"], b["label"], strict=True)]
    rows.sort()
    closed = str(pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms"))[:10]
    out = []
    while rows and rows[0][0] < closed:
        day = rows[0][0]
        today = [r for r in rows if r[0] == day]
        rows = rows[len(today) :]
        best = max(counts, key=lambda x: (counts[x], last[x])) if counts else None
        out += [(i, key[0], label, best, sum(counts.values())) for _, i, label in today]
        for d, i, label in today:
            counts[label] = counts.get(label, 0) + 1
            last[label] = f"{d}/{i:020d}"
    state.update((counts, last, [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]))
    if rows:
        due = int(pd.Timestamp(rows[0][0]).timestamp() * 1000) + 86_400_000
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame(out, columns=["id", "content", "label", "pred", "hist_n"])


def rolling_modes(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """(id, content, label, pred, hist_n) of a stream (id, ts, content, label), in append mode, a day behind the watermark."""
    s = stream.withWatermark("ts", late).selectExpr("id", "ts", "date(ts) as day", "content", "label")
    return s.groupBy("content").applyInPandasWithState(_advance, OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
