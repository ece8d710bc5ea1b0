"""Extension: the clamp of words and the idle timeout as one stateful operator of a stream, and the same over a table.

Of words(doc_id, word_idx, ts, start_s, end_s) in order of (ts, word_idx), each is moved to the last end
where it starts before it, its duration kept; a document that has no word for longer than gap after
one is idle, from ts + gap on, which is a row of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cantolith.operators import timeline

OUT = "doc_id {}, kind string, ts timestamp, word_idx long, start_s double, end_s double"
HELD = "ts timestamp, word_idx long, start_s double, end_s double"


class _Clamp(StatefulProcessor):
    """Rows wait in a list until the watermark has passed them; a timer for each time lets them out in order."""

    def __init__(self, gap: timedelta):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", HELD)
        self.last = handle.getValueState("last", "ts timestamp, end_s double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            new = [tuple(None if pd.isna(x) else x for x in r) for r in frame[["ts", "word_idx", "start_s", "end_s"]].itertuples(index=False)]
            self.held.appendList([(ts.to_pydatetime(), None if i is None else int(i), s, e) for ts, i, s, e in new])
            for ts in {r[0] for r in new}:
                self.handle.registerTimer(int(ts.timestamp() * 1000))
                self.handle.registerTimer(int((ts + self.gap).timestamp() * 1000))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")
        held = [(pd.Timestamp(r[0]).tz_localize(None), *r[1:]) for r in self.held.get()]
        out = sorted((r for r in held if r[0].floor("ms") <= now), key=lambda r: (r[0], r[1]))
        ts, end = self.last.get() if self.last.exists() else (None, None)
        ts, rows = None if ts is None else pd.Timestamp(ts).tz_localize(None), []
        for at, i, a, b in out:
            if a is not None and b is not None:
                a, b = (end, end + b - a) if end is not None and a < end else (a, b)
                end = b
            ts = at
            rows.append((*key, "word", at, i, a, b))
        if out:
            self.held.put([(r[0].to_pydatetime(), *r[1:]) for r in held if r[0].floor("ms") > now]) if len(out) < len(held) else self.held.clear()
            self.last.update((ts.to_pydatetime(), end))
        if ts is not None and (ts + self.gap).floor("ms") == now:
            rows.append((*key, "idle", ts + self.gap, None, None, None))
        if rows:
            yield pd.DataFrame(rows, columns=["doc_id", "kind", "ts", "word_idx", "start_s", "end_s"]).astype({"word_idx": "Int64", "start_s": "float64", "end_s": "float64"})


def clamped_stream(words: DataFrame, gap: timedelta, late: str) -> DataFrame:
    """Rows of words and of idle documents, once the watermark (late behind the latest ts) has passed them; later ones are dropped.

    The state is a document's rows that wait, its last time and its last end. A restart from its
    checkpoint goes on where it stopped. It needs the RocksDB state store.
    """
    own = words.where("ts is not null").withWatermark("ts", late)
    kind = dict(words.dtypes)["doc_id"]
    return own.groupBy("doc_id").transformWithStateInPandas(_Clamp(gap), OUT.format(kind), "Append", "EventTime")


def clamped(words: DataFrame, gap: timedelta) -> DataFrame:
    """The same rows of a table, all of them; word_idx must rise with ts."""
    order = Window.partitionBy("doc_id").orderBy("ts", "word_idx")
    own = timeline.monotonic_words(words.where("ts is not null"))
    rows = own.select("doc_id", F.lit("word").alias("kind"), "ts", "word_idx", "start_s", "end_s")
    after = words.where("ts is not null").select("doc_id", "ts", F.lead("ts").over(order).alias("_next"))
    idle = after.where(F.col("_next").isNull() | (F.col("_next") > F.col("ts") + gap)).select("doc_id", F.lit("idle").alias("kind"), (F.col("ts") + gap).alias("ts"), F.lit(None).cast("long").alias("word_idx"), F.lit(None).cast("double").alias("start_s"), F.lit(None).cast("double").alias("end_s"))
    return rows.unionByName(idle)
