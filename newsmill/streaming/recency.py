"""Keyed state: hours since the last event of each group, per entity."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}

OUTPUT = "entity string, ts timestamp, grp string, hours_since double"


class LastEvent(StatefulProcessor):
    """One map entry per event group: the newest event time seen for the entity."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", "grp string", "micros bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for grp, ts in pdf.groupby("grp")["ts"].max().items():
                micros = ts.value // 1000
                known = self.last.getValue((grp,))[0] if self.last.containsKey((grp,)) else None
                if known is None or micros > known:
                    self.last.updateValue((grp,), (micros,))
        # all rows of the batch are in: one answer per key, seen from its newest event so far
        seen = [(grp[0], last[0]) for grp, last in self.last.iterator()]
        now = max(micros for _, micros in seen)
        out = [(key[0], pd.Timestamp(now, unit="us"), grp, max(0.0, round((now - micros) / 3.6e9, 2))) for grp, micros in seen]
        yield pd.DataFrame(out, columns=["entity", "ts", "grp", "hours_since"])

    def close(self) -> None:
        pass


def newest_per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Combine before the shuffle: one row per (entity, group) of each Arrow batch."""
    for pdf in batches:
        yield pdf.groupby(["entity", "grp"], as_index=False)["ts"].max()[["entity", "ts", "grp"]]


def stream_hours_since(events: DataFrame) -> DataFrame:
    """events(entity, ts, grp) -> per micro-batch, hours from each known group's last event to the newest
    event of the entity.  State is one value per (entity, group); a busy entity ships one row per group and
    Arrow batch to its state, not every event."""
    slim = events.select("entity", "ts", "grp").mapInPandas(newest_per_batch, "entity string, ts timestamp, grp string")
    return slim.groupBy("entity").transformWithStateInPandas(
        statefulProcessor=LastEvent(), outputStructType=OUTPUT, outputMode="Update", timeMode="None")
