"""Arrivals by the clock: files held in state until a timer of processing time goes off.

Streams need the RocksDB state store: rocksdb(spark) sets it. State and timers are in the checkpoint, so a stream that starts again goes on
with the files it held. Keys are a unit's night for debouncing and a night for the gate; no key holds all files.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

RELEASE = "nightdate string, n_files long, paths array<string>"


def rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Quiet(StatefulProcessor):
    """Emits a key's pending files once none has come for `wait` milliseconds; each file sets the timer anew."""

    def __init__(self, wait: int):
        self.wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "path string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        paths = [(p,) for part in rows for p in part["path"]]
        if paths:
            self.pending.appendList(paths)
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        paths = sorted({x[0] for x in self.pending.get()})
        self.pending.clear()
        if paths:
            yield pd.DataFrame({"unit": [key[0]], "nightdate": [key[1]], "n_files": [len(paths)], "paths": [paths]})

    def close(self) -> None:
        pass


def debounce(arrivals: DataFrame, seconds: float = 5) -> DataFrame:
    """(unit, nightdate, n_files, paths) of a stream of files (path, unit, nightdate): those of a unit's night that have come since the last
    release, once none has for so many seconds; a path counts once."""
    rows = arrivals.select("path", "unit", "nightdate").groupBy("unit", "nightdate")
    return rows.transformWithStateInPandas(statefulProcessor=Quiet(int(seconds * 1000)), outputStructType="unit string, nightdate string, n_files long, paths array<string>", outputMode="Append", timeMode="processingTime")


class Gate(StatefulProcessor):
    """Holds a night's files until every batch that its manifest expects has come; looks again every `wait` milliseconds."""

    def __init__(self, wait: int):
        self.wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "path string")
        self.all = handle.getListState("all", "path string")
        self.expected = handle.getMapState("expected", "batch string", "there boolean")
        self.present = handle.getMapState("present", "batch string", "there boolean")

    def _ready(self) -> bool:
        have = {k[0] for k in self.present.keys()}
        return all(k[0] in have for k in self.expected.keys())

    def _release(self, key, every: bool) -> Iterator[pd.DataFrame]:
        """A night that has a manifest is released with all its files so far, ToO files among them."""
        paths = sorted({x[0] for x in (self.all if every else self.held).get()})
        self.held.clear()
        if paths:
            yield pd.DataFrame({"nightdate": [key[0]], "n_files": [len(paths)], "paths": [paths]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(rows))
        for batch in rows.loc[rows["path"].isna(), "batch_key"]:
            self.expected.updateValue((batch,), (True,))
        files = rows[rows["path"].notna()]
        if not len(files):
            yield pd.DataFrame()
            return
        too = files["is_too"].fillna(False).astype(bool)
        for batch in set(files.loc[~too, "batch_key"].dropna()):
            self.present.updateValue((batch,), (True,))
        self.all.appendList([(p,) for p in files["path"]])
        known = self.expected.exists()
        # ToO files, and those of batches that no manifest expects, don't wait
        waits = ~too & files["batch_key"].map(lambda b: b is not None and self.expected.containsKey((b,))) if known else too & False
        free = sorted(set(files.loc[~waits, "path"]))
        if waits.any():
            self.held.appendList([(p,) for p in files.loc[waits, "path"]])
            if self._ready():
                yield from self._release(key, every=True)
                return
            if not list(self.handle.listTimers()):
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait)
        yield pd.DataFrame({"nightdate": [key[0]], "n_files": [len(free)], "paths": [free]}) if free else pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.held.exists():
            return
        if self._ready():
            yield from self._release(key, every=True)
        else:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait)

    def close(self) -> None:
        pass


def gate(arrivals: DataFrame, manifest: DataFrame, seconds: float = 15) -> DataFrame:
    """Releases (nightdate, n_files, paths) of a stream of files (path, nightdate, batch_key, is_too), held back by a manifest that is a stream as
    well (nightdate, batch_key) and may grow while files wait.

    A file passes at once if its night or its batch is in no manifest, or it is a ToO file. Others are held until each expected
    batch of the night has a file; then the night goes out with all its files so far. A file that completes the night
    releases it at once; a change of the manifest takes effect when the night is looked at again, every so many seconds.
    A night's names stay in state, as later files release it again."""
    files = arrivals.select("nightdate", "path", "batch_key", "is_too")
    wanted = manifest.select("nightdate", F.lit(None).cast("string").alias("path"), "batch_key", F.lit(False).alias("is_too"))
    return files.unionByName(wanted).groupBy("nightdate").transformWithStateInPandas(statefulProcessor=Gate(int(seconds * 1000)), outputStructType=RELEASE, outputMode="Append", timeMode="processingTime")
