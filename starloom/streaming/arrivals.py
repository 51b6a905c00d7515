"""Arriving files: new-file streams, debouncing, and the gate that holds a night until its batches are complete."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from starloom.functions.text import UNIT

ARRIVAL = "path string, unit string, nightdate string, batch_key string, is_too boolean, ts timestamp"
EXPIRY_DAYS = 3


def new_files(spark: SparkSession, folder: str, unit: str = UNIT) -> DataFrame:
    """A stream of (path, ts) of .fits files under a unit's folder; contents are not read."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.fits").load(folder)
    return files.select("path", F.col("modificationTime").alias("ts")).where(F.col("path").rlike(rf"/{unit}/.*\.fits$"))


def debounce(events: DataFrame, gap: str = "5 seconds", watermark: str = "30 seconds", keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, start, end, n, paths): files that came with less than `gap` between them, once the gap has passed. Stream or batch.

    keys: columns that arrive apart, such as unit and night; without any, all files pass through one task."""
    df = events.withWatermark("ts", watermark) if events.isStreaming else events
    # streams need a key beside the window
    by = [F.col(k) for k in keys] or [F.col("ts").isNull().alias("none")]
    g = df.groupBy(*by, F.session_window("ts", gap)).agg(F.count("*").alias("n"), F.sort_array(F.collect_set("path")).alias("paths"))
    return g.select(*keys, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n", "paths")


def gate_batch(arrivals: DataFrame, manifest: DataFrame) -> DataFrame:
    """(nightdate, release_no, n_files, release_ts): the releases that the whole of `arrivals` leads to.

    A night is ready when the last of its manifest's batches has arrived (from any unit); a night without a manifest
    passes at once. Files with is_too do not count for readiness but belong to the release. Each file after the release
    makes one more release, with all the night's files so far."""
    need = manifest.groupBy("nightdate").agg(F.count_distinct("batch_key").alias("need"))
    first = arrivals.where("NOT is_too").join(manifest.select("nightdate", "batch_key").distinct(), ["nightdate", "batch_key"]).groupBy("nightdate", "batch_key").agg(F.min("ts").alias("t"))
    have = first.groupBy("nightdate").agg(F.count("*").alias("have"), F.max("t").alias("done"))
    nights = arrivals.groupBy("nightdate").agg(F.min("ts").alias("begin")).join(need, "nightdate", "left").join(have, "nightdate", "left")
    ready = nights.select("nightdate", F.when(F.col("need").isNull(), F.col("begin")).when(F.col("have") == F.col("need"), F.col("done")).alias("ready")).where("ready IS NOT NULL")
    j = arrivals.join(ready, "nightdate").withColumn("release_ts", F.greatest("ts", "ready"))
    per = j.groupBy("nightdate", "release_ts").agg(F.count("*").alias("k"))
    w = W.partitionBy("nightdate").orderBy("release_ts")
    return per.select("nightdate", F.row_number().over(w).alias("release_no"), F.sum("k").over(w).alias("n_files"), "release_ts")


def _gate(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """State: batches seen, files so far, releases so far, batches needed (-1: no manifest). Rows of a key come in order of ts."""
    if state.hasTimedOut:
        state.remove()
        return
    seen, files, releases, _ = state.get if state.exists else ("", 0, 0, -1)
    have = set(filter(None, seen.split("\n")))
    rows = pd.concat(list(frames)).sort_values(["ts", "path"], kind="stable")
    out = []
    need = {x for x in (rows["need"].iloc[0] or "").split("\n") if x}
    for ts, group in rows.groupby("ts", sort=True):
        have |= set(group.loc[~group["is_too"], "batch_key"]) & need
        files += len(group)
        if have == need:
            releases += 1
            out.append((key[0], releases, files, ts))
    state.update(("\n".join(sorted(have)), files, releases, len(need) if need else -1))
    state.setTimeoutTimestamp(max(int(rows["ts"].max().timestamp() * 1000), state.getCurrentWatermarkMs()) + EXPIRY_DAYS * 86_400_000)
    yield pd.DataFrame(out, columns=["nightdate", "release_no", "n_files", "release_ts"])


def gate_stream(arrivals: DataFrame, manifest: DataFrame) -> DataFrame:
    """The same releases from a stream of arrivals; the manifest is a static side. State is a night's batch names and counts.

    A night's state goes once the watermark is EXPIRY_DAYS past its last file; a file that comes even later starts anew."""
    need = manifest.groupBy("nightdate").agg(F.array_join(F.sort_array(F.collect_set("batch_key")), "\n").alias("need"))
    joined = arrivals.withWatermark("ts", "1 hour").join(need, "nightdate", "left").withColumn("need", F.coalesce("need", F.lit("")))
    return joined.groupBy("nightdate").applyInPandasWithState(_gate, "nightdate string, release_no int, n_files long, release_ts timestamp", "seen string, files long, releases int, need int", "append", GroupStateTimeout.EventTimeTimeout)


def missing_batches(arrivals: DataFrame, manifest: DataFrame) -> DataFrame:
    """Batches of the manifest that have not arrived."""
    return manifest.select("nightdate", "batch_key").distinct().join(arrivals.where("NOT is_too").select("nightdate", "batch_key"), ["nightdate", "batch_key"], "left_anti")
