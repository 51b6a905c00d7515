"""Streams by the clock: quiet periods, a manifest that grows, and a restart that finds the held files again."""

import json
import time

import pytest

from starloom.streaming import timers

FILES = "path string, unit string, nightdate string, batch_key string, is_too boolean"


class Folder:
    """A folder that a stream reads, and the rows that come out."""

    def __init__(self, spark, root, name, schema):
        self.spark, self.path, self.schema, self.n = spark, root / name, schema, 0
        self.path.mkdir()

    def put(self, *rows):
        self.n += 1
        hidden = self.path / f"_{self.n}"
        hidden.write_text("\n".join(json.dumps(r) for r in rows))
        hidden.rename(self.path / f"{self.n}.json")

    def stream(self):
        return self.spark.readStream.schema(self.schema).json(str(self.path))


def start(df, root, sink):
    def keep(batch, _):
        sink.extend(batch.collect())

    return df.writeStream.foreachBatch(keep).option("checkpointLocation", str(root / "state")).outputMode("append").trigger(processingTime="200 milliseconds").start()


def wait_for(test, seconds=60):
    end = time.time() + seconds
    while not test():
        assert time.time() < end, "nothing came"
        time.sleep(0.2)


def file(path, night="n1", batch="b1", too=False, unit="u1"):
    return {"path": path, "unit": unit, "nightdate": night, "batch_key": batch, "is_too": too}


@pytest.fixture(autouse=True)
def state(spark):
    timers.rocksdb(spark)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_debounce_by_unit_and_night(spark, tmp_path):
    files, out = Folder(spark, tmp_path, "files", FILES), []
    q = start(timers.debounce(files.stream(), 10), tmp_path, out)
    try:
        files.put(file("a"), file("b"), file("c", unit="u2"), file("a"))
        wait_for(lambda: sum(p.numInputRows for p in q.recentProgress) >= 4)
        files.put(file("d"))
        wait_for(lambda: len(out) >= 2)
        assert sorted((r.unit, r.n_files, tuple(r.paths)) for r in out) == [("u1", 3, ("a", "b", "d")), ("u2", 1, ("c",))]
    finally:
        q.stop()


def test_gate_with_growing_manifest_and_restart(spark, tmp_path):
    files, manifest, out = Folder(spark, tmp_path, "files", FILES), Folder(spark, tmp_path, "manifest", "nightdate string, batch_key string"), []
    rows = lambda: sorted((r.nightdate, r.n_files, tuple(r.paths)) for r in out)
    begin = lambda: start(timers.gate(files.stream(), manifest.stream(), 1), tmp_path, out)
    q = begin()
    try:
        manifest.put({"nightdate": "n1", "batch_key": "b1"}, {"nightdate": "n1", "batch_key": "b2"})
        wait_for(lambda: q.lastProgress and q.lastProgress.batchId >= 0)
        time.sleep(1)
        files.put(file("a"), file("t", batch="b9_x", too=True), file("free", night="n2"), file("odd", batch="b7"))
        wait_for(lambda: len(out) >= 2)
        assert rows() == [("n1", 2, ("odd", "t")), ("n2", 1, ("free",))]
        time.sleep(3)
        assert len(out) == 2  # looked at several times, held
        q.stop()
        q = begin()  # the held file is in the checkpoint
        manifest.put({"nightdate": "n1", "batch_key": "b3"})
        time.sleep(3)
        files.put(file("b", batch="b2"))
        time.sleep(4)
        assert len(out) == 2  # b3 is expected by now
        files.put(file("c", batch="b3"))
        wait_for(lambda: len(out) >= 3)
        assert rows()[0] == ("n1", 2, ("odd", "t")) and ("n1", 5, ("a", "b", "c", "odd", "t")) in rows()
        files.put(file("d"))
        wait_for(lambda: len(out) >= 4)
        assert ("n1", 6, ("a", "b", "c", "d", "odd", "t")) in rows()
    finally:
        q.stop()
