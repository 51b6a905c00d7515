"""The mesh of frames of more than a hundred rows against its SQL."""

import duckdb

from starloom.plans import ORACLES, QUERIES


def test_mesh_of_tall_frames_equals_its_sql(spark, tmp_path):
    spark.range(43_000).selectExpr("id AS event_id", "timestamp'2024-01-01' AS ts", "id % 7 AS user_id", "'click' AS event_type", "CAST(pmod(id * 7919, 1009) AS DOUBLE) AS value").write.parquet(f"{tmp_path}/events.parquet")
    spark.read.parquet("/root/testdata/sf0.001/orders.parquet").write.parquet(f"{tmp_path}/orders.parquet")
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW events AS FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    want = sorted(duck.sql("SELECT k, level, sigma FROM (" + ORACLES["p22_mesh_background"] + ")").fetchall())
    got = sorted(map(tuple, QUERIES["p22_mesh_background"](spark, str(tmp_path)).select("k", "level", "sigma").collect()))
    assert [r[0] for r in got] == [r[0] for r in want]
    assert all(abs(a - b) < 2e-6 for x, y in zip(got, want, strict=True) for a, b in zip(x, y, strict=True))
