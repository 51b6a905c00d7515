"""Queries against their SQL where sources of other keys have the same positions."""

import duckdb
import pytest
from pyspark.sql import functions as F

from starloom.operators import skyjoin
from starloom.plans import ORACLES, QUERIES
from starloom.storage import durable

SF = "/root/testdata/sf0.001"
NAMES = ["a17_catalog_rms", "a17_joint_match_stats", "a17_recalls", "j6_multi_match_inner", "j6_multi_match_left", "j6_multi_match_outer", "j8_drop_close", "j6_multi_match"]


@pytest.fixture(scope="module")
def twice(spark, tmp_path_factory):
    """A folder with sf0.001's orders and the same ones 360,000 keys on."""
    folder = str(tmp_path_factory.mktemp("twice"))
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.unionByName(orders.withColumn("o_orderkey", F.col("o_orderkey") + 360_000)).write.parquet(f"{folder}/orders.parquet")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_sources_of_equal_positions_stay_apart(spark, twice, name):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW orders AS FROM read_parquet('{twice}/orders.parquet/*.parquet')")
    want = duck.sql(ORACLES[name])
    got = QUERIES[name](spark, twice).select(*(f"`{c}`" for c in want.columns)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def test_without_by_equal_positions_are_one_group(spark):
    cats = durable(spark.createDataFrame([(i, i % 2, 10.0, 5.0, i // 2) for i in range(4)], "id long, cat int, ra double, dec double, field long"))
    found = lambda **k: {tuple(r) for r in skyjoin.multi_match(cats, 1.0, durable, **k).select("group", "id").collect()}
    assert found() == {(0, 0), (0, 1)} and found(by="field") == {(0, 0), (0, 1), (2, 2), (2, 3)}
    kept = lambda **k: {r.id for r in skyjoin.drop_close(cats.withColumn("pos", F.col("id")), 1.0, durable, **k).collect()}
    assert kept() == {0} and kept(by="field") == {0, 2}


@pytest.mark.parametrize("name", ["a17_catalog_rms", "a17_joint_match_stats"])
def test_edges_grow_with_the_turns_not_their_square(spark, twice, monkeypatch, name):
    seen, friends = [], skyjoin._friends
    monkeypatch.setattr(skyjoin, "_friends", lambda *a: (e := friends(*a), seen.append(e.count()))[0])
    for folder in (SF, twice):
        QUERIES[name](spark, folder).collect()
    assert seen[1] == 2 * seen[0] > 0
