"""The phased cascade on a small graph: barriers, cycles, reasons; decisions about masters."""

import pytest

from starloom.operators import lineage

IMAGES = "id long, image_type string, process_status_id long, nightdate string, unit string"
CONFIGS = "id long, name string, config_type string, config_file string, config_exists boolean, nightdate string, sanity boolean"


@pytest.fixture(scope="module")
def graph(spark):
    """bias 1 -> darks 2 and 3 -> flat 4 -> singles 5 and 6; dark 3 can't be remade, 5 leads back to dark 2, 7 has no edge, 8 is a coadd of 5 and 6."""
    edges = spark.createDataFrame([(2, 1), (3, 1), (4, 2), (5, 4), (6, 3), (2, 5), (8, 5), (8, 6), (9, 6)], "derived long, source long")
    images = spark.createDataFrame([(1, "bias", 90, "n0", "u"), (2, "dark", 90, "n1", "u"), (3, "dark", 90, "n2", "u"), (4, "flat", 90, "n1", "u"), (5, "science", 50, "n1", "u"), (6, "science", 51, "n2", "u"), (7, "science", 52, "n3", "u"), (8, "science", 53, None, None), (9, "science", 54, "n2", "u")], IMAGES)
    configs = spark.createDataFrame([(1, "n1_u", "preprocess", "/c", True, "n1", None), (2, "n2_u", "preprocess", "/home/x", True, "n2", True), (50, "s50", "science", "/c", True, "n1", None), (51, "s51", "science", "/c", True, "n2", None), (52, "s52", "science", "/c", True, "n3", None), (53, "s53", "science", "/c", True, None, None), (54, "s54", "science", None, True, "n2", None), (55, "s55", "science", "/c", True, "n2", False)], CONFIGS)
    deps = spark.createDataFrame([("s52", "n1_u"), ("s51", "n1_u"), ("s55", "n2_u")], "derived string, source string")
    return edges, images, configs, deps


def test_phases_and_barriers(spark, graph):
    got = {(r.config, r.phase): (r.sweep, r.state, r.reason, r.images, r.stale) for r in lineage.phased_cascade(*graph, spark.createDataFrame([(1,), (77,)], "id long")).collect()}
    home, below = "config file is in a home folder", "below a blocked master"
    assert got == {
        ("n1_u", 1): (2, "run", None, 2, 0), ("n2_u", 1): (2, "blocked", home, 1, 1),
        ("n1_u", 2): (None, "run", None, 1, 0), ("n2_u", 2): (None, "blocked", home, 2, 2),
        ("s50", 3): (None, "run", None, 1, 0), ("s51", 3): (None, "stale", below, 1, 1), ("s52", 3): (None, "run", None, 0, 0), ("s53", 4): (None, "stale", below, 1, 1), ("s54", 3): (None, "skip", "config file is missing", 1, 1),
        ("77", None): (None, "skip", "no such image", 0, 0),
    }


def test_unknown_seeds_and_a_seed_that_leads_nowhere(spark, graph):
    with pytest.raises(ValueError, match="known image"):
        lineage.phased_cascade(*graph, spark.createDataFrame([(77,)], "id long"))
    assert lineage.phased_cascade(*graph, spark.createDataFrame([(7,)], "id long")).count() == 0


def test_decisions(spark):
    wanted = spark.createDataFrame([("g", "bias", 1, 0, True), ("g", "dark", 2, 5, True), ("g", "flat", 3, 5, False), ("h", "bias", 4, 5, True), ("h", "dark", None, 0, False), ("h", "flat", 6, 0, False), ("k", "bias", 7, 3, False)], "group string, kind string, output long, n_raw long, exists boolean")
    given = spark.createDataFrame([("h", "bias", 40)], "group string, kind string, master long")
    reasons = spark.createDataFrame([(2, "regenerated"), (1, "sanity")], "output long, reason string")
    verdicts = spark.createDataFrame([(3, False), (7, False)], "output long, ok boolean")
    found = spark.createDataFrame([(3, 33), (6, 66)], "output long, master long")
    rows = {(r.group, r.kind): (r.action, r.master) for r in lineage.master_decisions(wanted, given, reasons, verdicts, found).collect()}
    assert rows == {("g", "bias"): ("fetch", 1), ("g", "dark"): ("generate", 2), ("g", "flat"): ("fetch another", 33), ("h", "bias"): ("adopt", 40), ("h", "dark"): ("none", None), ("h", "flat"): ("fetch another", 66), ("k", "bias"): ("missing", None)}
    again = {(r.group, r.kind): r.action for r in lineage.master_decisions(wanted, given, reasons, verdicts, found, overwrite=True).collect()}
    assert again["g", "bias"] == "fetch" and again["g", "dark"] == "generate"
