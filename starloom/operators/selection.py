"""Choosing images by their metrics: suggested cuts, their application, and quality criteria."""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.stats import median_nmad

#: On which side a metric is bad.
WORSE = {"seeing": "high", "ellipmn": "high", "skyval": "high", "ul5_5": "low"}
ZERO_IS_MISSING = ("seeing", "ellipmn", "ul5_5")


def missing_zeros(df: DataFrame, columns=ZERO_IS_MISSING) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0.0)) for c in columns if c in df.columns})


def suggest_cuts(df: DataFrame, keys: list[str], metrics: dict[str, str], n_sigma: float = 3.0) -> DataFrame:
    """(keys, metric, cut): median plus or minus n robust sigmas on the bad side.

    Sigma is the scaled median deviation, the standard deviation (n) if that is 0, and 0 for under two values."""
    long = df.select(*keys, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v"), F.lit(1.0 if side == "high" else -1.0).alias("sign")) for m, side in metrics.items()])).alias("x")).select(*keys, "x.*").where("v IS NOT NULL")
    by = [*keys, "metric", "sign"]
    dev = median_nmad(long, by, "v", bounded=False).withColumnRenamed("nmad", "mad").join(long.groupBy(*by).agg(F.stddev_pop("v").alias("sd")), by)
    sigma = F.when(F.col("n") < 2, 0.0).when(F.col("mad") > 0, F.col("mad")).otherwise(F.col("sd"))
    return dev.select(*keys, "metric", (F.col("med") + F.col("sign") * n_sigma * sigma).alias("cut"))


def mask_of(bits: str) -> int:
    """Number of a bit string, highest bit first."""
    return int(bits, 2)


def parse_cuts(text: str) -> list[tuple[str, str, float | int]]:
    """`metric<=v`, `metric>=v` and `metric=bits`, separated by blanks or commas."""
    out: list[tuple[str, str, float | int]] = []
    for item in re.split(r"[\s,]+", text.strip()):
        m = re.fullmatch(r"(\w+)(<=|>=|=)(\S+)", item)
        if not m:
            raise ValueError(f"not a cut: {item!r}")
        out.append((m[1], m[2], mask_of(m[3]) if m[2] == "=" else float(m[3])))
    return out


def failing(cut: tuple[str, str, float | int]) -> Column:
    """True where a row fails a cut; null never fails, and a bit mask lists the bits that are allowed."""
    c, op, v = cut
    bad = F.col(c) > v if op == "<=" else F.col(c) < v if op == ">=" else F.col(c).bitwiseAND(F.lit(~int(v) & 0x7FFFFFFF)) != 0
    return F.coalesce(bad, F.lit(False))


def apply_cuts(df: DataFrame, cuts) -> DataFrame:
    """Adds keep."""
    return df.withColumn("keep", ~functools.reduce(operator.or_, (failing(c) for c in cuts), F.lit(False)))


def rejection_counts(df: DataFrame, cuts) -> DataFrame:
    """(metric, total, alone): rows that fail each cut, and that fail it only."""
    n_failed = functools.reduce(operator.add, (failing(c).cast("int") for c in cuts))
    counted = df.withColumn("_n", n_failed).agg(*[f.alias(f"{k}{i}") for i, c in enumerate(cuts) for k, f in (("t", F.count_if(failing(c))), ("a", F.count_if(failing(c) & (F.col("_n") == 1))))])
    return counted.select(F.explode(F.array(*[F.struct(F.lit(c[0]).alias("metric"), F.col(f"t{i}").alias("total"), F.col(f"a{i}").alias("alone")) for i, c in enumerate(cuts)])).alias("x")).select("x.*")


CHECKS = {"eq": operator.eq, "neq": operator.ne, "gt": operator.gt, "gte": operator.ge, "lt": operator.lt, "lte": operator.le}
#: Quality criteria by image type, as (key, criterion, value or bounds).
CRITERIA = {
    "bias": [("clipmed", "within", (512, 514)), ("clipstd", "lte", 2.5)],
    "dark": [("clipstd", "lte", 2.8)],
    "flat": [("clipmax", "lt", 1.3), ("clipmin", "gt", 0.7), ("edgevar", "lt", 0.6), ("sigmean", "lt", 0.04)],
    "science": [("numfrac", "gt", 0.05), ("ellipmn", "lt", 0.3), ("ellip", "lt", 0.3)],
}


def first_failure(criteria, columns) -> Column:
    """Name of the first criterion that fails; null if none. Keys that are absent or null pass."""
    tests = []
    for key, kind, v in criteria:
        if key not in columns:
            continue
        c = F.col(key)
        ok = c.between(*v) if kind == "within" else CHECKS[kind](c, v)
        tests.append(F.when(~F.coalesce(ok, F.lit(True)), F.lit(key)))
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")


def apply_criteria(df: DataFrame, kind: str = "image_type", criteria=CRITERIA) -> DataFrame:
    """Adds rejected_by and sanity for rows of each image type."""
    by = F.coalesce(*[F.when(F.col(kind) == k, first_failure(rules, df.columns)) for k, rules in criteria.items()])
    return df.withColumn("rejected_by", by).withColumn("sanity", by.isNull())


def sanity_action(human: Column, sanity: Column, stage: Column, rejected_at: Column, overwrite: bool) -> Column:
    """keep, reject or recompute: a human verdict wins; False stays unless overwritten at or before the stage that rejected."""
    return (F.when(human.isNotNull(), "keep").when((sanity == F.lit(False)) & ~(F.lit(overwrite) & (stage <= rejected_at)), "reject").when((sanity == F.lit(True)) & ~F.lit(overwrite), "keep").otherwise("recompute"))


def first_key(df: DataFrame, candidates: list[str]) -> str | None:
    """The first candidate that has any value; one row reaches the driver."""
    row = df.agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in candidates]).first()
    return next((c for c in candidates if row[c]), None)
