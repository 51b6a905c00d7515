"""Mixing sources to target weights by pivotal dependent rounding (DataFrame operations only).

Each source gets a target number of words; a document of a source with rate r = target / source_size is taken
floor(r) times, and once more with the fractional probability. The extra copies are chosen dependently: within a
block, a running document and the next one exchange probability until one of them is 0 or 1. What is left of a block
is one document with a fraction, which meets the other blocks' leftovers on the next level of a reduction tree, first
inside (source, size band), then across the bands of a source in falling order of size. So the number of copies is
kept exactly in every band up to the last leftover and the words of a source come near its target.

Probabilities are integers in units of 2**-30 and the random numbers are hashes of the ids, so reruns agree whatever
the partitioning. Hot sources are split into blocks by a hash of the id; no group exceeds some tens of rows.

Edge cases: null text has size 0; documents of size 0 are never taken; null source is a source of its own, ranked
last; sources without words have target 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.common import WORD, durable

UNIT = 1 << 30
BLOCK = 64
BANDS_PER_DOUBLING = 4


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """(skey, source_size, target) from (skey, size): weights repeat over the sources in order of code points, null last.

    Sharing out T by weight with the caps most * size, and the excess again among the rest, ends at min(cap, level *
    weight) for the one level at which the targets add up to T; over sources in order of cap / weight, that level is
    the largest of the levels that follow from capping each prefix."""
    per = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    order = W.orderBy("skey")
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * F.lit(float(most))
    everything = W.partitionBy()
    before = W.orderBy(cap / F.col("weight"), "skey").rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    share = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level", left / share)
    return per.select("skey", "source_size", F.least(cap, F.max("level").over(everything) * F.col("weight")).alias("target"))


def _round_block(items: Column, seed: int) -> Column:
    """Pivotal rounding along an array: struct(rest: the one item left with a fraction, done: the decided ones)."""
    def decided(x: Column, extra: Column) -> Column:
        return F.struct(x["doc_id"].alias("doc_id"), x["text_hash"].alias("text_hash"), x["size"].alias("size"), (x["copies"] + extra).alias("copies"), x["source_size"].alias("source_size"), x["target"].alias("target"))

    def with_p(x: Column, p: Column) -> Column:
        return F.struct(x["neg"].alias("neg"), x["tie"].alias("tie"), x["doc_id"].alias("doc_id"), x["text_hash"].alias("text_hash"), x["size"].alias("size"), x["copies"].alias("copies"), x["source_size"].alias("source_size"), x["target"].alias("target"), p.alias("p"))

    def step(s: Column, x: Column) -> Column:
        r, u = s["rest"], F.pmod(F.xxhash64(s["rest"]["tie"], x["tie"], F.lit(seed)), F.lit(UNIT))
        total = r["p"] + x["p"]
        below = total < UNIT
        keep = F.when(below, u * total < r["p"] * UNIT).otherwise(u * (2 * UNIT - total) >= (UNIT - x["p"]) * UNIT)  # r goes on
        p = F.when(below, total).otherwise(total - UNIT)
        extra = F.when(below, 0).otherwise(1).cast("long")
        return F.struct(
            F.when(keep, with_p(r, p)).otherwise(with_p(x, p)).alias("rest"),
            F.concat(s["done"], F.array(F.when(keep, decided(x, extra)).otherwise(decided(r, extra)))).alias("done"),
        )

    first = F.struct(items[0].alias("rest"), F.filter(F.transform(items, lambda x: decided(x, F.lit(0).cast("long"))), lambda x: F.lit(False)).alias("done"))
    return F.aggregate(F.slice(items, 2, F.size(items)), first, step)


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, seed: int = 11) -> DataFrame:
    """(doc_id, text_hash, size, source_size, target, copies, taken) for each row of docs (doc_id, source, text)."""
    base = durable(docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("t")).alias("skey"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64("text").alias("text_hash"),
    ))
    return round_copies(base, source_targets(base, weights, most), seed)


def round_copies(base: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    parts = F.round((F.col("rate") - F.floor("rate")) * UNIT).cast("long")
    rows = base.join(targets, "skey").withColumn("rate", rate)
    rows = rows.select(
        "skey", F.floor(F.log2(F.col("size") + 1.0) * BANDS_PER_DOUBLING).cast("int").alias("band"),
        (-F.col("size")).alias("neg"), F.xxhash64("doc_id", "text_hash").alias("tie"), "doc_id", "text_hash", "size",
        F.when(F.col("size") == 0, 0).otherwise(F.floor("rate").cast("long") + F.when(parts >= UNIT, 1).otherwise(0)).alias("copies"), "source_size", "target",
        F.when((parts >= UNIT) | (F.col("size") == 0), F.lit(0).cast("long")).otherwise(parts).alias("p"),
    )
    rows = durable(rows)
    item = F.struct("neg", "tie", "doc_id", "text_hash", "size", "copies", "source_size", "target", "p")
    out = ("doc_id", "text_hash", "size", "copies", "source_size", "target")
    done = [rows.where("p = 0").select(*out)]
    rest, level = rows.where("p > 0"), 0
    while True:
        # one number to the driver: the largest (source, band)
        counts = rest.groupBy("skey", "band").agg(F.count("*").alias("n"))
        largest = counts.agg(F.max("n")).first()[0] or 0
        if largest <= 1:
            break
        blocks = F.ceil(F.col("n") / F.lit(BLOCK / 2)).cast("long")
        spread = rest.join(counts, ["skey", "band"]).withColumn("block", F.pmod(F.xxhash64("tie", F.lit(level)), F.when(F.col("n") <= BLOCK, 1).otherwise(blocks)))
        rounded = durable(spread.groupBy("skey", "band", "block").agg(F.sort_array(F.collect_list(item)).alias("items")).select("skey", "band", _round_block(F.col("items"), seed + level).alias("r")))
        done.append(rounded.select(F.explode("r.done").alias("d")).select("d.*").select(*out))
        rest, level = rounded.select("skey", "band", "r.rest.*"), level + 1
    last = durable(rest.groupBy("skey").agg(F.sort_array(F.collect_list(item)).alias("items")).select(_round_block(F.col("items"), seed + level).alias("r")))
    done.append(last.select(F.explode("r.done").alias("d")).select("d.*").select(*out))
    final = F.col("copies") + F.when(F.pmod(F.xxhash64("tie", F.lit(seed + 1000)), F.lit(UNIT)) < F.col("p"), 1).otherwise(0)
    done.append(last.select("r.rest.*").select("doc_id", "text_hash", "size", final.alias("copies"), "source_size", "target"))
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.withColumn("taken", F.col("copies") * F.col("size"))


def expand_copies(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mixed corpus itself: each document as often as it is taken. Rows that are equal in id and text share evenly what
    they are taken together; columns may have any names."""
    none, number = F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("number")
    times = mixed.groupBy(none, number, "text_hash").agg(F.sum("copies").alias("copies"), F.count("*").alias("equal")).where("copies > 0")
    rows = docs.select(none, number, F.xxhash64("text").alias("text_hash"), F.struct("*").alias("row"))
    joined = rows.join(times, ["none", "number", "text_hash"])
    place = F.row_number().over(W.partitionBy("none", "number", "text_hash").orderBy("number"))
    share = F.expr("copies div equal") + (place <= F.col("copies") % F.col("equal")).cast("long")
    return joined.withColumn("share", share).where("share > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("share").cast("int")))).select("row.*")
