"""Shards from a Feistel permutation of global row numbers (DataFrame operations only).

Row numbers run over rows in order of (hash bucket, id, size, crc): counts per bucket give each bucket's first number, and
a window inside the bucket the rest, so no task holds more than a bucket. A four-round Feistel network on the pair
(number div b, number mod b) with a * b >= N and a, b near the root of N permutes [0, a * b); fewer than a numbers of
it lie beyond N, and cycle walking carries those back inside. Shard and slot are the remainder and quotient of the
permuted number by the shard count: counts differ by at most one, slots have no gaps, and both can be computed for
any row number alone.

Edge cases: null text has size 1 and crc 0; null ids sort first; repeated rows get different slots; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.common import crc_of, durable, n_bytes

PRIME = (1 << 31) - 1
ROUNDS = ((48271, 11939), (69621, 40014), (16807, 60221), (39373, 27183), (45742, 31415), (50124, 57721))
"""Multiplier and offset of each round, arbitrary."""


def domain(n: int) -> tuple[int, int]:
    """a, b with a * b >= n, as near as may be to a square."""
    b = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return max(1, -(-n // b)), b


def feistel(x: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the network over [0, a * b): left and right in turn are shifted by a keyed function of the other."""
    keys = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit((c + 7919 * seed) % PRIME).cast("long").alias("c")) for m, c in ROUNDS])

    def f(v: Column, k: Column) -> Column:
        y = (v + k["c"]) % PRIME
        y = (y * y + k["m"]) % PRIME
        y = (y * k["m"] + k["c"]) % PRIME
        return y * y % PRIME

    both = F.aggregate(
        keys, F.struct((x / F.lit(b)).cast("long").alias("l"), F.lit(0).cast("long").alias("i"), (x % b).alias("r")),
        lambda s, k: F.struct(
            F.when(s["i"] % 2 == 0, (s["l"] + f(s["r"], k)) % a).otherwise(s["l"]).alias("l"), (s["i"] + 1).alias("i"),
            F.when(s["i"] % 2 == 1, (s["r"] + f(s["l"], k)) % b).otherwise(s["r"]).alias("r")),
    )
    return F.aggregate(F.array(both), F.lit(0).cast("long"), lambda _, s: s["l"] * b + s["r"])


def feistel_of(x: int, a: int, b: int, seed: int) -> int:
    """The same network on one number, for looking up the place of a single row."""
    left, right = divmod(x, b)
    for i, (m, c) in enumerate(ROUNDS):
        c = (c + 7919 * seed) % PRIME
        y = ((right if i % 2 == 0 else left) + c) % PRIME
        y = (y * y + m) % PRIME
        y = (y * m + c) % PRIME
        y = y * y % PRIME
        if i % 2 == 0:
            left = (left + y) % a
        else:
            right = (right + y) % b
    return left * b + right


def walks(n: int, seed: int) -> int:
    """Passes that bring every number of [0, n) back inside: one more than the longest chain of numbers outside.

    Only the numbers outside are looked at, fewer than the root of n; those on cycles that never come inside are
    never met from inside."""
    a, b = domain(n)
    after = {x: feistel_of(x, a, b, seed) for x in range(n, a * b)}
    starts, longest = set(after) - set(after.values()), 0
    for x in starts:
        steps = 0
        while x >= n:
            x, steps = after[x], steps + 1
        longest = max(longest, steps)
    return longest + 1


def permuted(x: Column, n: int, seed: int, steps: int) -> Column:
    """The cycle-walking permutation of [0, n)."""
    a, b = domain(n)
    once = feistel(x, a, b, seed)
    if steps == 1:
        return once
    return F.aggregate(F.sequence(F.lit(2), F.lit(steps)), once, lambda y, _: F.when(y < n, y).otherwise(feistel(y, a, b, seed)))


def shard_rows(docs: DataFrame, shards: int = 8, seed: int = 5, buckets: int = 4096) -> DataFrame:
    """(doc_id, size, text_crc32, row_number, shard, slot) for each row of docs (doc_id, text)."""
    rows = durable(docs.select("doc_id", (n_bytes(F.col("text")) + 1).alias("size"), crc_of(F.col("text")).alias("text_crc32"))
                   .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets)).cast("int")))
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    # at most `buckets` rows meet in one task here, whatever the input
    firsts = counts.select("bucket", (F.sum("n").over(W.orderBy("bucket")) - F.col("n")).alias("first"))
    n = rows.count()
    inside = W.partitionBy("bucket").orderBy("doc_id", "size", "text_crc32")
    numbered = rows.withColumn("k", F.row_number().over(inside)).join(F.broadcast(firsts), "bucket").withColumn("row_number", F.col("first") + F.col("k") - 1)
    out = numbered.withColumn("_y", permuted(F.col("row_number"), n, seed, walks(n, seed)))
    return out.select("doc_id", "size", "text_crc32", "row_number", (F.col("_y") % shards).cast("int").alias("shard"), F.floor(F.col("_y") / shards).cast("long").alias("slot"))
