"""Quality rules at the level of hosts (DataFrame operations only).

Every document gets its own measures and rule failures. Failures are summed by host (the `source` column), the failure
rate of each rule is shrunk towards the corpus with a beta prior fitted to all hosts by moments, and a host whose
shrunk rate exceeds the rule's limit is rejected with all its documents.

Edge cases: null or empty text has no words and fails the length rule; documents with a null host are judged alone;
an empty table gives an empty result; other columns are ignored; repeated rows are measured each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import WORD, durable

WINDOW = 8
SYMBOLS = "#*$%&|<>"
RULES = ("too_short", "repetitive", "symbols", "dup_lines")
HOST_LIMIT = 0.5
"""A host is rejected if the shrunk failure rate of any rule is above this."""


def repeat_words(words: Column) -> Column:
    """Words inside windows of eight words that occur twice or more in the array, the first occurrence included.

    Hashes of the windows decide quickly that nothing repeats; otherwise the windows themselves are compared, with
    their positions, in sorted order."""
    n = F.size(words) - (WINDOW - 1)
    places = F.sequence(F.lit(1), n)
    hashes = F.transform(places, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    windows = F.array_sort(F.transform(places, lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("w"), i.alias("i"))))

    def again(sorted_windows: Column) -> Column:
        same = F.zip_with(sorted_windows, F.slice(sorted_windows, 2, F.size(sorted_windows)), lambda a, b: F.struct(a["i"].alias("i"), b["i"].alias("j"), F.coalesce(a["w"] == b["w"], F.lit(False)).alias("same")))
        hit = F.filter(same, lambda s: s["same"])
        return F.array_sort(F.array_union(F.transform(hit, lambda s: s["i"]), F.transform(hit, lambda s: s["j"])))

    def covered(starts: Column) -> Column:
        steps = F.zip_with(starts, F.slice(starts, 2, F.size(starts)), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda s, x: s + x)

    def once(value: Column, f) -> Column:
        """f(value) with value computed once."""
        return F.element_at(F.transform(F.array(value), f), 1)

    slow = once(once(windows, again), covered)
    fast = once(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when(n < 2, 0).when(fast, 0).otherwise(slow).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) for each row of docs (doc_id, source, text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
    rows = docs.select("doc_id", F.col("source").alias("host"), text.alias("t"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"), lines.alias("lines"))
    return rows.select(
        "doc_id", "host", F.size("words").cast("long").alias("n_words"), F.length(F.translate("t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"), repeat_words(F.col("words")).alias("n_repeat_words"),
    )


def failures(rows: DataFrame) -> DataFrame:
    """Adds a boolean per rule and base_failed."""
    return rows.withColumns({
        "too_short": F.col("n_words") < 20, "repetitive": 100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("word_chars"), "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
    }).withColumn("base_failed", F.col("too_short") | F.col("repetitive"))


def host_verdicts(rows: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n, shrunk_<rule>..., host_ok): beta prior from the mean m and variance v of the hosts' rates.

    Its weight is m(1 - m)/v - 1, held within [1, 1000]; where hosts agree fully or one host is all there is, it is
    1000 or 1. The corpus numbers that reach the driver are two for each rule."""
    hosts = rows.where("host is not null").groupBy("host").agg(F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES])
    rates = {r: F.col(r) / F.col("n") for r in RULES}
    stats = hosts.agg(F.count("*").alias("hosts"), *[f.alias(f"{k}_{r}") for r in RULES for k, f in (("m", F.sum(r) / F.sum("n")), ("v", F.var_pop(rates[r])))]).first()
    shrunk = {}
    for r in RULES:
        m, v = stats[f"m_{r}"] or 0.0, stats[f"v_{r}"] or 0.0
        weight = 1.0 if (stats["hosts"] or 0) < 2 else min(1000.0, max(1.0, m * (1 - m) / v - 1)) if v > 0 else 1000.0
        shrunk[f"shrunk_{r}"] = (F.col(r) + F.lit(m * weight)) / (F.col("n") + F.lit(weight))
    ok = F.lit(True)
    for c in shrunk.values():
        ok = ok & (c <= limit)
    return hosts.select("host", "n", *[c.alias(k) for k, c in shrunk.items()], ok.alias("host_ok"))


def quality_rules(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """Measures, rule failures, the host's shrunk rates and verdict, and kept for each row of docs."""
    rows = durable(failures(measures(docs)))
    hosts = host_verdicts(rows, limit)
    return rows.join(hosts, "host", "left").withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("host_ok"), F.lit(True)))
