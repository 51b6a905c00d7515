"""The queries opN_<name> over `documents`."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import discriminant, hmm, langid, lexical, media, minhash, mixing, piece_codec, quality, sharding, spelling, suffix_dedup, toxicity
from starloom.llm.common import load, small_batches


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return load(spark, sf_dir, "documents")


def piece_model() -> str:
    """The vocabulary file; STARLOOM_PIECE_MODEL names another."""
    import public_tokenizers

    return os.environ.get("STARLOOM_PIECE_MODEL") or public_tokenizers.path("piece_bpe_32k.model")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_texts(documents(spark, sf_dir), piece_model())


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(documents(spark, sf_dir))


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digests(documents(spark, sf_dir))


def op5_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_classes(documents(spark, sf_dir))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op7_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_language(documents(spark, sf_dir))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_rows(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), load(spark, sf_dir, "labels"))


def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.quality_rules(documents(spark, sf_dir))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(spelling.run_counts(documents(spark, sf_dir)).where("n >= 2")).select("word", "form", "root", "n", "n_near", "form_n")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(documents(spark, sf_dir), load(spark, sf_dir, "benchmark"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discriminant.quality_scores(documents(spark, sf_dir), load(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_suffix_dedup, op2_sentencepiece, op3_language_id, op4_media_columns, op5_near_copies, op6_mix_sources, op7_hmm_score, op8_shards, op9_toxicity, op10_host_rules, op11_spelling_variants, op12_ranked_search, op13_quality_classifier)}


RULE_SQL = {"too_short": "n_words < 20", "repetitive": "100 * n_repeat_words > 30 * n_words", "symbols": "10 * n_symbols > word_chars", "dup_lines": "10 * n_dup_lines > 3 * n_lines"}


def _host_rules_sql() -> str:
    """The measures, the beta prior by moments and the verdicts in DuckDB's SQL."""
    word, gap = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"
    rates = ", ".join(f"sum(CASE WHEN {rule} THEN 1 ELSE 0 END) AS {r}" for r, rule in RULE_SQL.items())
    moments = ", ".join(f"sum({r}) / sum(n) AS m_{r}, var_pop({r} / n) AS v_{r}" for r in RULE_SQL)
    weight = "CASE WHEN hosts < 2 THEN 1.0 WHEN v_{r} > 0 THEN least(1000.0, greatest(1.0, m_{r} * (1 - m_{r}) / v_{r} - 1)) ELSE 1000.0 END"
    ok = " AND ".join("({r} + m_{r} * k_{r}) / (n + k_{r}) <= 0.5".format(r=r) for r in RULE_SQL)
    weights = ", ".join(weight.format(r=r) + f" AS k_{r}" for r in RULE_SQL)
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
     w AS (SELECT *, regexp_extract_all(t, '{word}+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{word}')) AS ls FROM d),
     g AS (SELECT r, i, list_slice(ws, i, i + 7) AS win FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 6, 1))) AS i FROM w)),
     again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM g) WHERE c > 1),
     cover AS (SELECT r, sum(s) AS n_repeat_words FROM (SELECT r, least(8, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 8)) AS s FROM again) GROUP BY r),
     m AS (SELECT doc_id, source, len(ws) AS n_words, length(regexp_replace(t, '{gap}', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
      len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN cover USING (r)),
     h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, {rates} FROM m WHERE source IS NOT NULL GROUP BY source), s AS (SELECT count(*) AS hosts, {moments} FROM h), k AS (SELECT *, {weights} FROM s),
     v AS (SELECT source, {ok} AS host_ok FROM h, k),
     f AS (SELECT *, {RULE_SQL["too_short"]} OR {RULE_SQL["repetitive"]} AS base_failed FROM m)
     SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
     base_failed, NOT base_failed AND coalesce(host_ok, true) AS kept FROM f LEFT JOIN v USING (source)"""


def _spelling_sql() -> str:
    """crc32 by its table over UTF-8 bytes, near words by equal strings with one code point left out, roots by recursion."""
    return r"""WITH RECURSIVE t AS MATERIALIZED (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
     r AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
     c AS (SELECT doc_id, w, count(*) AS k FROM r WHERE length(w) >= 7 GROUP BY ALL),
     b AS (SELECT w, k, flatten(list_transform(string_split(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', w), ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, CAST(unicode(x) AS BIGINT) - 64] END)) AS bytes FROM c),
     h AS (SELECT w, k, xor(list_reduce(list_prepend(4294967295, bytes), lambda x, y: xor(x >> 8, tab[CAST((xor(x, y) & 255) + 1 AS INT)])), 4294967295) AS h FROM b, t),
     g AS (SELECT CASE WHEN h % 31 = 0 THEN concat(left(w, CAST(h % length(w) AS INT)), substr(w, CAST(h % length(w) AS INT) + 2)) ELSE w END AS word, k FROM h),
     v AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM g WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
     d AS MATERIALIZED (SELECT word, i, concat(left(word, CAST(i AS INT) - 1), substr(word, CAST(i AS INT) + 1)) AS less FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
     e AS (SELECT a.word AS a, z.word AS z FROM d a JOIN d z ON a.less = z.less AND a.i = z.i AND a.word <> z.word UNION SELECT d.word, v.word FROM d JOIN v ON v.word = d.less UNION SELECT v.word, d.word FROM d JOIN v ON v.word = d.less),
     s AS (SELECT a, z, n, row_number() OVER (PARTITION BY a ORDER BY n DESC, z) AS p, count(*) OVER (PARTITION BY a) AS n_near FROM e JOIN v ON v.word = e.z),
     f AS MATERIALIZED (SELECT word, CASE WHEN s.n >= 10 * v.n THEN s.z END AS form, v.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN s.n >= 10 * v.n THEN s.n END AS form_n FROM v LEFT JOIN s ON s.a = v.word AND s.p = 1),
     o AS (SELECT word, word AS here, 0 AS step FROM f UNION ALL SELECT o.word, f.form, step + 1 FROM o JOIN f ON f.word = o.here WHERE f.form IS NOT NULL),
     l AS (SELECT word, arg_max(here, step) AS root FROM o GROUP BY word)
     SELECT word, form, root, n, n_near, form_n FROM f JOIN l USING (word)"""


def _ranked_search_sql(top: int = 10) -> str:
    """The same integer sums by joins in DuckDB's SQL."""
    terms = r"unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents), t AS (SELECT r, {terms} AS term FROM d), p AS (SELECT r, term, count(*) AS tf FROM t GROUP BY ALL),
     n AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY r), s AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS l FROM n), f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
     w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM f, s), m AS (SELECT r, 25 + (75 * n * nn) // l AS m FROM n, s),
     b AS (SELECT row_number() OVER () AS i, item_id, text FROM benchmark), q AS (SELECT i, term, count(*) AS k FROM (SELECT i, {terms} AS term FROM b) GROUP BY ALL),
     e AS (SELECT i, r, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY ALL),
     o AS (SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM e JOIN d USING (r) WHERE score > 0)
     SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM o JOIN b USING (i) WHERE rank <= {top}"""


def oracle_sql() -> dict[str, str]:
    return {"op10_host_rules": _host_rules_sql(), "op11_spelling_variants": _spelling_sql(), "op12_ranked_search": _ranked_search_sql()}
