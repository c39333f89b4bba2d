"""The registered queries of this package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from appmart.session import run_dir

from . import (decontaminate, html_extract, lm_score, mixing, nearest_neighbours, ngram_jaccard, periodic_runs,
               quality_rules, sharding, substring_dedup, url_filter, warc, whitening)
from .store import materialise

SHINGLE_WORDS, SIMILAR_PERCENT = 3, 90
SHARDS = 24
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]
#: The audit drill damages the first byte of the pages for which this is 5.
DAMAGE_MODULUS, DAMAGE_REST = 997, 5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components and numbers of links of all documents under 3-word Jaccard of at least 0.9."""
    found = ngram_jaccard.similar_components(_table(spark, sf_dir, "documents"), SHINGLE_WORDS, SIMILAR_PERCENT,
                                             count_links=True)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: 24 shards whose row counts differ by at most one."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    placed = sharding.shard_rows(docs, SHARDS)
    return placed.select("d.*", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or model verdict for the url of every page."""
    model = url_filter.train(url_filter.labelled_urls(spark))
    judged = url_filter.judge(_table(spark, sf_dir, "pages"), "url", ["page_id"], URL_RULES, model)
    return judged.select("d.page_id", "host", "path", "rule", "verdict")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select("d.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract_pages(_table(spark, sf_dir, "pages"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model and base score of every document."""
    return lm_score.score(_table(spark, sf_dir, "documents"))


def op7_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as two WARC replicas, the second with known damage, and audit them."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    hit = ((F.pmod(F.crc32(F.col("page_id").cast("string").cast("binary")), F.lit(DAMAGE_MODULUS)) == DAMAGE_REST)
           & F.col("html").startswith("<"))
    damaged = pages.withColumn("html", F.when(hit, F.concat(F.lit("~"), F.expr("substring(html, 2)")))
                               .otherwise(F.col("html")))
    folders = [run_dir(spark, f"warc-{side}") for side in ("first", "second")]
    for rows, folder in zip((pages, damaged), folders):
        warc.write_replica(rows, folder)
    return warc.audit(*[warc.read_records(spark, f) for f in folders]).select("page_id", "length", "digest", "status")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked benchmark items of every document."""
    judged = decontaminate.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), ["doc_id"])
    return judged.select("d.doc_id", (F.size("items") > 0).alias("leaked"), F.size("items").cast("long").alias("n_items"),
                         F.array_join(F.transform("items", lambda i: i.cast("string")), ",").alias("items"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors, rate and copies of every document."""
    rated = mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), keep=["doc_id"])
    return rated.select("d.doc_id", "tokens", *[F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(mixing.DOMAINS)],
                        "rate", "copies")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that each document shares with others or holds again itself."""
    found = substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", F.size("spans").cast("long").alias("n_passages"), "n_repeated_words",
                        F.array_join(F.transform("spans", lambda x: F.concat_ws("-", x["start"], x["end"])), ",")
                        .alias("passages"), "first_doc_id",
                        F.array_join(F.transform("classes", lambda x: F.concat(x["start"].cast("string"), F.lit("-"),
                            x["end"].cast("string"), F.lit(":"), x["class_id"].cast("string"))), ",").alias("classes"))


def planted_period(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a tenth of the documents, from some word on repeated with a period; both follow from the id."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least four periods and six words in every document, a tenth of them with a planted period."""
    found = periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"), ["doc_id"], key="doc_id",
                                        edit=planted_period)
    return materialise(periodic_runs.digests(found).select("d.doc_id", *[
        "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]), "runs")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 32 whitened components of every embedding."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), "embedding", ["vec_id"]).select(
        "d.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest embeddings of each one whose id is divisible by 100."""
    return nearest_neighbours.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_ngram_jaccard": op1_ngram_jaccard, "op2_sharding": op2_sharding, "op3_url_filter": op3_url_filter, "op4_quality_rules": op4_quality_rules,
            "op5_html_extract": op5_html_extract, "op6_lm_score": op6_lm_score, "op7_warc_audit": op7_warc_audit, "op8_decontaminate": op8_decontaminate, "op9_mixing": op9_mixing,
            "op10_substring_dedup": op10_substring_dedup, "op11_periodic_runs": op11_periodic_runs,
            "op12_embedding_whitening": op12_embedding_whitening, "op13_nearest_neighbours": op13_nearest_neighbours}


_Q = quality_rules
OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
pos AS (SELECT rid, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS k FROM pos) WHERE k > 1),
rep AS (SELECT rid, count(DISTINCT i + o) AS n FROM again, (SELECT unnest([0, 1, 2]) AS o) GROUP BY rid),
lines AS (SELECT rid, line FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT rid, count(*) AS n, count(*) - count(DISTINCT line) AS dups FROM lines GROUP BY rid),
s AS (SELECT d.rid, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        len(regexp_extract_all(t, '\p{Lu}')) AS n_capitals, coalesce(dup.n, 0) AS n_lines,
        CAST(coalesce(dup.dups, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM d JOIN w ON w.rid = d.rid LEFT JOIN rep ON rep.rid = d.rid LEFT JOIN dup ON dup.rid = d.rid),
r AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS word_length,
        CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols,
        CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_lines,
        CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeats,
        CASE WHEN word_chars > 0 THEN n_capitals / word_chars ELSE 0 END AS capitals FROM s),
""" + ",\n".join(
    f"{tag} AS (SELECT {keys} count(*) AS n, " + ", ".join(
        f"quantile_disc({m}, 0.25) AS {m}1, quantile_disc({m}, 0.75) AS {m}3" for m in _Q.RATIOS)
    + f" FROM r WHERE NOT base_failed{group})"
    for tag, keys, group in (("own", "lang, source,", " GROUP BY lang, source"),
                             ("bylang", "lang,", " GROUP BY lang"), ("corpus", "", ""))) + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  coalesce(NOT base_failed AND """ + " AND ".join(
    " AND ".join([f"{m} <= CASE " + " ".join(
        f"WHEN {t}.n >= {k} THEN {t}.{m}3 + 3 * greatest({t}.{m}3 - {t}.{m}1, {least})"
        for t, k in (("own", _Q.MIN_GROUP_ROWS), ("bylang", _Q.MIN_GROUP_ROWS), ("corpus", 0))) + " END"]
        + ([f"{m} >= CASE " + " ".join(
            f"WHEN {t}.n >= {k} THEN {t}.{m}1 - 3 * greatest({t}.{m}3 - {t}.{m}1, {least})"
            for t, k in (("own", _Q.MIN_GROUP_ROWS), ("bylang", _Q.MIN_GROUP_ROWS), ("corpus", 0))) + " END"]
           if both else []))
    for m, (least, both) in _Q.RATIOS.items()) + """, false) AS kept
FROM r LEFT JOIN own ON r.lang IS NOT DISTINCT FROM own.lang AND r.source IS NOT DISTINCT FROM own.source
LEFT JOIN bylang ON r.lang IS NOT DISTINCT FROM bylang.lang CROSS JOIN corpus
"""

OP8_SQL = r"""
WITH dw AS (SELECT row_number() OVER () AS rid, doc_id,
        list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS ws FROM documents),
iw AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'),
        lambda w: w <> '') AS ws FROM benchmark),
ds AS (SELECT rid, p, array_to_string(ws[p:p + 4], ' ') AS s
       FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS p FROM dw WHERE len(ws) >= 5)),
its AS (SELECT item_id, m, array_to_string(ws[o:o + 4], ' ') AS s
        FROM (SELECT item_id, ws, len(ws) - 4 AS m, unnest(range(1, len(ws) - 3)) AS o FROM iw WHERE len(ws) >= 5)),
ic AS (SELECT item_id, m, s, count(*) AS ci FROM its GROUP BY ALL),
hits AS (SELECT rid, p, item_id, m, s, ci FROM ds JOIN ic USING (s)),
starts AS (SELECT DISTINCT rid, item_id, m, unnest(range(greatest(1, p - m + 1), p + 1)) AS st FROM hits),
fit AS (SELECT starts.* FROM starts JOIN dw USING (rid) WHERE st + m - 1 <= len(ws) - 4),
cnt AS (SELECT f.rid, f.item_id, f.m, f.st, h.s, h.ci, count(*) AS cw FROM fit f JOIN hits h
        ON h.rid = f.rid AND h.item_id = f.item_id AND h.p BETWEEN f.st AND f.st + f.m - 1 GROUP BY ALL),
sim AS (SELECT rid, item_id, m, st, sum(least(ci, cw)) AS i FROM cnt GROUP BY ALL),
leak AS (SELECT rid, list_sort(list(DISTINCT item_id)) AS items FROM sim WHERE i >= 0.8 * (2 * m - i) GROUP BY rid)
SELECT doc_id, items IS NOT NULL AS leaked, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
    coalesce(array_to_string(items, ','), '') AS items
FROM dw LEFT JOIN leak USING (rid)
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_quality_rules": OP4_SQL, "op8_decontaminate": OP8_SQL}
