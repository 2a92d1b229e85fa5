"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import (
    decontaminate, importance, language_id, license_scan, line_dedup, mixing, phrases, quality_model, quality_rules,
    secret_scan, sharding, simhash, warc,
)
from tablewright.sources.tables import load_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return add


@query("op1_decontaminate")
def op1(spark, sf_dir):
    return decontaminate.leaks(load_table(spark, sf_dir, "documents"),
                               load_table(spark, sf_dir, "benchmark"))


@query("op2_language_id")
def op2(spark, sf_dir):
    return language_id.language_report(load_table(spark, sf_dir, "documents"))


@query("op3_quality_classifier")
def op3(spark, sf_dir):
    return quality_model.quality_scores(load_table(spark, sf_dir, "documents"),
                                        load_table(spark, sf_dir, "labels"))


@query("op4_line_dedup")
def op4(spark, sf_dir):
    return line_dedup.dedup_report(load_table(spark, sf_dir, "documents"))


@query("op5_license_scan")
def op5(spark, sf_dir):
    return license_scan.license_report(load_table(spark, sf_dir, "documents"))


@query("op6_simhash_near_dedup")
def op6(spark, sf_dir):
    return simhash.near_duplicates(load_table(spark, sf_dir, "documents"))


@query("op7_mixing")
def op7(spark, sf_dir):
    return mixing.mixing_report(load_table(spark, sf_dir, "documents"),
                                load_table(spark, sf_dir, "labels"))


@query("op8_quality_rules")
def op8(spark, sf_dir):
    return quality_rules.quality_report(load_table(spark, sf_dir, "documents"))


@query("op9_sharding")
def op9(spark, sf_dir):
    return sharding.shard_report(load_table(spark, sf_dir, "documents"))


@query("op10_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d,
                  strlen(coalesce(html, '')) AS n FROM pages),
     g AS (SELECT d, max(page_id) AS keeper FROM p GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM p JOIN g USING (d)""")
def op10(spark, sf_dir):
    return warc.capture_report(load_table(spark, sf_dir, "pages"))


@query("op11_importance_resampling")
def op11(spark, sf_dir):
    return importance.resample_report(load_table(spark, sf_dir, "documents"),
                                      load_table(spark, sf_dir, "benchmark"))


@query("op12_secret_scan")
def op12(spark, sf_dir):
    return secret_scan.secret_report(load_table(spark, sf_dir, "documents"))


@query("op13_phrase_mining", r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
             SELECT lang, unnest(regexp_split_to_array(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL)),
     g AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS f
           FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
                 FROM p, (SELECT unnest([1, 2, 3, 4]) AS k)) GROUP BY ALL),
     n AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
     c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND f >= 30),
     cut AS (SELECT lang, phrase, a, i, array_to_string(w[1:i], ' ') AS first, array_to_string(w[i + 1:], ' ') AS rest
             FROM (SELECT *, unnest(range(1, k)) AS i FROM c)),
     s AS (SELECT cut.lang, cut.phrase, a, i, x.f AS l, y.f AS r,
                  ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
           FROM cut JOIN g x ON x.lang = cut.lang AND x.phrase = cut.first
                    JOIN g y ON y.lang = cut.lang AND y.phrase = cut.rest),
     low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
     inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
                FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c))
                GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, score
FROM low LEFT JOIN inside USING (lang, phrase) JOIN n USING (lang)
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
QUALIFY rank <= 2000""")
def op13(spark, sf_dir):
    return phrases.collocations(load_table(spark, sf_dir, "documents"))
