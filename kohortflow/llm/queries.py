"""One query per operator over its whole table, and the same in DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kohortflow.llm import chat, lattice, mixing, near_dups, packing, pages, quality, reputation, runs, substrings, topk, warc, whitening
from kohortflow.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"))


def op2_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    return near_dups.components(table(spark, folder, "documents"))


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.removals(table(spark, folder, "documents"))


def op4_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extracted(table(spark, folder, "pages"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"), f"{scratch_dir(spark, 'warc')}/archives")


def op6_chat_repair(spark: SparkSession, folder: str) -> DataFrame:
    return chat.repair(table(spark, folder, "conversations"))


def op7_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Labels are of documents; a page's outcome is the label with its number: good if of quality and not toxic."""
    labels = table(spark, folder, "labels").selectExpr("doc_id AS page_id", "int(quality = 1 AND coalesce(toxic, 0) = 0) AS good")
    return reputation.judged(table(spark, folder, "pages"), labels).drop("bound")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), tokenizer_path())


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digests(runs.periodic_runs(table(spark, folder, "documents"), plant=True))


def op13_lattice_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.scores(table(spark, folder, "documents"), vocabulary_path())


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_quality_rules, op2_near_dups, op3_substring_dedup, op4_page_text, op5_warc, op6_chat_repair, op7_top_k, op8_url_filter, op9_packing, op10_mixing, op11_whitening, op12_periodic_runs, op13_lattice_scores)}


OP1_SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (
    SELECT doc_id, unnest(generate_series(1, len(w) - 2)) AS i, w FROM words),
windows AS (
    SELECT doc_id, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS g FROM places),
again AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (
    SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY doc_id),
lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words),
line_counts AS (
    SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
measured AS (
    SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
           CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(w.text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(coalesce(l.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(l.dup, 0) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
           CAST(len(regexp_extract_all(w.text, '\p{Lu}')) AS BIGINT) AS n_upper
    FROM words w LEFT JOIN repeats r USING (doc_id) LEFT JOIN line_counts l USING (doc_id)),
failed AS (
    SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
        + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
        + (CASE WHEN 5 * n_symbols > n_words THEN 4 ELSE 0 END)
        + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
        + (CASE WHEN 2 * n_upper > word_chars THEN 16 ELSE 0 END)
        + (CASE WHEN word_chars > 25 * n_words THEN 32 ELSE 0 END) AS BIGINT) AS failed_bits
    FROM measured)
SELECT *, failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept FROM failed"""


OP5_SQL = r"""
WITH p AS (
    SELECT page_id, sha1(encode(coalesce(html, ''))) AS hex, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages),
d AS (
    SELECT page_id, n, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> (15 - 5 * j)) & 31), 1), '' ORDER BY i, j) AS digest
    FROM (SELECT page_id, n, i, CAST(concat('0x', substr(hex, 1 + 5 * i, 5)) AS BIGINT) AS v
          FROM p, unnest(generate_series(0, 7)) AS g(i)), unnest(generate_series(0, 3)) AS h(j)
    GROUP BY page_id, n)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS last FROM d)"""

OP7_SQL = r"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
    FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
    FROM v AS q, v WHERE q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id),
r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""

OP8_SQL = r"""
WITH placed AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
outcomes AS (
    SELECT doc_id AS page_id, sum(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END) AS good, count(*) AS n
    FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
hosts AS (
    SELECT host, split_part(host, '.', -1) AS suffix,
           array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
           CAST(coalesce(sum(good), 0) AS DOUBLE) AS good, CAST(coalesce(sum(n), 0) AS DOUBLE) AS n
    FROM placed LEFT JOIN outcomes USING (page_id) GROUP BY host),
domains AS (SELECT domain, suffix, sum(good) AS good, sum(n) AS n FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(good) AS good, sum(n) AS n FROM domains GROUP BY suffix),
groups AS (
    SELECT 'h' AS level, good, n FROM hosts UNION ALL SELECT 'd', good, n FROM domains UNION ALL SELECT 's', good, n FROM suffixes),
moments AS (
    SELECT level, sum(good) AS g, sum(n) AS n, sum(n * n) AS n2, count(*) AS k, sum(good * good / n) AS w
    FROM groups WHERE n > 0 GROUP BY level),
means AS (SELECT *, (g + 1.0) / (n + 2.0) AS mean, n - n2 / n - (k - 1) AS room FROM moments),
levels AS (
    SELECT level, mean,
           least(greatest(1 / least(greatest(CASE WHEN room > 0 THEN
               (w - 2 * mean * g + mean * mean * n - (k - 1) * mean * (1 - mean)) / room / (mean * (1 - mean)) ELSE 0 END, 0.001), 0.999) - 1, 2.0), 1000.0) AS strength
    FROM means),
scored AS (
    SELECT h.host, h.n + lh.strength AS weight,
           (h.good + lh.strength * ((d.good + ld.strength * ((s.good + ls.strength * ls.mean) / (s.n + ls.strength))) / (d.n + ld.strength))) / (h.n + lh.strength) AS mean
    FROM hosts h JOIN domains d USING (domain, suffix) JOIN suffixes s USING (suffix),
         levels lh, levels ld, levels ls WHERE lh.level = 'h' AND ld.level = 'd' AND ls.level = 's'),
rules(kind, name, start) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
ruled AS (
    SELECT p.page_id, p.host, p.path, r.kind, r.name || r.start AS rule,
           row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.name || r.start) DESC NULLS LAST) AS place
    FROM placed p LEFT JOIN rules r ON (p.host = r.name OR ends_with(p.host, '.' || r.name)) AND starts_with(p.path, r.start))
SELECT page_id, host, path, rule,
       coalesce(kind, CASE WHEN mean - 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) >= 0.5 THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled JOIN scored USING (host) WHERE place = 1"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": OP1_SQL, "op5_warc": OP5_SQL, "op7_top_k": OP7_SQL, "op8_url_filter": OP8_SQL}
