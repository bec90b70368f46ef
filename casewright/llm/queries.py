"""The registered queries of the package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright.llm import ann, html_text, line_dedup, mixing, packing, prefix_trie, quality, scaled_sketch, secrets, simhash, substring_dedup, url_filter, whitening
from casewright.llm.common import join_unique, table
from casewright.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD = r"[^\x20\x09-\x0D]+"
_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def query(sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame under its name."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def tokenizer_path() -> str:
    """The byte-level vocabulary that op1 fixes; the operator takes any path."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# ---- 1: packing (no SQL: DuckDB has no tokenizer) -----------------------------------------------

@query()
def op1_packing(spark: SparkSession, d: str) -> DataFrame:
    packed = packing.pack(table(spark, d, "documents"), tokenizer_path())
    return packed.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


# ---- 2: line dedup -----------------------------------------------------------------------------

@query(f"""
WITH lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
               FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (SELECT *, translate(trim(line, {_SPACES}), {_LOWER}) AS key FROM lines),
shared AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
           GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""")
def op2_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, d, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


# ---- 3: suffix-array dedup (no SQL: all windows of all texts would be too many rows) --------------

@query()
def op3_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    kept = substring_dedup.dedup_substrings(table(spark, d, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# ---- 4: mixing (no SQL: the rates are found by iteration) ---------------------------------------

@query()
def op4_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


# ---- 5: quality rules --------------------------------------------------------------------------

@query(rf"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '{WORD}') AS words, string_split(text, chr(10)) AS parts FROM docs),
places AS (SELECT doc_id, unnest(range(1, greatest(len(words) - 3, 1))) AS i, words FROM worded),
grams AS (SELECT doc_id, i, list_slice(words, i, i + 4) AS gram FROM places),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
            FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM grams
                  WHERE (doc_id, gram) IN (SELECT (doc_id, gram) FROM grams GROUP BY doc_id, gram HAVING count(*) > 1))
            GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) AS n_lines
          FROM (SELECT doc_id, unnest(parts) AS line FROM worded) WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
counts AS (SELECT w.doc_id, w.source, CAST(len(w.words) AS BIGINT) AS n_words,
                  CAST(length(regexp_replace(w.text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                  CAST(len(regexp_extract_all(w.text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
                  coalesce(l.n_dup_lines, 0) AS n_dup_lines, coalesce(c.n_repeat_words, 0) AS n_repeat_words, coalesce(l.n_lines, 0) AS n_lines
           FROM worded w LEFT JOIN covered c USING (doc_id) LEFT JOIN lines l USING (doc_id)),
ruled AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
                 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS odd
          FROM counts),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed OR odd) AS bad FROM ruled GROUP BY source),
whole AS (SELECT sum(bad) / sum(n) AS mean, sum(n) AS n, count(*) AS hosts, sum(bad * bad / n) AS squares FROM hosts),
spread AS (SELECT mean, greatest(squares - n * mean * mean - (hosts - 1) * mean * (1 - mean), 0) / n AS between_hosts FROM whole),
prior AS (SELECT mean, CASE WHEN between_hosts > 0 THEN least(greatest(mean * (1 - mean) / between_hosts - 1, 2), 10000) ELSE 10000 END AS weight FROM spread),
verdicts AS (SELECT source, (bad + mean * weight) / (n + weight) <= 0.5 AS host_kept FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_kept AS kept
FROM ruled r JOIN verdicts v ON r.source IS NOT DISTINCT FROM v.source""")
def op5_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    judged = quality.judge(table(spark, d, "documents"))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# ---- 6: URL filters ----------------------------------------------------------------------------

RULES = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"), url_filter.Rule("block", "example.com", "/de/"),
         url_filter.Rule("allow", "org", "/fr/")]
#: Words in the host of a reported page.
REPORTED = "casino|pills|bets|spam|ads-track"


def reported_urls(pages: DataFrame) -> DataFrame:
    """The list of the query: pages on reported hosts, pages that mirror the path of one elsewhere, and the print view of each.

    Every URL is spelled otherwise than in ``pages``: other scheme, ``WWW.``, default port, a tracking parameter and a fragment.
    Print views are seldom pages, so the list holds much that meets no page.
    """
    url, path = F.col("url"), url_filter.path_of(F.col("url"))
    seen = stage(pages.select("url", path.alias("path"), url_filter.host_of(url).rlike(REPORTED).alias("reported")), "url-reports")
    paths = seen.filter("length(path) > 1").groupBy("path").agg(F.count("*").alias("n"), F.bool_or("reported").alias("known")).filter("known")
    mirrors = join_unique(seen.filter("NOT reported"), stage(paths, "url-reported-paths"), "path", "n", seen.count(), "inner")
    chosen = seen.filter("reported").select("url", "path").unionByName(mirrors.select("url", "path"))
    whole = F.regexp_replace(url, "(?s)#.*$", "")
    tracked = F.concat(whole, F.when(whole.contains("?"), "&").otherwise("?"), F.lit("utm_source=report#top"))
    printed = F.concat(F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1), F.regexp_replace("path", "/$", ""), F.lit("/print"))
    spelled = lambda u: F.regexp_replace(u, r"^https?://(?:www\.)?([^/?#:]+)(?=[/?#]|$)", "HTTPS://WWW.$1:443")
    return chosen.select(F.explode(F.array(spelled(tracked), spelled(printed))).alias("url"))


def _fits(host: str, path: str) -> str:
    return f"(host = '{host}' OR suffix(host, '.{host}')) AND prefix(path, '{path}')"


@query(rf"""
WITH split AS (SELECT page_id, url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), {_LOWER}), '') AS host,
                      coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
                      list_sort(list_filter(string_split(coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), ''), '&'),
                        lambda p: p <> '' AND NOT regexp_matches(p, '{url_filter.TRACKING}'))) AS parameters
               FROM pages),
canonical AS (SELECT *, CASE WHEN bare = '' THEN '' ELSE bare || regexp_replace(path, '/$', '') ||
                CASE WHEN len(parameters) > 0 THEN '?' || array_to_string(parameters, '&') ELSE '' END END AS key
              FROM (SELECT *, regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') AS bare FROM split)),
reported AS (SELECT DISTINCT path FROM canonical WHERE regexp_matches(host, '{REPORTED}') AND length(path) > 1),
chosen AS (SELECT * FROM canonical WHERE key <> '' AND (regexp_matches(host, '{REPORTED}') OR path IN (SELECT path FROM reported))),
listed AS (SELECT key FROM chosen UNION SELECT bare || regexp_replace(path, '/$', '') || '/print' FROM chosen),
ruled AS (SELECT *, CASE WHEN {_fits('example.net', '/en/')} THEN 'example.net/en/' WHEN {_fits('example.com', '/de/')} THEN 'example.com/de/'
                         WHEN {_fits('org', '/fr/')} THEN 'org/fr/' WHEN {_fits('net', '/')} THEN 'net/' END AS rule FROM canonical)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
         WHEN key IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""")
def op6_url_filter(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url")
    return url_filter.judge(pages, reported_urls(pages), RULES).select("page_id", "host", "path", "rule", "verdict")


# ---- 7: approximate nearest neighbours (no SQL: approximate) -------------------------------------

@query()
def op7_nearest(spark: SparkSession, d: str) -> DataFrame:
    return ann.search(table(spark, d, "embeddings"), lambda vec_id: vec_id % 100 == 0).select("query_id", "rank", "vec_id", "score")


# ---- 8: HTML extraction (no SQL: it would need an HTML parser) -----------------------------------

@query()
def op8_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return html_text.extract(table(spark, d, "pages").select("page_id", "url", "html"))


# ---- 9: SimHash near-dedup (no SQL: DuckDB has no seeded XXH64) ---------------------------------

@query()
def op9_simhash(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, d, "documents"), words_per_shingle=4, n_parts=1, probe_bits=4, max_bits=4)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("part0"), 16, "0")).alias("fingerprint"), "component_id")


# ---- 10: secret scans (no SQL: DuckDB gives no places of matches) --------------------------------

@query()
def op10_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return secrets.scan(table(spark, d, "documents")).select(F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans")


# ---- 11: conversation prefix trie (no SQL: DuckDB has no CRC-32) ---------------------------------

@query()
def op11_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, d, "conversations"))


# ---- 12: document fingerprints (no SQL: DuckDB has no seeded XXH64) ------------------------------

@query()
def op12_document_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return scaled_sketch.edited_and_next(table(spark, d, "documents")).withColumnRenamed("id", "doc_id")


# ---- 13: embedding whitening (no SQL: it needs eigenvectors) -------------------------------------

@query()
def op13_embedding_whitening(spark: SparkSession, d: str) -> DataFrame:
    return whitening.whiten(table(spark, d, "embeddings")).withColumnRenamed("id", "vec_id")
