"""The queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tilewright.llm import cap_filters, common, orc_tokens, packing, quality, radix_dedup, secrets, sharding, simhash, tiling, url_cascade


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated_pairs(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), short=True)


def op2_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one ledger: the second knows a rule more, and scans all blobs by that one only."""
    docs, ledger = _read(spark, sf_dir, "documents"), common.new_path(spark, "blob-ledger")
    secrets.findings_by_blob(docs, secrets.RULES[:-1], ledger)
    return secrets.find_secrets(docs, ledger=ledger)


def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_read(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"))


def op5_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op7_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_vectors(_read(spark, sf_dir, "embeddings"))


def op8_radix_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_dedup.remove_repeats(_read(spark, sf_dir, "documents"))


def op9_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_cascade.filter_urls(_read(spark, sf_dir, "pages"))


def op10_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orc_tokens.token_files(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_string_tiling": op1_string_tiling,
    "op2_blob_ledger": op2_blob_ledger,
    "op3_virtual_slots": op3_virtual_slots,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_ftrl_quality": op5_ftrl_quality,
    "op6_simhash_ball": op6_simhash_ball,
    "op7_cap_filters": op7_cap_filters,
    "op8_radix_windows": op8_radix_windows,
    "op9_url_cascade": op9_url_cascade,
    "op10_orc_tokens": op10_orc_tokens,
}

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _spans_sql(kind: str, place: int, pattern: str, group: int, least: int) -> str:
    """Matches by text between and text of them: leftmost, not overlapping, in code points."""
    return f"""
        SELECT doc_id, '{kind}' AS kind, {place} AS place, list_sum(list_transform(g[:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:k - 1], lambda x: length(x))), 0) AS a, length(m[k]) AS n
        FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS g, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {group}) AS v,
                     unnest(range(1, len(regexp_extract_all(t, '{pattern}', 0)) + 1)) AS k FROM d)
        WHERE length(v[k]) >= {least}"""


ORACLE_SQL: dict[str, str] = {
    "op2_blob_ledger": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        s AS ({_spans_sql("assign", 0, _ASSIGN, 1, 6)} UNION ALL {_spans_sql("access", 1, "AKIA[A-Z0-9]+", 0, 20)} UNION ALL {_spans_sql("hex", 2, "[0-9a-f]{24,}", 0, 24)}),
        j AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
                     string_agg(kind || ':' || a::BIGINT || ':' || (a + n)::BIGINT, ',' ORDER BY a, place) AS spans FROM s GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN j ON d.doc_id = j.doc_id""",
    "op8_radix_windows": """
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
        w AS (SELECT doc_id, i, array_slice(raw, i + 1, i + 50) AS s FROM (SELECT doc_id, raw, unnest(range(0, greatest(octet_length(raw) - 49, 0))) AS i FROM d)),
        m AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
        c AS (SELECT w.doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY w.doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM w JOIN m ON w.s = m.s WHERE first < w.doc_id),
        r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM c) GROUP BY doc_id, k),
        p AS (SELECT r.doc_id, a, b, hex(array_slice(raw, coalesce(lag(b) OVER (PARTITION BY r.doc_id ORDER BY a), 0) + 1, a)) AS piece FROM r JOIN d ON r.doc_id = d.doc_id),
        k AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS e, string_agg(piece, '' ORDER BY a) AS kept FROM p GROUP BY doc_id)
        SELECT d.doc_id, octet_length(raw)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(unhex(coalesce(kept || hex(array_slice(raw, e + 1, octet_length(raw))), hex(raw)))) AS kept_sha256
        FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op7_cap_filters": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n
            FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL),
        l AS (
            SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93),
        r AS (SELECT u AS id, u AS root FROM l UNION SELECT l.w, r.root FROM r JOIN l ON l.u = r.id),
        c AS (SELECT id, min(root) AS component FROM r GROUP BY id),
        k AS (SELECT u, count(*) AS n FROM l GROUP BY u)
        SELECT vec_id, coalesce(k.n, 0)::BIGINT AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
        FROM embeddings LEFT JOIN c ON c.id = vec_id LEFT JOIN k ON k.u = vec_id""",
    "op9_url_cascade": r"""
        WITH u AS (
            SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
            FROM pages),
        p AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM u),
        r AS (
            SELECT *, host = 'org' OR host LIKE '%.org' AS org, host = 'com' OR host LIKE '%.com' AS com,
                   host = 'example.org' OR host LIKE '%.example.org' AS ex
            FROM p),
        f AS (
            SELECT page_id, host, path,
                   CASE WHEN ex AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                        WHEN ex AND starts_with(path, '/es/') THEN 'example.org/es/'
                        WHEN com AND starts_with(path, '/fr/') THEN 'com/fr/'
                        WHEN com AND starts_with(path, '/de/') THEN 'com/de/'
                        WHEN org AND starts_with(path, '/') THEN 'org/' END AS rule
            FROM r)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
        FROM f""",
}
