"""Queries on names, posts, paths and hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import hashing, text
from tilewright.operators import gates, reports, resume
from tilewright.plans.registry import Listing, table

_l = Listing()
QUERIES, ORACLE_SQL = _l.queries, _l.sql


@_l.add("SELECT c_custkey, CASE WHEN ('0x' || md5(c_name))::UHUGEINT % 10 = 0 THEN 'val' ELSE 'train' END AS split FROM customer")
def camera_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", hashing.camera_split(F.col("c_name")).alias("split"))


@_l.add("""
    SELECT CASE WHEN ('0x' || md5(p_brand))::UHUGEINT % 10 = 0 THEN 'val' ELSE 'train' END AS split, count(*) AS n_tiles, count(DISTINCT p_brand) AS n_cameras
    FROM part GROUP BY 1""")
def camera_split_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").withColumn("split", hashing.camera_split(F.col("p_brand")))
    return rows.groupBy("split").agg(F.count("*").alias("n_tiles"), F.countDistinct("p_brand").alias("n_cameras"))


@_l.add("SELECT s_suppkey, ('0x' || substr(md5(s_name), 1, 8))::BIGINT AS seed, 'file/' || substr(sha1(s_name), 1, 8) || '/x.nef' AS rel FROM supplier")
def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", hashing.seed_of(F.col("s_name")).alias("seed"), hashing.file_key(F.col("s_name"), F.lit("x.nef")).alias("rel"))


@_l.add(r"""
    WITH n AS (SELECT p_partkey, 'NIKON CORPORATION NIKON ' || p_type || ' ' || p_brand || ' Co., Ltd.' AS camera FROM part),
    w AS (SELECT p_partkey, list_filter(string_split(regexp_replace(lower(camera), '[^a-z0-9]+', ' ', 'g'), ' '),
                 lambda x: x NOT IN ('', 'corporation', 'corp', 'co', 'ltd', 'gmbh')) AS words FROM n)
    SELECT p_partkey, array_to_string(list_filter(words, lambda x, i: i = 1 OR x <> words[i - 1]), ' ') AS camera_key FROM w""")
def norm_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    camera = F.concat(F.lit("NIKON CORPORATION NIKON "), "p_type", F.lit(" "), "p_brand", F.lit(" Co., Ltd."))
    return table(spark, sf_dir, "part").select("p_partkey", text.norm_key(camera).alias("camera_key"))


_LICENSE = r"""
    SELECT {key}, CASE
        WHEN regexp_matches({html}, '(?i)creativecommons\.org/(?:licenses/([a-z-]+)|publicdomain/(?:zero|mark))')
        THEN coalesce(nullif(lower(regexp_extract({html}, '(?i)creativecommons\.org/(?:licenses/([a-z-]+)|publicdomain/(?:zero|mark))', 1)), ''), 'cc0')
        WHEN regexp_matches(t, '(?i)\bcc0\b|public domain') THEN 'cc0'
        WHEN regexp_matches(t, '(?i)creative\s*commons|\bcc[- ]by') THEN 'by'
             || CASE WHEN regexp_matches(t, '(?i)non[- ]?commercial|\bnc\b') THEN '-nc' ELSE '' END
             || CASE WHEN regexp_matches(t, '(?i)share[- ]?alike|\bsa\b') THEN '-sa' ELSE '' END
        END AS license
    FROM (SELECT *, regexp_replace({html}, '<[^>]+>', ' ', 'g') AS t FROM {rows})"""


@_l.add(_LICENSE.format(key="doc_id", html="text", rows="documents"))
def detect_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.detect_license(F.col("text")).alias("license"))


_TAGS = ["<a href='https://creativecommons.org/licenses/by-sa/4.0/'>x</a>", "see creativecommons.org/publicdomain/zero/1.0", "licensed <b>CC0</b>.",
         "Creative Commons, By-Attribution, Share-Alike", "creative commons non-commercial", "no word"]
_TAGGED = f"(SELECT page_id, ({_TAGS!r}::VARCHAR[])[page_id % 6 + 1] || html AS html FROM pages)".replace('"', "'").replace("='https", "=https").replace("4.0/'>", "4.0/>")


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.array(*[F.lit(t.replace("'", "")) for t in _TAGS])
    # as the SQL's lists have it: places from 1 on, from the end where they are negative, nothing at 0
    place = (F.col("page_id") % 6 + 1).cast("int")
    return table(spark, sf_dir, "pages").select("page_id", F.concat(F.when(place != 0, F.try_element_at(tags, place)), "html").alias("html"))


@_l.add(f"SELECT license, count(*) AS n FROM ({_LICENSE.format(key='page_id', html='html', rows=_TAGGED)}) GROUP BY license")
def license_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).select(text.detect_license(F.col("html")).alias("license")).groupBy("license").agg(F.count("*").alias("n"))


@_l.add(f"SELECT page_id, coalesce(license IN ('by', 'by-sa', 'cc0'), false) AS allowed FROM ({_LICENSE.format(key='page_id', html='html', rows=_TAGGED)})")
def license_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = text.detect_license(F.col("html"))
    return _tagged(spark, sf_dir).select("page_id", gates.license_gate(tag, ("by", "by-sa", "cc0")).alias("allowed"))


_POST = """'<a href="/up/' || page_id || '.ORF">a</a><a href="//cdn.example.org/' || page_id || '.dng?dl=1"> <a href="/up/' || page_id || '.ORF"><a href="x.jpeg"><a href="https://e.org/y.x3f"><a href="https://e.org/y.NEF">' || html"""


@_l.add(f"""
    WITH h AS (SELECT page_id, unnest(regexp_extract_all({_POST}, 'href="([^"]+)"', 1)) AS href, generate_subscripts(regexp_extract_all({_POST}, 'href="([^"]+)"', 1), 1) AS k FROM pages),
    f AS (SELECT page_id, k, CASE WHEN starts_with(href, '//') THEN 'https:' || href WHEN starts_with(href, '/') THEN 'https://forum.example.org' || href ELSE href END AS link
          FROM h WHERE regexp_matches(lower(string_split(href, '?')[1]), '\\.(dng|nef|orf)$')),
    d AS (SELECT page_id, link, min(k) AS k FROM f GROUP BY ALL)
    SELECT page_id, string_agg(link, ' ' ORDER BY k) AS links FROM d GROUP BY page_id""")
def extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    post = F.expr(_POST.replace("page_id ||", "cast(page_id as string) ||"))
    links = text.raw_links(post, F.lit("https://forum.example.org/t/1"), (".dng", ".nef", ".orf"))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(links, " ").alias("links"))


@_l.add("""
    WITH s AS (SELECT o_orderkey, o_custkey % 50 AS a, o_custkey % 50 + o_orderkey % 9 - 4 AS b FROM orders),
    i AS (SELECT o_orderkey, unnest(list_distinct(list_concat([a, 7], range(a, b + 1)))) AS id FROM s)
    SELECT o_orderkey, string_agg(id::VARCHAR, ',' ORDER BY id) AS ids FROM i GROUP BY o_orderkey""")
def parse_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    a = F.col("o_custkey") % 50
    b = F.greatest(a + F.col("o_orderkey") % 9 - 4, F.lit(0))
    spec = F.concat(a.cast("string"), F.lit(", 7 ,,"), a.cast("string"), F.lit(" - "), b.cast("string"))
    return rows.select("o_orderkey", F.array_join(text.parse_ids(spec).cast("array<string>"), ",").alias("ids"))


@_l.add("""
    SELECT p_partkey, trim(coalesce(nullif(CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 5 = 1 THEN '' WHEN p_size % 5 = 2 THEN '  ' ELSE p_brand END, ''), '?')) || ' ' || trim(p_type) AS camera FROM part""")
def camera_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_size") % 5
    maker = F.when(k == 0, F.lit(None)).when(k == 1, "").when(k == 2, "  ").otherwise(F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", text.camera_name(maker, F.col("p_type")).alias("camera"))


@_l.add(r"""
    WITH p AS (SELECT page_id, split_part(split_part(url, '?', 1), '#', 1) || CASE WHEN page_id % 3 = 0 THEN '.NEF' WHEN page_id % 3 = 1 THEN '/.nef' ELSE '' END AS path FROM pages)
    SELECT page_id, string_split(path, '/')[-1] AS name,
           lower(regexp_extract(string_split(path, '/')[-1], '[^.](\.[^.]+)$', 1)) AS ext,
           replace(path, '/', '_') || '.npz' AS shard FROM p""")
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 3
    path = F.concat(F.split_part(F.split_part("url", F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1)), F.when(k == 0, ".NEF").when(k == 1, "/.nef").otherwise(""))
    rows = table(spark, sf_dir, "pages").select("page_id", path.alias("path"))
    return rows.select("page_id", text.file_name(F.col("path")).alias("name"), text.file_extension(F.col("path")).alias("ext"), text.shard_name(F.col("path")).alias("shard"))


@_l.add(r"""
    WITH h AS (SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'username' WHEN 1 THEN 'Jane Doe' WHEN 2 THEN lower(replace(s_name, '#', '-')) WHEN 3 THEN '-x' ELSE 'A' || s_suppkey END AS handle FROM supplier)
    SELECT s_suppkey, regexp_full_match(lower(handle), '[a-z0-9][a-z0-9-]{0,30}') AND lower(handle) NOT IN
           ('your-github-name', 'your-name', 'your-handle', 'your-username', 'your-github-username', 'github-username', 'handle', 'name', 'username') AS valid,
           CASE WHEN starts_with('a4_x.npz', lower(handle) || '_') THEN 'a4_x.npz' ELSE lower(handle) || '_a4_x.npz' END AS shard FROM h""")
def handles(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey") % 5
    handle = (
        F.when(k == 0, "username").when(k == 1, "Jane Doe").when(k == 2, F.lower(F.replace("s_name", F.lit("#"), F.lit("-")))).when(k == 3, "-x")
        .otherwise(F.concat(F.lit("A"), F.col("s_suppkey").cast("string")))
    )
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.valid_handle(handle).alias("valid"), text.prefixed(handle, F.lit("a4_x.npz")).alias("shard"))


@_l.add(r"""
    WITH l AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '  # ' || p_name WHEN 1 THEN '   ' WHEN 2 THEN ' ' || p_name || ' # c ' ELSE p_name END AS line FROM part)
    SELECT p_partkey, nullif(trim(split_part(line, '#', 1)), '') AS id_entry,
           CASE WHEN trim(line) <> '' AND NOT starts_with(trim(line), '#') THEN trim(line) END AS path_entry FROM l""")
def list_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_size") % 4
    line = F.when(k == 0, F.concat(F.lit("  # "), "p_name")).when(k == 1, "   ").when(k == 2, F.concat(F.lit(" "), "p_name", F.lit(" # c "))).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", text.list_entry(line, True).alias("id_entry"), text.list_entry(line, False).alias("path_entry"))


@_l.add("SELECT page_id, md5(regexp_replace(html, '<[^>]+>', ' ', 'g')) AS plain_md5 FROM pages")
def strip_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text.strip_tags(F.col("html")).cast("binary")).alias("plain_md5"))


@_l.add("""
    SELECT source, sha1(string_agg(doc_id || ':' || n_chars || ':' || doc_id * 7 || chr(10), '' ORDER BY doc_id::VARCHAR)) AS fingerprint, count(*) AS n_files
    FROM documents GROUP BY source""")
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select("source", F.col("doc_id").cast("string").alias("name"), F.col("n_chars").alias("size"), (F.col("doc_id") * 7).alias("mtime_ns"))
    return hashing.fingerprint(files, by="source")


@_l.add("SELECT event_type, json_extract_string(props, '$.' || json_keys(props)[1]) IS NOT NULL AS has_value, count(*) AS n FROM events GROUP BY ALL")
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", "map<string,string>")
    first = F.get(F.map_values(parsed), F.lit(0))
    return table(spark, sf_dir, "events").select("event_type", first.isNotNull().alias("has_value")).groupBy("event_type", "has_value").agg(F.count("*").alias("n"))


@_l.add("SELECT split_part(o_orderpriority, '-', 2) AS topic, count(*) AS n FROM orders GROUP BY 1")
def topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn("status", resume.topic_of(F.replace("o_orderpriority", F.lit("-"), F.lit("/"))))
    return reports.status_counts(rows).withColumnRenamed("status", "topic")
