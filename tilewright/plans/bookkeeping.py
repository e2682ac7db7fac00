"""Queries on libraries, ledgers, gates, manifests, batches and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators import contribution, gates, library, lookup, packing, reports, resume
from tilewright.plans.registry import Listing, table

_l = Listing()
QUERIES, ORACLE_SQL = _l.queries, _l.sql


def _library(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as images (two ids in forty share a file), customers as film rolls."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    file = F.when(F.col("o_orderkey") % 40 == 1, F.lit("same.nef")).otherwise(F.concat("o_orderkey", F.lit(".nef")))
    images = orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("film_id"), file.alias("filename"), F.col("o_orderpriority").alias("maker"),
        F.col("o_orderstatus").alias("model"), (F.col("o_orderkey") % 400).alias("iso"),
    )
    return images, customers.select(F.col("c_custkey").alias("id"), F.concat(F.lit("/photos/"), "c_mktsegment").alias("folder"))


_ENTRIES = """
    SELECT o_orderkey AS id, '/photos/' || c_mktsegment || '/' || CASE WHEN o_orderkey % 40 = 1 THEN 'same.nef' ELSE o_orderkey || '.nef' END AS path,
           trim(o_orderpriority) || ' ' || trim(o_orderstatus) AS camera, (o_orderkey % 400)::DOUBLE AS iso
    FROM orders JOIN customer ON o_custkey = c_custkey"""


@_l.add(_ENTRIES)
def library_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return library.library_entries(*_library(spark, sf_dir))


@_l.add(f"""
    WITH ids AS (SELECT l_orderkey + (l_linenumber = 1)::INT * 3 AS id FROM lineitem GROUP BY 1),
    j AS (SELECT ids.id, path, camera, iso FROM ids LEFT JOIN ({_ENTRIES}) e ON ids.id = e.id)
    SELECT *, 0 AS ord FROM j WHERE path IS NOT NULL QUALIFY row_number() OVER (PARTITION BY path ORDER BY id) = 1
    UNION ALL SELECT *, 1 FROM j WHERE path IS NULL""")
def library_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    ids = lines.select((F.col("l_orderkey") + F.when(F.col("l_linenumber") == 1, 3).otherwise(0)).alias("id"))
    return library.entries_by_id(ids, *_library(spark, sf_dir))


@_l.add(f"""
    WITH asked AS (SELECT p_partkey, ['/photos/BUILDING/' || p_partkey || '.nef', '/photos/MACHINERY/' || p_partkey || '.nef', '/photos/AUTOMOBILE/same.nef'] AS tries FROM part),
    t AS (SELECT p_partkey, unnest(tries) AS path, generate_subscripts(tries, 1) AS k FROM asked),
    h AS (SELECT p_partkey, e.id, e.path FROM t JOIN ({_ENTRIES}) e ON t.path = e.path
          QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY k, e.id) = 1)
    SELECT p_partkey, id, path FROM h UNION ALL SELECT p_partkey, NULL, NULL FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM h)""")
def library_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.col("p_partkey").cast("string"), F.lit(".nef"))
    tries = F.array(F.concat(F.lit("/photos/BUILDING/"), name), F.concat(F.lit("/photos/MACHINERY/"), name), F.lit("/photos/AUTOMOBILE/same.nef"))
    asked = table(spark, sf_dir, "part").select("p_partkey", tries.alias("tries"))
    known = library.library_entries(*_library(spark, sf_dir)).select("id", "path")
    found, left = lookup.first_candidate(asked, known, "p_partkey", "tries", "path")
    return found.select("p_partkey", "id", "path").unionByName(left.select("p_partkey"), allowMissingColumns=True)


@_l.add(f"""
    WITH e AS ({_ENTRIES}), u AS (
        SELECT path, 'id' AS origin, min(id) AS n, 0 AS o FROM e GROUP BY path
        UNION ALL SELECT '/photos/BUILDING/' || p_partkey || '.nef', 'path', p_partkey, 1 FROM part)
    SELECT path, origin, n FROM u QUALIFY row_number() OVER (PARTITION BY path ORDER BY o) = 1""")
def ordered_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = library.library_entries(*_library(spark, sf_dir)).groupBy("path").agg(F.min("id").alias("n"))
    first = entries.select("path", F.lit("id").alias("origin"), "n", F.lit(None).cast("string").alias("rel"))
    second = table(spark, sf_dir, "part").select(F.concat(F.lit("/photos/BUILDING/"), F.col("p_partkey").cast("string"), F.lit(".nef")).alias("path"), F.lit("path").alias("origin"), F.col("p_partkey").alias("n"))
    return library.ordered_union(first, second).select("path", "origin", "n")


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return rows.select(F.col("user_id").cast("string").alias("path"), F.when(F.col("event_type") == "error", "error").otherwise("harvested").alias("status"))


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("path"))


_DONE = "SELECT user_id::VARCHAR FROM events WHERE user_id IS NOT NULL"


@_l.add(f"SELECT c_custkey::VARCHAR AS path FROM customer WHERE c_custkey::VARCHAR NOT IN ({_DONE})")
def resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.remaining(_sources(spark, sf_dir), _ledger(spark, sf_dir))


@_l.add(f"SELECT c_custkey::VARCHAR AS path FROM customer WHERE c_custkey::VARCHAR NOT IN ({_DONE} AND event_type <> 'error')")
def resume_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.remaining(_sources(spark, sf_dir), _ledger(spark, sf_dir), retry=F.col("status") == "error")


@_l.add(f"SELECT c_custkey::VARCHAR AS path FROM customer WHERE c_custkey::VARCHAR NOT IN ({_DONE}) ORDER BY path LIMIT 20")
def limit_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.limit_after(_sources(spark, sf_dir), _ledger(spark, sf_dir), 20)


@_l.add("""
    WITH first AS (SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 100)
    SELECT c_custkey FROM first WHERE c_custkey NOT IN (SELECT l_suppkey FROM lineitem)""")
def limit_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("forum/"), "l_suppkey", F.lit("/"), "l_orderkey").alias("path"))
    return resume.limit_before(table(spark, sf_dir, "customer").select("c_custkey"), ledger, 100, "c_custkey", resume.topic_of(F.col("path")))


@_l.add("""
    WITH first AS (SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 100)
    SELECT c_custkey FROM first WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0)""")
def limit_before_some(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the first hundred topics some are left."""
    ledger = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").select(F.concat(F.lit("forum/"), "o_custkey", F.lit("/"), "o_orderkey").alias("path"))
    return resume.limit_before(table(spark, sf_dir, "customer").select("c_custkey"), ledger, 100, "c_custkey", resume.topic_of(F.col("path")))


_PATH = "p_name || CASE WHEN p_size % 3 = 0 THEN '.NEF' WHEN p_size % 3 = 1 THEN '.jpg' ELSE '.dng' END"


@_l.add(f"""
    WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'preset' WHEN p_partkey % 13 = 0 THEN 'image id not in library' WHEN p_partkey % 7 = 0 THEN 'file missing'
        WHEN NOT regexp_matches({_PATH}, '\\.(NEF|dng)$') THEN 'unsupported extension' WHEN p_size - 3 <= 0 THEN 'no ISO'
        WHEN p_size - 3 > 25 THEN 'ISO ' || (p_size - 3) || ' > 25' END AS reason FROM part)
    SELECT p_partkey, reason, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status FROM r""")
def gate_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    suffix = F.when(size % 3 == 0, ".NEF").when(size % 3 == 1, ".jpg").otherwise(".dng")
    path = F.when(key % 13 != 0, F.concat("p_name", suffix))
    reason = gates.library_gate(F.when(key % 11 == 0, "preset"), key, key % 7 == 0, path, (size - 3).cast("double"), 25)
    return gates.with_status(table(spark, sf_dir, "part"), reason).select("p_partkey", "reason", "status")


@_l.add("""
    WITH i AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN 'f/' || p_size ELSE (p_size * 10)::VARCHAR END AS iso FROM part)
    SELECT p_partkey, CASE WHEN iso IS NULL OR NOT regexp_full_match(iso, '[0-9]+') THEN 'no ISO in EXIF' WHEN iso::INTEGER > 200 THEN 'ISO ' || iso || ' > 200' END AS reason FROM i""")
def iso_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_size") % 4
    iso = F.when(k == 0, F.lit(None)).when(k == 1, F.concat(F.lit("f/"), F.col("p_size").cast("string"))).otherwise((F.col("p_size") * 10).cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", gates.iso_gate(iso, 200).alias("reason"))


@_l.add("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def publish_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume.unpublished(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@_l.add("""
    SELECT l.doc_id IS NOT NULL AS published, count(*) AS n_files, sum(n_chars)::BIGINT AS n_bytes
    FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id GROUP BY 1""")
def prune_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = resume.prune_flags(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), table(spark, sf_dir, "labels"), "doc_id")
    return resume.prune_totals(flags, "n_chars")


@_l.add("""
    WITH m AS (SELECT doc_id AS name, sha256(text) AS sha FROM documents WHERE doc_id % 17 <> 0),
    f AS (SELECT doc_id AS name, sha256(CASE WHEN doc_id % 19 = 0 THEN text || 'x' ELSE text END) AS sha FROM documents WHERE doc_id % 23 <> 0)
    SELECT coalesce(m.name, f.name) AS name, CASE WHEN f.name IS NULL THEN 'listed, not there' WHEN m.name IS NULL THEN 'there, not listed' ELSE 'sha256 differs' END AS problem
    FROM m FULL JOIN f ON m.name = f.name WHERE f.name IS NULL OR m.name IS NULL OR m.sha <> f.sha""")
def manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("name"), "text")
    manifest = docs.where(F.col("name") % 17 != 0).select("name", F.sha2("text", 256).alias("sha256"))
    changed = F.when(F.col("name") % 19 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    files = docs.where(F.col("name") % 23 != 0).select("name", F.sha2(changed, 256).alias("sha256"))
    return resume.manifest_difference(manifest, files)


@_l.add("""
    WITH known AS (SELECT doc_id AS name FROM labels UNION SELECT item_id FROM benchmark)
    SELECT known.name IS NULL AS is_new, count(*) AS n FROM documents LEFT JOIN known ON doc_id = known.name GROUP BY 1""")
def contrib_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = lambda t, c: table(spark, sf_dir, t).select(F.col(c).alias("name"))
    merged = resume.merge_new(name("documents", "doc_id"), name("labels", "doc_id"), name("benchmark", "item_id"))
    return merged.groupBy("is_new").agg(F.count("*").alias("n"))


@_l.add("""
    WITH c AS (SELECT s_name AS name, md5(s_name) AS sha, s_suppkey AS size, (s_suppkey % 4 + 1)::INTEGER AS revision FROM supplier WHERE s_suppkey % 5 <> 0),
    u AS (SELECT s_name AS name, md5(s_name || CASE WHEN s_suppkey % 2 = 0 THEN '+' ELSE '' END) AS sha, s_suppkey + 1 AS size FROM supplier WHERE s_suppkey % 3 = 0)
    SELECT coalesce(c.name, u.name) AS name, CASE WHEN ch THEN u.sha ELSE c.sha END AS sha256, CASE WHEN ch THEN u.size ELSE c.size END AS size,
           CASE WHEN ch THEN coalesce(revision, 0) + 1 ELSE revision END AS revision, CASE WHEN ch THEN '2025-06-01' ELSE '2025-01-01' END AS updated
    FROM (SELECT *, u.sha IS NOT NULL AND u.sha IS DISTINCT FROM c.sha AS ch FROM c FULL JOIN u ON c.name = u.name)""".replace("FROM (SELECT *, u.sha", "FROM (SELECT c, u, u.sha").replace("coalesce(revision, 0)", "coalesce(c.revision, 0)").replace("ELSE revision END", "ELSE c.revision END"))
def model_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, key = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    current = rows.where(key % 5 != 0).select(
        F.col("s_name").alias("name"), F.md5("s_name").alias("sha256"), key.alias("size"), (key % 4 + 1).cast("int").alias("revision"), F.lit("2025-01-01").alias("updated")
    )
    sha = F.md5(F.concat("s_name", F.when(key % 2 == 0, "+").otherwise("")))
    updates = rows.where(key % 3 == 0).select(F.col("s_name").alias("name"), sha.alias("sha256"), (key + 1).alias("size"))
    return resume.upsert(current, updates, F.lit("2025-06-01"))


@_l.add("""
    SELECT 'missing' AS kind, count(*) AS n FROM (SELECT DISTINCT l_orderkey FROM lineitem EXCEPT SELECT o_custkey FROM orders)
    UNION ALL SELECT 'one side', count(*) FROM ((SELECT p_partkey FROM part EXCEPT SELECT s_suppkey FROM supplier) UNION ALL (SELECT s_suppkey FROM supplier EXCEPT SELECT p_partkey FROM part))
    UNION ALL SELECT 'index', count(*) FROM (SELECT s_suppkey FROM supplier UNION ALL SELECT p_partkey FROM part)""")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = lambda t, c: table(spark, sf_dir, t).select(F.col(c).alias("id"))
    missing = resume.missing_from(ids("lineitem", "l_orderkey"), ids("orders", "o_custkey"), "id")
    sides = resume.symmetric_difference(ids("part", "p_partkey"), ids("supplier", "s_suppkey"))
    index = resume.append_index(ids("supplier", "s_suppkey"), ids("part", "p_partkey"))
    count = lambda df, kind: df.groupBy().agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count(missing, "missing").unionByName(count(sides, "one side")).unionByName(count(index, "index"))


_FOLD = """
    WITH RECURSIVE f AS (SELECT {by} AS grp_by, {name} AS name, {size}::BIGINT AS size, row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS k FROM {rows}),
    b AS (SELECT grp_by, name, size, k, size AS total, 0 AS bin FROM f WHERE k = 1
          UNION ALL SELECT f.grp_by, f.name, f.size, f.k, CASE WHEN b.total + f.size > {cap} THEN f.size ELSE b.total + f.size END, b.bin + (b.total + f.size > {cap})::INTEGER
          FROM b JOIN f ON f.grp_by = b.grp_by AND f.k = b.k + 1)"""


@_l.add(_FOLD.format(by="source", name="doc_id", size="n_chars", order="doc_id", rows="documents", cap=50_000) + " SELECT grp_by AS source, bin, count(*) AS n_files, sum(size)::BIGINT AS n_bytes FROM b GROUP BY 1, 2")
def pack_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    bins = packing.packed(files, ["doc_id"], "n_chars", 50_000, by=["source"])
    return bins.groupBy("source", "bin").agg(F.count("*").alias("n_files"), F.sum("n_chars").alias("n_bytes"))


_SMALL = "(SELECT * FROM documents WHERE n_chars < 3000)"


@_l.add(_FOLD.format(by="source", name="doc_id", size="n_chars", order="n_chars, doc_id", rows=_SMALL, cap=9_000) + """
    SELECT grp_by AS source, bin, name AS doc_id, count(*) OVER w AS members, sum(size) OVER w::BIGINT AS group_bytes FROM b
    WINDOW w AS (PARTITION BY grp_by, bin) QUALIFY members >= 2""".replace("sum(size) OVER w::BIGINT", "(sum(size) OVER w)::BIGINT"))
def compact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return packing.compact_groups(files, 9_000, 3_000, "doc_id", "n_chars", by=["source"]).select("source", F.col("grp").alias("bin"), "doc_id", "members", "group_bytes")


@_l.add("SELECT doc_id, (sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id) - n_chars)::BIGINT AS \"offset\" FROM documents")
def byte_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.byte_offsets(table(spark, sf_dir, "documents"), ["doc_id"], "n_chars", ["source"]).select("doc_id", "offset")


_SHARD = "CASE WHEN doc_id % 29 = 0 THEN 'unreadable: bad zip' WHEN doc_id % 23 = 0 THEN 'missing keys: wb' WHEN lang = 'es' AND doc_id % 5 = 0 THEN 'tiles dtype float32, expected uint16' WHEN doc_id % 19 = 0 THEN 'tiles shape (' || n_chars % 17 || ', 128, 128), expected (N, 256, 256)' WHEN n_chars % 17 = 0 THEN 'empty shard (0 tiles)' WHEN doc_id % 31 = 0 THEN 'offsets/tiles length mismatch' WHEN doc_id % 300 = 0 OR doc_id % 300 > 200 THEN 'ISO ' || doc_id % 300 || ' outside (0, 200]' END"
_SHARDS = f"SELECT doc_id, source, lang, n_chars % 17 AS n_tiles, {_SHARD} AS reason FROM documents"


def _shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, n = F.col("doc_id"), F.col("n_chars") % 17
    side = F.when(key % 19 == 0, 128).otherwise(256)
    keys = F.array(*map(F.lit, gates.REQUIRED_KEYS))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", n.alias("n_tiles"),
        F.when(key % 29 == 0, "bad zip").alias("error"),
        F.when(key % 23 == 0, F.array_remove(keys, "wb")).otherwise(keys).alias("keys"),
        F.when((F.col("lang") == "es") & (key % 5 == 0), "float32").otherwise("uint16").alias("dtype"),
        F.array(n.cast("int"), side, side).alias("shape"),
        F.when(key % 31 == 0, n + 1).otherwise(n).cast("int").alias("n_offsets"),
        (key % 300).cast("double").alias("iso"),
    )
    return rows.withColumn("reason", gates.shard_reason())


@_l.add(f"SELECT doc_id, reason FROM ({_SHARDS}) WHERE reason IS NOT NULL")
def validate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.invalid_shards(_shards(spark, sf_dir), "doc_id")


@_l.add(f"""
    SELECT source, count(*) FILTER (WHERE reason IS NULL) AS n_shards, count(*) FILTER (WHERE reason IS NOT NULL) AS n_invalid,
           coalesce(sum(n_tiles) FILTER (WHERE reason IS NULL), 0)::BIGINT AS n_tiles FROM ({_SHARDS}) GROUP BY source""")
def validate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.validation_summary(_shards(spark, sf_dir), ["source"])


@_l.add(f"SELECT source, sum(n_tiles)::BIGINT AS n_tiles, min(doc_id) AS first_shard FROM ({_SHARDS}) WHERE reason IS NULL GROUP BY source")
def camera_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.camera_report(_shards(spark, sf_dir).where("reason is null"), "source", "n_tiles", "doc_id")


@_l.add(f"SELECT string_agg(lang || '=' || n, ',' ORDER BY lang) AS cameras FROM (SELECT lang, sum(n_tiles)::BIGINT AS n FROM ({_SHARDS}) GROUP BY lang)")
def camera_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.camera_map(_shards(spark, sf_dir), "lang")
    pairs = F.transform(F.map_entries("cameras"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return found.select(F.array_join(pairs, ",").alias("cameras"))


@_l.add("SELECT event_type AS status, count(*) AS n FROM events GROUP BY 1")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.status_counts(table(spark, sf_dir, "events"), "event_type").withColumnRenamed("event_type", "status")


@_l.add("SELECT l_suppkey AS folder, count(*) AS n_shards FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def best_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.best_source(table(spark, sf_dir, "lineitem"), "l_suppkey").withColumnRenamed("l_suppkey", "folder")


@_l.add("""
    WITH r AS (SELECT o_custkey AS handle, o_orderkey AS bundle, l_returnflag AS camera, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)
    SELECT handle, camera, sum(n)::BIGINT AS n_tiles, count(*) AS n_bundles FROM r GROUP BY ALL""")
def registry_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    each = lines.groupBy(F.col("o_custkey").alias("handle"), "o_orderkey", F.col("l_returnflag").alias("camera")).agg(F.count("*").alias("n"))
    registry = each.groupBy("handle", "o_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("camera", "n"))).alias("cameras"))
    return reports.registry_rollup(registry)


@_l.add("SELECT sum((n_chars % 7 + 1) * (doc_id % 5 + 1))::BIGINT AS n_parameters FROM documents")
def parameter_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = F.array((F.col("n_chars") % 7 + 1).cast("int"), (F.col("doc_id") % 5 + 1).cast("int"))
    return reports.parameter_count(table(spark, sf_dir, "documents").select(shape.alias("shape")))


@_l.add("""
    WITH s AS (SELECT 'jane-doe_' || item_id || '.npz' AS name, sha256(text) AS sha, 'cam ' || item_id % 7 AS camera, length(text) % 17 AS n FROM benchmark)
    SELECT 'jane-doe' AS handle, count(*)::INTEGER AS n_shards, sum(n)::INTEGER AS n_tiles,
           (SELECT string_agg(camera || '=' || n, ',' ORDER BY camera) FROM (SELECT camera, sum(n)::BIGINT AS n FROM s GROUP BY camera)) AS cameras,
           string_agg(name || '=' || sha, ',' ORDER BY name) AS files FROM s""")
def contribution_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("item_id")
    shards = table(spark, sf_dir, "benchmark").select(
        F.concat(key.cast("string"), F.lit(".npz")).alias("name"), F.sha2("text", 256).alias("sha256"),
        F.concat(F.lit("cam "), (key % 7).cast("string")).alias("camera"), (F.length("text") % 17).alias("n_tiles"),
    )
    found = contribution.manifest(shards, "jane-doe", "2025-06-01", "CC0-1.0", "granted")
    joined = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return found.select("handle", "n_shards", "n_tiles", joined("cameras").alias("cameras"), joined("files").alias("files"))
