"""Queries that write files and read them back, and those on files' metadata.

What is written goes to the folder that `spark.checkpoint.dir` names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright import schemas
from tilewright.functions import dates, mosaic
from tilewright.operators import contribution, folds, gates, harvest, metadata, reports, resume
from tilewright.plans.registry import Listing, r6, table
from tilewright.runtime import shared_path
from tilewright.sources import binary, files

_l = Listing()
QUERIES, ORACLE_SQL = _l.queries, _l.sql


@_l.add("""
    SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'rejected' ELSE 'harvested' END AS status, count(*) AS n, count(*) FILTER (WHERE o_orderkey % 5 = 0) AS n_reasons,
           sum(CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 17 END)::BIGINT AS n_tiles FROM orders GROUP BY 1""")
def ledger_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, key = shared_path(spark, "ledger"), F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    for part in (orders.where(key % 2 == 0), orders.where(key % 2 == 1)):  # two batches, one after the other
        bad = key % 5 == 0
        rows = part.select(key.cast("string").alias("path"), F.when(bad, "rejected").otherwise("harvested").alias("status"), F.when(bad, 'no "ISO"\n').alias("reason"), F.when(~bad, key % 17).cast("int").alias("n_tiles"))
        files.append_ledger(rows, path)
    return files.read_ledger(spark, path).groupBy("status").agg(F.count("*").alias("n"), F.count("reason").alias("n_reasons"), F.sum("n_tiles").alias("n_tiles"))


_NAMED = "replace(p_name, ' ', '/') || '_' || p_partkey || CASE p_partkey % 4 WHEN 0 THEN '.NEF' WHEN 1 THEN '.txt' WHEN 2 THEN '.x3f' ELSE '.dng' END"


def _named() -> Column:
    ends = F.get(F.array(*map(F.lit, (".NEF", ".txt", ".x3f", ".dng"))), (F.col("p_partkey") % 4).cast("int"))
    return F.concat(F.replace("p_name", F.lit(" "), F.lit("/")), F.lit("_"), F.col("p_partkey").cast("string"), ends)


@_l.add(f"SELECT {_NAMED} AS rel, CASE p_partkey % 4 WHEN 0 THEN '.nef' ELSE '.dng' END AS ext FROM part WHERE p_partkey % 4 IN (0, 3)")
def listing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "listing")
    table(spark, sf_dir, "part").select(_named().alias("value")).write.text(path)
    return files.scan_listing(spark, path)


@_l.add("SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'red ')")
def include_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where(gates.included(F.col("p_name"), "red ")).select("p_partkey", "p_name")


@_l.add("SELECT p_partkey, CASE WHEN p_partkey % 6 = 5 THEN false ELSE p_partkey % 6 = 3 END AS three FROM part")
def three_colour_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.when(F.col("p_partkey") % 6 < 5, F.col("p_partkey") % 6)
    return table(spark, sf_dir, "part").select("p_partkey", gates.three_colour(n).alias("three"))


@_l.add("SELECT p_partkey, (p_size % 3)::INTEGER AS n_tiles FROM part WHERE p_size % 3 > 0")
def uniform_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size") % 3
    rows = table(spark, sf_dir, "part").select("p_partkey", n.alias("n_tiles"), F.when(n > 0, 256).otherwise(64).alias("tile_size"))
    return gates.one_tile_size(rows).select("p_partkey", "n_tiles")


_VAL = "('0x' || md5({0}))::UHUGEINT % 10 = 0"


@_l.add(f"""
    SELECT 'brands' AS source, count(*) AS n FROM part WHERE ({_VAL.format("p_brand")}) = EXISTS (SELECT 1 FROM part WHERE {_VAL.format("p_brand")})
    UNION ALL SELECT 'no validation', count(*) FROM part WHERE NOT {_VAL.format("p_brand")}
    UNION ALL SELECT 'required', count(*) FROM customer WHERE {_VAL.format("c_name")}""")
def validation_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, customers = table(spark, sf_dir, "part"), table(spark, sf_dir, "customer")
    sources = {
        "brands": gates.validation_rows(parts, "p_brand"),
        "no validation": gates.validation_rows(gates.split_rows(parts, "train", "p_brand"), "p_brand"),
        "required": gates.split_rows(customers, "val", "c_name", required=True),
    }
    counts = [rows.agg(F.lit(name).alias("source"), F.count("*").alias("n")) for name, rows in sources.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@_l.add("""
    SELECT c_custkey AS topic_id, u.url, CASE WHEN u.url IS NULL THEN 'rejected' END AS status, CASE WHEN u.url IS NULL THEN 'no raw links' END AS reason
    FROM customer LEFT JOIN (SELECT c_custkey AS k, unnest(list_transform(range(c_custkey % 4), lambda i: 'x/' || c_custkey || '_' || i || '.nef')) AS url FROM customer) u ON u.k = c_custkey""")
def topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    links = F.transform(F.filter(F.sequence(F.lit(0), F.lit(3)), lambda i: i < key % 4), lambda i: F.concat(F.lit("x/"), key.cast("string"), F.lit("_"), i.cast("string"), F.lit(".nef")))
    return harvest.topic_records(table(spark, sf_dir, "customer").select(key.alias("topic_id"), links.alias("links")), F.col("links"))


@_l.add("""
    SELECT p_partkey, p_size AS iso, CASE WHEN p_partkey % 4 = 0 THEN 'harvested' ELSE 'rejected' END AS status, CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 4 = 1 THEN 'no tile' END AS reason,
           CASE WHEN p_partkey % 4 = 0 THEN p_size % 16 END AS n_tiles FROM part""")
def status_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, kind = table(spark, sf_dir, "part"), F.col("p_partkey") % 4
    record = parts.select("p_partkey", F.col("p_size").alias("iso"), F.lit(None).cast("string").alias("status"))
    result = parts.where(kind < 2).select("p_partkey", F.when(kind == 0, "harvested").alias("status"), F.when(kind == 1, "no tile").alias("reason"), F.when(kind == 0, F.col("p_size") % 16).alias("n_tiles"))
    return harvest.merged_record(record, result, "p_partkey")


@_l.add("""
    WITH n AS (SELECT s_name AS name FROM supplier UNION ALL SELECT s_name FROM supplier WHERE s_suppkey % 3 = 0)
    SELECT name, count(*) AS n FROM n GROUP BY name""")
def published_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards go out in batches, the index grows with each; names that are appended once more are there twice."""
    path, sent = shared_path(spark, "index"), []
    shards = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.lit(400 << 20).cast("long").alias("size"), F.lit(False).alias("private"))
    first = shards.orderBy("name").limit(9)  # five batches of few
    contribution.publish(first, lambda number, rows: sent.append(number), path)
    shards.join(files.read_index(spark, path, required=True), "name", "left_anti").select(F.col("name").alias("value")).write.mode("append").text(path)
    more = table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_name").alias("name"))
    return resume.append_index(files.read_index(spark, path), more).groupBy("name").agg(F.count("*").alias("n"))


@_l.add("SELECT vec_id, round(list_sum(embedding::DOUBLE[]), 6) AS total FROM embeddings")
def tile_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built once; the second time it is read as it is, since the files are the same."""
    path = shared_path(spark, "cache")
    total = F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v.cast("double"))

    def build() -> DataFrame:
        return table(spark, sf_dir, "embeddings").select("vec_id", r6(total).alias("total"))

    contribution.reused(spark, path, "same files", 1, build)
    return contribution.reused(spark, path, "same files", 1, lambda: build().limit(0))


@_l.add("""
    WITH t AS (SELECT vec_id // 16 AS shard, (row_number() OVER (PARTITION BY vec_id // 16 ORDER BY vec_id) - 1)::INTEGER AS t, (vec_id % 16 * 2)::INTEGER AS oy, (vec_id % 5)::INTEGER AS ox,
                      list_sum(list_transform(embedding, lambda v: floor((v::DOUBLE + 1) * 8000)::INTEGER))::BIGINT AS total FROM embeddings)
    SELECT 'a_' || shard || '.nef.npz' AS name, t, oy, ox, total, NULL::VARCHAR AS reason FROM t""")
def shard_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of up to 16 tiles written as .npz files, validated, and read back tile by tile."""
    folder, key = shared_path(spark, "shards"), F.col("vec_id")
    pixels = F.transform("embedding", lambda v: F.floor((v.cast("double") + 1) * 8000).cast("int"))
    tile = F.struct(key, (key % 16 * 2).cast("int").alias("oy"), (key % 5).cast("int").alias("ox"), pixels.alias("pixels"))
    shards = table(spark, sf_dir, "embeddings").groupBy(F.floor(key / 16).alias("shard")).agg(F.array_sort(F.collect_list(tile)).alias("tiles"))
    pattern, flat = mosaic.pattern_column(((0, 1), (3, 2))), F.array(*[F.lit(1.0)] * 4)
    shards = shards.select(
        F.concat(F.lit("a/"), F.col("shard").cast("string"), F.lit(".nef")).alias("source_path"), "tiles", F.lit(8).alias("tile_size"), pattern.alias("pattern"), pattern.alias("pattern4"),
        flat.alias("black_per_channel"), F.lit(15000.0).alias("white"), flat.alias("wb"), F.lit(100).alias("iso"), F.lit("Acme One").alias("camera"),
    )
    binary.write_shards(shards, folder).write.parquet(f"{folder}-written")
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    reasons = binary.shard_info(spark, folder).select(name, gates.shard_reason(8, 200).alias("reason"))
    total = F.aggregate(F.col("pixels").cast("array<bigint>"), F.lit(0).cast("long"), lambda s, v: s + v).alias("total")
    return binary.read_tiles(spark, folder).select(name, "t", "oy", "ox", total).join(reasons, "name")


@_l.add("SELECT vec_id, round(list_sum(list_transform(range(64), lambda k: (k // 8) * embedding[k + 1]::DOUBLE)), 6) AS by_row, 64 AS n_pixels, true AS same FROM embeddings")
def long_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    pixels = mosaic.long_form(rows, "embedding", 8, "vec_id")
    sums = pixels.groupBy("vec_id").agg(r6(F.sum(F.col("y") * F.col("value").cast("double"))).alias("by_row"), F.count("*").cast("int").alias("n_pixels"))
    back = mosaic.from_long_form(pixels, "vec_id").join(rows, "vec_id").select("vec_id", (F.col("values") == F.col("embedding")).alias("same"))
    return sums.join(back, "vec_id")


@_l.add("""
    SELECT vec_id, round(list_sum(embedding::DOUBLE[]), 6) AS noisy, len(list_filter(range(64), lambda i: (i // 8) % 2 = 0 AND i % 2 = 0)) AS red, len(list_filter(range(64), lambda i: (i // 8 + i) % 2 = 1)) AS green,
           len(list_filter(range(64), lambda i: (i // 8) % 2 = 1 AND i % 2 = 1)) AS blue, round(list_sum(list_transform(embedding, lambda v: abs(v::DOUBLE))), 6) AS sigma FROM embeddings""")
def five_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    colour = mosaic.colours(mosaic.three_colours(mosaic.pattern_column(((0, 1), (3, 2)))), 8, 8)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", mosaic.planes(F.col("embedding"), colour, F.transform("embedding", F.abs)).alias("x"))
    total = lambda c: F.aggregate(F.col(f"x.{c}"), F.lit(0.0), lambda s, v: s + v.cast("double"))
    return rows.select("vec_id", r6(total("noisy")).alias("noisy"), *[total(c).cast("long").alias(n) for c, n in (("r", "red"), ("g", "green"), ("b", "blue"))], r6(total("sigma")).alias("sigma"))


@_l.add("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS iso, strftime(ts, '%Y%m%d') AS day, strftime(ts, '%Y%m%d-%H%M%S') AS stamp, strftime(ts, '%Y-%m-%d') AS local_day FROM events")
def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select("event_id", dates.iso_seconds(ts).alias("iso"), dates.day(ts).alias("day"), dates.stamp(ts).alias("stamp"), dates.local_day(ts).alias("local_day"))


@_l.add("SELECT event_type, count(*) // 32 AS n_batches, count(*) // 32 * 32 AS n FROM events GROUP BY event_type HAVING count(*) >= 32")
def shuffled_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = folds.shuffled_batches(table(spark, sf_dir, "events").select("event_type", "event_id"), "event_id", 32, 7, 1, ["event_type"])
    return found.groupBy("event_type").agg(F.countDistinct("batch").alias("n_batches"), F.countDistinct("event_id").alias("n"))


@_l.add("""
    SELECT user_id % 10 AS run, ceil((event_id + 1) / 100.0)::BIGINT AS "window", round(avg(value), 6) AS mean_loss, round(count(*) * 32 / sum(0.5 + value / 100), 6) AS samples_per_second
    FROM events GROUP BY ALL""")
def training_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs append to one log; windows of it have the mean loss and the throughput."""
    path, run = shared_path(spark, "log"), F.col("user_id") % 10
    rows = table(spark, sf_dir, "events").select(run.alias("run"), (F.col("event_id") + 1).alias("step"), F.col("value").alias("loss"), (0.5 + F.col("value") / 100).alias("seconds"))
    for part in (rows.where("run < 5"), rows.where("run >= 5 or run is null")):
        folds.append_metrics(part, path)
    log = spark.read.schema("run long, step long, loss double, seconds double").json(path)
    return folds.step_windows(log, ["run"], seconds="seconds", size=32).select("run", "window", r6(F.col("mean_loss")).alias("mean_loss"), r6(F.col("samples_per_second")).alias("samples_per_second"))


@_l.add("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_name || '.ema' ELSE s_name END AS weights FROM supplier")
def preferred_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("model"), F.when(F.col("s_suppkey") % 3 == 0, F.concat("s_name", F.lit(".ema"))).alias("ema"))
    return folds.preferred_weights(rows).select("s_suppkey", "weights")


@_l.add("""
    WITH e AS (SELECT min(c_custkey // 20) FILTER (WHERE c_custkey // 20 >= 4) AS last FROM customer)
    SELECT c_custkey AS topic_id, c_name AS title FROM customer, e WHERE c_custkey // 20 <= last""")
def forum_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages of twenty topics; the fifth names no further one, though there is."""
    page = F.floor(F.col("c_custkey") / 20)
    topic = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"))
    pages = table(spark, sf_dir, "customer").groupBy(page.alias("page")).agg(F.array_sort(F.collect_list(topic)).alias("topics"))
    return files.listed_topics(pages.withColumn("more_topics_url", F.when(F.col("page") != 4, "/next")))


@_l.add("SELECT c_custkey AS topic_id, CASE WHEN c_custkey % 3 = 0 THEN 'first' END AS cooked, CASE WHEN c_custkey % 6 = 0 THEN c_name ELSE '?' END AS author FROM customer")
def forum_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    post = lambda text, name: F.struct(F.lit(text).alias("cooked"), name.alias("username"))
    own = F.array(post("first", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name"))), post("second", F.col("c_name")))
    posts = F.when(F.col("c_custkey") % 3 == 0, own).otherwise(F.slice(own, 1, 0))
    return files.first_posts(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("topic_id"), posts.alias("posts")))


@_l.add("""
    WITH r AS (SELECT p_partkey, p_partkey % 11 > 0 AS there, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS tiff, (p_size % 4)::DOUBLE AS decoder,
                      CASE WHEN p_partkey % 3 = 0 THEN 'Acme' END AS make, CASE WHEN p_partkey % 5 = 0 THEN p_type END AS model, CASE WHEN p_partkey % 7 > 1 THEN (p_partkey % 3 * 100)::DOUBLE END AS tag FROM part),
    e AS (SELECT p_partkey, there, coalesce(CASE WHEN decoder > 0 THEN decoder END, CASE WHEN tag <> 0 THEN tag END) AS iso,
                 coalesce(tiff, CASE WHEN make IS NOT NULL OR model IS NOT NULL THEN trim(coalesce(make, '') || ' ' || coalesce(model, '')) END) AS camera FROM r)
    SELECT p_partkey, CASE WHEN there THEN CASE WHEN iso IS NULL THEN camera ELSE coalesce(camera, 'unknown') END END AS camera, CASE WHEN there THEN iso END AS iso,
           CASE WHEN NOT there THEN 'file missing on disk' WHEN iso IS NULL THEN 'no ISO in the file' END AS reason FROM e""")
def file_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(
        F.concat(F.lit("/p/"), key.cast("string")).alias("path"), (key % 11 > 0).alias("there"), F.when(key % 2 == 0, F.col("p_brand")).alias("tiff_camera"), (F.col("p_size") % 4).cast("double").alias("decoder_iso"),
        F.when(key % 3 == 0, "Acme").alias("make"), F.when(key % 5 == 0, F.col("p_type")).alias("model"), F.when(key % 7 > 1, key % 3 * 100).cast("double").alias("tag_iso"),
    )
    return metadata.file_entries(rows).select(F.substring("path", 4, 20).cast("long").alias("p_partkey"), "camera", "iso", "reason")


@_l.add("SELECT p_partkey, p_brand || CASE WHEN p_partkey % 3 > 0 THEN ' M' || lpad(p_partkey::VARCHAR, 9, '0') ELSE '' END AS camera FROM part")
def header_cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Make (8 letters) and model (10, or none) written as the first directory of a TIFF header, and read from it."""
    model = F.when(F.col("p_partkey") % 3 > 0, F.concat(F.lit("M"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))).otherwise(F.lit(" " * 10))
    directory = F.unhex(F.lit("49492A0008000000" + "0200" + "0F010200" + "09000000" + "26000000" + "10010200" + "0B000000" + "2F000000" + "00000000"))
    zero = F.unhex(F.lit("00"))
    head = F.concat(directory, F.rpad("p_brand", 8, " ").cast("binary"), zero, model.cast("binary"), zero)
    return table(spark, sf_dir, "part").select("p_partkey", binary.camera_of(head).alias("camera"))


@_l.add("""
    SELECT r_name AS name, (r_regionkey + 2)::BIGINT * 4 AS size, (sum(r_regionkey + 2) OVER (ORDER BY r_name) - r_regionkey - 2)::BIGINT * 4 AS "offset", (r_regionkey * (r_regionkey + 2))::DOUBLE AS total FROM region""")
def tensor_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "weights")
    rows = table(spark, sf_dir, "region").orderBy("r_name").collect()  # tensors of a model: some dozens
    content = binary.pack_tensors([(r.r_name, [r.r_regionkey] * (r.r_regionkey + 2)) for r in rows], {"width": 2}, b"TILEWT\0\1")
    binary.write_file(f"{folder}/weights.bin", content)
    total = F.aggregate("values", F.lit(0.0), lambda s, v: s + v.cast("double")).alias("total")
    return binary.read_tensors(spark, folder, b"TILEWT\0\1").select("name", "size", "offset", total)


@_l.add("""
    SELECT 's' || r_regionkey || '.npz' AS name, CASE WHEN r_regionkey > 0 THEN 'two.tar.gz' ELSE 'one.tar.gz' END AS bundle, length(r_name) + CASE WHEN r_regionkey > 0 THEN 1 ELSE 0 END AS size,
           sha256(r_name || CASE WHEN r_regionkey > 0 THEN '!' ELSE '' END) AS sha256 FROM region""")
def bundle_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two archives, of which the later holds newer versions of some shards: what restoring both leaves."""
    folder = shared_path(spark, "bundles")
    rows = table(spark, sf_dir, "region").orderBy("r_name").collect()  # shards of a bundle: a thousand at most
    for bundle, first, end in (("one", 0, ""), ("two", 1, "!")):
        members = [(f"s{r.r_regionkey}.npz", (r.r_name + end).encode()) for r in rows if r.r_regionkey >= first]
        binary.write_file(f"{folder}/{bundle}.tar.gz", binary.pack_bundle(members, {"format": 1, "handle": "jo"}))
    found = binary.restored(binary.bundle_members(spark, folder))
    return found.select("name", F.element_at(F.split("bundle", "/"), -1).alias("bundle"), F.col("size"), "sha256")


@_l.add("SELECT (SELECT count(*) FROM (SELECT s_suppkey FROM supplier EXCEPT SELECT l_suppkey FROM lineitem)) = 0 AS all_used, true AS same_as_itself")
def set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, used = table(spark, sf_dir, "supplier").select("s_suppkey"), table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"))
    both = own.join(used, "s_suppkey", "left_semi")
    return spark.createDataFrame([(resume.same_rows(own, both), resume.same_rows(own, own.repartition(3)))], "all_used boolean, same_as_itself boolean")


@_l.add("SELECT o_orderstatus AS handle, o_orderpriority AS camera, count(*)::BIGINT * 3 AS n_tiles, count(*)::BIGINT AS n_bundles FROM orders GROUP BY ALL")
def registry_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line for each of many bundles, appended in two runs and rolled up."""
    path, orders = shared_path(spark, "registry"), table(spark, sf_dir, "orders")
    bundles = orders.select("o_orderkey", F.col("o_orderstatus").alias("handle"), F.lit("20240101").alias("created"), F.lit(3).alias("n_tiles"), F.create_map("o_orderpriority", F.lit(3).cast("long")).alias("cameras"), F.lit("CC0").alias("license"))
    for part in (bundles.where("o_orderkey % 2 = 0"), bundles.where("o_orderkey % 2 = 1")):
        contribution.append_registry(contribution.registry_line(part, 1, "20240102", "mail", "00"), path)
    return reports.registry_rollup(spark.read.schema(schemas.REGISTRY).json(path))
