"""Queries on sensor levels and noise profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright import schemas
from tilewright.operators import gates, lookup, reports
from tilewright.plans.registry import Listing, r6, table

_l = Listing()
QUERIES, ORACLE_SQL = _l.queries, _l.sql

#: (key, variant, mode, sensor, black, white, ISO list, least, most) of invented cameras.
LEVELS = [
    ("acme 1", 0, "12bit", 0, 10.0, 1000.0, None, None, None),
    ("acme 1", 1, "14bit", 0, 40.0, 1600.0, None, None, None),
    ("acme 1", 2, "14bit", 0, 40.0, 1600.0, None, None, None),
    ("acme 2", 0, "", 0, 6.0, 1500.0, None, None, None),
    ("acme 2", 0, "", 1, 5.0, 1490.0, [10.0, 20.0], None, None),
    ("acme 2", 0, "", 2, 7.0, 1300.0, None, 30.0, None),
    ("acme 3", 0, "a", 0, 900.0, 800.0, None, None, 25.0),
    ("acme 3", 0, "a", 1, 8.0, 1200.0, None, None, None),
    ("acme 3", 1, "b", 0, 9.0, 1300.0, [7.0], 1.0, 50.0),
    ("acme 4", 0, "", 0, 3.0, 5000.0, None, 5.0, 45.0),
]


def _sql(value) -> str:
    return "NULL" if value is None else repr(value)


_LEVELS = "(VALUES " + ", ".join("(" + ", ".join(map(_sql, (*row[:6], row[6], *row[7:]))) + ")" for row in LEVELS) + ") v(key, variant_ix, mode, sensor_ix, black, white, iso_list, iso_min, iso_max)"
_ASSETS = "SELECT p_partkey, 'acme ' || p_partkey % 6 AS key, p_size::DOUBLE AS iso, CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 8 = 0 THEN 0 ELSE p_retailprice END AS white FROM part"
_FOUND = f"""
    WITH a AS ({_ASSETS}), l AS (SELECT key, variant_ix, sensor_ix, black, white, iso_list::DOUBLE[] AS iso_list, iso_min::DOUBLE AS iso_min, iso_max::DOUBLE AS iso_max FROM {_LEVELS}),
    j AS (SELECT p_partkey, a.white AS lw, l.*, CASE
            WHEN CASE WHEN iso_list IS NOT NULL THEN len(list_filter(iso_list, lambda v: abs(v - iso) < 0.5)) > 0
                 ELSE (iso_min IS NOT NULL OR iso_max IS NOT NULL) AND iso >= coalesce(iso_min, iso) AND iso <= coalesce(iso_max, iso) END THEN 0
            WHEN iso_list IS NULL AND iso_min IS NULL AND iso_max IS NULL THEN 1 END AS choice
          FROM a JOIN l ON a.key = l.key),
    s AS (SELECT * FROM j WHERE choice IS NOT NULL QUALIFY row_number() OVER (PARTITION BY p_partkey, variant_ix ORDER BY choice, sensor_ix) = 1),
    b AS (SELECT * FROM s WHERE white > black
          QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY CASE WHEN lw > 0 THEN abs(white / lw - 1) ELSE 0 END, variant_ix) = 1)
    SELECT p_partkey, black::DOUBLE AS level_black, white::DOUBLE AS level_white FROM b WHERE lw IS NULL OR lw <= 0 OR white / lw BETWEEN 0.6 AND 1.25"""


def _assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    white = F.when(key % 7 == 0, F.lit(None)).when(key % 8 == 0, 0.0).otherwise(F.col("p_retailprice"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("ACME Corp. Acme "), (key % 6).cast("string")).alias("camera"), F.col("p_size").alias("iso"), white.alias("libraw_white"), "p_retailprice", "p_size"
    )


def _levels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(r[0], r[1], r[2], r[3], *r[4:]) for r in LEVELS], schemas.LEVEL)


@_l.add(_FOUND)
def level_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.level_lookup(_assets(spark, sf_dir), _levels(spark), "p_partkey")


_RESOLVED = f"""
    SELECT p.p_partkey, f.level_white IS NOT NULL AS from_table, coalesce(f.level_black, (p_size + p_size + 1 + p_size + 2) / 3.0) AS norm_black,
           coalesce(f.level_white, a.white) AS norm_white, 'acme ' || p.p_partkey % 6 AS camera
    FROM part p JOIN ({_ASSETS}) a ON a.p_partkey = p.p_partkey LEFT JOIN ({_FOUND}) f ON f.p_partkey = p.p_partkey"""


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = _assets(spark, sf_dir).withColumn("black_per_channel", F.array(*[(F.col("p_size") + k).cast("float") for k in (0, 1, 2, 99)]))
    return lookup.resolve_levels(shards, _levels(spark), white="libraw_white")


@_l.add(f"SELECT p_partkey, from_table, round(norm_black, 6) AS norm_black, round(norm_white, 6) AS norm_white FROM ({_RESOLVED})")
def level_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir).select("p_partkey", "from_table", r6(F.col("norm_black")).alias("norm_black"), r6(F.col("norm_white")).alias("norm_white"))


@_l.add(f"SELECT from_table, count(*) AS n_tiles, count(DISTINCT camera) AS n_cameras FROM ({_RESOLVED}) GROUP BY 1")
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage_report(_resolved(spark, sf_dir).withColumn("n_tiles", F.lit(1).cast("long")))


@_l.add(f"SELECT count(DISTINCT key) AS n_keys, count(DISTINCT (key, variant_ix)) AS n_variants, count(*) AS n_sensors FROM {_LEVELS}")
def level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.table_counts(_levels(spark))


@_l.add(f"SELECT key, count(DISTINCT variant_ix) AS n_variants, string_agg(variant_ix || ':' || sensor_ix, ' ' ORDER BY variant_ix, sensor_ix) AS places FROM {_LEVELS} GROUP BY key")
def variant_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = F.flatten(F.transform("variants", lambda v: F.transform(v["sensors"], lambda s: F.concat(v["variant_ix"].cast("string"), F.lit(":"), s["sensor_ix"].cast("string")))))
    return reports.variant_map(_levels(spark)).select("key", F.size("variants").cast("long").alias("n_variants"), F.array_join(places, " ").alias("places"))


#: (event type, ISO, a) of invented profiles; b is a tenth.
KNOTS = [(t, float(iso), a * k) for k, t in ((1, "click"), (2, "view"), (3, "purchase")) for iso, a in ((10, 1.0), (20, 2.0), (40, 5.0), (90, 7.5))]
_KNOTS = "(VALUES " + ", ".join(f"('{t}', {iso}, {a})" for t, iso, a in KNOTS) + ") k(camera, iso, a)"


def _profiles(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(KNOTS, "camera string, iso double, x double")
    return rows.select("camera", "iso", F.array("x", F.col("x") * 2, F.col("x") * 3).alias("a"), F.array(*[F.col("x") / 10] * 3).alias("b"))


@_l.add(f"""
    WITH k AS (SELECT camera, iso::DOUBLE AS iso, a::DOUBLE AS a, lead(iso) OVER w::DOUBLE AS iso2, lead(a) OVER w::DOUBLE AS a2, row_number() OVER w AS n FROM {_KNOTS} WINDOW w AS (PARTITION BY camera ORDER BY iso)),
    j AS (SELECT event_id, CASE WHEN value <= k.iso OR iso2 IS NULL THEN a ELSE (1 - (value - k.iso) / (iso2 - k.iso)) * a + (value - k.iso) / (iso2 - k.iso) * a2 END AS a
          FROM events JOIN k ON event_type = camera AND ((value >= k.iso OR n = 1) AND (value < iso2 OR iso2 IS NULL)))
    SELECT event_id, round(a, 6) AS a_red, round(a * 3, 6) AS a_blue, round(a / 10, 6) AS b_green FROM j""".replace("lead(iso) OVER w::DOUBLE", "(lead(iso) OVER w)::DOUBLE").replace("lead(a) OVER w::DOUBLE", "(lead(a) OVER w)::DOUBLE"))
def profile_interp(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    found = lookup.interpolate(asked, _profiles(spark), "event_type", "value")
    item = lambda c, k: r6(F.get(c, F.lit(k)))
    return found.select("event_id", item("a", 0).alias("a_red"), item("a", 2).alias("a_blue"), item("b", 1).alias("b_green"))


@_l.add("SELECT * FROM (VALUES ('Acme', 'One', 100.0::DOUBLE, 1.0::DOUBLE), ('Acme', 'One', 200.0, 2.0), ('Bolt', 'X', 50.0, 5.0)) v(maker, model, iso, a)")
def profile_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = lambda iso, a: {"iso": iso, "a": [a] * 3, "b": [a] * 3}
    makers = [
        {"maker": "Acme", "models": [{"model": "One", "profiles": [p(200.0, 2.0), p(100.0, 1.0)]}, {"model": "None", "profiles": []}]},
        {"maker": "Bolt", "models": [{"model": "X", "profiles": [p(50.0, 5.0)]}]},
    ]
    flat = lookup.flatten_profiles(spark.createDataFrame([(makers,)], schemas.PROFILE_DB))
    return flat.select("maker", "model", "iso", F.get("a", F.lit(0)).alias("a"))


@_l.add("SELECT p_brand, count(*) AS n FROM part WHERE p_brand NOT IN (SELECT DISTINCT p_brand FROM part WHERE p_partkey % 50 = 0) GROUP BY p_brand")
def holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    kept = gates.without_holdout(parts, parts.where(F.col("p_partkey") % 50 == 0), "p_brand", required=False)
    return kept.groupBy("p_brand").agg(F.count("*").alias("n"))


@_l.add("""
    SELECT l_orderkey, l_linenumber, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def tiles_with_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("name"), "o_totalprice", F.array(*[F.lit(1.0)] * 4).alias("black_per_channel"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("shard"), "l_linenumber")
    return lookup.tiles_with_shards(lines, shards).where(F.size("black") == 3).select(F.col("shard").alias("l_orderkey"), "l_linenumber", "o_totalprice")
