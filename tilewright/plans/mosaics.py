"""Queries on tiles, mosaics and the noise model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import maths, mosaic
from tilewright.operators import gates, noise, reports, tiles
from tilewright.plans.registry import Listing, r6, table

_l = Listing()
QUERIES, ORACLE_SQL = _l.queries, _l.sql

SIDE, CLIP, LEAST_TEXTURE, MOST_CLIPPED = 8, 0.25, 0.2, 0.02

_DOWN = [y * 8 + x for y in (0, 2, 4) for x in range(8)]
_ACROSS = [y * 8 + x for y in range(8) for x in (0, 2, 4)]
_SCORES = f"""
    SELECT vec_id, label,
           list_sum(list_transform(embedding, lambda v: CASE WHEN v >= {CLIP}::FLOAT THEN 1 ELSE 0 END)) / 64.0 AS clipped,
           list_avg(list_transform({_DOWN}, lambda i: abs(embedding[i + 17]::DOUBLE - embedding[i + 1]::DOUBLE)))
           + list_avg(list_transform({_ACROSS}, lambda i: abs(embedding[i + 3]::DOUBLE - embedding[i + 1]::DOUBLE))) AS texture,
           ((vec_id // 16) % 8 * 2)::INTEGER AS oy, (vec_id % 16 * 2)::INTEGER AS ox
    FROM embeddings"""


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    rows = tiles.scored(rows, "embedding", SIDE, SIDE, CLIP)
    return rows.select("vec_id", "label", "clipped", "texture", (F.floor(F.col("vec_id") / 16) % 8 * 2).cast("int").alias("oy"), (F.col("vec_id") % 16 * 2).cast("int").alias("ox"))


@_l.add(f"SELECT vec_id, round(clipped, 6) AS clipped, round(texture, 6) AS texture FROM ({_SCORES})")
def tile_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("vec_id", r6(F.col("clipped")).alias("clipped"), r6(F.col("texture")).alias("texture"))


_PASSES = f"clipped <= {MOST_CLIPPED} AND texture >= {LEAST_TEXTURE}"


@_l.add(f"SELECT label, count(*) AS n_tiles, count(*) FILTER (WHERE {_PASSES}) AS n_good FROM ({_SCORES}) GROUP BY label")
def tile_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = gates.tile_gate(F.col("clipped"), F.col("texture"), MOST_CLIPPED, LEAST_TEXTURE)
    return _scores(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n_tiles"), F.count_if(good).alias("n_good"))


@_l.add(f"""
    WITH good AS (SELECT label, oy, ox, max(texture) AS texture FROM ({_SCORES}) WHERE {_PASSES} GROUP BY label, oy, ox),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY texture DESC, oy DESC, ox DESC) AS rank FROM good)
    SELECT label, rank::INTEGER AS rank, oy, ox, round(texture, 6) AS texture FROM ranked WHERE rank <= 5""")
def tile_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scores(spark, sf_dir).where(gates.tile_gate(F.col("clipped"), F.col("texture"), MOST_CLIPPED, LEAST_TEXTURE))
    # tiles at the same place of a source: the most textured stands for them
    rows = rows.groupBy("label", "oy", "ox").agg(F.max("texture").alias("texture"), F.min("clipped").alias("clipped"))
    best = tiles.best_tiles(rows, "label", 5, MOST_CLIPPED, LEAST_TEXTURE)
    return best.select("label", "rank", "oy", "ox", r6(F.col("texture")).alias("texture"))


_BLACK, _WHITE = [512.0, 520.0, 530.0, 515.0], 15000.0
_ADU = "list_transform(embedding, lambda v: floor((v::DOUBLE + 1) * 8000)::INTEGER)"


def _adu(column: str = "embedding"):
    return F.transform(column, lambda v: F.floor((v.cast("double") + 1) * 8000).cast("int"))


@_l.add(f"""
    WITH adu AS (SELECT vec_id, {_ADU} AS px FROM embeddings),
    n AS (SELECT vec_id, list_transform(range(64), lambda i: ((px[i + 1]::FLOAT - ([512, 520, 515, 530]::FLOAT[])[((i // 8) % 2) * 2 + i % 2 + 1]) / (15000 - 519.25)::FLOAT)::FLOAT) AS v FROM adu)
    SELECT vec_id, round(v[1]::DOUBLE, 6) AS first, round(v[64]::DOUBLE, 6) AS last,
           round(list_avg(list_transform(v, lambda x: x::DOUBLE)), 6) AS mean FROM n""")
def mosaic_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = mosaic.pattern_column(((0, 1), (3, 2)))
    black = F.array(*[F.lit(b) for b in _BLACK])
    rows = table(spark, sf_dir, "embeddings").select("vec_id", _adu().alias("px"), mosaic.colours(pattern, SIDE, SIDE).alias("c"))
    rows = rows.withColumn("v", mosaic.normalized(F.col("px"), F.col("c"), black, F.lit(_WHITE)))
    mean = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double")) / F.size("v")
    return rows.select("vec_id", r6(F.get("v", F.lit(0)).cast("double")).alias("first"), r6(F.get("v", F.lit(63)).cast("double")).alias("last"), r6(mean).alias("mean"))


_X = [c for row in mosaic.XTRANS for c in row]


@_l.add(f"""
    SELECT vec_id, list_aggregate(list_transform(range(64), lambda i: ({_X})[((i // 8 + vec_id) % 6) * 6 + (i % 8 + vec_id // 6) % 6 + 1]), 'string_agg', '') AS colours
    FROM embeddings""")
def cfa_colours(spark: SparkSession, sf_dir: str) -> DataFrame:
    oy, ox = (F.col("vec_id") % 6).cast("int"), (F.floor(F.col("vec_id") / 6) % 6).cast("int")
    found = mosaic.colours(mosaic.pattern_column(mosaic.XTRANS), SIDE, SIDE, oy, ox)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.array_join(found.cast("array<string>"), "").alias("colours"))


@_l.add(f"""
    WITH c AS (SELECT unnest(list_transform(range(64), lambda i: ({_X})[((i // 8 + vec_id) % 6) * 6 + (i % 8) % 6 + 1])) AS colour FROM embeddings)
    SELECT colour::INTEGER AS colour, count(*) AS n FROM c GROUP BY colour""")
def colour_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(mosaic.colours(mosaic.pattern_column(mosaic.XTRANS), SIDE, SIDE, (F.col("vec_id") % 6).cast("int")).alias("c"))
    return reports.colour_histogram(rows, "c")


_ONE_HOT = ", ".join(f"round(list_sum(list_transform(range(64), lambda i: CASE WHEN ({_X})[((i // 8 + vec_id) % 6) * 6 + (i % 8) % 6 + 1] = {k} THEN embedding[i + 1]::DOUBLE ELSE 0 END)), 6) AS {c}" for k, c in enumerate(("red", "green", "blue")))


@_l.add(f"SELECT vec_id, {_ONE_HOT} FROM embeddings")
def one_hot_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sum of each colour's pixels: values weighed by the one-hot planes."""
    found = mosaic.colours(mosaic.pattern_column(mosaic.XTRANS), SIDE, SIDE, (F.col("vec_id") % 6).cast("int"))
    own = lambda k: F.zip_with("embedding", mosaic.one_hot(found, k), lambda v, w: v.cast("double") * w.cast("double"))
    total = lambda k: r6(F.aggregate(own(k), F.lit(0.0), lambda s, v: s + v))
    return table(spark, sf_dir, "embeddings").select("vec_id", total(0).alias("red"), total(1).alias("green"), total(2).alias("blue"))


@_l.add("SELECT vec_id, 16.0::DOUBLE AS red, 32.0::DOUBLE AS green, 16.0::DOUBLE AS blue FROM embeddings")
def one_hot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mosaic.colours(mosaic.three_colours(mosaic.pattern_column(((0, 1), (3, 2)))), SIDE, SIDE)
    total = lambda k: F.aggregate(mosaic.one_hot(found, k), F.lit(0.0), lambda s, v: s + v.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", total(0).alias("red"), total(1).alias("green"), total(2).alias("blue"))


@_l.add("""
    SELECT vec_id,
           round(list_sum(list_transform(range(16), lambda k: (k + 1) * embedding[((k // 4) + (vec_id % 3)) * 8 + k % 4 + vec_id % 5 + 1]::DOUBLE)), 6) AS cropped,
           round(list_sum(list_transform(range(64), lambda k: (k + 1) * embedding[(CASE WHEN vec_id % 2 = 0 THEN 7 - k // 8 ELSE k // 8 END) * 8 + (CASE WHEN vec_id % 3 = 0 THEN 7 - k % 8 ELSE k % 8 END) + 1]::DOUBLE)), 6) AS flipped
    FROM embeddings""")
def flip_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    oy, ox = (F.col("vec_id") % 3).cast("int"), (F.col("vec_id") % 5).cast("int")
    window = mosaic.crop(F.col("embedding"), SIDE, oy, ox, 4, 4)
    turned = mosaic.flipped(F.col("embedding"), SIDE, SIDE, F.col("vec_id") % 2 == 0, F.col("vec_id") % 3 == 0)
    weigh = lambda a: F.aggregate(F.transform(a, lambda v, i: (i + 1) * v.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return rows.select("vec_id", r6(weigh(window)).alias("cropped"), r6(weigh(turned)).alias("flipped"))


_AB = "CASE event_type WHEN 'click' THEN 0.01 WHEN 'view' THEN 0.02 ELSE -0.001 END"
_LINE = f"({_AB}) * greatest(value, 0.0) + 0.0005"


@_l.add(f"SELECT event_id, round(sqrt(greatest({_LINE}, 1e-12)), 6) AS sigma, round(greatest({_LINE}, 0.0), 6) AS variance FROM events")
def sigma_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.when(F.col("event_type") == "click", 0.01).when(F.col("event_type") == "view", 0.02).otherwise(-0.001)
    b, x = F.lit(0.0005), F.col("value")
    return table(spark, sf_dir, "events").select("event_id", r6(maths.sigma(x, a, b)).alias("sigma"), r6(maths.variance_line(x, a, b)).alias("variance"))


@_l.add("SELECT event_id, round(round_even(value / 0.25, 0) * 0.25, 6) AS quantized, round(greatest(10.0, least(60.0, value)), 6) AS clipped FROM events")
def quantize_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return rows.select("event_id", r6(maths.quantize(F.col("value"), 0.25)).alias("quantized"), r6(maths.clip(F.col("value"), 10.0, 60.0)).alias("clipped"))


@_l.add("""
    SELECT p_partkey, p_size >= 16 + 6 AS fits, CASE WHEN p_size >= 16 THEN (p_size - 16) // 6 END AS span FROM part""")
def aligned_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part")
    size = F.col("p_size")
    span = F.when(size >= 16, maths.aligned_span(F.greatest(size, F.lit(16)), F.lit(16), F.lit(6)))
    return rows.select("p_partkey", gates.frame_fits(size, size, 16, 6, 6).alias("fits"), span.cast("int").alias("span"))


def _profiles(spark: SparkSession) -> DataFrame:
    rows = [("Acme", "One", float(iso), [a, a, a], [a / 10] * 3) for iso, a in ((100, 1e-4), (200, 2e-4), (800, 5e-4))]
    rows += [("Acme", "Two", float(iso), [a, 2 * a, a], [a / 5] * 3) for iso, a in ((50, 5e-5), (6400, 4e-3))]
    return spark.createDataFrame(rows, "maker string, model string, iso double, a array<double>, b array<double>").selectExpr("*", "concat_ws(' ', maker, model) as camera")


@_l.add()
def profile_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noise.sample_profiles(table(spark, sf_dir, "embeddings").select("vec_id"), _profiles(spark), "vec_id")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("tile_id"), _adu().alias("pixels"), F.lit(512.0).alias("norm_black"), F.lit(15000.0).alias("norm_white"))
    return noise.training_pairs(rows, _profiles(spark), mosaic.BAYER, side=SIDE, patch=4, seed=7)


@_l.add()
def training_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)


@_l.add()
def noise_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = _pairs(spark, sf_dir).select(F.explode(F.arrays_zip("noisy", "clean", "colours")).alias("p"))
    return reports.residual_stats(pixels.select(F.col("p.colours").alias("channel"), (F.col("p.noisy") - F.col("p.clean")).cast("double").alias("residual")))


@_l.add()
def candidate_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size") + 8
    drawn = noise.candidate_offsets(F.lit(noise.DEFAULT_SEED), F.col("p_partkey"), size, size, 16, F.lit(2), F.lit(2))
    return table(spark, sf_dir, "part").select("p_partkey", F.posexplode(drawn).alias("draw", "o")).select("p_partkey", "draw", "o.oy", "o.ox")


@_l.add("""
    SELECT event_type AS channel, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS variance, count(*) AS n FROM events GROUP BY event_type""")
def residual_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.residual_stats(table(spark, sf_dir, "events"), "event_type", "value")
    return found.select(F.col("event_type").alias("channel"), r6(F.col("mean")).alias("mean"), r6(F.col("variance")).alias("variance"), "n")
