"""Conditional lookups: sensor levels by camera and ISO, noise profiles between ISOs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions import text

#: A table's white level must be within these times the decoder's.
RATIO_LEAST, RATIO_MOST = 0.6, 1.25


def matches_iso(iso: Column, iso_list: Column, iso_min: Column, iso_max: Column) -> Column:
    """Whether a sensor's conditions name this ISO: its list if it has one, else its range (a missing bound is open)."""
    listed = F.exists(iso_list, lambda v: F.abs(iso - v) < 0.5)
    ranged = (iso_min.isNotNull() | iso_max.isNotNull()) & F.coalesce(iso >= iso_min, F.lit(True)) & F.coalesce(iso <= iso_max, F.lit(True))
    return F.coalesce(iso.isNotNull() & F.when(iso_list.isNotNull(), listed).otherwise(ranged), F.lit(False))


def sensor_arrays(levels: DataFrame) -> DataFrame:
    """One row per camera key with its sensors in order: some thousands of rows, which Spark broadcasts by their size."""
    sensor = F.struct("variant_ix", "sensor_ix", F.coalesce("black", F.lit(0.0)).alias("black"), F.coalesce("white", F.lit(0.0)).alias("white"), "iso_list", "iso_min", "iso_max")
    return levels.groupBy(F.col("key").alias("__level_key")).agg(F.array_sort(F.collect_list(sensor)).alias("__sensors"))


def chosen_level(sensors: Column, iso: Column, white: Column) -> Column:
    """The struct (far, variant_ix, black, white) that a camera's sensors give for an ISO and a decoder's white level, or null.

    Of each variant the first sensor that names the ISO counts, else the first
    without conditions; if its white isn't above its black the variant is out. Of
    the variants the one whose white is nearest in proportion to the decoder's
    wins, the first of equals, and must be within the bounds; without a decoder's
    white the first variant wins as it is.
    """

    def weighed(s: Column) -> Column:
        plain = s["iso_list"].isNull() & s["iso_min"].isNull() & s["iso_max"].isNull()
        choice = F.when(matches_iso(iso, s["iso_list"], s["iso_min"], s["iso_max"]), 0).when(plain, 1)
        return F.struct(s["variant_ix"].alias("variant_ix"), choice.alias("choice"), s["sensor_ix"].alias("sensor_ix"), s["black"].alias("black"), s["white"].alias("white"))

    known = F.coalesce(white > 0, F.lit(False))
    usable = F.array_sort(F.filter(F.transform(sensors, weighed), lambda s: s["choice"].isNotNull()))
    # in order of variant, choice and sensor the first of each variant is its own; then the least by distance
    firsts = lambda own: F.filter(own, lambda s, i: (i == 0) | (s["variant_ix"] != F.get(own, i - 1)["variant_ix"]))
    far = lambda s: F.when(known, F.abs(s["white"] / white - 1.0)).otherwise(0.0)
    rated = lambda own: F.transform(
        F.filter(firsts(own), lambda s: s["white"] > s["black"]), lambda s: F.struct(far(s).alias("far"), s["variant_ix"].alias("variant_ix"), s["black"].alias("black"), s["white"].alias("white"))
    )
    best = F.get(F.transform(F.array(usable), lambda own: F.array_min(rated(own))), F.lit(0))
    return F.get(F.filter(F.array(best), lambda x: x.isNotNull() & (~known | (x["white"] / white).between(RATIO_LEAST, RATIO_MOST))), F.lit(0))


def _with_level(assets: DataFrame, levels: DataFrame, camera: str, iso: str, white: str) -> DataFrame:
    """Every row of `assets` with __level, by `chosen_level`, and without a shuffle while the table of levels can be broadcast."""
    keyed = assets.withColumn("__camera_key", text.norm_key(F.col(camera)))
    joined = keyed.join(sensor_arrays(levels), F.col("__camera_key") == F.col("__level_key"), "left")
    level = chosen_level(F.col("__sensors"), F.col(iso).cast("double"), F.col(white).cast("double"))
    return joined.withColumn("__level", level).drop("__camera_key", "__level_key", "__sensors")


def level_lookup(assets: DataFrame, levels: DataFrame, key: str, camera: str = "camera", iso: str = "iso", white: str = "libraw_white") -> DataFrame:
    """Rows of `assets` that the level table knows: key, level_black, level_white, as `chosen_level` has them."""
    found = _with_level(assets, levels, camera, iso, white).where("__level is not null")
    return found.select(key, F.col("__level.black").alias("level_black"), F.col("__level.white").alias("level_white"))


def resolve_levels(shards: DataFrame, levels: DataFrame, black: str = "black_per_channel", white: str = "white", n_black: int = 3, camera: str = "camera", iso: str = "iso") -> DataFrame:
    """Every shard with norm_black and norm_white: from the table, else the mean of the first `n_black` blacks and the shard's white."""
    own = F.slice(F.col(black).cast("array<double>"), 1, n_black)
    mean = F.aggregate(own, F.lit(0.0), lambda s, b: s + b) / F.size(own)
    return (
        _with_level(shards, levels, camera, iso, white)
        .withColumn("from_table", F.col("__level").isNotNull())
        .withColumn("norm_black", F.coalesce("__level.black", mean))
        .withColumn("norm_white", F.coalesce("__level.white", F.col(white).cast("double")))
        .drop("__level")
    )


def flatten_profiles(db: DataFrame) -> DataFrame:
    """One row per profile of a nested profile table; models without profiles have none."""
    maker = db.select(F.explode("noiseprofiles").alias("m"))
    model = maker.select(F.col("m.maker").alias("maker"), F.explode("m.models").alias("d"))
    row = model.select("maker", F.col("d.model").alias("model"), F.explode("d.profiles").alias("p"))
    return row.select("maker", "model", F.concat_ws(" ", "maker", "model").alias("camera"), F.col("p.iso").alias("iso"), F.col("p.a").alias("a"), F.col("p.b").alias("b"))


def profile_knots(profiles: DataFrame, camera: str = "camera") -> DataFrame:
    """One row per camera with its knots, ascending by ISO: some dozens per camera."""
    return profiles.groupBy(camera).agg(F.array_sort(F.collect_list(F.struct("iso", "a", "b"))).alias("knots"))


def interpolated(knots: Column, iso: Column) -> Column:
    """The struct (iso, a, b) at an ISO: linear between knots, the end knots beyond; a and b element by element."""

    def between(ends: Column) -> Column:
        low, high = ends["low"], ends["high"]
        t = F.when(high["iso"] > low["iso"], (iso - low["iso"]) / (high["iso"] - low["iso"])).otherwise(0.0)
        blend = lambda name: F.zip_with(low[name], high[name], lambda p, q: (1 - t) * p + t * q)
        return F.struct(F.greatest(low["iso"], F.least(iso, high["iso"])).alias("iso"), blend("a").alias("a"), blend("b").alias("b"))

    def ends(n: Column) -> Column:  # n knots are at this ISO or below
        low, high = F.get(knots, n - 1), F.get(knots, n)
        return F.struct(F.coalesce(low, high).alias("low"), F.coalesce(high, low).alias("high"))

    # one search: what it finds is bound by one-element arrays
    place = F.array(F.size(F.filter(knots, lambda k: k["iso"] <= iso)))
    return F.get(F.transform(F.transform(place, ends), between), F.lit(0))


def interpolate(asked: DataFrame, profiles: DataFrame, camera: str = "camera", iso: str = "iso") -> DataFrame:
    """`asked` rows of known cameras with columns a and b at their ISO.

    The knots stay an array per camera, so that no range join is needed: an equi
    join, then a search inside the row.
    """
    knots = profile_knots(profiles).withColumnRenamed("camera", "__camera")
    joined = asked.join(knots, F.col(camera) == F.col("__camera")).withColumn("__at", interpolated(F.col("knots"), F.col(iso).cast("double")))
    return joined.withColumn("a", F.col("__at.a")).withColumn("b", F.col("__at.b")).drop("__camera", "__at", "knots")


def tiles_with_shards(tiles: DataFrame, shards: DataFrame, n_black: int = 3) -> DataFrame:
    """Tiles with their shard's metadata; of the blacks the first `n_black`."""
    meta = shards.withColumnRenamed("name", "shard").withColumn("black", F.slice("black_per_channel", 1, n_black)).drop("black_per_channel")
    return tiles.join(meta, "shard")


def first_candidate(asked: DataFrame, known: DataFrame, key: str, candidates: str, match: str) -> tuple[DataFrame, DataFrame]:
    """(found, left over): each row of `asked` with the row of `known` that its earliest candidate (an array) matches.

    Of several rows with that match the one with the least first other column counts;
    the others go before the join, or a match that many rows have would meet each of
    the rows that ask for it.
    """
    order = F.struct(match, *[c for c in known.columns if c != match][:1])
    one = known.where(F.col(match).isNotNull()).groupBy(F.col(match).alias("__match")).agg(F.min_by(F.struct(*known.columns), order).alias("__known"))
    tried = asked.select(F.col(key), F.posexplode(candidates).alias("__place", "__candidate"))
    hits = tried.join(one, tried["__candidate"] == one["__match"])
    found = hits.groupBy(key).agg(F.min_by("__known", "__place").alias("__known")).select(key, "__known.*")
    return found, asked.join(found.select(key), key, "left_anti")
