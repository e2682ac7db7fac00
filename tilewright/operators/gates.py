"""Accept or reject with a reason: ordered tests as one CASE, the first that fails names the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions import hashing, text

#: The columns that a shard must have.
REQUIRED_KEYS = ("tiles", "offsets", "pattern", "pattern4", "black_per_channel", "white", "wb", "iso", "camera", "source_path")


def cascade(*tests: tuple[Column, Column | str]) -> Column:
    """The reason of the first test that holds, null if none does; a null test doesn't hold."""
    out = F.lit(None).cast("string")
    for test, reason in reversed(tests):
        out = F.when(F.coalesce(test, F.lit(False)), F.lit(reason) if isinstance(reason, str) else reason).otherwise(out)
    return out


def with_status(rows: DataFrame, reason: Column, accepted: str = "accepted") -> DataFrame:
    """Add status and reason."""
    return rows.withColumn("reason", reason).withColumn("status", F.when(F.col("reason").isNull(), accepted).otherwise("rejected"))


def has_extension(path: Column, extensions: tuple[str, ...] = text.RAW_EXTENSIONS) -> Column:
    return F.coalesce(text.file_extension(path).isin(*extensions), F.lit(False))


def included(path: Column, part: str) -> Column:
    """Substring test; an empty one lets everything pass."""
    return path.contains(part) if part else F.lit(True)


def iso_gate(iso: Column, most: int) -> Column:
    """Reason by an ISO read as text: it must be digits and at most `most`. Zero passes here."""
    digits = iso.rlike(r"^[0-9]+\z")
    number = iso.try_cast("bigint")
    return cascade((~F.coalesce(digits, F.lit(False)), "no ISO in EXIF"), (digits & (number.isNull() | (number > most)), F.concat(F.lit("ISO "), iso, F.lit(f" > {most}"))))


def library_gate(preset: Column, image_id: Column, missing: Column, path: Column, iso: Column, most: int) -> Column:
    """Reason of a library entry: preset, unknown id, no file, no raw suffix, no ISO, too high an ISO, in this order."""
    return cascade(
        (preset.isNotNull(), preset),
        (image_id.isNotNull() & path.isNull(), "image id not in library"),
        (missing, "file missing"),
        (~has_extension(path), "unsupported extension"),
        (iso.isNull() | (iso <= 0), "no ISO"),
        (iso > most, text.iso_reason(iso, most)),
    )


def license_gate(tag: Column, allowed: tuple[str, ...]) -> Column:
    """'all' lets everything pass, undeclared licences too; else the tag must be listed."""
    return F.lit(True) if "all" in allowed else F.coalesce(tag.isin(*allowed), F.lit(False))


def tile_gate(clipped: Column, texture: Column, most_clipped: float = 0.02, least_texture: float = 1e-4) -> Column:
    """Both bounds inclusive; NaN fails."""
    return (clipped <= most_clipped) & (texture >= least_texture) & ~F.isnan(clipped) & ~F.isnan(texture)


def frame_fits(height: Column, width: Column, tile: int, period_y: Column | int, period_x: Column | int) -> Column:
    """A frame is large enough for a tile and one period beside it."""
    return (height >= F.lit(tile) + period_y) & (width >= F.lit(tile) + period_x)


def three_colour(n_colours: Column) -> Column:
    return F.coalesce(n_colours == 3, F.lit(False))


def shard_reason(tile_size: int = 256, max_iso: int = 200, names: dict[str, str] | None = None) -> Column:
    """Why a shard is invalid, null if it is valid.

    Columns, by default of these names: error, keys (array of what it has), dtype,
    shape (array), n_offsets, iso. Order: unreadable, missing keys, dtype, shape,
    empty, offsets, ISO.
    """
    c = {k: F.col((names or {}).get(k, k)) for k in ("error", "keys", "dtype", "shape", "n_offsets", "iso")}
    missing = F.array_except(F.array(*map(F.lit, REQUIRED_KEYS)), c["keys"])
    n = F.get(c["shape"], F.lit(0))
    square = (F.size(c["shape"]) == 3) & (F.get(c["shape"], F.lit(1)) == tile_size) & (F.get(c["shape"], F.lit(2)) == tile_size)
    return cascade(
        (c["error"].isNotNull(), F.concat(F.lit("unreadable: "), c["error"])),
        (F.size(missing) > 0, F.concat(F.lit("missing keys: "), F.array_join(missing, ", "))),
        (c["dtype"] != "uint16", F.concat(F.lit("tiles dtype "), c["dtype"], F.lit(", expected uint16"))),
        (~square, F.concat(F.lit("tiles shape ("), F.array_join(c["shape"].cast("array<string>"), ", "), F.lit(f"), expected (N, {tile_size}, {tile_size})"))),
        (n == 0, "empty shard (0 tiles)"),
        (c["n_offsets"] != n, "offsets/tiles length mismatch"),
        (~F.coalesce((c["iso"] > 0) & (c["iso"] <= max_iso), F.lit(False)), F.concat(F.lit("ISO "), F.bround(c["iso"], 0).cast("long").cast("string"), F.lit(f" outside (0, {max_iso}]"))),
    )


def require(rows: DataFrame, wrong: Column, message: str) -> DataFrame:
    """`rows`, raising `message` when one that is `wrong` is read."""
    first = rows.columns[0]
    return rows.withColumn(first, F.when(F.coalesce(wrong, F.lit(False)), F.raise_error(F.lit(message)).cast(rows.schema[first].dataType)).otherwise(F.col(first)))


def require_count(rows: DataFrame, least: int = 1, most: int | None = None, what: str = "rows") -> DataFrame:
    """Raise unless there are `least` to `most` rows; looks at `most` + 1 rows at most."""
    n = rows.limit((most if most is not None else least) + 1).count()
    if n < least or (most is not None and n > most):
        raise ValueError(f"{what}: {'too few' if n < least else 'more than ' + str(most)}")
    return rows


def require_public(rows: DataFrame, private: str = "private") -> DataFrame:
    """Refuse to publish anything while a row is marked private."""
    if rows.where(F.col(private)).limit(1).count():
        raise PermissionError("a source is marked private; nothing of it may be published")
    return rows


def one_tile_size(shards: DataFrame, n_tiles: str = "n_tiles", tile_size: str = "tile_size") -> DataFrame:
    """Shards with tiles; raises if their tile sizes differ."""
    filled = shards.where(F.col(n_tiles) > 0)
    found = filled.agg(F.min(tile_size), F.max(tile_size)).first()
    if found[0] != found[1]:
        raise ValueError(f"tile sizes differ: {found[0]} and {found[1]}")
    return filled


def without_holdout(profiles: DataFrame, holdout: DataFrame, camera: str = "camera", required: bool = True) -> DataFrame:
    """Profiles of cameras that aren't held out; if `required`, none left is an error."""
    kept = profiles.join(holdout.select(camera).distinct(), camera, "left_anti")
    return require_count(kept, what="cameras left after the holdout") if required else kept


def split_rows(rows: DataFrame, split: str, camera: str = "camera", buckets: int = 10, required: bool = False) -> DataFrame:
    """The rows whose camera falls into `split`; if `required`, none is an error."""
    found = rows.where(hashing.camera_split(F.col(camera), buckets) == split)
    return require_count(found, what=f"rows of the split {split!r}") if required else found


def require_patch(patch: int, depth: int) -> int:
    """A patch is halved `depth` times, so its side must be a multiple of that power of two."""
    if patch <= 0 or patch % 2**depth:
        raise ValueError(f"a patch of {patch} can't be halved {depth} times")
    return patch


def validation_rows(rows: DataFrame, camera: str = "camera", buckets: int = 10) -> DataFrame:
    """The validation split, or the training one if that is empty."""
    val = split_rows(rows, "val", camera, buckets)
    return val if val.limit(1).count() else split_rows(rows, "train", camera, buckets)


def broken_runs(metrics: DataFrame, total: int, loss: str = "loss", lr: str = "lr", step: str = "step") -> DataFrame:
    """Rows that show a broken run: a loss that isn't finite, or a rate of 0 before the end."""
    bad_loss = F.isnan(loss) | (F.abs(F.col(loss)) == float("inf"))
    reason = cascade((bad_loss, "non-finite loss"), ((F.col(lr) == 0) & (F.col(step) < total), "learning rate 0 before the end"))
    return metrics.withColumn("reason", reason).where("reason is not null")
