"""Sensor mosaics as flat row-major arrays: everything stays inside one row, without explode or shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Colour filter patterns, 0 red, 1 green, 2 blue.
BAYER = ((0, 1), (1, 2))
XTRANS = (
    (1, 1, 0, 1, 1, 2),
    (1, 1, 2, 1, 1, 0),
    (2, 0, 1, 0, 2, 1),
    (1, 1, 2, 1, 1, 0),
    (1, 1, 0, 1, 1, 2),
    (0, 2, 1, 2, 0, 1),
)


def pattern_column(pattern: tuple[tuple[int, ...], ...]) -> Column:
    return F.array(*[F.array(*map(F.lit, row)) for row in pattern])


def three_colours(pattern: Column) -> Column:
    """A pattern that tells two greens apart (3: the second) as one of three colours."""
    return F.transform(pattern, lambda row: F.transform(row, lambda c: F.when(c == 3, 1).otherwise(c)))


def colours(pattern: Column, height: int, width: int, oy: Column | int = 0, ox: Column | int = 0) -> Column:
    """The colour index of every pixel of a crop whose corner is at (oy, ox)."""
    oy, ox = (F.lit(x) if isinstance(x, int) else x for x in (oy, ox))
    row = lambda i: F.get(pattern, F.pmod(F.floor(i / width).cast("int") + oy, F.size(pattern)))
    return F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), lambda i: F.get(row(i), F.pmod(F.pmod(i, F.lit(width)) + ox, F.size(row(i)))))


def one_hot(colour: Column, k: int) -> Column:
    """The plane of one colour as 0 and 1."""
    return F.transform(colour, lambda c: (c == k).cast("float"))


def gather(levels: Column, colour: Column) -> Column:
    """Each pixel's entry of a per-channel vector."""
    return F.transform(colour, lambda c: F.get(levels, c))


def scale(white: Column, black: Column) -> Column:
    """White minus the mean black, at least 1."""
    return F.greatest(white - F.aggregate(black, F.lit(0.0), lambda s, b: s + b) / F.size(black), F.lit(1.0))


def normalized(pixels: Column, colour: Column, black: Column, white: Column) -> Column:
    """(value - its channel's black) / scale, in single precision."""
    by = scale(white.cast("double"), black.cast("array<double>")).cast("float")
    return F.zip_with(pixels, colour, lambda v, c: ((v.cast("float") - F.get(black, c).cast("float")) / by).cast("float"))


def clipped_fraction(values: Column, threshold: float = 0.98) -> Column:
    """The part of values at or above the threshold, compared in single precision; NaN is not."""
    hit = F.filter(values, lambda v: (v.cast("float") >= F.lit(threshold).cast("float")) & ~F.isnan(v))
    return F.size(hit) / F.size(values)


def _mean_step(values: Column, height: int, width: int, rows: bool) -> Column:
    """Mean absolute difference between pixels two apart, down (rows, from even rows) or across (from even columns)."""
    if (height if rows else width) <= 2:
        return F.lit(0.0)
    step = 2 * width if rows else 2
    starts = [y * width + x for y in range(0, height - 2, 2) for x in range(width)] if rows else [y * width + x for y in range(height) for x in range(0, width - 2, 2)]
    at = F.sequence(F.lit(0), F.lit(len(starts) - 1))
    if rows:
        place = lambda k: F.floor(k / width).cast("int") * (2 * width) + F.pmod(k, F.lit(width))
    else:
        n = len(range(0, width - 2, 2))
        place = lambda k: F.floor(k / n).cast("int") * width + F.pmod(k, F.lit(n)) * 2
    value = lambda i: F.get(values, i).cast("double")
    return F.aggregate(at, F.lit(0.0), lambda s, k: s + F.abs(value(place(k) + step) - value(place(k)))) / len(starts)


def texture(values: Column, height: int, width: int) -> Column:
    """Mean absolute two-pixel gradient down plus across: one colour's neighbours, so that the mosaic isn't texture."""
    return _mean_step(values, height, width, True) + _mean_step(values, height, width, False)


def crop(values: Column, width: int, oy: Column | int, ox: Column | int, height_out: int, width_out: int) -> Column:
    """A window of a mosaic."""
    oy, ox = (F.lit(x) if isinstance(x, int) else x for x in (oy, ox))
    at = lambda k: (F.floor(k / width_out).cast("int") + oy) * width + F.pmod(k, F.lit(width_out)) + ox
    return F.transform(F.sequence(F.lit(0), F.lit(height_out * width_out - 1)), lambda k: F.get(values, at(k)))


def flipped(values: Column, height: int, width: int, vertical: Column, horizontal: Column) -> Column:
    """A mosaic, or its colours, turned over along either axis, or both, or none."""
    y = lambda k: F.floor(k / width).cast("int")
    x = lambda k: F.pmod(k, F.lit(width))
    row = lambda k: F.when(vertical, F.lit(height - 1) - y(k)).otherwise(y(k))
    column = lambda k: F.when(horizontal, F.lit(width - 1) - x(k)).otherwise(x(k))
    return F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), lambda k: F.get(values, row(k) * width + column(k)))


def long_form(rows: DataFrame, values: str, width: int, *keep: str) -> DataFrame:
    """One row per pixel: keep, y, x, value; for reports, since arrays stay inside their row everywhere else."""
    pixels = rows.select(*keep, F.posexplode(values).alias("__k", "value"))
    return pixels.select(*keep, F.floor(F.col("__k") / width).cast("int").alias("y"), F.pmod("__k", F.lit(width)).alias("x"), "value")


def from_long_form(pixels: DataFrame, *by: str) -> DataFrame:
    """Row-major arrays from pixels (y, x, value)."""
    return pixels.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("y", "x", "value"))), lambda p: p["value"]).alias("values"))


def planes(noisy: Column, colour: Column, sigma: Column) -> Column:
    """The five input planes: noisy, red, green, blue, sigma."""
    return F.struct(noisy.alias("noisy"), one_hot(colour, 0).alias("r"), one_hot(colour, 1).alias("g"), one_hot(colour, 2).alias("b"), sigma.alias("sigma"))
