"""Series in order: averages with warm-up, best so far, early stop, windows of steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions import maths


def series(rows: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """One row per series with its values in order; a run's metrics, some thousands of numbers."""
    items = F.array_sort(F.collect_list(F.struct(*order, F.col(value).cast("double").alias("__v"))))
    return rows.groupBy(*by).agg(F.transform(items, lambda x: x["__v"]).alias("values"))


def ema(values: Column, decay: float) -> Column:
    """The average after the last value, starting from the first, with decay min(decay, (1 + step) / (10 + step))."""
    start = F.struct(F.get(values, F.lit(0)).alias("mean"), F.lit(0).alias("step"))

    def step(acc, v):
        d = F.least(F.lit(decay), (acc["step"] + 1.0) / (acc["step"] + 10.0))
        return F.struct((acc["mean"] * d + v * (1 - d)).alias("mean"), (acc["step"] + 1).alias("step"))

    return F.aggregate(F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(1))), start, step, lambda acc: acc["mean"])


def best_so_far(values: Column, gain: float = 0.05, patience: int = 5) -> Column:
    """(best, stale, stopped_at): a value counts as better only if it beats the accepted best by `gain`.

    stale counts values since; at `patience` the run stops, and stopped_at is that
    value's number from 1 (null: never).
    """
    start = F.struct(F.lit(float("-inf")).alias("best"), F.lit(0).alias("stale"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("stopped_at"))

    def step(acc, v):
        better = v > acc["best"] + gain
        stale = F.when(better, 0).otherwise(acc["stale"] + 1)
        new = F.struct(
            F.when(better, v).otherwise(acc["best"]).alias("best"), stale.alias("stale"), (acc["n"] + 1).alias("n"),
            F.when(stale >= patience, acc["n"] + 1).alias("stopped_at"),
        )
        return F.when(acc["stopped_at"].isNotNull(), acc).otherwise(new)

    return F.aggregate(values, start, step, lambda acc: F.struct(acc["best"].alias("best"), acc["stale"].alias("stale"), acc["stopped_at"].alias("stopped_at")))


def stale_checkpoints(checkpoints: DataFrame, keep: int, by: list[str], step: str = "step") -> DataFrame:
    """Checkpoints to delete: all but the newest `keep` of each run; 0 keeps all."""
    if keep <= 0:
        return checkpoints.limit(0)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(step)))
    return checkpoints.withColumn("__rank", rank).where(F.col("__rank") > keep).drop("__rank")


def latest_checkpoint(checkpoints: DataFrame, by: list[str], path: str = "path") -> DataFrame:
    """The path with the largest step in its name, as a number."""
    step = F.regexp_extract(path, r"(\d+)\D*$", 1).try_cast("bigint")
    return checkpoints.groupBy(*by).agg(F.max_by(path, step).alias(path))


def step_windows(metrics: DataFrame, by: list[str], every: int = 100, step: str = "step", loss: str = "loss", seconds: str | None = None, size: int = 1) -> DataFrame:
    """The mean loss of every `every` steps (1 to 100, 101 to 200, ...); with `seconds` (of a step) also samples a second, `size` a step."""
    window = F.ceil(F.col(step) / every).cast("long").alias("window")
    rate = [(F.count("*") * size / F.sum(seconds)).alias("samples_per_second")] if seconds else []
    return metrics.groupBy(*by, window).agg(F.avg(loss).alias("mean_loss"), F.count("*").alias("n_steps"), *rate)


def shuffled_batches(rows: DataFrame, key: str, size: int, seed: int, epoch: int = 0, by: list[str] | None = None) -> DataFrame:
    """Full batches in an order drawn from (seed, epoch, key): the same wherever and however often it runs."""
    drawn = rows.withColumn("__drawn", F.xxhash64(F.lit(seed), F.lit(epoch), F.col(key)))
    return batches(drawn, ["__drawn", key], size, True, by).drop("__drawn")


def preferred_weights(checkpoints: DataFrame, model: str = "model", ema: str = "ema") -> DataFrame:
    """Checkpoints with weights: the averaged ones where there are any."""
    return checkpoints.withColumn("weights", F.coalesce(ema, model))


def append_metrics(metrics: DataFrame, path: str) -> None:
    """A training log grows by a run's rows; what it holds stays."""
    metrics.write.mode("append").json(path)


def batches(rows: DataFrame, order: list, size: int, drop_last: bool, by: list[str] | None = None) -> DataFrame:
    """Rows with their batch number from 0, in order; a short last batch goes if `drop_last`."""
    by = by or []
    place = F.row_number().over(Window.partitionBy(*by or [F.lit(0)]).orderBy(*order)) - 1
    out = rows.withColumn("batch", F.floor(place / size).cast("long"))
    if drop_last:
        out = out.withColumn("__n", F.count("*").over(Window.partitionBy(*by, "batch"))).where(F.col("__n") == size).drop("__n")
    return out


def batch_psnr(errors: DataFrame, batch: str = "batch", error: str = "mse", most: int | None = 50, by: list[str] | None = None) -> DataFrame:
    """The mean over batches of each batch's PSNR: not the PSNR of the mean."""
    by = by or []
    rows = errors.where(F.col(batch) < most) if most else errors
    each = rows.groupBy(*by, batch).agg(F.avg(error).alias("__mse"))
    return each.groupBy(*by).agg(F.avg(maths.psnr(F.col("__mse"))).alias("psnr"), F.count("*").alias("n_batches"))


def progress(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with '[i/n]'; both numbers come from a global order, so this is for reports, not for data."""
    n = F.count("*").over(Window.partitionBy(F.lit(0)))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
    return rows.withColumn("progress", F.concat(F.lit("["), place.cast("string"), F.lit("/"), n.cast("string"), F.lit("]")))
