"""Queries on metric series: averages, best values, windows, batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import maths
from tilewright.operators import folds, gates
from tilewright.plans.registry import Listing, r6, table

_l = Listing()
QUERIES, ORACLE_SQL = _l.queries, _l.sql

_ERR = "list_avg(list_transform(embedding, lambda v: power(v::DOUBLE - greatest(-0.05, least(0.05, v::DOUBLE)), 2)))"


@_l.add(f"""
    WITH e AS (SELECT (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) // 8 AS batch, label, {_ERR} AS mse FROM embeddings),
    b AS (SELECT label, batch, avg(mse) AS mse FROM e WHERE batch < 50 GROUP BY ALL)
    SELECT label, count(*) AS n_batches, round(avg(CASE WHEN mse <= 1e-12 THEN 99 ELSE 10 * log10(1 / mse) END), 6) AS psnr FROM b GROUP BY label""")
def psnr_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    square = lambda v: F.pow(v.cast("double") - maths.clip(v.cast("double"), -0.05, 0.05), 2)
    mse = F.aggregate(F.transform("embedding", square), F.lit(0.0), lambda s, v: s + v) / F.size("embedding")
    rows = folds.batches(table(spark, sf_dir, "embeddings").select("vec_id", "label", mse.alias("mse")), ["vec_id"], 8, False, ["label"])
    return folds.batch_psnr(rows, "batch", "mse", 50, ["label"]).select("label", "n_batches", r6(F.col("psnr")).alias("psnr"))


@_l.add("""
    SELECT user_id % 10 AS run, ceil((event_id + 1) / 100.0)::BIGINT AS "window", round(avg(value), 6) AS mean_loss, count(*) AS n_steps
    FROM events GROUP BY ALL""")
def loss_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("run"), (F.col("event_id") + 1).alias("step"), F.col("value").alias("loss"))
    return folds.step_windows(rows, ["run"]).select("run", "window", r6(F.col("mean_loss")).alias("mean_loss"), "n_steps")


_SERIES = "SELECT user_id, list(value ORDER BY event_id) AS v FROM events WHERE user_id IS NOT NULL GROUP BY user_id"


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.series(table(spark, sf_dir, "events").where("user_id is not null"), ["user_id"], ["event_id"], "value")


@_l.add(f"""
    WITH RECURSIVE s AS ({_SERIES}),
    f AS (SELECT user_id, v, 1 AS k, v[1] AS mean FROM s
          UNION ALL SELECT user_id, v, k + 1, mean * least(0.9, k / (9.0 + k)) + v[k + 1] * (1 - least(0.9, k / (9.0 + k))) FROM f WHERE k < len(v))
    SELECT user_id, round(mean, 6) AS ema FROM f WHERE k = len(v)""")
def ema_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series(spark, sf_dir).select("user_id", r6(folds.ema(F.col("values"), 0.9)).alias("ema"))


@_l.add(f"""
    WITH RECURSIVE s AS ({_SERIES}),
    f AS (SELECT user_id, v, 0 AS k, '-inf'::DOUBLE AS best, 0 AS stale, NULL::INTEGER AS stop FROM s
          UNION ALL SELECT user_id, v, k + 1, CASE WHEN v[k + 1] > best + 0.05 THEN v[k + 1] ELSE best END,
                           CASE WHEN v[k + 1] > best + 0.05 THEN 0 ELSE stale + 1 END, CASE WHEN v[k + 1] > best + 0.05 OR stale + 1 < 5 THEN NULL ELSE k + 1 END
          FROM f WHERE k < len(v) AND stop IS NULL)
    SELECT user_id, round(best, 6) AS best, stale, stop AS stopped_at FROM f WHERE stop IS NOT NULL OR k = len(v)""")
def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _series(spark, sf_dir).select("user_id", folds.best_so_far(F.col("values")).alias("b"))
    return found.select("user_id", r6(F.col("b.best")).alias("best"), "b.stale", "b.stopped_at")


@_l.add("SELECT event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) > 100")
def ckpt_rotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.stale_checkpoints(table(spark, sf_dir, "events").select("event_type", "event_id"), 100, ["event_type"], "event_id")


@_l.add("SELECT event_type, 'ckpt-0' || max(event_id) || '.pt' AS path FROM events GROUP BY event_type")
def latest_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("ckpt-0"), F.col("event_id").cast("string"), F.lit(".pt"))
    return folds.latest_checkpoint(table(spark, sf_dir, "events").select("event_type", path.alias("path")), ["event_type"])


@_l.add("SELECT event_id, round(0.5 * 0.0002 * (1 + cos(pi() * event_id / 100000.0)), 9) AS lr FROM events")
def cosine_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.round(maths.cosine_lr(F.col("event_id"), 100_000, 2e-4), 9).alias("lr"))


@_l.add("""
    SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'non-finite loss' ELSE 'learning rate 0 before the end' END AS reason
    FROM events WHERE event_id % 50 = 0 OR (event_id % 70 = 0 AND event_id < 5000)""")
def invariant_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    loss = F.when(F.col("event_id") % 100 == 0, float("nan")).when(F.col("event_id") % 50 == 0, float("inf")).otherwise(F.col("value"))
    rows = table(spark, sf_dir, "events").select("event_id", loss.alias("loss"), F.when(F.col("event_id") % 70 == 0, 0.0).otherwise(1e-4).alias("lr"), F.col("event_id").alias("step"))
    return gates.broken_runs(rows, 5000).select("event_id", "reason")


@_l.add("""
    WITH n AS (SELECT event_type, event_id, (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 32 AS batch FROM events)
    SELECT event_type, event_id, batch FROM n QUALIFY count(*) OVER (PARTITION BY event_type, batch) = 32""")
def train_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.batches(table(spark, sf_dir, "events").select("event_type", "event_id"), ["event_id"], 32, True, ["event_type"])


@_l.add("SELECT s_suppkey, '[' || row_number() OVER (ORDER BY s_suppkey) || '/' || count(*) OVER () || ']' AS progress FROM supplier")
def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.progress(table(spark, sf_dir, "supplier").select("s_suppkey"), ["s_suppkey"])
