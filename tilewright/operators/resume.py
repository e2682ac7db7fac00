"""Incremental work: what is done, what is new, what has changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def done_paths(ledger: DataFrame, path: str = "path", retry: Column | None = None) -> DataFrame:
    """Paths with any row that isn't to be retried: one good row is enough, whatever came later."""
    rows = ledger.where(~F.coalesce(retry, F.lit(False))) if retry is not None else ledger
    return rows.select(path).distinct()


def remaining(sources: DataFrame, ledger: DataFrame, path: str = "path", retry: Column | None = None) -> DataFrame:
    """Sources that the ledger doesn't list; a null path is never listed."""
    return sources.join(done_paths(ledger, path, retry), path, "left_anti")


def limit_after(sources: DataFrame, ledger: DataFrame, n: int, path: str = "path", retry: Column | None = None) -> DataFrame:
    """The first `n` of what remains, by path."""
    return remaining(sources, ledger, path, retry).orderBy(path).limit(n)


def limit_before(topics: DataFrame, ledger: DataFrame, n: int, key: str, done_key: Column) -> DataFrame:
    """What remains of the first `n` topics: a resumed run may have nothing left."""
    done = ledger.select(done_key.alias("__done")).where("__done is not null").distinct()
    first = topics.orderBy(key).limit(n)
    return first.join(done, first[key].cast("string") == done["__done"].cast("string"), "left_anti")


def topic_of(path: Column) -> Column:
    """The second part of a ledger path such as forum/<topic>/<file>."""
    return F.get(F.split(path, "/"), F.lit(1))


def unpublished(local: DataFrame, published: DataFrame, name: str = "name") -> DataFrame:
    return local.join(published.select(name).distinct(), name, "left_anti")


def prune_flags(local: DataFrame, published: DataFrame, name: str = "name") -> DataFrame:
    """`local` with column published: what may be deleted here and what stays."""
    index = published.select(F.col(name).alias("__name")).distinct()
    joined = local.join(index, local[name] == index["__name"], "left")
    return joined.withColumn("published", F.col("__name").isNotNull()).drop("__name")


def prune_totals(flags: DataFrame, size: str = "size") -> DataFrame:
    """Files and bytes to delete and to keep."""
    return flags.groupBy("published").agg(F.count("*").alias("n_files"), F.sum(size).alias("n_bytes"))


def manifest_difference(manifest: DataFrame, files: DataFrame, name: str = "name", sha: str = "sha256") -> DataFrame:
    """Names on one side only, and names whose hashes differ: name and problem."""
    left, right = manifest.select(F.col(name), F.col(sha).alias("__listed")), files.select(F.col(name), F.col(sha).alias("__found"))
    sides = left.withColumn("__in", F.lit(True)).join(right.withColumn("__on", F.lit(True)), name, "full_outer")
    problem = (
        F.when(F.col("__on").isNull(), "listed, not there")
        .when(F.col("__in").isNull(), "there, not listed")
        .when(~F.col("__listed").eqNullSafe(F.col("__found")), "sha256 differs")
    )
    return sides.withColumn("problem", problem).where("problem is not null").select(name, "problem")


def merge_new(bundle: DataFrame, dest: DataFrame, published: DataFrame, name: str = "name") -> DataFrame:
    """`bundle` with column is_new: neither in the destination nor published."""
    known = dest.select(F.col(name).alias("__known")).unionByName(published.select(F.col(name).alias("__known"))).distinct()
    joined = bundle.join(known, bundle[name] == known["__known"], "left")
    return joined.withColumn("is_new", F.col("__known").isNull()).drop("__known")


def upsert(current: DataFrame, updates: DataFrame, today: Column, name: str = "name") -> DataFrame:
    """A manifest (name, sha256, size, revision, updated) after `updates` (name, sha256, size).

    The same hash changes nothing; another one raises the revision; a new name begins at 1.
    """
    new = updates.select(F.col(name), F.col("sha256").alias("__sha"), F.col("size").alias("__size"))
    both = current.join(new, name, "full_outer")
    changed = F.col("__sha").isNotNull() & ~F.col("sha256").eqNullSafe(F.col("__sha"))
    take = lambda new, old: F.when(changed, new).otherwise(F.col(old))
    return both.select(
        name,
        take(F.col("__sha"), "sha256").alias("sha256"),
        take(F.col("__size"), "size").alias("size"),
        take(F.coalesce("revision", F.lit(0)) + 1, "revision").alias("revision"),
        take(today, "updated").alias("updated"),
    )


def missing_from(asked: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Set difference."""
    return asked.select(key).subtract(found.select(key))


def symmetric_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right).unionByName(right.subtract(left))


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables hold the same rows as often."""
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def append_index(index: DataFrame, more: DataFrame) -> DataFrame:
    """An index with more names, sorted; repeats stay."""
    return index.unionByName(more).orderBy(*index.columns)
