"""Small tables are stored in few files, with all their rows, however many partitions the session has."""

from pathlib import Path

from pyspark.sql import functions as F

from tilewright.llm import common, memory, near_copies


def files(spark):
    return len([x for x in Path(common.shared_dir(spark).removeprefix("file:")).rglob("part-*")])


def test_few_files(spark):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "211")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        rows = spark.range(5_000).groupBy((F.col("id") % 700).alias("k")).agg(F.sum("id").alias("s"), F.collect_list("id").alias("all"))
        before = files(spark)
        found = common.saved_small(rows.withColumn("n", F.monotonically_increasing_id()))
        assert files(spark) - before <= common.CORE_FILES * spark.sparkContext.defaultParallelism
        first = sorted(found.collect())
        assert sorted(found.collect()) == first and len({r.n for r in first}) == 700
        assert {(r.k, r.s, tuple(sorted(r["all"]))) for r in first} == {(k, sum(range(k, 5_000, 700)), tuple(range(k, 5_000, 700))) for k in range(700)}
        assert not spark.sparkContext._jsc.getPersistentRDDs()

        texts = ["one two three four five six seven eight nine ten " * 9 + end for end in ("a", "a", "b", "c d")] + ["quite another text"]
        docs = spark.createDataFrame([(k, text) for k, text in enumerate(texts)], "doc_id long, text string")
        before = files(spark)
        assert [r.doc_id for r in near_copies.keep_first(docs).orderBy("doc_id").collect()] == [0, 4]
        many = files(spark) - before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert many < 40 * 211 / 8


def test_an_empty_table(spark):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "100")
        assert common.saved_small(spark.range(0)).collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_memory_is_one_at_a_time():
    assert memory.held("first", lambda: [1]) == [1]
    assert memory.held("second", dict) == {} and memory.held("first", lambda: [2]) == [2]
