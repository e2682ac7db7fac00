"""What is refused, what a refresh leaves, and what a rerun repeats."""

import datetime
import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright import runtime, schemas
from tilewright.functions import dates
from tilewright.operators import folds, gates, noise
from tilewright.sources import binary, files, tables


def test_patch_and_split_are_checked(spark):
    assert gates.require_patch(96, 4) == 96
    for patch in (0, 100, -16):
        with pytest.raises(ValueError, match="halved"):
            gates.require_patch(patch, 4)
    rows = spark.createDataFrame([("a",)], "camera string")
    split = "val" if int(hashlib.md5(b"a").hexdigest(), 16) % 10 else "train"
    assert gates.split_rows(rows, split).count() == 0
    with pytest.raises(ValueError, match="too few"):
        gates.split_rows(rows, split, required=True)


def test_category(spark):
    site = spark.createDataFrame([([(1, "a"), (7, "raw")],)], "categories array<struct<id:int,slug:string>>")
    assert files.category_id(site, "raw") == 7
    with pytest.raises(ValueError, match="no category"):
        files.category_id(site, "x")


def test_listing_stops_at_an_empty_page(spark):
    pages = spark.createDataFrame([(0, [(1, "a")], "/1"), (1, [], "/2"), (2, [(2, "b")], "/3")], "page int, topics array<struct<id:int,title:string>>, more_topics_url string")
    assert [r.topic_id for r in files.listed_topics(pages).collect()] == [1]
    assert [r.topic_id for r in files.listed_topics(pages.where("page <> 1")).collect()] == [1, 2]


def test_refresh_keeps_the_old_table_unless_the_new_one_is_good(spark, tmp_path):
    place, fresh = str(tmp_path / "profiles"), tmp_path / "fresh.json"
    db = {"noiseprofiles": [{"maker": "M", "models": [{"model": "X", "profiles": [{"iso": 100, "a": [1, 2, 3], "b": [0, 0, 0]}]}]}]}
    fresh.write_text(json.dumps(db))
    assert tables.refresh_profiles(spark, str(fresh), place, "c1") == 1
    for broken in ({"noiseprofiles": []}, {"noiseprofiles": [{"maker": "M", "models": [{"model": "X", "profiles": [{"iso": 100, "a": [1], "b": [0, 0, 0]}]}]}]}):
        fresh.write_text(json.dumps(broken))
        with pytest.raises(ValueError, match="no profiles"):
            tables.refresh_profiles(spark, str(fresh), place, "c2")
    assert [r.camera for r in tables.current_profiles(spark, place).collect()] == ["M X"]


def test_level_table_names_its_source(spark, tmp_path):
    levels = spark.createDataFrame([("k", 0, "", 0, 1.0, 2.0, None, None, None)], schemas.LEVEL)
    tables.write_levels(levels, str(tmp_path / "levels"), b"source")
    assert spark.read.parquet(str(tmp_path / "levels")).first()["source_sha1"] == hashlib.sha1(b"source").hexdigest()


def test_stamps_are_utc(spark):
    moment = F.lit(datetime.datetime(2024, 5, 6, 23, 8, 9, tzinfo=datetime.timezone.utc))
    found = lambda: tuple(spark.range(1).select(dates.iso_seconds(moment), dates.day(moment), dates.stamp(moment), dates.local_day(moment)).first())
    assert found() == ("2024-05-06T23:08:09+00:00", "20240506", "20240506-230809", "2024-05-06")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert found() == ("2024-05-06T23:08:09+00:00", "20240506", "20240506-230809", "2024-05-07")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_epochs_differ_and_runs_do_not(spark):
    rows = spark.range(200)
    order = lambda epoch, df=rows: {r.id: r.batch for r in folds.shuffled_batches(df, "id", 32, 5, epoch).collect()}
    assert order(0) == order(0, rows.repartition(7)) != order(1) and len(order(0)) == 192


def test_written_file_is_whole_or_not_there(tmp_path):
    binary.write_file(str(tmp_path / "d" / "x.bin"), b"one")
    binary.write_file(str(tmp_path / "d" / "x.bin"), b"two")
    assert [p.name for p in (tmp_path / "d").iterdir()] == ["x.bin"] and (tmp_path / "d" / "x.bin").read_bytes() == b"two"


def tiff(order, entries, tail=b""):
    number = lambda value, size: value.to_bytes(size, "little" if order == b"II" else "big")
    rows = b"".join(number(tag, 2) + number(kind, 2) + number(n, 4) + (value if isinstance(value, bytes) else number(value, 4)) for tag, kind, n, value in entries)
    return order + number(42, 2) + number(8, 4) + number(len(entries), 2) + rows + tail


@pytest.mark.parametrize("order", [b"II", b"MM"])
def test_headers(order):
    short = tiff(order, [(0x0100, 3, 1, 7), (0x010F, 2, 4, b"Abc\0"), (0x0110, 2, 2, b"Z\0\0\0")])
    assert binary.tiff_camera(short) == "Abc Z"
    assert binary.tiff_camera(tiff(order, [(0x0110, 2, 9, 22)], b"Model\xff 1\0")) == "Model� 1"
    assert binary.tiff_camera(tiff(order, [(0x0110, 2, 99, 22)], b"Model 1\0")) is None  # reaches beyond what is there
    assert binary.tiff_camera(tiff(order, [(0x0110, 3, 4, b"Abc\0"), (0x010F, 2, 0, 0)])) is None
    for cut in range(len(short)):
        assert binary.tiff_camera(short[:cut]) in (None, "Abc")
    assert binary.tiff_camera(order + b"\0" * 6) is None and binary.tiff_camera(order) is None


def test_draws_lie_in_their_bounds():
    own = [noise.Knots("c", np.array([100.0, 400.0]), np.array([[1.0] * 3, [4.0] * 3]), np.array([[2.0] * 3, [2.0] * 3]))]
    rng = np.random.default_rng(3)
    drawn = [noise.draw_profile(own, rng, 1.25) for _ in range(500)]
    isos = np.array([iso for *_, iso in drawn])
    assert isos.min() >= 100 and isos.max() <= 400 and np.median(isos) == pytest.approx(200, rel=0.15)
    factors = np.array([b for _, b, *_ in drawn]) / 2
    assert factors.min() >= 0.8 and factors.max() <= 1.25 and np.exp(np.log(factors).mean()) == pytest.approx(1, rel=0.02)


def test_a_cluster_needs_a_shared_folder(spark):
    assert runtime.shared_path(spark, "x") != runtime.shared_path(spark, "x")
