"""Tiles from frames, isolated workers, bundles."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.functions import mosaic
from tilewright.operators import contribution, harvest


def frame(pattern, height=1200, width=1600):
    rng = np.random.default_rng(0)
    y, x = np.mgrid[0:height, 0:width]
    light = 0.45 + 0.25 * np.sin(x / 9) * np.cos(y / 7) + 0.02 * rng.standard_normal((height, width))
    light[:, : width // 8] = 1.2
    light[height // 2 : height // 2 + 100] = 0.4
    cfa = np.array(pattern)
    colours = np.tile(cfa, (-(-height // cfa.shape[0]), -(-width // cfa.shape[1])))[:height, :width]
    return {"adu": np.clip(light * 14488 + 512, 0, 65535).astype(np.uint16), "colours4": colours, "pattern": cfa, "black": [512.0] * 4, "white": 15000.0}


@pytest.mark.parametrize("pattern", [mosaic.BAYER, mosaic.XTRANS])
def test_picked_tiles(pattern):
    own = frame(pattern)
    found = harvest.pick_tiles(own, np.random.default_rng(1), n=8)
    assert 1 <= len(found) <= 8 and len({(y, x) for y, x, _ in found}) == len(found)
    textures = []
    for y, x, pixels in found:
        assert pixels.shape == (256, 256) and pixels.dtype == np.uint16 and y % len(pattern) == 0 and x % len(pattern) == 0
        clipped, texture = harvest.score((pixels.astype(np.float32) - 512) / np.float32(14488))
        textures.append(texture)
        assert clipped <= 0.02
    assert textures == sorted(textures, reverse=True)
    assert harvest.pick_tiles(frame(pattern, 100, 100), np.random.default_rng(1)) == []


def test_scores():
    assert harvest.score(np.full((64, 64), 0.4, np.float32)) == (0.0, 0.0)
    assert harvest.score(np.ones((64, 64), np.float32))[0] == 1.0
    assert harvest.score(np.random.default_rng(0).uniform(0, 0.9, (64, 64)).astype(np.float32))[1] > 0.01


def healthy():
    return {"status": "harvested"}


def test_isolation():
    assert harvest.isolated(healthy, (), 60) == {"status": "harvested"}
    crash = harvest.isolated(os.abort, (), 60)
    assert crash["status"] == "error" and "crashed" in crash["reason"]
    hang = harvest.isolated(time.sleep, (60,), 2)
    assert hang["status"] == "error" and "hang" in hang["reason"]


def test_harvest(spark):
    def decode(content):
        if content == b"garbage":
            raise OSError("not a raw file")
        size = int(content)
        if not size:
            return None
        rng = np.random.default_rng(size)
        adu = (rng.uniform(0, 0.8, (size, size)) * 10000).astype(np.uint16)
        return {"adu": adu, "colours4": np.zeros((size, size), int), "pattern": np.zeros((2, 2), int), "black": [0.0], "white": 10000.0}

    assets = spark.createDataFrame([(str(c), bytearray(c)) for c in (b"garbage", b"0", b"30", b"12")], "path string, content binary")
    rows = {r.path: r for r in harvest.harvest(assets, decode, tile=16, n=4).collect()}
    assert {p: r.status for p, r in rows.items()} == {"b'garbage'": "error", "b'0'": "rejected", "b'30'": "harvested", "b'12'": "rejected"}
    assert rows["b'30'"].n_tiles == 4 and len(rows["b'30'"].tiles[0].pixels) == 256
    again = harvest.harvest(assets.repartition(4), decode, tile=16, n=4).where("status = 'harvested'").first()
    assert again.tiles == rows["b'30'"].tiles
    merged = harvest.merged_record(spark.createDataFrame([("b'30'", 100), ("x", 200)], "path string, iso int"), harvest.harvest(assets, decode, tile=16, n=4).drop("tiles"))
    assert {(r.path, r.iso, r.status) for r in merged.collect()} == {("b'30'", 100, "harvested"), ("x", 200, "rejected")}


def test_topics(spark):
    topics = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "topic_id int, links array<string>")
    rows = harvest.topic_records(topics, F.col("links")).collect()
    assert sorted((r.topic_id, r.url or "", r.reason or "") for r in rows) == [(1, "a", ""), (1, "b", ""), (2, "", "no raw links")]


def test_bundles(spark, tmp_path):
    shards = spark.createDataFrame([("a.npz", "1", "X", 3), ("jo_b.npz", "2", "Y", 4), ("c.npz", "3", "X", 5)], "name string, sha256 string, camera string, n_tiles int")
    row = contribution.manifest(shards, "jo", "2025-01-01", "CC0", "mine").first()
    assert (row.n_shards, row.n_tiles, row.cameras) == (3, 12, {"X": 8, "Y": 4})
    assert row.files == {"jo_a.npz": "1", "jo_b.npz": "2", "jo_c.npz": "3"}
    with pytest.raises(ValueError, match="same name"):
        contribution.manifest(shards.unionByName(spark.createDataFrame([("b.npz", "9", "X", 1)], shards.schema)), "jo", "", "", "")
    with pytest.raises(ValueError, match="no contributor"):
        contribution.manifest(shards, "your-name", "", "", "")
    line = contribution.registry_line(contribution.manifest(shards, "jo", "d", "CC0", "mine"), 2, "now", "url", "00")
    contribution.append_registry(line, str(tmp_path / "registry"))
    assert spark.read.json(str(tmp_path / "registry")).first().n_shards_new == 2


def test_publish_resumes(spark, tmp_path):
    shards = spark.createDataFrame([(f"{k}.npz", 4) for k in range(5)], "name string, size long")
    sent, index = [], str(tmp_path / "index")

    def upload(k, rows):
        if len(sent) == 1 and not resumed:
            raise ConnectionError
        sent.append(sorted(r.name for r in rows.collect()))

    resumed = False
    with pytest.raises(ConnectionError):
        contribution.publish(shards, upload, index, cap=8)
    resumed = True
    assert contribution.publish(shards, upload, index, cap=8) == 2
    assert sent == [["0.npz", "1.npz"], ["2.npz", "3.npz"], ["4.npz"]]
    with pytest.raises(PermissionError):
        contribution.publish(shards.withColumn("private", F.lit(True)), upload, index)


def test_reuse(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for fingerprint, version, n in (("a", 1, 1), ("a", 1, 1), ("b", 1, 2), ("b", 2, 3)):
        assert contribution.reused(spark, str(tmp_path / "t"), fingerprint, version, build).count() == 3
        assert len(calls) == n
