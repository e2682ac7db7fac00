"""Exact cases of the functions."""

import hashlib
import io
import struct
import tarfile

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright import schemas
from tilewright.functions import hashing, maths, mosaic, text
from tilewright.operators import folds, gates, library, lookup, noise, packing, resume
from tilewright.plans import calibration, texts
from tilewright.sources import binary, files, tables
from tilewright.streaming import ledger as ledger_stream


def one(spark, column, *values):
    df = spark.createDataFrame([values], " , ".join(f"c{k} string" for k in range(len(values)))) if values else spark.range(1)
    return df.select(column).first()[0]


@pytest.mark.parametrize(("name", "key"), [("Zenith Corp. ZENITH Zenith-3M", "zenith 3m"), (" \u00c9clair GmbH 16/mm ", "clair 16 mm"), ("Ltd. Co", ""), ("a A b a", "a b a"), ("Corps 5", "corps 5")])
def test_norm_key(spark, name, key):
    assert one(spark, text.norm_key(F.col("c0")), name) == key


@pytest.mark.parametrize(
    ("html", "tag"),
    [
        ("see http://CreativeCommons.org/licenses/by-nd/2.0, not CC0", "by-nd"),
        ("creativecommons.org/publicdomain/mark/1.0/", "cc0"),
        ("put into the public<br>domain", "cc0"),
        ("CC BY noncommercial, share alike", "by-nc-sa"),
        ("<i>cc-by</i> 3.0", "by"),
        ("creative<b>commons</b>: NC", "by-nc"),
        ("all rights kept, accby cc09", None),
        ("", None),
    ],
)
def test_license(spark, html, tag):
    assert one(spark, text.detect_license(F.col("c0")), html) == tag


@pytest.mark.parametrize(
    "html",
    [
        "creative commons \u00e9sa", "creative commons nc\u00e9", "creative commons \u4e2dnc\u6587 sa\u0301", "creative commons s\u00e1 anc nc_", "x\u00e9cc0",
        "creative\x0bcommons", "creative\u00a0commons", "creative\t\r\n\fcommons", "CREATIVECOMMON\u017f.org/licenses/by-\u017fa/", "creativecommons.org/licenses/\u212a\u0130",
        "creative commons \u017fa", "creative commons x\u017fa", "cc by \u017fhare ali\u212ae", "publ\u0131c domain", "cc-by non-commerc\u0130al", None,
    ],
)
def test_license_as_sql_has_it(spark, html):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT 1 AS doc_id, ?::VARCHAR AS text", [html])
    assert one(spark, text.detect_license(F.col("c0")), html) == con.execute(texts.ORACLE_SQL["detect_license"]).fetchone()[1]


def test_license_gate_as_sql_has_it(spark, tmp_path):
    # page 3 of 6 says Creative Commons, Share-Alike; the words that follow decide about -nc
    pages = [(3, "canci\u00f3nc"), (9, "nc\u00e9"), (15, "nca"), (21, "\u4e2dnc"), (27, "NC."), (33, None), (1, ""), (5, "creative\x0bcommons"), (11, "\u00e9cc0")]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    own = texts.license_gate(spark, str(tmp_path)).select("page_id", "allowed").collect()
    assert sorted(map(tuple, own)) == sorted(con.execute(texts.ORACLE_SQL["license_gate"]).fetchall())


@pytest.mark.parametrize("name", ["license_gate", "license_report"])
def test_license_of_any_page_as_sql_has_it(spark, tmp_path, name):
    pages = [(k, html) for k in (*range(-14, 15), -(2**62), 2**62, None) for html in ("", "x", "sa", None)]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    own = texts.QUERIES[name](spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, own))) == sorted(map(str, con.execute(texts.ORACLE_SQL[name]).fetchall()))


def test_links(spark):
    html = """<p><a class="x" href="one.CR2">1</a> <a href="//cdn.site/two.rw2?v=3">2</a> <a href='three.nef'> <a href="/p/four.png"><a href="sub/five.dng"><a href="one.CR2"> <a href="six.X3F">"""
    found = one(spark, text.raw_links(F.col("c0"), F.lit("https://board.site/topic/77/")), html)
    assert found == ["https://board.site/topic/77/one.CR2", "https://cdn.site/two.rw2?v=3", "https://board.site/topic/77/sub/five.dng"]
    assert one(spark, text.resolve_urls(F.lit("https://board.site/topic/77/"), F.array(F.lit("./../up.raf")))) == ["https://board.site/topic/up.raf"]


@pytest.mark.parametrize(("spec", "ids"), [("7", [7]), ("3-5,4-6,1", [1, 3, 4, 5, 6]), (",,8 - 9,", [8, 9]), ("20-19,\t2", [2]), (" ", [])])
def test_parse_ids(spark, spec, ids):
    assert one(spark, text.parse_ids(F.col("c0")), spec) == ids


@pytest.mark.parametrize(("handle", "good"), [("your-github-name", False), ("your-name", False), ("YOUR-GITHUB-NAME", False), ("handle", False), ("username", False), ("Jane Doe", False), ("jane-doe", True), (None, False)])
def test_handles(spark, handle, good):
    assert one(spark, text.valid_handle(F.col("c0").cast("string")), handle) is good


def test_paths(spark):
    assert one(spark, text.file_extension(F.col("c0")), "a/b.c/X.NEF") == ".nef"
    assert one(spark, text.file_extension(F.col("c0")), "a/.nef") == ""
    assert one(spark, text.link_extension(F.col("c0")), "/up/.nef?x=1") == ".nef"
    assert one(spark, text.iso_reason(F.lit(2.5), 2)) == "ISO 2 > 2"


def test_split_is_the_whole_md5(spark):
    for name in ("Acme One", "", "é"):
        expect = "val" if int(hashlib.md5(name.encode()).hexdigest(), 16) % 10 == 0 else "train"
        assert one(spark, hashing.camera_split(F.col("c0")), name) == expect
        assert one(spark, hashing.seed_of(F.col("c0")), name) == int(hashlib.md5(name.encode()).hexdigest()[:8], 16)


def test_mosaic(spark):
    counts = [0, 0, 0]
    for row in mosaic.XTRANS:
        for c in row:
            counts[c] += 1
    assert counts == [8, 20, 8]
    assert one(spark, mosaic.colours(mosaic.pattern_column(mosaic.BAYER), 2, 2, 1, 1)) == [2, 1, 1, 0]
    rng = np.random.default_rng(0)
    tile = rng.uniform(0, 0.9, (16, 12)).astype(np.float32)
    df = spark.createDataFrame([(tile.ravel().tolist(),)], "v array<float>")
    down, across = np.abs(np.diff(tile[::2].astype(float), axis=0)).mean(), np.abs(np.diff(tile[:, ::2].astype(float), axis=1)).mean()
    assert df.select(mosaic.texture(F.col("v"), 16, 12)).first()[0] == pytest.approx(down + across, abs=1e-12)
    flat = spark.createDataFrame([([0.4] * 64,), ([1.0] * 64,)], "v array<float>")
    assert [tuple(r) for r in flat.select(mosaic.clipped_fraction(F.col("v")), mosaic.texture(F.col("v"), 8, 8)).collect()] == [(0.0, 0.0), (1.0, 0.0)]


def test_maths(spark):
    assert [one(spark, maths.quantize(F.lit(x), 1.0)) for x in (0.5, 1.5, 2.5)] == [0.0, 2.0, 2.0]
    assert one(spark, maths.psnr(F.lit(0.0))) == 99.0
    with pytest.raises(Exception, match="larger than the frame"):
        one(spark, maths.aligned_span(F.lit(10), F.lit(20), F.lit(2)))


LEVELS = [
    ("acme mk1", 0, "12", 0, 10.0, 4000.0, None, None, None),
    ("acme mk1", 1, "14", 0, 40.0, 16000.0, None, None, None),
    ("acme mk2", 0, "", 0, 6.0, 4000.0, None, None, None),
    ("acme mk2", 0, "", 1, 5.0, 4090.0, [100.0, 200.0], None, None),
    ("acme mk2", 0, "", 2, 7.0, 3900.0, None, 3200.0, None),
]


def test_levels(spark):
    asked = [(1, "Acme Mk1", None, 4095.0), (2, "Acme Mk1", None, 16383.0), (3, "Acme Mk2", 100.0, 4095.0), (4, "Acme Mk2", 6400.0, 4095.0), (5, "Acme Mk2", 64.0, 4095.0), (6, "Acme Mk1", 100.0, 65535.0), (7, "Acme Mk1", None, None), (8, "Other", None, 4095.0)]
    df = spark.createDataFrame(asked, "id int, camera string, iso double, libraw_white double")
    found = {r[0]: (r[1], r[2]) for r in lookup.level_lookup(df, spark.createDataFrame(LEVELS, schemas.LEVEL), "id").collect()}
    assert found == {1: (10, 4000), 2: (40, 16000), 3: (5, 4090), 4: (7, 3900), 5: (6, 4000), 7: (10, 4000)}


def test_interpolation(spark):
    knots = spark.createDataFrame([("c", float(i), [float(a)] * 3, [0.0] * 3) for i, a in ((100, 1), (200, 2), (800, 5))], "camera string, iso double, a array<double>, b array<double>")
    asked = spark.createDataFrame([("c", float(i)) for i in (1, 100, 150, 200, 500, 800, 9e9)], "camera string, iso double").withColumnRenamed("iso", "at")
    found = lookup.interpolate(asked, knots, "camera", "at").orderBy("at").select(F.get("a", F.lit(0))).collect()
    assert [r[0] for r in found] == [1, 1, 1.5, 2, 3.5, 5, 5]


def test_library(spark):
    rolls = spark.createDataFrame([(1, "/photos/roll1"), (2, "/photos/roll2")], "id int, folder string")
    images = spark.createDataFrame(
        [(10, 1, "a.nef", "NIKON", "D850", 100.0), (11, 1, "b.nef", "NIKON", "D850", 3200.0), (12, 2, "c.raf", "FUJIFILM", "X-T4", 160.0), (13, 2, "c.raf", "FUJIFILM", "X-T4", 160.0)],
        "id int, film_id int, filename string, maker string, model string, iso double",
    )
    ids = spark.createDataFrame([(10,), (11,), (12,), (13,), (99,)], "id int")
    found = [(r.id, r.path) for r in library.entries_by_id(ids, images, rolls).orderBy("ord", "id").collect()]
    assert found == [(10, "/photos/roll1/a.nef"), (11, "/photos/roll1/b.nef"), (12, "/photos/roll2/c.raf"), (99, None)]


def test_limits_before_and_after(spark):
    topics = spark.createDataFrame([(str(k),) for k in range(100)], "path string")
    done = spark.createDataFrame([(f"f/{k}/x",) for k in range(100) if k < 90], "path string")
    assert resume.limit_before(topics, done, 10, "path", resume.topic_of(F.col("path"))).count() == 0
    assert resume.limit_after(topics, done.select(resume.topic_of(F.col("path")).alias("path")), 10).count() == 10


def test_private_and_counts(spark):
    with pytest.raises(PermissionError):
        gates.require_public(spark.createDataFrame([(True,)], "private boolean"))
    with pytest.raises(ValueError, match="too few"):
        gates.require_count(spark.range(0))
    with pytest.raises(ValueError, match="more than 5"):
        gates.require_count(spark.range(9), most=5)
    with pytest.raises(ValueError, match="differ"):
        gates.one_tile_size(spark.createDataFrame([(1, 256), (1, 128)], "n_tiles int, tile_size int"))
    assert not gates.three_colour(F.lit(3)) is None


def test_packing_needs_a_full_bin(spark):
    sizes = [5, 0, 5, 1, 20, 3, 0]
    df = spark.createDataFrame([(f"{k:02d}", s) for k, s in enumerate(sizes)], "name string, size long")
    assert [r.bin for r in packing.publish_batches(df, 10).orderBy("name").collect()] == [0, 0, 0, 1, 2, 3, 3]
    assert [(r.grp, r.name) for r in packing.compact_groups(df, 10, 15).orderBy("grp", "size", "name").collect()] == [(0, "01"), (0, "06"), (0, "03"), (0, "05"), (0, "00")]


def test_folds(spark):
    values = [1.0, 1.04, 2.0, 2.01, 1.0, 1.0, 1.0, 1.0, 9.0]
    df = spark.createDataFrame([(values,)], "v array<double>")
    got = df.select(folds.best_so_far(F.col("v"), 0.05, 5).alias("b")).select("b.*").first()
    assert tuple(got) == (2.0, 5, 8)
    mean = values[0]
    for step, v in enumerate(values[1:]):
        d = min(0.999, (1 + step) / (10 + step))
        mean = mean * d + v * (1 - d)
    assert df.select(folds.ema(F.col("v"), 0.999)).first()[0] == pytest.approx(mean)


def test_noise_variance():
    colours = np.tile(np.array(mosaic.BAYER), (256, 256))
    a, b = np.array([2e-3, 1e-3, 3e-3]), np.array([1e-5, 2e-5, 1e-5])
    for level in (0.02, 0.2, 0.8):
        out = noise.synthesize(np.full((512, 512), level), colours, a, b, np.random.default_rng(1), white=10.0, black_part=10.0)
        for c in range(3):
            part = out[colours == c]
            assert np.var(part) == pytest.approx(a[c] * level + b[c], rel=0.1)
            assert part.mean() == pytest.approx(level, rel=0.02)
    for a1, b1 in ((-1e-3, 2e-3), (1e-3, -1e-5)):
        out = noise.synthesize(np.full((512, 512), 0.5), colours, np.full(3, a1), np.full(3, b1), np.random.default_rng(2), white=10.0)
        assert np.var(out) == pytest.approx(max(a1 * 0.5 + b1, 0), rel=0.1)


def test_noise_identity_clip_and_steps():
    colours = np.zeros((32, 32), int)
    clean = np.random.default_rng(0).uniform(0, 1, (32, 32))
    zero = np.zeros(3)
    assert np.allclose(noise.synthesize(clean, colours, zero, zero, np.random.default_rng(0)), clean, atol=1e-6)
    loud = noise.synthesize(clean, colours, np.full(3, 0.1), np.full(3, 0.1), np.random.default_rng(0), black_part=0.05)
    assert loud.max() <= 1 and loud.min() >= np.float32(-0.05)
    steps = noise.synthesize(clean, colours, np.full(3, 1e-3), np.full(3, 1e-4), np.random.default_rng(0), step=1 / 4096) * 4096
    assert np.allclose(steps, np.rint(steps), atol=1e-3)
    assert np.isfinite(noise.sigma(np.full((4, 4), -1.0, np.float32), np.zeros((4, 4), int), np.full(3, 1e-3), zero)).all()


def test_aligned_offsets():
    rng = np.random.default_rng(0)
    found = [noise.aligned(rng, 100, 30, 6) for _ in range(200)]
    assert all(0 <= x <= 70 and x % 6 == 0 for x in found)
    with pytest.raises(ValueError):
        noise.aligned(rng, 10, 20, 2)


def tiff(order, make, model):
    body = make + b"\0" + model + b"\0"
    head = struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, 8)
    at = 8 + 2 + 24 + 4
    rows = struct.pack(order + "HHII", 0x010F, 2, len(make) + 1, at) + struct.pack(order + "HHII", 0x0110, 2, len(model) + 1, at + len(make) + 1)
    return head + struct.pack(order + "H", 2) + rows + b"\0\0\0\0" + body


def test_tiff_camera(spark):
    for order in "<>":
        assert binary.tiff_camera(tiff(order, b"NIKON CORPORATION", b"NIKON D90")) == "NIKON CORPORATION NIKON D90"
    assert binary.tiff_camera(b"junk") is None and binary.tiff_camera(None) is None and binary.tiff_camera(b"II*\0") is None
    assert binary.tiff_camera(b"FUJIFILM".ljust(28, b"-") + b"X-T4\0".ljust(40, b"\0")) == "FUJIFILM X-T4"
    df = spark.createDataFrame([(bytearray(tiff("<", b"Acme1", b"Model2")),)], "content binary")
    assert df.select(binary.camera_of(F.substring("content", 1, 65536))).first()[0] == "Acme1 Model2"


def shard(**changes):
    data = {
        "tiles": np.zeros((3, 256, 256), np.uint16), "offsets": np.zeros((3, 2), np.int32), "pattern": "RGGB", "pattern4": "RGGB", "black_per_channel": np.full(4, 512.0, np.float32),
        "white": np.float32(16383), "wb": np.ones(4, np.float32), "iso": np.int32(100), "camera": "Testmaker Model X", "source_path": "x",
    } | changes
    out = io.BytesIO()
    np.savez(out, **{k: v for k, v in data.items() if v is not None})
    return out.getvalue()


def test_shard_validator(spark, tmp_path):
    cases = {
        "a": shard(), "missing": shard(wb=None), "dtype": shard(tiles=np.zeros((3, 256, 256), np.float32)), "shape": shard(tiles=np.zeros((3, 128, 128), np.uint16)),
        "empty": shard(tiles=np.zeros((0, 256, 256), np.uint16)), "ISO": shard(iso=np.int32(1600)), "unreadable": b"not a zip",
    }
    for name, content in cases.items():
        (tmp_path / f"{name}.npz").write_bytes(content)
    rows = binary.shard_info(spark, str(tmp_path)).withColumn("reason", gates.shard_reason()).withColumn("name", text.file_name(F.col("path")))
    found = {r.name[:-4]: r.reason for r in rows.collect()}
    assert found.pop("a") is None
    assert all(name in reason for name, reason in found.items()), found
    tiles = binary.read_tiles(spark, f"{tmp_path}/a.npz")
    assert tiles.count() == 3 and tiles.first().tile_size == 256


def test_bundle_and_manifest(spark, tmp_path):
    with tarfile.open(tmp_path / "b.tar.gz", "w:gz") as out:
        for name, content in (("x/manifest.json", b'{"handle": "h", "n_shards": 1, "files": {"a.npz": "0"}}'), ("x/a.npz", b"1"), ("x/other.txt", b"2")):
            info = tarfile.TarInfo(name)
            info.size = len(content)
            out.addfile(info, io.BytesIO(content))
    members = binary.bundle_members(spark, str(tmp_path))
    assert sorted((r.name, r.size, r.sha256) for r in members.drop("content").collect())[0] == ("a.npz", 1, hashlib.sha256(b"1").hexdigest())
    manifest = binary.read_manifests(members).first()
    assert manifest.handle == "h" and manifest.files == {"a.npz": "0"}


def test_weights(spark, tmp_path):
    tensors = [("w", np.arange(6).reshape(2, 3)), ("b", np.array([1.5]))]
    (tmp_path / "w.bin").write_bytes(binary.pack_tensors(tensors, {"base": 8}, b"8BYTESOK"))
    rows = binary.read_tensors(spark, str(tmp_path), b"8BYTESOK").orderBy("offset").collect()
    assert [(r.name, list(r.shape), r.offset, r["size"], list(r["values"])) for r in rows] == [("w", [2, 3], 0, 24, [0, 1, 2, 3, 4, 5]), ("b", [1], 24, 4, [1.5])]


def test_camera_xml(spark, tmp_path):
    (tmp_path / "c.xml").write_text(
        """<Cameras>
        <Camera make="NIKON CORPORATION" model="NIKON D90" mode="12bit"><ID make="Nikon" model="D90">Nikon D90</ID><Sensor black="0" white="3900"/><Sensor black="1" white="4000" iso_list="100 200"/></Camera>
        <Camera make="A" model="B"><Sensor black="1"/></Camera>
        <Camera make="A" model="C"><ID make="Alpha" model="C">Alpha Cee</ID><Sensor black="2" white="9" iso_min="800"/></Camera></Cameras>"""
    )
    rows = tables.read_camera_xml(spark, str(tmp_path)).orderBy("key", "sensor_ix").collect()
    assert [(r.key, r.sensor_ix, r.black, r.white, r.iso_list, r.iso_min) for r in rows] == [
        ("a c", 0, 2.0, 9.0, None, 800.0), ("alpha c", 0, 2.0, 9.0, None, 800.0), ("alpha cee", 0, 2.0, 9.0, None, 800.0),
        ("nikon d90", 0, 0.0, 3900.0, None, None), ("nikon d90", 1, 1.0, 4000.0, [100.0, 200.0], None),
    ]


def test_files_and_lists(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    for name in ("b.NEF", "sub/a.dng", "c.x3f", "d.txt"):
        (tmp_path / "in" / name).write_bytes(b"12")
    assert [(r.rel, r.ext, r.length) for r in files.scan_files(spark, str(tmp_path / "in")).collect()] == [("b.NEF", ".nef", 2), ("sub/a.dng", ".dng", 2)]
    (tmp_path / "list.txt").write_text("# all\n\n 1 # one\n2\n")
    assert sorted(r[0] for r in files.read_list(spark, str(tmp_path / "list.txt"), True).collect()) == ["1", "2"]
    assert files.read_index(spark, str(tmp_path / "none.txt")).count() == 0
    with pytest.raises(FileNotFoundError):
        files.read_index(spark, str(tmp_path / "none.txt"), required=True)
    assert tables.read_levels(spark, str(tmp_path / "none.json")).count() == 0


def test_profiles_and_levels_json(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"noiseprofiles": [{"maker": "A", "models": [{"model": "M", "profiles": [{"iso": 200, "a": [1,2,3], "b": [0,0,0]}]}, {"model": "N", "profiles": []}]}]}')
    assert [tuple(r)[:4] for r in tables.read_profiles(spark, str(tmp_path / "p.json")).collect()] == [("A", "M", "A M", 200.0)]
    (tmp_path / "l.json").write_text('{"cameras": {"a m": [{"mode": "", "sensors": [{"black": 1, "white": 9}, {"black": 2, "white": 8, "iso_min": 100}]}]}}')
    assert [(r.key, r.sensor_ix, r.iso_min) for r in tables.read_levels(spark, str(tmp_path / "l.json")).orderBy("sensor_ix").collect()] == [("a m", 0, None), ("a m", 1, 100.0)]


def test_ledgered_stream(spark, tmp_path):
    source, ledger = tmp_path / "in", str(tmp_path / "ledger")
    spark.createDataFrame([("a",), ("b",)], "path string").coalesce(1).write.json(str(source))
    decide = lambda rows: rows.select("path", F.when(F.col("path") == "a", "error").otherwise("harvested").alias("status"))
    run = lambda k, retry=False: ledger_stream.run_ledgered(spark.readStream.schema("path string").json(str(source)), decide, ledger, str(tmp_path / f"c{k}"), retry_errors=retry).awaitTermination(60)
    run(0)
    assert sorted((r.path, r.status) for r in files.read_ledger(spark, ledger).collect()) == [("a", "error"), ("b", "harvested")]
    run(1)
    assert files.read_ledger(spark, ledger).count() == 2
    run(2, retry=True)
    assert files.read_ledger(spark, ledger).count() == 3


def test_holdout_of_all_cameras(spark):
    parts = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "camera string, k int")
    assert gates.without_holdout(parts, parts, required=False).count() == 0
    assert [r.k for r in gates.without_holdout(parts, parts.where("k = 3"), required=False).collect()] == [1]
    with pytest.raises(ValueError):
        gates.without_holdout(parts, parts)


def test_holdout_query_without_cameras_left(spark, tmp_path):
    spark.createDataFrame([(50, "a"), (1, "a"), (100, "b")], "p_partkey long, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    found = calibration.holdout(spark, str(tmp_path))
    assert found.columns == ["p_brand", "n"] and found.collect() == []


def _rows_joined(plan):
    metric = plan.metrics().get("numOutputRows")
    own = [metric.get().value()] if "Join" in plan.nodeName() and metric.isDefined() else []
    children = plan.children()
    return own + [n for k in range(children.size()) for n in _rows_joined(children.apply(k))]


def test_first_candidate_meets_one_row_of_a_match(spark):
    asked = spark.range(500).select("id", F.array(F.concat(F.lit("own"), F.col("id")), F.lit("same")).alias("tries"))
    own = spark.createDataFrame([(9, "own3"), (7, "own3")], "n long, path string")
    known = spark.range(1000, 1400).select(F.col("id").alias("n"), F.lit("same").alias("path")).unionByName(own)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        found, left = lookup.first_candidate(asked, known, "id", "tries", "path")
        rows = {r.id: (r.n, r.path) for r in found.collect()}
        met = _rows_joined(found._jdf.queryExecution().executedPlan())
        assert left.count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert rows == {k: (7, "own3") if k == 3 else (1000, "same") for k in range(500)}
    assert 500 <= max(met) <= 1000
