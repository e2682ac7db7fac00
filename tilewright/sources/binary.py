"""Binary containers, read through Spark's own file source so that any store will do."""

from __future__ import annotations

import hashlib
import io
import json
import tarfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tilewright import schemas
from tilewright.operators.gates import REQUIRED_KEYS

_SHARD_INFO = "path string, error string, keys array<string>, dtype string, shape array<int>, n_offsets int, iso double, camera string"
_TILE = "path string, t int, oy int, ox int, tile_size int, pixels array<int>"


def _files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "content")


def shard_info(spark: SparkSession, path: str) -> DataFrame:
    """What the shard validator looks at, of every .npz file; unreadable ones have only an error. Tiles aren't copied out."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, content in zip(batch.path, batch.content, strict=True):
                row = dict.fromkeys(("error", "keys", "dtype", "shape", "n_offsets", "iso", "camera"))
                try:
                    with np.load(io.BytesIO(content), allow_pickle=False) as npz:
                        row["keys"] = sorted(npz.files)
                        if set(REQUIRED_KEYS) <= set(npz.files):
                            tiles = npz["tiles"]
                            row |= {"dtype": str(tiles.dtype), "shape": list(tiles.shape), "n_offsets": len(npz["offsets"]), "iso": float(npz["iso"]), "camera": str(npz["camera"])}
                except Exception as error:  # whatever can't be read is invalid, and the reason is kept
                    row["error"] = repr(error)[:200]
                rows.append({"path": name} | row)
            yield pd.DataFrame(rows, columns=["path", "error", "keys", "dtype", "shape", "n_offsets", "iso", "camera"])

    return _files(spark, path, "*.npz").mapInPandas(look, _SHARD_INFO)


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """The tiles of every readable .npz file, one row each; pixels row by row as int."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch.path, batch.content, strict=True):
                with np.load(io.BytesIO(content), allow_pickle=False) as npz:
                    tiles, offsets = npz["tiles"], npz["offsets"]
                yield pd.DataFrame(
                    {"path": name, "t": np.arange(len(tiles)), "oy": offsets[:, 0], "ox": offsets[:, 1], "tile_size": tiles.shape[1], "pixels": [t.astype(np.int32).ravel() for t in tiles]}
                )

    return _files(spark, path, "*.npz").mapInPandas(unpack, _TILE)


def bundle_members(spark: SparkSession, path: str, pattern: str = "*.tar*") -> DataFrame:
    """Manifest and shards of contribution archives: bundle, name (without folders), size, sha256, content."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for bundle, content in zip(batch.path, batch.content, strict=True):
                with tarfile.open(fileobj=io.BytesIO(content)) as archive:
                    for member in archive:
                        name = member.name.rsplit("/", 1)[-1]
                        if member.isfile() and (name == "manifest.json" or name.endswith(".npz")):
                            yield pd.DataFrame({"bundle": [bundle], "name": [name], "content": [archive.extractfile(member).read()]})

    rows = _files(spark, path, pattern).mapInPandas(unpack, "bundle string, name string, content binary")
    return rows.select("bundle", "name", F.length("content").cast("long").alias("size"), F.sha2("content", 256).alias("sha256"), "content")


def read_manifests(members: DataFrame) -> DataFrame:
    """The manifest of each bundle."""
    parsed = F.from_json(F.col("content").cast("string"), schemas.MANIFEST).alias("m")
    return members.where(F.col("name") == "manifest.json").select("bundle", parsed).select("bundle", "m.*")


#: Fixed values of the TIFF layout: a directory's entry, the kind of text, the tags of make and model, and what is read of a file.
_ENTRY = np.dtype([("tag", "u2"), ("kind", "u2"), ("n", "u4"), ("value", "u1", 4)])
_TEXT, _MAKE_MODEL, _HEAD, _MOST_ENTRIES = 2, (0x010F, 0x0110), 1 << 16, 512


def _first_text(raw: bytes) -> str:
    """Up to the first zero, without space around."""
    return raw.partition(b"\0")[0].decode("ascii", "replace").strip()


def _directory(head: bytes, order: str) -> np.ndarray:
    """The entries of the first directory, as many as are there whole."""
    number = lambda form, at: int(np.frombuffer(head[at : at + np.dtype(form).itemsize].ljust(np.dtype(form).itemsize, b"\0"), order + form)[0])
    start = number("u4", 4)
    room = (len(head) - start - 2) // _ENTRY.itemsize
    return np.frombuffer(head, _ENTRY.newbyteorder(order), min(number("u2", start), room, _MOST_ENTRIES), start + 2) if room > 0 else np.array([], _ENTRY)


def tiff_camera(head: bytes | None) -> str | None:
    """Make and model in the first directory of a TIFF-like file, or a RAF file's own header; null if it has neither."""
    head = (head or b"")[:_HEAD]
    if head[:8] == b"FUJIFILM":
        model = _first_text(head[28:60])
        return model and f"FUJIFILM {model}" or None
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    if order is None or len(head) < 8:
        return None
    entries = _directory(head, order)
    found = {}
    for entry in entries[(entries["kind"] == _TEXT) & (entries["n"] > 0) & np.isin(entries["tag"], _MAKE_MODEL)]:
        n, inline = int(entry["n"]), entry["value"].tobytes()
        at = int.from_bytes(inline, "little" if order == "<" else "big")
        raw = inline[:n] if n <= len(inline) else head[at : at + n]
        if len(raw) == n:
            found[int(entry["tag"])] = _first_text(raw)
    return " ".join(filter(None, map(found.get, _MAKE_MODEL))) or None


@F.pandas_udf(StringType())
def camera_of(heads: pd.Series) -> pd.Series:
    """`tiff_camera` of the first 64 KiB of each file: pass substring(content, 1, 65536)."""
    return heads.map(tiff_camera)


def write_file(path: str, content: bytes) -> None:
    """Write one small file under another name first, then rename it."""
    store, at = FileSystem.from_uri(path if ":/" in path else f"file://{path}")
    folder, name = at.rsplit("/", 1)
    store.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(content)
    store.move(part, at)


def write_shards(shards: DataFrame, folder: str) -> DataFrame:
    """Write one .npz a row to `folder`, each under another name first and then renamed, so that no reader sees half a file.

    shards: source_path, tiles (array of oy, ox, pixels), tile_size, pattern,
    pattern4, black_per_channel, white, wb, iso, camera. Returns name, size and
    sha256; a task that is run again writes the same bytes.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples():
                side = int(row.tile_size)
                content = io.BytesIO()
                np.savez_compressed(
                    content, tiles=np.array([t["pixels"] for t in row.tiles], np.uint16).reshape(-1, side, side), offsets=np.array([(t["oy"], t["ox"]) for t in row.tiles], np.int32).reshape(-1, 2),
                    pattern=np.array([list(x) for x in row.pattern]), pattern4=np.array([list(x) for x in row.pattern4]), black_per_channel=np.array(row.black_per_channel, np.float32),
                    white=np.float32(row.white), wb=np.array(row.wb, np.float32), iso=np.int32(row.iso), camera=np.str_(row.camera), source_path=np.str_(row.source_path),
                )
                data = content.getvalue()
                name = row.source_path.replace("/", "_") + ".npz"
                write_file(f"{folder}/{name}", data)
                rows.append((name, len(data), hashlib.sha256(data).hexdigest()))
            yield pd.DataFrame(rows, columns=["name", "size", "sha256"])

    return shards.mapInPandas(write, "name string, size long, sha256 string")


def pack_bundle(members: list[tuple[str, bytes]], manifest: dict) -> bytes:
    """A contribution archive: the manifest, then the shards by name."""
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as archive:
        for name, content in [("manifest.json", json.dumps(manifest, sort_keys=True).encode()), *sorted(members)]:
            info = tarfile.TarInfo(name)
            info.size = len(content)
            archive.addfile(info, io.BytesIO(content))
    return out.getvalue()


def restored(members: DataFrame) -> DataFrame:
    """What restoring published archives one after another leaves: of a name in several, the last archive's."""
    last = F.max_by(F.struct(*members.columns), F.struct("bundle")).alias("m")
    return members.where(F.col("name") != "manifest.json").groupBy(F.col("name").alias("__name")).agg(last).select("m.*")


def read_tensors(spark: SparkSession, path: str, magic: bytes, pattern: str = "*") -> DataFrame:
    """Tensors of weight files: 8 magic bytes, header length, JSON header (tensors: name, shape, offset, size), values."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch.path, batch.content, strict=True):
                if content[:8] != magic:
                    raise ValueError(f"{name}: bad magic")
                n = int.from_bytes(content[8:12], "little")
                payload = content[12 + n :]
                rows = json.loads(content[12 : 12 + n])["tensors"]
                values = [np.frombuffer(payload, "<f4", t["size"] // 4, t["offset"]) for t in rows]
                yield pd.DataFrame([(name, t["name"], t["shape"], t["offset"], t["size"], v) for t, v in zip(rows, values, strict=True)], columns=["file", "name", "shape", "offset", "size", "values"])

    return _files(spark, path, pattern).mapInPandas(unpack, schemas.TENSOR)


def pack_tensors(tensors: list[tuple[str, np.ndarray]], config: dict, magic: bytes) -> bytes:
    """A weight file's bytes: little-endian singles at running offsets."""
    blobs = [np.ascontiguousarray(values, "<f4").tobytes() for _, values in tensors]
    ends = np.cumsum([len(b) for b in blobs]).tolist()
    listed = [{"name": name, "shape": list(np.shape(values)), "offset": end - len(blob), "size": len(blob)} for (name, values), blob, end in zip(tensors, blobs, ends, strict=True)]
    header = json.dumps({"cfg": config, "tensors": listed}).encode()
    return b"".join([magic, len(header).to_bytes(4, "little"), header, *blobs])
