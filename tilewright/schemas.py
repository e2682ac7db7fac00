"""Explicit schemas of the tables; nothing is inferred."""

ASSET = "rel STRING, length BIGINT, ext STRING"

LEDGER = (
    "path STRING, status STRING, reason STRING, annex_key STRING, iso INT, camera STRING, n_tiles INT, shard STRING, "
    "topic STRING, author STRING, license STRING, url STRING, image_id BIGINT, source STRING"
)

SHARD = (
    "name STRING, pattern ARRAY<ARRAY<INT>>, pattern4 ARRAY<ARRAY<INT>>, black_per_channel ARRAY<FLOAT>, white FLOAT, "
    "wb ARRAY<FLOAT>, iso INT, camera STRING, source_path STRING, annex_key STRING"
)

TILE = "shard STRING, t INT, oy INT, ox INT, tile_size INT, pixels ARRAY<INT>"

PROFILE = "maker STRING, model STRING, camera STRING, iso DOUBLE, a ARRAY<DOUBLE>, b ARRAY<DOUBLE>"

PROFILE_DB = (
    "noiseprofiles ARRAY<STRUCT<maker: STRING, models: ARRAY<STRUCT<model: STRING, "
    "profiles: ARRAY<STRUCT<iso: DOUBLE, a: ARRAY<DOUBLE>, b: ARRAY<DOUBLE>>>>>>>"
)

LEVEL = (
    "key STRING, variant_ix INT, mode STRING, sensor_ix INT, black DOUBLE, white DOUBLE, "
    "iso_list ARRAY<DOUBLE>, iso_min DOUBLE, iso_max DOUBLE"
)

LEVEL_JSON = (
    "cameras MAP<STRING, ARRAY<STRUCT<mode: STRING, sensors: ARRAY<STRUCT<black: DOUBLE, white: DOUBLE, "
    "iso_list: ARRAY<DOUBLE>, iso_min: DOUBLE, iso_max: DOUBLE>>>>>"
)

MANIFEST = (
    "format INT, handle STRING, created STRING, license STRING, `grant` STRING, n_shards INT, n_tiles INT, "
    "cameras MAP<STRING, BIGINT>, files MAP<STRING, STRING>"
)

REGISTRY = (
    "collected STRING, handle STRING, created STRING, source STRING, bundle_sha256 STRING, n_shards_new INT, "
    "n_tiles INT, cameras MAP<STRING, BIGINT>, license STRING"
)

TENSOR = "file STRING, name STRING, shape ARRAY<INT>, offset BIGINT, size BIGINT, values ARRAY<FLOAT>"

TOPIC = "topic_id BIGINT, title STRING, cooked STRING, author STRING"
