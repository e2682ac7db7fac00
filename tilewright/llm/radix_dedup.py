"""Removing repeated byte strings by anchors, in place of a depth-limited radix sort of suffixes.

Every 50-byte window (a suffix cut at the threshold) is grouped by its digits,
most significant first; groups without a second text are dropped after each pass,
and what is equal after the last one is exactly a repeated window.

No suffix is ordered: anchors stand in place of the digit passes, to move fewer values.
The first digit is the window's anchor: of its 20-byte strings the one with the
least hash. Windows with the same bytes have the same anchor at the same place, and
neighbouring windows mostly share one, so the first pass moves one value for some
16 windows. Its survivors are few; the second pass takes each surviving anchor with
the 30 bytes on either side, which hold all its windows, and compares the remaining
digits byte for byte. Every window of an anchor contains it, so what an anchor's
repeated windows cover is one run of bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm import common, sieve

WINDOW, DIGIT = 50, 20
SIDE = WINDOW - DIGIT

#: Leading bits of a hash that make a part: at least, and at most; and bytes of text for which a part is meant.
LEAST_BITS, MOST_BITS, PART_BYTES = 8, 24, 32 << 20

#: Bits of a hash kept beside the part's; equal values of different strings only cost time.
KEPT_BITS = 40

#: Texts with an anchor from which on its windows are dealt out in two halves, and with a half from which on they are
#: dealt out one by one. Windows with HALF bytes or more before the anchor share those, the others what follows it.
HOT, HALF = 4_096, SIDE // 2

#: Packing of the second pass's rows, beside which Spark's own finds little.
CODEC = "zstd"

#: Bits and hashes per surviving value in the Bloom blocks that the second reading looks anchors up in, and
#: bytes of blocks that it holds at once: beyond that it reads in turns, each with the blocks of some parts.
BLOOM_BITS, BLOOM_HASHES, BLOOM_BYTES = 10, 5, 256 << 20

#: Numbers (8 bytes each) up to which runs go to their texts, and copies' ids to the first reading, by broadcast.
BROADCAST_NUMBERS, BROADCAST_IDS = 8_000_000, 2_000_000

#: Readings of the texts for as many broadcasts of runs; where it would take more, the texts move instead.
RUN_TURNS = 16

#: Bytes of text worked on at once, and anchors with their sides that a task gathers before it sends them.
SLICE, GATHERED = 1 << 19, 1 << 17

NO_ID = 2**63 - 1

_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]

_RUN = pa.schema([("tid", pa.int64()), ("least", pa.int64()), ("run", pa.int64())])

RECORD = np.dtype([("mark", "<u8"), ("tid", "<i8"), ("least", "<i8"), ("at", "<i4"), ("left", "u1"), ("right", "u1"), ("low", "u1"), ("high", "u1"), ("bytes", "u1", (WINDOW + SIDE,))])


def _hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 20 bytes that start at each place."""
    n = len(data) - DIGIT + 1
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    four = np.ndarray(len(data) - 3, "<u4", data, strides=(1,))
    h = eight[:n] * _C[0]
    h ^= h >> np.uint64(32)
    h += eight[8 : 8 + n] * _C[1]
    h *= _C[2]
    h ^= h >> np.uint64(29)
    h += four[16 : 16 + n] * _C[3]
    h *= _C[0]
    h ^= h >> np.uint64(32)
    return h


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all windows inside the texts [start, end) of `data`.

    At most 2**26 bytes at once. The leftmost of equal least hashes is taken. Least
    hashes are small ones: they are mixed again, so that their leading bits make equal parts.
    """
    if len(data) < WINDOW:
        return np.array([], np.int64), np.array([], np.uint64)
    h = _hashes(data)
    place = np.uint64((1 << 26) - 1)
    least = (h & ~place) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while span * 2 <= SIDE + 1:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = SIDE + 1 - span
    least = np.minimum(least[: len(least) - rest], least[rest:])  # of the windows at 0, 1, ...
    inside = np.zeros(len(least) + 1, np.int8)
    long = ends - starts >= WINDOW
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - WINDOW + 1, -1)
    chosen = np.zeros(len(h), bool)
    chosen[(least[np.cumsum(inside[:-1]) > 0] & place).astype(np.int64)] = True
    at = np.flatnonzero(chosen)
    return at, h[at] * _C[1]


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Ranges of a batch's bytes worked on at once: (from, to, rows, starts, ends); a long text comes in overlapping ones."""
    row, n = 0, len(offsets) - 1
    while row < n:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1)
        a, b = int(offsets[row]), int(offsets[last])
        if b - a <= 2 * SLICE:
            yield a, b, np.arange(row, last), offsets[row:last], offsets[row + 1 : last + 1]
        else:
            for begin in range(a, b, SLICE):
                end = min(b, begin + SLICE + WINDOW - 1)
                yield begin, end, np.array([row]), np.array([begin]), np.array([end])
                if end == b:
                    break
        row = last


def _anchors_of(batch_bytes: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place in the batch's bytes, hash, the bytes, offsets) of all anchors, slice by slice."""
    offsets = np.frombuffer(batch_bytes.buffers()[1], "<i4" if pa.types.is_binary(batch_bytes.type) else "<i8")
    offsets = offsets[batch_bytes.offset : batch_bytes.offset + len(batch_bytes) + 1].astype(np.int64)
    raw = batch_bytes.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.array([], np.uint8)
    for a, b, rows, starts, ends in _slices(offsets):
        at, h = anchors(data[a:b], starts - a, ends - a)
        if len(at):
            yield rows[np.searchsorted(ends - a, at, "right")], at + a, h, data, offsets


def _order(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by part, the parts, and where each begins and ends."""
    order = np.argsort(parts.astype(np.uint16 if parts.max(initial=0) < 1 << 16 else np.uint32), kind="stable")
    own, first = np.unique(parts[order], return_index=True)
    return order, own, np.append(first, len(parts))


def _bloom_place(mark: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
    """The k-th place of values in blocks of `size` bits."""
    h = (mark + np.uint64(k + 1)) * _C[k % 4]
    h ^= h >> np.uint64(31)
    h *= _C[(k + 1) % 4]
    return ((h >> np.uint64(11)) % size.astype(np.uint64)).astype(np.int64)


def bloom_block(mark: np.ndarray) -> np.ndarray:
    """The block of a part's values, a whole number of bytes."""
    size = np.full(1, (len(mark) * BLOOM_BITS + 7) // 8 * 8)
    bits = np.zeros(int(size[0]), bool)
    for k in range(BLOOM_HASHES):
        bits[_bloom_place(mark, size, k)] = True
    return np.packbits(bits, bitorder="little")


class Blocks:
    """The Bloom blocks of some parts, and the hot values among them."""

    def __init__(self, rows: list[tuple[int, bytes, bytes]], bits: int):
        self.size, self.begin = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        at = 0
        for part, block, _ in rows:
            self.size[part], self.begin[part] = len(block) * 8, at
            at += len(block) * 8
        self.bytes = np.frombuffer(b"".join(block for _, block, _ in rows), np.uint8)
        self.hot = np.frombuffer(b"".join(hot for _, _, hot in rows), "<u8")

    def keeps(self, mark: np.ndarray) -> np.ndarray:
        """Places of the values that may have survived: all that have, and one in a hundred others."""
        left = np.flatnonzero(self.size[(mark >> np.uint64(KEPT_BITS)).astype(np.int64)])
        for k in range(BLOOM_HASHES):
            if not len(left):
                break
            own = mark[left]
            part = (own >> np.uint64(KEPT_BITS)).astype(np.int64)
            at = self.begin[part] + _bloom_place(own, self.size[part], k)
            left = left[(self.bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
        return left


def first_pass(texts: DataFrame, bits: int, hot: int = HOT) -> DataFrame:
    """Values of anchors that stand in two texts or more: per part a Bloom block and the hot values.

    texts: tid, raw (binary); any number that differs from row to row will do as tid,
    small steps pack best. A task packs its anchors into one blob per part and batch;
    a part's task sorts the values and keeps groups of several texts.
    """
    kept = np.uint64(64 - bits - KEPT_BITS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_anchors_of(batch["raw"]))
            if not found:
                continue
            tid = batch["tid"].to_numpy()[np.concatenate([f[0] for f in found])]
            mark = np.concatenate([f[2] for f in found]) >> kept
            order, parts, edges = _order(mark >> np.uint64(KEPT_BITS))
            low = mark[order].view(np.uint8).reshape(-1, 8)[:, : KEPT_BITS // 8]
            tid = tid[order].view(np.uint8).reshape(-1, 8)
            cut = list(zip(edges[:-1], edges[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts.astype(np.int32)), pa.array([low[a:b].tobytes() for a, b in cut], pa.binary()), pa.array([tid[a:b].T.tobytes() for a, b in cut], pa.binary())],
                ["part", "low", "tid"],
            )

    def keep(group: pa.Table) -> pa.Table:
        part = np.uint64(group["part"][0].as_py())
        width = KEPT_BITS // 8
        low = np.frombuffer(b"".join(group["low"].to_pylist()), np.uint8).reshape(-1, width)
        mark = np.zeros((len(low), 8), np.uint8)
        mark[:, :width] = low
        mark = mark.view("<u8").ravel()
        tid = np.concatenate([np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view("<i8").ravel() for x in group["tid"].to_pylist()])
        order = np.lexsort((tid, mark))
        mark, tid = mark[order], tid[order]
        once = np.append(True, (mark[1:] != mark[:-1]) | (tid[1:] != tid[:-1]))
        mark, tid = mark[once], tid[once]
        first = np.flatnonzero(np.append(True, mark[1:] != mark[:-1]))
        n = np.diff(np.append(first, len(mark)))
        several = n > 1
        mark, n = mark[first][several] | part << np.uint64(KEPT_BITS), n[several]
        rows = len(mark) and 1
        return pa.table({"part": pa.array([int(part)] * rows, pa.int32()), "block": pa.array([bloom_block(mark).tobytes()] * rows, pa.binary()), "hot": pa.array([mark[n >= hot].tobytes()] * rows, pa.binary())})

    dealt = texts.mapInArrow(deal, "part int, low binary, tid binary")
    return dealt.groupBy("part").applyInArrow(keep, "part int, block binary, hot binary")


def _near(batch: pa.RecordBatch, blocks: Blocks, kept: np.uint64, hot_only: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """RECORDs of a batch's anchors that may have survived, and which of them are hot; slice by slice."""
    tids, leasts = batch["tid"].to_numpy(), batch["least"].to_numpy()
    for row, at, h, data, offsets in _anchors_of(batch["raw"]):
        mark = h >> kept
        near = blocks.keeps(mark)
        hot = np.isin(mark[near], blocks.hot)
        if hot_only:
            near, hot = near[hot], hot[hot]
        if not len(near):
            continue
        row, at, mark = row[near], at[near], mark[near]
        out = np.zeros(len(near), RECORD)
        out["mark"], out["tid"], out["least"], out["at"] = mark, tids[row], leasts[row], at - offsets[row]
        out["left"] = np.minimum(SIDE, at - offsets[row])
        out["right"] = np.minimum(SIDE, offsets[row + 1] - at - DIGIT)
        out["high"] = SIDE
        around = at[:, None] + np.arange(-SIDE, DIGIT + SIDE)
        there = (around >= offsets[row][:, None]) & (around < offsets[row + 1][:, None])
        out["bytes"] = np.where(there, data[np.clip(around, 0, len(data) - 1)], 0)
        yield out, hot


def _mixed(mark: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = (mark * _C[0] + left) * _C[1] + right * _C[2]
    h ^= h >> np.uint64(29)
    return h * _C[3]


def _growing(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the nearest 0, 1, ... 30 bytes left and right of each row's anchor; those on the left hold the anchor too."""
    left, right = np.zeros(len(rows), np.uint64), np.ones(len(rows), np.uint64)
    for k in range(DIGIT):
        left = left * _C[2] + rows["bytes"][:, SIDE + k]
    yield left, right
    for k in range(SIDE):
        left = left * _C[1] + rows["bytes"][:, SIDE - 1 - k] + np.uint64(1)
        right = right * _C[0] + rows["bytes"][:, SIDE + DIGIT + k] + np.uint64(1)
        yield left, right


def _sides(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All of them, by the number of bytes."""
    left, right = zip(*_growing(rows), strict=True)
    return np.array(left), np.array(right)


def _earlier(key: np.ndarray, rows: np.ndarray, cut: slice) -> np.ndarray:
    """Which rows have the same mark and bytes (of `cut`) as one of an earlier text; equal keys are compared byte for byte."""
    order = np.lexsort((rows["least"], key))
    first = np.append(True, key[order][1:] != key[order][:-1])
    head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    same = (rows["mark"][order] == rows["mark"][head]) & (rows["bytes"][order, cut] == rows["bytes"][head, cut]).all(axis=1)
    later = np.zeros(len(rows), bool)
    later[order] = same & (rows["least"][order] > rows["least"][head])
    if not same.all():  # two strings with one hash: sort those out by their bytes
        odd = np.isin(key, key[order[~same]])
        least: dict[bytes, int] = {}
        at = np.flatnonzero(odd)
        names = [rows["mark"][k].tobytes() + rows["bytes"][k, cut].tobytes() for k in at]
        for k, name in zip(at, names, strict=True):
            least[name] = min(least.get(name, NO_ID), int(rows["least"][k]))
        later[at] = [rows["least"][k] > least[name] for k, name in zip(at, names, strict=True)]
    return later


def whole_sides(rows: np.ndarray) -> np.ndarray:
    """Rows whose anchor and both sides of 30 bytes stand in an earlier text: all their windows are repeated."""
    later = np.zeros(len(rows), bool)
    full = np.flatnonzero((rows["left"] == SIDE) & (rows["right"] == SIDE) & (rows["low"] == 0) & (rows["high"] == SIDE))
    if len(full):
        for left, right in _growing(rows[full]):
            pass  # the last ones are of all bytes
        later[full] = _earlier(_mixed(rows["mark"][full], left, right), rows[full], slice(0, WINDOW + SIDE))
    return later


def repeated(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the least and the most bytes before its anchor with which a window of it is repeated (none: 99, -1)."""
    low, high = np.full(len(rows), 99), np.full(len(rows), -1)
    later = whole_sides(rows)
    low[later], high[later] = 0, SIDE
    own = np.flatnonzero(~later)
    _, group, n = np.unique(rows["mark"][own], return_inverse=True, return_counts=True)
    own = own[n[group] > 1]
    if not len(own):
        return low, high
    left, right = _sides(rows[own])
    for before in range(SIDE + 1):
        some = rows[own]
        ok = np.flatnonzero((some["left"] >= before) & (some["right"] >= SIDE - before) & (some["low"] <= before) & (some["high"] >= before))
        if len(ok) > 1:
            key = _mixed(some["mark"][ok], left[before][ok], right[SIDE - before][ok])
            hit = own[ok[_earlier(key, some[ok], slice(SIDE - before, SIDE - before + WINDOW))]]
            low[hit], high[hit] = np.minimum(low[hit], before), before
    return low, high


def halves(rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int, int]]:
    """The rows that have windows of either half: (rows, hashes of what these windows share, least and most bytes before the anchor).

    Windows are the same only if their half's hashes are, so a half is dealt out by
    it: two rows stand for all 31 windows. Bytes of no window of the half are zero.
    """
    left, right = np.zeros(len(rows), np.uint64), np.ones(len(rows), np.uint64)
    for k, (a, b) in enumerate(_growing(rows)):
        left, right = (a if k == HALF else left), (b if k == SIDE - HALF + 1 else right)
    before, after = rows[rows["left"] >= HALF], rows[rows["right"] > SIDE - HALF]
    out = [(before, _mixed(before["mark"], left[rows["left"] >= HALF], np.uint64(0)), HALF, SIDE), (after, _mixed(after["mark"], np.uint64(0), right[rows["right"] > SIDE - HALF]), 0, HALF - 1)]
    for own, _, low, high in out:
        own["low"], own["high"] = low, high
        own["bytes"][:, : SIDE - high] = 0
        own["bytes"][:, SIDE - low + WINDOW :] = 0
    return out


def hot_halves(texts: DataFrame, blocks: Blocks, bits: int, hot: int) -> np.ndarray:
    """Hashes of the halves of hot anchors that stand `hot` times or more; all texts are read for it."""
    if not len(blocks.hot):
        return np.array([], np.uint64)
    kept = np.uint64(64 - bits - KEPT_BITS)
    shared = texts.sparkSession.sparkContext.broadcast(blocks)

    def counted(keys: list[np.ndarray]) -> pa.RecordBatch:
        own, n = np.unique(np.concatenate(keys), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n.astype(np.int64))], ["half", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = [], 0
        for batch in batches:
            for rows, _ in _near(batch, shared.value, kept, True):
                keys += [half[1] for half in halves(rows)]
                n += len(rows)
                if n >= GATHERED:
                    yield counted(keys)
                    keys, n = [], 0
        if keys:
            yield counted(keys)

    found = texts.mapInArrow(count, "half long, n long").groupBy("half").agg(F.sum("n").alias("n")).where(F.col("n") >= hot).select("half").toArrow()
    return found["half"].to_numpy().view(np.uint64)


def _pack(rows: np.ndarray) -> bytes:
    """Rows as packed bytes, their number before them."""
    return len(rows).to_bytes(8, "little") + pa.compress(rows.tobytes(), CODEC, asbytes=True)


def _unpack(packed: bytes) -> bytes:
    return pa.decompress(memoryview(packed)[8:], int.from_bytes(packed[:8], "little") * RECORD.itemsize, CODEC, asbytes=True)


def single_windows(rows: np.ndarray, least: int = 0, most: int = SIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows cut into one for each window with `least` to `most` bytes before the anchor, without those that an earlier text among `rows` settles.

    Returns (the others, the hashes of their windows, and for each of `rows` the least
    and the most bytes before its anchor with which a window is settled; none: 99, -1).
    Of a window's rows those of the least id stay, so it is still known to the others.
    """
    left, right = _sides(rows)
    low, high = np.full(len(rows), 99), np.full(len(rows), -1)
    each, keys = [], []
    for before in range(least, most + 1):
        ok = np.flatnonzero((rows["left"] >= before) & (rows["right"] >= SIDE - before))
        key = _mixed(rows["mark"][ok], left[before][ok], right[SIDE - before][ok])
        later = _earlier(key, rows[ok], slice(SIDE - before, SIDE - before + WINDOW))
        hit = ok[later]
        low[hit], high[hit] = np.minimum(low[hit], before), before
        one = rows[ok[~later]]
        one["low"] = one["high"] = before
        each.append(one)
        keys.append(key[~later])
    return np.concatenate(each), np.concatenate(keys), low, high


def _runs(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Table:
    hit = high >= 0
    start = rows["at"][hit].astype(np.int64) - high[hit]
    end = rows["at"][hit].astype(np.int64) + WINDOW - low[hit]
    return pa.table({"tid": rows["tid"][hit], "least": rows["least"][hit], "run": (start << 32) | end})


def second_pass(texts: DataFrame, blocks: Blocks, bits: int, hot: int = HOT) -> DataFrame:
    """Runs (tid, least, run = start << 32 | end) of repeated bytes, for the anchors that `blocks` keeps.

    texts: tid, least (its row's id), raw. A hot anchor's windows are dealt out by
    their two halves' hashes, so that no part has to hold all texts with it. The
    windows of a hot half are dealt out each by its own hash, and of those that a task
    has gathered only the ones of the least id move. Rows that a batch settles
    by itself don't move. A value that survived by chance has no equal and gives no run.
    """
    kept = np.uint64(64 - bits - KEPT_BITS)
    shared, common_halves = (texts.sparkSession.sparkContext.broadcast(x) for x in (blocks, hot_halves(texts, blocks, bits, hot)))

    def packed(rows: np.ndarray, route: np.ndarray) -> pa.RecordBatch:
        order, parts, edges = _order(route)
        rows = rows[order]
        blobs = [_pack(rows[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        none = pa.nulls(len(parts), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(parts.astype(np.int32)), pa.array(blobs, pa.binary()), none, none, none], ["part", "rows", *_RUN.names])

    def send(found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        rows, hot = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        found.clear()
        done = whole_sides(rows)
        settled = _runs(rows, np.zeros(len(rows), int), np.where(done, SIDE, -1))
        plain, wide = rows[~done & ~hot], rows[~done & hot]
        del rows
        yield packed(plain, plain["mark"] >> np.uint64(KEPT_BITS))
        for half, keys, least, most in halves(wide):
            single = np.isin(keys, common_halves.value)
            yield packed(half[~single], keys[~single] >> np.uint64(64 - bits))
            half = half[single]
            half = half[np.argsort(half["mark"], kind="stable")]
            for begin in range(0, len(half), 1 << 14):
                some = half[begin : begin + (1 << 14)]
                left_over, each, low, high = single_windows(some, least, most)
                settled = pa.concat_tables([settled, _runs(some, low, high)])
                yield packed(left_over, each >> np.uint64(64 - bits))
        if settled.num_rows:
            # settled runs ride along, spread over the parts
            spread = pa.array((np.arange(settled.num_rows) % (1 << bits)).astype(np.int32))
            columns = [spread, pa.nulls(settled.num_rows, pa.binary()), *(settled[c].combine_chunks() for c in _RUN.names)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "rows", *_RUN.names])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for batch in batches:
            for one in _near(batch, shared.value, kept):
                found.append(one)
                n += len(one[0])
                if n >= GATHERED:
                    yield from send(found)
                    n = 0
        if found:
            yield from send(found)

    def match(group: pa.Table) -> pa.Table:
        rows = np.frombuffer(b"".join(_unpack(x) for x in group["rows"].to_pylist() if x is not None), RECORD)
        settled = group.select(_RUN.names).filter(group["run"].is_valid())
        return pa.concat_tables([settled.cast(_RUN), _runs(rows, *repeated(rows)).cast(_RUN)])

    dealt = texts.mapInArrow(deal, "part int, rows binary, tid long, least long, run long")
    return dealt.groupBy("part").applyInArrow(match, "tid long, least long, run long")


def merged(runs: np.ndarray) -> np.ndarray:
    """Overlapping or touching runs as one, ascending."""
    runs = np.sort(runs)
    start, end = runs >> 32, np.maximum.accumulate(runs & 0xFFFFFFFF)
    new = np.append(True, start[1:] > end[:-1])
    return (start[new] << 32) | np.maximum.reduceat(end, np.flatnonzero(new))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs = [merged(np.array(x, np.int64)) for x in batch["runs"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["tid"], batch["least"], pa.array(runs, pa.list_(pa.int64()))], ["tid", "least", "runs"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, spans, kept = [], [], []
        for raw, runs in zip(batch["raw"].to_pylist(), batch["runs"].to_pylist(), strict=True):
            sha, at = hashlib.sha256(), 0
            for run in runs:
                sha.update(raw[at : run >> 32])
                at = run & 0xFFFFFFFF
            sha.update(raw[at:])
            removed.append(sum((run & 0xFFFFFFFF) - (run >> 32) for run in runs))
            spans.append(len(runs))
            kept.append(sha.hexdigest())
        yield pa.RecordBatch.from_arrays([batch["tid"], batch["least"], pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept)], ["tid", "least", "n_removed", "n_spans", "kept_sha256"])


def repeated_runs(docs: DataFrame, hot: int = HOT, held: int = BLOOM_BYTES) -> tuple[DataFrame, DataFrame]:
    """(rows, done) for `docs` (doc_id, text).

    rows: id (doc_id, NO_ID if null), doc_id, sha, quick (a 64-bit hash of the text),
    n_bytes, and least, the smallest id with the same text. done: tid (quick), least,
    n_removed, n_spans and kept_sha256 of the texts in which bytes are repeated.

    Texts are read three times, a fourth time where anchors are hot, and don't move:
    the last reading sends the runs to them by broadcast, in turns of a reading each
    if they are many. Beyond RUN_TURNS the texts move to their runs.
    """
    texts = common.doc_texts(docs).withColumn("id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("tid", F.xxhash64("text")).withColumn("raw", F.col("text").cast("binary"))
    rows = texts.select("id", "doc_id", F.unhex(F.sha2("text", 256)).alias("sha"), F.col("tid").alias("quick"), F.octet_length("text").cast("long").alias("n_bytes"))
    rows = common.saved(rows)
    n_rows, total = rows.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    owners = common.saved(rows.groupBy("sha").agg(F.min("id").alias("least"), F.count("*").alias("__n")))
    rows = common.saved(sieve.joined(rows, owners, "sha", n_rows))
    bits = min(MOST_BITS, max(LEAST_BITS, (total // PART_BYTES).bit_length()))

    long = texts.where(F.octet_length("text") >= WINDOW).select("tid", F.col("id").alias("least"), "raw")
    copies = rows.where(F.col("id") > F.col("least")).select(F.col("quick").alias("__tid"), F.col("id").alias("__id")).distinct()
    if copies.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:  # copies change nothing; leaving them out saves work
        long = long.join(F.broadcast(copies), (F.col("tid") == F.col("__tid")) & (F.col("least") == F.col("__id")), "left_anti")

    kept = common.saved(first_pass(long.select(F.monotonically_increasing_id().alias("tid"), "raw"), bits, hot))
    sizes = kept.select("part", F.length("block").alias("n")).orderBy("part").collect()  # a row per part
    turns, room = [], 0
    for part, n in sizes:
        if not turns or room + n > held:
            turns.append([])
            room = 0
        turns[-1].append(part)
        room += n
    found = None
    for turn in turns:
        blocks = Blocks([tuple(r) for r in kept.where(F.col("part").between(turn[0], turn[-1])).toLocalIterator()], bits)
        runs = second_pass(long, blocks, bits, hot)
        found = runs if found is None else found.unionByName(runs)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "tid long, least long, run long")
    runs = common.saved(found.groupBy("tid", "least").agg(F.collect_list("run").alias("runs")).mapInArrow(_merge, "tid long, least long, runs array<long>"))
    n = runs.agg(F.coalesce(F.sum(F.size("runs") + 8), F.lit(0))).first()[0]
    turns = max(1, -(-n // BROADCAST_NUMBERS))

    def cut(some: DataFrame) -> DataFrame:
        some = some.withColumnsRenamed({"tid": "__tid", "least": "__least"})
        own = long.join(some, (F.col("tid") == F.col("__tid")) & (F.col("least") == F.col("__least"))).select("tid", "least", "raw", "runs")
        return own.mapInArrow(_cut, "tid long, least long, n_removed long, n_spans long, kept_sha256 string")

    if turns > RUN_TURNS:
        done = cut(runs)
    elif turns == 1:
        done = cut(F.broadcast(runs))
    else:  # one broadcast at a time
        turn = F.pmod(F.xxhash64("tid", "least"), F.lit(turns))
        done = reduce(DataFrame.unionByName, [common.saved(cut(F.broadcast(runs.where(turn == k)))) for k in range(turns)])
    return rows, done.dropDuplicates(["tid", "least"])


def remove_repeats(docs: DataFrame, hot: int = HOT, held: int = BLOOM_BYTES) -> DataFrame:
    """Bytes of each text that a 50-byte string covers which also starts in a document with a smaller doc_id.

    docs: doc_id, text. Returns doc_id, n_bytes, n_removed, n_spans (maximal removed
    runs) and kept_sha256 (of the remaining bytes). Judged on the input; matches
    never cross documents.

    Null text is empty, and texts under 50 bytes keep all. A null doc_id counts as
    larger than any other. Of documents with the same text the one with the smallest
    id decides, the others lose everything; rows with the same doc_id don't affect
    each other. Repeated rows stay. An empty table has no rows. Texts are taken
    whole, up to 2 GB (places in a text are 32 bits). Other columns are ignored.
    """
    rows, done = repeated_runs(docs, hot, held)
    done = done.withColumnsRenamed({"tid": "__tid", "least": "__least"})
    copy, zero = (F.col("id") > F.col("least")) & (F.col("n_bytes") >= WINDOW), F.lit(0).cast("long")
    # copies need no fact: only rows of least ids move to theirs
    own = rows.where(~copy)
    own = own.join(done, (own["quick"] == done["__tid"]) & (own["least"] == done["__least"]), "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", F.lower(F.hex("sha"))).alias("kept_sha256"),
    )
    empty = hashlib.sha256(b"").hexdigest()
    gone = rows.where(copy).select("doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(empty).alias("kept_sha256"))
    return own.unionByName(gone)
