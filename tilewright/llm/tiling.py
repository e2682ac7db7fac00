"""Benchmark decontamination by greedy string tiling.

Word windows of the benchmark are seeds; a document's rolling (Karp-Rabin) window
hashes are looked up among them. For each document and item that share a seed,
the longest common passages that don't overlap are marked, longest first, until
none of the least length is left. Marked words over the item's words is the
coverage, whatever the order in which the passages stand.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import common, memory

#: Words in the shortest passage, and the part of an item's words from which a document counts as contaminated.
LEAST_WORDS, COVERAGE = 5, 0.5

#: Words of benchmark text that are broadcast at once (some 50 bytes each); a larger benchmark is taken in turns.
CHUNK_WORDS = 1_000_000

#: Meetings of windows that are in memory at once.
HITS = 1 << 19

_WORD = re.compile(r"\w+")
_BASE = 0x9E3779B97F4A7C15


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the lower-cased words; punctuation and spacing don't count."""
    return np.array(memory.word_hashes(_WORD.findall(text.lower())), np.uint64)


def rolling(words: np.ndarray, least: int) -> np.ndarray:
    """Karp-Rabin hash of each window of `least` words."""
    n = len(words) - least + 1
    if n <= 0:
        return np.array([], np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(least):
        out = out * np.uint64(_BASE) + words[k : k + n]
    return out


class Seeds:
    """The windows of some benchmark items, by hash; with `short`, items under the least length by the hash of the whole."""

    def __init__(self, items: list[tuple[int, str]], least: int, short: bool = False):
        self.least = least
        hashed = [(item, word_hashes(text or "")) for item, text in items]
        self.items = [(item, words) for item, words in hashed if len(words) >= least]
        parts = [rolling(words, least) for _, words in self.items]
        hashes = np.concatenate([*parts, np.array([], np.uint64)])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.item = np.concatenate([*(np.full(len(p), k) for k, p in enumerate(parts)), np.array([], np.int64)]).astype(np.int64)[order]
        self.at = np.concatenate([*(np.arange(len(p)) for p in parts), np.array([], np.int64)]).astype(np.int64)[order]
        self.words = np.concatenate([*(words for _, words in self.items), np.array([], np.uint64)])
        begin = np.cumsum([0, *(len(words) for _, words in self.items)])
        self.place = self.at + begin[self.item]  # in self.words
        self.short = np.zeros(1 << 20, bool)
        self.short[(self.hashes >> np.uint64(44)).astype(np.int64)] = True
        self.whole: dict[int, dict[bytes, list[int]]] = defaultdict(lambda: defaultdict(list))  # words -> item's bytes -> items
        for item, words in hashed if short else []:
            if 0 < len(words) < least:
                self.whole[len(words)][words.tobytes()].append(item)
        self.whole = {n: dict(own) for n, own in self.whole.items()}

    def short_items(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, words, first place) of the items under the least length that stand in the text as a whole."""
        for n, own in self.whole.items():
            windows, known = rolling(words, n), rolling_keys(own, n)
            for at in np.flatnonzero(np.isin(windows, known)) if len(windows) else []:
                for item in own.get(words[at : at + n].tobytes(), ()):
                    yield item, n, int(at)

    def runs(self, words: np.ndarray, block: int = HITS) -> dict[int, list[tuple[int, int, int]]]:
        """Maximal common passages (length, place in item, place in document) by item."""
        return dict(self.runs_by_item(words, block=block))

    def runs_by_item(self, words: np.ndarray, coverage: float = 0.0, block: int = HITS) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """The same, item after item; items of which no tiling can mark `coverage` of the words are left out.

        Some `block` meetings of an item's and the text's windows (those of one window at
        least) are in memory at once, however often a passage stands on either side; an
        item that a passage covers as a whole needs no other.
        """
        windows = rolling(words, self.least)
        near = np.flatnonzero(self.short[(windows >> np.uint64(44)).astype(np.int64)])
        if not len(near):
            return
        own = words[near[:, None] + np.arange(self.least)]
        name, first, group = np.unique(windows[near], return_index=True, return_inverse=True)
        if not (own == own[first][group]).all():  # equal hashes of different words
            _, first, group = np.unique(own, axis=0, return_index=True, return_inverse=True)
            name, group = windows[near][first], group.ravel()
        low, high = (np.searchsorted(self.hashes, name, side) for side in ("left", "right"))
        n = high - low
        if not n.any():
            return
        seed = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        kind = np.repeat(np.arange(len(name)), n)
        same = (self.words[self.place[seed][:, None] + np.arange(self.least)] == own[first][kind]).all(axis=1)
        seed, kind = seed[same], kind[same]
        by_item = np.lexsort((self.at[seed], self.item[seed]))
        seed, kind = seed[by_item], kind[by_item]
        places = near[np.argsort(group, kind="stable")]
        edge = np.append(0, np.cumsum(np.bincount(group, minlength=len(name))))
        item = self.item[seed]
        starts = np.flatnonzero(np.diff(item, prepend=-1))
        for a, b in zip(starts, np.append(starts[1:], len(item)), strict=True):
            k, at = int(item[a]), self.at[seed[a:b]]
            size = len(self.items[k][1])
            if np.minimum(np.diff(at, append=at[-1] + self.least), self.least).sum() < coverage * size:
                continue
            yield k, self._runs(at, kind[a:b], places, edge, size, block)

    def _runs(self, at: np.ndarray, kind: np.ndarray, places: np.ndarray, edge: np.ndarray, size: int, block: int) -> list[tuple[int, int, int]]:
        """One item's runs: its windows `at` of some kinds, whose places in the text are places[edge[kind] : edge[kind + 1]]."""
        n = edge[kind + 1] - edge[kind]
        total, begin, out = np.cumsum(n), 0, []
        while begin < len(at):
            end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + block, "right")))
            own = n[begin:end]
            p = np.repeat(at[begin:end], own)
            t = places[np.repeat(edge[kind[begin:end]], own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)]
            order = np.lexsort((p, t - p))
            p, t = p[order], t[order]
            new = np.flatnonzero((np.diff(t - p, prepend=np.iinfo(np.int64).min // 2) != 0) | (np.diff(p, prepend=-2) != 1))
            length = np.diff(np.append(new, len(p))) + self.least - 1
            if (length == size).any():
                whole = new[np.flatnonzero(length == size)[0]]
                return [(size, int(p[whole]), int(t[whole]))]
            out += zip(length.tolist(), p[new].tolist(), t[new].tolist(), strict=True)
            begin = end
        out = _joined(out)
        whole = next((run for run in out if run[0] == size), None)
        return [whole] if whole else out


def rolling_keys(own: dict[bytes, list[int]], n: int) -> np.ndarray:
    """The window hashes of the keys of `own`, each the bytes of `n` word hashes."""
    return rolling(np.frombuffer(b"".join(own), np.uint64), n)[::n]


def _joined(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs that a block's edge cut are one again."""
    out: list[tuple[int, int, int]] = []
    for size, p, t in sorted(runs, key=lambda r: (r[2] - r[1], r[1])):
        if out and out[-1][2] - out[-1][1] == t - p and p <= out[-1][1] + out[-1][0]:
            last = out.pop()
            out.append((max(last[0], p + size - last[1]), last[1], last[2]))
        else:
            out.append((size, p, t))
    return out


def tiles(runs: list[tuple[int, int, int]], n_item: int, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: mark the longest unmarked passage again and again; ties by place in item, then document."""
    free_item, taken, out = np.ones(n_item, bool), [], []
    heap = [(-size, p, t) for size, p, t in runs]
    heapq.heapify(heap)
    while heap and free_item.any():
        size, p, t = heapq.heappop(heap)
        size = -size
        open_ = free_item[p : p + size].copy()
        for a, b in taken:  # tiles in the document are few: they don't overlap in the item
            if a < t + size and b > t:
                open_[max(0, a - t) : max(0, b - t)] = False
        if open_.all():
            free_item[p : p + size] = False
            taken.append((t, t + size))
            out.append((size, p, t))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], open_, [False]]).astype(np.int8)))
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            if b - a >= least:
                heapq.heappush(heap, (-int(b - a), p + int(a), t + int(a)))
    return out


def _chunks(rows: Iterator[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    chunk, n = [], 0
    for item, text in rows:
        chunk.append((item, text))
        n += len(text or "") // 4 + 1
        if n >= CHUNK_WORDS:
            yield chunk
            chunk, n = [], 0
    if chunk:
        yield chunk


def _marked(seeds: Seeds, words: np.ndarray, coverage: float) -> Iterator[tuple[int, float, list[tuple[int, int, int]]]]:
    """(item, coverage, tiles) of the items of which a text holds `coverage` or more."""
    for k, runs in seeds.runs_by_item(words, coverage):
        item, own = seeds.items[k]
        marked = tiles(runs, len(own), seeds.least)
        part = sum(size for size, _, _ in marked) / len(own)
        if part >= coverage:
            yield item, part, marked
    seen = set()
    for item, n, at in seeds.short_items(words):
        if item not in seen:  # equal items under one id count once
            seen.add(item)
            yield item, 1.0, [(n, 0, at)]


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, least: int = LEAST_WORDS, coverage: float = COVERAGE, short: bool = False) -> DataFrame:
    """Pairs of a document and a benchmark item of which it holds `coverage` of the words or more.

    Returns doc_id, item_id, coverage, n_tiles, longest (words), tiles (array of
    words, item_start, doc_start in words). One row per row of `docs` and item;
    documents without any are left out. Of equally long passages the one first in
    the item is marked, then the one first in the document.

    Null texts hold no words. Items of fewer than `least` words match nothing, or,
    with `short`, a document in which they stand as a whole; items without words
    never match. Repeated items and documents give repeated pairs; null ids are
    kept. Texts of any length, and passages that stand any number of times on
    either side, are taken whole, in blocks. Empty tables have no pairs. Other
    columns are ignored.

    Texts stay where they are: the benchmark, streamed to the driver in chunks of
    bounded size, is broadcast; no shuffle. With more than one chunk each one's
    pairs are stored before the next is broadcast, and the texts are read once a chunk.
    """
    schema = "doc_id long, item_id long, coverage double, n_tiles int, longest int, tiles array<struct<words:int,item_start:int,doc_start:int>>"
    texts = common.doc_texts(docs)

    def of_chunk(shared) -> DataFrame:
        def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seeds = shared.value
            for batch in batches:
                found = []
                for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                    for item_id, part, marked in _marked(seeds, word_hashes(text.as_py()), coverage):
                        found.append((doc_id.as_py(), item_id, part, len(marked), max(m[0] for m in marked), [dict(zip(("words", "item_start", "doc_start"), m, strict=True)) for m in marked]))
                columns = list(zip(*found, strict=True)) or [()] * 6
                types = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.list_(pa.struct([(n, pa.int32()) for n in ("words", "item_start", "doc_start")])))
                names = ["doc_id", "item_id", "coverage", "n_tiles", "longest", "tiles"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        return texts.mapInArrow(tile, schema)

    out = None
    for shared, before in _broadcasts(docs.sparkSession, benchmark, least, short):
        if before is not None:
            out = common.saved(out)
            before.unpersist()
        out = of_chunk(shared) if out is None else out.unionByName(of_chunk(shared))
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def _broadcasts(spark: SparkSession, benchmark: DataFrame, least: int, short: bool) -> Iterator[tuple]:
    """(the broadcast seeds of a chunk, those of the chunk before), chunk by chunk."""
    rows, before = benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator(), None
    for chunk in _chunks((row[0], row[1]) for row in rows):
        shared = spark.sparkContext.broadcast(Seeds(chunk, least, short))
        yield shared, before
        before = shared


def decontaminate(docs: DataFrame, benchmark: DataFrame, least: int = LEAST_WORDS, coverage: float = COVERAGE) -> DataFrame:
    """`docs` without all rows whose doc_id (null too) a contaminated document has; all columns stay.

    Clean rows that share such an id go as well: `without_leaks` looks at each row.
    Null and empty texts hold nothing; repeated rows go or stay together; texts are
    taken whole; an empty table or benchmark drops nothing.
    """
    ids = common.saved(contaminated_pairs(docs, benchmark, least, coverage).select("doc_id").distinct())
    return common.without_ids(docs, ids)


def without_leaks(docs: DataFrame, benchmark: DataFrame, least: int = LEAST_WORDS, coverage: float = COVERAGE, short: bool = False) -> DataFrame:
    """`docs` without the rows whose own text holds `coverage` or more of an item; all columns stay.

    Each row is judged by its text alone: clean rows with a null or repeated doc_id
    stay, rows that repeat go or stay together. Null and empty texts hold nothing
    and stay. Texts are taken whole, whatever their length. Items under `least`
    words drop nothing unless `short` (a one-word item would drop every text with
    that word). An empty table has no rows; an empty benchmark drops none.
    """
    common.small_batches(docs.sparkSession)
    clean = docs
    for shared, before in _broadcasts(docs.sparkSession, benchmark, least, short):
        if before is not None:
            clean = common.saved(clean)
            before.unpersist()

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            seeds = shared.value
            for batch in batches:
                leaks = [next(_marked(seeds, word_hashes(text.as_py() or ""), coverage), None) is not None for text in batch["text"]]
                yield batch.filter(pa.array([not leak for leak in leaks], pa.bool_()))

        clean = clean.mapInArrow(keep, docs.schema)
    return clean
