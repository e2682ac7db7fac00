"""Best-fit packing planned on the histogram of lengths.

The plan looks at counts of lengths, never at documents: best-fit decreasing
places whole runs of equal lengths at once, so its work depends on the sequence
length alone. Documents then take the planned slots by their rank within length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilewright.llm import common, tokens

#: A rank within length is counted in this many parts, so that no length is one task's.
RANK_PARTS = 64


def plan_slots(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of lengths (1 to `capacity`).

    Returns rows (length, rank_from, rank_to, sequence, copies, offset): of the
    pieces of that length, rank r from rank_from to before rank_to goes to
    sequence + (r - rank_from) // copies, at offset + (r - rank_from) % copies *
    length. Sequences are numbered gapless from 0.
    """
    free: list[int] = []  # rooms that some open group has, ascending
    groups: dict[int, list[tuple[int, list]]] = {}  # room -> (sequences, what each holds)
    closed: list[tuple[int, list]] = []

    def put(room: int, n: int, held: list) -> None:
        if room == 0:
            closed.append((n, held))
            return
        if room not in groups:
            insort(free, room)
            groups[room] = []
        groups[room].append((n, held))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(free, length)
            if at < len(free):  # the smallest room that is large enough
                room = free[at]
                n, held = groups[room].pop()
                if not groups[room]:
                    del groups[room], free[at]
            else:
                room, n, held = capacity, left, []
            copies = min(room // length, left)  # what is left after a piece is the best fit for the next
            used = min(n, left // copies)
            if n > used and held:  # the other sequences keep their pieces: later ranks
                put(room, n - used, [(l, r + used * c, c, o) for l, r, c, o in held])  # noqa: E741
            put(room - copies * length, used, [*held, (length, rank, copies, capacity - room)])
            rank += used * copies
            left -= used * copies
    rows, sequence = [], 0
    for n, held in closed + [group for room in free for group in groups[room]]:
        for length, rank, copies, offset in held:
            rows.append((length, rank, rank + n * copies, sequence, copies, offset))
        sequence += n
    return rows


def token_pieces(docs: DataFrame, capacity: int, tokenizer: str, end_id: int, remembered: int | None = None) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece; ids stay in the task."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer, remembered)
        for batch in batches:
            rows, pieces, starts, lengths, sums = [], [], [], [], []
            ids, ends = encoder.many(batch["text"], end_id)
            every, ends = memoryview(ids).cast("B"), ends.tolist()
            for row, (first, last) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                raw, n = every[4 * first : 4 * last], last - first
                edges = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(a)
                    lengths.append(b - a)
                    sums.append(zlib.crc32(raw[4 * a : 4 * b]))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return common.doc_texts(docs).mapInArrow(cut, schema)


def ranked(pieces: DataFrame, parts: int = RANK_PARTS) -> DataFrame:
    """Add __rank, gapless from 0 within each length, without one task for a length.

    Rows are ranked within (length, part of the hash of their id); the counts of
    these, lengths x parts rows at most, give each part its first rank.
    """
    dealt = pieces.withColumn("__part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        dealt.groupBy("length", "__part").agg(F.count("*").alias("__n"))
        .select("length", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    )
    own = Window.partitionBy("length", "__part").orderBy("doc_id", "piece", "ids_crc32", "start")
    return dealt.withColumn("__own", F.row_number().over(own) - 1).join(F.broadcast(first), ["length", "__part"]).withColumn("__rank", F.col("__first") + F.col("__own"))


def pack_documents(docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None, end_id: int = 2, remembered: int | None = None) -> DataFrame:
    """Pack every document of `docs` (doc_id, text) into sequences of at most `capacity` tokens.

    A document is its ids and `end_id`. Longer ones are cut into pieces of
    `capacity` tokens, of which the first may be shorter. Returns doc_id, piece,
    start, length, ids_crc32, sequence_id and offset (the token's place in the
    sequence, gapless from 0).

    A null or empty text is one token. Rows that repeat, or share a null or equal
    doc_id, are packed each by themselves; which of two equal rows gets which slot
    is arbitrary, and they are the same. An empty table has no rows. Other columns
    are ignored.

    Texts are read and encoded once, without a shuffle; what moves is a narrow row
    per piece. The histogram and the plan depend on `capacity`, not on the data.
    `remembered` bounds the pieces of texts that a worker keeps ids of (some 100 bytes
    each); it costs time, never rows or ids.
    """
    spark = docs.sparkSession
    pieces = common.saved(token_pieces(docs, capacity, tokenizer or tokens.default_path(), end_id, remembered))
    counts = {row[0]: row[1] for row in pieces.groupBy("length").count().collect()}
    plan = spark.createDataFrame(
        plan_slots(counts, capacity), "__length long, __from long, __to long, __sequence long, __copies long, __offset long"
    )
    rows = ranked(pieces)
    place = F.col("__rank") - F.col("__from")
    fits = (rows["length"] == plan["__length"]) & (rows["__rank"] >= plan["__from"]) & (rows["__rank"] < plan["__to"])
    return rows.join(F.broadcast(plan), fits).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("__sequence") + F.floor(place / F.col("__copies"))).alias("sequence_id"),
        (F.col("__offset") + place % F.col("__copies") * F.col("length")).alias("offset"),
    )
