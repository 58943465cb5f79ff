"""Best-fit packing of token sequences into bins of several permitted lengths.

A bin of length S costs S + S * S / ``KNEE`` (dense layers and attention). Pieces are taken by decreasing length; a piece goes
into the open bin, of whatever size, that it fills best; if none has room, the size is opened that costs least per token it
can expect to hold: what the pieces of this length fill, and for the gap the shorter pieces that are still to come. At the end
each bin is downsized to the least permitted length that holds its contents.

Pieces of one length are alike, so the plan needs only the number of pieces of each length: a table of at most ``max(sizes)``
rows, which Spark counts. Bins with equal free room are kept as one group, a step fills or splits one group, and the plan is
exactly what best-fit over single pieces gives. Documents then find their places by length and rank; ranks come from counts
per partition plus the position inside it, so a length that a third of all pieces have is never gathered in one task.

Texts longer than the largest size are cut into pieces of that size. Defined results: null and empty texts are one piece of
one token (the end mark); equal rows are packed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, map_batches, staged, table, texts

SIZES = (512, 1024, 2048, 4096)
KNEE = 8192


def cost(size: int) -> float:
    return size + size * size / KNEE


class Groups:
    """Open bins: per amount of free room the groups (first bin, number of bins, contents). Bins of a group are alike."""

    def __init__(self):
        self.rooms: list[int] = []
        self.by_room: dict[int, list[tuple[int, int, int, int]]] = {}

    def add(self, room: int, first: int, bins: int, size: int) -> None:
        if room not in self.by_room:
            bisect.insort(self.rooms, room)
            self.by_room[room] = []
        self.by_room[room].append((first, bins, size, room))

    def tightest(self, length: int) -> tuple[int, int, int, int] | None:
        at = bisect.bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        group = self.by_room[room].pop()
        if not self.by_room[room]:
            del self.by_room[room], self.rooms[at]
        return group


def opening(length: int, count: int, shorter: int, room: int, sizes=SIZES) -> int:
    """The size with the least cost per expected token for ``count`` pieces of ``length``. ``shorter`` tokens are still to
    come in shorter pieces, of which ``room`` fit into bins that are open already."""

    def per_token(size: int) -> float:
        each = size // length
        bins = -(-count // each)
        filled = min(count, each * bins) * length / bins
        return cost(size) / (filled + min(size - filled, max(0, shorter - room) / bins))

    return min((s for s in sizes if s >= length), key=lambda s: (per_token(s), s))


def plan(counts: Mapping[int, int], sizes=SIZES) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int, int]]]:
    """(slots, bins). A slot (length, first rank, bins, first bin, pieces per bin) takes the pieces of that length with ranks
    from ``first rank`` on: ``pieces per bin`` into each of ``bins`` bins in turn. A run of bins is (first bin, bins, size
    opened, free room)."""
    groups, slots, opened = Groups(), [], 0
    shorter, room = sum(n * c for n, c in counts.items()), 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        shorter -= length * left

        def put(first: int, bins: int, each: int, size: int, free: int) -> None:
            nonlocal left, rank, room
            slots.append((length, rank, bins, first, each))
            groups.add(free - each * length, first, bins, size)
            rank, left, room = rank + bins * each, left - bins * each, room - bins * each * length

        while left:
            group = groups.tightest(length)
            if group is None:
                size = opening(length, left, shorter, room, sizes)
                each = min(size // length, left)
                bins = left // each
                room += bins * size
                put(opened, bins, each, size, size)
                opened += bins
                continue
            first, bins, size, free = group
            each = min(free // length, left)  # best fit returns to the bin it has just filled further
            full = min(bins, left // each)
            if full < bins:
                groups.add(free, first + full, bins - full, size)
            put(first, full, each, size, free)
    return slots, [g for some in groups.by_room.values() for g in some]


def downsized(size: int, free: int, sizes=SIZES) -> int:
    return next(s for s in sorted(sizes) if s >= size - free)


def count_tokens(text: bytes) -> int:
    """Words and an end mark. Any other count can be passed to ``pack`` as a column."""
    return len(text.split()) + 1


def token_lengths(docs: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = [count_tokens(x) for x in as_bytes(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["doc_id", "tokens"])

    return map_batches(texts(docs), run, "doc_id long, tokens long")


def _pieces(lengths: DataFrame, largest: int) -> DataFrame:
    """doc_id, piece, start and length of each piece, with its place in the written table: partition and rank by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(largest + 1, np.int64)
        for batch in batches:
            total = np.maximum(batch.column(1).to_numpy(zero_copy_only=False), 1)
            n = -(-total // largest)
            owner = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            length = np.minimum(largest, total[owner] - piece * largest)
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            position = np.empty(len(length), np.int64)
            position[order] = np.arange(len(length)) - np.searchsorted(ordered, ordered, side="left")
            local = seen[length] + position
            np.add.at(seen, length, 1)
            ids = batch.column(0).take(pa.array(owner))
            arrays = [ids, pa.array(piece), pa.array(piece * largest), pa.array(length), pa.array(local)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "tokens", "local"])

    pieces = lengths.mapInArrow(run, "doc_id long, piece long, start long, tokens long, local long")
    return pieces.withColumn("part", F.spark_partition_id())


def pack(lengths: DataFrame, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """Places the pieces of (doc_id, tokens): doc_id, piece, start, tokens, bin, position in the bin, and the bin's size."""
    sizes = tuple(sorted(sizes))
    pieces = staged(_pieces(lengths.select("doc_id", "tokens"), sizes[-1]), "packing-pieces")
    per_part = pieces.groupBy("tokens", "part").agg(F.count("*").alias("n"))
    counts = {r["tokens"]: r["n"] for r in per_part.groupBy("tokens").agg(F.sum("n").alias("n")).collect()}
    slots, groups = plan(counts, sizes)
    offset = F.sum("n").over(_by_tokens()).cast("long") - F.col("n")
    ranked = pieces.join(per_part.select("tokens", "part", offset.alias("before")), ["tokens", "part"])
    return ranked.select("doc_id", "piece", "start", "tokens", (F.col("before") + F.col("local")).alias("rank")).mapInArrow(
        _placer(slots, groups, sizes), "doc_id long, piece long, start long, tokens long, bin long, position long, size long"
    )


def _by_tokens():
    from pyspark.sql import Window

    return Window.partitionBy("tokens").orderBy("part")


def _placer(slots, groups, sizes):
    """Looks up bin and position of a piece by (length, rank). The plan is bounded by the largest size, not by the data."""
    table_ = np.array(slots, dtype=np.int64).reshape(-1, 5)
    table_ = table_[np.lexsort((table_[:, 1], table_[:, 0]))]
    of_length = {n: (int(np.searchsorted(table_[:, 0], n)), int(np.searchsorted(table_[:, 0], n, side="right"))) for n in np.unique(table_[:, 0]).tolist()}
    runs = np.array(sorted((first, bins, downsized(size, free, sizes)) for first, bins, size, free in groups), dtype=np.int64).reshape(-1, 3)
    before = _positions(table_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
            bins, position = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                low, high = of_length[n]
                at = np.flatnonzero(length == n)
                slot = low + np.searchsorted(table_[low:high, 1], rank[at], side="right") - 1
                k = rank[at] - table_[slot, 1]
                each = table_[slot, 4]
                bins[at] = table_[slot, 3] + k // each
                position[at] = before(slot, bins[at]) + (k % each) * n
            size = runs[np.searchsorted(runs[:, 0], bins, side="right") - 1, 2] if len(bins) else bins
            arrays = [*(batch.column(i) for i in range(4)), pa.array(bins), pa.array(position), pa.array(size)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "tokens", "bin", "position", "size"])

    return run


def _positions(table_: np.ndarray):
    """Tokens that earlier (longer) slots put into a bin. Bins between two neighbouring slot borders have the same slots."""
    borders = np.unique(np.concatenate([table_[:, 3], table_[:, 3] + table_[:, 2]])) if len(table_) else np.zeros(1, np.int64)
    filled = np.zeros(len(borders), np.int64)
    start = {}
    for i in np.lexsort((table_[:, 1], -table_[:, 0])):
        length, _, bins, first, each = table_[i]
        low, high = np.searchsorted(borders, (first, first + bins))
        start[int(i)] = (int(low), filled[low:high].copy())
        filled[low:high] += length * each

    def before(slot: np.ndarray, bins: np.ndarray) -> np.ndarray:
        stretch = np.searchsorted(borders, bins, side="right") - 1
        return np.array([start[s][1][t - start[s][0]] for s, t in zip(slot.tolist(), stretch.tolist())], dtype=np.int64)

    return before


def packed_texts(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: (bin, size, doc_ids, words of its pieces in order). Ids must be unique here; a bin
    holds at most ``size`` tokens, so a group is bounded."""
    words = F.split(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")), " ")
    joined = placed.join(texts(docs), "doc_id").withColumn("words", F.array_remove(words, ""))
    cut = joined.select("bin", "size", F.struct("position", "doc_id", F.slice("words", F.col("start").cast("int") + 1, F.col("tokens").cast("int")).alias("words")).alias("piece"))
    return cut.groupBy("bin", "size").agg(F.array_sort(F.collect_list("piece")).alias("pieces")).select(
        "bin", "size", F.col("pieces.doc_id").alias("doc_ids"), F.flatten(F.col("pieces.words")).alias("words")
    )


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(token_lengths(table(spark, sf_dir, "documents")))
