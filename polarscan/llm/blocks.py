"""Documents as blocks of word codes, so that a fact about each word reaches every place where the word stands.

A block is a run of documents of one partition, about ``BLOCK_BYTES`` of text (one longer document makes a block of its own).
It holds the documents' words as codes into the block's own list of distinct words. Only that list, not the text, is shuffled
by word; what is found out about a word comes back to the block by its code, and with it to all positions of the word. A word
enters the shuffle once per block, so a word that a third of all positions have is no hot key.

The blocks are written once, bucketed by block id, and are read in place when their words come back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bucketed, fold, texts

BLOCK_BYTES = 16 << 20

SCHEMA = "block long, doc_ids array<long>, held_out array<boolean>, sizes array<int>, codes binary, words array<string>, uses array<long>"


def pack_codes(codes: np.ndarray) -> bytes:
    """Codes as byte planes, compressed: high bytes are mostly zero."""
    planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(len(codes).to_bytes(8, "little") + planes.tobytes())


def unpack_codes(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(raw, np.uint8, offset=8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class _Block:
    def __init__(self):
        self.code: dict = {}
        self.codes: list[np.ndarray] = []
        self.ids: list = []
        self.held: list[bool] = []
        self.bytes = 0

    def add(self, doc_id, held: bool, words: list, size: int) -> None:
        put = self.code.setdefault
        code = self.code
        self.codes.append(np.fromiter((put(w, len(code)) for w in words), dtype=np.uint32, count=len(words)))
        self.ids.append(doc_id)
        self.held.append(held)
        self.bytes += size

    def row(self, number: int) -> pa.RecordBatch:
        sizes = np.array([len(c) for c in self.codes], dtype=np.int64)
        codes = np.concatenate(self.codes)
        training = np.repeat(~np.array(self.held), sizes)
        uses = np.bincount(codes[training], minlength=len(self.code))
        words = list(self.code)
        kind = pa.binary() if words and isinstance(words[0], bytes) else pa.string()
        one = lambda values, k: pa.array([values], pa.list_(k))
        arrays = [
            pa.array([number], pa.int64()),
            one(self.ids, pa.int64()),
            one(self.held, pa.bool_()),
            one(sizes, pa.int32()),
            pa.array([pack_codes(codes)], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(words, kind).cast(pa.string())),
            one(uses, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["block", "doc_ids", "held_out", "sizes", "codes", "words", "uses"])


def blocks_of(
    docs: DataFrame, split: Callable[[bytes], list], folds: int = 1, held_out: int = 1, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The written table of blocks. ``split`` gives a text's words; ``uses`` counts a word in texts that are not held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = _Block()
        for batch in batches:
            held = batch.column(1).to_pylist()
            for doc_id, out, text in zip(batch.column(0).to_pylist(), held, as_bytes(batch.column(2))):
                if block.bytes and block.bytes + len(text) > block_bytes:
                    yield block.row(number)
                    number, block = number + 1, _Block()
                block.add(doc_id, out, split(text), len(text))
        if block.ids:
            yield block.row(number)

    rows = texts(docs).select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "text")
    return bucketed(rows.mapInArrow(run, SCHEMA), "block", "word_blocks")


def word_rows(blocks: DataFrame) -> DataFrame:
    """(home, code, word, uses): one row per block and distinct word."""
    zipped = F.posexplode(F.arrays_zip("words", "uses")).alias("code", "w")
    return blocks.select(F.col("block").alias("home"), zipped).select("home", "code", F.col("w.words").alias("word"), F.col("w.uses").alias("uses"))


def with_words(blocks: DataFrame, facts: DataFrame, apply: Callable, schema: str) -> DataFrame:
    """Brings (home, ...) rows back to their blocks: ``apply(block row, facts)`` gives rows per document."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return apply(left.slice(0, 1).to_pylist()[0], right)

    kept = blocks.select("block", "doc_ids", "held_out", "sizes", "codes")
    return kept.groupBy("block").cogroup(facts.groupBy("home")).applyInArrow(run, schema)
