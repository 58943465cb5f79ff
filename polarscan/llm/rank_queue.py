"""Byte-level BPE by a rank queue on a hierarchical bitmap.

A pre-token's tokens are a linked list over its byte positions. Every neighbouring pair that the rank file knows waits in the
bucket of its merge rank, as the position where the pair begins. A bitmap of two levels marks the ranks with a bucket: one bit
per rank, gathered in words, and one bit per word that is not zero, so the next rank is two find-first-set steps away, whatever
the pre-token's length. A bucket is emptied from left to right; a merge changes the pairs on both sides, whose old entries stay
and are skipped when they come up, because another pair begins there by then. If a new pair's rank is lower, the rest of the
bucket waits. Several pre-tokens share a queue, so that one step serves all that have the rank. The work is proportional to
the bytes (times the logarithm of a bucket), so a megabyte without a break is no special case.

Texts are cut where white space follows something else, which is always an edge of the pattern's matches, so a long text is
split run by run in bounded memory; only a run without such an edge is taken whole. Ids that a pre-token has are remembered
per worker in a table of at most ``REMEMBERED`` pre-tokens, which saves time and changes no result.

Defined results: null and empty texts have no tokens; equal rows stay rows; further columns are ignored; an id that the rank
file does not have stops decoding with an error, as with the library.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_texts, table, texts

RUN = 1 << 20  # code points that are split and encoded at once
REMEMBERED = 800_000
REMEMBERED_LENGTH = 64  # longer pre-tokens are not remembered
BATCH_BYTES = 8 << 20

EDGE = regex.compile(r"\S(?=\s)")


def rank_file(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class RankCoder:
    """Encodes by merge ranks and decodes by the table of id and bytes."""

    def __init__(self, ranks: dict[bytes, int], split: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the rank file lacks single bytes, {missing[0]} among them")
        self.ranks = ranks
        self.matches = regex.compile(split)
        n = max(ranks.values()) + 1
        self.pieces: list[bytes | None] = [None] * n
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.has_piece = np.array([piece is not None for piece in self.pieces])
        self.decimals = [str(k) for k in range(n)]
        self.known: dict[str, bytes] = {}
        # The queue: positions by rank, and the bitmap over them. All of it is empty between two calls.
        self.shift = max(1, ((n - 1).bit_length() + 1) // 2)
        self.words = [0] * ((n >> self.shift) + 1)
        self.buckets: list[list[int] | None] = [None] * n
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)])
        self.pair_rank = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)])

    def _fill(self, pair: np.ndarray) -> int:
        """Puts all first pairs into their buckets, in order of position; returns the upper level of the bitmap."""
        at = np.flatnonzero(pair >= 0)
        at = at[np.argsort(pair[at], kind="stable")]
        ranks, first = np.unique(pair[at], return_index=True)
        places, cuts, top = at.tolist(), [*first.tolist(), len(at)], 0
        for rank, low, high in zip(ranks.tolist(), cuts, cuts[1:]):
            self.buckets[rank] = places[low:high]
            word = rank >> self.shift
            self.words[word] |= 1 << (rank & (1 << self.shift) - 1)
            top |= 1 << word
        return top

    def merged(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each of some pre-tokens. They lie end to end in one list that no pair crosses from one to the next; the
        order of merges inside each is the same as if it were alone."""
        find, buckets, words, shift = self.ranks.get, self.buckets, self.words, self.shift
        mask = (1 << shift) - 1
        data = b"".join(pieces)
        n, ends = len(data), np.cumsum([len(p) for p in pieces])
        values = np.frombuffer(data, np.uint8).astype(np.int64)
        first = np.full(n, -1)
        first[:-1] = self.pair_rank[values[:-1] << 8 | values[1:]]
        first[ends - 1] = -1
        top, pair = self._fill(first), first.tolist()  # pair: rank of the pair that begins here, -1: none, or no token begins here
        token = self.byte_rank[values].tolist()  # rank of the token that begins here, -1: none
        edge = np.zeros(n + 1, bool)
        edge[ends] = edge[0] = True
        at_edge = edge.tolist()
        after = list(range(1, n + 2))  # where the next token begins
        before = list(range(-1, n))
        opened: list[int] = []
        while top:
            word = (top & -top).bit_length() - 1  # two find-first-set steps to the lowest rank
            bits = words[word]
            low = bits & -bits
            rank = word << shift | low.bit_length() - 1
            bucket = buckets[rank]
            buckets[rank] = None
            words[word] = bits = bits ^ low
            if not bits:
                top &= top - 1
            bucket.sort()  # leftmost first
            for done, i in enumerate(bucket, 1):
                if pair[i] != rank:
                    continue  # stale: another pair begins here by now, or no token does
                gone = after[i]
                end = after[gone]
                after[i] = end
                before[end] = i
                pair[gone] = token[gone] = -1
                token[i] = least = rank
                pair[i] = -1
                if not at_edge[end]:
                    new = find(data[i : after[end]])
                    if new is not None:
                        pair[i] = new
                        other = buckets[new]
                        if other is None:
                            buckets[new] = [i]
                            opened.append(new)
                        else:
                            other.append(i)
                if not at_edge[i]:
                    left = before[i]
                    new = find(data[left:end])
                    if new is None:
                        pair[left] = -1
                    else:
                        pair[left] = new
                        other = buckets[new]
                        if other is None:
                            buckets[new] = [left]
                            opened.append(new)
                        else:
                            other.append(left)
                if opened:  # new buckets set their bits
                    for new in opened:
                        words[new >> shift] |= 1 << (new & mask)
                        top |= 1 << (new >> shift)
                    least = min(opened)
                    opened.clear()
                if least < rank and done < len(bucket):  # a lower rank is due before the rest of this bucket
                    rest = bucket[done:]
                    buckets[rank] = rest if buckets[rank] is None else buckets[rank] + rest
                    words[rank >> shift] |= 1 << (rank & mask)
                    top |= 1 << (rank >> shift)
                    break
        tokens = np.array(token, np.int64)
        places = np.flatnonzero(tokens >= 0)
        cuts = np.searchsorted(places, ends)
        return np.split(tokens[places].astype("<u4"), cuts[:-1])

    def _learn(self, matches: set[str]) -> None:
        """Ids of matches not met before: that of the whole, where the rank file has it, else by merging."""
        known, rest = self.known, []
        for match in matches:
            rank = self.ranks.get(match.encode())
            if rank is None:
                rest.append(match)
            else:
                known[match] = rank.to_bytes(4, "little")
        if rest:
            known.update((match, ids.tobytes()) for match, ids in zip(rest, self.merged([match.encode() for match in rest])))

    def _ids(self, matches: list[list[str]]) -> list[bytes]:
        """Ids of lists of matches."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = set().union(*matches).difference(self.known)
        self._learn(new)
        found = [b"".join(map(self.known.__getitem__, some)) for some in matches]
        for match in new:
            if len(match) > REMEMBERED_LENGTH:
                del self.known[match]
        return found

    def runs(self, text: str) -> Iterator[str]:
        """The text in runs of about ``RUN`` code points that end at an edge of the pattern's matches."""
        low = 0
        while len(text) - low > RUN:
            edge = EDGE.search(text, low + RUN)
            if edge is None:
                break
            yield text[low : edge.end()]
            low = edge.end()
        yield text[low:]

    def encode_all(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of all matches of the pattern in each text, in order, as unsigned 32-bit integers."""
        held, size = [], 0
        for text in texts:
            if len(text) <= RUN:
                held.append(self.matches.findall(text))
                size += len(text)
            if size > RUN or len(text) > RUN:
                yield from (np.frombuffer(ids, "<u4") for ids in self._ids(held))
                held, size = [], 0
            if len(text) > RUN:
                yield np.frombuffer(b"".join(self._ids([self.matches.findall(run)])[0] for run in self.runs(text)), "<u4")
        yield from (np.frombuffer(ids, "<u4") for ids in self._ids(held))

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))

    def decode(self, ids: np.ndarray) -> bytes:
        strange = (ids < 0) | (ids >= len(self.has_piece)) | ~self.has_piece[np.clip(ids, 0, len(self.has_piece) - 1)]
        if strange.any():
            raise ValueError(f"unknown id {ids[strange][0]}")
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))


@functools.lru_cache(maxsize=4)
def coder(path: str, split: str) -> RankCoder:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return RankCoder(ranks, split)


def _rows(rows: Iterator[tuple], kinds: dict[str, pa.DataType], size) -> Iterator[pa.RecordBatch]:
    """Batches of rows, of about ``BATCH_BYTES`` each."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += size(row)
        if weight >= BATCH_BYTES:
            yield _batch(held, kinds)
            held, weight = [], 0
    if held:
        yield _batch(held, kinds)


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))


def encoded(docs: DataFrame, path: str, split: str) -> DataFrame:
    """(doc_id, ids) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(path, split).encode_all
        rows = ((i, ids.view("<i4")) for b in batches for i, ids in zip(b.column(0).to_pylist(), encode(as_texts(b.column(1)))))
        yield from _rows(rows, {"doc_id": pa.int64(), "ids": pa.list_(pa.int32())}, lambda row: row[1].nbytes + 16)

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def _ids(column: pa.ListArray) -> Iterator[np.ndarray]:
    for row in column:
        yield np.empty(0, np.int32) if row.values is None else row.values.to_numpy()


def decoded(rows: DataFrame, path: str, split: str) -> DataFrame:
    """(doc_id, content) from (doc_id, ids): the bytes of the ids' pieces. They need not be valid UTF-8 if the ids were cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = coder(path, split).decode
        found = ((i, decode(ids)) for b in batches for i, ids in zip(b.column(0).to_pylist(), _ids(b.column(1))))
        yield from _rows(found, {"doc_id": pa.int64(), "content": pa.binary()}, lambda row: len(row[1]) + 16)

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, content binary")


def digests(rows: DataFrame, path: str, split: str) -> DataFrame:
    """Number of ids, digest of the ids as decimals and digest of the decoded bytes, from (doc_id, ids)."""
    kinds = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode, decimal = coder(path, split).decode, coder(path, split).decimals.__getitem__

        def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
            for doc_id, ids in zip(batch.column(0).to_pylist(), _ids(batch.column(1))):
                decimals = " ".join(map(decimal, ids.tolist())).encode()
                yield doc_id, len(ids), hashlib.sha256(decimals).hexdigest(), hashlib.sha256(decode(ids)).hexdigest()

        yield from _rows((row for b in batches for row in rows_of(b)), kinds, lambda row: 200)

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op12_rank_queue_bpe(spark, sf_dir: str) -> DataFrame:
    path, split = rank_file(), pattern()
    return digests(encoded(table(spark, sf_dir, "documents"), path, split), path, split)
