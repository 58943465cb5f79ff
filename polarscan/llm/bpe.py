"""BPE encoding and decoding by a distinct-word table.

Documents are split into words in Spark tasks exactly as the tokenizer's normaliser and splitter do. The distinct words of all
blocks are shuffled and sorted by word: that is the word table, each run of equal words one entry, which is encoded once; its ids come back to all its positions. For decoding, the ids of a block's distinct words are joined with the
table of id and piece, which every task holds (its size is that of the vocabulary file), and the pieces come back by position
in the same way.

Defined results: null and empty texts, and texts of white space, have no tokens; equal rows stay rows; the special tokens'
strings in a text are the special tokens, as with the library.
"""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .blocks import blocks_of, unpack_codes, with_words, word_rows
from .common import shuffle_partitions, table

BLOCK_BYTES = 32 << 20  # larger blocks hold fewer distinct words per token

# Texts of these characters only are in composed form and split alike by the two patterns below, of which one is faster.
SIMPLE = re.compile(r"[\t-\r -~À-ÖØ-öø-ɏ«»¡¿–—‘’“”…€]*")
FAST = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
SPACES = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
EXACT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACES}\p{{L}}\p{{N}}]+")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=4)
def _word_tokenizer(path: str):
    """For words that the splitter has normalised already: a second pass could reorder marks."""
    from tokenizers import Tokenizer, normalizers

    tokenizer = Tokenizer.from_file(path)
    tokenizer.normalizer = normalizers.Sequence([])
    return tokenizer


class Splitter:
    """Words of a text as the tokenizer sees them; a special token's string is one word."""

    def __init__(self, path: str):
        self.path = path
        added = _tokenizer(path).get_added_tokens_decoder()
        self.special = re.compile("|".join(f"({re.escape(t.content)})" for t in added.values())) if added else None
        self.marks = [t.content for t in added.values()]

    def __call__(self, data: bytes) -> list[str]:
        text = data.decode()
        if self.special is None or not any(mark in text for mark in self.marks):
            return self._plain(text)
        words, done = [], 0
        for m in self.special.finditer(text):
            words += [*self._plain(text[done : m.start()]), m[0]]
            done = m.end()
        return words + self._plain(text[done:])

    def _plain(self, text: str) -> list[str]:
        if SIMPLE.fullmatch(text):
            return FAST.findall(text.lower())
        # lower case is taken letter by letter, so a capital sigma never becomes the final form
        return EXACT.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


def _encode_runs(path: str):
    """Rows (home, code, word) of a partition, sorted by word, are its part of the distinct-word table: each run of equal
    words is one entry and is encoded once. Gives packed rows (home, codes, lengths, ids), one per block and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_ids = None, b""
        for batch in batches:
            words = batch.column(2).to_pylist()
            if not words:
                continue
            new = np.array([a != b for a, b in zip([last, *words], words)])
            distinct = [w for w, first in zip(words, new.tolist()) if first]
            found = _word_tokenizer(path).encode_batch(distinct, add_special_tokens=False)
            ids = [last_ids, *(np.array(e.ids, dtype="<u4").tobytes() for e in found)]
            of = np.cumsum(new)
            last, last_ids = words[-1], ids[-1]
            home, code = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            order = np.argsort(home, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(home[order]) != 0, True])
            rows = []
            for low, high in zip(cuts[:-1], cuts[1:]):
                at = order[low:high]
                own = [ids[k] for k in of[at].tolist()]
                lengths = np.array([len(x) // 4 for x in own], dtype="<u4")
                rows.append((home[at[0]], code[at].astype("<u4").tobytes(), lengths.tobytes(), b"".join(own)))
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["home", "codes", "lengths", "ids"])

    return run


def piece_table(path: str) -> pa.Array:
    """The pieces by id, special tokens included: the side of the decoding join that every task holds. Its size is that of
    the vocabulary file."""
    vocab = _tokenizer(path).get_vocab(with_added_tokens=True)
    by_id: list = [None] * (max(vocab.values()) + 1)
    for piece, number in vocab.items():
        by_id[number] = piece
    return pa.array(by_id, pa.string())


def texts_of(block: dict, facts: pa.Table, path: str):
    """(doc_id, ids, decoded text) of each document of a block: the ids of the block's words are joined to their pieces,
    and both come back to the words' positions."""
    codes = unpack_codes(block["codes"])
    packed = lambda name: np.frombuffer(b"".join(facts.column(name).to_pylist()), "<u4").astype(np.int64)
    known, sizes, flat = packed("codes"), packed("lengths"), packed("ids")
    n = int(max(codes.max(initial=-1), known.max(initial=-1))) + 1
    count, begin = np.zeros(n, np.int64), np.zeros(n, np.int64)
    count[known], begin[known] = sizes, np.cumsum(sizes) - sizes
    pieces = piece_table(path).take(pa.array(flat)).to_pylist()
    decoded: list = [None] * n
    for code, low, k in zip(known.tolist(), begin[known].tolist(), sizes.tolist()):
        if k:
            decoded[code] = " ".join(pieces[low : low + k])
    end = 0
    for doc_id, size in zip(block["doc_ids"], block["sizes"]):
        own = codes[end : end + size]
        end += size
        k = count[own]
        at = np.repeat(begin[own] - np.cumsum(k) + k, k) + np.arange(int(k.sum()))
        yield doc_id, flat[at], " ".join([d for d in map(decoded.__getitem__, own.tolist()) if d is not None])


def _blocks_and_facts(docs: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    blocks = blocks_of(docs, Splitter(path), block_bytes=BLOCK_BYTES)
    words = word_rows(blocks).select("home", "code", "word").repartition(shuffle_partitions(docs.sparkSession), "word")
    packed = words.sortWithinPartitions("word").mapInArrow(_encode_runs(path), "home long, codes binary, lengths binary, ids binary")
    return blocks, packed


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the decoded text of every document."""

    def run(block: dict, facts: pa.Table) -> pa.Table:
        rows = list(zip(*texts_of(block, facts, path)))
        return pa.table({"doc_id": pa.array(rows[0], pa.int64()), "ids": pa.array([r.astype(np.int32) for r in rows[1]], pa.list_(pa.int32())), "decoded": pa.array(rows[2])})

    return with_words(*_blocks_and_facts(docs, path), run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Like ``encoded``, but with digests for ids and text."""

    def run(block: dict, facts: pa.Table) -> pa.Table:
        rows = [
            (doc_id, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
            for doc_id, ids, text in texts_of(block, facts, path)
        ]
        kinds = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
        return pa.table({name: pa.array(c, k) for (name, k), c in zip(kinds.items(), zip(*rows))})

    return with_words(*_blocks_and_facts(docs, path), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_word_table_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), vocabulary())
