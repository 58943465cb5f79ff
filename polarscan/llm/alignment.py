"""Alignment of two tokenizers' tokens over the same bytes.

Each text is encoded by both tokenizers. Where a token ends is first read from the tokenizers' own spans: character offsets of
the one, turned into bytes by the text's character widths, and the byte spans of the other. These cuts are coarse: tokens
that split a character share its span, and byte-fallback tokens have none of their own. Such tokens are placed by the bytes they
decode to, counted from the last clean cut before them. Offsets where both tokenizations have a token end cut the text into
groups; all tokens of a group are linked with each other.

Both tokenizers end a token before a space that follows a character, so no group reaches over such a place. Texts are cut into
words there, and the alignment of a distinct word is worked out once per worker while it is remembered, many words in one call; a
text's is those of its words, laid end to end. Words that are long or have many links are aligned where they stand, in segments that
no token can reach over.

Counting: a block holds a run of documents (about ``BLOCK_BYTES`` of text) as digests and, per document, its linked id pairs as
codes into the block's list of distinct pairs, with the number of links. Only that list is shuffled: pairs are counted over all
blocks, each block is told the counts of its own pairs, and the codes bring them back to the documents. A pair enters the
shuffle once per block, however many documents have it.

Defined results: null and empty texts, and texts that one of the tokenizers does not give back byte for byte (such as those
that hold U+2581 themselves), have no tokens: zeros and an empty digest; equal rows stay rows and count one by one; special
tokens' strings are plain text; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from itertools import batched, chain
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_texts, bucketed, map_batches, staged, table, texts

BLOCK_BYTES = 16 << 20
ROWS = 1 << 16  # rows of an Arrow batch
LINKS = 1 << 20  # links of a document that are held before equal ones are added up
SPACE = "▁"
SPACED = re.compile(r" +[^ ]*")
CUT = re.compile(r" (?<=\S )")  # before it, both tokenizers end a token
RUN = 1 << 21
LARGE_RUN = 1 << 18  # code points of words that are aligned where they stand, at once
LEARNT = 1 << 11  # new words that are taken up at once
TOGETHER = 64  # segments that are encoded as one text: with many more, the merges' queue outgrows the cache
REMEMBERED = 250_000
REMEMBERED_LENGTH = 64  # longer words and segments are not remembered
REMEMBERED_LINKS = 64  # words of more links neither


def tokenizer_files(a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(a), public_tokenizers.path(b)


class Tokens(NamedTuple):
    ids: np.ndarray
    ends: np.ndarray  # byte offsets in space + text


class Strings:
    """Byte strings by number, to be laid end to end for many numbers at once."""

    def __init__(self, strings: list[bytes]):
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        return self.bytes[np.repeat(self.begins[numbers] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


def refined(coarse: np.ndarray, clean: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Token ends: the coarse cut where it is clean, else the last clean cut before it and the bytes decoded since."""
    if clean.all():
        return coarse
    total = np.cumsum(lengths)
    last = np.maximum.accumulate(np.where(clean, np.arange(len(clean)), -1))
    base = np.where(last >= 0, coarse[last] - total[last], 0)
    return np.where(clean, coarse, base + total)


class Spans(NamedTuple):
    ids: np.ndarray
    coarse: np.ndarray  # byte where each token ends, as the tokenizer tells it
    clean: np.ndarray  # the token shares no character with the next one


def joined(segments: list[str]) -> list[str]:
    return ["".join(some) for some in batched(segments, TOGETHER)]


def parted(items: Iterable, sizes: Iterable[int], most: int) -> Iterator[list]:
    """Runs of items: each ends with the item that brings its size to ``most``."""
    held, total = [], 0
    for item, size in zip(items, sizes):
        held.append(item)
        total += size
        if total >= most:
            yield held
            held, total = [], 0
    if held:
        yield held


class Segmented:
    """Encodes texts segment by segment, between places that no token can reach over.

    What the tokens of a segment are and where they end is worked out once per distinct segment and worker, many segments in
    one call. The table holds about ``REMEMBERED`` segments; when full it keeps those of the texts at hand, which costs time and changes nothing."""

    pieces: Strings

    def __init__(self):
        self.known: dict[str, bytes | None] = {}

    def segments(self, spaced: str) -> list[str]:
        raise NotImplementedError

    def spans(self, texts: list[str]) -> Spans:
        """Tokens of texts, each encoded by itself, laid end to end; byte ends count from the first one's begin. A text begins with a space."""
        raise NotImplementedError

    def tokens(self, texts: list[str]) -> Tokens | None:
        """Tokens of texts laid end to end; None where their bytes are not the texts'."""
        spans = self.spans(texts)
        if not np.array_equal(self.pieces.joined(spans.ids), np.frombuffer("".join(texts).encode(), np.uint8)):
            return None
        return Tokens(spans.ids, refined(spans.coarse, spans.clean, self.pieces.lengths[spans.ids]))

    def _learn(self, segments: list[str]) -> None:
        tokens = self.tokens(self.together(segments))
        if tokens is None:
            if len(segments) == 1:
                self.known[segments[0]] = None  # not given back byte for byte
                return
            half = len(segments) // 2
            self._learn(segments[:half])
            self._learn(segments[half:])
            return
        cuts = np.searchsorted(tokens.ends, np.cumsum([len(s.encode()) for s in segments]), "right") * 8
        packed = np.stack([tokens.ids, np.diff(tokens.ends, prepend=0)], 1).astype("<u4").tobytes()
        self.known.update((s, packed[low:high]) for s, low, high in zip(segments, [0, *cuts.tolist()], cuts.tolist()))

    def encode(self, spaced: list[str]) -> list[Tokens | None]:
        """Tokens of texts with the space before them; None where their bytes are not the text's."""
        parted = [self.segments(text) for text in spaced]
        now = set().union(*parted)
        if len(self.known) > REMEMBERED:  # what these texts have is likely to come again
            self.known = {s: self.known[s] for s in now.intersection(self.known)}
        new = now.difference(self.known)
        for some in self.kinds(new):
            if some:
                self._learn(some)
        out: list[Tokens | None] = []
        for segments in parted:
            try:
                found = b"".join(map(self.known.__getitem__, segments))
            except TypeError:  # one of them is None
                out.append(None)
                continue
            both = np.frombuffer(found, "<u4").reshape(-1, 2).astype(np.int64)
            out.append(Tokens(both[:, 0], np.cumsum(both[:, 1])))
        for segment in new:
            if len(segment) > REMEMBERED_LENGTH:
                del self.known[segment]
        return out

    def kinds(self, new: set[str]) -> tuple[list[str], ...]:
        raise NotImplementedError

    def together(self, segments: list[str]) -> list[str]:
        """Texts to encode for segments of one kind."""
        raise NotImplementedError


class ByteLevel(Segmented):
    """The byte-level tokenizer: tokens with character offsets. Its segments are the matches that it encodes one by one."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.segments = regex.compile(public_tokenizers.PATTERN).findall
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        value = self._byte_of()
        pieces: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for piece, number in vocab.items():
            pieces[number] = bytes(value[c] for c in piece)
        self.pieces = Strings(pieces)

    @staticmethod
    def _byte_of() -> dict[str, int]:
        """The byte that each character of the byte-level alphabet stands for: printable Latin-1 for itself, the others in order."""
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}

    def kinds(self, new: set[str]) -> tuple[list[str], ...]:
        """Matches of a space and something else can be encoded as one text, in which each is a match again."""
        spaced = [s for s in new if s[0] == " " and not s[1:2].isspace() and len(s) > 1]
        return spaced, list(new.difference(spaced))

    def together(self, segments: list[str]) -> list[str]:
        return joined(segments) if self.kinds({segments[0]})[0] else segments

    def spans(self, texts: list[str]) -> Spans:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        ids = np.array([k for f in found for k in f.ids], np.int64)
        offsets = chain.from_iterable(chain.from_iterable(f.offsets for f in found))
        begins, ends = np.fromiter(offsets, np.int64, 2 * len(ids)).reshape(-1, 2).T
        lengths = np.array([len(t) for t in texts], np.int64)
        before = np.repeat(np.cumsum(lengths) - lengths, [len(f) for f in found])  # characters of the texts before
        begins, ends = begins + before, ends + before
        clean = np.r_[begins[1:] >= ends[:-1], True][: len(ids)]
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        at = np.r_[np.flatnonzero((data & 0xC0) != 0x80), len(data)]  # byte where each character begins
        return Spans(ids, at[ends], clean)


class Pieces(Segmented):
    """The piece tokenizer with byte fallback: tokens with byte spans, after a space that it puts in front.

    If no piece has a space behind something else, as the vocabulary shows, no merge reaches over such a place, and texts are
    cut into segments there; else each is one segment. The library has replaced its immutable proto by an offset mapping with
    the same spans, which is read here."""

    def __init__(self, path: str):
        super().__init__()
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.processor.get_piece_size()
        self.fallback = np.array([self.processor.is_byte(k) for k in range(n)])
        names = [self.processor.id_to_piece(k) for k in range(n)]
        self.separable = not any(SPACE in name.lstrip(SPACE) for name in names)
        self.pieces = Strings([bytes([int(p[3:5], 16)]) if b else p.replace(SPACE, " ").encode() for p, b in zip(names, self.fallback)])
        self.lead = len(self.processor.encode("x"))

    def segments(self, spaced: str) -> list[str]:
        return SPACED.findall(spaced) if self.separable else [spaced]

    def kinds(self, new: set[str]) -> tuple[list[str], ...]:
        """Segments that end in something else than a space can be encoded as one text; of the others one by one."""
        closed = [s for s in new if self.separable and s[-1] not in (" ", SPACE)]
        return closed, *([s] for s in new.difference(closed))

    def together(self, segments: list[str]) -> list[str]:
        return joined(segments)

    def spans(self, texts: list[str]) -> Spans:
        # a last space is only seen behind something else
        skips = [self.lead if self.separable and not text.strip(" ") else 0 for text in texts]
        found = self.processor.encode(["x" + t if skip else t[1:] for t, skip in zip(texts, skips)], return_type="offset_mapping", return_bytes=True, num_threads=1)
        parts = [(f["ids"][skip:], f["offsets"][skip:]) if skip else (f["ids"], f["offsets"]) for f, skip in zip(found, skips)]
        ids = np.fromiter(chain.from_iterable(k for k, _ in parts), np.int64)
        ends = np.fromiter(map(itemgetter(1), chain.from_iterable(o for _, o in parts)), np.int64, len(ids))
        lengths = np.array([len(t.encode()) for t in texts], np.int64)
        before = np.cumsum(lengths) - lengths + np.where(skips, -1, 1)  # bytes of the texts before, and what is put in front
        return Spans(ids, ends + np.repeat(before, [len(k) for k, _ in parts]), ~self.fallback[ids])


class Aligned(NamedTuple):
    n_a: int
    n_b: int
    n_groups: int
    digest: str
    pairs: np.ndarray  # distinct linked pairs, a << 32 | b
    links: np.ndarray  # how many links each of them has


NOTHING = Aligned(0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and the sums of their links."""
    pairs = np.concatenate([p for p, _ in parts])
    order = np.argsort(pairs, kind="stable")
    pairs, links = pairs[order], np.concatenate([n for _, n in parts])[order]
    first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    return pairs[first], np.add.reduceat(links, first)


def _counted(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and how often each stands there."""
    pairs = np.sort(pairs)
    first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]][: len(pairs)])
    return pairs[first], np.diff(first, append=len(pairs))


def _pairs(a: np.ndarray, b: np.ndarray, times: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Pairs of each id of ``a`` with as many ids of ``b`` as ``times`` says, from ``begins`` on."""
    left = np.repeat(a << 32, times)
    return left | b[np.repeat(begins - np.cumsum(times) + times, times) + np.arange(len(left))]


class Word(NamedTuple):
    """What a distinct word of a run of texts adds to a text."""

    n_a: int
    n_b: int
    n_groups: int
    marked: bytes  # its part of the digest's text
    pairs: np.ndarray
    links: np.ndarray


LOST = (b"", b"")  # a word that is not given back byte for byte
LARGE = (b"\0" * 8, b"")  # a word of too many links to be remembered
FIELD = 21  # bits of each number of a remembered word's first item


class Aligner:
    def __init__(self, a: str, b: str):
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.known: dict[str, tuple[bytes, bytes]] = {}  # words of late, and those before them
        self.older: dict[str, tuple[bytes, bytes]] = {}
        self.n = max(len(self.a.pieces.lengths), len(self.b.pieces.lengths))
        # a token in the digest's text: with the mark before it that a group's first or later token has
        self.marked = Strings([mark + str(k).encode() for mark in (b";", b",", b"|") for k in range(self.n)])

    def groups(self, a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, int]:
        """The group of each token, and the number of groups."""
        cuts = np.intersect1d(a.ends, b.ends, assume_unique=True)
        return np.searchsorted(cuts, a.ends), np.searchsorted(cuts, b.ends), len(cuts)

    def marks(self, a: Tokens, b: Tokens, of_a: np.ndarray, of_b: np.ndarray, n: int) -> np.ndarray:
        """;a1,a2|b1;a3|b2,b3: the groups in order, the ids of each side in order, as numbers of marked ids."""
        per_a, per_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        out = np.empty(len(of_a) + len(of_b), np.int64)
        first_a, first_b = np.diff(of_a, prepend=-1) != 0, np.diff(of_b, prepend=-1) != 0
        out[np.arange(len(of_a)) + (np.cumsum(per_b) - per_b)[of_a]] = a.ids + np.where(first_a, 0, self.n)
        out[np.arange(len(of_b)) + np.cumsum(per_a)[of_b]] = b.ids + np.where(first_b, 2 * self.n, self.n)
        return out

    def linked(self, a: Tokens, b: Tokens, of_a: np.ndarray, of_b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct linked pairs and their links. Groups are taken in runs of about ``LINKS`` links; a group with more than
        that by itself is first reduced to its distinct ids, with how often each stands there."""
        per_a, per_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        ends_a, ends_b = np.cumsum(per_a), np.cumsum(per_b)
        at_b_of = ends_b - per_b
        total, parts, low = np.cumsum(per_a * per_b), [], 0
        while low < n:
            done = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, done + LINKS, "right")))
            at_a, at_b = ends_a[low] - per_a[low], ends_b[low] - per_b[low]
            if high == low + 1 and per_a[low] * per_b[low] > LINKS:
                ids_a, times_a = np.unique(a.ids[at_a : ends_a[low]], return_counts=True)
                ids_b, times_b = np.unique(b.ids[at_b : ends_b[low]], return_counts=True)
                for k in range(0, len(ids_a), max(1, LINKS // len(ids_b))):
                    some = slice(k, k + max(1, LINKS // len(ids_b)))
                    parts.append((((ids_a[some, None] << 32) | ids_b).ravel(), (times_a[some, None] * times_b).ravel()))
            else:
                some = slice(at_a, ends_a[high - 1])
                parts.append(_counted(_pairs(a.ids[some], b.ids, per_b[of_a[some]], at_b_of[of_a[some]])))
            low = high
        return parts[0] if len(parts) == 1 else _added(parts)

    def _learn(self, words: list[str]) -> None:
        """Remembers the alignments of words: numbers of tokens and groups in one item, then the linked pairs; and the part of the
        digest's text."""
        closed = [w for w in words if self.b.separable and w and not w[-1].isspace() and SPACE not in w]
        for some in (*map(list, batched(closed, LEARNT)), *([w] for w in set(words).difference(closed))):
            self._learn_kind(some)

    def _learn_kind(self, words: list[str]) -> None:
        segments = [" " + w for w in words]
        texts, ends = joined(segments), np.cumsum([len(s.encode()) for s in segments])
        a, b = self.a.tokens(texts), self.b.tokens(texts)
        if a is None or b is None:
            if len(words) == 1:
                self.known[words[0]] = LOST
                return
            half = len(words) // 2
            self._learn_kind(words[:half])
            self._learn_kind(words[half:])
            return
        of_a, of_b, n = self.groups(a, b)
        word = np.searchsorted(ends, np.intersect1d(a.ends, b.ends, assume_unique=True))  # of each group
        links = np.bincount(of_a, minlength=n) * np.bincount(of_b, minlength=n)
        light = np.bincount(word, links, len(words)) <= REMEMBERED_LINKS
        if not light.all():
            self.known.update((w, LARGE) for w, few in zip(words, light.tolist()) if not few)
            a, b = (Tokens(x.ids[some], x.ends[some]) for x, some in ((a, light[word[of_a]]), (b, light[word[of_b]])))
            words, ends = [w for w, few in zip(words, light.tolist()) if few], ends[light]
            of_a, of_b, n = self.groups(a, b)
        per_b = np.bincount(of_b, minlength=n)
        times = per_b[of_a]
        pairs = _pairs(a.ids, b.ids, times, (np.cumsum(per_b) - per_b)[of_a])
        marks = self.marks(a, b, of_a, of_b, n)
        text = self.marked.joined(marks).tobytes()
        # tokens, groups, links and bytes of the words before each word and before the end
        n_a, n_b = (np.r_[0, np.searchsorted(x.ends, ends, "right")] for x in (a, b))
        n_groups = np.r_[0, of_a[n_a[1:] - 1] + 1]
        n_links = np.r_[0, np.cumsum(times)][n_a]
        at = np.r_[0, np.cumsum(self.marked.lengths[marks])][n_a + n_b].tolist()
        first = np.diff(n_a) | np.diff(n_b) << FIELD | np.diff(n_groups) << 2 * FIELD
        items = np.insert(pairs, n_links[:-1], first).astype("<i8").tobytes()
        begins = ((n_links + np.arange(len(n_links))) * 8).tolist()
        self.known.update((w, (items[i:j], text[k:m])) for w, i, j, k, m in zip(words, begins, begins[1:], at, at[1:]))

    def words(self, distinct: list[str]) -> tuple[list[tuple[bytes, bytes]], dict[int, Word]]:
        """The remembered alignments of words, and by number those of the others."""
        found = list(map(self.known.get, distinct))
        new = []
        for k in [k for k, f in enumerate(found) if f is None]:
            word = distinct[k]
            if len(word) > REMEMBERED_LENGTH:
                found[k] = LARGE
            elif (before := self.older.get(word)) is not None:
                found[k] = self.known[word] = before
            else:
                new.append(k)
        self._learn([distinct[k] for k in new])
        for k in new:
            found[k] = self.known[distinct[k]]
        if len(self.known) > REMEMBERED:  # words that do not come again before the next time are forgotten then
            self.known, self.older = {}, self.known
        large = [k for k, f in enumerate(found) if f is LARGE]
        others = {}
        for some in parted(large, [len(distinct[k]) for k in large], LARGE_RUN):
            spaced = [" " + distinct[k] for k in some]
            for k, a, b in zip(some, self.a.encode(spaced), self.b.encode(spaced)):
                if a is None or b is None:
                    found[k] = LOST
                    continue
                of_a, of_b, n = self.groups(a, b)
                marked = self.marked.joined(self.marks(a, b, of_a, of_b, n)).tobytes()
                others[k] = Word(len(a.ids), len(b.ids), n, marked, *self.linked(a, b, of_a, of_b, n))
        return found, others

    def __call__(self, text: str) -> Aligned:
        return next(self.each([text]))

    def each(self, texts: Iterable[str]) -> Iterator[Aligned]:
        """Alignments of texts, which are taken ``RUN`` code points and more at once, or an eighth of that where words are long."""
        texts = list(texts)
        for held in parted(texts, (len(text) * (1 if text.count(" ") * 16 >= len(text) else 8) for text in texts), RUN):
            yield from self._all(held)

    def _all(self, texts: list[str]) -> Iterator[Aligned]:
        found = self._some([text for text in texts if text])
        for text in texts:
            yield next(found) if text else NOTHING

    def _some(self, texts: list[str]) -> Iterator[Aligned]:
        def coded(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
            words = lists.flatten().dictionary_encode()
            return lists.offsets.to_numpy(), words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()

        cuts, codes, distinct = coded(pc.split_pattern(pa.array(texts, pa.large_string()), " "))
        if not self.b.separable:
            cuts, codes, distinct = coded(pa.array([[text] for text in texts], pa.list_(pa.large_string())))
        elif any(not word or word[-1].isspace() for word in distinct):  # not every space is a cut
            cuts, codes, distinct = coded(pa.array(map(CUT.split, texts), pa.list_(pa.large_string())))
        found, others = self.words(distinct)

        items = np.frombuffer(b"".join(f[0] for f in found), "<i8")
        lengths = np.array([len(f[0]) >> 3 for f in found], np.int64)
        begins = np.cumsum(lengths) - lengths
        lost, sizes = lengths == 0, np.maximum(lengths - 1, 0)
        any_lost = lost.any()
        first = np.zeros(len(found), np.int64)
        first[~lost] = items[begins[~lost]]
        counts = np.stack([first >> shift & (1 << FIELD) - 1 for shift in (0, FIELD, 2 * FIELD)], 1)
        marked = [f[1] for f in found]
        other = np.zeros(len(found), bool)
        for k, word in others.items():
            counts[k], marked[k], other[k] = word[:3], word.marked, True
        marked = pa.array(marked, pa.large_binary()).take(pa.array(codes))
        ends, data = np.frombuffer(marked.buffers()[1], np.int64), memoryview(marked.buffers()[2] or b"")

        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            own = codes[low:high]
            if any_lost and lost[own].any():
                yield NOTHING
                continue
            total = np.cumsum(sizes[own])
            parts, done = [], 0
            while done < len(own):  # some ``LINKS`` links at once
                until = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + LINKS, "right")))
                some = own[done:until]
                n = sizes[some]
                parts.append(_counted(items[np.repeat(begins[some] + 1 - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]))
                done = until
            if others:
                large, times = np.unique(own[other[own]], return_counts=True)
                parts += [(others[k].pairs, others[k].links * m) for k, m in zip(large.tolist(), times.tolist())]
            digest = hashlib.sha256(data[ends[low] + 1 : ends[high]]).hexdigest()
            yield Aligned(*counts[own].sum(0).tolist(), digest, *(parts[0] if len(parts) == 1 else _added(parts)))


@functools.lru_cache(maxsize=2)
def aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


BLOCK = "block long, doc_ids array<long>, counts binary, digests array<string>, pairs binary, docs binary, sizes binary, codes binary, links binary"


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on as the byte planes that they need, compressed: high bytes are mostly zero. The first byte is their number."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or numbers.max(initial=0) < 1 << 8 * w)
    planes = np.ascontiguousarray(numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    raw, width = np.frombuffer(zstandard.ZstdDecompressor().decompress(memoryview(data)[1:]), np.uint8), data[0]
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(f"<u{width}").ravel().astype(np.int64)


class _Block:
    def __init__(self):
        self.ids: list = []
        self.found: list[Aligned] = []
        self.bytes = 0

    def add(self, doc_id: int | None, found: Aligned, size: int) -> None:
        self.ids.append(doc_id)
        self.found.append(found)
        self.bytes += size

    def row(self, number: int) -> pa.RecordBatch:
        coded = pa.array(np.concatenate([f.pairs for f in self.found])).dictionary_encode()
        pairs = coded.dictionary.to_numpy()
        order = np.argsort(pairs)
        codes, pairs = np.argsort(order)[coded.indices.to_numpy()], pairs[order]
        counts = np.array([(f.n_a, f.n_b, f.n_groups, f.links.sum()) for f in self.found], np.int64)
        columns = {
            "block": pa.array([number], pa.int64()),
            "doc_ids": pa.array([self.ids], pa.list_(pa.int64())),
            "counts": pa.array([_packed(counts.ravel())], pa.binary()),
            "digests": pa.array([[f.digest for f in self.found]], pa.list_(pa.string())),
            "pairs": pa.array([_packed(pairs)], pa.binary()),
            "docs": pa.array([_packed(np.bincount(codes, minlength=len(pairs)))], pa.binary()),
            "sizes": pa.array([_packed(np.array([len(f.pairs) for f in self.found]))], pa.binary()),
            "codes": pa.array([_packed(codes)], pa.binary()),
            "links": pa.array([_packed(np.concatenate([f.links for f in self.found]))], pa.binary()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def aligned_blocks(docs: DataFrame, a: str, b: str) -> DataFrame:
    """The written table of blocks, bucketed by block: documents' token, group and link numbers, and their linked pairs as codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(a, b)
        number = TaskContext.get().partitionId() << 32
        block = _Block()
        for batch in batches:
            texts = as_texts(batch.column(1))
            for doc_id, text, found in zip(batch.column(0).to_pylist(), texts, align.each(texts)):
                block.add(doc_id, found, len(text.encode()) + 256)
                if block.bytes >= BLOCK_BYTES:
                    yield block.row(number)
                    number, block = number + 1, _Block()
        if block.ids:
            yield block.row(number)

    return bucketed(texts(docs).mapInArrow(run, BLOCK), "block", "aligned_blocks")


def block_pairs(blocks: DataFrame) -> DataFrame:
    """(home, code, a, b, docs): each block's distinct pairs, and how many of its documents have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, docs in zip(*(batch.column(k).to_pylist() for k in range(3))):
                pairs, docs = _unpacked(pairs), _unpacked(docs)
                for low in range(0, len(pairs), ROWS):
                    some = pairs[low : low + ROWS]
                    arrays = [np.full(len(some), block), np.arange(low, low + len(some), dtype=np.int32), (some >> 32).astype(np.int32), (some & 0xFFFFFFFF).astype(np.int32), docs[low : low + ROWS]]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["home", "code", "a", "b", "docs"])

    return blocks.select("block", "pairs", "docs").mapInArrow(run, "home long, code int, a int, b int, docs long")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, docs, best): in how many documents the pair is linked, and whether no pair of the same ``a`` is in more."""
    counts = staged(block_pairs(blocks).groupBy("a", "b").agg(F.sum("docs").alias("docs")), "pair_counts")
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))  # at most one row per id of the vocabulary file
    return counts.join(F.broadcast(most), "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best"))


RESULT = {
    **{name: pa.int64() for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")},
    "groups_sha256": pa.string(),
}


def alignments(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Per document its tokens, groups and links, the links to the partner that the id has most often, and the links' counts."""
    blocks = aligned_blocks(docs, a, b)
    told = block_pairs(blocks).drop("docs").hint("merge").join(pair_counts(blocks).hint("merge"), ["a", "b"]).select("home", "code", "docs", "best")

    def run(block: pa.Table, facts: pa.Table) -> pa.Table:
        row = block.slice(0, 1).to_pylist()[0]
        codes, links, sizes = _unpacked(row["codes"]), _unpacked(row["links"]), _unpacked(row["sizes"])
        at = facts.column("code").to_numpy()
        docs, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        docs[at], best[at] = facts.column("docs").to_numpy(), facts.column("best").to_numpy()
        of = np.repeat(np.arange(len(sizes)), sizes)
        total = np.zeros((2, len(sizes)), np.int64)
        np.add.at(total[0], of, links * best[codes])
        np.add.at(total[1], of, links * docs[codes])
        counts = _unpacked(row["counts"]).reshape(-1, 4).T
        columns = [pa.array(row["doc_ids"], pa.int64()), *map(pa.array, counts), *map(pa.array, total), pa.array(row["digests"], pa.string())]
        return pa.Table.from_arrays(columns, schema=pa.schema(list(RESULT.items())))

    kept = blocks.drop("pairs", "docs")
    return kept.groupBy("block").cogroup(told.groupBy("home")).applyInArrow(run, ", ".join(f"{n} {'string' if k == pa.string() else 'long'}" for n, k in RESULT.items()))


def links(docs: DataFrame, a: str, b: str) -> DataFrame:
    """(doc_id, a, b, links): the linked id pairs of every document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = list(aligner(a, b).each(as_texts(batch.column(1))))
        sizes = [len(f.pairs) for f in found]
        pairs = np.concatenate([f.pairs for f in found])
        arrays = [batch.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes))), pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), pa.array(np.concatenate([f.links for f in found]))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "a", "b", "links"])

    return map_batches(texts(docs), run, "doc_id long, a int, b int, links long")


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    return alignments(table(spark, sf_dir, "documents"), *tokenizer_files())
