"""Rank queue, token alignment and prefix trie against brute force, on small tables with nulls, empties, ties and repeated rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from polarscan.llm import alignment, prefix_trie, rank_queue

BITS = ["a", "aa", "ab", " ", "  ", "\n", "\t", "é", "日", "1", "12", "!", "'s", "'S", "　", "😀", "𝔘", "the", "ing", "\x00", "\r\n", "é", "<|endoftext|>", "</s>", "<0x0A>"]
SHA_EMPTY = hashlib.sha256(b"").hexdigest()


def mixtures(n, more=(), longest=50):
    draw = random.Random(7)
    return ["".join(draw.choice(BITS + list(more)) for _ in range(draw.randint(0, longest))) for _ in range(n)]


def sample_texts():
    return [None, "", " ", "\n\n", "same text", "same text", "x" * 3000, "ab" * 40_000, "z ▁ z", *mixtures(60, ["▁"])]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", 1.0) for i, t in enumerate(sample_texts())]
    return spark.createDataFrame([*rows, rows[4], (None, "null id", "clash", 1.0)], "doc_id long, text string, ids string, block double").repartition(3)


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = rank_queue.coder(rank_queue.rank_file(), rank_queue.pattern()).ranks
    return tiktoken.Encoding("test", pat_str=rank_queue.pattern(), mergeable_ranks=ranks, special_tokens={})


def test_rank_queue_equals_the_library(library, monkeypatch):
    coder = rank_queue.coder(rank_queue.rank_file(), rank_queue.pattern())
    draw = random.Random(3)
    long = "ab" * 5000 + "".join(draw.choice("abcdefgh") for _ in range(20_000)) + "é" * 3000
    for text in [*mixtures(1500), long, " " * 5000 + "x", ("word " * 30_000)]:
        assert coder.encode(text).tolist() == library.encode_ordinary(text)
        assert coder.decode(coder.encode(text)) == text.encode()
    monkeypatch.setattr(rank_queue, "RUN", 3)
    for text in mixtures(1500):
        assert coder.encode(text).tolist() == library.encode_ordinary(text)
    assert not any(coder.words) and not any(coder.buckets)  # the queue is empty between pre-tokens


def test_rank_queue_on_ranks_that_merge_out_of_order():
    """A pair that arises late can have a lower rank than those before it, to the left of entries of the same bucket."""
    draw = random.Random(11)
    for _ in range(30):
        words = {"".join(draw.choice("abc") for _ in range(draw.randint(2, 5))).encode() for _ in range(25)}
        order = list(words)
        draw.shuffle(order)
        ranks = {bytes([b]): b for b in range(256)} | {w: 256 + k for k, w in enumerate(order)}
        coder = rank_queue.RankCoder(ranks, r"(?s).+")
        pieces, want = [], []
        for _ in range(60):
            piece = "".join(draw.choice("abc") for _ in range(draw.randint(1, 40))).encode()
            parts = [bytes([b]) for b in piece]
            while len(parts) > 1:
                rank, at = min((ranks.get(x + y, 10**9), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))
                if rank == 10**9:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            pieces.append(piece)
            want.append([ranks[p] for p in parts])
        assert [ids.tolist() for ids in coder.merged(pieces)] == want
        assert [ids.tolist() for piece in pieces for ids in coder.merged([piece])] == want
        assert not any(coder.words) and not any(coder.buckets)


def test_rank_queue_rejects_bad_input():
    with pytest.raises(ValueError, match="single bytes"):
        rank_queue.RankCoder({b"a": 0}, r".+")
    with pytest.raises(ValueError, match="unknown id"):
        rank_queue.coder(rank_queue.rank_file(), rank_queue.pattern()).decode(np.array([10**6]))


def test_rank_queue_rows(spark, docs, library):
    path, split = rank_queue.rank_file(), rank_queue.pattern()
    ids = rank_queue.encoded(docs, path, split)
    want = collections.Counter()
    for i, text in [*enumerate(sample_texts()), (4, "same text"), (None, "null id")]:
        found = library.encode_ordinary(text or "")
        decimals = " ".join(map(str, found)).encode()
        want[i, len(found), hashlib.sha256(decimals).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert collections.Counter(map(tuple, rank_queue.digests(ids, path, split).collect())) == want
    texts = {r.doc_id: bytes(r.content).decode() for r in rank_queue.decoded(ids, path, split).collect()}
    assert all(texts[i] == (t or "") for i, t in enumerate(sample_texts()))
    assert rank_queue.digests(rank_queue.encoded(docs.limit(0), path, split), path, split).count() == 0


def groups_of(text):
    """Token by token: the groups of one text, or None if it has no tokens."""
    a, b = alignment.tokenizer_files()
    aligner = alignment.aligner(a, b)
    if not text:
        return None
    piece = lambda side, k: side.pieces.joined(np.array([k])).tobytes()
    left = aligner.a.tokenizer.encode(" " + text, add_special_tokens=False).ids
    right = aligner.b.processor.encode(text)
    both = [[(k, piece(side, k)) for k in ids] for side, ids in ((aligner.a, left), (aligner.b, right))]
    if any(b"".join(p for _, p in tokens) != (" " + text).encode() for tokens in both):
        return None
    cuts = []
    for tokens in both:
        end, ends = 0, {}
        for at, (_, p) in enumerate(tokens):
            end += len(p)
            ends[end] = at + 1
        cuts.append(ends)
    shared = sorted(set(cuts[0]) & set(cuts[1]))
    groups, i, j = [], 0, 0
    for end in shared:
        groups.append((left[i : cuts[0][end]], right[j : cuts[1][end]]))
        i, j = cuts[0][end], cuts[1][end]
    return groups


def digest_of(groups):
    return hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups).encode()).hexdigest()


@pytest.mark.parametrize("links", [1 << 20, 5])
def test_alignment_equals_token_by_token(links, monkeypatch):
    monkeypatch.setattr(alignment, "LINKS", links)
    aligner = alignment.aligner(*alignment.tokenizer_files())
    for text in ["", "a 𝔘𝔘b", *mixtures(600, ["▁"], 25), *mixtures(300)]:
        groups, found = groups_of(text), aligner(text)
        if groups is None:
            assert found is alignment.NOTHING
            continue
        want = collections.Counter((x << 32) | y for left, right in groups for x in left for y in right)
        assert found.digest == digest_of(groups) and found.n_groups == len(groups)
        assert dict(zip(found.pairs.tolist(), found.links.tolist())) == dict(want)


@pytest.mark.parametrize("block_bytes", [16 << 20, 300])
def test_alignment_rows(docs, monkeypatch, block_bytes):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block_bytes)
    rows = [*enumerate(sample_texts()), (4, "same text"), (None, "null id")]
    grouped = [groups_of(t) or [] for _, t in rows]
    each = [collections.Counter((x, y) for left, right in g for x in left for y in right) for g in grouped]
    docs_with = collections.Counter(pair for links in each for pair in links)
    most = {}
    for (x, _), n in docs_with.items():
        most[x] = max(most.get(x, 0), n)
    want = collections.Counter()
    for (i, _), g, links in zip(rows, grouped, each):
        best = sum(n for p, n in links.items() if docs_with[p] == most[p[0]])
        count_sum = sum(n * docs_with[p] for p, n in links.items())
        sizes = [sum(len(side[k]) for side in g) for k in (0, 1)]
        want[i, *sizes, len(g), links.total(), best, count_sum, digest_of(g) if g else ""] += 1
    files = alignment.tokenizer_files()
    found = alignment.alignments(docs, *files)
    assert found.columns == list(alignment.RESULT)
    assert collections.Counter(map(tuple, found.collect())) == want
    per_doc = collections.Counter()
    for r in alignment.links(docs, *files).where("doc_id is null").collect():
        per_doc[r.a, r.b] += r.links
    assert per_doc == each[-1]
    assert alignment.alignments(docs.limit(0), *files).count() == 0


def brute_trie(rows):
    """Nodes of the trie, from whole sequences."""
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0, tie), role, text))
    own = {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    words = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text))
    children = collections.Counter(node[:-1] for node in members if node)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(convs) - 1) * words(node[-1][1]) if node else 0
    out = collections.Counter()
    for node, convs in members.items():
        ends = sorted(c for c in convs if whole[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out[min(convs), len(node), parent, len(convs), children[node], leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()] += 1
    return out


def conversation_rows():
    draw = random.Random(5)
    says = ["yes", "no", "why not", "", " tell\tme \n more ", None, "one two three"]
    rows = []
    for conv in [c for c in range(0, 65) if c not in (20, 33)]:
        for turn in range(draw.choice([1, 1, 2, 3, 5, 9])):
            rows.append((conv, turn, draw.choice(["user", "assistant", None]), draw.choice(says[: 2 + turn])))
    rows += [(7, None, "user", "null turn first"), (8, 1, "user", "tie"), (8, 1, "user", "tie"), (8, 1, "user", "other"), (None, 1, "user", "no conversation")]
    rows += [(200 + k, t, "user", "yes") for k in range(30) for t in range(3)]  # copies
    rows += [(300, t, "user", "deep") for t in range(70)] + [(301, t, "user", "deep") for t in range(45)] + [(-5, 0, "user", "yes")]
    return rows


@pytest.mark.parametrize("band, piece, text", [(16, 4096, 1 << 20), (2, 8, 3), (4, 16, 1)])
def test_trie_equals_brute_force(spark, monkeypatch, band, piece, text):
    monkeypatch.setattr(prefix_trie, "BAND", band)
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    monkeypatch.setattr(prefix_trie, "TEXT", text)
    rows = conversation_rows()
    if band == 16:  # one conversation with most of the rows, over several pieces
        rows += [(400, t, "user", f"t{t % 7}") for t in range(9000)]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, d string, k1 int").repartition(4)
    found = collections.Counter(map(tuple, prefix_trie.trie(frame).collect()))
    if band == 16:
        chain = [r for r in found if r[0] == 400]
        assert {r[1] for r in chain} == set(range(min(r[1] for r in chain), max(r[1] for r in chain) + 1))
        assert all(r[5] == 1 and r[6] == 0 for r in chain)
        found = collections.Counter({r: n for r, n in found.items() if r[0] != 400 and r[1] > 0})
        want = brute_trie(conversation_rows())
        assert found == collections.Counter({r: n for r, n in want.items() if r[1] > 0})
    else:
        assert found == brute_trie(rows)


def test_trie_of_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "user", "x")], schema)).count() == 0
    # conversation 1 takes its head from conversation 0, which is absent, and has no turns beyond it
    alone = prefix_trie.trie(spark.createDataFrame([(2, 0, "user", "x")], schema)).collect()
    h = zlib.crc32(b"2") % 4
    assert len(alone) == (2 if h == 0 else 1) and alone[0].ends_sha256 in (SHA_EMPTY, hashlib.sha256(b"2").hexdigest())


def test_stages_keep_columns_of_any_name(spark):
    from polarscan.llm import secrets, simhash

    text = 'password = "abcdefgh1234" and more words'
    rows = [(1, text, "d", "a", 5, "q", 1, "r"), (2, text, "d2", "a2", 6, "q2", 2, "r2"), (None, None, None, None, None, None, None, None)]
    names = "doc_id long, text string, digest string, added string, a_doc_id long, a_digest string, row_number long, own string"
    frame = spark.createDataFrame(rows, names)
    redacted = sorted(map(tuple, secrets.redact(frame).collect()), key=repr)
    assert redacted == sorted([(r[0], r[1] and r[1].replace("abcdefgh1234", "[SECRET]"), *r[2:]) for r in rows], key=repr)
    kept = simhash.keep_first(frame)
    assert kept.columns == frame.columns and sorted(map(tuple, kept.collect()), key=repr) == sorted([rows[0], rows[2]], key=repr)
    assert secrets.redact(frame.limit(0)).count() == 0 and simhash.keep_first(frame.limit(0)).count() == 0


def test_full_table_keeps_the_segments_at_hand(monkeypatch):
    import public_tokenizers
    from polarscan.llm import alignment

    aligner = alignment.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["the same words come again", "some other words", "the same words été ▁ again"]
    wanted = [tuple(map(repr, x)) for x in aligner.each(texts)]
    monkeypatch.setattr(alignment, "REMEMBERED", 1)
    aligner.a.encode([" never seen before"])
    learned = []
    learn = aligner.a._learn
    monkeypatch.setattr(aligner.a, "_learn", lambda segments: learned.extend(segments) or learn(segments))
    aligner.a.encode([" never seen before"])
    assert learned == []  # the table was full, but its words stayed
    assert [tuple(map(repr, x)) for x in aligner.each(texts)] == wanted


def test_texts_of_known_words_are_not_aligned_again(monkeypatch):
    aligner = alignment.Aligner(*alignment.tokenizer_files())
    list(aligner.each(["some words, twice: some\nlines été", "other words"]))
    monkeypatch.setattr(aligner, "groups", None)  # a call of it would fail
    text = "other words, some words, twice: other été some\nlines"
    found, groups = aligner(text), groups_of(text)
    assert found.digest == digest_of(groups) and found.n_groups == len(groups)
    want = collections.Counter((x << 32) | y for left, right in groups for x in left for y in right)
    assert dict(zip(found.pairs.tolist(), found.links.tolist())) == dict(want)


@pytest.mark.parametrize("run", [1, 400, 1 << 22])
def test_alignment_by_words_equals_token_by_token(run, monkeypatch):
    """Words that are long, have many links, end in white space or are not given back, in runs of one and of many texts."""
    for name, value in {"RUN": run, "REMEMBERED": 20, "LARGE_RUN": 40, "REMEMBERED_LENGTH": 12, "REMEMBERED_LINKS": 6, "LEARNT": 5, "TOGETHER": 2}.items():
        monkeypatch.setattr(alignment, name, value)
    aligner = alignment.Aligner(*alignment.tokenizer_files())
    texts = [*mixtures(300, [" ", "\n", " word", "x" * 30, "😀" * 9, "\x1c ", "　"], 25), *mixtures(200, ["▁", " "], 10), " ", "a ", " a", "a  b ", "", "▁", "a ▁ b"]
    for text, found in zip(texts, aligner.each(texts), strict=True):
        groups = groups_of(text)
        if groups is None:
            assert found is alignment.NOTHING
            continue
        want = collections.Counter((x << 32) | y for left, right in groups for x in left for y in right)
        sizes = [sum(len(side[k]) for side in groups) for k in (0, 1)]
        assert [found.n_a, found.n_b] == sizes and found.digest == digest_of(groups) and found.n_groups == len(groups)
        assert dict(zip(found.pairs.tolist(), found.links.tolist())) == dict(want)


def test_packed_numbers_come_back():
    for top in (0, 1, 255, 256, 65535, 65536, (1 << 32) - 1, 1 << 32, (1 << 62) + 5):
        numbers = np.array([0, top, top // 2], np.int64)
        assert alignment._unpacked(alignment._packed(numbers)).tolist() == numbers.tolist()
    assert alignment._unpacked(alignment._packed(np.empty(0, np.int64))).tolist() == []
