"""Prefix trie of conversations, with subtree totals by a rollup over bands of depth.

A node is a distinct sequence of first turns. Its key is the exclusive or of 128-bit hashes of (position, turn), which can be
summed up over pieces of a conversation, so a conversation of any length is keyed piece by piece. A node knows its parent's band:
the keys from the band's root to the parent, ``BAND`` at most. A total then rises in two steps. Within a band of ``BAND`` depths
every node is added to its band's root; the roots of all bands are a trie of a ``BAND``-th of the depth, whose totals come from
the same procedure. With them complete, every node is added to its ancestors inside its band, and every band root, with its
complete total, to those inside the band above. So a node is exploded to fewer than ``BAND`` rows twice at most, and the number
of rounds is the logarithm of the greatest depth to the base ``BAND``.

Turns are ordered in ranges, whose counts carry over, and worked on in pieces of ``PIECE`` depths; sums combine before
they are shuffled. So neither a turn, a node nor a conversation that a third of all rows have makes a task of its own. The ids
that end in a node are joined to long texts range by range before one task per node hashes these, as they come.

Defined results: null roles and texts are empty; a null turn stands first; equal turn numbers are ordered by the digest of role
and text, and repeated rows stay rows; rows without conv_id belong to no conversation; without conversations there is no root.
Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, staged, table

FAMILY = 20  # conversations that share the head of the first of them
HEADS = 4  # a head has fewer turns than this
BAND = 16
PIECE = 4096  # a power of BAND
TEXT = 1 << 20  # bytes of ids that are joined to one row


def turns(conversations: DataFrame) -> DataFrame:
    """(part, conv_id, local, x1, x2, words): the turns in order; ``local`` counts a conversation's turns within a range."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("copy"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("copy")]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            begins = np.flatnonzero(np.r_[ids[0] != conv, ids[1:] != ids[:-1]])
            base = np.zeros(len(ids), np.int64)
            base[begins] = begins
            base = np.maximum.accumulate(base)
            local = np.arange(len(ids)) - base + 1
            local[: begins[0] if len(begins) else len(ids)] += seen
            conv, seen = ids[-1], int(local[-1])
            digests = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i8").reshape(-1, 2)
            columns = [np.full(len(ids), part, np.int64), ids, local, digests[:, 0].copy(), digests[:, 1].copy(), batch.column(2).to_numpy()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "conv_id", "local", "x1", "x2", "words"])

    ranges = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    sorted_rows = ranges.select("conv_id", "digest", "words").mapInArrow(number, "part long, conv_id long, local long, x1 long, x2 long, words long")
    return staged(sorted_rows, "turns")


def placed(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with ``pos`` in their conversation, from 1; and (conv_id, n). A range continues one conversation at most, so what
    is broadcast has at most one row per range."""
    counts = staged(turns.groupBy("part", "conv_id").agg(F.max("local").alias("n")), "turn_counts")
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    carried = counts.withColumn("before", before).where("before is not null").select("part", "conv_id", "before")
    rows = turns.join(F.broadcast(carried), ["part", "conv_id"], "left")
    rows = rows.select("conv_id", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "x1", "x2", "words")
    return rows, counts.groupBy("conv_id").agg(F.sum("n").alias("n"))


def head_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, d, x1, x2, words, last): the turns of the rebuilt conversations by depth, with a row for depth 0."""
    rows, sizes = placed(turns)
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    known = sizes.select("conv_id", "n", head_turns(F.col("conv_id")).alias("h"), base.alias("base"))
    given = sizes.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("given"))
    known = known.join(given.hint("merge"), "base", "left").withColumn("m", F.least("h", F.coalesce("given", F.lit(0))))
    known = staged(known.select("conv_id", "base", "n", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")), "heads")

    first = rows.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS)).withColumnRenamed("conv_id", "base")
    heads = known.where("h > 0").join(first.hint("merge"), "base").where("pos <= h")
    pieces = known.withColumn("piece", F.explode(F.sequence(F.lit(0), (F.col("n") / PIECE).cast("long"))))
    own = rows.withColumn("piece", (F.col("pos") / PIECE).cast("long")).join(pieces.hint("merge"), ["conv_id", "piece"]).where("pos > h")
    none = F.lit(0).cast("long")
    columns = lambda d, *rest: ["conv_id", d.cast("long").alias("d"), *rest, (d == F.col("size")).alias("last")]
    return (
        heads.select(*columns(F.col("pos"), "x1", "x2", "words"))
        .unionAll(own.select(*columns(F.col("pos") - F.col("h") + F.col("m"), "x1", "x2", "words")))
        .unionAll(known.select(*columns(none, none.alias("x1"), none.alias("x2"), none.alias("words"))))
    )


def keyed(turns: DataFrame) -> DataFrame:
    """(conv_id, d, words, last, k1, k2, p1, p2): every turn of every conversation with its node's and its parent's key."""
    piece = (F.col("d") / PIECE).cast("long").alias("piece")
    hashes = [F.when(F.col("d") > 0, F.xxhash64(F.lit(seed), "d", "x1", "x2")).otherwise(0).alias(f"c{seed}") for seed in (1, 2)]
    rows = turns.select("conv_id", "d", "words", "last", piece, *hashes)
    so_far = Window.partitionBy("conv_id", "piece").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[F.bit_xor(f"c{k}").over(so_far).alias(f"r{k}") for k in (1, 2)])
    rows = staged(rows, "turn_keys")
    ends = rows.where((F.col("d") % PIECE == PIECE - 1) & ~F.col("last"))  # the last turn of a piece holds its total
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, 0)
    carried = ends.select("conv_id", (F.col("piece") + 1).alias("piece"), *[F.bit_xor(f"r{k}").over(before).alias(f"b{k}") for k in (1, 2)])
    rows = rows.join(carried.hint("merge"), ["conv_id", "piece"], "left")
    key = [F.col(f"r{k}").bitwiseXOR(F.coalesce(f"b{k}", F.lit(0))) for k in (1, 2)]
    parent = [F.when(F.col("d") > 0, key[k - 1].bitwiseXOR(F.col(f"c{k}"))) for k in (1, 2)]
    named = [c.alias(n) for c, n in zip([*key, *parent], ("k1", "k2", "p1", "p2"))]
    return staged(rows.select("conv_id", "d", "words", "last", *named), "paths")


def with_bands(paths: DataFrame, stride: int) -> DataFrame:
    """Turns at multiples of ``stride`` with ``up``: the keys at such depths from the root of the parent's band to the parent."""
    wide = PIECE * stride
    rows = paths.where(F.col("d") % stride == 0)
    # a turn where a piece begins is looked up in its own piece, and finds its parents in the one before
    pieces = F.when((F.col("d") % wide == 0) & (F.col("d") > 0), F.array(F.lit(-1), F.lit(0))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("shift", F.explode(pieces)).withColumn("piece", (F.col("d") / wide).cast("long") + F.col("shift"))
    window = Window.partitionBy("conv_id", "piece").orderBy("d").rowsBetween(-BAND, -1)
    length = (F.pmod((F.col("d") / stride).cast("long") - 1, F.lit(BAND)) + 1).cast("int")
    found = F.collect_list(F.struct("k1", "k2")).over(window)
    rows = rows.withColumn("found", found).where((F.col("shift") == -1) | (F.col("d") % wide != 0) | (F.col("d") == 0))
    up = F.when(F.col("d") > 0, F.slice("found", -length, length)).otherwise(F.expr("cast(array() as array<struct<k1:bigint,k2:bigint>>)"))
    return rows.drop("shift", "piece").withColumn("up", up).drop("found")


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("k1", "k2").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def totals(paths: DataFrame, nodes: DataFrame, deepest: int, stride: int = 1) -> DataFrame:
    """(k1, k2, leaves, saved) over the subtree of every node at a multiple of ``stride``. ``nodes`` has these with d, up and
    what they bring themselves: everything between them and the next such nodes below."""
    wide = stride * BAND
    root = F.col("d") % wide == 0
    to_root = [F.when(root, F.col(k)).otherwise(F.col("up")[0][k]).alias(k) for k in ("k1", "k2")]
    bands = summed(nodes.select(*to_root, "leaves", "saved"))
    if deepest < wide:
        done = staged(bands, "root_total")
    else:
        above = with_bands(paths, wide).select("d", "k1", "k2", "up").distinct()
        above = staged(above.join(bands.hint("merge"), ["k1", "k2"]), "band_roots")
        done = staged(totals(paths, above, deepest, wide), "band_totals")
    inside = F.slice("up", 2, BAND)
    within = nodes.where(~root).select(F.explode(F.concat(F.array(F.struct("k1", "k2")), inside)).alias("k"), "leaves", "saved")
    rows = within.select("k.k1", "k.k2", "leaves", "saved")
    if deepest >= wide:
        down = nodes.where(root).select("k1", "k2", "up").join(done.hint("merge"), ["k1", "k2"])
        rows = rows.unionAll(down.select(F.explode(inside).alias("k"), "leaves", "saved").select("k.k1", "k.k2", "leaves", "saved"))
    return summed(rows).unionAll(done.select("k1", "k2", "leaves", "saved"))


def end_digests(paths: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of the nodes in which conversations end: the digest of their ids in order, joined by commas."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of ids of one node, as text."""
        key, first, held, size = None, None, [], 0

        def row() -> pa.RecordBatch:
            arrays = [pa.array([x], pa.int64()) for x in (*key, first)]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([",".join(held)], pa.string())], names=["k1", "k2", "first", "ids"])

        for batch in batches:
            for k1, k2, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (k1, k2) or size >= TEXT:
                    if held:
                        yield row()
                    key, first, held, size = (k1, k2), conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
        if held:
            yield row()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One digest per node, fed with its texts as they come."""
        names = ["k1", "k2", "ends_sha256"]
        key, state, done = None, None, []
        for batch in batches:
            for k1, k2, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key == (k1, k2):
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
                done = []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip((*key, state.hexdigest()))], names=names)

    ends = paths.where("last").select("k1", "k2", "conv_id")
    n = shuffle_partitions(paths.sparkSession)
    texts = ends.repartitionByRange(n, "k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id").mapInArrow(join, "k1 long, k2 long, first long, ids string")
    return texts.repartition(n, "k1", "k2").sortWithinPartitions("k1", "k2", "first").select("k1", "k2", "ids").mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    paths = keyed(rebuilt(turns(conversations)))
    deepest = paths.agg(F.max("d")).first()[0] or 0
    own = with_bands(paths, 1).groupBy("d", "k1", "k2", "p1", "p2", "up")
    nodes = own.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.sum(F.col("last").cast("long")).alias("ends"))
    leaf = (F.col("ends") == F.col("n_convs")).cast("long").alias("leaves")  # all that come here end here
    nodes = staged(nodes.select("d", "k1", "k2", "p1", "p2", "up", "conv_id", "n_convs", leaf, ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "nodes")

    zero = F.lit(0).cast("long")
    below = nodes.where("d > 0").select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), zero.alias("leaves"), zero.alias("saved"), F.lit(1).cast("long").alias("children"))
    parts = totals(paths, nodes, deepest).select("k1", "k2", "leaves", "saved", zero.alias("children")).unionAll(below)
    found = parts.groupBy("k1", "k2").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.sum("children").alias("n_children"))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.drop("up", "leaves", "saved").join(found.hint("merge"), ["k1", "k2"]).join(end_digests(paths).hint("merge"), ["k1", "k2"], "left")
    return whole.join(parents.hint("merge"), ["p1", "p2"], "left").select(
        "conv_id",
        F.col("d").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


SQL = r"""
WITH RECURSIVE own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, count(*) AS n,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
           lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))),
           4294967295::BIGINT) % 4 AS h
  FROM own GROUP BY conv_id
), heads AS (
  SELECT c.conv_id, c.h, least(c.h, coalesce(b.n, 0)) AS m, c.base FROM convs c LEFT JOIN convs b ON b.conv_id = c.base
), rebuilt AS (
  SELECT h.conv_id, o.pos AS d, o.role, o.text FROM heads h JOIN own o ON o.conv_id = h.base AND o.pos <= h.h
  UNION ALL
  SELECT h.conv_id, o.pos - h.h + h.m, o.role, o.text FROM heads h JOIN own o ON o.conv_id = h.conv_id AND o.pos > h.h
), paths AS (
  SELECT conv_id, 0::BIGINT AS d, 'root' AS k, NULL::VARCHAR AS p, 0::BIGINT AS words FROM heads
  UNION ALL
  SELECT r.conv_id, r.d, md5(q.k || ':' || strlen(r.role)::VARCHAR || ':' || r.role || r.text), q.k,
         len(regexp_extract_all(r.text, '[^\x20\x09-\x0D]+'))
  FROM paths q JOIN rebuilt r ON r.conv_id = q.conv_id AND r.d = q.d + 1
), sizes AS (SELECT conv_id, max(d) AS size FROM paths GROUP BY conv_id
), nodes AS (
  SELECT k, any_value(p) AS p, any_value(p.d) AS depth, min(p.conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(words) AS saved, count(*) FILTER (p.d = size) AS ends,
         sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (p.d = size), '')) AS ends_sha256
  FROM paths p JOIN sizes s ON s.conv_id = p.conv_id GROUP BY k
), below AS (
  SELECT a.k, sum(n.saved) AS saved_tokens, count(*) FILTER (n.ends = n.n_convs) AS n_leaves
  FROM nodes n JOIN paths a ON a.conv_id = n.conv_id AND a.d <= n.depth GROUP BY a.k
), children AS (SELECT p AS k, count(*) AS n FROM nodes WHERE p IS NOT NULL GROUP BY p)
SELECT n.conv_id, n.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.k = n.k LEFT JOIN children c ON c.k = n.k LEFT JOIN nodes q ON q.k = n.p
"""
