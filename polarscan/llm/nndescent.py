"""Embedding near-duplicates by NN-descent.

Rows with the same label and vector are one class, and each class is a node. A neighbour graph starts from several sorted
orders: per order, nodes are sorted by label and the signs of random projections, spread by range, and look at the nodes
beside them. Each round then joins neighbours of neighbours: a node gathers its list and those that list it, compares all of
them with each other and offers better neighbours. After some rounds recall is audited: the links of nodes, of more the larger the
table is and the rarer links are, are found by brute force, and while too few of them are in the graph, new orders and rounds
follow; if those do not reach the recall, every node is asked. Links that an audit finds missing are added.

A list whose last entry still is a link is saturated: it may hide further links, and a link whose two ends are saturated may be
in no list. The lists of saturated nodes are enlarged in two ways. Outside their component of threshold edges: saturated nodes
get another list in which only nodes of other components take places, searched in the same way; what it finds unites
components, and searches follow until none finds a link. Inside: the component's members are compared in tiles of ``TILE`` x
``TILE`` in double precision, and a tile gives counts and one reached node per node, not pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without a label, link with
nothing; vectors of different lengths are never compared; equal rows are linked and stay rows; null ids never name a
component unless it has no other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, shuffle_partitions, staged, table
from .components import components

LEAST = 0.98
SLACK = 1e-4  # single-precision similarities below the threshold by this much are still verified
NEIGHBOURS = 10
ORDERS = 5
BESIDE = 12
OFFERS = 5
ROUNDS = 2
MOST_EXTENSIONS = 4
AUDITED = 256
LINKED = 64  # asked nodes with true links that a verdict on the recall needs
PASS = 8  # blocks of AUDITED nodes asked in one pass over the table
WANTED_RECALL = 0.98
TILE = 1024
BITS = 30

EDGE = "u long, v long, s float"


def prepared(vectors: DataFrame) -> DataFrame:
    """row, vec_id, label, digest (null: links with nothing), dim and the unit vector in double precision; written."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests, dims, units = [], [], []
        for label, vector in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            good = label is not None and vector and None not in vector
            x = np.array(vector, dtype=np.float64) + 0.0 if good else np.zeros(0)
            good = good and bool(np.isfinite(x).all()) and bool(x.any())
            if good:
                scaled = x / np.abs(x).max()  # no overflow in the norm
                digests.append(hashlib.blake2b(b"%d:" % label + x.tobytes(), digest_size=16).digest())
                units.append((scaled / np.linalg.norm(scaled)).tobytes())
                dims.append(len(x))
            else:
                digests.append(None), units.append(None), dims.append(None)
        arrays = [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(dims, pa.int32()), pa.array(units, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["vec_id", "label", "digest", "dim", "unit"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    found = map_batches(rows, run, "vec_id long, label long, digest binary, dim int, unit binary")
    return staged(found.withColumn("row", F.monotonically_increasing_id()), "vectors")


def _single(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of single precision."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1).astype(np.float32)


def _orders(nodes: DataFrame, first: int, orders: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == dim))
                x = _single(some.column(3))
                for order in range(first, first + orders):
                    planes = np.random.default_rng((order, dim)).normal(size=(dim, BITS)).astype(np.float32)
                    code = ((x @ planes) > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                    names = ["o", "label", "dim", "code", "node", "unit", "side"]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), order, np.int32)), some.column(1), some.column(2), pa.array(code), some.column(0), some.column(3), some.column(4)], names=names
                    )

    coded = nodes.select("node", "label", "dim", "unit", "side").mapInArrow(run, "o int, label long, dim int, code long, node long, unit binary, side long")
    keys = ["o", "label", "dim", "code", "node"]
    n = shuffle_partitions(nodes.sparkSession)
    return coded.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per node the best of the nodes up to ``BESIDE`` places away in its order, label and length. Nodes of one side are not
    compared, and of each run of them only the two ends keep their places, so that a run hides nothing behind it."""
    kept = None
    for batch in batches:
        whole = pa.Table.from_batches([batch] if kept is None else [kept, batch]).combine_chunks().to_batches()
        if not whole:
            continue
        whole = whole[0]
        same = np.logical_and.reduce([whole.column(i).to_numpy()[1:] == whole.column(i).to_numpy()[:-1] for i in (0, 1, 2, 6)])
        whole = whole.filter(pa.array(~(np.r_[False, same] & np.r_[same, False])))
        key = np.stack([whole.column(i).to_numpy() for i in (0, 1, 2)], axis=1)
        cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1), True])
        for low, high in zip(cuts[:-1], cuts[1:]):
            n = int(high - low)
            if n < 2:
                continue
            node, x = whole.column(4).to_numpy()[low:high], _single(whole.column(5).slice(low, n))
            side = whole.column(6).to_numpy()[low:high]
            reach = min(BESIDE, n - 1)
            s = np.full((n, 2 * reach), -2, np.float32)
            for k in range(1, reach + 1):
                near = np.where(side[:-k] != side[k:], np.einsum("ij,ij->i", x[:-k], x[k:]), np.float32(-2))
                s[:-k, k - 1], s[k:, reach + k - 1] = near, near
            best = np.argsort(-s, axis=1)[:, :OFFERS]
            value = np.take_along_axis(s, best, axis=1)
            step = np.where(best < reach, best + 1, reach - 1 - best)
            i, j = np.nonzero(value > -2)
            yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[i + step[i, j]]), pa.array(value[i, j])], names=["u", "v", "s"])
        kept = whole.slice(max(0, whole.num_rows - BESIDE))


def _best(edges: DataFrame, k: int = NEIGHBOURS, by: str = "u", other: str = "v") -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("s"), other)
    return edges.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def _join_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows hold the gathered nodes of one pivot: pairs of them, of two sides, that are better than either one's
    last neighbour."""
    for batch in batches:
        us, vs, ss = [], [], []
        for members in batch.column(0).to_pylist():
            node = np.array([m["node"] for m in members])
            last = np.array([m["last"] for m in members], dtype=np.float32)
            side = np.array([m["side"] for m in members])
            x = np.frombuffer(b"".join(m["unit"] for m in members), np.float64).reshape(len(node), -1).astype(np.float32)
            s = x @ x.T
            i, j = np.nonzero((s > last[:, None]) & (side[:, None] != side[None, :]))
            us.append(node[i]), vs.append(node[j]), ss.append(s[i, j])
        if us:
            arrays = [pa.array(np.concatenate(us)), pa.array(np.concatenate(vs)), pa.array(np.concatenate(ss).astype(np.float32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["u", "v", "s"])


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u", "v").agg(F.max("s").alias("s"))


def refined(graph: DataFrame, nodes: DataFrame, k: int, own: DataFrame | None = None) -> DataFrame:
    """One round of neighbours-of-neighbours joins. A node gathers at most ``k`` neighbours and ``k`` that list it, and as many
    of ``own``, a graph inside the sides."""
    known_graph = graph if own is None else graph.unionByName(own)
    forward = known_graph.select(F.col("u").alias("pivot"), F.col("v").alias("node"))
    backward = _best(graph, k, "v", "u") if own is None else _best(graph, k, "v", "u").unionByName(_best(own, k, "v", "u"))
    backward = backward.select(F.col("v").alias("pivot"), F.col("u").alias("node"))
    last = graph.groupBy("u").agg(F.when(F.count("*") >= k, F.min("s")).otherwise(F.lit(-2.0)).cast("float").alias("last"))
    known = nodes.select("node", "unit", "side").join(last.withColumnRenamed("u", "node"), "node", "left").select("node", "unit", "side", F.coalesce("last", F.lit(-2.0).cast("float")).alias("last"))
    gathered = forward.unionByName(backward).distinct().join(known.hint("merge"), "node")
    pivots = gathered.groupBy("pivot").agg(F.collect_list(F.struct("node", "last", "side", "unit")).alias("members")).select("members")
    offered = pivots.mapInArrow(_join_neighbours, EDGE)
    return staged(_best(_distinct(graph.unionByName(_distinct(offered))), k), "neighbours")


def _links(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("s") >= LEAST - SLACK).select(F.col("u").alias("a"), F.col("v").alias("b"))


def across(nodes: DataFrame, graph: DataFrame, k: int, orders: int, rounds: int, first: int) -> DataFrame:
    """Links (a, b): those of the graph and, for saturated nodes, what they hide: links into other components."""
    links = _links(graph)
    full = graph.groupBy("u").agg(F.count("*").alias("n"), F.min("s").alias("last")).where((F.col("n") >= k) & (F.col("last") >= LEAST - SLACK))
    full = staged(nodes.drop("side").join(full.select(F.col("u").alias("node")).hint("merge"), "node"), "saturated")
    own = graph.join(full.select(F.col("node").alias("u")).hint("merge"), "u").join(full.select(F.col("node").alias("v")).hint("merge"), "v").select("u", "v", "s")
    own = staged(own, "saturated-lists")
    while True:
        comp = components(links).withColumnRenamed("component", "side")
        sided = staged(full.join(comp.hint("merge"), "node"), "sides")
        if sided.groupBy("label", "dim").agg((F.min("side") < F.max("side")).alias("many")).where("many").isEmpty():
            return links
        lists = staged(_best(_distinct(_orders(sided, first, orders).mapInArrow(_beside, EDGE)), k), "across")
        for _ in range(rounds):
            lists = refined(lists, sided, k, own)
        found = _links(lists)
        if found.isEmpty():
            return links
        links, first = staged(links.unionByName(found), "links-across"), first + orders


def _asked(rows: DataFrame, asked: list) -> DataFrame:
    """(node, total, found, missed) of the asked nodes, by brute force over all rows, one row per batch with links: the number
    of true links, of those inside the node's component, and of each other component that links reach one node."""
    groups: dict[tuple[int, int], list] = {}
    for q in asked:
        groups.setdefault((q["dim"], q["label"]), []).append((q["node"], q["component"], bytes(q["unit"])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, label, dim, at = (batch.column(i).to_numpy() for i in (0, 1, 2, 4))
            units, out = batch.column(3), []
            for (d, k), some in groups.items():
                pick = np.flatnonzero((dim == d) & (label == k))
                if not len(pick):
                    continue
                y = np.frombuffer(b"".join(u for _, _, u in some), np.float64).reshape(len(some), d)
                for low in range(0, len(pick), 512):
                    part = pick[low : low + 512]
                    x = np.frombuffer(b"".join(units.take(pa.array(part)).to_pylist()), np.float64).reshape(len(part), d)
                    near = y @ x.T >= LEAST
                    for i in np.flatnonzero(near.any(axis=1)):
                        q, component, _ = some[i]
                        linked = part[near[i] & (node[part] != q)]
                        other = linked[at[linked] != component]
                        if len(linked):
                            out.append((q, len(linked), len(linked) - len(other), node[other[np.unique(at[other], return_index=True)[1]]].tolist()))
            columns = list(zip(*out)) or [()] * 4
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], names=["node", "total", "found", "missed"])

    return staged(rows.mapInArrow(run, "node long, total long, found long, missed array<long>"), "audit")


def audited(nodes: DataFrame, links: DataFrame, whole: bool = False) -> tuple[DataFrame, float]:
    """The links with those that the audit found missing, and the recall: of the asked nodes with true links, the mean share of
    them inside the node's component. Nodes are asked in random order, ``AUDITED`` times the cube root of the table at least,
    until ``LINKED`` have true links. If that takes all nodes, or for a ``whole`` audit, nothing is missing any more and the
    recall is 1."""
    component = F.coalesce("component", "node").alias("component")
    rows = staged(nodes.join(components(links).hint("merge"), "node", "left").select("node", "label", "dim", "unit", component), "audit-components")
    blocks = max(1, math.ceil(rows.count() / AUDITED))
    at, least, linked, shares = 0, math.ceil(blocks ** (1 / 3)), 0, 0.0
    block = F.pmod(F.xxhash64("node"), F.lit(blocks))
    while at < blocks and (whole or at < least or linked < LINKED):
        seen = _asked(rows, rows.where((block >= at) & (block < at + PASS)).collect())
        n, share = seen.groupBy("node").agg((F.sum("found") / F.sum("total")).alias("share")).agg(F.count("*"), F.sum("share")).first()
        links = links.unionByName(seen.select(F.col("node").alias("a"), F.explode("missed").alias("b")))
        at, linked, shares = at + PASS, linked + n, shares + (share or 0.0)
        links = staged(links, "links-audited") if at % (32 * PASS) == 0 else links  # keeps the plan short
    return staged(links, "links-audited"), 1.0 if at >= blocks else shares / linked


def neighbour_graph(nodes: DataFrame, k: int = NEIGHBOURS, orders: int = ORDERS, rounds: int = ROUNDS) -> DataFrame:
    """Links (a, b) that connect what the search finds, refined until the audited recall is reached, or else completed by
    asking every node."""
    graph, nodes = None, nodes.withColumn("side", F.col("node"))
    for extension in range(MOST_EXTENSIONS):
        seeds = _distinct(_orders(nodes, extension * orders, orders).mapInArrow(_beside, EDGE))
        graph = staged(_best(seeds if graph is None else _distinct(graph.unionByName(seeds)), k), "neighbours")
        for _ in range(rounds):
            graph = refined(graph, nodes, k)
        links = across(nodes, graph, k, orders, rounds, MOST_EXTENSIONS * orders)
        links, recall = audited(nodes, links)
        if recall >= WANTED_RECALL:
            return links
    return audited(nodes, links, whole=True)[0]


def _least_reachable(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per left node the least node that it reaches over the links of this pair of tiles."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib = at[: len(a)], at[len(a) :]
    least = np.arange(len(ids))
    while True:
        before = least.copy()
        np.minimum.at(least, ia, np.where(near, before[ib][None, :], len(ids)).min(axis=1))
        np.minimum.at(least, ib, np.where(near, before[ia][:, None], len(ids)).min(axis=0))
        least = least[least]  # what a node's least one has reached, the node reaches too
        if (least == before).all():
            return ids[least[ia]]


def _compare(left: pa.Table, right: pa.Table) -> pa.Table:
    """Counts of links of the left tile's nodes in the right tile (weighted by class size), and one node of their component
    within the two tiles: the same one for all of it, so that these partners connect what the links connect."""
    matrix = lambda t, unit: np.frombuffer(b"".join(t.column(unit).to_pylist()), np.float64).reshape(t.num_rows, -1)
    if not left.num_rows or not right.num_rows:
        return pa.table({"node": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "partner": pa.array([], pa.int64())})
    a, b = left.column("l_node").to_numpy(), right.column("node").to_numpy()
    near = (matrix(left, "l_unit") @ matrix(right, "unit").T >= LEAST) & (a[:, None] != b[None, :])
    n = near @ right.column("size").to_numpy()
    partner = _least_reachable(near, a, b)
    some = near.any(axis=1)
    return pa.table({"node": a[some], "n": n[some].astype(np.int64), "partner": partner[some]})


def exact_links(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """(node, n, partner) rows: per node and tile the number of linked rows and one node reached by links."""
    members = staged(nodes.join(components(found).hint("merge"), "node").select("node", "component", "size", "unit", (F.xxhash64("node")).alias("h")), "link-members")
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    tiled = members.join(sizes.hint("merge"), "component").withColumn("tile", F.pmod("h", F.col("tiles")).cast("int")).drop("h")
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    left = tiled.select("component", F.col("tile").alias("i"), every.alias("j"), "node", "unit")
    right = tiled.select("component", every.alias("i"), F.col("tile").alias("j"), "node", "unit", "size")
    left = left.select(F.col("component").alias("c"), F.col("i").alias("li"), F.col("j").alias("lj"), F.col("node").alias("l_node"), F.col("unit").alias("l_unit"))
    pair = left.groupBy("c", "li", "lj").cogroup(right.groupBy("component", "i", "j"))
    return staged(pair.applyInArrow(_compare, "node long, n long, partner long"), "links")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = prepared(vectors)
    classes = rows.where("digest is not null").groupBy("digest").agg(F.min("row").alias("node"), F.count("*").alias("size"), F.min("vec_id").alias("least"))
    nodes = staged(
        classes.select(F.col("node").alias("row"), "size", "least").join(rows.select("row", "label", "dim", "unit"), "row").withColumnRenamed("row", "node"), "nodes"
    )
    links = exact_links(nodes, neighbour_graph(nodes))
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    joined = components(links.select(F.col("node").alias("a"), F.col("partner").alias("b")))
    placed = nodes.select("node", "size", "least").join(joined.hint("merge"), "node", "left").join(counts.hint("merge"), "node", "left").select(
        "node", "size", "least", F.coalesce("component", "node").alias("component"), F.coalesce("n", F.lit(0)).alias("n")
    )
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = placed.join(names.hint("merge"), "component").select("node", (F.col("n") + F.col("size") - 1).alias("n_links"), "component_id")
    of_row = classes.select("digest", "node").join(of_class.hint("merge"), "node").select("digest", "n_links", "component_id")
    out = rows.select("vec_id", "digest").join(of_row.hint("merge"), "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op8_nn_descent(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
