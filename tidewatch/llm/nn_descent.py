"""Operator 12: approximate nearest neighbours by NN-descent and greedy graph search.

Equal vectors are one node. Every node gets a list of near nodes, first from random-projection trees
(exact inside a leaf), then by rounds of NN-descent: the neighbours of a node, forward and reverse, meet
each other in that node's block, and pairs nearer than what a list holds enter it. A block asks for each
vector it needs once. Vectors travel as bytes with a scale of their own, around the centre; only answers
are measured on the original vectors.

A query starts from its own list. In each hop the nearest nodes of its beam that were not opened yet give
their neighbours, and the new ones are compared in their blocks, until no hop is left or nothing is open.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.arrow import batch_of, starts_of, whole_groups
from tidewatch.llm.skew import attach
from tidewatch.session import cut_lineage

#: Neighbours in a list, and the nearest reverse neighbours that a round and the search add to it.
LIST, REVERSE = 32, 32
#: Trees, the nodes of a leaf that are compared exactly, and neighbours that a tree gives a node.
TREES, LEAF, FROM_TREE = 3, 2048, 24
#: At most so many rounds; a round that shortens the lists by less than this share is the last.
ROUNDS, GAIN = 3, 0.002
#: New neighbours that a round brings a node from one block.
FROM_BLOCK = 16
#: Nodes of a block.
BLOCK = 16_384
#: The beam of a query, the nodes it opens in a hop, the hops, and the candidates measured exactly.
BEAM, OPENED, HOPS, EXACT = 256, 96, 5, 64
#: Sampled vectors (those of the smallest hashes) that place the centre and the trees' planes, and their bytes.
SAMPLE, SAMPLE_BYTES = 20_000, 16 << 20
#: Nodes of a tree's group that one task splits further.
GROUP = 8192
NEAR = pa.schema([("node", pa.int64()), ("ids", pa.list_(pa.int64())), ("d", pa.list_(pa.float32()))])
NEAR_SQL = "node long, ids array<long>, d array<float>"


@contextmanager
def files_removed(spark: SparkSession):
    """Shuffle files go when their query has ended: each step of the iteration is written as a table."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def listed(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, kind))


def unlisted(column) -> tuple[np.ndarray, np.ndarray]:
    """A list column's values end to end, and the number in each row."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)


def codes_of(column) -> np.ndarray:
    """Binary codes of one length as a matrix of signed bytes."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.empty((0, 1), np.int8)
    off = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    return np.frombuffer(column.buffers()[2], np.int8)[off[0]:off[-1]].reshape(len(column), -1)


def coded(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors around the centre as signed bytes, and the scale of each."""
    moved = vectors - centre
    scale = np.abs(moved).max(axis=1) / 127
    scale[~np.isfinite(scale) | (scale == 0)] = 1
    return np.nan_to_num(np.rint(moved / scale[:, None])).clip(-127, 127).astype(np.int8), scale


def squared(dots: np.ndarray, a_norm, b_norm, a_scale, b_scale) -> np.ndarray:
    """Squared distances from exact dot products of codes; the same whichever side comes first."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = (a_norm + b_norm) - 2 * ((a_scale * b_scale) * dots)
        return np.nan_to_num(np.maximum(out, 0), nan=np.inf, posinf=np.inf).astype(np.float32)


def norms(codes: np.ndarray, scale: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.einsum("ij,ij->i", codes.astype(np.float32), codes.astype(np.float32)).astype(np.float64) * scale**2


def nearest(of: np.ndarray, ids: np.ndarray, d: np.ndarray, most: int):
    """For each value of ``of`` its ``most`` nearest ids, each once: values, counts, ids, distances."""
    order = np.lexsort((ids, d, of))
    of, ids, d = of[order], ids[order], d[order]
    if len(of):
        new = np.concatenate([[True], (of[1:] != of[:-1]) | (ids[1:] != ids[:-1])])
        of, ids, d = of[new], ids[new], d[new]
    start = starts_of(of)
    rank = np.arange(len(of)) - np.repeat(start[:-1], np.diff(start))
    fit = rank < most
    return of[start[:-1]] if len(of) else of, np.minimum(np.diff(start), most) if len(of) else of, ids[fit], d[fit]


class Planes:
    """A random-projection tree: planes between two sampled points, at the sample's median."""

    def __init__(self, sample: np.ndarray, points: int, seed: int):
        rng = np.random.default_rng(seed)
        normals, cuts, kids, todo = [], [], [], [(np.arange(len(sample)), -1, 0)]
        self.leaves = 0
        while todo:
            at, parent, side = todo.pop()
            me = None
            if len(at) > points:
                a, b = rng.choice(len(at), 2, replace=False)
                normal = (sample[at[a]] - sample[at[b]]).astype(np.float32)
                shadow = sample[at] @ normal
                cut = np.median(shadow)
                left = shadow <= cut
                if left.any() and not left.all():
                    me = len(kids)
                    normals.append(normal)
                    cuts.append(cut)
                    kids.append([0, 0])
                    todo += [(at[left], me, 0), (at[~left], me, 1)]
            if me is None:
                me, self.leaves = -1 - self.leaves, self.leaves + 1
            if parent >= 0:
                kids[parent][side] = me
        self.normals, self.cuts, self.kids = np.array(normals, np.float32), np.array(cuts), np.array(kids, np.int64)

    def leaf(self, vectors: np.ndarray) -> np.ndarray:
        if not len(self.kids):
            return np.zeros(len(vectors), np.int64)
        at, open_ = np.zeros(len(vectors), np.int64), np.arange(len(vectors))
        while len(open_):
            here = at[open_]
            side = np.empty(len(open_), np.int64)
            for k in range(0, len(open_), 4096):
                part = slice(k, k + 4096)
                shadow = np.einsum("ij,ij->i", vectors[open_[part]], self.normals[here[part]])
                side[part] = shadow > self.cuts[here[part]]
            at[open_] = self.kids[here, side]
            open_ = open_[at[open_] >= 0]
        return -1 - at


def split_leaves(vectors: np.ndarray, most: int, seed: int):
    """Index arrays of at most ``most`` vectors each, cut by planes between two of them."""
    rng, todo = np.random.default_rng(seed), [np.arange(len(vectors))]
    while todo:
        at = todo.pop()
        if len(at) <= most:
            yield at
            continue
        a, b = rng.choice(at, 2, replace=False)
        shadow = vectors[at] @ (vectors[a] - vectors[b])
        order = np.argsort(shadow, kind="stable")
        todo += [at[order[:len(at) // 2]], at[order[len(at) // 2:]]]


def graph_of_leaves(coded_nodes: DataFrame, trees: list[Planes], salts: int) -> DataFrame:
    """Each node's nearest in its leaf of each tree: a row for each node and tree."""
    shared = coded_nodes.sparkSession.sparkContext.broadcast(trees)

    def placed(batches):
        schema = pa.schema([("group", pa.int64()), *[(c, t) for c, t in zip(
            ("node", "code", "scale"), (pa.int64(), pa.binary(), pa.float64()))]])
        for batch in batches:
            vectors = codes_of(batch.column(1)) * batch.column(2).to_numpy()[:, None].astype(np.float32)
            salt = batch.column(0).to_numpy() % salts
            for t, tree in enumerate(shared.value):
                group = (t << 40) + tree.leaf(vectors) * salts + salt if len(vectors) else salt
                yield batch_of(schema, group, *batch.columns)

    def compared(batches):
        for table in whole_groups(batches, "group"):
            group, node = table.column("group").to_numpy(), table.column("node").to_numpy()
            codes, scale = codes_of(table.column("code")), table.column("scale").to_numpy()
            edge = starts_of(group)
            for a, b in zip(edge[:-1], edge[1:]):
                order = a + np.argsort(node[a:b], kind="stable")
                vectors = codes[order] * scale[order, None].astype(np.float32)
                for part in split_leaves(vectors, LEAF, int(group[a]) & 0xFFFFFFFF):
                    mine = order[part]
                    if len(mine) < 2:
                        continue
                    c, s = codes[mine].astype(np.float32), scale[mine]
                    n = norms(codes[mine], s)
                    most = min(FROM_TREE, len(mine) - 1)
                    for k in range(0, len(mine), 512):
                        d = squared(c[k:k + 512] @ c.T, n[k:k + 512, None], n[None], s[k:k + 512, None], s[None])
                        d[np.arange(len(d)), np.arange(k, k + len(d))] = np.inf
                        near = np.argpartition(d, most - 1, axis=1)[:, :most]
                        yield batch_of(NEAR, node[mine[k:k + 512]],
                                       listed(node[mine][near].ravel(), np.full(len(d), most), pa.int64()),
                                       listed(np.take_along_axis(d, near, 1).ravel(), np.full(len(d), most), pa.float32()))

    spread = coded_nodes.select("node", "code", "scale").mapInArrow(
        placed, "group long, node long, code binary, scale double")
    return spread.repartition("group").sortWithinPartitions("group").mapInArrow(compared, NEAR_SQL)


def merged(near: DataFrame, most: int) -> DataFrame:
    """One list for each node from several."""
    def merge(batches):
        for table in whole_groups(batches, "node"):
            ids, counts = unlisted(table.column("ids"))
            of = np.repeat(table.column("node").to_numpy(), counts)
            nodes, sizes, ids, d = nearest(of, ids, unlisted(table.column("d"))[0], most)
            yield batch_of(NEAR, nodes, listed(ids, sizes, pa.int64()), listed(d, sizes, pa.float32()))

    return near.repartition("node").sortWithinPartitions("node").mapInArrow(merge, NEAR_SQL)


def opened(graph: DataFrame, coded_nodes: DataFrame) -> DataFrame:
    """Nodes with their neighbours both ways: block, node, ids, code, scale, bound (the distance that a new
    neighbour must beat)."""
    edge = graph.select("node", F.explode(F.arrays_zip("ids", "d")).alias("x")).select(
        F.col("x.ids").alias("to"), "node", "x.d")
    rank = F.row_number().over(Window.partitionBy("to").orderBy("d", "node"))
    back = edge.withColumn("rank", rank).filter(F.col("rank") <= REVERSE).groupBy("to").agg(
        F.collect_list("node").alias("back"))
    full = F.when(F.size("ids") >= LIST, F.array_max("d")).otherwise(F.lit(float("inf")).cast("float"))
    return coded_nodes.join(graph.withColumn("bound", full), "node").join(
        back.withColumnRenamed("to", "node"), "node", "left").select(
        "block", "node", F.array_sort(F.array_union("ids", F.coalesce("back", F.array().cast("array<long>")))).alias("ids"),
        "code", "scale", "bound")


def local_join(open_nodes: DataFrame) -> DataFrame:
    """One round: in each block, the neighbours of each node are compared with each other."""
    def needs(batches):
        schema = pa.schema([("block", pa.int64()), ("node", pa.int64())])
        for table in whole_groups(batches, "block"):
            block = table.column("block").to_numpy()
            ids, counts = unlisted(table.column("ids"))
            edge = starts_of(block)
            total = np.concatenate([[0], np.cumsum(counts)])
            for a, b in zip(edge[:-1], edge[1:]):
                wanted = np.unique(ids[total[a]:total[b]])
                yield batch_of(schema, np.full(len(wanted), block[a]), wanted)

    def compared(batches):
        for table in whole_groups(batches, "block", 1):
            block = table.column("block").to_numpy()
            edge = starts_of(block)
            for a, b in zip(edge[:-1], edge[1:]):
                yield from block_pairs(table.slice(a, b - a))

    by_block = open_nodes.repartition("block").sortWithinPartitions("block")
    wanted = by_block.select("block", "ids").mapInArrow(needs, "block long, node long").distinct()
    lent = wanted.join(open_nodes.select("node", "code", "scale", "bound"), "node")
    none = F.lit(None)
    both = open_nodes.select("block", F.lit(0).alias("kind"), "node", "ids", none.cast("binary").alias("code"),
                             none.cast("double").alias("scale"), none.cast("float").alias("bound")).unionByName(
        lent.select("block", F.lit(1).alias("kind"), "node", none.cast("array<long>").alias("ids"), "code", "scale", "bound"))
    return both.repartition("block").sortWithinPartitions("block", "kind", "node").mapInArrow(compared, NEAR_SQL)


def block_pairs(table: pa.Table):
    """New neighbours found in one block."""
    kind = table.column("kind").to_numpy()
    cut = int(np.searchsorted(kind, 1))
    own, lent = table.slice(0, cut), table.slice(cut)
    node = lent.column("node").to_numpy()
    codes, scale = codes_of(lent.column("code")), lent.column("scale").to_numpy()
    bound, size = lent.column("bound").to_numpy(), norms(codes, scale)
    ids, counts = unlisted(own.column("ids"))
    ids = np.searchsorted(node, ids)
    edge = np.concatenate([[0], np.cumsum(counts)])
    width, held, pending = int(counts.max(initial=0)), [], 0
    if not width:
        return
    step = max(1, (4 << 20) // (width * max(codes.shape[1], width)))

    def best(parts):
        of, other, d = (np.concatenate(x) for x in zip(*parts))
        return nearest(of, other, d, FROM_BLOCK)

    for k in range(0, len(counts), step):
        n = counts[k:k + step]
        at = np.arange(width)[None]
        there = at < n[:, None]
        index = ids[np.minimum(edge[k:k + step][:len(n), None] + at, len(ids) - 1)]
        c = codes[index].astype(np.float32)
        d = squared(c @ c.transpose(0, 2, 1), size[index][:, :, None], size[index][:, None], scale[index][:, :, None],
                    scale[index][:, None])
        good = there[:, :, None] & there[:, None] & (d < bound[index][:, :, None])
        good[:, np.arange(width), np.arange(width)] = False
        i, j, m = np.nonzero(good)
        held.append((index[i, j], index[i, m], d[i, j, m]))
        pending += len(i)
        if pending > 2_000_000:
            of, sizes, other, d = best(held)
            held, pending = [(np.repeat(of, sizes), other, d)], len(other)
    if pending:
        of, sizes, other, d = best(held)
        yield batch_of(NEAR, node[of], listed(node[other], sizes, pa.int64()), listed(d, sizes, pa.float32()))


def hop(beams: DataFrame, open_nodes: DataFrame) -> DataFrame:
    """One hop of all queries. ``beams``: q, code, scale, ids and d (nearest first), done (opened ids), seen."""
    waiting = F.slice(F.array_except("ids", "done"), 1, OPENED)
    asked = beams.select("q", F.explode(waiting).alias("node")).join(open_nodes.select("node", "ids"), "node")
    # neighbours of one query arrive as lists; what it has seen, and repeats, go before anything is compared
    fresh = asked.groupBy("q").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("new"))
    state = cut_lineage(beams.join(fresh, "q", "left").select(
        "q", "code", "scale", "ids", "d", F.concat("done", waiting).alias("done"), "seen",
        F.array_except(F.coalesce("new", F.array().cast("array<long>")), F.col("seen")).alias("new")), "beams")
    bound = F.when(F.size("ids") >= BEAM, F.array_max("d")).otherwise(F.lit(float("inf")).cast("float"))
    none = F.lit(None)
    ask = state.select(F.explode("new").alias("node"), "q").groupBy(
        F.shiftright("node", 32).alias("block"), "q").agg(F.sort_array(F.collect_list("node")).alias("ids"))
    ask = ask.join(state.select("q", "code", "scale", bound.alias("bound")), "q")
    both = open_nodes.select("block", F.lit(0).alias("kind"), "node", "code", "scale", none.cast("float").alias("bound"),
                             none.cast("array<long>").alias("ids")).unionByName(
        ask.select("block", F.lit(1).alias("kind"), F.col("q").alias("node"), "code", "scale", "bound", "ids"))

    def compared(batches):
        for table in whole_groups(batches, "block", 1):
            edge = starts_of(table.column("block").to_numpy())
            for a, b in zip(edge[:-1], edge[1:]):
                part = table.slice(a, b - a)
                cut = int(np.searchsorted(part.column("kind").to_numpy(), 1))
                node, codes = part.column("node").to_numpy(), codes_of(part.column("code"))
                scale = part.column("scale").to_numpy()
                size = norms(codes, scale)
                ids, counts = unlisted(part.slice(cut).column("ids"))
                bounds = part.slice(cut).column("bound").to_numpy()
                at = 0
                for k, n in enumerate(counts):
                    mine, row = np.searchsorted(node[:cut], ids[at:at + n]), cut + k
                    at += n
                    dots = codes[mine].astype(np.float32) @ codes[row].astype(np.float32)
                    d = squared(dots, size[mine], size[row], scale[mine], scale[row])
                    fit = d < bounds[k]
                    q, sizes, found, d = nearest(np.full(fit.sum(), node[row]), node[mine[fit]], d[fit], BEAM)
                    if len(q):
                        yield batch_of(NEAR, q, listed(found, sizes, pa.int64()), listed(d, sizes, pa.float32()))

    found = both.repartition("block").sortWithinPartitions("block", "kind", "node").mapInArrow(compared, NEAR_SQL)
    old = state.select(F.col("q").alias("node"), "ids", "d")
    new = merged(old.unionByName(found), BEAM).withColumnsRenamed({"node": "q", "ids": "near", "d": "apart"})
    return cut_lineage(state.join(new, "q").select(
        "q", "code", "scale", F.col("near").alias("ids"), F.col("apart").alias("d"), "done",
        F.concat("seen", "new").alias("seen")), "beams")


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id (long) and v of the rows that take part."""
    v = F.col("embedding")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
        & F.exists("v", lambda x: x != 0))


def build(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """The index over all rows: nodes (block, node, v, members: the k + 1 smallest vec_ids), graph and open nodes."""
    n_rows = rows.count()
    if not n_rows:
        return None
    by_v = Window.partitionBy("v").orderBy("vec_id")
    unique = rows.withColumn("rank", F.row_number().over(by_v)).filter(F.col("rank") <= k + 1).groupBy("v").agg(
        F.sort_array(F.collect_list("vec_id")).alias("members"))
    unique = cut_lineage(unique, "vectors")
    n = unique.count()
    width = unique.select(F.size("v")).first()[0]
    few = max(64, min(SAMPLE, SAMPLE_BYTES // (4 * width)))
    sample = unique.orderBy(F.xxhash64("v"), "v").limit(few).select("v").toArrow()
    sample = unlisted(sample.column(0))[0].astype(np.float64).reshape(-1, width)
    centre = np.median(sample, axis=0)       # one huge value must not move it
    blocks = max(1, -(-n_rows // BLOCK))
    kind = dict(rows.dtypes)["v"]

    def number(batches):
        block, at = None, 0
        for batch in batches:
            own = batch.column(0).to_numpy()
            place = np.empty(len(own), np.int64)
            edge = starts_of(own) if len(own) else np.zeros(1, np.int64)
            for a, b in zip(edge[:-1], edge[1:]):
                if own[a] != block:
                    block, at = own[a], 0
                place[a:b] = np.arange(at, at + b - a)
                at += b - a
            values = unlisted(batch.column(1))[0].astype(np.float64).reshape(len(own), -1)
            codes, scale = coded(values, centre)
            packed = pa.array([c.tobytes() for c in codes], pa.binary())
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array((own << 32) + place), batch.column(1), batch.column(2),
                                              packed, pa.array(scale, pa.float64())],
                                             ["block", "node", "v", "members", "code", "scale"])
            yield out

    dealt = unique.select(F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("long").alias("block"), "v", "members")
    dealt = dealt.repartition("block").sortWithinPartitions("block", F.xxhash64("v"), "v")
    nodes = cut_lineage(dealt.mapInArrow(number, f"block long, node long, v {kind}, members array<long>, code binary, "
                                                 "scale double"), "nodes")
    slim = nodes.select("block", "node", "code", "scale")
    points = max(8, len(sample) * GROUP // n)
    moved = coded(sample, centre)
    moved = moved[0] * moved[1][:, None].astype(np.float32)
    trees = [Planes(moved, points, seed) for seed in range(TREES if n > LEAF else 1)]
    salts = max(1, n // (trees[0].leaves << 20))
    graph = cut_lineage(merged(graph_of_leaves(slim, trees, salts), LIST), "graph")
    length = graph.agg(F.sum(F.aggregate("d", F.lit(0.0), lambda a, x: a + x))).first()[0]
    for _ in range(ROUNDS if n > LEAF else 0):
        open_nodes = cut_lineage(opened(graph, slim), "open")
        graph = cut_lineage(merged(graph.unionByName(local_join(open_nodes)), LIST), "graph")
        before, length = length, graph.agg(F.sum(F.aggregate("d", F.lit(0.0), lambda a, x: a + x))).first()[0]
        if length is None or not before - length > GAIN * before:
            break
    return nodes, graph, cut_lineage(opened(graph, slim), "open")


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance in double precision."""
    parts = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))
    return F.sqrt(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x))


def neighbours(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """The ``k`` nearest found of each query: query_id, rank (from 1), vec_id, score (Euclidean distance, double).

    ``vectors``: vec_id (integer) and embedding (array of numbers); other columns are left aside. Queries are the rows
    whose vec_id is divisible by ``every``; candidates are all rows but the query's own, copies included. Ties go to
    smaller vec_ids. Rows take no part if vec_id or the vector is null, the vector is empty or zero or holds a null or
    a value that is not finite, or if its length isn't the table's most frequent one (the longer of two). Repeated
    rows are candidates and queries each. Every row is indexed; which neighbours are found is approximate, their
    distances are exact. ``k`` may be up to ``LIST``. An empty table gives no rows.
    """
    if k > LIST:
        raise ValueError(f"k may be {LIST} at most")
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors)
    usual = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.col("count").desc(), F.col("size").desc()).first()
    if usual is None:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("v") == usual["size"])
    with files_removed(spark):
        asking = cut_lineage(rows.filter(F.col("vec_id") % every == 0), "queries")
        if asking.isEmpty():
            return spark.createDataFrame([], schema)
        nodes, graph, open_nodes = build(rows, k)
        wanted = asking.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        starts = cut_lineage(nodes.join(wanted, "v").select(F.col("node").alias("q"), "v", "members", "n", "code", "scale"),
                             "starts")
        none = F.array().cast("array<long>")
        beams = cut_lineage(starts.select("q", "code", "scale").join(graph.withColumnRenamed("node", "q"), "q", "left").select(
            "q", "code", "scale", F.coalesce("ids", none).alias("ids"), F.coalesce("d", F.array().cast("array<float>")).alias("d"),
            none.alias("done"), F.concat(F.coalesce("ids", none), F.array("q")).alias("seen")), "beams")
        for _ in range(HOPS):
            if beams.filter(F.size(F.array_except("ids", "done")) > 0).isEmpty():
                break
            beams = hop(beams, open_nodes)
        near = beams.select("q", F.explode(F.concat(F.slice("ids", 1, EXACT), F.array("q"))).alias("node"))
        near = near.join(nodes.select("node", F.col("v").alias("other"), F.col("members").alias("held")), "node")
        scored = near.join(starts.select("q", "v"), "q").select(
            "q", distance(F.col("v"), F.col("other")).alias("score"), "held")
        # one list for each query vector: the k + 1 nearest rows, its own copies among them
        order = Window.partitionBy("q").orderBy("score", "vec_id")
        best = scored.select("q", "score", F.explode("held").alias("vec_id")).withColumn(
            "at", F.row_number().over(order)).filter(F.col("at") <= k + 1)
        best = best.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("best"))
        answers = cut_lineage(starts.join(best, "q").select("v", "n", "best"), "answers")
        met = attach(asking, answers, ["v"])
        # the query's own row goes once, if it is among them
        own = F.array_position(F.transform("best", lambda b: b.vec_id), F.col("vec_id"))
        others = F.filter("best", lambda b, i: i + 1 != F.col("own"))
        out = met.withColumn("own", own).select(F.col("vec_id").alias("query_id"),
                                                F.posexplode(F.slice(others, 1, k)).alias("pos", "b"))
        return cut_lineage(out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"),
                                      F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score")), "neighbours")
