"""Operator 5: exact top-k inner-product search by a ball tree for each shard.

Every task packs its vectors into shards and builds a ball tree over each. A query first
searches the shard that it lies in; its k-th best score there is a bound that it takes along to
all other shards, and that rises as tasks go on from shard to shard. In a tree, nodes are
visited in the order of their upper bounds on the inner product (q.c + |q| r for a ball of
centre c and radius r) and skipped where the bound is below the current k-th score.

Queries travel in blocks to the shards, dealt by a shard group number. Scores are integers,
computed exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.arrow import batch_of
from tidewatch.session import cut_lineage

#: Vectors of a shard, of a leaf, and queries of a block.
SHARD, LEAF, BLOCK = 8192, 128, 1024
#: Shards that share a group, and so the task that a query block visits them in.
GROUP = 4
NO_SCORE = np.iinfo(np.int64).min
SHARDS = pa.schema([("shard", pa.int64()), ("n", pa.int32()), ("queries", pa.int64()), ("ids", pa.binary()),
                    ("vectors", pa.binary()), ("nodes", pa.binary()), ("centres", pa.binary())])
QUERIES = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("bound", pa.int64()), ("vector", pa.binary())])
BLOCKS = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("query_ids", pa.binary()),
                    ("bounds", pa.binary()), ("dim", pa.int32()), ("queries", pa.binary())])
FOUND = pa.schema([("key", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def narrow(x: np.ndarray) -> bytes:
    """Integers in the fewest bytes each that hold all of them, after a byte that says how many."""
    for kind in (np.int16, np.int32, np.int64):
        if kind is np.int64 or np.abs(x.astype(np.float64)).max(initial=0) < np.iinfo(kind).max:
            return bytes([np.dtype(kind).itemsize]) + x.astype(kind).tobytes()


def wide(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.dtype(f"i{packed[0]}"), offset=1).astype(np.int64)


class Tree:
    """A ball tree; ``vectors`` and ``ids`` are in the order of its leaves."""

    def __init__(self, ids, vectors, nodes, centres):
        self.ids, self.vectors = ids, vectors
        self.start, self.end, self.left, self.right = nodes[:4]
        self.radius, self.centres = centres[:, -1], centres[:, :-1]
        self.largest = float(np.abs(vectors).max(initial=0))

    @classmethod
    def build(cls, ids, vectors):
        order, exact = np.arange(len(ids)), vectors.astype(np.float64)
        nodes, centres, todo = [], [], [(0, len(ids))]
        while len(nodes) < len(todo):
            a, b = todo[len(nodes)]
            part = exact[order[a:b]]
            centre = part.mean(axis=0)
            away = np.sqrt(((part - centre) ** 2).sum(axis=1))
            left = right = -1
            if b - a > LEAF:
                one = part[away.argmax()]
                other = part[((part - one) ** 2).sum(axis=1).argmax()]
                side = part @ (other - one)
                half = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(side, half)]
                left, right = len(todo), len(todo) + 1
                todo += [(a, a + half), (a + half, b)]
            nodes.append((a, b, left, right))
            centres.append([*centre, away.max(initial=0) * (1 + 1e-9)])
        return cls(ids[order], vectors[order], np.array(nodes, np.int64).T, np.array(centres, np.float64))

    def packed(self):
        nodes = np.stack([self.start, self.end, self.left, self.right])
        return (self.ids.tobytes(), narrow(self.vectors), nodes.tobytes(),
                np.column_stack([self.centres, self.radius]).tobytes())

    @classmethod
    def unpack(cls, n, ids, vectors, nodes, centres):
        nodes = np.frombuffer(nodes, np.int64).reshape(4, -1)
        return cls(np.frombuffer(ids, np.int64), wide(vectors).reshape(n, -1), nodes,
                   np.frombuffer(centres, np.float64).reshape(nodes.shape[1], -1))

    def search(self, best: "Best", own: np.ndarray) -> None:
        """Put what this shard holds into ``best``; ``own``: each query's row here, or -1."""
        d = min(best.queries.shape[1], self.vectors.shape[1])   # what is missing counts as zero
        queries, vectors = best.queries[:, :d], self.vectors[:, :d]
        fits = d * best.largest * self.largest < 2**52          # then doubles are exact
        if fits:
            queries, vectors = queries.astype(np.float64), vectors.astype(np.float64)
        near = queries.astype(np.float64) @ self.centres[:, :d].T
        # rounding: a little above what the exact bound can be
        bound = (near + best.norms[:, None] * self.radius) * (1 + 1e-9) + np.abs(near) * 1e-8 + 1e-3

        def visit(node, who):
            who = who[bound[who, node] >= best.bound(who)]
            if not len(who):
                return
            left, right = self.left[node], self.right[node]
            if left < 0:
                a, b = self.start[node], self.end[node]
                scores = (queries[who] @ vectors[a:b].T).astype(np.int64)
                mine = own[who]
                here = np.flatnonzero((mine >= a) & (mine < b))
                scores[here, mine[here] - a] = NO_SCORE
                best.add(who, scores, self.ids[a:b])
                return
            first = bound[who, left] >= bound[who, right]
            for group, order in ((who[first], (left, right)), (who[~first], (right, left))):
                for child in order:
                    if len(group):
                        visit(child, group)

        visit(0, np.arange(len(queries)))


class Best:
    """The k best of each query of a block so far: (score, id), the best first."""

    def __init__(self, keys, ids, bounds, queries, k):
        self.keys, self.ids, self.queries, self.k = keys, ids, queries, k
        self.shared = bounds
        self.norms = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        self.largest = float(np.abs(queries).max(initial=0))
        self.score = np.full((len(keys), k), NO_SCORE)
        self.found = np.full((len(keys), k), np.iinfo(np.int64).max)

    def bound(self, who):
        return np.maximum(self.shared[who], self.score[who, -1])

    def add(self, who, scores, ids):
        keep = np.minimum(self.k, scores.shape[1])
        if scores.shape[1] > 4 * self.k:      # what is below the k-th of this leaf can go
            kth = np.partition(scores, -keep, axis=1)[:, -keep]
            some = np.flatnonzero((scores >= np.maximum(kth, self.bound(who))[:, None]).any(axis=0))
            scores, ids = scores[:, some], ids[some]
        score = np.concatenate([self.score[who], scores], axis=1)
        found = np.concatenate([self.found[who], np.broadcast_to(ids, scores.shape)], axis=1)
        found = np.where(score == NO_SCORE, np.iinfo(np.int64).max, found)
        order = np.lexsort((found, ~score), axis=1)[:, :self.k]
        self.score[who] = np.take_along_axis(score, order, 1)
        self.found[who] = np.take_along_axis(found, order, 1)

    def rows(self):
        who, at = np.nonzero(self.score != NO_SCORE)
        return self.keys[who], self.ids[who], self.found[who, at], self.score[who, at]


def _integers(vectors: DataFrame) -> DataFrame:
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * 256).cast("long"))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding"))
            .filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
            .select("vec_id", whole.alias("vector")))


def _pack(batches, every):
    """Shards from the rows of one task, in their order."""
    part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

    def shard(rows):
        nonlocal made
        ids = np.concatenate([r[0] for r in rows])
        dim = max(r[1].shape[1] for r in rows)
        vectors = np.concatenate([np.pad(r[1], ((0, 0), (0, dim - r[1].shape[1]))) for r in rows])
        tree = Tree.build(ids, vectors)
        made += 1
        return batch_of(SHARDS, [part << 24 | made - 1], [len(ids)], [int((ids % every == 0).sum())],
                        *([x] for x in tree.packed()))

    for batch in batches:
        lists = batch.column(1)
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
        values, ids = lists.flatten().to_numpy(zero_copy_only=False), batch.column(0).to_numpy()
        ends = np.cumsum(lengths)
        change = np.flatnonzero(np.diff(lengths)) + 1            # runs of one length
        for a, b in zip([0, *change], [*change, len(ids)]):
            while a < b:
                to = min(b, a + SHARD - size)
                rows = values[ends[a] - lengths[a]:ends[to - 1]].reshape(to - a, lengths[a])
                held.append((ids[a:to].astype(np.int64), rows.astype(np.int64)))
                size, a = size + to - a, to
                if size == SHARD:
                    yield shard(held)
                    held, size = [], 0
    if size:
        yield shard(held)


def _unpack(batch, row):
    get = lambda name: batch.column(batch.schema.get_field_index(name))[row].as_py()
    return Tree.unpack(*(get(c) for c in ("n", "ids", "vectors", "nodes", "centres")))


def _seed(batches, every, k):
    """A shard's queries, each with its k-th best score in that shard."""
    for batch in batches:
        for row in range(batch.num_rows):
            shard, tree = batch.column(0)[row].as_py(), _unpack(batch, row)
            for at in np.array_split(np.flatnonzero(tree.ids % every == 0), 1 + len(tree.ids) // (every * BLOCK)):
                if not len(at):
                    continue
                best = Best(at, tree.ids[at], np.full(len(at), NO_SCORE), tree.vectors[at], k)
                tree.search(best, at)
                yield batch_of(QUERIES, (shard << 13) + at, tree.ids[at], best.score[:, -1],
                               [narrow(v) for v in tree.vectors[at]])


def _blocks(batches):
    part, made, held = TaskContext.get().partitionId(), 0, []

    def block():
        nonlocal made
        made += 1
        vectors = [wide(r[3]) for r in held]
        dim = max(map(len, vectors))
        keys, ids, bounds = (np.array([r[c] for r in held], np.int64).tobytes() for c in range(3))
        packed = narrow(np.stack([np.pad(v, (0, dim - len(v))) for v in vectors]))
        return batch_of(BLOCKS, [part << 24 | made - 1], [keys], [ids], [bounds], [dim], [packed])

    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            held.append(r)
            if len(held) == BLOCK:
                yield block()
                held = []
    if held:
        yield block()


def _search(batches, k):
    """Query blocks against shards, pair by pair; a block's k-th scores are kept from one to the next."""
    blocks: dict[int, Best] = {}
    for batch in batches:
        col = {name: c for name, c in zip(batch.schema.names, batch.columns)}
        for row in range(batch.num_rows):
            get = lambda name: col[name][row].as_py()  # noqa: E731, B023
            block, shard = get("block"), get("shard")
            if block not in blocks:
                keys, ids, bounds = (np.frombuffer(get(c), np.int64) for c in ("keys", "query_ids", "bounds"))
                queries = wide(get("queries")).reshape(len(keys), get("dim"))
                blocks[block] = Best(keys, ids, bounds, queries, k)
            best = blocks[block]
            own = np.where(best.keys >> 13 == shard, best.keys & (SHARD - 1), -1)
            _unpack(batch, row).search(best, own)
    for best in blocks.values():
        yield batch_of(FOUND, *best.rows())


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The k highest integer inner products of each query with all rows but its own.

    ``vectors``: ``vec_id`` and ``embedding`` (array of a floating type); components become
    floor(256 x). Queries are the rows whose vec_id is divisible by ``every``. Returns query_id,
    rank (from 1), vec_id and score; fewer than k where there are fewer rows. Ties go to the
    smaller vec_id. Rows whose vector is null or holds a null or non-finite component, and rows
    without vec_id, take no part. Of vectors of unequal length the shorter counts as padded with
    zeros. Rows that repeat a vec_id are rows of their own: each is a query, and a candidate of
    the others. Scores are 64-bit integers; vectors so large that theirs don't fit are out of range.
    """
    shards = cut_lineage(_integers(vectors).mapInArrow(
        lambda b: _pack(b, every), "shard long, n int, queries long, ids binary, vectors binary, nodes binary, centres binary"),
        "topk-shards")
    n_shards, n_queries = shards.agg(F.count("*"), F.coalesce(F.sum("queries"), F.lit(0))).first()
    groups = max(1, math.ceil(n_shards / GROUP))
    seeded = shards.filter("queries > 0").mapInArrow(
        lambda b: _seed(b, every, k), "key long, id long, bound long, vector binary")
    blocks = cut_lineage(seeded.repartition(max(1, math.ceil(n_queries / BLOCK))).mapInArrow(
        _blocks, "block long, keys binary, query_ids binary, bounds binary, dim int, queries binary"), "topk-queries")
    pairs = (shards.drop("queries").withColumn("group", F.pmod(F.xxhash64("shard"), F.lit(groups)))
             .join(blocks.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))), "group"))
    found = pairs.mapInArrow(lambda b: _search(b, k), "key long, query_id long, vec_id long, score long")
    order = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
