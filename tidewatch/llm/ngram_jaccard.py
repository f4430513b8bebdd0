"""Operator 4: n-gram Jaccard join by chosen paths.

Texts with equal sets of word 5-grams form a class; one row stands for each. A set is embedded
as ``COORDINATES`` minhash tokens. In each run, sets are split recursively: a bucket's name
decides by hashing which coordinate(s) split it (1 / threshold of them on average), and sets
with the same token there share a child. A bucket of up to ``BUCKET`` sets is compared by brute
force on small sketches; larger ones are split again, and what is still large after ``DEPTH``
levels is compared block by block. Similar pairs follow a common path to the end with a
probability that the branching process gives; runs are repeated until a pair is met in some run
with the target recall. All runs go through Spark together.

Candidates link sets into groups, which only have to be connected: within a group, *all* pairs
are verified exactly, block by block, so a link is found even if no run met its own pair.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.arrow import batch_of, flat, mix64, ranges, sliced, starts_of, whole_groups
from tidewatch.llm.components import components
from tidewatch.llm.skew import attach
from tidewatch.llm.spans import numbered
from tidewatch.session import cut_lineage

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9999
COORDINATES, BUCKET, DEPTH, BLOCK = 64, 256, 4, 256
#: Sets of a block where a bucket that is still large after DEPTH levels is compared in blocks.
LAST_BLOCK = 1024
#: Equal sketch bytes from which two sets are candidates: at the threshold, 51 of 64 are equal
#: on average with a deviation of 3.2, so a similar pair falls short with a chance of 1e-4.
AGREE = 39
SETS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("hash", pa.int64()), ("n", pa.int64()),
                  ("k1", pa.int64()), ("k2", pa.int64()), ("tokens", pa.binary()), ("sketch", pa.binary())])
PATHS = pa.schema([("path", pa.int64()), ("rep", pa.int64())])
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
MEMBERS = pa.schema([("rep", pa.int64()), ("comp", pa.int64()), ("size", pa.int64()), ("weight", pa.int64()),
                     ("grams", pa.binary())])
LINKS = pa.schema([("rep", pa.int64()), ("label", pa.int64()), ("links", pa.int64())])

U = np.uint64
IS_WORD = np.zeros(256, bool)
IS_WORD[128:] = True
IS_WORD[[*b"abcdefghijklmnopqrstuvwxyz0123456789_"]] = True
MULTIPLY = mix64(np.arange(1, 65, dtype=U)) | U(1)


def run_count(threshold: float = THRESHOLD, depth: int = DEPTH, recall: float = RECALL) -> int:
    """Runs after which a pair at the threshold has shared a path to ``depth`` with ``recall``."""
    more = 1 / threshold - 1                  # chance that a bucket is split by a second coordinate
    lost = 0.0
    for _ in range(depth):
        one = 1 - threshold + threshold * lost
        lost = (1 - more) * one + more * one * one
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost)))


def grams(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the word n-grams of each text, sorted, each once; and offsets.

    Words are runs of ASCII letters, digits, underscores and non-ASCII characters of the lower
    case text. Fewer words than ``words`` make one n-gram of them all; no word makes none.
    """
    data, off = flat(pa.compute.utf8_lower(texts))
    word = IS_WORD[data]
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    at = off[:-1]
    before[at[at < len(data)]] = False
    begin = np.flatnonzero(word & ~before)
    inside = np.flatnonzero(word)
    of = np.cumsum((word & ~before)[inside]) - 1
    hashes = np.zeros(0, U)
    if len(begin):
        place = (inside - begin[of]).astype(U)
        hashes = np.add.reduceat(mix64(place << U(8) | data[inside].astype(U)), np.searchsorted(inside, begin))
        hashes = mix64(hashes)
    edges = np.searchsorted(begin, off)
    out, ends = [], [0]
    full = np.zeros(max(0, len(hashes) - words + 1), U)
    for k in range(words):
        full += hashes[k:k + len(full)] * (MULTIPLY[k])
    full = mix64(full)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b - a >= words:
            own = np.unique(full[a:b - words + 1])
        elif b > a:
            own = mix64(np.array([(hashes[a:b] * MULTIPLY[32:32 + b - a]).sum()], U))
        else:
            own = full[:0]
        out.append(own)
        ends.append(ends[-1] + len(own))
    return (np.concatenate(out) if out else full[:0]), np.array(ends)


def sets_of(rows: DataFrame, words: int) -> DataFrame:
    """Per row: its text's hash, the size of its set, 128 bits that name the set, its minhash tokens, a sketch."""
    def run(batches):
        for batch in sliced(batches, "text"):
            hashes, ends = grams(batch.column(3), words)
            n = np.diff(ends)
            some = np.flatnonzero(n)
            tokens = np.zeros((len(n), COORDINATES), np.uint32)
            k1, k2 = np.zeros(len(n), U), np.zeros(len(n), U)
            if len(some):
                starts = ends[:-1][some]
                k1[some] = np.add.reduceat(mix64(hashes ^ MULTIPLY[40]), starts)
                k2[some] = np.add.reduceat(mix64(hashes ^ MULTIPLY[41]), starts)
                for c in range(COORDINATES):
                    tokens[some, c] = np.minimum.reduceat(hashes * MULTIPLY[c], starts) >> U(32)
            small = (tokens >> np.uint32(4)).astype(np.uint8)
            yield batch_of(SETS, *batch.columns[:3], n, k1.view(np.int64), k2.view(np.int64),
                           [t.tobytes() for t in tokens], [t.tobytes() for t in small])

    hashed = rows.select("row", "doc_id", F.xxhash64("text").alias("hash"), "text")
    return hashed.mapInArrow(
        run, "row long, doc_id long, hash long, n long, k1 long, k2 long, tokens binary, sketch binary")


def children(path: np.ndarray, tokens: np.ndarray, more: float) -> tuple[np.ndarray, np.ndarray]:
    """Names of the child buckets that each row goes to, and the row of each."""
    seed = mix64(path.view(U))
    second = np.flatnonzero((mix64(seed ^ MULTIPLY[50]) >> U(11)).astype(np.float64) / 2**53 < more)
    names = []
    for k, who in ((0, np.arange(len(path))), (1, second)):
        pick = mix64(seed[who] ^ MULTIPLY[51 + k])
        coordinate = (pick % U(COORDINATES)).astype(np.int64)
        token = tokens[who, coordinate].astype(U)
        names.append((mix64(pick ^ mix64(token << U(8) | coordinate.astype(U))).view(np.int64), who))
    return np.concatenate([n for n, _ in names]), np.concatenate([w for _, w in names])


def _split(rows: DataFrame, threshold: float, runs: int = 0) -> DataFrame:
    """path and rep of the next level. ``rows``: rep, tokens and, but for the first level, path."""
    more = 1 / threshold - 1

    def run(batches):
        for batch in batches:
            rep = batch.column(0).to_numpy()
            if not len(rep):
                continue
            tokens = np.frombuffer(flat(batch.column(1))[0], np.uint32).reshape(len(rep), -1)
            paths = [np.full(len(rep), r, np.int64) for r in range(runs)] if runs else [batch.column(2).to_numpy()]
            for path in paths:
                names, who = children(path, tokens, more)
                yield batch_of(PATHS, names, rep[who])

    return rows.mapInArrow(run, "path long, rep long")


def labels_in(near: np.ndarray) -> np.ndarray:
    """The smallest index that each index is connected with, by a matrix of neighbours."""
    label = np.arange(len(near))
    while True:
        new = np.where(near, label, len(near)).min(axis=1)
        new = np.minimum(new, label)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _across(near: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Labels that join what two blocks have in common: the first set of each block's components
    gets the first set that it is connected with; all others get themselves. Links inside a block
    are found where that block is compared with itself."""
    same = side[:, None] == side
    inside = labels_in(near & same)
    a, b = np.nonzero(near & ~same)
    between = np.zeros(near.shape, bool)
    between[inside[a], inside[b]] = True
    return labels_in(between)


def _compare(buckets: DataFrame) -> DataFrame:
    """Brute force in buckets (path, side, rep, n, sketch): each set is linked with the first of
    the candidates that it is connected with; ``side`` as ``_blocks`` gives it."""
    def run(batches):
        for table in whole_groups(batches, "path"):
            path, rep, n = (table.column(k).to_numpy() for k in (0, 2, 3))
            side = table.column(1).fill_null(-1).to_numpy()
            sketch = np.frombuffer(flat(table.column(4).combine_chunks())[0], np.uint8).reshape(len(rep), -1)
            cuts, out = starts_of(path), []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if b - a < 2:
                    continue
                s, size = sketch[a:b], n[a:b].astype(np.float64)
                near = np.empty((b - a, b - a), bool)
                for k in range(0, b - a, 64):
                    near[k:k + 64] = (s[k:k + 64, None] == s[None]).sum(axis=2, dtype=np.uint8) >= AGREE
                near &= np.minimum(size[:, None], size) >= THRESHOLD * np.maximum(size[:, None], size) - 1e-9
                label = labels_in(near) if side[a] < 0 else _across(near, side[a:b])
                linked = np.flatnonzero(label != np.arange(b - a))
                if len(linked):
                    out.append((rep[a:b][linked], rep[a:b][label[linked]]))
            if out:
                yield batch_of(EDGES, *(np.concatenate(x) for x in zip(*out)))

    return buckets.repartition("path").sortWithinPartitions("path").mapInArrow(run, "a long, b long")


def _blocks(rows: DataFrame, key: str, size: str, block: int) -> DataFrame:
    """Rows of keys with more than ``block`` rows, once for each pair of their key's blocks that
    their own is in: group, side (0 or 1; None if both are one block), and the columns."""
    n = F.ceil(F.col(size) / block)
    own = F.pmod(F.xxhash64("rep", key), n)
    other = F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))
    out = rows.withColumn("own", own).withColumn("other", other)
    pair = [F.col(key), F.least("own", "other"), F.greatest("own", "other")]
    side = F.when(F.col("own") != F.col("other"), (F.col("own") > F.col("other")).cast("int"))
    return out.withColumn("group", F.xxhash64(*pair)).withColumn("side", side).drop("own", "other")


def candidates(sets: DataFrame, threshold: float, recall: float) -> DataFrame:
    """Edges (a, b) that connect all similar sets. ``sets``: rep, n, tokens, sketch (a table)."""
    found = []
    slim = sets.select("rep", "n", "sketch")
    level = _split(sets.select("rep", "tokens"), threshold, run_count(threshold, DEPTH, recall))
    for depth in range(1, DEPTH + 1):
        level = cut_lineage(level, "paths")
        shared = cut_lineage(level.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1"), "path-sizes")
        closed = attach(level, shared.filter(F.col("n") <= BUCKET), ["path"])
        found.append(cut_lineage(_compare(closed.join(slim, "rep").select(
            "path", F.lit(None).cast("int").alias("side"), "rep", "n", "sketch")), "links"))
        large = shared.filter(F.col("n") > BUCKET)
        if large.isEmpty():
            break
        open_ = attach(level, large.withColumn("size", F.col("n")), ["path"])
        if depth < DEPTH:
            level = _split(open_.join(sets.select("rep", "tokens"), "rep").select("rep", "tokens", "path"), threshold)
        else:
            parts = _blocks(open_, "path", "size", LAST_BLOCK).select(F.col("group").alias("path"), "side", "rep")
            found.append(_compare(parts.join(slim, "rep").select("path", "side", "rep", "n", "sketch")))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def _member_sets(rows: DataFrame, words: int) -> DataFrame:
    def run(batches):
        for batch in sliced(batches, "text"):
            hashes, ends = grams(batch.column(4), words)
            yield batch_of(MEMBERS, *batch.columns[:4],
                           [hashes[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])])

    return rows.mapInArrow(run, "rep long, comp long, size long, weight long, grams binary")


def similar(hashes: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of the sets reach the threshold with which, exactly."""
    n = np.array([len(h) for h in hashes])
    of = np.repeat(np.arange(len(n)), n)
    values, token, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    often = counts > 1
    number = np.cumsum(often) - 1
    keep = often[token]
    token, of = number[token[keep]], of[keep]
    both = np.zeros((len(n), len(n)), np.float64)
    width = 1 << 14
    for low in range(0, int(often.sum()), width):
        here = (token >= low) & (token < low + width)
        part = np.zeros((len(n), min(width, int(often.sum()) - low)), np.float32)
        part[of[here], token[here] - low] = 1
        both += part @ part.T
    out = both >= threshold * (n[:, None] + n - both) - 1e-9
    np.fill_diagonal(out, False)
    return out


def _verify(groups: DataFrame, threshold: float) -> DataFrame:
    """Per group and set: what the sets that it is similar to weigh, and a set it is connected with.
    ``groups``: group, side, rep, weight, grams."""
    def run(batches):
        for table in whole_groups(batches, "group", 2000):
            group, rep, weight = (table.column(k).to_numpy() for k in (0, 2, 3))
            side = table.column(1).fill_null(-1).to_numpy()
            data, off = flat(table.column(4).combine_chunks())
            hashes = data.view(U)
            cuts, out = starts_of(group), []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if b - a < 2:
                    continue
                near = similar([hashes[off[k] // 8:off[k + 1] // 8] for k in range(a, b)], threshold)
                s = side[a:b]
                near &= (s[:, None] != s) | (s[:, None] < 0)      # of two blocks, pairs across
                if near.any():
                    some = np.flatnonzero(near.any(axis=1))
                    out.append((rep[a:b][some], rep[a:b][labels_in(near)[some]], (near @ weight[a:b])[some]))
            if out:
                yield batch_of(LINKS, *(np.concatenate(x) for x in zip(*out)))

    return (groups.repartition("group").sortWithinPartitions("group")
            .mapInArrow(run, "rep long, label long, links long"))


def jaccard_classes(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD,
                    recall: float = RECALL) -> DataFrame:
    """Near-duplicate classes by the Jaccard similarity of word n-gram sets.

    ``docs``: doc_id and text. Returns for each row: row (its number in the table), doc_id,
    class_row and class_id (row and doc_id of the first row of its class, by doc_id, then the
    text's hash; classes are what links connect) and n_links (the number of other rows at the
    threshold or above). Rows with equal sets are linked; a text without any word (null, empty) is alone in its class. Repeated
    rows are rows of their own; an empty table gives no rows.
    """
    rows = numbered(docs)
    sets = cut_lineage(sets_of(rows, words), "sets")
    keys = ["k1", "k2", "n"]
    same = cut_lineage(sets.filter("n > 0").groupBy(*keys, "tokens", "sketch").agg(
        F.min("row").alias("rep"), F.count("*").alias("weight")), "set-classes")
    links = cut_lineage(components(candidates(same.select("rep", "n", "tokens", "sketch"), threshold, recall)), "groups")
    sizes = links.groupBy("label").agg(F.count("*").alias("n"))
    members = attach(links, cut_lineage(sizes.withColumn("size", F.col("n")), "group-sizes"), ["label"])
    members = members.join(same.select(F.col("rep").alias("node"), "weight"), "node")
    texts = members.join(rows.select(F.col("row").alias("node"), "text"), "node")
    grams_ = _member_sets(texts.select(F.col("node").alias("rep"), F.col("label").alias("comp"), "size", "weight", "text"), words)
    pairs = _blocks(grams_, "comp", "size", BLOCK).select("group", "side", "rep", "weight", "grams")
    verified = cut_lineage(_verify(pairs, threshold), "verified")
    counts = verified.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(verified.select(F.col("rep").alias("a"), F.col("label").alias("b")))
    of_rep = counts.join(classes.withColumnRenamed("node", "rep"), "rep", "left")
    of_set = cut_lineage(
        same.select(*keys, "rep", "weight").join(of_rep, "rep", "left")
        .select(*keys, "weight", F.coalesce("label", "rep").alias("class_row"),
                (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "set-links")
    slim = sets.select("row", "doc_id", "hash", *keys)
    linked = attach(slim, of_set.withColumnRenamed("weight", "copies"), keys, "copies")
    alone = slim.filter("n = 0").select("row", "doc_id", "hash", F.col("row").alias("class_row"),
                                        F.lit(0).cast("long").alias("n_links"))
    placed = cut_lineage(linked.select(*alone.columns).unionAll(alone), "class-rows")
    # row numbers follow the scan's splits, so the first of a class is named by what its row holds
    order = F.struct("doc_id", "hash", "row")
    heads = placed.groupBy("class_row").agg(F.count("*").alias("n"), F.min(order).alias("head"))
    return attach(placed, cut_lineage(heads, "class-heads"), ["class_row"]).select(
        "row", "doc_id", F.col("head.row").alias("class_row"), F.col("head.doc_id").alias("class_id"), "n_links")
