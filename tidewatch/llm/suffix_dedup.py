"""Operator 8: exact substring removal by a distributed merge sort of suffixes.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else too. Not every
suffix is sorted: of every window of WINDOW places the one with the smallest 16-gram hash (the
leftmost of equal ones) is an anchor, so that two equal strings of ``length`` bytes have the same
place of theirs, among the first WINDOW, as an anchor, and it is enough to sort the suffixes at
anchors and to look at the bytes before them.

1. Anchors are hashed over the bytes that such a pair must share, and those whose hash occurs
   once are done with. Anchors with equal surroundings (WINDOW - 1 bytes before, ``length`` from
   there on) are counted, and one of them stands for all.
2. Tasks sort the suffixes of their texts and front-code the runs (the length of the prefix
   shared with the suffix before, then the rest); runs are exchanged by ranges of the key.
   Groups with one kind of surroundings need no sorting: all of these are covered.
3. Loser trees that never compare a known prefix again merge the runs of a range
   (``loser_tree.py``). Neighbours' common prefixes give how far matches reach to the right,
   the bytes before the anchors how far to the left; a match of ``length`` or more makes spans.

A group of suffixes that begin alike and have too many different surroundings for one task is
dealt out by the strings themselves: a group-by over the hashes of its windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.arrow import batch_of, flat, mix64, sliced
from tidewatch.llm.decontaminate import qgrams
from tidewatch.llm.loser_tree import common, merge
from tidewatch.llm.skew import attach
from tidewatch.llm.spans import cut_spans, numbered
from tidewatch.session import cut_lineage

LENGTH, WINDOW, GRAM = 400, 256, 16
#: Suffixes of a run, groups of at most so many are compared in pairs, and different
#: surroundings of a group from which on it is dealt out.
RUN, PAIRS, LARGE = 20_000, 300, 50_000
#: Bytes of suffixes that a range should have.
RANGE_BYTES = 64 << 20
ANCHORS = pa.schema([("row", pa.int64()), ("pos", pa.int32()), ("after", pa.int32()),
                     ("h", pa.int64()), ("c", pa.int64())])
RUNS = pa.schema([("range", pa.int64()), ("run", pa.binary())])
REACH = pa.schema([("id", pa.int64()), ("left", pa.int32()), ("right", pa.int32())])
WINDOWS = pa.schema([("id", pa.int64()), ("offset", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64())])
U = np.uint64


def anchors(data: np.ndarray, off: np.ndarray, length: int, window: int) -> np.ndarray:
    """Places of the anchors of all texts, which lie end to end."""
    x = qgrams(data)
    if len(x) <= GRAM // 2:
        return np.zeros(0, np.int64)
    x = mix64(mix64(x[:-GRAM // 2]) + x[GRAM // 2:])
    bits = U(int(len(data)).bit_length())
    x = (x >> bits << bits) | np.arange(len(x), dtype=U)      # equal hashes: the leftmost
    span = 1
    while span * 2 <= window:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    if span < window:
        x = np.minimum(x[:-(window - span)], x[window - span:])
    place = (x & ((U(1) << bits) - U(1))).astype(np.int64)
    n = np.diff(off)
    begins = np.zeros(len(data) + 1, np.int8)                 # strings that stay inside a text
    some = n >= length
    begins[off[:-1][some]] += 1
    begins[off[1:][some] - length + 1] -= 1
    inside = np.flatnonzero(np.cumsum(begins)[:len(place)])
    return np.unique(place[inside])


def _anchor_rows(rows: DataFrame, length: int, window: int) -> DataFrame:
    sure = length - window + 1                                # bytes that a pair shares from the anchor on

    def find(batches):
        for batch in sliced(batches, "text"):
            data, off = flat(batch.column(1))
            at = anchors(data, off, length, window)
            if not len(at):
                continue
            doc = np.searchsorted(off, at, "right") - 1
            text, digest = data.tobytes(), hashlib.blake2b
            h, c = [], []
            for p, a, b in zip(at.tolist(), off[doc].tolist(), off[doc + 1].tolist()):
                h.append(digest(text[p:p + sure], digest_size=8).digest())
                start = max(a, p - window + 1)
                whole = text[start:min(b, p + length)]
                c.append(digest(whole, digest_size=8, salt=(p - start).to_bytes(4, "little")).digest())
            row = batch.column(0).to_numpy()[doc]
            after = np.minimum(off[doc + 1] - at, length)
            yield batch_of(ANCHORS, row, (at - off[doc]).astype(np.int32), after.astype(np.int32),
                           np.frombuffer(b"".join(h), np.int64), np.frombuffer(b"".join(c), np.int64))

    return rows.select("row", "text").mapInArrow(find, "row long, pos int, after int, h long, c long")


def _surroundings(rows: DataFrame, some: DataFrame) -> DataFrame:
    """Texts with the anchors of ``some`` in them: text, anchors (pos, id, h, n)."""
    gathered = some.groupBy("row").agg(F.collect_list(F.struct("pos", "id", "h", "n")).alias("anchors"))
    return rows.join(gathered, "row").select("text", "anchors")


def _each(batch, length, window):
    for text, found in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
        for a in found:
            p = a["pos"]
            yield a, text[max(0, p - window + 1):p], text[p:p + length]


def front_coded(items: list[tuple[bytes, bytes, int, int]]) -> bytes:
    """A sorted run of (key, bytes before, id, count) as one value."""
    shared = [0, *(common(a[0], b[0]) for a, b in zip(items, items[1:]))]
    rests = [key[s:] for s, (key, *_) in zip(shared, items)]
    numbers = np.array([shared, list(map(len, rests)), [len(i[1]) for i in items], [i[2] for i in items],
                        [i[3] for i in items]], np.int64)
    body = b"".join(rests) + b"".join(i[1] for i in items)
    return zstandard.compress(len(items).to_bytes(4, "little") + numbers.tobytes() + body, 3)


def decoded(run: bytes) -> list[tuple[int, bytes, tuple[bytes, int, int]]]:
    """What ``merge`` takes: (shared prefix, key, (bytes before, id, count))."""
    raw = zstandard.decompress(run)
    n = int.from_bytes(raw[:4], "little")
    shared, rest, before, ids, counts = np.frombuffer(raw, np.int64, 5 * n, 4).reshape(5, n).tolist()
    at = 4 + 40 * n
    lefts, out, key = at + sum(rest), [], b""
    for s, r, b, i, c in zip(shared, rest, before, ids, counts):
        key = key[:s] + raw[at:at + r]
        at += r
        out.append((s, key, (raw[lefts:lefts + b], i, c)))
        lefts += b
    return out


def _exchanged(texts: DataFrame, ranges: int, length: int, window: int) -> DataFrame:
    """Sorted, front-coded runs of suffixes, by range of the key (hash, then suffix)."""
    def cut(items):
        items.sort()
        begin = 0
        bucket = [int.from_bytes(i[0][:8]) * ranges >> 64 for i in items]
        for k in range(1, len(items) + 1):
            if k == len(items) or bucket[k] != bucket[begin]:
                yield batch_of(RUNS, [bucket[begin]], [front_coded(items[begin:k])])
                begin = k

    def run(batches):
        items = []
        for batch in sliced(batches, "text"):
            for a, before, suffix in _each(batch, length, window):
                items.append(((a["h"] + 2**63).to_bytes(8) + suffix, before, a["id"], min(a["n"], 2)))
                if len(items) == RUN:
                    yield from cut(items)
                    items = []
        yield from cut(items)

    return texts.mapInArrow(run, "range long, run binary")


def reach(group: list[tuple[int, bytes, bytes, int]], length: int) -> list[tuple[int, int]]:
    """How far before and after its anchor each suffix of a group is covered, (0, 0) if not at all.

    ``group``: (prefix shared with the suffix before, suffix, bytes before the anchor, count) in
    the order of the suffixes. A pair that agrees on l bytes before and r bytes after covers l and r if l + r
    is at least ``length``.
    """
    n = len(group)
    size = np.array([len(b) for _, _, b, _ in group])
    several = np.array([count > 1 for *_, count in group])
    left = np.where(several, size, 0)
    right = np.where(several, [len(s) for _, s, _, _ in group], 0)
    if n > 1:
        shared = np.minimum([g[0] for g in group], length)
        before = np.zeros((n, max(int(size.max()), 1)), np.uint8)     # from the anchor backwards
        for k, (_, _, b, _) in enumerate(group):
            before[k, :len(b)] = np.frombuffer(b, np.uint8)[::-1]
        (_pairs if n <= PAIRS else _blocks)(shared, before, size, length, left, right)
    return list(zip(left.tolist(), right.tolist()))


def _alike(a: np.ndarray, m: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many bytes rows of ``a`` (m of them filled) and ``b`` (n) share from the front."""
    differ = a != b
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), differ.shape[1])
    return np.minimum(first, np.minimum(m, n))


def _pairs(shared, before, size, length, left, right):
    """Each suffix with all that follow it in its group."""
    for i in range(len(size) - 1):
        r = np.minimum.accumulate(shared[i + 1:])
        both = _alike(before[i], size[i], before[i + 1:], size[i + 1:])
        hit = np.flatnonzero(r + both >= length)
        if len(hit):
            j, r, both = hit + i + 1, r[hit], both[hit]
            left[j], right[j] = np.maximum(left[j], both), np.maximum(right[j], r)
            left[i], right[i] = max(left[i], both.max()), max(right[i], r.max())


def _blocks(shared, before, size, length, left, right):
    """The same by offset of the string's start, for groups with too many pairs.

    At an offset, suffixes that share length - offset bytes are a block of neighbours in their
    own order, and those with equal bytes before are one in the order of these; a suffix is
    covered if both its blocks hold another one too. Offsets between which no block
    changes are taken together.
    """
    order = np.lexsort((size, *before.T[::-1]))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    a, n = before[order], size[order]
    alike = np.concatenate([[0], _alike(a[:-1], n[:-1], a[1:], n[1:])])
    widest = int(size.max())
    turns = np.unique(np.concatenate([[0], length - shared, alike + 1, size + 1]))
    turns = turns[(turns >= 0) & (turns <= widest)]
    for first, last in zip(turns.tolist(), [*(turns[1:] - 1).tolist(), widest]):
        far = np.flatnonzero(size >= first)
        block = np.cumsum(shared < length - first)[far] * (len(size) + 1) + np.cumsum(alike < first)[rank[far]]
        _, of, counts = np.unique(block, return_inverse=True, return_counts=True)
        hit = far[counts[of] > 1]
        left[hit] = np.maximum(left[hit], last)
        right[hit] = np.maximum(right[hit], length - first)


def _merged(runs: DataFrame, length: int, window: int) -> DataFrame:
    """id, left and right of every suffix that is covered at all."""
    sure = 8 + length - window + 1

    def covered(runs_):
        group, ids = [], []

        def done():
            return [(i, a, b) for i, (a, b) in zip(ids, reach(group, length)) if a + b >= length]

        for shared, key, (before, i, count) in merge([decoded(r) for r in runs_]):
            if shared < sure and group:
                yield from done()
                group, ids = [], []
            group.append((max(0, shared - 8), key[8:], before, count))
            ids.append(i)
        if group:
            yield from done()

    def run(batches):
        number, runs_ = None, []
        for batch in batches:
            for r, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if r != number and runs_:
                    yield from out(runs_)
                    runs_ = []
                number = r
                runs_.append(blob)
        if runs_:
            yield from out(runs_)

    def out(runs_):
        found = list(covered(runs_))
        if found:
            yield batch_of(REACH, *map(list, zip(*found)))

    return (runs.repartition("range").sortWithinPartitions("range")
            .mapInArrow(run, "id long, left int, right int"))


def _dealt(texts: DataFrame, length: int, window: int) -> DataFrame:
    """The same for large groups: their strings, by hash, in a group-by."""
    def strings(batches):
        for batch in sliced(batches, "text", 1 << 16):
            ids, offsets, hashes = [], [], []
            for a, before, suffix in _each(batch, length, window):
                whole, p, group = before + suffix, len(before), a["h"].to_bytes(8, signed=True)
                for offset in range(max(0, length - len(suffix)), p + 1):
                    at = p - offset
                    ids.append(a["id"])
                    offsets.append(offset)
                    # with the place of the anchor: strings at two anchors of one place don't meet
                    salt = group + offset.to_bytes(4)
                    hashes.append(hashlib.blake2b(whole[at:at + length], digest_size=16, salt=salt).digest())
            w = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            yield batch_of(WINDOWS, ids, offsets, w[:, 0], w[:, 1])

    found = cut_lineage(texts.mapInArrow(strings, "id long, offset int, w1 long, w2 long"), "suffix-strings")
    keys = ["w1", "w2"]
    twice = cut_lineage(found.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1"), "suffix-repeats")
    return (attach(found, twice, keys).groupBy("id")
            .agg(F.max("offset").alias("left"), (F.lit(length) - F.min("offset")).cast("int").alias("right")))


def covered_spans(rows: DataFrame, length: int = LENGTH, window: int = WINDOW, large: int = LARGE) -> DataFrame:
    """row, start and length of spans that together are the bytes to remove."""
    found = cut_lineage(_anchor_rows(rows, length, window).withColumn("at", F.monotonically_increasing_id()), "anchors")
    shared = cut_lineage(found.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"), "anchor-hashes")
    some = cut_lineage(attach(found, shared, ["h"]), "anchor-repeats")
    same = cut_lineage(some.groupBy("h", "c").agg(F.count("*").alias("n"), F.min("at").alias("id")), "surroundings")
    groups = cut_lineage(same.groupBy("h").agg(F.count("*").alias("n")).withColumn("kinds", F.col("n")), "suffix-groups")
    # one anchor for each of the surroundings, with the number of kinds in its group
    heads = some.join(same.select(F.col("id").alias("at"), "n"), "at").withColumnRenamed("at", "id")
    heads = attach(heads.withColumnRenamed("n", "copies"), groups, ["h"]).withColumnRenamed("copies", "n")
    heads = cut_lineage(heads.select("row", "pos", "after", "id", "h", "n", "kinds"), "suffix-heads")
    sorted_ = (F.col("kinds") > 1) & (F.col("kinds") <= large)
    total = heads.filter(sorted_).count()
    ranges = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), total * (length + window) // RANGE_BYTES)
    runs = _exchanged(_surroundings(rows, heads.filter(sorted_)), ranges, length, window)
    # copies of the same surroundings cover all of these, whatever else is in their group
    copied = heads.filter(~sorted_ & (F.col("n") > 1)).select(
        "id", F.least("pos", F.lit(window - 1)).cast("int").alias("left"), F.col("after").alias("right"))
    reaches = _merged(runs, length, window).unionAll(copied)
    big = heads.filter(F.col("kinds") > large)
    if not big.isEmpty():
        reaches = reaches.unionAll(_dealt(_surroundings(rows, big), length, window)).groupBy("id").agg(
            F.max("left").alias("left"), F.max("right").alias("right"))
    of_kind = same.join(cut_lineage(reaches, "reaches"), "id").select("h", "c", "n", "left", "right")
    anchors_ = attach(some, cut_lineage(of_kind, "kind-reaches"), ["h", "c"])
    return anchors_.select("row", (F.col("pos") - F.col("left")).alias("start"), (F.col("left") + F.col("right")).alias("length"))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, window: int = WINDOW, large: int = LARGE) -> DataFrame:
    """Texts without the bytes that a string of ``length`` bytes covers which starts elsewhere too.

    ``docs``: doc_id and text, taken as UTF-8 bytes (null: empty). All occurrences go, in one
    text or several, judged on the input; matches never cross texts. Returns for each row
    doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (the remaining bytes).
    Texts shorter than ``length`` stay as they are; repeated rows of that length or more lose
    everything; an empty table gives no rows.
    """
    rows = numbered(docs)
    return cut_spans(rows, covered_spans(rows, length, window, large)).drop("row")
