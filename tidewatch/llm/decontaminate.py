"""Operator 2: benchmark decontamination by the q-gram lemma and banded alignment.

An item of n characters that occurs in a text with at most k edits shares at least
n + 1 - Q - k Q of its q-grams with it, and those lie on diagonals (place in the text less
place in the item) within k of each other. So shared q-grams are counted in overlapping bands
of 2 (k + 1) diagonals, and only where a band reaches the bound its region is aligned, inside
the band. Q-grams that are frequent in the benchmark are left out of the count, each lowering
the bound by one, which keeps the filter exact.

The benchmark goes to the tasks in blocks of bounded size, one pass over the documents for each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.arrow import batch_of, flat, mix64, ranges, sliced
from tidewatch.llm.spans import numbered

Q, EDITS = 8, 0.1
#: Shared q-grams that a band must have at least; the edit budget of short items follows from it.
LEAST = 4
#: Q-grams that more places of the benchmark have may be left out.
FREQUENT = 3
#: Normalised bytes of benchmark items that go to the tasks at once.
BLOCK_BYTES = 1 << 20
BITS = 22
HITS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()),
                  ("end", pa.int64()), ("edits", pa.int32())])

#: Letters in lower case, digits and bytes of other characters as they are; the rest is a blank.
FOLD = np.full(256, 32, np.uint8)
FOLD[128:] = np.arange(128, 256)
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789":
    FOLD[_c] = _c
for _c in range(ord("A"), ord("Z") + 1):
    FOLD[_c] = _c + 32


def normal(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes with blanks run together, texts' offsets in them, and where each byte was."""
    folded = FOLD[data]
    blank = folded == 32
    drop = np.zeros(len(data), bool)
    drop[1:] = blank[1:] & blank[:-1]
    first = off[:-1][off[:-1] < len(data)]
    drop[first] = blank[first]                       # none at the start of a text
    place = np.flatnonzero(~drop)
    return folded[place], np.searchsorted(place, off), place


def qgrams(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as one integer."""
    x = text.astype(np.uint64)
    for step in (1, 2, 4):
        if len(x) <= step:
            return np.zeros(0, np.uint64)
        x = x[:-step] | x[step:] << np.uint64(8 * step)
    return x


def budget(n: int, edits: float = EDITS) -> int:
    """Edits allowed in an item of n normalised bytes."""
    return max(0, min(math.floor(edits * n), (n + 1 - Q - LEAST) // Q))


class Index:
    """Q-grams of the items of a block, and for each the items and places that have it."""

    def __init__(self, items: list[tuple[int, bytes]], edits: float):
        self.ids = np.array([i for i, _ in items], np.int64)
        self.texts = [np.frombuffer(t, np.uint8) for _, t in items]
        self.size = np.array([len(t) for t in self.texts], np.int64)
        self.budget = np.array([budget(n, edits) for n in self.size], np.int64)
        per_item = [qgrams(t) for t in self.texts]
        all_, counts = np.unique(np.concatenate(per_item), return_counts=True)
        need = np.maximum(1, self.size + 1 - Q - self.budget * Q)
        grams, item, place = [], [], []
        for k, x in enumerate(per_item):
            often = counts[np.searchsorted(all_, x)]
            order = np.argsort(-often, kind="stable")
            spare = max(0, int(need[k]) - LEAST)
            left_out = order[:spare][often[order[:spare]] > FREQUENT]
            need[k] -= len(left_out)
            keep = np.setdiff1d(np.arange(len(x)), left_out)
            grams.append(x[keep])
            item.append(np.full(len(keep), k))
            place.append(keep)
        grams, self.item, self.place = (np.concatenate(x) for x in (grams, item, place))
        order = np.argsort(grams, kind="stable")
        self.item, self.place, self.need = self.item[order], self.place[order], need
        self.grams, self.first, self.count = np.unique(grams[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << BITS, bool)
        self.table[self._slot(self.grams)] = True

    @staticmethod
    def _slot(x):
        return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)

    def regions(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Item and first diagonal of every band that has enough shared q-grams."""
        x = qgrams(text)
        at = np.flatnonzero(self.table[self._slot(x)])
        found = np.searchsorted(self.grams, x[at])
        found = np.minimum(found, len(self.grams) - 1)
        hit = self.grams[found] == x[at]
        at, found = at[hit], found[hit]
        posting = ranges(self.first[found], self.count[found])
        item = self.item[posting]
        step = self.budget[item] + 1
        shift = int(self.size.max(initial=0)) + 1          # keeps diagonals positive
        band = (np.repeat(at, self.count[found]) - self.place[posting] + shift) // step
        span = (len(text) + shift) // 1 + 2
        keys, counts = np.unique(np.concatenate([item * span + band, item * span + band - 1]), return_counts=True)
        item, band = keys // span, keys % span
        good = counts >= self.need[item]
        item, band = item[good], band[good]
        return item, band * (self.budget[item] + 1) - shift


def align(item: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Edit distances of ``item`` to pieces of each row of ``texts``, by the diagonal they end on.

    Row r, column c of the result: the fewest edits between the item and a piece of texts[r]
    that ends at len(item) + c, over paths that stay within the band of diagonals 0 to
    texts.shape[1] - len(item). A 0 byte in ``texts`` matches nothing.
    """
    n, width = len(item), texts.shape[1] - len(item) + 1
    d = np.zeros((len(texts), width), np.int32)
    across = np.arange(width, dtype=np.int32)
    for i in range(n):
        now = d + (texts[:, i:i + width] != item[i])
        now[:, :-1] = np.minimum(now[:, :-1], d[:, 1:] + 1)
        d = np.minimum.accumulate(now - across, axis=1) + across
    return d


def _padded(text: np.ndarray, start: int, end: int, low: int, high: int) -> np.ndarray:
    out = np.zeros(end - start, np.uint8)
    a, b = max(start, low), min(end, high)
    if b > a:
        out[a - start:b - start] = text[a:b]
    return out


def occurrences(index: Index, text: np.ndarray, off: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(text number, item number) -> (edits, start, end) of the item's best occurrence there, the
    first of equally good ones; texts lie end to end, cut at ``off``."""
    item, diagonal = index.regions(text)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for k in np.unique(item).tolist():
        n, edits, pattern = int(index.size[k]), int(index.budget[k]), index.texts[k]
        low = diagonal[item == k] - edits
        high = low + 2 * (edits + 1) + 2 * edits + n
        first = np.maximum(np.searchsorted(off, np.maximum(low, 0), "right") - 1, 0)
        last = np.searchsorted(off, high, "left")
        todo = sorted({(doc, a, b) for a, b, x, y in zip(low.tolist(), high.tolist(), first.tolist(), last.tolist())
                       for doc in range(x, min(y, len(off) - 1)) if off[doc + 1] > off[doc]})
        raw, rest = pattern.tobytes(), []
        for doc, a, b in todo:
            x, y = max(a, int(off[doc])), min(b, int(off[doc + 1]))
            at = text[x:y].tobytes().find(raw)
            if at >= 0:                                        # as it is: nothing to align
                at += x - int(off[doc])
                best[doc, k] = min(best.get((doc, k), (edits + 1, 0, 0)), (0, at, at + n))
            else:
                rest.append((doc, a, b))
        rest = [r for r in rest if best.get((r[0], k), (1,))[0] > 0]
        for at in range(0, len(rest), 256):
            part = rest[at:at + 256]
            rows = np.stack([_padded(text, a, b, off[doc], off[doc + 1]) for doc, a, b in part])
            distance = align(pattern, rows)
            for r in np.flatnonzero(distance.min(axis=1) <= edits).tolist():
                doc, a, _ = part[r]
                c, cost = int(distance[r].argmin()), int(distance[r].min())
                end = a + n + c
                # the same from the end backwards gives the start
                back = _padded(text, end - n - cost, end, off[doc], off[doc + 1])[::-1]
                back = np.concatenate([back, np.zeros(cost, np.uint8)])
                start = end - _length(pattern[::-1], back, cost)
                here = (cost, max(start, int(off[doc])) - int(off[doc]), min(end, int(off[doc + 1])) - int(off[doc]))
                best[doc, k] = min(best.get((doc, k), here), here)
    return best


def _length(pattern: np.ndarray, text: np.ndarray, cost: int) -> int:
    """The length of the shortest prefix of ``text`` at edit distance ``cost`` from ``pattern``."""
    d = np.arange(len(text) + 1)
    across = np.arange(len(text) + 1)
    for i, c in enumerate(pattern.tolist()):
        now = np.empty_like(d)
        now[0] = i + 1
        now[1:] = np.minimum(d[:-1] + (text != c), d[1:] + 1)
        d = np.minimum.accumulate(now - across) + across
    return int(np.argmax(d <= cost))


def contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Occurrences of benchmark items in documents.

    ``docs``: doc_id and text; ``benchmark``: item_id and text. Texts are compared in lower case
    (ASCII), everything but letters and digits counting as a blank and blanks run together. An
    item of n such bytes may differ by ``budget(n)`` edits (a tenth of n; less below 55).
    Returns for each row of ``docs`` and each item in it the best occurrence, the first of equal
    ones: row, doc_id, item_id, start and end (bytes of the text), edits. Null and empty texts
    have none; items of fewer than Q bytes (null and empty ones too) are not searched. Repeated
    rows and items are reported each; empty tables give no rows.
    """
    rows, context = numbered(docs), docs.sparkSession.sparkContext
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter(F.octet_length("text") >= Q)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    out = None
    for block in range(blocks):
        own = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        texts = items.filter(own).toArrow().combine_chunks()       # about block_bytes
        if not texts.num_rows:
            continue
        data, off = flat(texts.column("text").combine_chunks().cast(pa.string()))
        folded, cuts, _ = normal(data, off)
        found = [(i, folded[a:b].tobytes().rstrip(b" ")) for i, a, b in
                 zip(texts.column("item_id").to_pylist(), cuts[:-1], cuts[1:])]
        found = [(i, t) for i, t in found if len(t) >= Q and i is not None]
        if found:
            index = context.broadcast(Index(sorted(found), edits))
            part = _search(rows, index)
            out = part if out is None else out.unionAll(part)
    if out is None:
        out = rows.limit(0).selectExpr("row", "doc_id", "row as item_id", "row as start", "row as end", "0 as edits")
    return out


def _search(rows: DataFrame, index) -> DataFrame:
    def search(batches):
        for batch in sliced(batches, "text"):
            data, off = flat(batch.column(2))
            text, cuts, place = normal(data, off)
            found = sorted(occurrences(index.value, text, cuts).items())
            if not found:
                continue
            doc, item = (np.array(x) for x in zip(*(k for k, _ in found)))
            cost, start, end = (np.array(x) for x in zip(*(v for _, v in found)))
            begin = place[start + cuts[doc]] - off[doc]
            stop = place[end - 1 + cuts[doc]] + 1 - off[doc]
            yield batch_of(HITS, batch.column(0).take(pa.array(doc)), batch.column(1).take(pa.array(doc)),
                           index.value.ids[item], begin, stop, cost)

    return rows.mapInArrow(search, "row long, doc_id long, item_id long, start long, end long, edits int")
