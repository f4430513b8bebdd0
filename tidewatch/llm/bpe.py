"""Byte-level BPE on padded numpy matrices.

Pieces (pre-tokens) of similar length form the rows of one matrix of token ids. In every
round each row merges its leftmost pair of minimum rank; pairs are looked up in an
open-addressing hash table, and rows with nothing left to merge leave the matrix. Long pieces
take a round for each rank instead (all occurrences of the minimum-rank pair from left to
right, which is what the single steps would come to; where a fresh pair would come first, the
round falls back to the single step).
"""

from __future__ import annotations

import base64
import functools
import json

import numpy as np

NONE = np.int32(2**31 - 1)
#: Pieces of more bytes than this merge a rank at a time.
LONG = 128
#: Cells of a matrix; more rows of a bucket go into further matrices.
CELLS = 1 << 18


class PairTable:
    """(left id, right id) -> (rank, merged id), with linear probing."""

    def __init__(self, left, right, rank, merged):
        n = len(left)
        bits = max(4, int(np.ceil(np.log2(max(n, 1) * 4))))
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, NONE, np.int32)
        #: the id that a merge of this rank gives
        self.merged = np.zeros(int(np.max(rank, initial=-1)) + 1, np.int32)
        self.merged[rank] = merged
        key = np.asarray(left, np.int64) << 32 | np.asarray(right, np.int64)
        slot, left_over = self._slot(key), np.arange(n)
        self.probes = 0
        while len(left_over):
            self.probes += 1
            s = slot[left_over]
            free = self.keys[s] == -1
            first = np.zeros(len(s), bool)
            first[np.unique(s, return_index=True)[1]] = True
            put = free & first
            at, which = s[put], left_over[put]
            self.keys[at], self.rank[at] = key[which], rank[which]
            left_over = left_over[~put]
            slot[left_over] = (slot[left_over] + 1) & self.mask

    def _slot(self, key):
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left, right):
        """Ranks; NONE where the pair does not merge."""
        shape = left.shape
        key = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        slot = self._slot(key)
        got = self.keys[slot]
        rank = np.where(got == key, self.rank[slot], NONE)
        open_ = np.flatnonzero((got != key) & (got != -1))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & self.mask
            s = slot[open_]
            got = self.keys[s]
            hit = got == key[open_]
            rank[open_[hit]] = self.rank[s[hit]]
            open_ = open_[~hit & (got != -1)]
        return rank.reshape(shape)


class Bpe:
    """A vocabulary: the bytes of each id, the merge pairs, and whole pieces by their bytes."""

    def __init__(self, tokens: dict[bytes, int], pairs, whole: bool):
        self.tokens, self.whole = tokens, whole
        self.size = max(tokens.values(), default=-1) + 1
        self.bytes_of = [b""] * self.size
        for b, i in tokens.items():
            self.bytes_of[i] = b
        self.byte_ids = np.array([tokens[bytes([b])] for b in range(256)], np.int32)
        self.table = PairTable(*pairs)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end (int32) and the number of ids of each piece."""
        n = len(pieces)
        length = np.fromiter(map(len, pieces), np.int64, n)
        counts, out = np.zeros(n, np.int64), [None] * n
        bucket = np.where(length <= 1, length, np.ceil(length / 4).astype(np.int64) * 4)
        bucket = np.where(length > 32, 1 << np.ceil(np.log2(np.maximum(length, 1))).astype(np.int64), bucket)
        bucket = np.where(length > LONG, LONG + np.arange(1, n + 1), bucket)
        order = np.argsort(bucket, kind="stable")
        flat_ids, flat_rows = [], []
        edges = np.flatnonzero(np.diff(bucket[order])) + 1
        for rows in np.split(order, edges):
            if not len(rows) or not length[rows].any():
                continue
            if length[rows[0]] > LONG:
                ids = self._long(np.frombuffer(pieces[rows[0]], np.uint8))
                flat_ids.append(ids)
                flat_rows.append(np.full(len(ids), rows[0]))
                continue
            step = max(1, CELLS // int(bucket[rows[0]]))
            for at in range(0, len(rows), step):
                part = rows[at:at + step]
                for row, ids in self._matrix([pieces[r] for r in part], length[part]):
                    flat_ids.append(ids)
                    flat_rows.append(part[row])
        if not flat_ids:
            return np.empty(0, np.int32), counts
        ids, rows = np.concatenate(flat_ids), np.concatenate(flat_rows)
        counts = np.bincount(rows, minlength=n)
        return ids[np.argsort(rows, kind="stable")], counts

    def _matrix(self, pieces, length):
        """Yields (row numbers, ids) of rows as they finish; ids of a row keep their order."""
        n, width = len(pieces), int(length.max())
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        ids = self.byte_ids[raw].reshape(n, width)
        cols = np.arange(width)
        row, size = np.arange(n), length.copy()
        ids[cols >= size[:, None]] = -1
        rank = np.full((n, width), NONE, np.int32)
        if width > 1:
            rank[:, :-1] = self.table.find(ids[:, :-1], ids[:, 1:])
            rank[cols >= size[:, None] - 1] = NONE
        while len(row):
            at = rank.argmin(axis=1)                  # the leftmost of equal ranks
            low = rank[np.arange(len(row)), at]
            live = low != NONE
            if not live.all():                        # compaction
                done = ~live
                keep = cols[:ids.shape[1]] < size[done][:, None]
                yield np.repeat(row[done], size[done]), ids[done][keep]
                row, size, at, low = row[live], size[live], at[live], low[live]
                ids, rank = ids[live], rank[live]
                if not len(row):
                    return
                w = int(size.max())
                ids, rank = ids[:, :w], rank[:, :w]
            w, r = ids.shape[1], np.arange(len(row))
            new = self.table.merged[low]
            take = np.minimum(cols[:w] + (cols[:w] > at[:, None]), w - 1)
            ids = np.take_along_axis(ids, take, 1)
            rank = np.take_along_axis(rank, take, 1)
            size -= 1
            ids[r, at] = new
            ids[:, w - 1] = -1
            rank[:, w - 1] = NONE
            rank[r, size - 1] = NONE
            has = at < size - 1
            rank[r[has], at[has]] = self.table.find(new[has], ids[r[has], at[has] + 1])
            has = at > 0
            rank[r[has], at[has] - 1] = self.table.find(ids[r[has], at[has] - 1], new[has])

    def _long(self, raw):
        ids = self.byte_ids[raw]
        while len(ids) > 1:
            rank = self.table.find(ids[:-1], ids[1:])
            low = rank.min()
            if low == NONE:
                break
            at = np.flatnonzero(rank == low)
            run = np.concatenate([[0], np.cumsum(np.diff(at) > 1)])   # neighbours overlap
            first = at[np.searchsorted(run, run)]
            at = at[(at - first) % 2 == 0]
            new = self.table.merged[low]
            out = ids.copy()
            out[at] = new
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            if len(at) > 1:
                right = at[at + 2 < len(ids)]
                before = np.where(keep, out, 0)
                prev = at[at > 0] - 1
                prev = np.where(keep[prev], prev, prev - 1)
                fresh = min(
                    self.table.find(np.full(len(right), new), ids[right + 2]).min(initial=NONE),
                    self.table.find(before[prev], np.full(len(prev), new)).min(initial=NONE))
                if fresh < low:
                    out = ids.copy()
                    out[at[0]] = new
                    keep[:] = True
                    keep[at[0] + 1] = False
            ids = out[keep]
        return ids


def _pairs_by_rank(tokens: dict[bytes, int]):
    """Every way to put a token together from two others; its rank is the token's."""
    left, right, rank = [], [], []
    for token, r in tokens.items():
        for k in range(1, len(token)):
            a, b = tokens.get(token[:k]), tokens.get(token[k:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                rank.append(r)
    rank = np.array(rank, np.int32)
    return np.array(left, np.int32), np.array(right, np.int32), rank, rank


@functools.lru_cache(maxsize=4)
def load_tiktoken(path: str) -> Bpe:
    """A rank file: a base64 token and its rank on each line; ids are ranks."""
    with open(path, "rb") as f:
        tokens = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, f)))}
    return Bpe(tokens, _pairs_by_rank(tokens), whole=True)


def byte_chars() -> dict[str, int]:
    """The printable characters by which byte-level vocabularies write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@functools.lru_cache(maxsize=4)
def load_json(path: str) -> tuple[Bpe, tuple[str, ...]]:
    """A byte-level BPE in the tokenizers format: the vocabulary, and its special strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, special = spec["model"], [t["content"] for t in spec.get("added_tokens") or []]
    if model["type"] != "BPE" or spec.get("normalizer") or model.get("ignore_merges"):
        raise ValueError(f"{path}: only plain byte-level BPE files are read")
    of = byte_chars()
    as_bytes = {t: bytes(of[c] for c in t) for t in model["vocab"] if all(c in of for c in t)}
    tokens = {as_bytes[t]: i for t, i in model["vocab"].items() if t in as_bytes}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = np.array([[model["vocab"][a], model["vocab"][b], model["vocab"][a + b]] for a, b in merges],
                   np.int32).reshape(-1, 3)
    pairs = ids[:, 0], ids[:, 1], np.arange(len(ids), dtype=np.int32), ids[:, 2]
    return Bpe(tokens, pairs, whole=False), tuple(special)
