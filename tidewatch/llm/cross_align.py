"""Operator 11: alignment of two tokenizers' tokens over the same bytes.

The tokenizers library's character offsets and the spans of sentencepiece's protos are coarse cuts of
the text. Where a token's decoded bytes fill its coarse span, the span stands; tokens that share a
character (parts of a multibyte one, byte-fallback tokens) are laid out by their decoded bytes.

Both tokenizers always cut before a single space that stands between two other characters: byte-level
pre-tokens only begin with a space, and no piece has a space mark behind another character. They also cut
between a Latin letter or a digit and a punctuation mark: no pre-token and no piece holds both, in that
order. (Both are checked in the vocabulary; without that, texts are encoded whole.) So a text is encoded
part by part, from a bounded cache in the worker, which is exact. A part without a space before it is
encoded behind the letter a, whose own token is taken off again. Pairs are counted for each document before they leave the task.
A document's sums then need the corpus-wide counts: the most frequent pairs, a table of fixed size, are
looked up where the documents are, the rest by a join.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.arrow import batch_of, sliced, starts_of
from tidewatch.llm.bpe import load_json
from tidewatch.session import cut_lineage

#: Words that a worker keeps (half of them those met last), and the longest kept.
CACHE_ENTRIES, KEPT_CHARS = 300_000, 200
#: Words encoded at once, and the bytes of text in a step.
MISSES, TEXT_BYTES = 8_000, 2 << 20
#: Frequent pairs that are broadcast: 17 bytes each, whatever the input. The others are joined.
HOT_PAIRS = 1 << 18
#: Links that a task sums up before it emits their counts.
SUM_LINKS = 4_000_000
SPACE = "\u2581"
#: White space, and characters that some engines count as such.
WHITE = r"\s\u180e\u200b\ufeff" + SPACE
#: Where the words of a text can't simply be cut at every space.
ODD = re.compile(f"[{WHITE}] | (?:{SPACE}|\\Z)|\\A ")
CUT = re.compile(f"(?<=[^{WHITE}])(?= [^ {SPACE}])")
#: A letter or digit that all engines know, and the marks before which both sides cut behind it (no underscore).
LETTER, MARK = "A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"!-/:-@\[-\^`{-~"
INNER = re.compile(f"(?<=[{LETTER}])(?=[{MARK}])")
#: A part that stands behind no space; no other part looks like this.
CARRIED = re.compile(f"a[{MARK}]").match
#: Words that others may stand beside in one call: nothing that counts as white space at either end.
SIMPLE = re.compile(f"[^{WHITE}](?:.*[^{WHITE}])?", re.DOTALL).fullmatch
DOCS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                  ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()),
                  ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
SUMS = pa.schema([("pair", pa.int64()), ("n", pa.int64())])
FOUND = pa.schema([("row", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()),
                   ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
_WORKER: dict = {}


def byte_offsets(text: str) -> np.ndarray:
    """Byte offset of each character, and of the end."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    size = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    return np.concatenate([[0], np.cumsum(size)])


def refined(begin: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Byte ends of tokens from coarse spans: a token that fills its span ends with it; others follow the last
    such end by their decoded sizes."""
    total = np.cumsum(size)
    last = np.maximum.accumulate(np.where(end - begin == size, np.arange(len(size)), -1))
    return total + np.where(last >= 0, end[last] - total[last], 0)


def _bounds(counts) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.asarray(counts, np.int64))])


class Aligner:
    """Both tokenizers and the cache of one worker."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")       # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        bpe, special = load_json(a_path)
        a_bytes = {i: t for t, i in bpe.tokens.items()} | {self.a.token_to_id(t): t.encode() for t in special}
        self.a_bytes = [a_bytes.get(i, b"") for i in range(max(a_bytes) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        self.width = len(pieces)
        self.codes = self.width * len(self.a_bytes)            # pairs that there can be
        self.by_word = not any(SPACE in p.lstrip(SPACE) or INNER.search(p) for i, p in enumerate(pieces)
                               if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))) and {len(self.a.encode(" a").ids), len(self.b.encode("a"))} == {1}
        #: ids as text with what follows them: a comma, or the mark behind the last one of a group's side
        self.shown = [f"{i}{c}" for side, last in ((self.a_bytes, "|"), (self.b_bytes, ";"))
                      for i in range(len(side)) for c in (",", last)]
        self.kept, self.older = {}, {}

    def words(self, text: str) -> list[str]:
        """The parts of space + text that are encoded for themselves, without their first space."""
        if not self.by_word:
            return [text]
        text = INNER.sub(" a", text)
        if ODD.search(text):
            return [w[1:] for w in CUT.split(" " + text)]
        return text.split(" ")

    def tokens(self, words: list[str]):
        """Both sides' tokens of all words end to end: ids, number for each word, coarse character spans (A) and
        byte spans (B), counted from the first word's start."""
        whole = [" " + w for w in words]
        if self.by_word and all(map(SIMPLE, words)):
            # both tokenizers cut between such words: one call for all, and each word's end is a token's end
            x = self.a.encode("".join(whole), add_special_tokens=False)
            pieces = self.b.encode("".join(whole)[1:], return_type="proto").pieces
            spans = np.array(x.offsets, np.int64).reshape(-1, 2)
            chars, size = _bounds(list(map(len, whole)))[1:], _bounds([len(w.encode()) for w in whole])[1:]
            b_spans = np.array([(p.begin + 1, p.end + 1) for p in pieces], np.int64).reshape(-1, 2)
            b_spans[0, 0] = 0
            # parts of a character carry its start or its end: either lies in their word
            a_n = np.bincount(np.searchsorted(chars, spans[:, 0], "right"), minlength=len(words))
            b_n = np.bincount(np.searchsorted(size, b_spans[:, 0], "right"), minlength=len(words))
            return np.array(x.ids, np.int64), np.array([p.id for p in pieces], np.int64), a_n, b_n, spans, b_spans
        a_side = self.a.encode_batch(whole, add_special_tokens=False)
        b_side = [y.pieces for y in self.b.encode(words, return_type="proto", num_threads=1)]
        a_n, b_n = (np.array(list(map(len, x)), np.int64) for x in (a_side, b_side))
        flat = [p for y in b_side for p in y]
        chars, size = _bounds(list(map(len, whole))), _bounds([len(w.encode()) for w in whole])
        spans = np.array([o for x in a_side for o in x.offsets], np.int64).reshape(-1, 2) + np.repeat(chars[:-1], a_n)[:, None]
        # spans of the proto are bytes of the word; the space that the library adds lies before them
        b_spans = np.array([(p.begin + 1, p.end + 1) for p in flat], np.int64).reshape(-1, 2)
        b_spans[_bounds(b_n)[:-1][b_n > 0], 0] = 0
        b_spans += np.repeat(size[:-1], b_n)[:, None]
        return (np.array([i for x in a_side for i in x.ids], np.int64), np.array([p.id for p in flat], np.int64),
                a_n, b_n, spans, b_spans)

    def encoded(self, words: list[str]) -> list[tuple | None]:
        """For each word: tokens of A, tokens of B, groups, links, groups as text, pairs as bytes; None where the
        bytes of a side are others. All words are worked on at once, end to end."""
        whole = [" " + w for w in words]
        data = [w.encode() for w in whole]
        a, b, a_n, b_n, span, b_span = self.tokens(words)
        n = np.array(list(map(len, data)), np.int64)
        a_of, b_of = np.repeat(np.arange(len(words)), a_n), np.repeat(np.arange(len(words)), b_n)
        joined = b"".join(data)
        a_joined, b_joined = (b"".join(map(side.__getitem__, ids.tolist())) for side, ids in
                              ((self.a_bytes, a), (self.b_bytes, b)))
        a_held, b_held = (np.bincount(of, size, len(words)).astype(np.int64) for of, size in
                          ((a_of, self.a_size[a]), (b_of, self.b_size[b])))
        good = (a_held == n) & (b_held == n)
        if not good.all() or a_joined != joined or b_joined != joined:
            x, y = _bounds(a_held), _bounds(b_held)
            good = np.array([a_joined[x[k]:x[k + 1]] == d == b_joined[y[k]:y[k + 1]] for k, d in enumerate(data)])
            left = np.flatnonzero(good)
            out = [None] * len(words)
            for k, entry in zip(left, self.encoded([words[k] for k in left]) if len(left) else []):
                out[k] = entry
            return out

        edge = _bounds(n)
        span = byte_offsets("".join(whole))[span]
        a_ends = refined(span[:, 0], span[:, 1], self.a_size[a])
        b_ends = refined(b_span[:, 0], b_span[:, 1], self.b_size[b])

        # between two neighbouring ends of either side lies one token of each: a link
        cuts = np.union1d(a_ends, b_ends)
        pairs = (a[np.searchsorted(a_ends, cuts)] * self.width + b[np.searchsorted(b_ends, cuts)]).tobytes()
        links = _bounds(np.bincount(np.searchsorted(edge[1:], cuts), minlength=len(words)))
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        groups = np.bincount(np.searchsorted(edge[1:], common), minlength=len(words))
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        shown = np.concatenate([2 * a + (np.diff(a_group, append=-1) != 0),
                                2 * (len(self.a_bytes) + b) + (np.diff(b_group, append=-1) != 0)])
        order = np.lexsort((np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a_group, b_group])))
        parts, at = list(map(self.shown.__getitem__, shown[order].tolist())), _bounds(a_n + b_n).tolist()
        texts = ["".join(parts[s:e])[:-1] for s, e in zip(at, at[1:])]
        held = [pairs[s:e] for s, e in zip((8 * links).tolist(), (8 * links[1:]).tolist())]
        out = list(zip(a_n.tolist(), b_n.tolist(), groups.tolist(), np.diff(links).tolist(), texts, held))
        for k in [k for k, w in enumerate(words) if CARRIED(w)] if self.by_word else []:
            a, b, g, n, text, pair = out[k]                    # the carrying letter is the first group and link
            out[k] = a - 1, b - 1, g - 1, n - 1, text[text.index(";") + 1:], pair[8:]
        return out

    def texts(self, texts: list[str | None]) -> list[list | None]:
        """For each text its words' entries; None for a text without tokens."""
        split = [self.words(t) if t else None for t in texts]
        seen = dict.fromkeys(w for words in split if words for w in words)
        if len(self.kept) > CACHE_ENTRIES // 2:
            self.kept, self.older = {}, self.kept
        known, older, missing = self.kept, self.older, []
        for w in seen:
            if w not in known:
                if w in older:
                    known[w] = older[w]
                else:
                    missing.append(w)
        long = {}
        missing.sort(key=lambda w: SIMPLE(w) is None)          # simple words first, to be encoded together
        simple = sum(SIMPLE(w) is not None for w in missing)
        for a, b in ((0, simple), (simple, len(missing))):
            for k in range(a, b, MISSES):
                part = missing[k:min(b, k + MISSES)]
                for word, entry in zip(part, self.encoded(part)):
                    (known if len(word) <= KEPT_CHARS else long)[word] = entry
        out = []
        for words in split:
            if not words:
                out.append(None)
                continue
            entries = list(map(known.get, words))
            if None in entries:                                # a long word, or one that has no tokens
                entries = [known[w] if w in known else long[w] for w in words]
            out.append(None if None in entries else entries)
        return out


def _aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _WORKER:
        _WORKER[a_path, b_path] = Aligner(a_path, b_path)
    return _WORKER[a_path, b_path]


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values))


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their weights."""
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    start = starts_of(keys)[:-1]
    return keys[start], np.add.reduceat(weights, start) if len(keys) else weights


def _listed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A list column's values end to end, and the number in each row."""
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)


def align(docs: DataFrame, a_path: str, b_path: str, digest: bool = False) -> DataFrame:
    """row, doc_id, n_a, n_b, n_groups, n_links, groups (text), pairs and times (id pairs a * width + b, and how
    often the document links them), as a written table. ``docs``: doc_id (integer, null allowed) and text; other
    columns are left aside. Null and empty texts, and those that a tokenizer's bytes don't give back, have no
    tokens: zeros, empty groups. Repeated rows are aligned each; an empty table gives no rows. With ``digest``,
    groups is the SHA-256 of the text (empty without tokens), which spares writing several times the input.
    """
    def run(batches):
        aligner = _aligner(a_path, b_path)
        for batch in sliced(batches, "text", TEXT_BYTES):
            entries = aligner.texts(batch.column(2).to_pylist())
            sums, groups, pairs, sizes = [], [], [], []
            for e in entries:
                if e is None:
                    sums.append((0, 0, 0, 0))
                    groups.append("")
                    sizes.append(0)
                    continue
                a, b, n, links, text, linked_pairs = zip(*e)
                sums.append((sum(a), sum(b), sum(n), sum(links)))
                text = ";".join(text)
                groups.append(hashlib.sha256(text.encode()).hexdigest() if digest else text)
                pairs.extend(linked_pairs)
                sizes.append(sums[-1][3])
            key = np.frombuffer(b"".join(pairs), np.int64) + np.repeat(np.arange(len(sizes)) * aligner.codes, sizes)
            key.sort()
            new = starts_of(key)[:-1] if len(key) else np.empty(0, np.int64)
            times = np.diff(np.append(new, len(key)))
            held = np.bincount(key[new] // aligner.codes, minlength=len(sizes))
            columns = np.array(sums, np.int64).T
            yield batch_of(DOCS, batch.column(0), batch.column(1), *columns, groups,
                           lists(key[new] % aligner.codes, held), lists(times, held))

    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return cut_lineage(slim.mapInArrow(run, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                            "groups string, pairs array<long>, times array<long>"), "aligned")


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """pair, n (links that hold it, over all documents) and best (no pair of the same B id has more)."""
    def add(batches):
        keys, weights, held = [], [], 0
        for batch in batches:
            keys.append(_listed(batch.column(0))[0])
            weights.append(_listed(batch.column(1))[0])
            held += len(keys[-1])
            if held >= SUM_LINKS:
                k, w = summed(np.concatenate(keys), np.concatenate(weights))
                keys, weights, held = [k], [w], len(k)
                if held >= SUM_LINKS // 2:
                    yield batch_of(SUMS, k, w)
                    keys, weights, held = [], [], 0
        if held:
            yield batch_of(SUMS, *summed(np.concatenate(keys), np.concatenate(weights)))

    sums = aligned.select("pairs", "times").mapInArrow(add, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.col("pair") % width))
    return cut_lineage(sums.select("pair", "n", (F.col("n") == most).alias("best")), "pair_counts")


def cross_align(docs: DataFrame, a_path: str, b_path: str, hot_pairs: int = HOT_PAIRS, digest: bool = False) -> DataFrame:
    """``align`` with each document's sums over its links: n_best (links whose count is the highest of their B id's)
    and count_sum. Columns: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (see ``align`` for ``digest``). ``hot_pairs`` says how many
    pairs are looked up by broadcast, and changes no result.
    """
    import sentencepiece

    spark = docs.sparkSession
    width = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    aligned = align(docs, a_path, b_path, digest)
    counts = pair_counts(aligned, width)
    top = counts.orderBy(F.col("n").desc(), "pair").limit(hot_pairs).toArrow().sort_by("pair")
    hot = spark.sparkContext.broadcast(tuple(top.column(c).to_numpy() for c in ("pair", "n", "best")))

    def look_up(batches):
        pair, n, best = hot.value
        for batch in batches:
            keys, held = _listed(batch.column(1))
            times = _listed(batch.column(2))[0]
            of = np.repeat(np.arange(len(held)), held)
            at = np.minimum(np.searchsorted(pair, keys), max(len(pair) - 1, 0))
            hit = pair[at] == keys if len(pair) else np.zeros(len(keys), bool)
            sums = []
            for part in (times * best[at] * hit, times * n[at] * hit) if len(pair) else (times * 0, times * 0):
                total = np.concatenate([[0], np.cumsum(part)])
                edge = np.concatenate([[0], np.cumsum(held)])
                sums.append(total[edge[1:]] - total[edge[:-1]])
            left = np.bincount(of[~hit], minlength=len(held))
            yield batch_of(FOUND, batch.column(0), *sums, lists(keys[~hit], left), lists(times[~hit], left))

    found = cut_lineage(aligned.select("row", "pairs", "times").mapInArrow(
        look_up, "row long, n_best long, count_sum long, pairs array<long>, times array<long>"), "found")
    rest = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
    rest = rest.withColumnRenamed("pairs", "pair").join(counts, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("best").cast("long")).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    sums = found.select("row", "n_best", "count_sum").unionByName(rest).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return aligned.drop("pairs", "times").join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
