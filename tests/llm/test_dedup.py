import collections
import hashlib
import random

import numpy as np
import pytest
from tests.llm.samples import ODD, table

from tidewatch.llm import line_dedup as lines
from tidewatch.llm import registry
from tidewatch.llm import substring_dedup as chunks
from tidewatch.llm import suffix_dedup as suffixes
from tidewatch.llm.loser_tree import common, merge


def strings_removed(texts, length):
    """Brute force: every string of ``length`` bytes, counted."""
    counts = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if counts[t[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((int(gone.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize(("length", "window", "large"), [(40, 16, 50_000), (40, 16, 3), (60, 40, 50_000)])
def test_suffix_dedup_is_exact(spark, length, window, large):
    rng = random.Random(5)
    base = ["".join(rng.choice("ab cd") for _ in range(rng.randint(5, 150))) for _ in range(14)]
    texts = ["".join(rng.choice(base) for _ in range(rng.randint(0, 7))) for _ in range(50)]
    texts += ["a" * 300, "a" * 35, "", "ab" * 100, base[0] * 3]
    got = {r.doc_id: (r.n_removed, r.n_spans, bytes(r.kept))
           for r in suffixes.suffix_dedup(table(spark, list(enumerate(texts))), length, window, large).collect()}
    assert [got[i] for i in range(len(texts))] == strings_removed([t.encode() for t in texts], length)


def test_large_groups_are_compared_by_offset(spark, monkeypatch):
    rng = random.Random(6)
    core = "".join(rng.choice("abcdef ") for _ in range(60))
    texts = ["".join(rng.choice("xyz") for _ in range(rng.randint(0, 30))) + core[rng.randint(0, 10):]
             + "".join(rng.choice("uvw") for _ in range(rng.randint(0, 30))) for _ in range(60)]
    expected = strings_removed([t.encode() for t in texts], 40)
    group = []
    order = sorted(range(len(texts)), key=lambda k: texts[k][texts[k].find(core[20:30]):])
    for before, k in zip([None, *order], order):
        at = texts[k].find(core[20:30])
        suffix = texts[k][at:at + 40].encode()
        shared = 0 if before is None else common(group[-1][1], suffix)
        group.append((shared, suffix, texts[k][max(0, at - 39):at].encode(), 1))
    reaches = []                                   # every pair, byte by byte
    for i, (_, a, before, _) in enumerate(group):
        left = right = 0
        for j, (_, b, other, _) in enumerate(group):
            if i != j:
                r = common(a, b)
                both = common(before[::-1], other[::-1])
                if r + both >= 40:
                    left, right = max(left, both), max(right, min(r, 40))
        reaches.append((left, right))
    for pairs in (1, 1000):                        # by offsets, and pair by pair
        monkeypatch.setattr(suffixes, "PAIRS", pairs)
        assert suffixes.reach(group, 40) == reaches
    assert sum(a + b > 0 for a, b in reaches) == sum(r > 0 for r, _, _ in expected)


def test_loser_tree_merges_and_knows_prefixes():
    rng = random.Random(2)
    for k in (1, 2, 3, 7):
        runs = []
        for number in range(k):
            strings = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 30)))
            runs.append([(common(strings[i - 1], s) if i else 0, s, number) for i, s in enumerate(strings)])
        out = list(merge(runs))
        assert [s for _, s, _ in out] == sorted(s for run in runs for _, s, _ in run)
        for (_, a, _), (shared, b, _) in zip(out, out[1:]):
            assert shared == common(a, b)


def test_odd_rows(odd, none):
    for operator in (suffixes.suffix_dedup, chunks.substring_dedup, lines.line_dedup):
        got = collections.Counter((r.doc_id, r.n_bytes) for r in operator(odd).collect())
        assert got == collections.Counter((i, len((t or "").encode())) for i, t in ODD)
        assert operator(none).count() == 0
        for r in operator(odd).collect():
            assert len(r.kept) == r.n_bytes - r.n_removed


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(3)
    pool = [f"line number {k} of the pool" for k in range(12)] + ["", " "]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(60)]
    texts += [texts[0], texts[0] + "\n", "one line\r\nwith returns\r\nand more", "one line\r\nwith returns\r\nand more"]
    rows = table(spark, list(enumerate(texts))).coalesce(1)
    seen, expected = set(), {}
    for r in rows.collect():
        text, kept, at = r.text.encode(), b"", 0
        for a, b in lines.line_chunks(text):
            chunk = text[a:b].removesuffix(b"\n")
            if chunk in seen:
                kept, at = kept + text[at:a], b
            seen.add(chunk)
        expected[r.doc_id] = kept + text[at:]
    assert {r.doc_id: bytes(r.kept) for r in lines.line_dedup(rows).collect()} == expected
    assert any(len(expected[i]) < len(t) for i, t in enumerate(texts))


def test_line_chunks_resist_a_shift():
    rng = random.Random(4)
    text = [f"{rng.random()} some line" for _ in range(200)]
    one = "\n".join(text).encode()
    two = "\n".join(["a new line", *text[:90], "another", *text[90:]]).encode()
    a, b = ({t[x:y].removesuffix(b"\n") for x, y in lines.line_chunks(t)} for t in (one, two))
    assert len(a & b) >= 0.9 * len(a)


def test_line_dedup_finds_every_run_of_lines(spark):
    rng = random.Random(11)
    number = iter(range(10**6))
    fresh = lambda n: [f"line {next(number)} of nobody else" for _ in range(n)]
    passages = [fresh(n) for n in (2, 2, 2, 3, 3, 4, 4, 5, 9) for _ in range(4)]
    for p in passages[::3]:
        p.insert(1, "")
    texts = [fresh(rng.randint(1, 6)) + p + fresh(rng.randint(1, 6)) for p in passages for _ in range(3)]
    texts += [["", *texts[0], " "], ["", *texts[0], " "], ["x", "", "alone", "", "y"], ["z", "", "alone", "", "w"]]
    rows = table(spark, list(enumerate("\n".join(t) for t in texts))).coalesce(1)
    seen, expected = set(), {}
    for r in rows.collect():
        text = r.text.split("\n")
        gone = [False] * len(text)
        full = [k for k, line in enumerate(text) if line.strip()]
        runs = [(i, j) for k, i in enumerate(full) for j in full[k + 1:]]
        runs += [(0, j) for j in full[1:]] + [(i, len(text) - 1) for i in full[:-1]]
        for i, j in runs:
            if tuple(text[i:j + 1]) in seen:
                gone[i:j + 1] = [True] * (j + 1 - i)
        seen.update(tuple(text[i:j + 1]) for i, j in runs)
        expected[r.doc_id] = sum(len(line) for line, g in zip(text, gone) if not g)
    got = {r.doc_id: len(bytes(r.kept).replace(b"\n", b"")) for r in lines.line_dedup(rows).collect()}
    assert got == expected
    # of three places of each passage, two lose all of it
    assert sum(len("".join(t)) for t in texts) - sum(got.values()) >= sum(2 * len("".join(p)) for p in passages)


def test_repeated_passages_go_but_for_the_first(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    passages = [" ".join(word() for _ in range(51)) for _ in range(40)]
    texts = [" ".join([*(word() for _ in range(rng.randint(1, 60))), p, *(word() for _ in range(rng.randint(1, 40)))])
             for p in passages for _ in range(3)]
    clean = [" ".join(word() for _ in range(150)) for _ in range(40)]
    rows = table(spark, list(enumerate(texts + clean))).coalesce(1)
    first = {3 * k for k in range(40)}            # the order is that of doc_id
    out = {r.doc_id: r for r in chunks.substring_dedup(rows).collect()}
    hit = {i for i in out if out[i].n_removed}
    assert hit <= set(range(120)) - first
    assert len(hit) >= 0.95 * 80


def test_op6_query_against_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").coalesce(1).collect()
    seen, expected = set(), {}
    for r in rows:
        text, runs = r.text.encode(), []
        marks = np.flatnonzero(chunks.gear(np.frombuffer(text, np.uint8)) >> np.uint32(32 - chunks.BITS) == 0) + 1
        ends = chunks.chunk_ends([m for m in marks.tolist() if m >= 32], 0, len(text))
        for a, b in zip([0, *ends], ends):
            if text[a:b] in seen:
                if runs and runs[-1][1] == a:
                    runs[-1][1] = b
                else:
                    runs.append([a, b])
            seen.add(text[a:b])
        kept, at = b"", 0
        for a, b in runs:
            while 0 < a < len(text) and text[a] & 0xC0 == 0x80:
                a -= 1
            while b < len(text) and text[b] & 0xC0 == 0x80:
                b += 1
            if b - a >= chunks.RUN:
                kept, at = kept + text[at:a], b
        expected[r.doc_id] = hashlib.sha256(kept + text[at:]).hexdigest()
    assert {r.doc_id: r.kept_sha256 for r in registry.op6_substring_dedup(spark, sf_dir).collect()} == expected
