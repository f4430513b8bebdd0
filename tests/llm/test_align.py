import collections
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tests.llm.samples import ODD, table
from tokenizers import Tokenizer

from tidewatch.llm import registry
from tidewatch.llm.bpe import load_json
from tidewatch.llm.cross_align import Aligner, cross_align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def whole(texts):
    """Brute force: the libraries over whole texts, byte ranges compared pair by pair."""
    a_tok, b_tok = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tok.encode_special_tokens = True
    entries = {i: t for t, i in load_json(A)[0].tokens.items()}
    out = []
    for text in texts:
        out.append(None)
        if not text:
            continue
        a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
        x = [entries[i] for i in a]
        y = [b_tok.id_to_piece(i) for i in b]
        y = [bytes([int(p[3:5], 16)]) if 3 <= i < 259 else p.replace("\u2581", " ").encode() for i, p in zip(b, y)]
        if b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
            continue

        def ranges(parts):
            at = 0
            for p in parts:
                yield at, at + len(p)
                at += len(p)

        x, y = list(ranges(x)), list(ranges(y))
        links, first = [], 0
        for i, (s, e) in enumerate(x):
            while y[first][1] <= s:
                first += 1
            for j in range(first, len(y)):
                if y[j][0] >= e:
                    break
                links.append((a[i], b[j]))
        cuts = sorted({e for _, e in x} & {e for _, e in y})
        groups = [[[], []] for _ in cuts]
        for side, tokens, spans in ((0, a, x), (1, b, y)):
            at = 0
            for t, (_, e) in zip(tokens, spans):
                while cuts[at] < e:
                    at += 1
                groups[at][side].append(str(t))
        out[-1] = len(a), len(b), links, ";".join("|".join(",".join(s) for s in g) for g in groups), len(cuts)
    counts = collections.Counter(p for o in out if o for p in o[2])
    top = collections.Counter()
    for (_, t), n in counts.items():
        top[t] = max(top[t], n)
    return [(0, 0, 0, 0, 0, 0, "") if o is None else
            (o[0], o[1], o[4], len(o[2]), sum(counts[p] == top[p[1]] for p in o[2]), sum(counts[p] for p in o[2]), o[3])
            for o in out]


def rows(frame):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups)
                  for r in frame.collect())


def wild(seed, n=150):
    rng = random.Random(seed)
    parts = ["word", "Wörter", " ", "  ", "\n", "\t", "\u3000", "\u00a0", "漢字", "🙂👍🏽", "e\u0301", "\u2581", "<0x41>", "<|endoftext|>", "<s>",
             "don't", "'ll", "123456", "...", "_", "\x1f", "\x85", "\u200b", "\ufeff", "\u180e", "\u2028", "\x00", "न", "\u202f", "x" * 40,
             "a,", "a", "x_y", "f(x)", "²!", "ɏ.", "é#", "9%", "a.b.c", "`a`", "it's", "a\u0301.", "ﬁ!", "५.", "ß;"]
    return ["".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randint(1, 25))) for _ in range(n)]


@pytest.mark.parametrize("hot", [1 << 18, 50, 0])
def test_alignment_equals_the_libraries_over_whole_texts(spark, hot):
    texts = wild(1) + [" ", "  ", "a ", " a", "a  ", "\n", " \n b", "a \n b", None, "", "same same"] + ["same text here"] * 5
    frame = table(spark, list(enumerate(texts)))
    expected = [(i, *e) for i, e in enumerate(whole(texts))]
    assert rows(cross_align(frame, A, B, hot)) == expected
    assert any(e[1] for e in expected[:150]) and any(e[1] == 0 for e in expected[:150])


def test_whole_query_against_the_libraries(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = {d.doc_id: (*e[:6], hashlib.sha256(e[6].encode()).hexdigest() if e[0] else "")
                for d, e in zip(docs, whole([d.text for d in docs]))}
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
           for r in registry.op11_cross_align(spark, sf_dir).collect()}
    assert got == expected


def test_odd_rows_and_none(spark, odd, none):
    expected = sorted((-1 if i is None else i, *e) for (i, _), e in zip(ODD, whole([t for _, t in ODD])))
    assert rows(cross_align(odd, A, B)) == expected
    assert cross_align(none, A, B).count() == 0


def test_one_word_of_a_megabyte_and_bounded_cache(monkeypatch):
    aligner = Aligner(A, B)
    monkeypatch.setattr("tidewatch.llm.cross_align.CACHE_ENTRIES", 3)
    texts = ["one two three four five", "six seven", "y" * 20_000, "one two"]
    got = [[e[:5] for e in t] for t in aligner.texts(texts)]
    assert got[3] == got[0][:2] and all(len(w) < 300 for w in aligner.kept)
    assert len(aligner.texts(texts[:1])[0]) == 5 and len(aligner.kept) <= 5
