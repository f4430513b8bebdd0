import base64
import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tests.llm.samples import ODD
from tokenizers import Tokenizer

from tidewatch.llm import registry
from tidewatch.llm.bpe import load_json, load_tiktoken
from tidewatch.llm.bpe_codec import decode, encode
from tidewatch.llm.pretoken import PATTERN, splitter
from tidewatch.llm.token_counts import token_counts

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pattern_is_the_published_one():
    assert PATTERN == public_tokenizers.PATTERN


def test_pieces_join_to_the_text_in_every_class_of_characters():
    split = splitter()
    for text in ("it's  a\n\n b", "²3 ½x_y--z", "\x1c\x85  a", "՘࢏漢字 🙂🙂", "", "   "):
        assert "".join(split(text)) == text


def test_matrices_agree_with_both_libraries(reference):
    rng = random.Random(1)
    pieces = ["".join(rng.choice("abcdeht") for _ in range(rng.randint(1, 300))) for _ in range(80)]
    pieces += ["a" * k for k in (1, 2, 127, 128, 129, 400)] + ["ab" * 150, "é" * 40]
    library = Tokenizer.from_file(JSON)
    for bpe, expected in ((load_tiktoken(RANKS), reference.encode_ordinary),
                          (load_json(JSON)[0], lambda t: library.encode(t, add_special_tokens=False).ids)):
        ids, counts = bpe.encode([p.encode() for p in pieces])
        for piece, got in zip(pieces, np.split(ids, np.cumsum(counts)[:-1])):
            whole = bpe.tokens.get(piece.encode()) if bpe.whole else None
            assert ([whole] if whole is not None else got.tolist()) == expected(piece)


def test_counts_of_odd_rows(odd, none):
    library = Tokenizer.from_file(JSON)
    rows = token_counts(odd, JSON, entries=10).collect()          # a cache that starts anew all the time
    expected = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ODD]
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)
    assert token_counts(none, JSON).count() == 0


def test_codec_of_odd_rows(odd, none, reference):
    out = decode(encode(odd, RANKS, entries=10), RANKS)
    assert "lang" in out.columns and out.columns.count("ids") == 1
    got = [(r.doc_id, bytes(r.ids), bytes(r.decoded), r.text) for r in out.collect()]
    expected = []
    for i, t in ODD:
        ids = reference.encode_ordinary(t or "")
        expected.append((i, struct.pack(f"<{len(ids)}I", *ids), (t or "").encode(), t))
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert decode(encode(none, RANKS), RANKS).count() == 0


def test_queries_on_the_small_table(spark, sf_dir, reference):
    library = Tokenizer.from_file(JSON)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in registry.op1_token_counts(spark, sf_dir).collect():
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)
    for r in registry.op10_byte_bpe(spark, sf_dir).collect():
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
