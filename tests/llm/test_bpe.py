"""Byte-level BPE against the public library, and the round trip."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from saasmart.llm import bpe
from saasmart.llm.queries import QUERIES, tokenizer
from tests.conftest import SF001


@pytest.fixture(scope="module")
def library():
    tokens, pattern = tokenizer()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def odd_texts():
    rng = random.Random(2)
    bits = ["a", "b", " ", " ", "\n", "\t", "'", "'s", "'ll", "'re", "1", "2", "é", "ß", "日本", " ", "\xa0", "!", "?", "²",
            "Ⅷ", "😀", "\x1c", "\x85", "_", "-", "x" * 30, "́", "<|endoftext|>", "\r\n", "İ"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    return made + ["", None, " ", "\n\n", "  a", "a  ", "'s 's", "don't  we'll", " 's", "ab " * 30000, "z" * 3000]


def test_odd_texts_match_the_library(spark, library):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    tokens, pattern = tokenizer()
    for r in df.select("doc_id", "text", bpe.encode(df.text, tokens, pattern, keep_ids=True, keep_decoded=True).alias("x")).collect():
        want = library.encode_ordinary(r.text or "")
        assert np.frombuffer(bytes(r.x.ids), "<u4").tolist() == want
        assert bytes(r.x.decoded) == (r.text or "").encode()
        assert r.x.n_tokens == len(want)


def test_long_pieces_match_the_library(library):
    rng = random.Random(7)
    texts = ["x" * 100000, "".join(rng.choice("ACGT") for _ in range(50000)), "é" * 500, "=" * 1001, "1" * 30000, "日本語" * 2000]
    texts += ["".join(rng.choice(rng.choice(["ab", "aeinrst", "xyz"])) for _ in range(rng.randint(250, 600))) + " end" for _ in range(100)]
    encoder = bpe.Encoder(*tokenizer())
    for row, ids, decoded in encoder(bpe.pa.array(texts)):
        for k, (i, d) in enumerate(zip(ids, decoded)):
            assert np.frombuffer(i, "<u4").tolist() == library.encode_ordinary(texts[row + k]) and d == texts[row + k].encode()


def test_pieces_are_forgotten_without_effect(library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 3)
    encoder = bpe.Encoder(*tokenizer())
    texts = [t or "" for t in odd_texts()[:60]]
    for _ in range(2):
        for text in texts:
            (_, ids, decoded), = encoder(bpe.pa.array([text]))
            assert np.frombuffer(ids[0], "<u4").tolist() == library.encode_ordinary(text) and decoded[0] == text.encode()


def test_query_matches_the_library(spark, library):
    import hashlib
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = QUERIES["op2_byte_bpe"](spark, SF001).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_pattern_is_the_one_the_splitter_is_made_for():
    assert public_tokenizers.PATTERN == r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
