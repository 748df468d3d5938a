"""Words that collide under sums over powers modulo 2**64, whatever the base (those of Thue and Morse)."""

import random

import numpy as np
import pytest
import tiktoken

from saasmart.llm import bpe, difference_cover, suffix_array
from saasmart.llm.queries import tokenizer
from saasmart.llm.textops import Hasher, split_words


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(k).count("1") % 2 else a for k in range(n))


PAIR = thue_morse(2048), thue_morse(2048, "b", "a")


def hashes(text, length, seed=3, lower=False):
    data = np.frombuffer(text.encode(), np.uint8)
    words = split_words(data, np.array([0, len(data)]))
    hasher = Hasher.seeded(seed, lower)
    of_words = hasher.words(words.kept, words.start)
    return hasher.runs(of_words, np.arange(len(of_words) - length + 1), length)


@pytest.mark.parametrize("n", [16, 32, 64, 256, 1024, 4096])
def test_words_and_runs_do_not_collide(n):
    assert hashes(thue_morse(n), 1) != hashes(thue_morse(n, "b", "a"), 1)
    runs = [" ".join(thue_morse(n, a, b)) for a, b in ("ab", "ba")]
    assert hashes(runs[0], n) != hashes(runs[1], n)


def test_runs_depend_on_their_words_alone():
    rng = random.Random(1)
    words = [rng.choice(["x", "yy", "Zé", "w" * 70]) for _ in range(300)]
    for length in (1, 2, 3, 7, 8, 20, 50):
        own = hashes(" ".join(words), length).tolist()
        by_text = {}
        for k, h in enumerate(own):
            assert by_text.setdefault(tuple(words[k:k + length]), h) == h
        assert len(set(by_text.values())) == len(by_text)
        assert hashes(" ".join(words[5:5 + length]), length).tolist() == [own[5]]
    assert hashes("AB " + "Q" * 80, 2, lower=True) == hashes("ab " + "q" * 80, 2, lower=True)


def test_bpe_tells_them_apart():
    tokens, pattern = tokenizer()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    for texts in (list(PAIR), [PAIR[0]] * 2 + [PAIR[1]]):
        (_, ids, decoded), = bpe.Encoder(tokens, pattern)(bpe.pa.array(texts))
        for text, i, d in zip(texts, ids, decoded):
            assert np.frombuffer(i, "<u4").tolist() == library.encode_ordinary(text) and d == text.encode()


def test_bpe_with_a_hash_that_always_collides(monkeypatch):
    tokens, pattern = tokenizer()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    monkeypatch.setattr(bpe.Encoder, "hashes", lambda self, data, start, stop: (stop - start).astype(np.uint64) % 3)
    encoder = bpe.Encoder(tokens, pattern)
    for texts in (["one two six ten", "", "xqzw " + "k" * 300], ["six xqzw 12 été", "q" * 300 + " " + "k" * 300]):
        for row, ids, decoded in encoder(bpe.pa.array(texts)):
            for k, (i, d) in enumerate(zip(ids, decoded)):
                assert np.frombuffer(i, "<u4").tolist() == library.encode_ordinary(texts[row + k]) and d == texts[row + k].encode()


def test_windows_that_differ_in_one_word_are_not_repeats(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("cdefgh") for _ in range(5)) for _ in range(49)]
    rows = [(k, " ".join(words[:25] + [word] + words[25:])) for k, word in enumerate(PAIR)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert [r.n_removed for r in difference_cover.remove_repeats(df).collect()] == [0, 0]
    assert suffix_array.repeated_spans(df).count() == 0
