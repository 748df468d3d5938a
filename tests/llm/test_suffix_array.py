"""Sparse suffix array against brute force over all windows."""

import random
import re

import numpy as np
import pytest

from saasmart.llm import repeats
from saasmart.llm import suffix_array as sa
from saasmart.llm.queries import QUERIES
from tests.conftest import SF01


def brute(rows, size=50):
    """(document, first word, end word, smallest other document with its first words) of runs that another has."""
    split = [(i, re.findall("[^\x20\x09-\x0D]+", t or "")) for i, t in rows if i is not None]
    owners = {}
    for i, words in split:
        for k in range(len(words) - size + 1):
            owners.setdefault(tuple(words[k:k + size]), set()).add(i)
    out = set()
    for i, words in split:
        spans = []
        for k in range(len(words) - size + 1):
            others = owners[tuple(words[k:k + size])] - {i}
            if others and spans and k <= spans[-1][1]:
                spans[-1] = (spans[-1][0], k + size, spans[-1][2])
            elif others:
                spans.append((k, k + size, min(others)))
        out.update((i, *x) for x in spans)
    return out


def answer(df, **more):
    """The result as a set; no row twice."""
    rows = [tuple(r) for r in sa.repeated_spans(df, **more).select("id", "first_word", "end_word", "other").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_documents_match_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    got = QUERIES["op4_suffix_array"](spark, SF01).collect()
    assert {(r.doc_id, r.first_word, r.end_word, r.other_doc_id) for r in got} == brute(rows)
    assert all(r.n_words == r.end_word - r.first_word for r in got)


def planted():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 5)))
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 75, 300)]
    rows = [(900, None), (901, ""), (902, " \n"), (903, "one"), (905, "a " * 49), (None, " ".join(passages[3])), (908, "x" * 20000),
            (909, "q " * 900), (910, "r s " * 300), (911, "q " * 200), (912, "s r " * 40)]
    for i in range(80):
        words = [word() for _ in range(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 2)):
            words += rng.choice(passages) + [word() for _ in range(rng.randint(0, 9))]
        rows.append((i, " ".join(words)))
    rows += [(200 + k, rows[20][1]) for k in range(6)] + [(200, rows[20][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions,pool,floor", [(7, 1 << 16, 1 << 10), (1, 1 << 16, 1 << 10), (3, 40, 1 << 10), (3, 40, 1), (1, 1 << 16, 0)])
def test_planted_passages_and_odd_rows(spark, monkeypatch, partitions, pool, floor):
    """Equal for any layout of files, batches and split prefixes; the partner too."""
    rows = planted()
    monkeypatch.setattr(repeats, "POOL", pool)
    monkeypatch.setattr(sa, "POOL", pool)
    monkeypatch.setattr(sa, "FLOOR", floor)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as hashes", "2 as state", "3 as k")
    if floor == 0:
        monkeypatch.setattr(sa, "SHARE", 1 << 40)  # every prefix is split
    assert answer(df.repartition(partitions)) == brute(rows)


def test_short_matches(spark):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert answer(df, words=6) == brute(rows, 6)


def test_minimisers_take_the_first_least():
    words = sa.Words(np.zeros(0, np.uint8), np.arange(12), np.ones(12, int), np.array([0, 7, 12]))
    hashes = np.array([5, 3, 3, 9, 1, 7, 8, 2, 2, 2, 4, 6], dtype=np.uint64)
    at = np.arange(12)
    want = set()
    for lo, hi in ((0, 7), (7, 12)):
        for k in range(lo, hi - 3 + 1):
            want.add(min(range(k, k + 3), key=lambda p: (hashes[p], p)))
    assert set(sa.minimisers(words, hashes, at, 3).tolist()) == want


def test_empty_table(spark):
    assert sa.repeated_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_run_with_a_passage_that_many_documents_have(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = []
    for case in range(12):
        footer, before = [word() for _ in range(45)], [word() for _ in range(10)]
        texts = [[word() for _ in range(20)] + footer for _ in range(40)]
        texts += [[word() for _ in range(20)] + before + footer for _ in range(2)]
        rows += [(1000 * case + k, " ".join(t)) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for n in (4, 1):
        got = answer(df.repartition(n))
        assert got == brute(rows) and len(got) == 24
        assert {(r[0], r[3]) for r in got} == {(1000 * c + 40 + k, 1000 * c + 41 - k) for c in range(12) for k in (0, 1)}
