"""Substring dedup against brute force."""

import hashlib
import random
import re

from saasmart.llm import difference_cover as dc
from saasmart.llm import repeats
from saasmart.llm.queries import QUERIES
from tests.conftest import SF01


def brute(rows, size=50):
    split = [(i, re.findall("[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, words in split:
        if i is not None:
            for k in range(len(words) - size + 1):
                run = tuple(words[k:k + size])
                least[run] = min(least.get(run, i), i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - size + 1):
            if i is not None and least[tuple(words[k:k + size])] < i:
                gone.update(range(k, k + size))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def check(df, size=50):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = dc.remove_repeats(df, words=size).collect()
    want = brute(rows, size)
    assert sorted(map(tuple, got), key=str) == want
    return want


def test_cover_meets_every_pair_of_positions():
    for i in range(31):
        for j in range(31):
            assert any((i + d) % 31 in dc.COVER and (j + d) % 31 in dc.COVER for d in range(31))


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    want = check(docs.select("doc_id", "text"))
    assert sum(w[2] for w in want) > 0
    got = QUERIES["op10_difference_cover"](spark, SF01).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == [w[:4] for w in want]


def planted():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 4)))
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 75, 200)]
    rows = [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "a " * 3000), (905, "a " * 49), (906, "a " * 51),
            (None, " ".join(passages[3])), (907, "b " * 60), (2, "b " * 60), (908, "x" * 20000)]
    for i in range(80):
        words = [word() for _ in range(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 3)):
            words += rng.choice(passages) + [word() for _ in range(rng.randint(0, 9))]
        rows.append((i, rng.choice([" ", "\t", " \n "]).join(words)))
    rows += [rows[20], (21, rows[30][1])]
    rng.shuffle(rows)
    return rows


def test_planted_passages_and_odd_rows(spark, monkeypatch):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as hashes", "2 as kept")
    check(df.repartition(5))
    check(df.repartition(5), 8)
    monkeypatch.setattr(repeats, "POOL", 50)
    check(df.repartition(2))


def test_empty_table(spark):
    assert dc.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
