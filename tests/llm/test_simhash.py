"""SimHash: fingerprints and components against brute force."""

import itertools
import random
import re

import xxhash

from saasmart.llm import graph, simhash
from tests.conftest import SF001


def fingerprint(text, k=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", low)
    runs = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(prints, distance):
    parent = {i: i for i, _ in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, x), (j, y) in itertools.combinations(prints, 2):
        if (x ^ y).bit_count() <= distance:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return {i: root(i) for i, _ in prints}


def check(df, distance=4, block=simhash.BLOCK):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = [(i, fingerprint(t)) for i, t in rows]
    reach = smallest_reachable(want, distance)
    got = simhash.near_duplicates(df, distance=distance, block=block).collect()
    assert sorted((r.id, r.fp % 2**64, r.component) for r in got) == sorted((i, f, reach[i]) for i, f in want)


def test_documents_match_brute_force(spark):
    check(spark.read.parquet(f"{SF001}/documents.parquet"))


def test_close_fingerprints_and_odd_texts(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    base = [[word() for _ in range(rng.randint(3, 120))] for _ in range(12)]
    texts = [None, "", " \t\n", "one", "One", "a b c", "a b c d", "a\x0bb\x0cc\rd e", "x" * 5000, "\x00     z"]
    for words in base:
        for _ in range(8):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(3, "one", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    rows = df.dropDuplicates(["doc_id"])
    check(rows)
    check(rows, block=3)  # every shared anchor in blocks
    assert simhash.near_duplicates(df).count() == len(texts) + 1


def test_anchor_cover_meets_every_close_pair(spark):
    rng = random.Random(1)
    pairs = []
    for i in range(400):
        x, y = rng.getrandbits(64), 0
        y = x
        for b in rng.sample(range(64), rng.randint(0, 4)):
            y ^= 1 << b
        sign = lambda v: v - (1 << 64) if v >> 63 else v
        pairs.append((i, sign(x), sign(y)))
    df = spark.createDataFrame(pairs, "i long, x long, y long")
    met = df.select(simhash.F.arrays_overlap(simhash.anchors(df.x, 4), simhash.anchors(df.y, 4)).alias("met"))
    assert met.where("met").count() == len(pairs)


def test_empty_table_and_null_id(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0
    one = spark.createDataFrame([(None, "a b c d e"), (4, "a b c d e")], "doc_id long, text string")
    assert {(r.id, r.component) for r in simhash.near_duplicates(one).collect()} == {(None, 4), (4, 4)}


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(2000 + i, 2000 + (i + 1) % 9) for i in range(9)]
    edges += [(5, 5), (None, 3), (7, 6), (7, 6)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(40)} | {2000 + i: 2000 for i in range(9)}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
