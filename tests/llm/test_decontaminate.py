"""Containment search against brute force."""

import random
import re

import pyarrow as pa

from saasmart.llm import decontaminate as dc
from saasmart.llm.queries import QUERIES
from tests.conftest import SF001


def shingles(text, k):
    words = re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").lower())
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}, len(words)


def brute(docs, items, threshold=0.8):
    out = []
    for item, text in items:
        n = shingles(text, 5)[1]
        k = min(5, n)
        if not k:
            continue
        want = shingles(text, k)[0]
        for doc, body in docs:
            both = len(want & shingles(body, k)[0])
            if both >= threshold * len(want) - 1e-9:
                out.append((doc, item, both, len(want)))
    return sorted(out, key=str)


def test_documents_match_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    got = QUERIES["op7_decontaminate"](spark, SF001).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in got), key=str) == brute(docs, items)


def test_partial_items_odd_rows_and_blocks(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["ab", "É", "c1", "dd", "eee", "f", "g2", "hh", "日本"])
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 25)))) for i in range(30)]
    items += [(90, None), (91, ""), (92, "!! --"), (0, items[0][1]), (None, "ab ab ab ab ab ab")]
    docs = [(100, None), (101, ""), (102, "ab, É; c1!")]
    for i in range(60):
        body = [word() for _ in range(rng.randint(0, 30))]
        part = (items[i % 30][1]).split()
        for _ in range(rng.randint(0, 3)):
            part[rng.randrange(len(part))] = "zz"
        docs.append((i, " ".join(body + [p.upper() + "," for p in part] + body)))
    docs += [(103, " ".join(word() for _ in range(60000))), (0, docs[3][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as id")
    t = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id")
    want = brute(docs, items)
    for block in (dc.BLOCK_BYTES, 200):
        got = dc.contained_items(d, t, block_bytes=block).collect()
        assert sorted(((r.id, r.item, r.n_shared, r.n_shingles) for r in got), key=str) == want
        flagged = d.where(dc.contaminated(d.text, t, block_bytes=block)).select("text").distinct().collect()
        assert {r.text for r in flagged} == {b for k, b in docs if k in {w[0] for w in want}} & {r.text for r in flagged} and flagged
        clean = dc.without_items(d, t, block_bytes=block)
        assert clean.columns == d.columns
        hit = [bool(brute([doc], items)) for doc in docs]
        assert sorted((str(tuple(r)[:2]) for r in clean.collect())) == sorted(str(doc) for doc, bad in zip(docs, hit) if not bad)


def test_size_classes():
    words = [" ".join(f"w{i}x{j}" for j in range(n)) for i, n in enumerate([1, 3, 5, 6, 7, 8, 11, 12, 40, 300])]
    tables = dc._index([*words, ""], 5, 0.8)["tables"]
    sizes = {length: {c: sorted(set(t["items"].tolist())) for c, t in classes.items()} for length, classes in tables.items()}
    # 5 words and more have 1, 2, 3, 4, 7, 8, 36 and 296 shingles
    assert sizes == {1: {0: [0]}, 3: {0: [1]}, 5: {0: [2], 1: [3, 4], 2: [5, 6], 3: [7], 5: [8], 8: [9]}}
    for classes in tables.values():
        for c, table in classes.items():
            items = len(set(table["items"].tolist()))
            assert len(table["sketch"]) <= items * dc.depth(c, 0.8)
            assert all(m - dc.need(m, 0.8) + 1 <= dc.depth(c, 0.8) for m in range(1 << c, 2 << c))
    assert len(tables[5][8]["sketch"]) == dc.depth(8, 0.8) == 103


def test_every_size_is_found_at_the_threshold():
    rng = random.Random(8)
    items = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n)) for n in [*range(1, 40), 100, 259, 260, 700]]
    find = dc.Search(dc._index(items, 5, 0.8))
    for i, item in enumerate(items):
        part = item.split()
        for cut in range(len(part) // 4 + 1):  # a document with all words but some at an end
            text = " ".join(["aa"] + (part[cut:] if cut % 2 else part[:len(part) - cut]) + ["zz"])
            want = [(d, k, both) for d, k, both, _ in brute([(0, text)], list(enumerate(items[i:i + 1], i)))]
            assert [(int(t), k, n) for t, k, n in find(pa.array([text])) if k == i] == want


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contained_items(d, none).count() == 0
    assert d.where(dc.contaminated(d.text, none)).count() == 0
    assert dc.without_items(d, none).count() == 1
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert dc.contained_items(d.limit(0), some).count() == 0
    assert dc.contained_items(d, some).first().containment == 1.0
