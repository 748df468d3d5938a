"""Quality rules against brute force; verdicts on labelled documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from saasmart.llm import quality
from saasmart.llm.queries import QUERIES
from tests.conftest import SF01, SF001


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    count = Counter(runs)
    again = {k + j for k, r in enumerate(runs) if count[r] > 1 for j in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again))


def measured(df):
    words = quality.words_of(F.col("text"))
    return df.select("doc_id", quality.let(words, lambda w: F.struct(*quality.base_statistics(F.col("text"), w))).alias("x")) \
        .select("doc_id", "x.*").collect()


def test_statistics_match_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "\n\n", "a", "a b c d", "a b c d e", "a b c d e a b c d e", "a " * 5000, "\x0ba\x0cb\r\n a\n\na\na \n", "é#é &<|>",
             "x" * 100000, " a a a a a a", "a b c d e f " * 3 + "g"]
    for _ in range(150):
        texts.append("".join(rng.choice(["a", "b", "é"]) + rng.choice([" ", " ", "\n", "  ", "\t"]) for _ in range(rng.randint(0, 60))))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as n_words", "2 as counts")
    for r in measured(df):
        assert tuple(r)[1:] == brute(texts[r.doc_id]), texts[r.doc_id]


def test_query_statistics_and_rules(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = QUERIES["op9_quality_rules"](spark, SF001).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_verdicts_keep_clean_and_find_junk(spark):
    got = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, SF01).collect()}
    labels = spark.read.parquet(f"{SF01}/labels.parquet").collect()
    clean = [got[r.doc_id] for r in labels if r.quality == 1 and not got[r.doc_id].base_failed]
    junk = [got[r.doc_id] for r in labels if r.quality == 0]
    assert sum(r.kept for r in clean) / len(clean) > 0.99
    assert sum(not r.kept for r in junk) / len(junk) > 0.6


def test_ratio_matches_brute_force(spark):
    rows = [(1, "a b a"), (2, "c d"), (3, None), (4, ""), (None, "a c"), (5, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    place = {r.w: r.b for r in spark.createDataFrame([(w,) for w in "abcd"], "w string")
             .select("w", F.pmod(F.xxhash64("w"), F.lit(64)).alias("b")).collect()}
    pairs = {(r.v, r.w): r.b for r in spark.createDataFrame([(v, w) for v in "abcd" for w in "abcd"], "v string, w string")
             .select("v", "w", F.pmod(F.xxhash64("v", "w"), F.lit(64)).alias("b")).collect()}
    words = [F.col("text")]
    got = df.select("doc_id", "text", quality.let(quality.words_of(*words), lambda w: quality.buckets_of(w, 64)).alias("b")).collect()
    for r in got:
        w = (r.text or "").split()
        assert r.b == [place[x] for x in w] + [pairs[p] for p in zip(w, w[1:])]


def test_every_trusted_document_counts_and_sets_the_threshold(spark):
    # more trusted documents than a bounded sample would take; ids repeat and are null, and so are trusted ones
    n = 45_000
    docs = spark.range(n).selectExpr(
        "if(id % 1000 = 7, null, if(id % 1000 = 8, id - 1000, id)) as doc_id",
        "if(id % 97 = 0, null, concat('a', id % 11, ' b', id % 7, if(id % 3 = 0, ' junk', ''), if(id = 30001, ' once', ''))) as text")
    trusted = spark.range(n).where("id % 3 > 0").selectExpr("id as doc_id").unionAll(
        spark.createDataFrame([(None,), (30001,)], "doc_id long"))
    ids = {r.doc_id for r in trusted.collect()} - {None}
    assert len(ids) == 30_000
    rows = docs.select("doc_id", "text", quality.half_of(F.col("doc_id")).alias("half"),
                       quality.let(quality.words_of(F.col("text")), lambda w: quality.buckets_of(w, 64)).alias("b")).collect()
    raw, halves = Counter(range(64)), (Counter(), Counter())
    for r in rows:
        raw.update(r.b)
        if r.doc_id in ids:
            halves[r.half].update(r.b)

    def weights(target):
        return [math.log((target[k] + 1) / (target.total() + 64)) - math.log(raw[k] / raw.total()) for k in range(64)]

    ratio = quality.fit(docs, trusted, buckets=64)
    assert ratio.weights == pytest.approx(weights(halves[0] + halves[1]))
    by = weights(halves[0]), weights(halves[1])
    assert ratio.halves[0] == pytest.approx(by[0]) and ratio.halves[1] == pytest.approx(by[1])

    def mean(b, w):
        return sum(w[x] for x in b) / len(b) if b else 0

    unseen = [round(mean(r.b, by[1 - r.half]), 3) for r in rows if r.doc_id in ids]
    low, middle = np.percentile(unseen, [1, 50])
    found = docs.select("doc_id", "text", quality.measure(F.col("text"), ratio, F.col("doc_id")).alias("x")).select("doc_id", "text", "x.*")
    assert quality.threshold(found, trusted) == pytest.approx(low - (middle - low), abs=0.002)
    score = {r.text: mean(r.b, ratio.weights) for r in rows}
    for r in found.where("doc_id is null or doc_id % 500 = 1").collect():
        assert r.score == pytest.approx(score[r.text])


def test_trusted_words_in_one_half_let_all_pass(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "x y z")], "doc_id long, text string")
    trusted = docs.where("doc_id = 1")
    ratio = quality.fit(docs, trusted)
    found = docs.select("doc_id", quality.measure(F.col("text"), ratio, F.col("doc_id")).alias("x")).select("doc_id", "x.*")
    assert ratio.weights and quality.threshold(found, trusted) == -math.inf


def test_no_trusted_documents_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    ratio = quality.fit(df, df.limit(0))
    assert ratio.weights == []
    assert df.select(quality.measure(F.col("text"), ratio).alias("x")).first().x.score == 0
    assert quality.fit(df.limit(0), df.limit(0)).weights == []


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op9_quality_rules"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
