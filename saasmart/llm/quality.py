"""Quality rules: text statistics and a hashed n-gram log-likelihood ratio, in DataFrame operations alone.

Each text's words and pairs of neighbouring words fall into ``BUCKETS`` by hash. Two
multinomials over the buckets are counted, with one added to each bucket: the raw
corpus (every document) and the trusted target (documents named as trusted). A text's
score is the mean over its n-grams of log(target / raw). Every trusted document counts in
the target, and every one sets the threshold: a hash of the id deals them into two halves,
each is scored by a target that only the other half counted in, and the threshold is the
``LOWEST`` quantile of these scores, lowered once more by the distance from their median.
Every document is held against that one threshold.

Documents are joined with the trusted ids by a shuffle, as both grow with the corpus; only
bucket counts leave the tasks after it. A second pass gives each document its statistics,
its score and the score that it would set the threshold with.

Defined results: a null text counts as empty; a text without words has score 0 and
passes the threshold (the rules on words catch it); without trusted documents every
score is 0 and every document passes, and every one passes if all trusted words are in one
half. Repeated rows count and are answered each on its own; a null id is never trusted.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
LOWEST = 0.01

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP, -1), "")


def _upto(n: Column, body: Callable[[Column], Column], kind: str = "array<bigint>") -> Column:
    """body(0) .. body(n - 1)."""
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), body)).otherwise(F.array().cast(kind))


def buckets_of(words: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all words and of all pairs of neighbours."""
    place = lambda *x: F.pmod(F.xxhash64(*x), F.lit(buckets).cast("long")).cast("int")
    pairs = _upto(F.size(words) - 1, lambda i: place(words[i], words[i + 1]), "array<int>")
    return F.concat(F.transform(words, lambda w: place(w)), pairs)


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows that the text has twice or more, the first ones included."""
    n = F.size(words)

    def covered(hashes: Column) -> Column:
        # hash (its low bits cut) and position in one long: one sort brings equal windows together
        bits = F.ceil(F.log2(n + 1)).cast("int")
        packed = F.sort_array(F.transform(hashes, lambda h, i: F.call_function("shiftleft", h, bits).bitwiseOR(i.cast("long"))))
        place = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int")
        hash_at = lambda s, j: hashes[place(s[j])]
        found = let(packed, lambda s: F.transform(
            F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                     lambda j: ((j > 0) & (hash_at(s, F.greatest(j - 1, F.lit(0))) == hash_at(s, j)))
                     | ((j < F.size(s) - 1) & (hash_at(s, F.least(j + 1, F.size(s) - 1)) == hash_at(s, j)))),
            lambda j: place(s[j])))
        # the words from one such window's start to the next one's, at most a window's
        return let(F.sort_array(found), lambda p: F.aggregate(
            p, F.struct(F.lit(0).alias("sum"), F.lit(-(1 << 20)).alias("last")),
            lambda a, x: F.struct((a["sum"] + F.least(F.lit(window), x - a["last"])).alias("sum"), x.alias("last")),
            lambda a: a["sum"]))

    hashed = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: _upto(
        n - window + 1, lambda i: F.xxhash64(*(h[i + k] for k in range(window)))))
    return let(hashed, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier one."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def base_statistics(text: Column, words: Column) -> list[Column]:
    return [
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        duplicate_lines(text).cast("long").alias("n_dup_lines"),
        repeat_words(words).cast("long").alias("n_repeat_words"),
    ]


@dataclass
class Ratio:
    """log(target / raw) per bucket: with all trusted documents in the target, and with those of either half."""

    weights: list[float] = field(default_factory=list)
    halves: tuple[list[float], list[float]] = ([], [])

    def score(self, words: Column) -> Column:
        if not self.weights:
            return F.lit(0.0)
        return let(buckets_of(words, len(self.weights)), lambda b: _mean(b, self.weights))

    def scores(self, words: Column, half: Column) -> Column:
        """A struct: ``score``, and ``unseen`` by the target of the half that the text is not in (null if that is empty)."""
        none = F.lit(None).cast("double")
        if not self.weights:
            return F.struct(F.lit(0.0).alias("score"), none.alias("unseen"))
        by = lambda b, k: _mean(b, self.halves[k]) if self.halves[k] else none
        return let(buckets_of(words, len(self.weights)), lambda b: F.struct(
            _mean(b, self.weights).alias("score"), F.when(half == 0, by(b, 1)).otherwise(by(b, 0)).alias("unseen")))


def _mean(buckets: Column, weights: list[float]) -> Column:
    weights = F.lit(np.array(weights))  # one literal, not an expression per bucket
    return F.when(F.size(buckets) > 0, F.aggregate(
        buckets, F.lit(0.0), lambda s, x: s + weights[x]) / F.size(buckets)).otherwise(F.lit(0.0))


def half_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("half")), F.lit(2))


def _ids(trusted: DataFrame, key: str) -> DataFrame:
    return trusted.select(F.col(key).alias("id")).where("id is not null").distinct()


def fit(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> Ratio:
    """``trusted``: rows whose ``key`` names the trusted documents."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    ids = _ids(trusted, key).withColumn("half", half_of(F.col("id")))
    # hashed, not sorted, as the other side is texts; null ids would all go to one task
    rows = rows.where("id is not null").join(ids.hint("shuffle_hash"), "id", "left").select("half", "text") \
        .union(rows.where("id is null").select(F.lit(None).cast("long"), "text"))
    counts = rows.select("half", F.explode(let(words_of(F.col("text")), lambda w: buckets_of(w, buckets))).alias("bucket")) \
        .groupBy("bucket").agg(F.count("*").alias("raw"), *(F.count_if(F.col("half") == k).alias(f"half_{k}") for k in (0, 1))).collect()
    raw, halves = [1] * buckets, ([0] * buckets, [0] * buckets)
    for r in counts:
        raw[r.bucket] += r.raw
        halves[0][r.bucket], halves[1][r.bucket] = r.half_0, r.half_1

    def weights(target: list[int]) -> list[float]:
        all_raw, all_target = sum(raw), sum(target) + buckets
        return [math.log((t + 1) / all_target) - math.log(r / all_raw) for t, r in zip(target, raw)] if any(target) else []

    return Ratio(weights([a + b for a, b in zip(*halves)]), tuple(map(weights, halves)))


def threshold(found: DataFrame, trusted: DataFrame, key: str = "doc_id", lowest: float = LOWEST) -> float:
    """The least score that passes. ``found``: all documents' ``key`` and ``unseen``; ``trusted``: as in ``fit``."""
    unseen = found.select(F.col(key).alias("id"), F.round("unseen", 3).alias("unseen")).join(_ids(trusted, key), "id")
    low, middle = unseen.agg(F.percentile("unseen", F.array(F.lit(lowest), F.lit(0.5))).alias("q")).first().q or (None, None)
    return -math.inf if low is None else low - (middle - low)


def measure(text: Column, ratio: Ratio, key: Column | None = None) -> Column:
    """A struct per text: the base statistics and ``score``; with the text's ``key`` also ``unseen``."""
    def of(w: Column) -> Column:
        stats = base_statistics(text, w)
        if key is None:
            return F.struct(*stats, ratio.score(w).alias("score"))
        return let(ratio.scores(w, half_of(key)), lambda s: F.struct(*stats, s["score"].alias("score"), s["unseen"].alias("unseen")))

    return let(words_of(text), of)
