"""URL filters by a Bloom filter cascade.

A rule is a host and a path with a verdict. It fits a url of its host or a subdomain whose
path starts with the rule's path. So only a few keys of a url can be a rule: the last n
labels of its host with the first l characters of its path, for the shapes (n, l) that the
rules have. Those keys of all pages are the universe.

Level 0 of the cascade is a Bloom filter of the listed keys. Level 1 encodes the keys of
the universe that level 0 takes for listed but aren't, level 2 the listed keys that level 1
hits, and so on in turn, until a level hits none of the other side. A key's answer is that
of the first level that misses it, which is exact for every key of the universe. A second,
smaller cascade tells blocked from allowed among the listed keys. Pages are then judged
without a join, a shuffle or the list itself.

Each level hashes the key's text anew, so keys that collide on one level part on another.
The filters are broadcast; their size is known from the number of keys before they are
made. A list that needs more than ``FILTER_BYTES`` is dealt into groups by a hash of the
key, and one group's cascade after the other goes over the pages.

Of the rules that fit a url the longest decides (counted in characters of host and path,
then of host); of a rule that is listed with both verdicts, block. A url without one gets
the default verdict: it isn't listed.

Defined results: a null url, or one without ``://``, has an empty host and path and no
rule; only A-Z are lower-cased; a host may have a port or user, which are part of its
text. Rules with a null or empty host, a null path, or a path that neither is empty nor
starts with ``/`` can't fit and are left out. Repeated pages are judged each on its own, an
empty table of pages or rules gives no rows or no rule, and the pages' columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import cut, free_name

#: Bytes of the first filter of one cascade; a longer list goes in groups.
FILTER_BYTES = 64 << 20
#: Share of false hits of every level but the first.
RATE = 0.05
#: Least share of false hits of the first level.
LEAST_RATE = 2.0 ** -20

RULES = T.StructType([T.StructField("host", T.StringType()), T.StructField("path", T.StringType()),
                      T.StructField("verdict", T.StringType())])

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """The host after the first ``://``, A-Z lower-cased; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """The path up to ``?``, ``#`` or the end; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: bits, hashes per key and the broadcast bytes."""

    number: int
    bits: int
    hashes: int
    filter: Broadcast


def layout(keys: int, rate: float) -> tuple[int, int]:
    """Bits and hashes per key of a filter for so many keys and this share of false hits."""
    hashes = max(1, math.ceil(math.log2(1 / rate)))
    return max(64, math.ceil(keys * hashes / math.log(2))), hashes


def _hash(level: int, key: Column) -> Column:
    return F.xxhash64(F.lit(level), key)


def _encode(keys: DataFrame, number: int, count: int, rate: float) -> Level:
    """The filter of a table of keys; its bits are set in Spark, 4 KB of them a group."""
    bits, hashes = layout(count, rate)
    h = _hash(number, F.col("key"))
    low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    spots = keys.select(F.explode(F.array(*((low + F.lit(j) * high) % F.lit(bits) for j in range(hashes)))).alias("spot"))
    words = spots.groupBy(F.bitmap_bucket_number(F.col("spot") + 1).alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("spot") + 1)).alias("bitmap"))
    out = bytearray(math.ceil(bits / 32768) * 4096)
    for row in words.toLocalIterator():
        out[(row.bucket - 1) * 4096:row.bucket * 4096] = row.bitmap
    return Level(number, bits, hashes, keys.sparkSession.sparkContext.broadcast(bytes(out)))


def _answers(values: np.ndarray, levels: list[tuple]) -> np.ndarray:
    """For rows of one hash per level: if the cascade says that the key is listed."""
    listed = np.zeros(len(values), dtype=bool)
    at = np.arange(len(values))
    for n, (bits, hashes, data) in enumerate(levels):
        low, high = values[at, n] & 0xFFFFFFFF, (values[at, n] >> 32) & 0xFFFFFFFF | 1
        hit = np.ones(len(at), dtype=bool)
        for j in range(hashes):
            spot = (low + j * high) % bits
            hit &= (data[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1
        listed[at[~hit]] = n % 2 == 1
        at = at[hit]
    listed[at] = len(levels) % 2 == 1
    return listed


def listed(keys: Column, levels: list[Level]) -> Column:
    """For an array of keys: an array of what the cascade says of each."""
    if not levels:
        return F.transform(keys, lambda k: F.lit(False))
    shipped = [(x.bits, x.hashes, x.filter) for x in levels]
    width = len(levels)

    @F.arrow_udf(T.ArrayType(T.BooleanType()))
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = [(bits, hashes, np.frombuffer(data.value, np.uint8)) for bits, hashes, data in shipped]
        for column in columns:
            count = np.asarray(column.value_lengths().fill_null(0)) // width
            values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            at = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(at), pa.array(_answers(values, own)))

    return run(F.flatten(F.transform(keys, lambda k: F.array(*(_hash(x.number, k) for x in levels)))))


def _held(keys: DataFrame, levels: list[Level], wanted: bool) -> DataFrame:
    return keys.where(listed(F.array("key"), levels)[0] == wanted)


def cascade(inside: DataFrame, outside: DataFrame, count: int, rows: int) -> list[Level]:
    """Levels that tell ``inside`` from ``outside``, tables of distinct keys that share none.

    ``count``: keys of ``inside``; ``rows``: about as many keys as ``outside`` has.
    ``outside`` is read once; of it only what level 0 hits is kept.
    """
    if not count:
        return []
    rate = min(0.5, max(LEAST_RATE, count / max(rows, 1)))
    levels = [_encode(inside, 0, count, rate)]
    own, other = inside, _held(outside, levels, True)
    while True:
        other = cut(other.select("key").distinct(), "cascade")
        count = other.count()
        if not count:
            return levels
        number = len(levels)
        levels.append(_encode(other, number, count, RATE))
        # the next level encodes what this one takes from the side before it
        own, other = other, _held(own, levels, number % 2 == 0)


@dataclass(frozen=True)
class Group:
    """The cascades of one group of the list: listed or not, and blocked among the listed."""

    listed: list[Level]
    blocked: list[Level]


def _shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """Labels of the host and characters of the path that rules have; at most labels x lengths, not rules."""
    found = rules.select(F.size(F.split("host", r"\.", -1)).alias("n"), F.length("path").alias("l")).distinct().collect()
    return sorted((r.n, r.l) for r in found)


def _keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Keys of a url: (text, characters of the host) for each shape that it has."""
    labels = F.size(F.split(host, r"\.", -1))
    made = []
    for n, length in shapes:
        end = F.substring_index(host, ".", -n)
        fits = (labels >= n) & (F.length(path) >= length) & (host != "")
        made.append(F.when(fits, F.struct(F.concat(end, F.substring(path, 1, length)).alias("key"), F.length(end).alias("n_host"))))
    return F.array_compact(F.array(*made)) if made else F.array().cast("array<struct<key:string,n_host:int>>")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", into: str = "found") -> DataFrame:
    """``pages`` with a struct ``into``: host, path, rule (null without one) and verdict.

    ``rules``: host, path, verdict (block or allow). See the module for what fits.
    """
    rules = rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", (F.col("verdict") == "block").alias("block")) \
        .where("host <> '' and (path = '' or startswith(path, '/'))")
    shapes = _shapes(rules)
    rules = cut(rules.select(F.concat("host", "path").alias("key"), "block").groupBy("key").agg(F.max("block").alias("block")), "rules")
    count = rules.count()
    columns = pages.columns
    names = {n: free_name(columns, f"_{n}") for n in ("host", "path", "keys", "hits")}
    host, path, keys, hits = names.values()
    pages = pages.withColumn(host, host_of(F.col(url).cast("string"))).withColumn(path, path_of(F.col(url).cast("string"))) \
        .withColumn(keys, _keys(F.col(host), F.col(path), shapes)) \
        .withColumn(hits, F.array().cast("array<struct<size:int,n_host:int,key:string,block:boolean>>"))
    if not count:
        return _verdicts(pages, columns, names, default, into)
    rows = pages.count() * len(shapes)
    rate = min(0.5, max(LEAST_RATE, count / max(rows, 1)))
    groups = math.ceil(layout(count, rate)[0] / 8 / FILTER_BYTES)
    for g in range(groups):
        own = rules.where(_in_group(F.col("key"), g, groups))
        in_group = _of_group(F.col(keys), g, groups)
        group = _group(own, pages.select(F.explode(in_group["key"]).alias("key")), rows // groups)
        told = F.zip_with(listed(in_group["key"], group.listed), listed(in_group["key"], group.blocked),
                          lambda a, b: F.struct(a.alias("listed"), b.alias("block")))
        found = F.zip_with(in_group, told, lambda k, x: F.struct(
            F.length(k["key"]).alias("size"), k["n_host"].alias("n_host"), k["key"].alias("key"), x["block"].alias("block"),
            x["listed"].alias("listed")))
        found = F.transform(F.filter(found, lambda x: x["listed"]),
                            lambda x: F.struct(*(x[c].alias(c) for c in ("size", "n_host", "key", "block"))))
        pages = pages.withColumn(hits, F.concat(hits, found))
        if g < groups - 1:
            pages = cut(pages, "judged")
    return _verdicts(pages, columns, names, default, into)


def _in_group(key: Column, g: int, groups: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(groups)) == g


def _of_group(keys: Column, g: int, groups: int) -> Column:
    return F.filter(keys, lambda k: _in_group(k["key"], g, groups))


def _group(rules: DataFrame, universe: DataFrame, rows: int) -> Group:
    count = rules.count()
    known = rules.select("key")
    apart = _Apart(universe, known)
    blocked = rules.where("block").select("key")
    n_blocked = blocked.count()
    return Group(cascade(known, apart, count, rows), cascade(blocked, rules.where("not block").select("key"), n_blocked, count))


class _Apart:
    """A universe without the listed keys, which are taken out of the few that a level hits."""

    def __init__(self, universe: DataFrame, known: DataFrame):
        self.universe, self.known = universe, known

    def where(self, condition: Column) -> DataFrame:
        return self.universe.where(condition).distinct().join(self.known, "key", "left_anti")


def _verdicts(pages: DataFrame, columns: list[str], names: dict[str, str], default: str, into: str) -> DataFrame:
    best = F.array_max(F.col(names["hits"]))
    verdict = F.when(best.isNull(), F.lit(default)).when(best["block"], F.lit("block")).otherwise(F.lit("allow"))
    return pages.select(*columns, F.struct(F.col(names["host"]).alias("host"), F.col(names["path"]).alias("path"),
                                           best["key"].alias("rule"), verdict.alias("verdict")).alias(into))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, RULES)
