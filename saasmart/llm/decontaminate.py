"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are partitioned by size: class ``c`` holds those of ``2**c`` up to ``2**(c + 1) - 1``
distinct shingles, each class with tables and a sketch depth of its own. A document that
contains ``threshold`` of an item of ``m`` shingles misses at most ``m - ceil(threshold * m)``,
so at least one of the item's ``m - ceil(threshold * m) + 1`` smallest shingle hashes is in
it. A class looks for as many minimum hashes of each item as its largest size needs:
``depth(c) = u - ceil(threshold * u) + 1`` for ``u = 2**(c + 1) - 1``; no smaller size needs
more. Texts with fewer shingles than ``ceil(threshold * 2**c)`` can't contain an item of the
class and leave it out. All other documents are searched whole, however long, for those
minimum hashes alone, and none above the threshold is missed. Each candidate is verified by
exact containment: the shingles as strings, counted as sets.

The items are the query set: they are processed in blocks of ``block_bytes`` of text,
each block one pass over the documents, so what is broadcast has a fixed bound and the
documents are never shuffled. With more than one block, each one's findings are written
to the shared folder and its broadcast ends before the next one's begins.

Words are runs of ASCII letters and digits and of non-ASCII characters, in lower case.
An item of fewer words than a shingle is one shingle of all its words.

Defined results: null and empty texts on either side, and items without a word, are in
no result. Repeated rows on either side are answered each on its own.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import cut, free_name
from .textops import Hasher, Words, split_words, text_chunks, windows_in_text

SHINGLE = 5
THRESHOLD = 0.8
#: Item text of one block.
BLOCK_BYTES = 16 << 20

#: Bytes that part words: ASCII other than letters and digits.
PARTS = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_SIEVE_BITS = 20


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.cast(pa.string()))


def need(m: int, threshold: float) -> int:
    """Shingles of an item of ``m`` that a document must have."""
    return math.ceil(threshold * m - 1e-9)


def depth(size_class: int, threshold: float) -> int:
    """Minimum hashes that a class looks for."""
    most = (2 << size_class) - 1
    return most - need(most, threshold) + 1


def _index(texts: list[str], shingle: int, threshold: float) -> dict:
    """Tables by (shingle length, size class): sketch and all (sorted hashes, items, shingles); what each item needs."""
    hasher = Hasher.seeded(7)
    classes: dict[tuple[int, int], list] = defaultdict(list)
    needs = np.zeros(len(texts), dtype=np.int64)
    total = np.zeros(len(texts), dtype=np.int64)
    for row, end, data, offsets in text_chunks(_lower(pa.array(texts, pa.string()))):
        words = split_words(data, offsets, PARTS)
        spaced, at, stop = words.spaced()
        of_words = hasher.words(words.kept, words.start)
        for i in range(end - row):
            lo, hi = words.of_text[i], words.of_text[i + 1]
            length = min(shingle, hi - lo)
            if not length:
                continue
            first = np.arange(lo, hi - length + 1)
            hashes = hasher.runs(of_words[lo:hi], first - lo, length)
            strings = {spaced[at[f]:stop[f + length - 1]]: h for f, h in zip(first, hashes)}
            m = len(strings)
            total[row + i], needs[row + i] = m, need(m, threshold)
            size_class = m.bit_length() - 1
            looked_for = depth(size_class, threshold)
            smallest = sorted(strings.items(), key=lambda x: x[1])
            classes[int(length), size_class] += [(h, row + i, s, k < looked_for) for k, (s, h) in enumerate(smallest)]
    tables: dict[int, dict[int, dict]] = defaultdict(dict)
    for (length, size_class), found in sorted(classes.items()):
        found.sort(key=lambda x: x[0])
        hashes = np.array([x[0] for x in found], dtype=np.uint64)
        least = np.array([x[3] for x in found])
        tables[length][size_class] = {
            "hashes": hashes, "items": np.array([x[1] for x in found]), "strings": [x[2] for x in found],
            "sketch": np.unique(hashes[least]), "least": need(1 << size_class, threshold),
        }
    return {"tables": dict(tables), "need": needs, "total": total}


class Search:
    """Finds the items that a text contains."""

    def __init__(self, index: dict):
        self.index, self.hasher, self.sieves = index, Hasher.seeded(7), {}
        for length, classes in index["tables"].items():
            for size_class, table in classes.items():
                sieve = np.zeros(1 << _SIEVE_BITS, dtype=bool)
                sieve[table["sketch"] >> np.uint64(64 - _SIEVE_BITS)] = True
                self.sieves[length, size_class] = sieve

    def __call__(self, column: pa.Array) -> Iterator[tuple[int, int, int]]:
        """(row, item, distinct shingles of the item in the row's text) of what passes."""
        for row, _, data, offsets in text_chunks(_lower(column)):
            words = split_words(data, offsets, PARTS)
            of_words = self.hasher.words(words.kept, words.start)
            spaced = None
            for length, classes in self.index["tables"].items():
                at = windows_in_text(words, length)
                hashes = self.hasher.runs(of_words, at, length)
                bits = hashes >> np.uint64(64 - _SIEVE_BITS)
                text_of = np.searchsorted(words.of_text, at, "right") - 1
                windows = np.bincount(text_of, minlength=len(words.of_text) - 1)
                for size_class, table in classes.items():
                    maybe = np.flatnonzero(self.sieves[length, size_class][bits])
                    maybe = maybe[windows[text_of[maybe]] >= table["least"]]
                    maybe = maybe[np.isin(hashes[maybe], table["sketch"])]
                    if not len(maybe):
                        continue
                    spaced = spaced or words.spaced()
                    for t in np.unique(text_of[maybe]):
                        yield from ((row + t, *x) for x in self._verify(words, spaced, at, hashes, t, length, table))

    def _verify(self, words: Words, spaced, at: np.ndarray, hashes: np.ndarray, text: int, length: int, table: dict):
        lo, hi = np.searchsorted(at, words.of_text[text:text + 2])
        own = hashes[lo:hi]
        first = np.searchsorted(table["hashes"], own, "left")
        last = np.searchsorted(table["hashes"], own, "right")
        data, start, stop = spaced
        shared: dict[int, set] = defaultdict(set)
        seen = set()
        for k in np.flatnonzero(last > first):
            if own[k] in seen:
                continue
            w = at[lo + k]
            string = data[start[w]:stop[w + length - 1]]
            for entry in range(first[k], last[k]):
                if table["strings"][entry] == string:
                    seen.add(own[k])
                    shared[int(table["items"][entry])].add(string)
        return [(item, len(s)) for item, s in sorted(shared.items()) if len(s) >= self.index["need"][item]]


def _blocks(items: DataFrame, key: str, text: str, shingle: int, threshold: float,
            block_bytes: int) -> tuple[int, Iterator[tuple[list, dict]]]:
    """How many blocks there are, and (keys, index) of one bounded block of items after another."""
    rows = items.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(2 * size / block_bytes))  # blocks are dealt by hash: half full on average

    def each() -> Iterator[tuple[list, dict]]:
        for k in range(n):
            block = rows.where(F.pmod(F.xxhash64("key", "text"), F.lit(n)) == k).collect()
            if block:
                yield [r.key for r in block], _index([r.text for r in block], shingle, threshold)

    return n, each()


def _per_block(blocks: tuple[int, Iterator], shipped_to: Callable[[Broadcast], DataFrame], what: Callable[[tuple[list, dict]], object],
               name: str) -> list[DataFrame]:
    """The findings of each block: one block's as they are, those of several written one after another."""
    n, each = blocks
    out = []
    for block in each:
        shipped = SparkContext.getOrCreate().broadcast(what(block))
        found = shipped_to(shipped)
        if n > 1:
            found = cut(found, name)
            shipped.destroy()
        out.append(found)
    return out


def contained_items(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                    item_key: str = "item_id", item_text: str = "text", shingle: int = SHINGLE,
                    threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, item, n_shared, n_shingles, containment) of each document and item that it contains."""
    kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    out_kind = f"id {kind}, item {item_kind}, n_shared long, n_shingles long, containment double"
    source = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))

    def search(shipped: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, index = shipped.value
            find = Search(index)
            item_type = None
            for batch in batches:
                found = list(find(batch.column(1)))
                if found:
                    rows, hit, shared = (np.array(x) for x in zip(*found))
                    item_type = item_type or pa.array([keys[i] for i in hit]).type
                    total = index["total"][hit]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(rows)), pa.array([keys[i] for i in hit], item_type),
                         pa.array(shared), pa.array(total), pa.array(shared / total)],
                        names=["id", "item", "n_shared", "n_shingles", "containment"])

        return source.mapInArrow(run, out_kind)

    parts = _per_block(_blocks(items, item_key, item_text, shingle, threshold, block_bytes), search, lambda block: block, "contained")
    return reduce(DataFrame.union, parts) if parts else docs.sparkSession.createDataFrame([], out_kind)


def _contains(shipped: Broadcast, text: Column) -> Column:
    """If a text contains any item of a block."""
    @F.arrow_udf("boolean")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find = Search(shipped.value)
        for column in columns:
            out = np.zeros(len(column), dtype=bool)
            for row, _, _ in find(column):
                out[row] = True
            yield pa.array(out)

    return run.asNondeterministic()(text.cast("string"))


def without_items(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
                  shingle: int = SHINGLE, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` whose text contains none of the items.

    One block is a filter. Several need the rows written once with a number, a table of the
    numbers of what each block finds, and an anti-join.
    """
    n, each = _blocks(items, item_key, item_text, shingle, threshold, block_bytes)
    if n == 1:
        for _, index in each:
            return docs.where(~_contains(SparkContext.getOrCreate().broadcast(index), F.col(text)))
        return docs
    row = free_name(docs.columns, "_row")
    numbered = cut(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = _per_block((n, each), lambda shipped: numbered.where(_contains(shipped, F.col(text))).select(row),
                       lambda block: block[1], "contaminated")
    return numbered.join(reduce(DataFrame.union, found), row, "left_anti").select(*docs.columns) if found else docs


def contaminated(text: Column, items: DataFrame, item_key: str = "item_id", item_text: str = "text",
                 shingle: int = SHINGLE, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> Column:
    """If a text contains any of the items."""
    _, each = _blocks(items, item_key, item_text, shingle, threshold, block_bytes)
    flags = [_contains(SparkContext.getOrCreate().broadcast(index), text) for _, index in each]
    return reduce(lambda a, b: a | b, flags) if flags else F.lit(False)
