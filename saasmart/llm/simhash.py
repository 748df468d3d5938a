"""SimHash near-duplicates, found by anchor-point covering.

A 64-bit fingerprint is cut into two halves of 32 bits; of two fingerprints that
differ in ``d`` bits, one half differs in ``t = d // 2`` at most. In each half the
anchors are the words of the Hamming code of 31 bits (its 32nd bit is left out of the
anchor), a perfect covering code of radius 1. Two half words at distance ``t`` have a
midpoint within ``ceil(t / 2)`` of both, and the midpoint has an anchor within 1, so a
fingerprint that goes to every anchor within the covering radius plus the threshold,
as seen from the midpoint (``1 + ceil(t / 2)``), meets every partner at an anchor. For
d = 4 that is 1 or 16 of the 2**26 anchors per half. Distances are then computed per
anchor over all 64 bits, so no pair beyond ``d`` links and none within it is missed.

Only distinct fingerprints travel (copies of a text share one), and each anchor's
members give a spanning forest of their links rather than their pairs. Anchors with
many members are cut into blocks that are compared block against block in tasks of
their own.

Defined results: a null text, an empty one and one without a word have fingerprint
zero and link like any other. Repeated rows have equal fingerprints and so one
component; null ids are carried through the fingerprints but name no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .storage import cut
from .textops import split_words, text_chunks

SEED = 42
#: Members of one anchor that a task compares at a time.
BLOCK = 2048
#: Runs up to this length are compared by shifting the whole batch against itself.
SHORT = 8


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(id, fp): the fingerprint of every text, lower-cased (A-Z), over its shingles of words.

    A bit is 1 if it is set in over half of the shingles' hashes (repeats included). A
    text of fewer words is one shingle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash64 = xxhash.xxh64_intdigest
        for batch in batches:
            out = np.zeros(batch.num_rows, dtype=np.uint64)
            for row, end, data, offsets in text_chunks(batch.column(1)):
                words = split_words(data, offsets)
                spaced, at, stop = words.spaced(lower=True)
                n = words.count()
                shingles = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
                of_text = np.concatenate(([0], np.cumsum(shingles)))
                first = np.arange(of_text[-1]) + np.repeat(words.of_text[:-1] - of_text[:-1], shingles)
                last = np.minimum(first + shingle, np.repeat(words.of_text[1:], shingles)) - 1
                hashes = np.array([hash64(spaced[a:b], SEED) for a, b in zip(at[first].tolist(), stop[last].tolist())],
                                  dtype=np.uint64)
                some = np.flatnonzero(shingles)
                for part in np.array_split(some, max(1, len(hashes) // 200_000)):  # 64 bytes a hash at a time
                    if not len(part):
                        continue
                    lo, hi = of_text[part[0]], of_text[part[-1] + 1]
                    bits = np.unpackbits(hashes[lo:hi].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    total = np.add.reduceat(bits, of_text[part] - lo, axis=0, dtype=np.int32)
                    out[row + part] = np.packbits(2 * total > shingles[part, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["id", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")) \
        .mapInArrow(run, f"id {kind}, fp long")


def anchors(fp: Column, distance: int) -> Column:
    """All anchors of a fingerprint, as an array of longs: the half in bit 32, the code word below."""
    if not 0 <= distance <= 5:
        raise ValueError("the covering is laid out for 0 to 5 differing bits")
    halves = []
    for half in (0, 1):
        word = F.shiftrightunsigned(fp, 32 * half).bitwiseAND(F.lit((1 << 31) - 1).cast("long"))
        syndrome = F.lit(0).cast("long")
        for k in range(5):  # position p (1..31) of the word is bit p - 1; bit k of the syndrome: parity of the p with bit k
            mask = sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1)
            syndrome = syndrome + F.shiftleft(F.bit_count(word.bitwiseAND(F.lit(mask).cast("long"))) % 2, k).cast("long")
        tag = F.lit(half << 32).cast("long")
        near = F.when(syndrome == 0, word).otherwise(word.bitwiseXOR(_bit(syndrome)))
        found = F.array(near)
        if distance >= 2:  # code words two flips away: pairs of positions whose exclusive or is the syndrome
            far = F.transform(
                F.filter(F.sequence(F.lit(1).cast("long"), F.lit(31).cast("long")),
                         lambda i: (i < i.bitwiseXOR(syndrome)) & (syndrome > 0)),
                lambda i: word.bitwiseXOR(_bit(i)).bitwiseXOR(_bit(i.bitwiseXOR(syndrome))))
            found = F.concat(found, far)
        halves.append(F.transform(found, lambda x: x + tag))
    return F.concat(*halves)


def _bit(position: Column) -> Column:
    """The word with only the given position (1..31) set."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (position - 1).cast("int"))


def _distance(x: np.ndarray, y) -> np.ndarray:
    return np.bitwise_count(x ^ y)


def _forest(fp: np.ndarray, name: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join the members of one anchor as all their pairs within ``distance`` do.

    Breadth first over the members not reached yet, so a dense group costs few passes.
    """
    out = []
    todo = np.arange(len(fp))
    while len(todo):
        front, todo = [todo[0]], todo[1:]
        while front and len(todo):
            at = front.pop()
            close = _distance(fp[todo], fp[at]) <= distance
            if close.any():
                found = todo[close]
                out.append((np.repeat(name[at], len(found)), name[found]))
                todo = todo[~close]
                front.extend(found.tolist())
    return out


def _compare(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches sorted by tile; a tile may go over several batches."""
        held = None
        for columns in chain(_columns(batches), [None]):
            if columns is None:
                now, held = held, None
            else:
                now = columns if held is None else [np.concatenate(x) for x in zip(held, columns)]
                cutoff = np.searchsorted(now[0], now[0][-1], "left")
                now, held = [x[:cutoff] for x in now], [x[cutoff:] for x in now]
            if now is None or not len(now[0]):
                continue
            tile, fp, name = now
            start = np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))
            size = np.diff(np.append(start, len(tile)))
            left, right = [], []
            short = np.repeat(size <= SHORT, size)
            t, f, n = tile[short], fp[short], name[short]
            for step in range(1, SHORT):
                same = np.flatnonzero(t[step:] == t[:-step])
                if not len(same):
                    break
                same = same[_distance(f[same], f[same + step]) <= distance]
                left.append(n[same])
                right.append(n[same + step])
            for at, width in zip(start[size > SHORT], size[size > SHORT]):
                for a, b in _forest(fp[at:at + width], name[at:at + width], distance):
                    left.append(a)
                    right.append(b)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))],
                                                 names=["a", "b"])

    return run


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield [batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy()]


def links(distinct: DataFrame, distance: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect what all pairs of fingerprints within ``distance`` connect.

    ``distinct``: (fp, id), each fingerprint once.
    """
    spread = distinct.select("fp", "id", F.explode(anchors(F.col("fp"), distance)).alias("anchor"))
    # how many meet at each anchor, summed before the shuffle; alone: nothing to compare
    met = cut(spread.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
              .select("anchor", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "shared-anchors")
    spread = spread.join(met, "anchor")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # block i meets block j in tile (i, j), i <= j: each member goes to its row and column
    tiles = spread.withColumn("own", own).withColumn(
        "tile", F.explode(F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"))))
                          .otherwise(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                                                 lambda k: F.struct(F.least(F.col("own"), k).alias("i"),
                                                                    F.greatest(F.col("own"), k).alias("j"))))))
    tile = F.when(F.col("blocks") == 1, F.col("anchor")).otherwise(F.xxhash64("anchor", "tile.i", "tile.j"))
    tiles = tiles.select(tile.alias("tile"), "fp", "id").repartition("tile").sortWithinPartitions("tile")
    return tiles.mapInArrow(_compare(distance), "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4,
                    distance: int = 4, block: int = BLOCK) -> DataFrame:
    """(id, fp, component) per row of ``docs``; component: the smallest id reachable over links."""
    prints = cut(fingerprints(docs, key, text, shingle), "fingerprints")
    distinct = cut(prints.groupBy("fp").agg(F.min("id").cast("long").alias("id")).where("id is not null"), "distinct-fingerprints")
    found = components(links(distinct, distance, block))
    labels = distinct.join(found, distinct["id"] == found["node"], "left") \
        .select("fp", F.coalesce("component", "id").alias("component"))
    return prints.join(labels, "fp", "left").select("id", "fp", "component")


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4,
                  distance: int = 4, block: int = BLOCK) -> DataFrame:
    """(id, h): of each group of near-duplicate texts the smallest id, and the hash of its text.

    Groups are those of fingerprints, not of ids: rows that repeat an id with texts of several
    groups are in each of them. h is ``xxhash64`` of the text, the least one of the id in its
    group. Null ids are in no group.
    """
    marked = docs.where(F.col(key).isNotNull()) \
        .select(F.struct(F.col(key).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("h")).alias("mark"), F.col(text).alias("text"))
    prints = fingerprints(marked, "mark", "text", shingle)
    firsts = cut(prints.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    # a fingerprint stands for itself in the graph
    found = components(links(firsts.select("fp", F.col("fp").alias("id")), distance, block))
    return firsts.join(found, firsts["fp"] == found["node"], "left").groupBy(F.coalesce("component", "fp").alias("component")) \
        .agg(F.min("first").alias("first")).select("first.*")
