"""Which hashes of a document occur in other documents as well.

Every task first settles what it can see alone: of a hash that several of its documents
have, it sends on one row, however many they are. So a hash that a third of all
documents have costs one row per task, not one per document, and no group in the
shuffle grows with its copies. What is settled already travels in the same shuffle,
spread by document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import mix

#: Rows that a task settles at a time.
POOL = 1 << 19
ALONE, MANY, SETTLED = 0, 1, 2

#: From batches of a partition: (hash, further bits of the hash, document) arrays.
Emit = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows starts."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return new


def _settle(h: np.ndarray, more: np.ndarray, doc: np.ndarray, smaller: bool) -> list[np.ndarray]:
    """(shuffle key, more, document, state, hash, partner) rows for the hashes seen by one task.

    A hash is its own shuffle key; what is settled goes by document and takes its hash along.
    """
    order = np.lexsort((doc, more, h))
    h, more, doc = h[order], more[order], doc[order]
    once = _starts(h, more, doc)
    h, more, doc = h[once], more[once], doc[once]
    first = _starts(h, more)
    start = np.flatnonzero(first)
    size = np.diff(np.append(start, len(h)))
    state = np.full(len(h), SETTLED, dtype=np.int8)
    if smaller:  # the smallest document speaks for all; those above it are settled
        state[start] = ALONE
    else:  # two documents settle each other; one row tells other tasks
        state[np.repeat(size == 1, size)] = ALONE
    settled = state == SETTLED
    key = np.where(settled, mix(doc.view(np.uint64) + np.uint64(0x51ED27)), h)
    # the partner: the smallest other document of the task's group
    second = doc[np.minimum(start + 1, len(doc) - 1)] if len(doc) else doc
    partner = np.repeat(doc[start], size)
    partner[start] = np.where(size > 1, second, doc[start])
    out = [key, more, doc, state, np.where(settled, h, np.uint64(0)), partner]
    if not smaller and (size > 1).any():
        tell = start[size > 1]
        out = [np.concatenate(x) for x in zip(out, [
            h[tell], more[tell], doc[tell], np.full(len(tell), MANY, np.int8), np.zeros(len(tell), np.uint64),
            partner[tell]])]
    return [x.view(np.int64) if x.dtype == np.uint64 else x for x in out]


def _map(emit: Emit, smaller: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            rows = _settle(*(np.concatenate(x) for x in zip(*held)), smaller)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in rows[:len(names)]], names=names)

        n = 0
        for found in emit(batches):
            held.append(found)
            n += len(found[0])
            if n >= POOL:
                yield flush()
                n = 0
        if n:
            yield flush()

    return run


def _reduce(smaller: bool, partners: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (k, more, doc); a key may go over several batches."""
        held = None
        columns = ([c.to_numpy() for c in b.columns] for b in batches if b.num_rows)
        for now in chain(columns, [None]):
            if now is None:
                now, held = held, None
                if now is None:
                    return
            else:
                if held is not None:
                    now = [np.concatenate(x) for x in zip(held, now)]
                cut = int(np.searchsorted(now[0], now[0][-1], "left"))
                now, held = [x[:cut] for x in now], [x[cut:] for x in now]
            h, more, doc, state, taken = now[:5]
            partner = now[5] if partners else doc
            settled = state == SETTLED
            out_h, out_doc, out_partner = [taken[settled]], [doc[settled]], [partner[settled]]
            h, more, doc, state, partner = (x[~settled] for x in (h, more, doc, state, partner))
            if len(h):
                start = np.flatnonzero(_starts(h, more))
                size = np.diff(np.append(start, len(h)))
                lowest = np.repeat(np.minimum.reduceat(doc, start), size)
                if smaller:
                    hit = doc > lowest
                else:
                    highest = np.repeat(np.maximum.reduceat(doc, start), size)
                    many = np.repeat(np.maximum.reduceat(state, start), size) == MANY
                    hit = (state == ALONE) & (many | (lowest != highest))
                out_h.append(h[hit])
                out_doc.append(doc[hit])
                if partners:
                    none = np.iinfo(np.int64).max
                    second = np.minimum(np.where(doc != lowest, doc, none), np.where((state == MANY) & (partner != lowest), partner, none))
                    second = np.repeat(np.minimum.reduceat(second, start), size)
                    out_partner.append(np.where(doc != lowest, lowest, second)[hit])
            out = [np.concatenate(out_doc), np.concatenate(out_h)] + ([np.concatenate(out_partner)] if partners else [])
            if len(out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["doc", "h", "partner"][:len(out)])

    return run


def repeated(source: DataFrame, emit: Emit, smaller: bool = False, partners: bool = False) -> DataFrame:
    """(doc, hashes): the document's hashes that another document has, too.

    ``smaller``: another document with a smaller id. Documents without any are not listed.
    ``partners``: with a list of the smallest other document met for each of the hashes.
    """
    names = ["k", "more", "doc", "state", "h"] + ["partner"] * partners
    rows = source.mapInArrow(_map(emit, smaller, names), "k long, more int, doc long, state byte, h long" + ", partner long" * partners)
    rows = rows.repartition("k").sortWithinPartitions("k", "more", "doc")
    found = rows.mapInArrow(_reduce(smaller, partners), "doc long, h long" + ", partner long" * partners)
    if not partners:
        return found.groupBy("doc").agg(F.collect_list("h").alias("hashes"))
    return found.groupBy("doc").agg(F.collect_list(F.struct("h", "partner")).alias("x")) \
        .select("doc", F.col("x.h").alias("hashes"), F.col("x.partner").alias("partners"))


def with_hashes(texts: DataFrame, found: DataFrame) -> DataFrame:
    """``texts`` (id, text) with the hashes found for each, null where none were."""
    return texts.join(found, texts["id"] == found["doc"], "left").select("id", "text", *found.columns[1:])
