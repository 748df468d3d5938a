"""Substring dedup with difference-cover anchors.

``COVER`` modulo ``PERIOD`` is a difference cover: for any two positions i and j there is
a shift below the period that takes both onto cover positions. So if two documents share
a run of ``words`` words, at whatever positions, they share a run of
``words - PERIOD + 1`` words that starts at a cover position in both, in the first
``PERIOD`` words of the run: the anchor. Only runs at cover positions (6 of 31) are
hashed and shuffled. Each shared anchor is then extended: the windows of ``words`` words
around it are hashed and compared between the documents, which finds the shared run to
both its ends without setting documents against each other pair by pair.

A window whose words also start in a document with a smaller id is removed from this
document; windows are judged on the texts as they came.

Windows are compared by hashes of 64 and 31 bits of their words. Defined results: a null text
counts as empty; texts of fewer than ``words`` words stay whole; a document with a null
id stays whole and lends no window; repeated rows of one id don't remove each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import repeated, with_hashes
from .textops import Hasher, Words, split_words, text_chunks, windows_in_text

WORDS = 50
PERIOD = 31
#: Every difference modulo 31 is one of two of these (a perfect difference set).
COVER = (0, 1, 3, 8, 12, 18)


def _cover_mask(words: int) -> tuple[int, np.ndarray]:
    """Period and cover positions for windows of so many words."""
    if words > PERIOD:
        mask = np.zeros(PERIOD, dtype=bool)
        mask[list(COVER)] = True
        return PERIOD, mask
    return 1, np.ones(1, dtype=bool)


def _positions(words: Words, at: np.ndarray) -> np.ndarray:
    """Of words ``at``: their positions in their texts."""
    return at - np.repeat(words.of_text[:-1], words.count())[at]


def _anchors(words: Words, size: int) -> tuple[np.ndarray, int]:
    """Word indexes of the anchors, of texts that have a window, and an anchor's length."""
    period, mask = _cover_mask(size)
    length = size - period + 1
    at = windows_in_text(words, length)
    long = np.repeat(words.count() >= size, words.count())
    return at[mask[_positions(words, at) % period] & long[at]], length


def _hit(hashes: np.ndarray, found: np.ndarray) -> np.ndarray:
    """``found``: sorted."""
    at = np.minimum(np.searchsorted(found, hashes), len(found) - 1)
    return found[at] == hashes


def _spread(starts: np.ndarray, n: int, before: int, after: int) -> np.ndarray:
    """Flags of the positions from ``start - before`` to ``start + after`` (exclusive), for each start."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, np.maximum(starts - before, 0), 1)
    np.add.at(edge, np.minimum(starts + after, n), -1)
    return np.cumsum(edge[:-1]) > 0


def _emit_anchors(size: int):
    def emit(batches: Iterator[pa.RecordBatch]):
        hasher = Hasher.seeded(21)
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids = batch.column(0).to_numpy()
            for row, _, data, offsets in text_chunks(batch.column(1)):
                words = split_words(data, offsets)
                at, length = _anchors(words, size)
                hashes = hasher.runs(hasher.words(words.kept, words.start), at, length)
                doc = ids[row + np.searchsorted(words.of_text, at, "right") - 1]
                yield hashes, np.zeros(len(at), np.int32), doc

    return emit


def _some(batch: pa.RecordBatch) -> Iterator[tuple[int, Words, np.ndarray, list]]:
    """Chunks of a batch (id, text, hashes): first row, words, and each text's found hashes (sorted) or None."""
    lists = batch.column(2)
    for row, end, data, offsets in text_chunks(batch.column(1)):
        values = [np.sort(lists[i].values.to_numpy().view(np.uint64)) if lists[i].is_valid and len(lists[i]) else None
                  for i in range(row, end)]
        yield row, data, offsets, values


def _emit_windows(size: int):
    """Windows around shared anchors."""
    def emit(batches: Iterator[pa.RecordBatch]):
        hasher, check = Hasher.seeded(21), Hasher.seeded(22)
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids = batch.column(0).to_numpy()
            for row, data, offsets, found in _some(batch):
                if not any(f is not None for f in found):
                    continue
                words = split_words(data, offsets)
                of_words = hasher.words(words.kept, words.start)
                at, length = _anchors(words, size)
                hashes = hasher.runs(of_words, at, length)
                edge = np.searchsorted(at, words.of_text)
                take = []
                for t, shared in enumerate(found):
                    lo, hi = edge[t], edge[t + 1]
                    if shared is None or lo == hi:
                        continue
                    first, n = words.of_text[t], words.of_text[t + 1] - words.of_text[t] - size + 1
                    own = at[lo:hi][_hit(hashes[lo:hi], shared)] - first
                    take.append(first + np.flatnonzero(_spread(own, n, size - length, 1)[:n]))
                if not take:
                    continue
                take = np.concatenate(take)
                second = check.runs(check.words(words.kept, words.start), take, size)
                doc = ids[row + np.searchsorted(words.of_text, take, "right") - 1]
                yield hasher.runs(of_words, take, size), (second >> np.uint64(33)).astype(np.int32), doc

    return emit


def _cut(size: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher.seeded(21)
        for batch in batches:
            n_words, n_removed, digests, texts = [], [], [], []
            for _, data, offsets, found in _some(batch):
                words = split_words(data, offsets)
                spaced, start, stop = words.spaced()
                of_words = None
                for t, shared in enumerate(found):
                    lo, hi = words.of_text[t], words.of_text[t + 1]
                    kept = spaced[start[lo]:stop[hi - 1]] if hi > lo else b""
                    gone = 0
                    if shared is not None and hi - lo >= size:
                        of_words = hasher.words(words.kept, words.start) if of_words is None else of_words
                        windows = hasher.runs(of_words[lo:hi], np.arange(hi - lo - size + 1), size)
                        drop = _spread(np.flatnonzero(_hit(windows, shared)), hi - lo, 0, size)
                        gone = int(drop.sum())
                        kept = b" ".join(spaced[start[w]:stop[w]] for w in (lo + np.flatnonzero(~drop)).tolist())
                    n_words.append(int(hi - lo))
                    n_removed.append(gone)
                    digests.append(hashlib.sha256(kept).hexdigest())
                    texts.append(kept.decode() if keep else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                names=["id", "n_words", "n_removed", "kept_sha256", "kept"])

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                   keep: bool = True) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept) per row; ``kept`` is null unless ``keep``.

    The texts are shuffled once, by id; both joins read that one exchange.
    """
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    anchored = with_hashes(texts, repeated(texts, _emit_anchors(words)))
    marked = with_hashes(texts, repeated(anchored, _emit_windows(words), smaller=True))
    return marked.mapInArrow(_cut(words, keep), "id long, n_words long, n_removed long, kept_sha256 string, kept string")
