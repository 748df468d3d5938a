"""Substring dedup with a sparse suffix array.

Of all suffixes only those at minimisers are retained: the positions whose run of
``GRAM`` words has the least hash among ``SPAN`` neighbouring positions. They are chosen
by content alone, so a run of words that two documents share has the same minimisers in
both, the first of them less than ``SPAN`` words after its start. Suffixes whose first
``GRAM`` words no other document has are dropped before their words travel.

A match of ``words`` words that starts less than ``SPAN`` words before a minimiser holds
the first ``words - SPAN + 1`` words of its suffix. So the suffixes are dealt by those
(their prefix) and sorted, within a prefix, by the words after it. Neighbours' common
prefixes say how far a match extends right. Each prefix's suffixes are then sorted by the
words before them, backwards, and neighbours' common parts say how far it extends left.
For each way to part ``words`` words into a left and a right part, the suffixes equal in
both are a run of the two orders; if it has two documents, the match is theirs. All
documents of a run are seen, not only the nearest, so that a passage that many documents
have doesn't hide a longer match. Matches that overlap or adjoin are one span.

Skew: equal suffixes (with equal words before them) of a task are one row, which speaks
for the two smallest of their documents; the others' spans are joined up in the task and
get their partner by a join that AQE may split. A prefix with more than ``1 / (SHARE * partitions)`` of all rows goes deeper:
its suffixes are dealt by each whole match that they could be part of. At most ``SHARE *
partitions`` prefixes are, so the list of them is broadcast.

Prefixes are compared by hashes of 64 and 31 bits, other words by 40 bits each. Defined
results: a null text counts as empty; texts of fewer than ``words`` words have no
span; a document with a null id has none, and rows that repeat an id give no match with
themselves and are answered as one: spans of them that overlap by position are joined.
Ids must be integers: the key is cast to long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .repeats import repeated, with_hashes
from .storage import cut
from .textops import Hasher, Words, mix, pair_hash, split_words, text_chunks, windows_in_text

WORDS = 50
GRAM = 8
SPAN = 16

#: Bytes by which a word beyond the prefix is compared.
BYTES = 5
#: Suffixes that a task settles, or compares, at a time (or one prefix's, if those are more).
POOL = 1 << 16
#: A prefix is split if it has more rows than this and than 1 / (SHARE * shuffle partitions) of all.
FLOOR = 1 << 10
SHARE = 4

NONE = np.iinfo(np.int64).max
SPAN_ROW, GROUP_ROW, SETTLED_ROW = 0, 1, 2
_SUFFIX = "k long, more int, suffix binary, doc long, second long, at binary, ahead int, behind int, key long, settled boolean"
_FOUND = "state byte, key long, more int, doc long, first int, last int, a long, b long"


def layout(words: int) -> tuple[int, int]:
    """Words of a minimiser's run and positions per minimiser, for runs of ``words`` words."""
    gram = max(1, min(GRAM, words // 4))
    return gram, max(1, min(SPAN, words - gram))


def minimisers(words: Words, hashes: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    """Which of the positions ``at`` (words that start a run, ``hashes`` of the runs) are minimisers."""
    n = len(at)
    if n < span:
        return np.zeros(0, dtype=np.int64)
    best, where = hashes.copy(), np.arange(n)
    width = 1
    while width < span:  # the least of 2, 4, .. neighbours, the first of equals
        step = min(width, span - width)
        least, place = best[step:], where[step:]
        take = least < best[:-step]
        best = np.where(take, least, best[:-step])
        where = np.where(take, place, where[:-step])
        width += step
    text = np.searchsorted(words.of_text, at, "right")
    whole = text[:n - span + 1] == text[span - 1:]
    return np.unique(where[whole])


def _chosen(words: Words, hasher: Hasher, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words, word indexes of the minimisers and hashes of their runs."""
    gram, span = layout(size)
    of_word = hasher.words(words.kept, words.start)
    at = windows_in_text(words, gram)
    long = np.repeat(words.count() >= size, words.count())
    at = at[long[at]]
    hashes = hasher.runs(of_word, at, gram)
    pick = minimisers(words, hashes, at, span)
    return of_word, at[pick], hashes[pick]


def _emit_grams(size: int):
    def emit(batches: Iterator[pa.RecordBatch]):
        hasher = Hasher.seeded(31)
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids = batch.column(0).to_numpy()
            for row, _, data, offsets in text_chunks(batch.column(1)):
                words = split_words(data, offsets)
                _, at, hashes = _chosen(words, hasher, size)
                yield hashes, np.zeros(len(at), np.int32), ids[row + np.searchsorted(words.of_text, at, "right") - 1]

    return emit


def _listed(column: pa.Array, row: int) -> np.ndarray:
    return column[row].values.to_numpy() if column[row].is_valid else np.zeros(0, np.int64)


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary value per row; ``data`` are their bytes end to end."""
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and the size of each value."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, np.diff(offsets)


def _around(of_word: np.ndarray, words: Words, at: np.ndarray, size: int):
    """Words after the prefix, words before it backwards (a row each), and how many there are."""
    _, span = layout(size)
    side, lead = span - 1, size - span + 1
    text = np.searchsorted(words.of_text, at, "right") - 1
    ahead = np.minimum(words.of_text[text + 1] - at, size)
    behind = np.minimum(at - words.of_text[text], side)
    low = of_word & np.uint64((1 << (8 * BYTES)) - 1)
    steps = np.arange(side)
    right = low[np.minimum(at[:, None] + lead + steps, len(low) - 1)]
    right[steps + lead >= ahead[:, None]] = 0
    left = low[np.maximum(at[:, None] - 1 - steps, 0)]
    left[steps >= behind[:, None]] = 0
    return np.concatenate((right, left), axis=1), ahead, behind


def _joined_up(rows: np.ndarray, doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of spans of a document that overlap or adjoin, those that start first, one of them with the end of all."""
    if not len(rows):
        return rows, last
    order = np.lexsort((first, doc))
    rows, doc, first, last = (x[order] for x in (rows, doc, first, last))
    apart = np.cumsum(np.append(False, doc[1:] != doc[:-1])) << 33  # documents far from each other
    reach = np.maximum.accumulate(last + apart)
    opens = np.flatnonzero(np.append(True, (first + apart)[1:] > reach[:-1]))
    size = np.diff(np.append(opens, len(rows)))
    last[opens] = np.maximum.reduceat(last, opens)
    keep = first == np.repeat(first[opens], size)
    return rows[keep], last[keep]


def _settled(k, more, around, doc, at, ahead, behind) -> pa.RecordBatch:
    """One row for equal suffixes with equal words before them; the documents it doesn't name are settled."""
    key = pair_hash(k, more.astype(np.uint64) ^ (ahead.astype(np.uint64) << np.uint64(40)) ^ (behind.astype(np.uint64) << np.uint64(52)))
    for column in around.T:
        key = pair_hash(key, column)
    order = np.lexsort((at, doc, key))
    repeats = (key[order][1:] == key[order][:-1]) & (doc[order][1:] == doc[order][:-1]) & (at[order][1:] == at[order][:-1])
    order = order[np.append(True, ~repeats)]
    new_key = np.append(True, key[order][1:] != key[order][:-1])
    sub = np.flatnonzero(new_key | np.append(True, doc[order][1:] != doc[order][:-1]))  # a key and document
    sizes = np.diff(np.append(sub, len(order)))
    speaks = new_key[sub]
    row = order[sub]
    several = np.append(~speaks[1:], False) & speaks
    second = np.where(several, doc[np.append(row[1:], row[-1:])], doc[row])
    told, rest = row[speaks], order[~np.repeat(speaks, sizes)]
    rest, last = _joined_up(rest, doc[rest], (at - behind)[rest], (at + ahead)[rest])
    take = np.concatenate((told, rest))
    spread = mix(key[rest] ^ mix(doc[rest].view(np.uint64)))
    suffix = np.ascontiguousarray(around[told]).view(np.uint8).reshape(len(told), around.shape[1], 8)[:, :, :BYTES]
    width = around.shape[1] * BYTES
    places = np.concatenate((at[order][np.repeat(speaks, sizes)], at[rest])).astype(np.int32)
    ones = np.ones(len(rest), np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate((k[told], spread)).view(np.int64)), pa.array(more[take].astype(np.int32)),
        _binary(suffix.reshape(-1), np.concatenate((np.full(len(told), width), ones * 0))), pa.array(doc[take]),
        pa.array(np.concatenate((second[speaks], doc[rest]))),
        _binary(places.view(np.uint8), 4 * np.concatenate((sizes[speaks], ones))),
        pa.array(np.concatenate((ahead[told], last - at[rest])).astype(np.int32)), pa.array(behind[take].astype(np.int32)), pa.array(key[take].view(np.int64)),
        pa.array(np.arange(len(take)) >= len(told))],
        names=["k", "more", "suffix", "doc", "second", "at", "ahead", "behind", "key", "settled"])


def _suffixes(size: int, heavy: np.ndarray):
    """Rows of the retained suffixes, with the words around their prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, check = Hasher.seeded(31), Hasher.seeded(32)
        _, span = layout(size)
        held: list[tuple] = []
        n = 0
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids, lists = batch.column(0).to_numpy(), batch.column(2)
            for row, end, data, offsets in text_chunks(batch.column(1)):
                if not any(lists[i].is_valid for i in range(row, end)):
                    continue
                words = split_words(data, offsets)
                of_word, at, hashes = _chosen(words, hasher, size)
                edge = np.searchsorted(at, words.of_text)
                take = [edge[t] + np.flatnonzero(np.isin(hashes[edge[t]:edge[t + 1]], _listed(lists, row + t).view(np.uint64)))
                        for t in range(end - row)]
                at = at[np.concatenate(take).astype(np.int64)]
                text = np.searchsorted(words.of_text, at, "right") - 1
                # a match needs its words around the minimiser
                at = at[np.minimum(words.of_text[text + 1] - at, size) + np.minimum(at - words.of_text[text], span - 1) >= size]
                if not len(at):
                    continue
                second = check.words(words.kept, words.start)
                k, more = (h.runs(w, at, size - span + 1) for h, w in ((hasher, of_word), (check, second)))
                for lo in range(0, len(at), POOL):
                    part = slice(lo, lo + POOL)
                    for rows in _deepened(words, size, heavy, (hasher, check), (of_word, second), at[part], k[part], more[part]):
                        text = np.searchsorted(words.of_text, rows[3], "right") - 1
                        held.append((rows[0], rows[1] >> np.uint64(33), rows[2], ids[row + text], rows[3] - words.of_text[text], *rows[4:]))
                        n += len(text)
                        if n >= POOL:
                            yield _settled(*(np.concatenate(x) for x in zip(*held)))
                            held, n = [], 0
        if n:
            yield _settled(*(np.concatenate(x) for x in zip(*held)))

    return run


def _deepened(words: Words, size: int, heavy: np.ndarray, hashers, hashes, at, k, more):
    """(key, check, words around, position, words ahead, words behind); for heavy prefixes whole matches instead, with no words around."""
    around, ahead, behind = _around(hashes[0], words, at, size)
    deep = np.isin(k, heavy)
    if not deep.all():
        yield tuple(x[~deep] for x in (k, more, around, at, ahead, behind))
    for left in range(around.shape[1] // 2 + 1) if deep.any() else ():
        fits = deep & (behind >= left) & (ahead >= size - left)
        if fits.any():
            first = at[fits] - left
            yield (*(h.runs(w, first, size) for h, w in zip(hashers, hashes)), np.zeros_like(around[fits]), first,
                   np.full(len(first), size), np.zeros(len(first), np.int64))


def _prefixes(size: int):
    """(k, n): rows of each prefix, as a task would send them."""
    rows = _suffixes(size, np.zeros(0, np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            k, n = np.unique(batch.column(0).filter(pc.invert(batch.column(9))).to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n.astype(np.int64))], names=["k", "n"])

    return run


def _common(words: np.ndarray, same: np.ndarray) -> np.ndarray:
    """For each row: leading words that equal those of the row before; -1 where ``same`` is false."""
    out = np.full(len(words), -1)
    differ = words[1:] != words[:-1]
    equal = np.where(differ.any(1), differ.argmax(1), words.shape[1]) // BYTES
    out[1:] = np.where(same[1:], equal, -1)
    return out


def _compare(size: int, k, more, suffix, doc, second, ahead, behind):
    """(least and most words before the suffix that a match has, two smallest documents) of each suffix.

    The documents are those of the match that starts first. The rows are whole prefixes,
    sorted by prefix and words. For a row without a match the most is -1.
    """
    _, span = layout(size)
    side, n = span - 1, len(k)
    same = np.append(False, (k[1:] == k[:-1]) & (more[1:] == more[:-1]))
    right, left = suffix[:, :side * BYTES], suffix[:, side * BYTES:]
    to_right = _common(right, same)
    prefix = np.cumsum(~same)
    # the second order: within a prefix, by the words before, backwards
    back = np.concatenate((prefix.astype(">i8").view(np.uint8).reshape(n, 8), left), axis=1)
    back = np.argsort(np.ascontiguousarray(back).view(f"S{back.shape[1]}").ravel(), kind="stable")
    to_left = _common(left[back], np.append(False, prefix[back][1:] == prefix[back][:-1]))
    least, most = np.full(n, size), np.full(n, -1)
    a, b = np.full(n, NONE), np.full(n, NONE)
    for before in range(span):
        fits = np.flatnonzero((behind >= before) & (ahead >= size - before))
        if len(fits) == 0:
            continue
        of_left = np.empty(n, dtype=np.int64)
        of_left[back] = np.cumsum(to_left < before)
        group = np.cumsum(to_right < side - before) * (n + 1) + of_left
        group = group[fits]
        order = np.argsort(group, kind="stable")
        row = fits[order]
        start = np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1]))
        length = np.diff(np.append(start, len(row)))
        lowest = np.repeat(np.minimum.reduceat(doc[row], start), length)
        next_ = np.minimum(np.where(doc[row] != lowest, doc[row], NONE), np.where(second[row] != lowest, second[row], NONE))
        next_ = np.repeat(np.minimum.reduceat(next_, start), length)
        hit = next_ != NONE
        row, lowest, next_ = row[hit], lowest[hit], next_[hit]
        least[row] = np.minimum(least[row], before)
        most[row] = before
        a[row], b[row] = lowest, next_
    return least, most, a, b


def _matches(size: int):
    """Spans, and the smallest documents of the groups that a row speaks for; rows come sorted."""
    _, span = layout(size)
    width = 2 * (span - 1) * BYTES

    def out(state, key, more, doc, first, last, a, b) -> pa.RecordBatch:
        kinds = (np.int64, np.int32, np.int64, np.int32, np.int32, np.int64, np.int64)
        columns = [pa.array(x.astype(t)) for x, t in zip((key, more, doc, first, last, a, b), kinds)]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), state, np.int8)), *columns],
                                          names=["state", "key", "more", "doc", "first", "last", "a", "b"])

    def compare(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        k, more, doc, second, ahead, behind, key = (rows.column(i).to_numpy() for i in (0, 1, 3, 4, 6, 7, 8))
        suffix = _bytes_of(rows.column(2))[0].reshape(len(k), width)
        places, sizes = _bytes_of(rows.column(5))
        least, most, a, b = _compare(size, k, more, suffix, doc, second, ahead, behind)
        found = np.repeat(most >= 0, sizes // 4)
        at = np.frombuffer(places.tobytes(), np.int32)[found]
        row = np.repeat(np.arange(len(k)), sizes // 4)[found]
        other = np.where(a != doc, a, b)
        yield out(SPAN_ROW, key[row], more[row], doc[row], at - most[row], at - least[row] + size, other[row], other[row])
        many = second != doc
        yield out(GROUP_ROW, key[many], more[many], doc[many], ahead[many], ahead[many], a[many], b[many])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            settled = batch.filter(batch.column(9))
            if settled.num_rows:
                more, doc, ahead, behind, key = (settled.column(i).to_numpy() for i in (1, 3, 6, 7, 8))
                at = np.frombuffer(_bytes_of(settled.column(5))[0].tobytes(), np.int32)
                yield out(SETTLED_ROW, key, more, doc, at - behind, at + ahead, doc, doc)
            rest = batch.filter(pc.invert(batch.column(9)))
            if not rest.num_rows:
                continue
            held.append(rest)
            n += rest.num_rows
            if n >= POOL and held[0].column(0)[0].as_py() != rest.column(0)[-1].as_py():
                rows = pa.concat_batches(held)
                k = rows.column(0).to_numpy()
                whole = int(np.searchsorted(k, k[-1], "left"))
                yield from compare(rows.slice(0, whole))
                held, n = [rows.slice(whole)], len(k) - whole
        if n:
            yield from compare(pa.concat_batches(held))

    return run


def _heavy(suffixes: DataFrame, size: int) -> np.ndarray:
    """Prefixes that would make a task's rows too many, SHARE * partitions of them at most."""
    counts = suffixes.mapInArrow(_prefixes(size), "k long, n long").rollup("k") \
        .agg(F.sum("n").alias("n"), F.grouping("k").alias("all"))
    counts = cut(counts.where((F.col("n") > FLOOR) | (F.col("all") == 1)), "suffix-prefixes")
    total = counts.where(F.col("all") == 1).first()
    partitions = int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = max(FLOOR, (total.n or 0 if total else 0) // (SHARE * partitions))
    found = counts.where((F.col("all") == 0) & (F.col("n") > limit)).select("k").collect()
    return np.array([r.k for r in found], dtype=np.int64).view(np.uint64)


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(id, first_word, end_word, other): runs of ``words`` words or more that another document has, too.

    ``other``: the smallest other document that has the span's first ``words`` words.
    """
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    shared = with_hashes(texts, repeated(texts, _emit_grams(words))).where("hashes is not null")
    rows = shared.mapInArrow(_suffixes(words, _heavy(shared, words)), _SUFFIX)
    rows = rows.repartition("k").sortWithinPartitions("k", "more", "suffix")
    found = cut(rows.mapInArrow(_matches(words), _FOUND), "suffix-matches")
    groups = found.where(F.col("state") == GROUP_ROW).groupBy("key", "more").agg(F.min("a").alias("a"), F.min("b").alias("b"))
    settled = found.where(F.col("state") == SETTLED_ROW).drop("a", "b").join(groups, ["key", "more"])
    settled = settled.withColumn("a", F.when(F.col("a") != F.col("doc"), F.col("a")).otherwise(F.col("b")))
    columns = [F.col("doc").alias("id"), "first", "last", F.col("a").alias("other")]
    spans = found.where(F.col("state") == SPAN_ROW).select(columns).union(settled.select(columns))
    by_doc = Window.partitionBy("id").orderBy("first", "last")
    reach = F.max("last").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    joined = spans.withColumn("opens", (F.coalesce(reach, F.lit(-1)) < F.col("first")).cast("int")) \
        .withColumn("island", F.sum("opens").over(by_doc))
    return joined.groupBy("id", "island").agg(
        F.min("first").cast("long").alias("first_word"), F.max("last").cast("long").alias("end_word"),
        F.min(F.struct("first", "other"))["other"].alias("other")).drop("island")
