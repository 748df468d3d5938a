"""Language identification with interpolated Kneser-Ney character models.

Fit: Spark counts the character 4-grams of every labelled text, per language. A
4-gram is packed in 60 bits (15 bits a character; letters in lower case, every run
of other characters is one boundary). The letters of the labelled texts are numbered,
so that no two of them share a code; a letter that they don't have is none of theirs.
Beyond 32,766 distinct letters the rarest share one code. All distinct 4-grams are kept under their whole
keys; from them follow the lower orders' continuation counts, the discounts and the
interpolation weights. Where the arrays of all that take ``MODEL_BYTES`` at most, the
driver smooths, and the tasks look keys up in sorted hash arrays.

A larger model is smoothed in Spark and stays a table. A character's log probability is
there a sum of what each order's n-gram and context add, one row per key and language
that has it. The sum may be taken in any order: the table is read in parts of
``MODEL_BYTES``, every part is broadcast and adds to the sums of all texts.

Score: each text gets the language of the lowest cross-entropy per character.
A text is accepted if that cross-entropy is near what texts of the language have
in the calibration sample.

Defined results: a null text, or one without letters, is ``und`` with score 0 and
not accepted. Without any labelled text, every text is. A tie goes to the language
that sorts first. Repeated rows are counted and answered each on its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import cut, free_name

ORDER = 4
CHAR_BITS = 15
#: Letters that have a code of their own; only a corpus of more distinct letters has some that share one.
LETTERS = (1 << CHAR_BITS) - 2
HASH_BITS = 63
#: Most that the arrays of a model, or of a part of a larger one, may take.
MODEL_BYTES = 1 << 26
#: Bytes of a row of a model's table in the sorted arrays.
ENTRY_BYTES = 24
#: Labelled texts that calibrate the rejection; only they are left out of the counts.
CALIBRATION_ROWS = 2000
CALIBRATION_SHARE = 20
#: Accepted: within so many times the calibration sample's 99.9 % deviation.
REJECT_AT = 2.0
#: A cross-entropy so many nats above the language's mean is accepted at any length.
SLACK = 0.75
#: n-grams a mapper holds before it pools them.
POOL = 1 << 21

UNKNOWN = "und"
RESULT = T.StructType([
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("accepted", T.BooleanType()),
    T.StructField("cross_entropy", T.DoubleType()),
    T.StructField("n_chars", T.LongType()),
])


class Alphabet:
    """Codes of characters: 0 no letter, 1 a letter without a code of its own, from 2 on the letters in order."""

    def __init__(self, letters: np.ndarray | list[int]):
        self.letters = np.unique(np.asarray(letters, dtype=np.uint32))
        self.low = _LETTER.astype(np.uint64)
        own = self.letters < 0x10000
        self.low[self.letters[own]] = 2 + np.flatnonzero(own).astype(np.uint64)

    @staticmethod
    def of(texts: list[str]) -> Alphabet:
        points, count = _letters_of(texts)
        return Alphabet(points)

    def codes(self, points: np.ndarray) -> np.ndarray:
        high = points > 0xFFFF
        if not high.any():
            return self.low[points]
        out = self.low[np.where(high, 0, points)]
        some, at = np.unique(points[high], return_inverse=True)
        code = np.array([chr(p).isalpha() for p in some.tolist()], dtype=np.uint64)
        if len(self.letters):
            place = np.minimum(np.searchsorted(self.letters, some), len(self.letters) - 1)
            code = np.where(self.letters[place] == some, 2 + place.astype(np.uint64), code)
        out[high] = code[at]
        return out


#: If a code point of the basic plane is a letter.
_LETTER = np.array([not 0xD800 <= c <= 0xDFFF and chr(c).isalpha() for c in range(0x10000)])


def _points(texts: list[str]) -> list[np.ndarray]:
    return [np.frombuffer(t.lower().encode("utf-32-le", "replace"), np.uint32) for t in texts]


def _letters_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of texts, and how often each is there."""
    points = np.concatenate([np.zeros(0, np.uint32), *_points(texts)])
    low = np.bincount(points[points < 0x10000], minlength=0x10000) * _LETTER
    high, count = np.unique(points[points >= 0x10000], return_counts=True)
    rare = np.array([chr(p).isalpha() for p in high.tolist()], dtype=bool)
    seen = np.flatnonzero(low)
    return np.concatenate((seen, high[rare])).astype(np.uint32), np.concatenate((low[seen], count[rare])).astype(np.int64)


def _count_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[int] = Counter()
    for batch in batches:
        for _, some in _slices(batch.column(0).to_pylist()):
            points, count = _letters_of(some)
            total.update(dict(zip(points.tolist(), count.tolist())))
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], names=["point", "n"])


def _alphabet(texts: DataFrame) -> Alphabet:
    """The letters of a column of texts. Unicode bounds their number; the most frequent ``LETTERS`` get codes."""
    found = texts.mapInArrow(_count_letters, "point int, n long").groupBy("point").agg(F.sum("n").alias("n"))
    return Alphabet([r.point for r in found.orderBy(F.desc("n"), "point").limit(LETTERS).collect()])


def _stream(texts: list[str], alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the n-grams that end at each kept character, and the characters per text."""
    points = _points(texts)
    size = np.array([len(p) for p in points], dtype=np.int64)
    joined = np.concatenate(points) if points else np.zeros(0, np.uint32)
    code = alphabet.codes(joined)
    first = np.zeros(len(joined) + 1, dtype=bool)
    first[np.cumsum(size) - size] = True
    first = first[:-1]
    before = np.empty_like(code)
    before[:1] = 0
    before[1:] = code[:-1]
    before[first] = 0
    keep = (code != 0) | (before != 0)  # a run of other characters is one boundary; none opens a text
    seen = np.concatenate(([0], np.cumsum(keep)))
    ends = np.cumsum(size)
    count = seen[ends] - seen[ends - size]
    code = code[keep]
    key = code.copy()
    for back in range(1, ORDER):
        key[back:] |= code[:-back] << np.uint64(CHAR_BITS * back)
    start = (np.cumsum(count) - count)[count > 0]
    width = count[count > 0]
    for j in range(ORDER - 1):  # the first characters of a text see only boundaries before it
        at = start[width > j] + j
        key[at] &= np.uint64((1 << CHAR_BITS * (j + 1)) - 1)
    return key, count


def _slot(key: np.ndarray, bits: int) -> np.ndarray:
    """Top bits of a multiplicative hash."""
    x = key * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return ((x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)


def _slices(texts: list[str | None], limit: int = 1 << 19) -> Iterator[tuple[int, list[str]]]:
    row = 0
    while row < len(texts):
        end, size = row, 0
        while end < len(texts) and (end == row or size + len(texts[end] or "") <= limit):
            size += len(texts[end] or "")
            end += 1
        yield row, [t or "" for t in texts[row:end]]
        row = end


def _pool(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[at], np.add.reduceat(count, at) if len(at) else count


def _tally(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.sort(key)
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[at], np.diff(np.append(at, len(key)))


def _count_grams(alphabet: Alphabet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list, list]] = {}
        waiting: dict[str, list] = {}

        def settle(lang: str) -> None:
            keys, counts = held.setdefault(lang, ([], []))
            if waiting.get(lang):
                key, count = _tally(np.concatenate(waiting.pop(lang)))
                keys.append(key)
                counts.append(count)
            if len(keys) > 1:
                held[lang] = tuple([x] for x in _pool(keys, counts))

        def emit(lang: str) -> pa.RecordBatch:
            key, count = held.pop(lang)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(key[0])), pa.array(key[0].view(np.int64)), pa.array(count[0].astype(np.int64))],
                names=["lang", "key", "n"])

        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            texts = batch.column(1)
            for lang in sorted(set(langs)):
                rows = np.flatnonzero(langs == lang)
                for _, some in _slices(texts.take(pa.array(rows)).to_pylist()):
                    key, _ = _stream(some, alphabet)
                    waiting.setdefault(lang, []).append(key)
                    if sum(map(len, waiting[lang])) >= POOL:
                        settle(lang)
                        if len(held[lang][0][0]) >= POOL:
                            yield emit(lang)
        for lang in sorted({*held, *waiting}):
            settle(lang)
            if lang in held and held[lang][0] and len(held[lang][0][0]):
                yield emit(lang)

    return run


@dataclass
class Model:
    """Sorted hash arrays per order: for each key, a value per language; or a table in parts."""

    langs: list[str]
    bits: int              # widest directory of the hashes
    grams: list[tuple]     # per order: hashes (sorted), their keys, log probabilities (keys x languages)
    contexts: list[tuple]  # per order: hashes (sorted), their keys, log interpolation weights
    floor: float           # log probability of an unknown character
    alphabet: Alphabet = None
    table: DataFrame = None                        # of a large model: key with its table, language, value
    parts: int = 1
    mean: np.ndarray = None                        # calibration, per language
    spread: np.ndarray = None
    reach: float = 0.0
    heat: float = 1.0


def _smooth(langs: list[str], bits: int, lang: np.ndarray, key: np.ndarray, count: np.ndarray) -> Model:
    """Interpolated Kneser-Ney from the n-grams (lang: index, key, count)."""
    by_order = {ORDER: (lang, key, count.astype(np.float64))}
    for order in range(ORDER - 1, 0, -1):
        # the continuation count of a gram: in how many longer gram types it is the suffix
        above_lang, above, _ = by_order[order + 1]
        suffix = above & np.uint64((1 << CHAR_BITS * order) - 1)
        order_by = np.lexsort((suffix, above_lang))
        a, s = above_lang[order_by], suffix[order_by]
        at = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (s[1:] != s[:-1])))
        by_order[order] = (a[at], s[at], np.diff(np.append(at, len(s))).astype(np.float64))
    n = len(langs)
    floor = -CHAR_BITS * np.log(2.0)
    grams, contexts = [], []
    below_keys, below = None, None
    for order in range(1, ORDER + 1):
        who, key, count = by_order[order]
        keys, at = np.unique(key, return_inverse=True)
        context_of = keys >> np.uint64(CHAR_BITS) if order > 1 else np.zeros(len(keys), np.uint64)
        ctx_keys, ctx_at = np.unique(context_of, return_inverse=True)
        total, types = (np.zeros((n, len(ctx_keys))) for _ in range(2))
        np.add.at(total, (who, ctx_at[at]), count)
        np.add.at(types, (who, ctx_at[at]), 1)
        discount = np.empty(n)
        for k in range(n):
            one, two = (count[who == k] == 1).sum(), (count[who == k] == 2).sum()
            discount[k] = one / (one + 2 * two) if one and two else 0.5
        known = total > 0
        weight = np.where(known, discount[:, None] * types / np.where(known, total, 1), 1.0)
        own = np.zeros((n, len(keys)))
        own[who, at] = np.maximum(count - discount[who], 0) / total[who, ctx_at[at]]
        if order == 1:
            lower = np.full((n, len(keys)), np.exp(floor))
        else:
            lower = below[:, np.searchsorted(below_keys, keys & np.uint64((1 << CHAR_BITS * (order - 1)) - 1))]
        below = own + weight[:, ctx_at] * lower
        below_keys = keys
        for out, k, values in ((grams, keys, np.log(below)), (contexts, ctx_keys, np.log(weight))):
            hashes = _slot(k, HASH_BITS)
            sort = np.argsort(hashes, kind="stable")
            out.append((hashes[sort], k[sort], np.ascontiguousarray(values.astype(np.float32)[:, sort].T)))
    return Model(langs, bits, grams, contexts, floor)


def _sub_keys(key, part: int):
    """What a 4-gram looks up in table ``part``: its n-grams (0..), then its contexts (ORDER..)."""
    order = part % ORDER + 1
    mask = (1 << CHAR_BITS * order) - 1
    if isinstance(key, Column):
        gram = key.bitwiseAND(F.lit(mask))
        return gram if part < ORDER else F.shiftright(gram, CHAR_BITS)
    gram = key & np.uint64(mask)
    return gram if part < ORDER else gram >> np.uint64(CHAR_BITS)


def _tagged(key, part: int):
    tag = part << CHAR_BITS * ORDER
    return key + F.lit(tag) if isinstance(key, Column) else key | np.uint64(tag)


def _smooth_table(langs: list[str], grams: DataFrame) -> tuple[DataFrame, float]:
    """The same from (lang, key, n) in Spark: (k, who, value) rows of all tables, and the floor.

    An n-gram's value is its log probability less what the next lower order and the
    context's weight give; a context's is its log weight. So the values that a character
    finds, and the floor, add up to its log probability.
    """
    by_order = {ORDER: grams}
    for order in range(ORDER - 1, 0, -1):
        by_order[order] = cut(by_order[order + 1].groupBy("lang", _sub_keys(F.col("key"), order - 1).alias("key"))
                              .agg(F.count("*").alias("n")), "language-orders")
    floor = -CHAR_BITS * float(np.log(2.0))
    below, tables = None, []
    for order in range(1, ORDER + 1):
        one, two = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        discounts = by_order[order].groupBy("lang").agg(
            F.when((one > 0) & (two > 0), one / (one + 2 * two)).otherwise(0.5).alias("discount"))
        rows = by_order[order].withColumn("context", _sub_keys(F.col("key"), ORDER + order - 1))
        contexts = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count("*").alias("types")) \
            .join(F.broadcast(discounts), "lang").withColumn("weight", F.col("discount") * F.col("types") / F.col("total"))
        contexts = cut(contexts, "language-contexts")
        rows = rows.join(contexts, ["lang", "context"])
        if below is None:
            rows = rows.withColumn("lower", F.exp(F.lit(floor)))
        else:
            rows = rows.withColumn("suffix", _sub_keys(F.col("key"), order - 2)) \
                .join(below.select("lang", F.col("key").alias("suffix"), F.col("p").alias("lower")), ["lang", "suffix"])
        own = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")
        below = cut(rows.select("lang", "key", "weight", "lower", (own + F.col("weight") * F.col("lower")).alias("p")),
                    "language-smoothed")
        tables.append(below.select("lang", _tagged(F.col("key"), order - 1).alias("k"),
                                   F.log(F.col("p") / (F.col("weight") * F.col("lower"))).alias("value")))
        tables.append(contexts.select("lang", _tagged(F.col("context"), ORDER + order - 1).alias("k"),
                                      F.log("weight").alias("value")))
    names = F.array(*map(F.lit, langs))
    table = reduce(DataFrame.union, tables) \
        .select("k", (F.array_position(names, F.col("lang")) - 1).cast("int").alias("who"), F.col("value").cast("float"))
    return cut(table, "language-model"), floor


def _fits(grams: DataFrame, n_langs: int, model_bytes: int) -> int | None:
    """The number of distinct 4-grams, None if the driver's arrays would take more than ``model_bytes``."""
    row = 8 + 4 * n_langs
    keys = grams.select("key").distinct()
    n = keys.count()
    if n * row > model_bytes:
        return None
    if 2 * ORDER * n * row > model_bytes:  # the lower orders and contexts are fewer: count them
        every = F.explode(F.array(*(_tagged(_sub_keys(F.col("key"), t), t) for t in range(2 * ORDER))))
        if keys.select(every.alias("k")).distinct().count() * row > model_bytes:
            return None
    return n


class Scorer:
    """Cross-entropies of texts; looks each slot up in the sorted arrays by its rank."""

    def __init__(self, model: Model):
        self.model = model
        self.starts = []  # per table: bits of its directory, and where each slot's keys start
        for hashes, _, _ in (*model.grams, *model.contexts):
            bits = max(1, min(model.bits, (2 * len(hashes)).bit_length()))
            size = np.bincount(hashes >> (HASH_BITS - bits), minlength=1 << bits)
            self.starts.append((bits, np.append(0, np.cumsum(size)).astype(np.int32)))

    def find(self, table: int, key: np.ndarray) -> np.ndarray:
        """Rows of the keys in the sorted arrays of grams (0..) or contexts (ORDER..); -1: not there."""
        m = self.model
        keys = (m.grams[table] if table < ORDER else m.contexts[table - ORDER])[1]
        out = np.full(len(key), -1, dtype=np.int32)
        bits, start = self.starts[table]
        slot = _slot(key, bits)
        row, end = start[slot], start[slot + 1]
        left = np.flatnonzero(row < end)
        while len(left):
            at = row[left]
            hit = keys[at] == key[left]
            out[left[hit]] = at[hit]
            left = left[~hit]
            row[left] += 1
            left = left[row[left] < end[left]]
        return out

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: cross-entropy for each language, characters, if it has a letter."""
        m = self.model
        key, count = _stream(texts, m.alphabet)
        log = np.zeros((len(key), len(m.langs)), dtype=np.float32)
        open_at, left = None, key
        for order in range(ORDER, 0, -1):
            k = left if order == ORDER else left & np.uint64((1 << CHAR_BITS * order) - 1)
            row = self.find(order - 1, k)
            hit = row >= 0
            if open_at is None:
                if hit.all():
                    log = m.grams[order - 1][2][row]
                    left = left[:0]
                    break
                open_at = np.arange(len(key))
            log[open_at[hit]] += m.grams[order - 1][2][row[hit]]
            miss = ~hit
            open_at, left, k = open_at[miss], left[miss], k[miss]
            if not len(left):
                break
            context = k >> np.uint64(CHAR_BITS) if order > 1 else np.zeros_like(k)
            row = self.find(ORDER + order - 1, context)
            seen = row >= 0
            log[open_at[seen]] += m.contexts[order - 1][2][row[seen]]
        if len(left):
            log[open_at] += np.float32(m.floor)
        out = np.zeros((len(texts), len(m.langs)))
        some = np.flatnonzero(count)
        if len(some):
            start = (np.cumsum(count) - count)[some]
            out[some] = -np.add.reduceat(log, start, axis=0, dtype=np.float64) / count[some, None]
        return out, count, count > 0  # no boundary opens a text: the first kept character is a letter


class PartScorer:
    """Per text, for each language: the sum of what one part of a model's table adds."""

    def __init__(self, alphabet: Alphabet, n_langs: int, k: np.ndarray, who: np.ndarray, value: np.ndarray):
        self.alphabet, self.n_langs, self.who, self.value = alphabet, n_langs, who, value
        at = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
        self.keys, self.start = k[at], np.append(at, len(k))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        key, count = _stream(texts, self.alphabet)
        out = np.zeros((len(texts), self.n_langs))
        some = np.flatnonzero(count)
        if len(some) and len(self.keys):
            once, back = np.unique(key, return_inverse=True)
            log = np.zeros((len(once), self.n_langs), dtype=np.float32)
            for t in range(2 * ORDER):
                k = _tagged(_sub_keys(once, t), t)
                at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
                hit = np.flatnonzero(self.keys[at] == k)
                first = self.start[at[hit]]
                size = self.start[at[hit] + 1] - first
                entry = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
                log[np.repeat(hit, size), self.who[entry]] += self.value[entry]
            start = (np.cumsum(count) - count)[some]
            out[some] = np.add.reduceat(log[back], start, axis=0, dtype=np.float64)
        return out, count


def _calibrate(model: Model, rows: list[tuple[int, list[float], int]]) -> Model:
    """Fit the rejection and the score's scale to (language, entropies, characters) of the sample."""
    n = len(model.langs)
    model.mean, model.spread = np.zeros(n), np.ones(n)
    model.reach, model.heat = np.inf, 4.0
    if not rows:
        return model
    truth = np.array([r[0] for r in rows])
    entropy = np.array([r[1] for r in rows])
    size = np.array([r[2] for r in rows], dtype=float)
    use = entropy.argmin(1) == truth
    if use.any():
        own, width, who = entropy[use, truth[use]], size[use], truth[use]
        score = np.zeros(len(own))
        for k in range(n):
            of = who == k
            base = of if of.any() else np.ones(len(own), bool)
            model.mean[k] = np.average(own[base], weights=width[base])
            model.spread[k] = max(np.sqrt(np.mean((own[base] - model.mean[k]) ** 2 * width[base])), 0.5)
            score[of] = (own[of] - model.mean[k]) * np.sqrt(width[of]) / model.spread[k]
        model.reach = REJECT_AT * max(float(np.quantile(score, 0.999)), 3.0)
    least = np.inf
    for heat in (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0):
        p = _posterior(entropy, heat)[np.arange(len(truth)), truth]
        loss = -np.log(np.maximum(p, 1e-9)).mean()
        if loss < least - 1e-9:
            least, model.heat = loss, heat
    return model


def _posterior(entropy: np.ndarray, heat: float) -> np.ndarray:
    x = np.exp(-heat * (entropy - entropy.min(1, keepdims=True)))
    return x / x.sum(1, keepdims=True)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str | None = None,
        model_bytes: int = MODEL_BYTES, calibration_rows: int = CALIBRATION_ROWS) -> Model | None:
    """A model of all rows with a text and a language; None if there are none.

    Of one labelled row in ``CALIBRATION_SHARE`` (by a hash of its text and ``key``),
    ``calibration_rows`` at most are set aside and calibrate the rejection; all others
    are counted. Rows of one hash stay together, and a language keeps a row to be counted.
    """
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
                           F.xxhash64(F.col(key) if key else F.col(text), F.col(lang)).alias("dice")) \
        .where("lang is not null and text is not null")
    of_lang = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    thin = max(1, sum(of_lang.values()) // (CALIBRATION_SHARE * calibration_rows))
    chosen, room = [], calibration_rows
    for r in rows.where(F.pmod("dice", F.lit(CALIBRATION_SHARE * thin)) == 0).groupBy("dice", "lang") \
            .agg(F.count("*").alias("n")).orderBy("dice", "lang").limit(calibration_rows).collect():
        if r.n <= room and r.n < of_lang[r.lang]:
            chosen.append(r.dice)
            room -= r.n
            of_lang[r.lang] -= r.n
    aside = F.expr(f"dice in ({', '.join(f'{d}L' for d in chosen)})") if chosen else F.lit(False)
    alphabet = _alphabet(rows.where(~aside).select("text"))
    grams = rows.where(~aside).select("lang", "text").mapInArrow(_count_grams(alphabet), "lang string, key long, n long")
    grams = cut(grams.groupBy("lang", "key").agg(F.sum("n").alias("n")), "language-grams")
    langs = sorted(r[0] for r in grams.select("lang").distinct().collect())
    if not langs:
        return None
    keys = _fits(grams, len(langs), model_bytes)
    if keys is not None:
        names = F.array(*map(F.lit, langs))
        held = grams.select((F.array_position(names, F.col("lang")) - 1).alias("lang"), "key", "n").toArrow()
        who, key, count = (held.column(i).to_numpy() for i in range(3))
        model = _smooth(langs, (2 * keys).bit_length(), who, key.astype(np.uint64), count)
        del held, who, key, count
    else:
        table, floor = _smooth_table(langs, grams)
        model = Model(langs, 0, [], [], floor, table=table, parts=-(-table.count() * ENTRY_BYTES // model_bytes))
    model.alphabet = alphabet
    sample = rows.where(aside & F.col("lang").isin(langs)).select("lang", "text")
    sample = _measured(model, sample, "text", "x").select("lang", "x.*").collect()
    return _calibrate(model, [(langs.index(r.lang), r.entropy, r.n_chars) for r in sample if r.n_chars])


def _shipped(model: Model):
    """The model for the tasks, as plain values."""
    return SparkContext.getOrCreate().broadcast(vars(model))


def _entropies(model: Model, text: Column) -> Column:
    """Per text: the cross-entropy for each language and the number of characters."""
    shipped = _shipped(model)

    @F.arrow_udf("entropy array<double>, n_chars long")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(Model(**shipped.value))
        for column in batches:
            rows = []
            for _, some in _slices(column.to_pylist()):
                entropy, count, _ = scorer(some)
                rows += [{"entropy": e, "n_chars": n} for e, n in zip(entropy.tolist(), count.tolist())]
            yield pa.array(rows, pa.struct([("entropy", pa.list_(pa.float64())), ("n_chars", pa.int64())]))

    return measure.asNondeterministic()(text)


def _sums(model: Model, part: int, text: Column) -> Column:
    """Per text: for each language what a part of the model adds, and the number of characters."""
    held = model.table.where(F.pmod(F.xxhash64("k"), F.lit(model.parts)) == part).toArrow()
    k, who, value = (held.column(i).to_numpy() for i in range(3))
    order = np.argsort(k, kind="stable")
    shipped = SparkContext.getOrCreate().broadcast((model.alphabet, len(model.langs), k[order].view(np.uint64), who[order], value[order]))

    @F.arrow_udf("sums array<double>, n_chars long")
    def add(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = PartScorer(*shipped.value)
        for column in batches:
            rows = []
            for _, some in _slices(column.to_pylist()):
                sums, count = scorer(some)
                rows += [{"sums": e, "n_chars": n} for e, n in zip(sums.tolist(), count.tolist())]
            yield pa.array(rows, pa.struct([("sums", pa.list_(pa.float64())), ("n_chars", pa.int64())]))

    return add.asNondeterministic()(text)


def _measured(model: Model, docs: DataFrame, text: str, into: str) -> DataFrame:
    """``docs`` with a struct per text: the cross-entropy for each language, the number of characters."""
    if model.table is None:
        return docs.withColumn(into, _entropies(model, F.col(text).cast("string")))
    row = free_name([*docs.columns, into], "_row")
    docs = cut(docs.withColumn(row, F.monotonically_increasing_id()), "language-rows")
    parts = []
    for part in range(model.parts):  # one part at a time is held
        x = cut(docs.select(row, _sums(model, part, F.col(text).cast("string")).alias("x")), "language-sums")
        parts.append(x.select(row, "x.*"))
    n = F.max("n_chars")
    entropy = F.array(*(-(F.sum(F.col("sums")[i]) / n + model.floor) for i in range(len(model.langs))))
    none = F.array_repeat(F.lit(0.0), len(model.langs))
    sums = reduce(DataFrame.union, parts).groupBy(row).agg(
        F.struct(F.when(n > 0, entropy).otherwise(none).alias("entropy"), n.alias("n_chars")).alias(into))
    return docs.join(sums, row).drop(row)


def identify(model: Model | None, docs: DataFrame, text: str = "text", into: str = "found") -> DataFrame:
    """``docs`` with the struct of ``predict`` in the column ``into``, by a model of any size."""
    if model is None or model.table is None:
        return docs.withColumn(into, predict(model, F.col(text)))
    measured = _measured(model, docs, text, into)
    return measured.withColumn(into, _judged(model, F.col(into)))


def _verdict(m: Model, entropy: np.ndarray, count: np.ndarray) -> tuple[list, list, list, list]:
    """Languages, scores, if accepted, and cross-entropies of texts with ``count`` characters."""
    best = entropy.argmin(1)
    least = entropy[np.arange(len(best)), best]
    sure = _posterior(entropy, m.heat)[np.arange(len(best)), best]
    room = np.maximum(SLACK, m.reach * m.spread[best] / np.sqrt(np.maximum(count, 1)))
    near, letters = least - m.mean[best] <= room, count > 0
    return ([m.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters)], np.where(letters, sure, 0.0).tolist(),
            (letters & near).tolist(), np.where(letters, least, 0.0).tolist())


def _judged(model: Model, measured: Column) -> Column:
    """The struct of ``predict`` from measured cross-entropies."""
    shipped = SparkContext.getOrCreate().broadcast({**vars(model), "table": None})

    @F.arrow_udf(RESULT)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = Model(**shipped.value)
        for column in batches:
            count = column.field("n_chars").to_numpy()
            entropy = column.field("entropy").flatten().to_numpy().reshape(len(count), len(m.langs))
            langs, scores, accepted, entropies = _verdict(m, entropy, count)
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_()),
                 pa.array(entropies, pa.float64()), pa.array(count, pa.int64())], names=RESULT.names)

    return judge.asNondeterministic()(measured)


def predict(model: Model | None, text: Column) -> Column:
    """A struct per text: lang_pred, score, accepted, cross_entropy, n_chars.

    For models that can be broadcast; ``identify`` takes any.
    """
    if model and model.table is not None:
        raise ValueError("a model in parts scores tables: use identify")
    shipped = _shipped(model) if model else None
    arrow = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_()),
                       ("cross_entropy", pa.float64()), ("n_chars", pa.int64())])

    @F.arrow_udf(RESULT)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(Model(**shipped.value)) if shipped else None
        for column in batches:
            langs, scores, accepted, entropies, sizes = [], [], [], [], []
            texts = column.to_pylist()
            if scorer is None:
                yield pa.array([{"lang_pred": UNKNOWN, "score": 0.0, "accepted": False}] * len(texts), type=arrow)
                continue
            m = scorer.model
            for _, some in _slices(texts):
                entropy, count, _ = scorer(some)
                for out, more in zip((langs, scores, accepted, entropies), _verdict(m, entropy, count)):
                    out += more
                sizes += count.tolist()
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_()),
                 pa.array(entropies, pa.float64()), pa.array(sizes, pa.int64())], fields=list(arrow))

    return judge.asNondeterministic()(text.cast("string"))
