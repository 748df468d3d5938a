"""Words and hashes of many texts at once, on numpy arrays over Arrow buffers.

A text's words are its maximal runs of bytes other than space and ``\\t``..``\\r``
(the same as the runs of ``[^\\x20\\x09-\\x0D]`` characters, as those are single
bytes in UTF-8). Everything here works on one chunk of whole texts at a time, so
memory depends on the chunk (or on the one longest text), not on the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 1 << 19

#: Bytes from which a word is hashed by XXH64. A sum over powers modulo 2**64 serves shorter
#: ones; words built for it (those of Thue and Morse) collide from 1,024 letters on.
LONG_WORD = 64

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values(seed: int, lower: bool = False) -> np.ndarray:
    """A 64-bit value per byte; ``lower`` gives A-Z the values of a-z."""
    out = mix(np.arange(1, 257, dtype=np.uint64) * _ODD + np.uint64(seed))
    if lower:
        out[0x41:0x5B] = out[0x61:0x7B]
    return out


class Powers:
    """Powers of an odd number modulo 2**64 and their inverses, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(n - 1, 1).bit_length()
            for name, base in (("up", self.base), ("down", self.inverse)):
                row = np.full(size, base, dtype=np.uint64)
                row[0] = 1
                setattr(self, name, np.multiply.accumulate(row))
        return self.up, self.down


def pair_hash(a: np.ndarray, b: np.ndarray, salt: np.uint64 = np.uint64(0)) -> np.ndarray:
    """A hash of pairs of hashes; a scramble between any two steps leaves sums over powers no structure to meet."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + b * np.uint64(0xA0761D6478BD642F) + salt)


@dataclass
class Hasher:
    """One 64-bit hash family for words and for runs of words."""

    seed: int
    values: np.ndarray
    in_word: Powers
    salt: np.uint64
    lower: bool = False

    @staticmethod
    def seeded(seed: int, lower: bool = False) -> Hasher:
        a, b = mix(np.array([seed * 2 + 1, seed * 2 + 2], dtype=np.uint64) * _ODD)
        return Hasher(seed, byte_values(seed, lower), Powers(int(a)), b, lower)

    def words(self, kept: np.ndarray, start: np.ndarray) -> np.ndarray:
        """A hash per word; ``kept`` are the words' bytes end to end."""
        if not len(start):
            return np.zeros(0, dtype=np.uint64)
        up, down = self.in_word.to(len(kept))
        out = mix(np.add.reduceat(self.values[kept] * up[: len(kept)], start) * down[start])
        end = np.append(start[1:], len(kept))
        for w in np.flatnonzero(end - start >= LONG_WORD).tolist():
            word = kept[start[w]:end[w]].tobytes()
            out[w] = xxhash.xxh64_intdigest(word.lower() if self.lower else word, self.seed)
        return out

    def runs(self, words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the runs of ``length`` words, given their hashes, that start at word ``at``.

        Runs of 2, 4, 8, .. words are hashed from two halves each, and those that make up
        ``length`` are joined.
        """
        out, taken, width = None, 0, 1
        while True:
            if length & width:
                own = words[at + taken]
                out = own if out is None else pair_hash(out, own, self.salt)
                taken += width
            if taken == length:
                return mix(out + np.uint64(length))
            words = pair_hash(words[:-width], words[width:], self.salt)
            width *= 2


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows in them) of runs of whole texts.

    A null text counts as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


@dataclass
class Words:
    """The words of a chunk of texts."""

    kept: np.ndarray    # bytes of the words, end to end
    start: np.ndarray   # where each word starts in ``kept``
    length: np.ndarray  # bytes of each word
    of_text: np.ndarray  # text i has the words of_text[i] up to of_text[i + 1]

    def count(self) -> np.ndarray:
        return np.diff(self.of_text)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.of_text) - 1), self.count())

    def spaced(self, lower: bool = False) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words with one space after each; start and end of each word in that."""
        n = np.arange(len(self.start))
        at = self.start + n
        out = np.full(len(self.kept) + len(self.start), 0x20, dtype=np.uint8)
        out[np.arange(len(self.kept)) + np.repeat(n, self.length)] = self.kept
        data = out.tobytes()
        return (data.lower() if lower else data), at, at + self.length


def split_words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> Words:
    """``space``: for each byte, if it parts words."""
    solid = ~space[data]
    before = np.empty_like(solid)
    before[:1] = False
    before[1:] = solid[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    before[edges] = False
    first = np.flatnonzero(solid & ~before)
    kept = data[solid]
    rank = np.cumsum(solid)
    start = rank[first] - 1
    length = np.diff(np.append(start, len(kept)))
    return Words(kept, start, length, np.searchsorted(first, offsets))


def windows_in_text(words: Words, size: int) -> np.ndarray:
    """Word indexes at which a run of ``size`` words starts that stays in its text."""
    at = np.arange(len(words.start))
    return at[at + size <= np.repeat(words.of_text[1:], words.count())]


def to_signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
