"""Byte-level BPE encoding and decoding, by DuckDB recursive queries per partition.

A text is split into pieces as the tokenizer's pattern does; each distinct piece of a
run of texts is encoded once; one that is known by its hash is compared byte for byte. In DuckDB, each piece's bytes are token-position rows;
every row joins the merge table with the token after it. A recursive query then
contracts, in each piece, the leftmost pair of the least rank, joins the two pairs that
this makes with the merge table, and goes on until no piece has a pair that merges. An
ordered aggregation joins the pieces' ids with the vocabulary and puts their bytes back
together; the decoded text is made of those.

The rare piece of ``LONG`` bytes or more is contracted in arrays, many places of the least
pair in one step: from the left up to the first that makes a pair of a lesser rank.

Texts are taken in runs of bounded size, and the pieces of ``PIECES`` are kept from one
run to the next, so a partition's memory doesn't grow with its rows.

Defined results: a null text counts as empty; an empty text has no ids. Texts of any
length are encoded whole. Repeated rows are answered each on its own; an empty table
gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textops import byte_values, mix, Powers, text_chunks

#: Distinct pieces that a task keeps encoded; beyond it, it starts anew.
PIECES = 1 << 20
#: Bytes of text per run, and per step within it where a byte needs words of memory.
RUN_BYTES = 2 << 20
STEP_BYTES = 1 << 18

#: Bytes from which a piece is contracted apart: its steps would each copy its whole list.
LONG = 256

_NONE = 1 << 30
_RADIX = 1 << 16

#: Character classes of the pattern, per code point: letter, number, other, space, other white space.
LETTER, NUMBER, OTHER, SPACE, WHITE = range(5)
_TEST = {LETTER: regex.compile(r"\p{L}"), NUMBER: regex.compile(r"\p{N}")}
#: The characters of \s.
_WHITE = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    out: list[bytes] = [b""] * (max(int(r) for _, r in pairs) + 1)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def _class_of(point: int) -> int:
    if point == 0x20:
        return SPACE
    if point in _WHITE:
        return WHITE
    char = chr(point)
    return next((k for k, p in _TEST.items() if p.match(char)), OTHER)


class Splitter:
    """Starts of the pattern's matches, for many texts at once.

    Between matches a run of one class goes together, with one space before it. White
    space before a solid character gives its last character up: to that match if it is a
    space, else to a match of its own. Texts with an apostrophe go to the pattern itself.
    """

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        self.low = np.array([_class_of(p) for p in range(0x800)], dtype=np.uint8)
        self.high: dict[int, int] = {}

    def classes(self, points: np.ndarray) -> np.ndarray:
        out = self.low[np.minimum(points, 0x7FF)]
        rare = np.flatnonzero(points > 0x7FF)
        if len(rare):
            some, at = np.unique(points[rare], return_inverse=True)
            known = [self.high[p] if p in self.high else self.high.setdefault(p, _class_of(p)) for p in some.tolist()]
            out[rare] = np.array(known, dtype=np.uint8)[at]
        return out

    def starts(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where matches start; ``first``: at each code point, if a text starts there."""
        kind = self.classes(points)
        n = len(kind)
        before = np.full(n, 255, dtype=np.uint8)
        before[1:] = kind[:-1]
        before[first] = 255
        after = np.full(n, 255, dtype=np.uint8)
        after[:-1] = np.where(first[1:], 255, kind[1:])
        solid = kind <= OTHER
        led = before == SPACE  # a space before goes with it
        start = solid & (kind != before) & ~led
        blank = ~solid
        opens = blank & ((before <= OTHER) | (before == 255))
        gives = blank & (after <= OTHER)  # the last of white space before a solid character
        return start | opens | gives

    def slow(self, text: str) -> np.ndarray:
        return np.array([m.start() for m in self.pattern.finditer(text)], dtype=np.int64)


class Encoder:
    """Encodes distinct pieces in DuckDB; keeps their ids and bytes."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.splitter = Splitter(pattern)
        self.tokens = tokens
        rank = {t: r for r, t in enumerate(tokens) if t}
        self.rank = rank
        self.byte = np.array([rank[bytes([b])] for b in range(256)], dtype=np.int32)
        self.values, self.powers = byte_values(11), Powers(0x2545F4914F6CDD1D)
        pairs = [(rank[t[:i]] * _RADIX + rank[t[i:]], r) for t, r in rank.items()
                 for i in range(1, len(t)) if t[:i] in rank and t[i:] in rank]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        merges = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.pairs, self.pair_ranks = merges[:, 0], merges[:, 1]
        self.db.register("m", pa.table({"pair": merges[:, 0], "rank": merges[:, 1].astype(np.int32)}))
        self.db.execute("create table merges as select pair, rank from m")
        self.db.register("v", pa.table({"id": pa.array(range(len(tokens)), pa.int32()), "bytes": pa.array(tokens, pa.binary())}))
        self.db.execute("create table vocabulary as select id, bytes from v")
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)   # hashes of pieces, sorted
        self.place = np.zeros(0, dtype=np.int64)    # of each: its place in what follows
        self.ids, self.id_at = np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)
        self.back, self.back_at = np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
        self.odd: dict[bytes, int] = {}             # places of pieces whose hash another piece has

    def contract(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and decoded bytes of all pieces end to end, with the length of each."""
        size = np.array([len(p) for p in pieces])
        data = np.frombuffer(b"".join(pieces), np.uint8)
        at = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
        token = self.byte[data]
        pair = np.full(len(data), -1, dtype=np.int64)
        pair[:-1] = np.where(at[1:] > 0, token[:-1].astype(np.int64) * _RADIX + token[1:], -1)
        self.db.register("positions", pa.table({
            "piece": np.repeat(np.arange(len(pieces), dtype=np.int32), size), "spot": at.astype(np.int32), "token": token, "pair": pair}))
        self.db.execute(f"""
            create or replace temp table encoded as
            with recursive step(piece, tokens, ranks, least) as (
                select piece, tokens, ranks, list_min(ranks) from (
                    select piece, list(token order by spot) as tokens, list(coalesce(rank, {_NONE}) order by spot) as ranks
                    from positions left join merges using (pair) group by piece)
                union all
                select piece, tokens, ranks, list_min(ranks) from (
                    select s.piece, s.tokens[:i - 1] || [s.least] || s.tokens[i + 2:] as tokens,
                           case when i > 1 then s.ranks[:i - 2] || [coalesce(l.rank, {_NONE})] else [] end
                           || [coalesce(r.rank, {_NONE})] || s.ranks[i + 2:] as ranks
                    from (select *, list_position(ranks, least) as i from step where least < {_NONE}) s
                    left join merges l on l.pair = s.tokens[i - 1]::bigint * {_RADIX} + s.least
                    left join merges r on r.pair = s.least::bigint * {_RADIX} + s.tokens[i + 2])
            )
            select piece, tokens from step where least = {_NONE}""")
        ids = self.db.sql("select tokens from encoded order by piece").to_arrow_table()["tokens"].combine_chunks()
        flat = ids.flatten().to_numpy().astype(np.uint32)
        decoded = self.db.sql("""
            select string_agg(hex(bytes), '' order by spot) as hexed from (
                select piece, unnest(tokens) as id, generate_subscripts(tokens, 1) as spot from encoded) t
            join vocabulary using (id) group by piece order by piece""").to_arrow_table()["hexed"].combine_chunks()
        self.db.unregister("positions")
        back = [bytes.fromhex(x) for x in decoded.to_pylist()]
        return flat, np.diff(ids.offsets.to_numpy()), np.frombuffer(b"".join(back), np.uint8), np.array([len(b) for b in back])

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of neighbours, _NONE where they don't merge."""
        pair = left * _RADIX + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.pair_ranks[at], _NONE)

    def contract_long(self, piece: bytes) -> np.ndarray:
        tokens = self.byte[np.frombuffer(piece, np.uint8)].astype(np.int64)
        ranks = self.ranks_of(tokens[:-1], tokens[1:])
        while len(ranks) and (least := ranks.min()) < _NONE:
            at = np.flatnonzero(ranks == least)
            n = np.arange(len(at))
            # of places that overlap (aaa) the first, the third, ..
            opens = np.maximum.accumulate(np.where(np.append(True, np.diff(at) > 1), n, 0))
            at = at[(n - opens) % 2 == 0]
            # one after the other from the left, until one makes a pair that goes before the rest
            left = np.where(at > 0, tokens[at - 1], -1)
            left[1:][at[1:] == at[:-1] + 2] = least
            right = np.append(tokens, (-1, -1))[at + 2]
            made = np.minimum(np.where(left >= 0, self.ranks_of(left, least), _NONE),
                              np.where(right >= 0, self.ranks_of(least, right), _NONE))
            if (made < least).any():
                at = at[:np.argmax(made < least) + 1]
            tokens[at] = least
            tokens, ranks = np.delete(tokens, at + 1), np.delete(ranks, at)
            here = at - np.arange(len(at))
            for changed in (here[here > 0] - 1, here[here < len(ranks)]):
                ranks[changed] = self.ranks_of(tokens[changed], tokens[changed + 1])
        return tokens

    def contract_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ``contract``, long pieces apart."""
        size = np.array([len(p) for p in pieces])
        if (size < LONG).all():
            return self.contract(pieces)
        short = np.flatnonzero(size < LONG)
        ids = [np.zeros(0, np.uint32)] * len(pieces)
        back = [b""] * len(pieces)
        if len(short):
            flat, width, text, text_width = self.contract([pieces[k] for k in short])
            for k, x, y in zip(short, np.split(flat, np.cumsum(width)[:-1]), np.split(text, np.cumsum(text_width)[:-1])):
                ids[k], back[k] = x, y.tobytes()
        for k in np.flatnonzero(size >= LONG):
            ids[k] = self.contract_long(pieces[k]).astype(np.uint32)
            back[k] = b"".join(self.tokens[i] for i in ids[k].tolist())
        return (np.concatenate(ids), np.array([len(x) for x in ids]), np.frombuffer(b"".join(back), np.uint8),
                np.array([len(b) for b in back]))

    def learn(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Places of all pieces, given their hashes and where they are in ``data``; new ones are encoded."""
        if len(self.known) > PIECES:
            self.forget()
        at = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        new = np.flatnonzero(self.known[at] != hashes) if len(self.known) else np.arange(len(hashes))
        if len(new):
            some, first = np.unique(hashes[new], return_index=True)
            raw = data.tobytes()
            pieces = [raw[a:b] for a, b in zip(start[new[first]].tolist(), stop[new[first]].tolist())]
            whole = [self.rank.get(p) for p in pieces]  # a piece that is a token needs no merge
            merge = [k for k, r in enumerate(whole) if r is None]
            n_ids = np.ones(len(pieces), dtype=np.int64)
            n_back = np.array([len(p) for p in pieces])
            if merge:
                flat, width, back, back_width = self.contract_all([pieces[k] for k in merge])
                n_ids[merge], n_back[merge] = width, back_width
            id_at = np.concatenate(([0], np.cumsum(n_ids)))
            back_at = np.concatenate(([0], np.cumsum(n_back)))
            ids, text = np.zeros(id_at[-1], dtype=np.uint32), np.zeros(back_at[-1], dtype=np.uint8)
            direct = np.array([k for k, r in enumerate(whole) if r is not None], dtype=np.int64)
            ids[id_at[direct]] = [whole[k] for k in direct]
            text[_ranges(back_at[direct], n_back[direct])] = np.frombuffer(
                b"".join(self.tokens[whole[k]] for k in direct), np.uint8)
            if merge:
                ids[_ranges(id_at[merge], n_ids[merge])] = flat
                text[_ranges(back_at[merge], n_back[merge])] = back
            place = np.concatenate((self.place, len(self.id_at) - 1 + np.arange(len(some))))
            self.id_at = np.concatenate((self.id_at[:-1], self.id_at[-1] + id_at))
            self.back_at = np.concatenate((self.back_at[:-1], self.back_at[-1] + back_at))
            self.ids, self.back = np.concatenate((self.ids, ids)), np.concatenate((self.back, text))
            known = np.concatenate((self.known, some))
            order = np.argsort(known, kind="stable")
            self.known, self.place = known[order], place[order]
        return self.verified(self.place[np.searchsorted(self.known, hashes)], data, start, stop)

    def verified(self, place: np.ndarray, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The places, but for pieces that share another one's hash: those are looked up by their bytes.

        What a place decodes to is its piece, so that is what a piece is compared with.
        """
        same = self.back_at[place + 1] - self.back_at[place] == stop - start
        some = np.flatnonzero(same)
        width = (stop - start)[some]
        differs = self.back[_ranges(self.back_at[place[some]], width)] != data[_ranges(start[some], width)]
        if len(some):
            same[some] = ~np.logical_or.reduceat(differs, np.cumsum(width) - width)
        wrong = np.flatnonzero(~same)
        if not len(wrong):
            return place
        pieces = [data[start[k]:stop[k]].tobytes() for k in wrong]
        new = [p for p in dict.fromkeys(pieces) if p not in self.odd]
        if new:
            ids, n_ids, back, n_back = self.contract_all(new)
            for k, p in enumerate(new):
                self.odd[p] = len(self.id_at) - 1 + k
            self.id_at = np.concatenate((self.id_at, self.id_at[-1] + np.cumsum(n_ids)))
            self.back_at = np.concatenate((self.back_at, self.back_at[-1] + np.cumsum(n_back)))
            self.ids, self.back = np.concatenate((self.ids, ids)), np.concatenate((self.back, back))
        place = place.copy()
        place[wrong] = [self.odd[p] for p in pieces]
        return place

    def hashes(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """A hash per piece."""
        out = np.empty(len(start), dtype=np.uint64)
        first = 0
        while first < len(start):
            last = max(first + 1, int(np.searchsorted(start, start[first] + STEP_BYTES)))
            own = data[start[first]:stop[last - 1]]
            at = start[first:last] - start[first]
            up, down = self.powers.to(len(own))
            out[first:last] = np.add.reduceat(self.values[own] * up[:len(own)], at) * down[at]
            first = last
        return mix(out ^ (stop - start).astype(np.uint64))

    def __call__(self, column: pa.Array) -> Iterator[tuple[int, list[bytes], list[bytes]]]:
        """(first row, ids of each text as little-endian 32-bit integers, decoded bytes of each)."""
        for row, end, data, offsets in text_chunks(column, RUN_BYTES):
            n = end - row
            if not len(data):
                yield row, [b""] * n, [b""] * n
                continue
            lead = (data & 0xC0) != 0x80  # the first byte of each code point
            byte_at = np.flatnonzero(lead)
            points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
            edges = offsets[:-1][offsets[:-1] < len(data)]
            of_text = np.searchsorted(byte_at, offsets)
            first = np.zeros(len(points), dtype=bool)
            first[np.searchsorted(byte_at, edges)] = True
            mark = self.splitter.starts(points, first)
            for t in np.unique(np.searchsorted(of_text, np.flatnonzero(points == 0x27), "right") - 1):
                lo, hi = of_text[t], of_text[t + 1]
                mark[lo:hi] = False
                mark[lo + self.splitter.slow(data[offsets[t]:offsets[t + 1]].tobytes().decode("utf-8"))] = True
            start = byte_at[mark]
            stop = np.append(start[1:], len(data))
            place = self.learn(self.hashes(data, start, stop), data, start, stop)
            piece_at = np.searchsorted(start, offsets)
            yield row, _joined(self.ids, self.id_at, place, piece_at), _joined(self.back, self.back_at, place, piece_at)


def _ranges(start, size) -> np.ndarray:
    """The indexes start[i] .. start[i] + size[i] - 1, end to end."""
    start, size = np.asarray(start, dtype=np.int64), np.asarray(size, dtype=np.int64)
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def _joined(values: np.ndarray, at: np.ndarray, place: np.ndarray, piece_at: np.ndarray) -> list[bytes]:
    """For each text, the values of its pieces end to end."""
    out = []
    for first, last in zip(piece_at[:-1].tolist(), piece_at[1:].tolist()):
        own = place[first:last]
        out.append(values[_ranges(at[own], at[own + 1] - at[own])].tobytes())
    return out


RESULT = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded", T.BinaryType()), T.StructField("decoded_sha256", T.StringType()),
])


def encode(text: Column, tokens: list[bytes], pattern: str, keep_ids: bool = False, keep_decoded: bool = False) -> Column:
    """A struct per text: n_tokens, digests, and if kept the ids (little-endian unsigned 32-bit) and the decoded bytes.

    The vocabulary has a fixed size; it goes to the tasks as it is.
    """
    if len(tokens) > _RADIX:
        raise ValueError(f"a vocabulary of at most {_RADIX} tokens")
    shipped = SparkContext.getOrCreate().broadcast((tokens, pattern))

    @F.arrow_udf(RESULT)
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(*shipped.value)
        for column in columns:
            out: list[list] = [[], [], [], [], []]
            for _, ids, decoded in encoder(column):
                out[0] += [len(x) // 4 for x in ids]
                out[1] += ids if keep_ids else [None] * len(ids)
                out[2] += [hashlib.sha256(x).hexdigest() for x in ids]
                out[3] += decoded if keep_decoded else [None] * len(ids)
                out[4] += [hashlib.sha256(x).hexdigest() for x in decoded]
            kinds = [pa.int64(), pa.binary(), pa.string(), pa.binary(), pa.string()]
            yield pa.StructArray.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=RESULT.names)

    return run.asNondeterministic()(text.cast("string"))
