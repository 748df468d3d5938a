"""Conversation structure repair by square-root checkpointed dynamic programming.

A conversation is put into the order ``(system? (user assistant)+)?`` at the least cost:
keep a row (0), give it the role user or assistant (1), delete it (2) or insert an empty
user or assistant row (5); a truncated row that isn't deleted adds 5, and blank rows and
rows seen earlier are always deleted. Of the cheapest ways that one is taken whose string
of edit initials (D, I, K, R) comes first in ASCII.

The four states are: nothing yet, after the system row, after a user row, after an
assistant row. Going backwards over a conversation's rows, the least cost to the end from
each state is a vector of four; only that of every k-th row is stored, k the root of the
number of rows. Going forwards, the vectors of one block are computed again from the next
checkpoint, and the least letter whose cost is tight is emitted. So n rows take one byte
each and about 2 sqrt(n) vectors.

In Spark: rows are counted by conversation, turn, role and the text's SHA-256, so that
copies are one row before anything is shuffled by conversation; first appearances come
from a grouping by conversation, role and digest. A conversation's rows, without texts,
then reach its task ahead of its texts, in one sorted stream, so that texts are edited,
hashed and let go as they come: a conversation is never held. The digest of a
conversation is one SHA-256 over its texts in order, which is why one task streams it.

Defined results: a null role or text is one space (so a null text is blank); rows go by
turn, nulls first, and rows of one turn by role, then by the text's digest; repeated rows
adjoin, the first counts and the others are duplicates. A null key is a conversation of
its own. A conversation without rows has zeros, an empty audit and the digest of the
empty string. A role's initial is its first character, as it is; an empty role has none.
``gaps`` is null where it doesn't fit a long. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import free_name

SPACES = " \t\n\v\f\r"
DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5
_NEVER = 1 << 62

#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
#: From each state: the one user or assistant row that may follow, and where it leads.
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
#: Where a kept row leads, by state and class (0 system, 1 user, 2 assistant, 3 other); -1: nowhere.
_KEPT = ((1, 2, -1, -1), (-1, 2, -1, -1), (-1, -1, 3, -1), (-1, 2, -1, -1))
_CLASS = {"s": 0, "u": 1, "a": 2}
_LEGAL = {"su", "ua", "au"}
_REAL, _TRUNCATED = 8, 4

Vector = tuple[int, int, int, int]
END: Vector = (0, 2 * INSERT, INSERT, 0)


def _back(code: int, copies: int, after: Vector) -> Vector:
    """Least costs before a row, given those after it; copies beyond the first are deleted."""
    if not code & _REAL:
        return tuple(c + DELETE * copies for c in after)
    extra, cut, kind = DELETE * (copies - 1), CUT if code & _TRUNCATED else 0, code & 3
    own = []
    for state in range(4):
        kept = _KEPT[state][kind]
        own.append(extra + min(DELETE + after[state], REROLE + cut + after[_NEXT[state]], cut + after[kept] if kept >= 0 else _NEVER))
    two = min(own[2], INSERT + own[3])
    three = min(own[3], INSERT + two)
    two = min(two, INSERT + three)
    return min(own[0], INSERT + two), min(own[1], INSERT + two), two, three


class Rows:
    """A conversation's rows as bytes (class, truncated, real), and how often each comes."""

    def __init__(self):
        self.codes = bytearray()
        self.copies: dict[int, int] = {}  # of rows that come more than once

    def add(self, code: int, copies: int) -> None:
        if copies > 1:
            self.copies[len(self.codes)] = copies
        self.codes.append(code)

    def solve(self) -> Checkpoints:
        return Checkpoints(self)


class Checkpoints:
    """Vectors of every k-th row, and the walk that computes the others again."""

    def __init__(self, rows: Rows):
        self.rows, n = rows, len(rows.codes)
        self.step = isqrt(n) + 1
        self.kept: dict[int, Vector] = {n: END}
        vector = END
        for at in range(n - 1, -1, -1):
            vector = self._before(at, vector)
            if at % self.step == 0:
                self.kept[at] = vector
        self.cost = vector[0]

    def _before(self, at: int, after: Vector) -> Vector:
        return _back(self.rows.codes[at], self.rows.copies.get(at, 1), after)

    def _block(self, first: int) -> list[Vector]:
        """Vectors of the rows from ``first`` up to the next checkpoint, with that one."""
        last = min(first + self.step, len(self.rows.codes))
        out = [self.kept[last]]
        for at in range(last - 1, first, -1):
            out.append(self._before(at, out[-1]))
        out.append(self.kept[first])
        return out[::-1]

    def walk(self) -> Iterator[tuple[str, list[str], str | None]]:
        """For each row, and once for the end: the edits, the roles inserted before it and its role (None: deleted)."""
        state, block = 0, []
        n = len(self.rows.codes)
        for at in range(n):
            if at % self.step == 0:
                block = self._block(at)
            code, copies = self.rows.codes[at], self.rows.copies.get(at, 1)
            here, after = block[at % self.step:at % self.step + 2]
            if not code & _REAL:
                yield "D" * copies, [], None
                continue
            extra, cut = DELETE * (copies - 1), CUT if code & _TRUNCATED else 0
            letters, before = "", []
            while True:
                cost = here[state] - extra
                if cost == DELETE + after[state]:
                    letter, role = "D", None
                elif here[state] == INSERT + here[_NEXT[state]]:
                    letters += "I"
                    before.append(_ROLE[state])
                    state = _NEXT[state]
                    continue
                elif (kept := _KEPT[state][code & 3]) >= 0 and cost == cut + after[kept]:
                    letter, role, state = "K", "", kept
                else:
                    letter, role, state = "R", _ROLE[state], _NEXT[state]
                yield letters + letter + "D" * (copies - 1), before, role
                break
        letters, before = "", []
        while END[state]:
            letters += "I"
            before.append(_ROLE[state])
            state = _NEXT[state]
        yield letters, before, None


class Conversation:
    """One conversation's way through the stream: first its rows, then its texts."""

    def __init__(self, keep: bool):
        self.rows, self.keep = Rows(), [] if keep else None
        self.low = self.high = self.turn = self.last = self.marked = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.walk = None
        self.audit: list[str] = []
        self.digest, self.empty = hashlib.sha256(), True
        self.done = None

    def row(self, turn: int | None, role: str, digest: bytes, blank: bool, cut: bool, copies: int) -> None:
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.turns += turn != self.turn
            self.turn = self.high = turn
        first = not blank and self.marked == (turn, role, digest)
        self.blank += copies if blank else 0
        self.duplicate += 0 if blank else copies - first
        self.truncated += first and cut
        initial = role[:1]
        if self.last is not None:
            self.illegal += self.last + initial not in _LEGAL
        self.illegal += copies - 1  # a role never follows itself
        self.last = initial
        self.rows.add(_CLASS.get(initial, 3) | (_TRUNCATED if cut else 0) | (_REAL if first else 0), copies)

    def _write(self, role: str, text: str) -> None:
        self.digest.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False
        if self.keep is not None:
            self.keep.append({"role": role, "text": text})

    def _solve(self) -> None:
        if self.walk is None:
            solved = self.rows.solve()
            self.cost, self.walk = solved.cost, solved.walk()

    def text(self, key: tuple, text: str) -> None:
        if key == self.done:
            return  # a copy
        self.done = key
        self._solve()
        letters, before, role = next(self.walk)
        self.audit.append(letters)
        for added in before:
            self._write(added, "")
        if role is not None:
            self._write(role or key[1], text)

    def result(self) -> tuple:
        self._solve()
        letters, before, _ = next(self.walk)
        self.audit.append(letters)
        for added in before:
            self._write(added, "")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps if gaps < 1 << 63 else None, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
                "".join(self.audit), self.digest.hexdigest(), self.keep)


#: Kinds of stream rows, in the order in which a conversation's rows come.
_NAME, _ROWS, _TEXTS = -1, 0, 1
_REPAIRED = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_OUT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
        ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()), ("repaired", _REPAIRED)]
_FLUSH = 1000


def _stream(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        keys, out, kind_of_key = [], [], None

        def flush() -> pa.RecordBatch:
            columns = [pa.array(keys, kind_of_key)] + [pa.array(x, t) for x, (_, t) in zip(zip(*out), _OUT)]
            keys.clear()
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["id", *(n for n, _ in _OUT)])

        for batch in batches:
            kind_of_key = batch.schema.field(0).type
            for key, kind, turn, role, digest, mark, blank, cut, copies, text in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == _NAME:
                    if now is not None:
                        out.append(now.result())
                        if len(out) >= _FLUSH:
                            yield flush()
                    keys.append(key)
                    now = Conversation(keep)
                elif kind == _TEXTS:
                    now.text((turn, role, digest), text)
                elif mark:
                    now.marked = (turn, role, digest)
                else:
                    now.row(turn, role, digest, blank, cut, copies)
        if now is not None:
            out.append(now.result())
            yield flush()

    return run


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Without rows that equal one that the task has sent, as far as it remembers."""
    seen: set = set()
    for batch in batches:
        take = []
        for row, key in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
            if key not in seen:
                take.append(row)
                seen.add(key)
                if len(seen) > 1 << 17:
                    seen.clear()
        yield batch.take(pa.array(take, pa.int64()))


def repair(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           present: Column | None = None, keep: bool = False) -> DataFrame:
    """(id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, repaired) per conversation.

    ``present``: false for a row that only names its conversation. ``repaired`` (role and
    text of each row) is null unless ``keep``, as it holds a conversation whole.
    """
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = rows.select(F.col(key).alias("id"), F.col(turn).cast("long").alias("turn"),
                       F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"), here.alias("here"))
    names = rows.select("id").distinct()
    digest = F.unhex(F.sha2(F.col("text"), 256))
    solid = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = rows.where("here").select("id", "turn", "role", digest.alias("digest"), "text", (solid == "").alias("blank"),
                                     (~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("cut"))
    same = ["id", "turn", "role", "digest"]
    counted = rows.groupBy(*same).agg(F.first("blank").alias("blank"), F.first("cut").alias("cut"), F.count(F.lit(1)).alias("copies"))
    first = counted.where("not blank").groupBy("id", "role", "digest") \
        .agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    none = {"turn": "long", "role": "string", "digest": "binary", "mark": "boolean", "blank": "boolean", "cut": "boolean",
            "copies": "long", "text": "string"}

    def part(df: DataFrame, kind: int, **own: Column) -> DataFrame:
        return df.select("id", F.lit(kind).alias("kind"), *(own.get(c, F.lit(None)).cast(t).alias(c) for c, t in none.items()))

    where = {c: F.col(c) for c in same[1:]}
    texts = rows.select(*same, "text").mapInArrow(_thin, rows.select(*same, "text").schema)
    stream = part(names, _NAME) \
        .union(part(first, _ROWS, turn=F.col("first.turn"), role=F.col("role"), digest=F.col("digest"), mark=F.lit(True))) \
        .union(part(counted, _ROWS, **where, mark=F.lit(False), blank=F.col("blank"), cut=F.col("cut"), copies=F.col("copies"))) \
        .union(part(texts, _TEXTS, **where, text=F.col("text")))
    # of equal rows the mark that one is a first appearance comes ahead
    order = ["id", "kind", "turn", "role", "digest"]
    stream = stream.repartition("id").sortWithinPartitions(*order, F.desc("mark"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *T.StructType.fromDDL(
        "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, "
        "repaired array<struct<role:string,text:string>>").fields])
    return stream.mapInArrow(_stream(keep), schema)


def damage(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, str]:
    """The rows with planted faults, by a checksum of key and turn, and the name of a column that is false for dropped rows.

    Of twenty values, 0 drops the row, 1 empties its text, 2 takes its sentence ends away,
    3 repeats it and 4 makes its role user. Nulls of these columns count as one space.
    """
    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault, copy, here = (free_name(rows.columns, n) for n in ("_fault", "_copy", "_here"))
    value = F.col(fault)
    rows = rows.withColumn(fault, F.crc32(F.concat(plain(key), F.lit(":"), plain(turn))) % 20)
    rows = rows.withColumn(copy, F.explode(F.when(value == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    new = {role: F.when(value == 4, F.lit("user")).otherwise(plain(role)),
           text: F.when(value == 1, F.lit("")).when(value == 2, F.translate(plain(text), ".!?", "")).otherwise(plain(text))}
    return rows.withColumns(new).withColumn(here, value != 0).drop(fault, copy), here
