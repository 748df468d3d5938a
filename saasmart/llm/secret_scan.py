"""Secret scans: base patterns, and literals bound to sensitive names.

The lexer goes from one assignment sign (``=``, ``:=``, ``=>``, ``:``) to the next. Left
of it stands a target name, right of it a value: a quoted string, a bare token, a name,
``${name}``, or several of these joined with ``+``. A string in three quotes may go over
several lines. Signs inside a value are read as well. Three more forms bind a name: a call
with a string as its first argument, an XML element that holds only text, and an armoured
block (``BEGIN .. PRIVATE KEY``). Names bound to literals are constants of their text (those bound inside a value
only if nothing else binds them); a value that refers to them stands for their literals,
by reference, so that the work is linear however constants are joined. Each
(target, literals) pair is scored by the words of its target name and by what the
literal looks like. From ``THRESHOLD`` on, its literals become spans of the kind
``named``, but for those that lie wholly in the secret parts of base spans.

All spans are in code points, end exclusive. Defined results: a null text counts as
empty; empty texts have no spans; repeated rows are answered each on its own.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("assign", "access", "hex", "named")
THRESHOLD = 0.6

#: What a target name's words say about its value.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "secret": 1.0,
    "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "auth": 0.6,
    "authorization": 0.7, "pat": 0.6, "pin": 0.5, "salt": 0.6, "signature": 0.5, "sas": 0.5,
}
#: Words that make a ``key`` sensitive.
KEY_OF = {"api", "access", "private", "secret", "signing", "encryption", "auth", "account", "master", "ssh", "service"}
#: Literals that stand for nothing.
PLACEHOLDER = re.compile(r"(?i)^(?:none|null|nil|true|false|undefined|todo|changeme|example|placeholder|redacted|dummy|test"
                         r"|x+|\*+|\.+|<.*>|\{.*\}|your[-_ ].*|env|string|str|int|bool|required|optional)$")

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that are long enough

SIGN = re.compile(r"[=:]")
NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
NAME_START = re.compile(r"[A-Za-z_]")
VALUE = re.compile(r"""[ \t]*(?:(?P<triple>\"{3}|'{3})(?P<long>(?:\\[\s\S]|(?!(?P=triple))[^\\])*+)(?P=triple)|(?P<quote>["'`])(?P<text>(?:\\.|(?!(?P=quote))[^\\\n])*+)(?P=quote)"""
                   r"""|\$\{?(?P<ref>[A-Za-z_][A-Za-z0-9_.]*+)\}?|(?P<bare>[^\s"'`,;#&|<>()\[\]{}+]))""")
BARE = re.compile(r"""[^\s"'`,;#&|<>()\[\]{}+]++""")
JOIN = re.compile(r"[ \t]*\+")
CALL = re.compile(r"\([ \t]*+(?=[\"'`])")
AFTER_ARGUMENT = re.compile(r"[ \t]*+[,)]")
ELEMENT = re.compile(r"<([A-Za-z_][A-Za-z0-9_.:-]*+)(?:\s[^<>]*+)?>\s*+([^<>]++)</\1\s*+>")
BLOCK = re.compile(r"-----BEGIN ([A-Z0-9 ]++)-----")
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

_KEEP = 32  # parts after which a chain's statistics are kept
_HEAD = 16  # characters by which placeholders are known, with the last one and the counts


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the secret part) of the base patterns."""
    out = []
    if ":" in text or "=" in text:
        out += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    return out


def name_weight(name: str) -> float:
    """How sensitive a target name is: the most that any of its words says."""
    words = [w.lower() for w in WORD.findall(name)]
    most = max([SENSITIVE.get(w, 0.0) for w in words], default=0.0)
    for a, b in zip(words, words[1:]):
        if b in ("key", "keys") and a in KEY_OF:
            most = 1.0
        most = max(most, SENSITIVE.get(a + b, 0.0))
    return most


@dataclass(slots=True)
class Stats:
    """What is known of a literal: length, characters, how it starts and ends."""

    n: int = 0
    count: Counter = field(default_factory=Counter)
    head: str = ""
    tail: str = ""

    def copy(self) -> Stats:
        return Stats(self.n, Counter(self.count), self.head, self.tail)

    def put_before(self, other: Stats) -> None:
        self.n += other.n
        for c, n in other.count.items():
            self.count[c] += n
        self.head = (other.head + self.head)[:_HEAD]
        self.tail = self.tail or other.tail

    @property
    def placeholder(self) -> bool:
        if self.n <= _HEAD:
            return bool(PLACEHOLDER.match(self.head))
        return self.count.keys() <= {"x", "X"} or len(self.count) == 1 and self.tail in "*." \
            or self.head[0] + self.tail in ("<>", "{}") or bool(re.match("(?i)your[-_ ]", self.head))

    def weight(self) -> float:
        if self.n < 8 or self.placeholder:
            return 0.0
        entropy = -sum(n / self.n * math.log2(n / self.n) for n in self.count.values() if n / self.n)
        mixed = any(c.isdigit() for c in self.count) and any(c.isalpha() for c in self.count)
        return 0.4 + 0.3 * (entropy >= 2.75) + 0.3 * mixed


def _stats_of(part: str) -> Stats:
    return Stats(len(part), Counter(part), part[:_HEAD], part[-1:])


def literal_weight(literal: str) -> float:
    """How much a literal looks like a secret."""
    return _stats_of(literal).weight()


@dataclass(slots=True, eq=False)
class Value:
    """A value from one of its parts on: a literal of the text or a constant, then what is joined to it."""

    span: tuple[int, int] | None
    refers: Value | None
    more: Value | None
    end: int
    stats: Stats | None = None
    reported: bool = False

    def chain(self) -> Iterator[Value]:
        part = self
        while part is not None:
            yield part
            part = part.more


class Lexer:
    """(target name, value) pairs of a text, and what the values' literals look like."""

    def __init__(self, text: str):
        self.text = text
        self.constants: dict[str, Value] = {}
        self.inner: dict[str, Value] = {}
        self.values: dict[int, tuple[Value | None, int]] = {}
        self.run = (0, 0)                      # the last run of bare characters
        self.part = (0, 0, Counter())          # the last part measured: start, end, characters
        self.longest = 0                       # of the names bound so far

    def name(self, at: int) -> str:
        """The target name that ends before a sign, empty if there is none."""
        text = self.text
        if at and text[at - 1] == ":":
            at -= 1
        while at and text[at - 1] in " \t":
            at -= 1
        at -= at > 0 and text[at - 1] == "]"
        at -= at > 0 and text[at - 1] in "\"'"
        start = at
        while start and text[start - 1] in NAME_CHARS:
            start -= 1
        first = NAME_START.search(text, start, at)
        return text[first.start():at] if first else ""

    def value(self, at: int) -> Value | None:
        """The value that starts at ``at``; parts that were read before are not read again."""
        read, text = [], self.text
        while at not in self.values:
            found = VALUE.match(text, at)
            if not found:
                self.values[at] = None, at
                break
            span, refers, end = None, None, found.end()
            if found["long"] is not None:
                span = found.span("long")
            elif found["text"] is not None:
                span = found.span("text")
            else:
                name = found["ref"]
                if found["bare"]:
                    start = found.start("bare")
                    if not self.run[0] <= start < self.run[1]:
                        self.run = BARE.match(text, start).span()
                    span, end = (start, self.run[1]), self.run[1]
                    name = text[start:end] if end - start <= self.longest else None
                refers = self.constants.get(name) or self.inner.get(name)
                span = None if refers else span
            joined = JOIN.match(text, end)
            read.append((at, span, refers, end))
            if not joined:
                at = -1
                break
            at = joined.end()
        more = self.values[at][0] if at >= 0 else None
        for at, span, refers, end in reversed(read):
            if span or refers:
                more = Value(span, refers, more, max(end, more.end if more else 0))
            self.values[at] = more, end
        return more

    def pairs(self) -> Iterator[tuple[str, Value]]:
        text, after = self.text, 0
        for sign in SIGN.finditer(text):
            at = sign.start()
            if text[at:at + 2] in ("==", "=~", "::", ":/") or at and text[at - 1:at + 1] == ":=":
                continue
            name = self.name(at)
            if not name:
                continue
            at += 1 + (text[at:at + 2] in (":=", "=>"))
            value = self.value(at)
            if value is None:
                continue
            (self.inner if sign.start() < after else self.constants)[name] = value
            self.longest = max(self.longest, len(name))
            after = max(after, value.end)
            yield name, value

    def marked(self) -> Iterator[tuple[str, Value]]:
        """(name, value) of calls with a string as first argument, of elements and of armoured blocks."""
        text = self.text
        for m in CALL.finditer(text):
            name = self.name(m.start()) if text[m.start() - 1:m.start()] in NAME_CHARS else ""  # prose has a blank there
            value = name_weight(name) and self.value(m.end())
            if value and AFTER_ARGUMENT.match(text, value.end):
                yield name, value
        for m in ELEMENT.finditer(text):
            start, end = m.span(2)
            end = start + len(m[2].rstrip())
            yield m[1], Value((start, end), None, None, end)
        at, open_ended = 0, set()
        for m in BLOCK.finditer(text):
            if m.start() < at or m[1] in open_ended:
                continue
            end = text.find(f"-----END {m[1]}-----", m.end())
            if end < 0:
                open_ended.add(m[1])
                continue
            at = end
            body = text[m.end():end]
            start = m.end() + len(body) - len(body.lstrip())
            end = max(start, m.end() + len(body.rstrip()))
            yield m[1], Value((start, end), None, None, end)

    def _own(self, part: Value) -> Stats:
        if part.refers:
            return part.refers.stats
        start, end = part.span
        s, e, count = self.part
        if e == end and s <= start:  # the end of the last one
            count.subtract(text := self.text[s:start])
            for c in set(text):
                if not count[c]:
                    del count[c]
        else:
            count = Counter(self.text[start:end])
        self.part = start, end, count
        return Stats(end - start, Counter(count), self.text[start:min(end, start + _HEAD)], self.text[max(start, end - 1):end])

    def measure(self, value: Value) -> Stats:
        """Statistics of the value's literals, joined."""
        todo = [value]
        while todo:
            now = todo[-1]
            missing = []
            for part in now.chain():
                if part.stats is not None:
                    break
                if part.refers and part.refers.stats is None:
                    missing.append(part.refers)
            if missing:
                todo += missing
                continue
            if now.stats is None:
                parts, known = [], Stats()
                for part in now.chain():
                    if part.stats is not None:
                        known = part.stats.copy()
                        break
                    parts.append(part)
                for k, part in enumerate(reversed(parts), 1):
                    known.put_before(self._own(part))
                    if k % _KEEP == 0:  # for values that start farther on in the chain
                        part.stats = known.copy()
                now.stats = known
            todo.pop()
        return value.stats

    def report(self, value: Value) -> Iterator[tuple[int, int]]:
        """Spans of the value's parts and its constants', each once."""
        todo = [value]
        while todo:
            for part in todo.pop().chain():
                if part.reported:
                    break
                part.reported = True
                if part.refers:
                    todo.append(part.refers)
                elif part.span[1] > part.span[0]:
                    yield part.span


def find_secrets(text: str) -> list[tuple[str, int, int, int]]:
    """Base spans and the spans that the lexer adds, by start and kind."""
    spans = base_spans(text)
    if any(mark in text for mark in ("=", ":", "(", "</", "-----BEGIN ")):
        taken = _merged((s, e) for _, _, e, s in spans)
        added, lexer, last = set(), Lexer(text), (0, 0)
        for name, value in chain(lexer.pairs(), lexer.marked()):
            weight = name_weight(name)
            if not weight or value.reported or value.more is None and value.span and last[0] <= value.span[0] and value.span[1] <= last[1]:
                continue
            if weight * lexer.measure(value).weight() >= THRESHOLD:
                added.update(lexer.report(value))
                last = value.span or last
        end = 0
        for s, e in sorted(added, key=lambda x: (x[0], -x[1])):
            if e > end and not _covered(taken, s, e):  # one inside another is the other's
                spans.append(("named", s, e, s))
            end = max(end, e)
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans by start, those that overlap or adjoin as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def _covered(merged: list[tuple[int, int]], start: int, end: int) -> bool:
    at = bisect_right(merged, (start, math.inf)) - 1
    return at >= 0 and end <= merged[at][1]


def redact(text: str, spans: list[tuple[str, int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with the secret part of each span replaced; parts that overlap are one."""
    out, at = [], 0
    for start, end in sorted((s, e) for _, _, e, s in spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType())])
RESULT = T.StructType([
    T.StructField("spans", T.ArrayType(SPAN)), T.StructField("base_sha256", T.StringType()),
    T.StructField("redacted", T.StringType()),
])
_ARROW = pa.struct([
    ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
    ("base_sha256", pa.string()), ("redacted", pa.string()),
])


def scan(text: Column, keep_text: bool = False) -> Column:
    """A struct per text: spans, base_sha256 (of the base spans), redacted (with ``keep_text``)."""
    @F.arrow_udf(RESULT)
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            rows = []
            for value in column:
                raw = value.as_py() or ""
                spans = find_secrets(raw)
                base = ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans if k != "named")
                rows.append({
                    "spans": [{"kind": k, "start": s, "end": e} for k, s, e, _ in spans],
                    "base_sha256": hashlib.sha256(base.encode()).hexdigest(),
                    "redacted": (redact(raw, spans) if value.is_valid else None) if keep_text else None,
                })
            yield pa.array(rows, _ARROW)

    return run.asNondeterministic()(text.cast("string"))
