"""Personal data: base patterns, and a bootstrapped contextual extraction.

The base patterns give the seed entities. Every occurrence of a seed, and of any other
run of groups that have digits (``030 123 4567``, ``abx-k2``, of any length), induces two
lexical patterns: the two words before it, and the word before it with the word after it.
Patterns and instances form a bipartite graph that Spark scores round by round:

- a pattern scores the mean confidence of its distinct instances, one more counted as
  worthless; it is accepted from ``PATTERN_SCORE`` on if ``SUPPORT`` or more of its
  instances are accepted. Seeds are accepted from the start, with certainty;
- an instance scores what its accepted patterns leave open, multiplied up; it is accepted
  from ``INSTANCE_SCORE`` on and then supports further patterns.

What is accepted keeps its score, so a round that accepts nothing is the fixpoint, and each
round reads only the edges of what the last one accepted. Scores are whole millionths and
sums of logarithms whole, too: no order of addition can move a score over its threshold.
Occurrences of accepted instances in accepted patterns are added with the kind ``context``.

One pass over the texts writes the spans and occurrences to the shared folder; texts are
never shuffled, and each round's gains are written there, too. Patterns of fewer than
``SUPPORT`` distinct instances can't be accepted and leave the graph at once.

A run joins neighbouring groups over one blank (with a hyphen, slash or bracket at it),
never over a base span; groups of up to four capitals count inside a run. Words are runs
of letters, digits and underscores, digits read as 0; one of over 64 characters stands
as its hash.

All spans are in code points, end exclusive. Defined results: a null text counts as
empty; empty texts have no spans; repeated rows are answered each on its own, and count
once as instances; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import cut

KINDS = ("email", "ip", "card", "phone", "context")
PATTERN_SCORE = 0.6
INSTANCE_SCORE = 0.6
SUPPORT = 3

# The contract's patterns, with possessive repeats where giving back can't help.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

MAYBE = re.compile(r"[0-9@]")
WORD = re.compile(r"\w+")
GROUP = re.compile(r"\+?\w+(?:(?:[-._/]|(?<=[0-9]):(?=[0-9]))\w+)*")
DIGIT = re.compile("[0-9]")
CAPITALS = re.compile("[A-Z]{1,4}")
JOINT = re.compile(r"\)?[ \t\xa0](?:[-/\u2013][ \t\xa0])?\(?")
_LOOK = 64  # code points of context to try first
_ONE = 1_000_000


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = seen = 0
    at = text.find("@")
    while at >= 0:
        low = max(end, seen)
        start = low + len(text[low:at].rstrip(LOCAL))
        seen = at + 1
        if start < at and at >= end and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start and kind."""
    out = []
    if not MAYBE.search(text):
        return out
    out += [("email", *span) for span in _emails(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-4:]) < 256 for p in m.groups())]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def _groups(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, bool]]:
    """(start, end, has a digit) of the groups between the spans ``taken`` (by start)."""
    at = 0
    for low, high in [*taken, (len(text), len(text))]:
        for m in GROUP.finditer(text, at, max(at, low)):
            if DIGIT.search(m[0]):
                yield *m.span(), True
            elif CAPITALS.fullmatch(m[0]):
                yield *m.span(), False
        at = max(at, high)


def _identifiers(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Runs of groups with digits outside the spans."""
    begin = stop = last = None  # the run, and the end of its last group of any kind
    for start, end, digits in _groups(text, sorted((s, e) for _, s, e in spans)):
        if begin is not None and JOINT.fullmatch(text, last, start):
            last, stop = end, end if digits else stop
        else:
            if begin is not None:
                yield begin, stop
            begin, stop, last = (start, end, end) if digits else (None, None, None)
    if begin is not None:
        yield begin, stop


def _plain(word: str) -> str:
    word = re.sub("[0-9]", "0", word.lower())
    return word if len(word) <= 64 else xxhash.xxh3_128_hexdigest(word.encode())


def _before(text: str, start: int) -> list[str]:
    """The two words before ``start``."""
    look = _LOOK
    while True:
        low = max(0, start - look)
        words = WORD.findall(text, low, start)
        if len(words) > 2 or low == 0:  # the first one may be cut
            return ["^"] * (2 - len(words)) + [_plain(w) for w in words[-2:]]
        look *= 4


def _patterns(text: str, start: int, end: int) -> list[str]:
    before, after = _before(text, start), WORD.search(text, end)
    return [f"{before[0]} {before[1]} _", f"{before[1]} _ {_plain(after[0]) if after else '$'}"]


FOUND = T.StructType([
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("seen", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("seed", T.BooleanType()),
        T.StructField("instance", T.BinaryType()), T.StructField("patterns", T.ArrayType(T.StringType()))]))),
])
_ARROW = pa.struct([
    ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
    ("seen", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_()), ("instance", pa.binary()),
                                 ("patterns", pa.list_(pa.string()))]))),
])


def occurrences(text: Column) -> Column:
    """A struct per text: base spans, and the seeds and identifiers seen with their patterns."""
    def seen(text: str, start: int, end: int, seed: bool) -> dict:
        name = xxhash.xxh3_128_digest(text[start:end].lower().encode())
        return {"start": start, "end": end, "seed": seed, "instance": name, "patterns": _patterns(text, start, end)}

    @F.arrow_udf(FOUND)
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            rows = []
            for value in column:
                body = value.as_py() or ""
                spans = base_spans(body)
                found = [seen(body, s, e, True) for _, s, e in spans]
                if MAYBE.search(body):
                    found += [seen(body, s, e, False) for s, e in _identifiers(body, spans)]
                rows.append({"spans": [{"kind": k, "start": s, "end": e} for k, s, e in spans], "seen": found})
            yield pa.array(rows, _ARROW)

    return run.asNondeterministic()(text.cast("string"))


def _left_open(score: float) -> int:
    """Minus the logarithm of what a score leaves open, in millionths."""
    return round(-math.log1p(-score) * _ONE)


def score_graph(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted (pattern, score) and (instance, score), in millionths, from edges (pattern, instance, seed)."""
    edges = edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    edges = cut(edges, "pii-edges")
    seeds = cut(edges.where("seed").select("instance", F.lit(_ONE).cast("long").alias("score")).distinct(), "pii-seeds")
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= SUPPORT)
    edges = cut(edges.select("pattern", "instance").join(sizes, "pattern"), "pii-graph")
    patterns = edges.select("pattern", F.lit(0).cast("long").alias("score")).where("false")
    instances, fresh, gains, opened = seeds, seeds, None, None
    while True:
        gained = edges.join(fresh, "instance").groupBy("pattern").agg(
            F.first("n").alias("n"), F.sum("score").alias("total"), F.count("*").alias("support"))
        if gains is not None:
            gained = gains.unionByName(gained).groupBy("pattern").agg(
                F.first("n").alias("n"), F.sum("total").alias("total"), F.sum("support").alias("support"))
        gains = cut(gained, "pii-gains")
        score = F.expr("total div (n + 1)")
        fresh_patterns = cut(gains.where((score >= round(PATTERN_SCORE * _ONE)) & (F.col("support") >= SUPPORT))
                             .select("pattern", score.alias("score")).join(patterns, "pattern", "left_anti"), "pii-patterns")
        if fresh_patterns.isEmpty():
            return patterns, instances
        patterns = patterns.unionByName(fresh_patterns)
        left = F.round(-F.log1p(-F.col("score") / _ONE) * _ONE).cast("long")
        found = edges.join(fresh_patterns, "pattern").join(instances.select("instance"), "instance", "left_anti") \
            .groupBy("instance").agg(F.sum(left).alias("left"))
        if opened is not None:
            found = opened.join(instances.select("instance"), "instance", "left_anti") \
                .unionByName(found).groupBy("instance").agg(F.sum("left").alias("left"))
        opened = cut(found, "pii-opened")
        fresh = cut(opened.where(F.col("left") >= _left_open(INSTANCE_SCORE))
                    .select("instance", F.round((1 - F.exp(-F.col("left") / _ONE)) * _ONE).cast("long").alias("score")), "pii-instances")
        if fresh.isEmpty():
            return patterns, instances
        instances = instances.unionByName(fresh)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans, added): per row the base spans and those that contexts add, each by start."""
    rows = cut(docs.select(F.col(key).alias("id"), F.monotonically_increasing_id().alias("row"),
                           occurrences(F.col(text)).alias("x")).select("id", "row", "x.*"), "pii-occurrences")
    seen = rows.select("row", F.explode("seen").alias("o")).select("row", "o.*")
    patterns, instances = score_graph(seen.select("instance", "seed", F.explode("patterns").alias("pattern")))
    added = seen.where("not seed").join(instances.select("instance"), "instance") \
        .select("row", "start", "end", F.explode("patterns").alias("pattern")) \
        .join(patterns.select("pattern"), "pattern").groupBy("row").agg(
            F.sort_array(F.collect_set(F.struct(F.lit("context").alias("kind"), "start", "end"))).alias("added"))
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return rows.select("id", "row", "spans").join(added, "row", "left") \
        .select("id", "spans", F.coalesce("added", empty).alias("added"))
