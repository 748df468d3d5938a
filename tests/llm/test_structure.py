"""Conversation repair against enumeration of edits and a plain reading of the contract."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from saasmart.llm import structure
from saasmart.llm.queries import QUERIES
from tests.conftest import SF01

SOLID = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    """(role, text) rows -> the first fault of each."""
    seen, out = set(), []
    for role, text in rows:
        solid = SOLID.findall(text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        out.append(fault)
    return out


def every_edit(rows):
    """(cost, audit, repaired) of all edits with at most two inserted rows in a place that give a right order."""
    choices = []
    for (role, text), fault in zip(rows, faults(rows)):
        own = [(2, "D", [])]
        if fault not in ("blank", "duplicate"):
            cut = 5 if fault == "truncated" else 0
            own += [(cut, "K", [(role, text)])] + [(1 + cut, "R", [(r, text)]) for r in ("user", "assistant")]
        choices.append(own)
    new = [[]] + [[a] for a in ("user", "assistant")] + [[a, b] for a in ("user", "assistant") for b in ("user", "assistant")]
    inserts = [(5 * len(x), "I" * len(x), [(r, "") for r in x]) for x in new]
    places = [inserts]
    for c in choices:
        places += [c, inserts]
    for picked in itertools.product(*places):
        out = [row for _, _, own in picked for row in own]
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in out)):
            yield sum(c for c, _, _ in picked), "".join(x for _, x, _ in picked), out


def plain(rows):
    """Cheapest edits of any number of rows, the least string of equals, by memoised search over (row, state)."""
    found = faults(rows)
    go = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @lru_cache(None)
    def best(at, state, inserted=0):
        ways = []
        if at == len(rows):
            if state in (0, 3):
                ways.append((0, "", ()))
        else:
            role, text = rows[at]
            cost, audit, out = best(at + 1, state)
            ways.append((cost + 2, "D" + audit, out))
            if found[at] not in ("blank", "duplicate"):
                cut = 5 if found[at] == "truncated" else 0
                for letter, new, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                    if (state, new[:1]) in go:
                        cost, audit, out = best(at + 1, go[state, new[:1]])
                        ways.append((cost + price + cut, letter + audit, ((new, text), *out)))
        if inserted < 3:
            for new in ("user", "assistant"):
                if (state, new[:1]) in go:
                    cost, audit, out = best(at, go[state, new[:1]], inserted + 1)
                    ways.append((cost + 5, "I" + audit, ((new, ""), *out)))
        return min(ways, default=(10 ** 9, "", ()))

    return best(0, 0)


def expected(rows):
    """(key, turn, role, text) -> key: the row of the contract, without the damage."""
    out = {}
    for key in {r[0] for r in rows}:
        own = [(t, " " if role is None else role, " " if x is None else x) for k, t, role, x in rows if k == key]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        pairs = [r[1:] for r in own]
        turns = {r[0] for r in own} - {None}
        found = faults(pairs)
        cost, audit, repaired = plain(tuple(pairs))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        text = "\n".join(f"{r}:{x}" for r, x in repaired)
        out[key] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(f) for f in ("blank", "duplicate", "truncated")),
                    illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def damaged(rows):
    for key, turn, role, text in rows:
        key_text, turn_text = (" " if v is None else str(v) for v in (key, turn))
        role, text = (" " if v is None else v for v in (role, text))
        fault = zlib.crc32(f"{key_text}:{turn_text}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        for _ in range((fault != 0) + (fault == 3)):
            yield key, turn, "user" if fault == 4 else role, text


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def answers(df, key="id"):
    got = df.collect()
    assert len({r[key] for r in got}) == len(got)
    return {r[key]: tuple(r[f] for f in FIELDS) for r in got}


ROLES = ("system", "user", "assistant", "tool", "", " ", "User")
TEXTS = ("Yes.", "No!", "cut off", "", " \t", "Why? ", "é", "...")


def made(rng, n):
    return [(rng.choice(ROLES[:3] if rng.random() < 0.8 else ROLES), rng.choice(TEXTS)) for _ in range(n)]


def test_plain_reading_equals_enumeration():
    rng = random.Random(1)
    for n in [0, 1, 1, 1, 2, 2, 2, 2, 3, 3]:
        rows = tuple(made(rng, n))
        cost, audit, out = min(every_edit(rows))
        assert plain(rows) == (cost, audit, tuple(out))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 16, 17, 60, 200])
def test_checkpointed_walk_equals_plain_reading(n):
    rng = random.Random(n)
    for _ in range(60 if n < 10 else 8):
        pairs = made(rng, n)
        rows = structure.Rows()
        found = faults(pairs)
        for (role, _), fault in zip(pairs, found):
            code = structure._CLASS.get(role[:1], 3)
            rows.add(code | (0 if fault in ("blank", "duplicate") else 8) | (4 if fault == "truncated" else 0), 1)
        solved = rows.solve()
        assert len(solved.kept) <= len(pairs) ** 0.5 + 2
        out, audit = [], ""
        for (letters, before, role), row in zip(solved.walk(), [*pairs, None]):
            audit += letters
            out += [(r, "") for r in before]
            if role is not None:
                out.append((role or row[0], row[1]))
        assert (solved.cost, audit, tuple(out)) == plain(tuple(pairs))


def test_conversations_match_plain_reading(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = expected(list(damaged(rows)))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want |= {key: nothing for key in {r[0] for r in rows} - set(want)}
    assert answers(QUERIES["op13_structure_repair"](spark, SF01), "conv_id") == want


def test_odd_rows(spark):
    rng = random.Random(4)
    rows = []
    for key in range(60):
        for _ in range(rng.randint(0, 12)):
            rows.append((key, rng.choice([None, 0, 1, 2, 3, 5, 9, -4]), rng.choice([None, *ROLES]), rng.choice([None, *TEXTS])))
    rows += [(None, 1, "user", "A null key."), (None, 2, "assistant", "Has a conversation."), (90, None, None, None),
             (91, 0, "user", "x" * 200_000 + "."), (91, 1, "assistant", "ok."), (92, -(1 << 63), "user", "a."), (92, (1 << 63) - 1, "tool", "b.")]
    rows += rows[:40] + rows[:20]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .selectExpr("*", "1 as id", "2 as kind", "3 as _here", "4 as digest", "5 as copies")
    want = {k: (None, *v[1:]) if v[0] >= 1 << 63 else v for k, v in expected(rows).items()}
    for n in (1, 5):
        assert answers(structure.repair(df.repartition(n), keep=True)) == want
    hurt, here = structure.damage(df)
    kept = answers(structure.repair(hurt, present=hurt[here]))
    want = expected(list(damaged(rows)))
    assert {k: v[5:7] for k, v in kept.items() if k in want} == {k: v[5:7] for k, v in want.items()}
    assert set(kept) == {r[0] for r in rows}


def test_repaired_rows_and_a_long_conversation_with_copies(spark):
    base = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(3000)]
    rows = base + base[10:20] * 400
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    got = structure.repair(df, keep=True).first()
    assert (got.cost, got.duplicate, got.gaps) == (2 * 4000, 4000, 0)
    assert got.audit.count("K") == 3000 and [(x.role, x.text) for x in got.repaired] == [r[2:] for r in base]


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    hurt, here = structure.damage(df)
    assert structure.repair(hurt, present=hurt[here]).count() == 0
