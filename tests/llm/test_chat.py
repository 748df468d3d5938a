"""Chat formatting against brute force."""

import random

from saasmart.llm import chat
from saasmart.llm.queries import QUERIES
from tests.conftest import SF01


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, set()).add(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in convs.items()}
    out = []
    for c, turns in convs.items():
        beaten = any((len(o) > len(turns) and o[:len(turns)] == turns) or (o == turns and k < c) for k, o in convs.items())
        if not beaten:
            out.append((c, len(turns), "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)))
    return sorted(out)


def test_conversations_match_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, QUERIES["op3_chat_format"](spark, SF01).collect())) == brute(rows)


def test_snapshots_ties_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [(None, 0, "user", "lost"), (500, None, None, None), (501, 0, "user", ""), (502, 0, "user", "x" * 100000)]
    for base in range(8):
        turns = [(k, rng.choice(["user", "assistant"]), rng.choice(["hi", "yes", "no", "é", None, ""])) for k in range(rng.randint(1, 6))]
        for copy in range(4):
            upto = rng.randint(1, len(turns))
            rows += [(base * 10 + copy, 3 * k, role, text) for k, role, text in turns[:upto]]
    rows += [rows[7], rows[7], (rows[9][0], rows[9][1], "user", "tie")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as id", "2 as turns", "3 as n")
    assert sorted(map(tuple, chat.format_chats(df).collect())) == brute(rows)


def test_empty_table_and_no_python(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    out = chat.format_chats(df)
    assert out.count() == 0
    plan = chat.format_chats(spark.read.parquet(f"{SF01}/conversations.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
