"""Chat formatting after a cumulative-snapshot collapse, in DataFrame operations alone.

Logs often hold the same conversation several times, cut at different turns. Every turn
gets a rolling hash of the conversation up to it: the exclusive or of position-tagged
128-bit turn hashes, one streaming window per conversation. A conversation whose last
rolling hash is that of an earlier turn of another one is a prefix of it; an anti-join
drops it. Of equal conversations the one with the smallest id stays. Only hashes travel
through these joins. The maximal conversations are then rendered, one text each.

Defined results: turns go by turn (nulls first), role, text; rows that repeat a turn
wholly count once; a null role or text is empty; rows without a conversation id are in
no conversation; an empty table has no conversations. One conversation is one row of
the result, so it must fit in a task; its copies don't meet there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Opening and closing marks of a turn, around "role, line break, text".
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def conversations(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(id, turns): the distinct turns of each conversation in order."""
    row = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                   F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return turns.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.sort_array(F.collect_set(row)).alias("turns"))


def rolling_hashes(found: DataFrame) -> DataFrame:
    """(id, n, at, a, b): for each turn, the hash of the conversation up to it."""
    spread = found.select("id", F.size("turns").alias("n"), F.posexplode("turns").alias("pos", "t"))
    tag = lambda seed: F.xxhash64(F.lit(seed), "pos", "t.role", F.lit("/"), "t.text")
    upto = Window.partitionBy("id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return spread.select("id", "n", "pos", tag("a").alias("x"), tag("b").alias("y")) \
        .select("id", "n", (F.col("pos") + 1).alias("at"), F.bit_xor("x").over(upto).alias("a"), F.bit_xor("y").over(upto).alias("b"))


def maximal(found: DataFrame) -> DataFrame:
    """(id) of the conversations that are no prefix of another one; the smallest id of equal ones."""
    hashes = rolling_hashes(found)
    whole = hashes.where("at = n").groupBy("at", "a", "b").agg(F.min("id").alias("id"))
    inner = hashes.where("at < n").select("at", "a", "b").distinct()
    return whole.join(inner, ["at", "a", "b"], "left_anti").select("id")


def format_chats(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 opening: str = OPEN, closing: str = CLOSE) -> DataFrame:
    """(id, n_turns, chat): the maximal conversations, rendered."""
    found = conversations(turns, key, turn, role, text)
    kept = found.join(maximal(found), "id", "left_semi")
    shown = F.transform("turns", lambda t: F.concat(F.lit(opening), t["role"], F.lit("\n"), t["text"], F.lit(closing)))
    return kept.select("id", F.size("turns").cast("long").alias("n_turns"), F.array_join(shown, "").alias("chat"))
