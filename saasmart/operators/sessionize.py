"""Gap-based sessionization that stays balanced when one key is hot.

Semantics (per key, rows ordered by ts ascending with NULLs last, then by a
tiebreak column):

* ``prev``   = ts of the previous row of the same key (NULL for the first);
* ``is_new`` = 1 when ``prev IS NULL OR ts - prev > gap`` else 0 (a gap of
  exactly ``gap`` stays in the session; a NULL ts after a non-NULL one
  compares as NULL and so continues the session);
* ``session_number`` = running sum of ``is_new`` from the key's first row.

Plan
----
A plain ``Window.partitionBy(key)`` sends every row of a key to one task, so
a key holding a third of the data is a third of the job in one task. We
split hot keys into contiguous time slices instead, with labels that are a
pure function of the row and of exact aggregates (so every pass, and every
recomputation after a lost executor, assigns the same slice):

1. Per-key stats (count, min ts, max ts): a partial aggregation.
2. Hot keys: count > L, where L = max(N / (2P), floor) for N rows and P the
   target parallelism. Since counts sum to N there are at most 2P hot keys,
   a size bound by construction: the table is collected (one small job) and
   broadcast. With no hot key every key has at most L rows and the plain
   one-window plan (one exchange on the key) is already balanced.
3. A hot key with c rows gets 4 * ceil(c / L) equal-width time cells over
   [min ts, max ts]; NULL timestamps get one extra, last cell. Other keys
   keep slice -1 (the whole key, at most L rows). Up to three rounds of a
   bounded histogram pass find slices still holding more than L rows
   (bursts) and cut them again, by finer time sub-cells, or by a tiebreak
   hash when the whole slice is one timestamp (``heavy_cells``); a round
   that finds nothing ends the loop. A heavy slice at one timestamp and one
   tiebreak value (copies of a record) is pre-aggregated instead: its rows become count-carrying
   chunk rows in separate sub-slices, exploded back after the window. The
   NULL-timestamp cell of a key is ordered by the tiebreak alone and is cut
   into tiebreak ranges: equal-width ranges of an integral tiebreak, else by
   the next character after the slice's common prefix; copies at a NULL
   timestamp are collapsed the same way (each copy after the first starts a
   session, which the window counts through the copy count).
4. Window over (key, slice): lag and running sum inside each slice; one
   hash exchange on (key, slice), balanced by construction. A slice label is
   a long (cell, then cell * parts + sub per round) while its exact bound fits,
   else an array of levels; either way ordered like the rows it holds.
5. For hot keys only: one summary row per (key, slice) (first ts, last ts,
   local session count). Cells are at most 4 * (N / L + 2P) + 2P <= 18P;
   each refinement round adds at most about 16P sub-slices and copy chunks
   at most 4P, so the count is a constant times P, never a function of N. A window
   over those per key gives each later slice the previous slice's last ts
   and the number of sessions before it. Joined back on (key, slice) to
   correct the first row of each continued slice and the running number;
   broadcast only if the slices counted while cutting fit the session's
   broadcast threshold.

The slices hold for the data they were made from: build a table from the result,
not a view over a table that goes on growing.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saasmart.functions import gap_exceeds, micros_between
from saasmart.sources.rules import SESSION_GAP_SECONDS

# A key is split only when it has more rows than this floor, whatever the
# data size; below it one task handles a whole key comfortably.
MIN_SLICE_ROWS = 1_000_000
CELLS_PER_SLICE = 4

# A heavy cell is cut into this many time sub-cells per L rows it holds, or,
# at a single timestamp, into this many tiebreak-hash sub-slices per L rows.
TIME_SPLITS_PER_LIMIT = 4
TIE_SPLITS_PER_LIMIT = 2
# Every round cuts each heavy slice further, so few rounds are needed; beyond
# this many the slices are left as they are (results don't depend on them).
MOST_ROUNDS = 64
# Bytes of one fix-up row in a broadcast table, rounded up.
FIX_ROW_BYTES = 128

# Spans of 64-bit ids.
WIDE = T.DecimalType(20, 0)
CODE_POINTS = 0x110000

_SLICE = "_ss_slice"
_K = "_ss_copies"
_RN = "_ss_rn"
_LOCAL_SN = "_ss_local_sn"


def _hot_keys(df: DataFrame, key: str, ts: str, parallelism: int,
              slice_rows: int | None, min_slice_rows: int = MIN_SLICE_ROWS) -> DataFrame:
    stats = df.groupBy(key).agg(F.count(F.lit(1)).alias("_c"),
                                F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    if slice_rows is None:
        # N from a count: on a parquet scan it reads no column, only footers
        total = df.count()
        limit = F.lit(max(-(-total // (2 * parallelism)), int(min_slice_rows)))
    else:
        limit = F.lit(int(slice_rows))
    cells = F.ceil(F.col("_c") / limit) * CELLS_PER_SLICE
    span = micros_between(F.col("_lo"), F.col("_hi")) + 1
    return (stats.where(F.col("_c") > limit)
            .select(F.col(key).alias("_hk"), F.lit(True).alias("_hot"), "_lo",
                    cells.cast("long").alias("_g"),
                    F.greatest(F.ceil(span / cells), F.lit(1)).cast("long").alias("_w"),
                    limit.cast("long").alias("_limit")))


def hot_key_table(df: DataFrame, key: str = "user_id", ts: str = "event_timestamp",
                  parallelism: int | None = None, slice_rows: int | None = None,
                  min_slice_rows: int = MIN_SLICE_ROWS) -> DataFrame:
    """The hot keys with their time-cell layout, as a small driver-side relation.

    At most 2P rows by default (counts sum to N, each hot count exceeds N/2P),
    so collecting it is bounded; as a local relation it is computed once and
    is identical for every branch and every recomputation of the plan.
    """
    spark = df.sparkSession
    p = parallelism or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = _hot_keys(df, key, ts, p, slice_rows, min_slice_rows)
    return spark.createDataFrame(hot.collect(), hot.schema)


class _Labels:
    """Slice labels: longs while their exact bound fits in 62 bits, arrays beyond.

    A label is -1 for ordinary keys and a non-negative position for hot-key
    slices. Each refinement level maps label -> label * parts + sub (sub in
    [0, parts)), which keeps the order between old slices. The bound is
    tracked exactly on the driver; a level that could overflow switches the
    encoding to an array of longs (one element per level, compared element
    by element), so no label arithmetic can overflow.
    """

    LIMIT = 2 ** 62

    def __init__(self, bound: int) -> None:
        self.bound = bound          # hot labels lie in [0, bound)
        self.as_array = False

    def is_hot(self, label: str) -> Column:
        first = F.element_at(F.col(label), 1) if self.as_array else F.col(label)
        return first >= 0

    def level(self, parts: int):
        """Fix the encoding of one more level; returns apply(df, label, sub)."""
        use_long = not self.as_array and self.bound * parts < self.LIMIT
        to_array = not use_long and not self.as_array
        if use_long:
            self.bound *= parts
        else:
            self.as_array = True

        def apply(df: DataFrame, label: str, sub: Column) -> DataFrame:
            lab = F.col(label)
            if use_long:
                return df.withColumn(label, F.when(lab >= 0, lab * parts + sub.cast("long"))
                                     .otherwise(lab))
            if to_array:
                df = df.withColumn(label, F.array(lab))
                lab = F.col(label)
            return df.withColumn(label, F.when(F.element_at(lab, 1) >= 0,
                                               F.concat(lab, F.array(sub.cast("long"))))
                                 .otherwise(lab))
        return apply


def _bytes(setting: str) -> int:
    """Bytes that a size setting says (``10485760``, ``10485760b``, ``256k``, ``10m``, ..; -1: none)."""
    number = setting.strip().lower().rstrip("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(number[-1:], 0)
    return int(number[:-1] if unit else number) << unit


def _cell(ts: str) -> Column:
    """Time cell of a non-NULL ts inside its hot key's [lo, hi] range."""
    return F.greatest(F.lit(0), F.least(F.floor(micros_between(F.col("_lo"), F.col(ts)) / F.col("_w")),
                                        F.col("_g") - 1))


def heavy_cells(labeled: DataFrame, label: str, limit: int, key: str = "user_id",
                ts: str = "event_timestamp", tiebreak: str = "event_id",
                is_hot: Column | None = None, round_: int = 0) -> DataFrame:
    """Slices of hot keys that still hold more than ``limit`` rows, and how to cut them.

    A slice spanning several timestamps is cut into finer equal-width time
    sub-cells. A slice at one single timestamp (a tie group) is cut by a
    hash of the tiebreak; the sub-slice holding the smallest tiebreak is
    ordered first, which is all the session logic needs inside a tie group
    (every other row of the group continues the session of the first). A
    tie group at one tiebreak value too (``_copy``: copies of one record)
    cannot be cut by any order value; ``sessionize`` collapses it. ``round_``
    salts the tiebreak hash, so that values which fell together part later.
    Only key, ts and tiebreak are read, so this pass scans narrow columns.
    Counts sum to N, so there are at most N / limit <= 2P heavy slices: the
    table is collected once, like the hot-key table.
    """
    spark = labeled.sparkSession
    integral_tiebreak = isinstance(labeled.schema[tiebreak].dataType,
                                   (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    hist = (labeled.where(F.col(label) >= 0 if is_hot is None else is_hot)
            .groupBy(F.col(key).alias("_rk"), F.col(label).alias("_rc"))
            .agg(F.count(F.lit(1)).alias("_n"),
                 F.min(ts).alias("_cmin"), F.max(ts).alias("_cmax"),
                 F.min(tiebreak).alias("_tmin"), F.max(tiebreak).alias("_tmax")))
    need = F.ceil(F.col("_n") / F.lit(limit))
    null_ts = F.col("_cmin").isNull()             # the NULL-timestamp slice of a key
    tie = F.coalesce(F.col("_cmin") == F.col("_cmax"), F.lit(False))
    span = micros_between(F.col("_cmin"), F.col("_cmax")) + 1
    w2 = F.greatest(F.ceil(span / (need * TIME_SPLITS_PER_LIMIT)), F.lit(1)).cast("long")
    # NULL timestamps are ordered by the tiebreak alone: cut its range, with one
    # last part for NULL tiebreaks. Wide ids: the span may not fit a long
    if integral_tiebreak:
        tbmin = F.col("_tmin").cast(WIDE)
        tb_span = F.col("_tmax").cast(WIDE) - tbmin + 1
        wtb = F.greatest(F.ceil(tb_span / (need * TIME_SPLITS_PER_LIMIT)), F.lit(1)).cast(WIDE)
        tb_parts = F.ceil(tb_span / wtb) + 1
    else:  # by the character that follows the common prefix: its code point + 1, 0 at the end
        tbmin = wtb = F.lit(None).cast(WIDE)
        tb_parts = F.lit(CODE_POINTS + 2)
    # one record at one timestamp (or at NULL), copied: no order value can cut it
    copy = (tie | null_ts) & F.col("_tmin").eqNullSafe(F.col("_tmax"))
    parts = (F.when(null_ts, tb_parts)
             .when(tie, need * TIE_SPLITS_PER_LIMIT)
             .otherwise(F.ceil(span / w2))).cast("long")
    heavy = hist.where(F.col("_n") > F.lit(limit))
    if not integral_tiebreak and not isinstance(labeled.schema[tiebreak].dataType, T.StringType):
        heavy = heavy.where(~null_ts | copy)  # no range and no characters to cut by
    ref = heavy.select("_rk", "_rc", "_n", tie.alias("_tie"), null_ts.alias("_nullts"),
                       "_cmin", tbmin.alias("_tbmin"),
                       F.when(null_ts, wtb).alias("_wtb"),
                       F.when(~tie & ~null_ts, w2).alias("_w2"), parts.alias("_parts"),
                       F.when(tie, F.pmod(F.xxhash64(F.col("_tmin"), F.lit(round_)), parts))
                       .otherwise(F.lit(0)).cast("long").alias("_first"),
                       copy.alias("_copy"),
                       F.col("_tmin").cast("string").alias("_least"), F.col("_tmax").cast("string").alias("_most"))
    # few rows: the common prefixes are found on the driver
    rows = [(*r[:-2], len(os.path.commonprefix([r._least or "", r._most or ""])) if r._nullts and not integral_tiebreak else 0)
            for r in ref.collect()]
    schema = T.StructType([*ref.drop("_least", "_most").schema.fields, T.StructField("_prefix", T.IntegerType())])
    return spark.createDataFrame(rows, schema)


def _refine(labeled: DataFrame, label: str, heavy: DataFrame, key: str, ts: str,
            tiebreak: str, labels: _Labels, round_: int) -> DataFrame:
    """Extend every hot label by a sub-slice index (0 where the slice is not cut)."""
    by_tie = F.pmod(F.pmod(F.xxhash64(F.col(tiebreak), F.lit(round_)), F.col("_parts")) - F.col("_first"),
                    F.col("_parts"))
    within = lambda x, most: F.greatest(F.lit(0), F.least(x, most))
    by_time = within(F.floor(micros_between(F.col("_cmin"), F.col(ts)) / F.col("_w2")), F.col("_parts") - 1)
    if isinstance(labeled.schema[tiebreak].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        place = within(F.floor((F.col(tiebreak).cast(WIDE) - F.col("_tbmin")) / F.col("_wtb")).cast("long"),
                       F.col("_parts") - 2)
    else:
        text = F.col(tiebreak).cast("string")
        after = F.ascii(F.substr(text, F.col("_prefix") + 1, F.lit(1)))
        place = F.when(F.length(text) <= F.col("_prefix"), F.lit(0)).otherwise(after + 1)
    by_tb = F.when(F.col(tiebreak).isNull(), F.col("_parts") - 1).otherwise(place)
    sub = (F.when(F.col("_parts").isNull(), F.lit(0))
           .when(F.col("_nullts"), by_tb)
           .when(F.col("_tie"), by_tie).otherwise(by_time))
    apply = labels.level(heavy.agg(F.max("_parts")).first()[0])
    joined = labeled.join(F.broadcast(heavy),
                          F.col(key).eqNullSafe(F.col("_rk")) & (F.col(label) == F.col("_rc")),
                          "left")
    return (apply(joined, label, sub)
            .drop("_rk", "_rc", "_n", "_tie", "_nullts", "_cmin", "_tbmin", "_wtb", "_w2",
                  "_parts", "_first", "_copy", "_prefix"))


def _collapse_copies(labeled: DataFrame, copies: DataFrame, key: str, limit: int,
                     labels: _Labels) -> DataFrame:
    """Replace each heavy copy group by chunk rows of at most ``limit // 2`` copies.

    Only rows of the (bounded) copy groups are aggregated; partial
    aggregation collapses them map-side. Chunk j of a group gets its own
    sub-slice (the group's label plus j), so the window spreads the chunks
    over tasks; each chunk row carries its copy count in ``_K`` and is
    exploded back after the window.
    """
    chunk = max(1, limit // 2)
    apply = labels.level(copies.agg(F.max(F.ceil(F.col("_n") / F.lit(chunk)))).first()[0])
    cols = [c for c in labeled.columns if c != _SLICE]
    marked = labeled.join(F.broadcast(copies.select("_rk", "_rc")),
                          F.col(key).eqNullSafe(F.col("_rk")) & (F.col(_SLICE) == F.col("_rc")),
                          "left")
    rest = (apply(marked.where(F.col("_rc").isNull()), _SLICE, F.lit(0))
            .withColumn(_K, F.lit(1).cast("long"))
            .drop("_rk", "_rc"))
    groups = (marked.where(F.col("_rc").isNotNull())
              .groupBy(*cols, _SLICE).agg(F.count(F.lit(1)).alias("_k")))
    chunks = (groups
              .withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"),
                                                     F.ceil(F.col("_k") / F.lit(chunk)) - 1)))
              .withColumn(_K, F.least(F.lit(chunk).cast("long"),
                                      F.col("_k") - F.col("_j") * chunk))
              .drop("_k"))
    chunks = apply(chunks, _SLICE, F.col("_j")).drop("_j")
    return rest.unionByName(chunks)


def sessionize(df: DataFrame, key: str = "user_id", ts: str = "event_timestamp",
               tiebreak: str = "event_id", gap_seconds: int = SESSION_GAP_SECONDS,
               parallelism: int | None = None, slice_rows: int | None = None,
               min_slice_rows: int = MIN_SLICE_ROWS, prev_col: str = "prev_event_at",
               flag_col: str = "is_new_session",
               number_col: str = "session_number") -> DataFrame:
    """Add ``prev_col``, ``flag_col`` (int) and ``number_col`` (bigint) to ``df``.

    ``slice_rows`` fixes the hot-key threshold (tests use a small one to
    force splitting); by default it is max(N / (2 * parallelism), min_slice_rows),
    with ``parallelism`` the session's shuffle partitions unless given.
    """
    ts_order = [F.col(ts).asc_nulls_last(), F.col(tiebreak).asc_nulls_last()]

    # 1-2. hot keys (bounded); none -> every key fits a task, one window suffices
    hot = hot_key_table(df, key, ts, parallelism, slice_rows, min_slice_rows)
    if hot.isEmpty():
        return sessionize_plain(df, key, ts, tiebreak, gap_seconds, prev_col, flag_col,
                                number_col)

    # 3. slice label: -1 for ordinary keys, a time cell for hot keys,
    #    refined inside heavy cells (one more level per round, see _Labels)
    cell = (F.when(F.col("_hot").isNull(), F.lit(-1))
            .when(F.col(ts).isNull(), F.col("_g"))
            .otherwise(_cell(ts))).cast("long")
    limit = hot.first()["_limit"]
    labels = _Labels(hot.agg(F.max("_g")).first()[0] + 1)
    labeled = (df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hk")), "left")
               .withColumn(_SLICE, cell)
               .drop("_hk", "_hot", "_lo", "_g", "_w", "_limit"))
    slices = hot.agg(F.sum(F.col("_g") + 1)).first()[0]
    for round_ in range(MOST_ROUNDS):
        heavy = heavy_cells(labeled, _SLICE, limit, key, ts, tiebreak, labels.is_hot(_SLICE), round_)
        cuttable = heavy.where(~F.col("_copy"))
        if cuttable.isEmpty():
            break
        # a part by characters exists only if a row has its character
        slices += cuttable.agg(F.sum(F.least("_parts", "_n"))).first()[0]
        labeled = _refine(labeled, _SLICE, cuttable, key, ts, tiebreak, labels, round_)
    copies = heavy.where(F.col("_copy"))
    has_copies = not copies.isEmpty()
    if has_copies:
        slices += copies.agg(F.sum(F.ceil(F.col("_n") / max(1, limit // 2)))).first()[0]
        labeled = _collapse_copies(labeled, copies, key, limit, labels)

    # 4. local lag / running sum inside each (key, slice)
    w = Window.partitionBy(key, _SLICE).orderBy(*ts_order)
    local = (labeled
             .withColumn(_RN, F.row_number().over(w))
             .withColumn(prev_col, F.lag(ts).over(w)))
    is_new = (F.col(prev_col).isNull()
              | F.coalesce(gap_exceeds(F.col(ts), F.col(prev_col), gap_seconds), F.lit(False)))
    # a chunk row of copies at a NULL timestamp stands for _K rows that each
    # start a session (their previous ts is NULL): count the extra ones
    extra = (F.when(F.col(ts).isNull(), F.col(_K) - 1).otherwise(F.lit(0))
             if has_copies else F.lit(0))
    local = (local.withColumn(flag_col, is_new.cast("int"))
             .withColumn("_ss_step", F.col(flag_col) + extra)
             .withColumn(_LOCAL_SN, F.sum("_ss_step").over(
                 w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - extra))

    # 5. fix-ups for slices that continue an earlier slice of the same hot key
    summary = local.where(labels.is_hot(_SLICE)).groupBy(key, _SLICE).agg(
        F.min(ts).alias("_first_ts"),
        F.when(F.count(F.lit(1)) == F.count(ts), F.max(ts)).alias("_last_ts"),
        F.sum("_ss_step").cast("long").alias("_n"),
    )
    by_key = Window.partitionBy(key).orderBy(_SLICE)
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    upto = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first_new = (F.col("_prev_last").isNull()
                 | F.coalesce(gap_exceeds(F.col("_first_ts"), F.col("_prev_last"), gap_seconds),
                              F.lit(False)))
    fix = (summary
           .withColumn("_pos", F.row_number().over(by_key))
           .withColumn("_prev_last", F.lag("_last_ts").over(by_key))
           .withColumn("_first_new", F.when(F.col("_pos") == 1, F.lit(1))
                       .otherwise(first_new.cast("int")))
           .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))
                       - F.sum(1 - F.col("_first_new")).over(upto))
           .where(F.col("_pos") > 1)
           .select(F.col(key).alias("_fx_key"), F.col(_SLICE).alias("_fx_slice"),
                   "_prev_last", "_first_new", "_off"))

    threshold = local.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if slices * FIX_ROW_BYTES <= _bytes(threshold):
        fix = F.broadcast(fix)
    joined = local.join(fix,
                        F.col(key).eqNullSafe(F.col("_fx_key"))
                        & (F.col(_SLICE) == F.col("_fx_slice")),
                        "left")
    continued_first = F.col("_fx_slice").isNotNull() & (F.col(_RN) == 1)
    out = (joined
           .withColumn(prev_col, F.when(continued_first, F.col("_prev_last"))
                       .otherwise(F.col(prev_col)))
           .withColumn(flag_col, F.when(continued_first, F.col("_first_new"))
                       .otherwise(F.col(flag_col)).cast("int"))
           .withColumn(number_col, (F.col(_LOCAL_SN)
                                    + F.coalesce(F.col("_off"), F.lit(0))).cast("long"))
           .drop(_SLICE, _RN, _LOCAL_SN, "_ss_step", "_fx_key", "_fx_slice", "_prev_last",
                 "_first_new", "_off"))
    if not has_copies:
        return out
    # 6. copies back: the first copy of a chunk keeps its outputs; every other
    #    copy continues the session at the same timestamp, or, at a NULL
    #    timestamp, starts the next one (its previous ts is NULL)
    again = F.col("_copy_no") > 1
    null = F.col(ts).isNull()
    return (out.withColumn("_copy_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col(_K))))
            .withColumn(prev_col, F.when(again, F.col(ts)).otherwise(F.col(prev_col)))
            .withColumn(flag_col, F.when(again, F.when(null, F.lit(1)).otherwise(F.lit(0)))
                        .otherwise(F.col(flag_col)).cast("int"))
            .withColumn(number_col, (F.col(number_col) + F.when(null, F.col("_copy_no") - 1)
                                     .otherwise(F.lit(0))).cast("long"))
            .drop("_copy_no", _K))


def sessionize_plain(df: DataFrame, key: str = "user_id", ts: str = "event_timestamp",
                     tiebreak: str = "event_id", gap_seconds: int = SESSION_GAP_SECONDS,
                     prev_col: str = "prev_event_at", flag_col: str = "is_new_session",
                     number_col: str = "session_number") -> DataFrame:
    """The direct one-window form: one exchange on the key, one task per key.

    Used by ``sessionize`` when no key is hot (every key then has at most L
    rows), and by the tests as the reference the split form must equal.
    """
    w = Window.partitionBy(key).orderBy(F.col(ts).asc_nulls_last(), F.col(tiebreak).asc_nulls_last())
    out = df.withColumn(prev_col, F.lag(ts).over(w))
    is_new = F.col(prev_col).isNull() | F.coalesce(
        gap_exceeds(F.col(ts), F.col(prev_col), gap_seconds), F.lit(False))
    return (out.withColumn(flag_col, is_new.cast("int"))
            .withColumn(number_col, F.sum(flag_col).over(
                w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("long")))
