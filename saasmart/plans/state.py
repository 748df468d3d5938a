"""Marts kept up to date load by load.

A state table holds, per load folder of a raw table, what that load adds to a mart:
partial aggregates, bitmaps of users, or numbered sessions. ``update`` works through the loads
that the ledger has and the state doesn't, one after the other, and reads only their
folders; readers merge the parts. A part is written under its load's id with mode
overwrite and counts once it is complete (``_SUCCESS``), so an update that is cut short
goes on where it stopped, and one that is repeated gives the same folders.

* ``DailyUsers``: users of a day as bitmaps, a part per (day, bucket of ids), merged by
  ``bitmap_or_agg``; exact however the days spread over loads. A bitmap holds 32,768
  neighbouring ids in 4 KB, which suits ids that are dealt one after the other.
* ``Revenue``: sums by date, plan, country and status with the users as they are when a
  load is worked through; invoices of users not known then are kept by user and joined when
  the mart is read. If a known user's plan or country changes, or the user goes, the parts
  are made anew from all loads.
* ``Sessions``: numbered events, with each user's last event and session number carried
  from load to load. Users whose new events all come after that are numbered on from it;
  those with late, repeated or untimed events are numbered anew from all their events.

A state takes loads in the order in which the ledger got them, and keeps that order.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saasmart import schemas
from saasmart.functions import gap_exceeds, sum_where
from saasmart.plans import models as M
from saasmart.plans import staging as S
from saasmart.session import children, path_exists, remove_folder
from saasmart.sources import rules as R
from saasmart.streaming import ingest as I


def loads(spark: SparkSession, lake: I.Lake, table: str) -> list[str]:
    """Ids of the table's loads in its current generation, in the order in which they were loaded."""
    now = I.generation(spark, lake, table)
    ledger = I.read_ledger(spark, lake, table).where((F.col("load_mode") == "append") | (F.col("load_id") == now))
    found = ledger.groupBy("load_id").agg(F.min("loaded_at").alias("at")).orderBy("at", "load_id").collect()
    return [r.load_id for r in found]


def read_load(spark: SparkSession, lake: I.Lake, table: str, *load_ids: str) -> DataFrame:
    """The rows of these loads alone."""
    folder = I.current_path(spark, lake, table)
    schema = schemas.nullable(schemas.RAW_TABLES[table])
    return spark.read.schema(schema).parquet(*(f"{folder}/load_{x}" for x in load_ids))


@dataclass(frozen=True)
class Parts:
    """The folders of one state table: ``<kind>/<place in order>_<load id>``.

    A load has a folder of each kind; it is done once that of ``last`` is complete.
    """

    spark: SparkSession
    lake: I.Lake
    name: str
    table: str
    last: str

    @property
    def root(self) -> str:
        return f"{self.lake.root}/state/{self.name}"

    def path(self, kind: str, label: str) -> str:
        return f"{self.root}/{kind}/{label}"

    def done(self) -> list[str]:
        """Labels of the loads worked through, in that order."""
        found = [name for name, _ in children(self.spark, f"{self.root}/{self.last}/*")]
        return [x for x in sorted(found) if path_exists(self.spark, f"{self.path(self.last, x)}/_SUCCESS")]

    def write(self, df: DataFrame, kind: str, label: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(kind, label))
        return self.read(kind, [label])

    def read(self, kind: str, labels: list[str]) -> DataFrame:
        return self.spark.read.parquet(*(self.path(kind, x) for x in labels))

    def forget(self) -> None:
        remove_folder(self.spark, self.root)

    def pending(self) -> list[str]:
        """Labels of the loads without a part, in order. Parts of loads that a replace took away go, with all others."""
        every, done = loads(self.spark, self.lake, self.table), [_load_of(x) for x in self.done()]
        if not set(done) <= set(every):
            self.forget()
            done = []
        new = [x for x in every if x not in done]
        return [f"{seq:08d}_{x}" for seq, x in enumerate(new, len(done))]


def _load_of(label: str) -> str:
    return label.split("_", 1)[1]


class DailyUsers:
    """Daily active users from bitmaps per load."""

    def __init__(self, spark: SparkSession, lake: I.Lake):
        self.parts = Parts(spark, lake, "daily_users", "events", "counts")

    def update(self) -> list[str]:
        """Work through new loads; their ids."""
        new = self.parts.pending()
        for label in new:
            events = S.stg_events(read_load(self.parts.spark, self.parts.lake, "events", _load_of(label)))
            day = F.to_date("event_timestamp").alias("activity_date")
            bits = events.where("user_id is not null").groupBy(day, F.bitmap_bucket_number("user_id").alias("bucket")) \
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users"))
            self.parts.write(bits, "users", label)
            self.parts.write(events.groupBy(day, "event_name").agg(F.count(F.lit(1)).alias("n")), "counts", label)
        return [_load_of(x) for x in new]

    def read(self, counted: Mapping[str, str] = M.DAU_EVENTS) -> DataFrame:
        """The mart of the loads worked through."""
        done = self.parts.done()
        bits = self.parts.read("users", done).groupBy("activity_date", "bucket").agg(F.bitmap_or_agg("users").alias("users"))
        zero, n = F.lit(0).cast("long"), F.col("n")
        active = bits.select("activity_date", F.bitmap_count("users").alias("active_users"), zero.alias("total_events"),
                             *(zero.alias(c) for c in counted))
        other = self.parts.read("counts", done).select(
            "activity_date", zero.alias("active_users"), n.alias("total_events"),
            *(F.when(F.col("event_name") == event, n).otherwise(zero).alias(c) for c, event in counted.items()))
        return active.unionByName(other).groupBy("activity_date") \
            .agg(*(F.sum(c).alias(c) for c in ("active_users", "total_events", *counted)))


class Revenue:
    """The revenue fact from partial sums per load."""

    _KEYS = ("revenue_date", "plan", "country_code", "invoice_status")

    def __init__(self, spark: SparkSession, lake: I.Lake):
        self.parts = Parts(spark, lake, "revenue", "invoices", "unknown")

    def _users(self) -> DataFrame:
        """What the mart takes of the users, as they are."""
        return S.stg_users(I.read_raw(self.parts.spark, self.parts.lake, "users")).select("user_id", "plan", "country_code")

    def _changed(self) -> bool:
        """If a user that a part has counted has other rows now."""
        done = self.parts.done()
        if not done:
            return False
        before = self.parts.read("users", [done[-1]])
        now = self._users().join(before.select("user_id").distinct(), "user_id", "left_semi").select(*before.columns)
        return not (before.exceptAll(now).isEmpty() and now.exceptAll(before).isEmpty())

    @staticmethod
    def _sums() -> list[Column]:
        status, amount = F.col("status"), F.col("amount")
        return [F.count(F.lit(1)).alias("invoice_count"), F.sum("amount").alias("gross_amount"),
                sum_where(amount, status == M.PAID).alias("net_revenue"), sum_where(amount, status == M.REFUNDED).alias("refunded_amount")]

    def update(self) -> list[str]:
        """Work through new loads, or all if a user changed; their ids."""
        if self._changed():
            self.parts.forget()
        new = self.parts.pending()
        for label in new:
            invoices = S.stg_invoices(read_load(self.parts.spark, self.parts.lake, "invoices", _load_of(label)))
            users = self.parts.write(self._users(), "users", label)
            self.parts.write(M.fct_revenue(invoices, users), "known", label)
            unknown = invoices.where("user_id is not null").join(users.select("user_id").distinct(), "user_id", "left_anti")
            by_user = unknown.groupBy("user_id", F.col("issued_at").alias("revenue_date"), F.col("status").alias("invoice_status"))
            self.parts.write(by_user.agg(*self._sums()), "unknown", label)
        return [_load_of(x) for x in new]

    def read(self) -> DataFrame:
        """The mart of the loads worked through."""
        done = self.parts.done()
        known = self.parts.read("known", done)
        late = self.parts.read("unknown", done).join(self._users(), "user_id").select(*known.columns)
        merged = known.union(late).groupBy(*self._KEYS).agg(*(F.sum(c).alias(c) for c in known.columns[len(self._KEYS):]))
        # sums of sums are wider than the sums of the mart
        return merged.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in known.schema))


class Sessions:
    """Numbered events, load by load.

    Kinds of parts: ``users`` (what the load's users carry, and if they are numbered anew),
    ``rows`` (numbered events) and ``carry`` (last event and session number after the load,
    and the first load whose rows of the user count).
    """

    def __init__(self, spark: SparkSession, lake: I.Lake, gap_seconds: int = R.SESSION_GAP_SECONDS):
        self.parts, self.gap = Parts(spark, lake, "sessions", "events", "carry"), gap_seconds

    @staticmethod
    def _place() -> Column:
        """What events of a user are ordered by: untimed ones last, then by id."""
        return F.struct(F.col("event_timestamp").isNull().alias("untimed"), "event_timestamp", F.col("event_id").isNull().alias("unnamed"), "event_id")

    def _carried(self, done: list[str]) -> DataFrame:
        """Each user's last event, session number, and the load from which the user's rows count."""
        newest = F.max_by(F.struct("last", "session_number", "since"), "seq").alias("x")
        return self.parts.read("carry", done).groupBy("user_id").agg(newest) \
            .select("user_id", F.col("x.last").alias("before"), F.col("x.session_number").alias("sessions"), "x.since")

    def update(self) -> list[str]:
        """Work through new loads; their ids."""
        spark, lake, new = self.parts.spark, self.parts.lake, self.parts.pending()
        for label in new:
            done = self.parts.done()
            events = S.stg_events(read_load(spark, lake, "events", _load_of(label)))
            users = events.groupBy("user_id").agg(F.min(self._place()).alias("first"))
            if done:
                users = users.alias("n").join(self._carried(done).alias("c"), F.expr("n.user_id <=> c.user_id"), "left") \
                    .select("n.user_id", "first", "before", "sessions", "since")
            else:
                kinds = {"before": users.schema["first"].dataType, "sessions": "long", "since": "int"}
                users = users.select("*", *(F.lit(None).cast(t).alias(c) for c, t in kinds.items()))
            # others go on: all of their new events come after the last one
            users = users.withColumn("late", F.coalesce(F.col("first") <= F.col("before"), F.lit(False)))
            users = self.parts.write(users, "users", label)
            late = users.where("late").select("user_id")
            rows = self._numbered(_of(events, users.where("not late").select("user_id")), users.where("not late"))
            if not late.isEmpty():
                every = S.stg_events(read_load(spark, lake, "events", *map(_load_of, done), _load_of(label)))
                rows = rows.unionByName(self._number(_of(every, late)))
            rows = self.parts.write(rows, "rows", label)
            seq = F.lit(len(done))
            since = F.when(F.col("late") | F.col("since").isNull(), seq).otherwise(F.col("since")).cast("int")
            last = rows.groupBy("user_id").agg(F.max(self._place()).alias("last"), F.max("session_number").alias("session_number"))
            last = last.alias("l").join(users.alias("n"), F.expr("l.user_id <=> n.user_id")) \
                .select("l.user_id", "last", "session_number", seq.alias("seq"), since.alias("since"))
            self.parts.write(last, "carry", label)
        return [_load_of(x) for x in new]

    def _number(self, events: DataFrame) -> DataFrame:
        return M.user_events_sessionized(events, gap_seconds=self.gap)

    def _numbered(self, events: DataFrame, users: DataFrame) -> DataFrame:
        """Events numbered on from what their users carry."""
        first, before = F.col("first.event_timestamp"), F.col("before.event_timestamp")
        # as in one window: an untimed event before starts a session, an untimed one after a timed one doesn't
        goes_on = before.isNotNull() & ~F.coalesce(gap_exceeds(first, before, self.gap), F.lit(False))
        offsets = users.select("user_id", (F.coalesce("sessions", F.lit(0)) - goes_on.cast("int")).alias("offset"))
        rows = self._number(events)
        return rows.alias("r").join(offsets.alias("o"), F.expr("r.user_id <=> o.user_id")) \
            .select(*(F.col(f"r.{c}") for c in rows.columns[:-1]), (F.col("r.session_number") + F.col("o.offset")).alias("session_number"))

    def read(self) -> DataFrame:
        """All events of the loads worked through, with their session numbers."""
        done = self.parts.done()
        parts = [self.parts.read("rows", [label]).withColumn("seq", F.lit(seq)) for seq, label in enumerate(done)]
        since = self._carried(done).where("since > 0").select("user_id", "since")
        before = F.expr("r.user_id <=> s.user_id and r.seq < s.since")
        return reduce(DataFrame.unionByName, parts).alias("r").join(since.alias("s"), before, "left_anti").drop("seq")


def _of(events: DataFrame, users: DataFrame) -> DataFrame:
    return events.alias("e").join(users.alias("u"), F.expr("e.user_id <=> u.user_id"), "left_semi")
