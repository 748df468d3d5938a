"""Landing zone -> raw layer.

* ``replace_load``: users are read whole into a new generation of the raw table.
* ``append_incremental``: each activity table is a stream of batches drained with
  ``trigger(availableNow=True)``; the stream checkpoint (one per table, so cursors are
  independent) remembers what was loaded, so a rerun loads only new batches.
* ``append_by_mtime``: the batch form with a modification-time cursor, file by file,
  kept in the load ledger.

Batches of an open table (``sources.landing``) count from their manifest on: the stream
reads manifests, which name the files to load, and the mtime cursor takes the files of
batches that are all there with the sizes that the manifest states. Other tables are read
file by file, each as it appears.

Layout: ``<raw>/<table>/<generation>/load_<id>/``. A replace writes a new
generation and then its ledger rows; the ledger names the current generation,
so readers have the old rows until the new ones are complete, and a failed
write changes nothing. Generations are numbered, each number claimed by a file that only
one writer can create; the highest one in the ledger is the current one, whatever a
driver's clock says. An append writes its load folder in the current
generation, then its ledger rows, both with mode overwrite. A load's id follows from what
is in it (the stream's batch number, or the files with their times), and a folder that
an earlier run left without ledger rows goes before the next load is written: so a load that is
repeated after a failure gives its rows once, also if more files have come since. One
ingest per table runs at a time.

The ledger has one row per file loaded (table, load, batch, file, rows); no file is loaded
twice in a state that it has been loaded in.

Cursor differences, stated once:

=====================================  =======================  ==================
situation                              stream (default)         mtime cursor
=====================================  =======================  ==================
cursor                                 set of manifests         newest mtime, and the
                                       (paths if not open)      files with their times
same path rewritten / touched later    not loaded again         loaded again
late batch carrying an older mtime     loaded                   skipped
new batch with the newest mtime        loaded                   loaded
batch without its manifest             not seen                 not seen
file added to a batch that is loaded   not seen                 the new file is loaded,
                                                                once its manifest has it
                                                                (not open: at once)
rerun with nothing new                 nothing loaded           nothing loaded
=====================================  =======================  ==================

Appends keep duplicates (ids can repeat across batches); no dedupe.

A lake may keep users, invoices and tickets in buckets by user (``set_buckets``, before its
first load). Each load is then dealt by user once, at ingest, into one file per bucket of its
folder; the catalog's tables state the buckets, so that sums by user and joins on it read them
side by side without an exchange, however many loads there are. One task reads a bucket, so
a lake where one user holds a large share of all rows is better left without: partial
sums and AQE then spread that user.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from saasmart import schemas
from saasmart.session import (child_folders, children, create_new, glob_exists, path_exists, read_text, remove_folder, scratch_dir,
                              write_whole)
from saasmart.sources import landing as L

LEDGER_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("load_mode", T.StringType()),
    T.StructField("load_id", T.StringType()),
    T.StructField("batch", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("file_mtime", T.TimestampType()),
    T.StructField("loaded_at", T.TimestampType()),
])

FIRST_GENERATION = "g0"
#: Generations of a replaced raw table that are kept: the current one and the one before.
KEEP_GENERATIONS = 2
#: Ledger folders of a table beyond which ingest writes them anew as one.
COMPACT_AT = 64

_FILE, _MTIME = "_source_file", "_file_mtime"


@dataclass(frozen=True)
class Lake:
    """Folder layout of one lakehouse under a shared root."""

    root: str

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def checkpoints(self) -> str:
        return f"{self.root}/checkpoints"

    @property
    def warehouse(self) -> str:
        return f"{self.root}/warehouse"

    @property
    def claims(self) -> str:
        return f"{self.root}/claims"

    def raw_path(self, table: str, generation: str = FIRST_GENERATION) -> str:
        return f"{self.raw}/{table}/{generation}"

    @staticmethod
    def fresh(spark: SparkSession, name: str = "lake") -> Lake:
        return Lake(scratch_dir(spark, name))


def _with_source(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*schema.fieldNames(), F.col("_metadata.file_path").alias(_FILE),
                     F.col("_metadata.file_modification_time").alias(_MTIME))


def _plain(path: Column) -> Column:
    """A path without percent signs for odd characters."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _batch_of(path: str) -> Column:
    """The batch that a file belongs to: its landing folder or file name."""
    return _plain(F.regexp_extract(path, r"/((?:batch_|users)[^/]*\.parquet)", 1))


def _relative(path: str) -> Column:
    """A data file's path below its table's landing folder."""
    return _plain(F.regexp_extract(path, r"/((?:batch_|users)[^/]*\.parquet(?:/.+)?)$", 1))


def set_buckets(spark: SparkSession, lake: Lake, count: int) -> None:
    """Keep the tables of ``schemas.BUCKET_KEYS`` in so many buckets; for a lake without loads, once and for all."""
    if path_exists(spark, lake.raw):
        raise ValueError(f"{lake.root} has loads that are not in {count} buckets")
    write_whole(spark, f"{lake.root}/buckets", str(count))


def buckets(spark: SparkSession, lake: Lake) -> int:
    """Buckets by user of the lake's tables; 0: none."""
    return int(read_text(spark, f"{lake.root}/buckets") or 0)


def _write_rows(df: DataFrame, path: str, lake: Lake, table: str) -> None:
    """Write a load's rows, by bucket if the lake has buckets; what an earlier try left there goes."""
    spark, count = df.sparkSession, buckets(df.sparkSession, lake)
    if not count or table not in schemas.BUCKET_KEYS:
        df.write.mode("overwrite").parquet(path)
        return
    key, name = schemas.BUCKET_KEYS[table], f"_load_{uuid.uuid4().hex}"
    # only a table's writer names files by bucket; the table is external, so that they stay when it goes
    # rebalance deals by bucket, and splits the share of a hot user over several tasks (files of one bucket)
    df.hint("rebalance", count, key).write.bucketBy(count, key).mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")


def _load(df: DataFrame, path: str, lake: Lake, table: str, mode: str, load_id: str) -> int:
    """Write the rows, then one ledger row per source file; rows in all."""
    _write_rows(df.drop(_FILE, _MTIME), path, lake, table)
    files = (df.groupBy(_FILE, _MTIME).agg(F.count(F.lit(1)).alias("rows_loaded"))
             .select(F.lit(table).alias("table_name"), F.lit(mode).alias("load_mode"), F.lit(load_id).alias("load_id"),
                     _batch_of(_FILE).alias("batch"), F.col(_FILE).alias("file"), "rows_loaded",
                     F.col(_MTIME).alias("file_mtime"), F.lit(dt.datetime.now(dt.timezone.utc)).alias("loaded_at")))
    folder = f"{lake.ledger}/{table}/{load_id}"
    files.coalesce(1).write.mode("overwrite").parquet(folder)
    written = df.sparkSession.read.schema(LEDGER_SCHEMA).parquet(folder)
    return int(written.agg(F.coalesce(F.sum("rows_loaded"), F.lit(0))).first()[0])


def read_ledger(spark: SparkSession, lake: Lake, table: str | None = None) -> DataFrame:
    """One row per file loaded; a compaction cut short leaves repeats, which count once."""
    path = f"{lake.ledger}/{table}" if table else lake.ledger
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return (spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
            .dropDuplicates(["table_name", "load_id", "file"]))


def compact_ledger(spark: SparkSession, lake: Lake, table: str, at: int = COMPACT_AT) -> bool:
    """Write a table's ledger anew as one folder if it has over ``at`` folders."""
    folders = child_folders(spark, f"{lake.ledger}/{table}")
    if len(folders) <= at:
        return False
    read_ledger(spark, lake, table).coalesce(1).write.parquet(f"{lake.ledger}/{table}/compact-{uuid.uuid4().hex}")
    for folder in folders:
        remove_folder(spark, folder)
    return True


def _number(generation_id: str) -> int:
    """The claimed number of a generation; 0 for one that was named otherwise."""
    found = re.fullmatch("[a-z]+([0-9]+)", generation_id)
    return int(found.group(1)) if found else 0


def generation(spark: SparkSession, lake: Lake, table: str) -> str:
    """The highest generation that a complete replace wrote."""
    number = F.regexp_extract("load_id", "^[a-z]+([0-9]+)$", 1).try_cast("long")
    last = (read_ledger(spark, lake, table).where("load_mode = 'replace'")
            .agg(F.max(F.struct(F.coalesce(number, F.lit(0)).alias("number"), "loaded_at", "load_id")).alias("last")).first().last)
    return last.load_id if last else FIRST_GENERATION


def _claim(spark: SparkSession, lake: Lake, table: str) -> int:
    """A generation number above all that were claimed or written; no two writers get the same."""
    claimed = [int(name) for name, _ in children(spark, f"{lake.claims}/{table}/*")]
    number = max([*claimed, _number(generation(spark, lake, table))]) + 1
    while not create_new(spark, f"{lake.claims}/{table}/{number:010d}"):
        number += 1
    return number


def current_path(spark: SparkSession, lake: Lake, table: str) -> str:
    return lake.raw_path(table, generation(spark, lake, table))


def read_raw(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """The raw table: every load folder of its current generation."""
    return (spark.read.schema(schemas.nullable(schemas.RAW_TABLES[table]))
            .option("recursiveFileLookup", "true").parquet(current_path(spark, lake, table)))


def _replace(df: DataFrame, lake: Lake, table: str, prefix: str) -> int:
    """A new generation of a raw table; older ones than the one before go."""
    spark = df.sparkSession
    load_id = f"{prefix}{_claim(spark, lake, table):010d}"
    rows = _load(df, f"{lake.raw_path(table, load_id)}/load_{load_id}", lake, table, "replace", load_id)
    now = _number(generation(spark, lake, table))
    older = sorted((n, path) for path in child_folders(spark, f"{lake.raw}/{table}")
                   if (n := _number(path.rsplit("/", 1)[-1])) < now)
    for _, old in older[:len(older) - KEEP_GENERATIONS + 1]:
        remove_folder(spark, old)
    return rows


def replace_load(spark: SparkSession, lake: Lake, table: str = "users") -> int:
    """Read ``<landing>/users/*.parquet`` whole into a new generation of the raw table.

    The glob is flat: a file, or a folder of part files, right below ``users/``.
    """
    schema = schemas.nullable(schemas.RAW_TABLES[table])
    src = spark.read.schema(schema).parquet(f"{lake.landing}/{L.USERS_DIR}/*.parquet")
    return _replace(_with_source(src, schema), lake, table, "r")


# Upper bound on files per micro-batch: a large backlog drains as several
# bounded batches instead of one huge one.
MAX_FILES_PER_TRIGGER = 1000
# A file is new by its path, however old: the file source's age limit is set
# beyond any real age.
MAX_FILE_AGE = "36500d"


def _sweep(spark: SparkSession, folder: str, known: set[str]) -> None:
    """Remove load folders that the ledger doesn't have: a run that failed between the two left them."""
    for path in child_folders(spark, folder):
        name = path.rsplit("/", 1)[-1]
        if name.startswith("load_") and name.removeprefix("load_") not in known:
            remove_folder(spark, path)


def _load_ids(ledger: DataFrame) -> set[str]:
    return {r.load_id for r in ledger.select("load_id").distinct().collect()}


def _read_files(spark: SparkSession, table: str, paths: list[str]) -> DataFrame:
    schema = schemas.nullable(schemas.RAW_TABLES[table])
    return _with_source(spark.read.schema(schema).parquet(*paths), schema)


def _start(stream: DataFrame, sink, checkpoint: str, table: str) -> StreamingQuery:
    return (stream.writeStream.foreachBatch(sink)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .queryName(f"ingest_{table}_{uuid.uuid4().hex[:8]}")
            .start())


def start_incremental(spark: SparkSession, lake: Lake, table: str,
                      max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> StreamingQuery | None:
    """Start draining the new batches of one table; None before the first batch."""
    is_open = L.is_open(spark, lake.landing, table)
    if is_open:
        L.adopt_files(spark, lake.landing, table)
    pattern = (L.manifest_glob if is_open else L.batch_glob)(lake.landing, table)
    if not glob_exists(spark, pattern):
        return None
    schema = schemas.nullable(schemas.RAW_TABLES[table])
    folder = current_path(spark, lake, table)
    ledger = read_ledger(spark, lake, table)
    _sweep(spark, folder, _load_ids(ledger))
    reader = spark.readStream.option("maxFilesPerTrigger", str(max_files_per_trigger)).option("maxFileAge", MAX_FILE_AGE)

    def load_files(batch: DataFrame, batch_id: int) -> None:
        load_id = f"s{batch_id:010d}"
        _load(batch, f"{folder}/load_{load_id}", lake, table, "append", load_id)

    def load_manifests(batch: DataFrame, batch_id: int) -> None:
        load_id = f"c{batch_id:010d}"
        half = batch.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.max("files").alias("files")).where("n <> files").first()
        if half is not None:
            raise ValueError(f"{table}: the manifest of {half.batch} is incomplete")
        before = read_ledger(spark, lake, table).where(F.col("load_id") != load_id).select(_relative("file").alias("file"))
        new = batch.join(before, "file", "left_anti").select("file", "rows").collect()  # names that the scan lists in any case
        if not new:
            return
        df = _read_files(spark, table, [f"{L.table_dir(lake.landing, table)}/{r.file}" for r in new])
        stated, here = sum(r.rows for r in new), df.count()  # from footers
        if stated != here:
            raise ValueError(f"{table}: manifests state {stated} rows, the files have {here}")
        _load(df, f"{folder}/load_{load_id}", lake, table, "append", load_id)

    if is_open:
        return _start(reader.schema(L.MANIFEST_SCHEMA).json(pattern), load_manifests, f"{lake.checkpoints}/{table}-manifests", table)
    return _start(_with_source(reader.schema(schema).parquet(pattern), schema), load_files, f"{lake.checkpoints}/{table}", table)


def append_incremental(spark: SparkSession, lake: Lake, table: str,
                       max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> None:
    """Drain new files of one table and wait until they are loaded."""
    query = start_incremental(spark, lake, table, max_files_per_trigger)
    if query is not None:
        query.awaitTermination()
        compact_ledger(spark, lake, table)


def _landed(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """(batch, file, file_mtime): files of batches that count; nothing is read but names, times and sizes."""
    listed = spark.read.format("binaryFile").load(L.batch_glob(lake.landing, table)) \
        .select(_batch_of("_metadata.file_path").alias("batch"), F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_modification_time").alias("file_mtime"), F.col("_metadata.file_size").alias("bytes"))
    if not L.is_open(spark, lake.landing, table):
        return listed.select("batch", "file", "file_mtime")
    stated = spark.read.schema(L.MANIFEST_SCHEMA).json(L.manifest_glob(lake.landing, table)) \
        .select("batch", "files", F.col("file").alias("relative"), "bytes")
    here = listed.withColumn("relative", _relative("file")).join(stated, ["batch", "relative", "bytes"])
    whole = here.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.max("files").alias("files")).where("n = files")
    return here.join(whole.select("batch"), "batch").select("batch", "file", "file_mtime")


def append_by_mtime(spark: SparkSession, lake: Lake, table: str) -> int:
    """Batch form: load files that aren't loaded, of batches as new as the newest file that is.

    A batch's time is that of its newest file. A file counts as loaded if the ledger has
    it with the time that it has now. Only the names of the new files come to the driver,
    which lists them to read them in any case.
    """
    if L.is_open(spark, lake.landing, table):
        L.adopt_files(spark, lake.landing, table)
        if not glob_exists(spark, L.manifest_glob(lake.landing, table)):
            return 0
    if not glob_exists(spark, L.batch_glob(lake.landing, table)):
        return 0
    ledger = read_ledger(spark, lake, table)
    appended = ledger.where("load_mode = 'append'")
    cursor = appended.agg(F.max("file_mtime").alias("cursor")).first().cursor
    landed = _landed(spark, lake, table)
    if cursor is not None:
        recent = landed.groupBy("batch").agg(F.max("file_mtime").alias("newest")).where(F.col("newest") >= F.lit(cursor))
        landed = landed.join(recent.select("batch"), "batch")
    landed = landed.join(appended, ["file", "file_mtime"], "left_anti").select(_relative("file").alias("file"), "file_mtime")
    new = sorted((r.file, r.file_mtime) for r in landed.collect())
    if not new:
        return 0
    src = _read_files(spark, table, [f"{L.table_dir(lake.landing, table)}/{file}" for file, _ in new])
    load_id = "m" + hashlib.sha256("\n".join(f"{file} {when:%Y%m%dT%H%M%S%f}" for file, when in new).encode()).hexdigest()[:32]
    known = _load_ids(ledger)
    folder = current_path(spark, lake, table)
    _sweep(spark, folder, known)
    rows = _load(src, f"{folder}/load_{load_id}", lake, table, "append", load_id)
    compact_ledger(spark, lake, table)
    return rows


def bootstrap_raw(spark: SparkSession, lake: Lake, seed: int = 0,
                  n_users: int | None = None) -> dict[str, int]:
    """Write the four generated tables straight into the raw layer (create or replace).

    No landing zone is involved: each raw table becomes a new generation of one
    batch of seed ``seed`` (users by the fixed user rules). Refuses a lake whose
    activity was appended: its cursors say that those batches are loaded.
    """
    from saasmart.sources import synth

    for table in schemas.ACTIVITY_TABLES:
        if not read_ledger(spark, lake, table).where("load_mode = 'append'").isEmpty():
            raise ValueError(f"{table} has appended batches; bootstrap a new lake")
    tables = {
        "users": synth.users(spark) if n_users is None else synth.users(spark, n_users),
        **{t: gen(spark, [seed]).drop("batch") for t, gen in synth.GENERATORS.items()},
    }
    made = F.lit(f"generated:{seed}"), F.lit(None).cast("timestamp")
    return {table: _replace(df.withColumns({_FILE: made[0], _MTIME: made[1]}), lake, table, "b")
            for table, df in tables.items()}


def ingest_all(spark: SparkSession, lake: Lake) -> None:
    """Users by replace; every activity table by its own cursor, drained concurrently."""
    queries = [start_incremental(spark, lake, t) for t in schemas.ACTIVITY_TABLES]
    try:
        replace_load(spark, lake, "users")
    finally:
        for q in queries:
            if q is not None:
                q.awaitTermination()
    for t in schemas.RAW_TABLES:
        compact_ledger(spark, lake, t)
