"""Landing zone layout, writers and the commit of a batch.

::

    <landing>/users/users.parquet/                 users, replaced whole
    <landing>/<table>/batch_<tag>.parquet/         one folder per activity batch
    <landing>/_manifests/<table>/batch_<tag>.json  its manifest, written last

Spark names its own part files, so each batch is a folder named like the
single file the layout calls for; readers match it with the path glob
``<table>/batch_*.parquet`` (a glob on the folder, which also matches plain
files of that name). The root may be any Hadoop filesystem URI.

A folder of part files doesn't appear at once, least of all where a rename copies file
by file. So a batch counts from its manifest on: one line of JSON per file (batch,
number of files, file, bytes, rows from the footer). It is one small file and
appears whole. A table with a folder of manifests is *open*: the writers here open it before
their first byte, and readers then take only batches with a manifest. Data without one is
a landing cut short; landing the same tag again replaces it.

Others may land as well. A plain file ``batch_*.parquet`` is whole as it is and gets its
manifest by ``adopt_files``; a folder of an open table needs ``commit_batch``. A table
that was never opened has no manifests, and readers go file by file. Opening it
commits what is there.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from saasmart.session import children, files_of, footer_rows, make_folder, path_exists, remove_folder, rename, write_whole
from saasmart.sources import synth

USERS_DIR = "users"
USERS_FILE = "users.parquet"
BATCH_GLOB = "batch_*.parquet"
MANIFESTS = "_manifests"
MANIFEST_SCHEMA = "batch string, files int, file string, bytes long, rows long"
#: Driver threads for the file system calls of landing: a rename, a listing and footers per batch.
THREADS = 32


def users_path(landing: str) -> str:
    return f"{landing}/{USERS_DIR}/{USERS_FILE}"


def table_dir(landing: str, table: str) -> str:
    return f"{landing}/{table}"


def batch_glob(landing: str, table: str) -> str:
    return f"{table_dir(landing, table)}/{BATCH_GLOB}"


def batch_tag(n: int, now: dt.datetime | None = None) -> str:
    """UTC time of the run plus a 4-digit batch counter."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return f"{now:%Y-%m-%dT%H-%M-%S}_{n:04d}"


def write_users(users: DataFrame, landing: str) -> str:
    """Overwrite the users export (the table is small and replaced whole)."""
    path = users_path(landing)
    users.write.mode("overwrite").parquet(path)
    return path


def manifest_dir(landing: str, table: str) -> str:
    return f"{landing}/{MANIFESTS}/{table}"


def manifest_glob(landing: str, table: str) -> str:
    return f"{manifest_dir(landing, table)}/batch_*.json"


def is_open(spark: SparkSession, landing: str, table: str) -> bool:
    """If batches of this table count from their manifests on."""
    return path_exists(spark, manifest_dir(landing, table))


def open_table(spark: SparkSession, landing: str, table: str) -> None:
    """From now on only batches with a manifest count; those that are here get one."""
    if not is_open(spark, landing, table):
        here = [name for name, _ in children(spark, batch_glob(landing, table))]
        make_folder(spark, manifest_dir(landing, table))
        _each(lambda name: _commit(spark, landing, table, name), here)


def _each(work, items: Sequence) -> list:
    with ThreadPoolExecutor(max_workers=THREADS) as pool:
        return list(pool.map(work, items))


def _manifest_path(landing: str, table: str, name: str) -> str:
    return f"{manifest_dir(landing, table)}/{name.removesuffix('.parquet')}.json"


def _commit(spark: SparkSession, landing: str, table: str, name: str) -> None:
    """Write a batch's manifest, from its files as they are now."""
    path = f"{table_dir(landing, table)}/{name}"
    files = files_of(spark, path)
    rows = _each(lambda f: footer_rows(spark, f"{path}{f[0]}"), files)
    lines = [json.dumps({"batch": name, "files": len(files), "file": f"{name}{below}", "bytes": size, "rows": n})
             for (below, size), n in zip(files, rows)]
    write_whole(spark, _manifest_path(landing, table, name), "\n".join(lines))


def commit_batch(spark: SparkSession, landing: str, table: str, tag: str) -> None:
    """Make a batch that another tool landed count; its files must be complete."""
    open_table(spark, landing, table)
    name = f"batch_{tag}.parquet"
    if not path_exists(spark, _manifest_path(landing, table, name)):
        _commit(spark, landing, table, name)


def adopt_files(spark: SparkSession, landing: str, table: str) -> None:
    """Commit the plain files of an open table that have no manifest: a file is whole by being there."""
    done = {name.removesuffix(".json") for name, _ in children(spark, manifest_glob(landing, table))}
    plain = [name for name, folder in children(spark, batch_glob(landing, table)) if not folder and name.removesuffix(".parquet") not in done]
    _each(lambda name: _commit(spark, landing, table, name), plain)


def _clear(spark: SparkSession, landing: str, table: str, name: str) -> str:
    """The folder of a new batch; what an earlier try left without a manifest goes."""
    path = f"{table_dir(landing, table)}/{name}"
    if path_exists(spark, _manifest_path(landing, table, name)):
        raise FileExistsError(path)
    if path_exists(spark, path):
        remove_folder(spark, path)
    return path


def write_batch(df: DataFrame, landing: str, table: str, tag: str) -> str:
    """Add one batch folder and commit it; a committed batch is never overwritten."""
    spark = df.sparkSession
    open_table(spark, landing, table)
    path = _clear(spark, landing, table, f"batch_{tag}.parquet")
    df.write.mode("errorifexists").parquet(path)
    _commit(spark, landing, table, f"batch_{tag}.parquet")
    return path


def land_batches(df: DataFrame, landing: str, table: str, tags: Sequence[str], batch: str = "batch") -> list[str]:
    """Add one folder per batch number 0..n-1 in column ``batch``, all in one job.

    The job writes below a hidden folder. The batches are then moved and committed side by
    side; each counts from its manifest on, so a store where a move isn't atomic will do.
    """
    spark = df.sparkSession
    open_table(spark, landing, table)
    staged = f"{table_dir(landing, table)}/_staged_{uuid.uuid4().hex}"
    df.write.partitionBy(batch).parquet(staged)

    def move(item: tuple[int, str]) -> str | None:
        n, tag = item
        source = f"{staged}/{batch}={n}"
        target = _clear(spark, landing, table, f"batch_{tag}.parquet")
        if not path_exists(spark, source):
            return None
        rename(spark, source, target)
        _commit(spark, landing, table, f"batch_{tag}.parquet")
        return target

    paths = [path for path in _each(move, list(enumerate(tags))) if path is not None]
    remove_folder(spark, staged)
    return paths


def land_synthetic(spark: SparkSession, landing: str, seeds: Sequence[int], n_users: int | None = None) -> list[str]:
    """Users plus one batch per seed of every activity table: one job per table."""
    write_users(synth.users(spark) if n_users is None else synth.users(spark, n_users), landing)
    now = dt.datetime.now(dt.timezone.utc)
    tags = [batch_tag(n, now) for n in range(len(seeds))]
    with ThreadPoolExecutor(max_workers=len(synth.GENERATORS)) as pool:
        list(pool.map(lambda x: land_batches(x[1](spark, seeds), landing, x[0], tags), synth.GENERATORS.items()))
    return tags
