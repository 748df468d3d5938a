"""Session construction and shared working folders.

On a cluster the session is built by the deployment; library code never
creates one.  ``local_session`` is for tests, the bench and local runs.

Every folder this library writes to (landing zones, raw tables, streaming
checkpoints, marts) lives under the shared folder the cluster names in
``spark.checkpoint.dir``.  Only a local session that names none (tests) gets
one of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


_LOCAL_ROOTS: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "saasmart") -> SparkSession:
    """A local session with the settings the tests and the bench rely on."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder: the value of ``spark.checkpoint.dir`` itself.

    The same in every application of a cluster, so that one step finds what
    another left. Only a local session may leave it unset; it then gets a folder
    of its own, for the life of the session.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share, or name a root")
        configured = _LOCAL_ROOTS.get(sc.applicationId)
        if configured is None:
            configured = _LOCAL_ROOTS[sc.applicationId] = tempfile.mkdtemp(prefix="saasmart-")
    return configured.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared root."""
    return f"{shared_root(spark)}/saasmart/{name}-{uuid.uuid4().hex[:12]}"


def _filesystem(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Driver-side existence check through the path's Hadoop filesystem."""
    fs, hpath = _filesystem(spark, path)
    return bool(fs.exists(hpath))


def glob_exists(spark: SparkSession, pattern: str) -> bool:
    """If any path matches a glob."""
    fs, hpath = _filesystem(spark, pattern)
    found = fs.globStatus(hpath)
    return found is not None and len(found) > 0


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders right below ``path``, oldest first."""
    fs, hpath = _filesystem(spark, path)
    if not fs.exists(hpath):
        return []
    found = [(s.getModificationTime(), s.getPath().toString()) for s in fs.listStatus(hpath) if s.isDirectory()]
    return [p for _, p in sorted(found)]


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, hpath = _filesystem(spark, source)
    if not fs.rename(hpath, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, hpath = _filesystem(spark, path)
    fs.delete(hpath, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hpath = _filesystem(spark, path)
    fs.mkdirs(hpath)


def children(spark: SparkSession, pattern: str) -> list[tuple[str, bool]]:
    """(name, if it is a folder) of the paths that match a glob, by name."""
    fs, hpath = _filesystem(spark, pattern)
    return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.globStatus(hpath) or [])


def files_of(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path below ``path``, bytes) of its data files by name; of a plain file itself, with no path below."""
    fs, hpath = _filesystem(spark, path)
    base = fs.getFileStatus(hpath).getPath().toString()
    found, listed = [], fs.listFiles(hpath, True)
    while listed.hasNext():
        status = listed.next()
        below = status.getPath().toString()[len(base):]
        if not any(part.startswith(("_", ".")) for part in below.split("/")):
            found.append((below, status.getLen()))
    return sorted(found)


def footer_rows(spark: SparkSession, path: str) -> int:
    """Rows of one Parquet file, from its footer."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        return int(reader.getRecordCount())
    finally:
        reader.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    fs, hpath = _filesystem(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file if there is none; if this call made it."""
    fs, hpath = _filesystem(spark, path)
    fs.mkdirs(hpath.getParent())
    try:
        fs.create(hpath, False).close()
    except Py4JJavaError:
        if fs.exists(hpath):
            return False
        raise
    return True


def write_whole(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears with all its text or not at all; an existing one is never overwritten."""
    fs, hpath = _filesystem(spark, path)
    hidden = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(hpath.getParent(), f"_{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(hpath) or not fs.rename(hidden, hpath):
        fs.delete(hidden, False)
        raise FileExistsError(path)
