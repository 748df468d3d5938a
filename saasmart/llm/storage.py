"""Cutting lineage with tables in the cluster's shared folder.

Lost executors can then never force an iterative job back to its start, and no
step depends on blocks that only one executor holds.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from ..session import remove_folder

_KEPT = "llm"
_folder = ContextVar("folder", default=_KEPT)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session (tests) may leave it unset; it then gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="saasmart-llm-")
        spark.sparkContext.setCheckpointDir(named)
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def write(df: DataFrame, name: str, folder: str = _KEPT) -> str:
    """Write ``df`` as Parquet to a new folder under the shared folder; its path."""
    path = f"{shared_folder(df.sparkSession)}/{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back."""
    return df.sparkSession.read.schema(df.schema).parquet(write(df, name, _folder.get()))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What ``cut`` writes inside this block is deleted at its end; what ``write`` writes stays.

    Results that read those tables must be written or collected inside the block.
    """
    own = f"{_KEPT}/scratch-{uuid.uuid4().hex}"
    before = _folder.set(own)
    try:
        yield
    finally:
        _folder.reset(before)
        remove_folder(spark, f"{shared_folder(spark)}/{own}")


def free_name(df_columns: list[str], wanted: str) -> str:
    """``wanted``, lengthened until no column (in any case) has that name."""
    taken = {c.lower() for c in df_columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def moderate_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of fewer rows than Spark's default, as a row here is a whole text.

    A session that names a size of its own keeps it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))
