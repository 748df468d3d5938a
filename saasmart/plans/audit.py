"""Row-count audit and load-history queries."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every table: one global count per table.

    Each count is a partial count per task plus a one-row merge, so the
    audit costs one scan of each table and moves one number per task.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def recorded_counts(ledger: DataFrame, generations: Mapping[str, str]) -> DataFrame:
    """(table_name, row_count) for every table from the load ledger alone: no table is read.

    ``generations``: the current generation of each table, whose rows count beside what was appended.
    """
    spark = ledger.sparkSession
    current = spark.createDataFrame(sorted(generations.items()), "table_name string, current string")
    counted = ledger.join(F.broadcast(current), "table_name") \
        .where("load_mode = 'append' or load_id = current").groupBy("table_name").agg(F.sum("rows_loaded").alias("n"))
    return current.join(counted, "table_name", "left").select("table_name", F.coalesce("n", F.lit(0)).cast("long").alias("row_count"))


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """Rows loaded per (table, load mode) over the whole load history."""
    return ledger.groupBy("table_name", "load_mode").agg(
        F.sum("rows_loaded").cast("long").alias("rows_loaded"))
