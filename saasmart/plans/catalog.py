"""Layers and materialization in the Spark catalog.

* A layer is a database (``raw``, ``stg``, ``intermediate``, ``marts`` by
  default; a custom name is used verbatim, trimmed), created with an
  explicit LOCATION under the lake root so repeated runs never collide with
  leftover managed-table folders.
* Raw tables and the load ledger are external parquet tables; every build
  points them at the folders of the lake it is given.
* Staging models and SQL intermediates are persistent SQL views.
* Marts, and intermediates that are no plain SQL view (sessions), are tables with
  versions: each build writes a fresh folder and makes a table over it,
  ``<name>__v<number>``; the name itself is a view of one version, replaced by one
  statement. So a reader finds the old version or the new one at any time, also
  when the columns change, and a failed write leaves the old one in place. The numbers
  are claimed by files that only one writer can create. All but the last
  ``keep_versions`` go; a query that started on a version has that long to finish.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from saasmart import schemas
from saasmart.plans import staging
from saasmart.session import child_folders, children, create_new, remove_folder
from saasmart.streaming.ingest import LEDGER_SCHEMA, Lake, buckets, current_path

LEDGER_TABLE = "_load_ledger"


@dataclass(frozen=True)
class Layers:
    raw: str = schemas.DEFAULT_LAYERS["raw"]
    staging: str = schemas.DEFAULT_LAYERS["staging"]
    intermediate: str = schemas.DEFAULT_LAYERS["intermediate"]
    marts: str = schemas.DEFAULT_LAYERS["marts"]

    @staticmethod
    def named(raw: str | None = None, staging_: str | None = None,
              intermediate: str | None = None, marts: str | None = None) -> Layers:
        d = schemas.DEFAULT_LAYERS
        return Layers(schemas.layer_name(raw, d["raw"]),
                      schemas.layer_name(staging_, d["staging"]),
                      schemas.layer_name(intermediate, d["intermediate"]),
                      schemas.layer_name(marts, d["marts"]))

    @staticmethod
    def suffixed(suffix: str) -> Layers:
        d = schemas.DEFAULT_LAYERS
        return Layers.named(*(f"{d[k]}_{suffix}" for k in ("raw", "staging", "intermediate",
                                                            "marts")))

    def all(self) -> list[str]:
        return [self.raw, self.staging, self.intermediate, self.marts]


def _ddl_columns(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_layers(spark: SparkSession, layers: Layers, warehouse: str) -> None:
    for db in layers.all():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{warehouse}/{db}.db'")


def _location(spark: SparkSession, ident: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {ident}").where("col_name = 'Location'").collect()
    return rows[0].data_type if rows else ""


def _plain(path: str) -> str:
    """A path without what Hadoop adds to it for a local file."""
    return path.removeprefix("file:").replace("//", "/").rstrip("/")


def _columns(schema) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _bucket_count(spark: SparkSession, ident: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {ident}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0].data_type) if rows else 0


def _point_table(spark: SparkSession, layer: str, name: str, schema, path: str, options: str = "", buckets: int = 0) -> DataFrame:
    """Make ``layer.name`` a parquet table with these columns over ``path``, in ``buckets`` by its key if it has one."""
    ident, key = f"`{layer}`.`{name}`", schemas.BUCKET_KEYS.get(name)
    buckets = buckets if key else 0
    if buckets:
        options += f" CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS"
    if table_exists(spark, layer, name):
        if _columns(spark.table(ident).schema) != _columns(schema) or _bucket_count(spark, ident) != buckets:
            spark.sql(f"DROP TABLE {ident}")  # external: its files stay
        elif _plain(_location(spark, ident)) != _plain(path):
            spark.sql(f"ALTER TABLE {ident} SET LOCATION '{path}'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ident} ({_ddl_columns(schema)}) USING parquet {options} LOCATION '{path}'")
    spark.sql(f"REFRESH TABLE {ident}")
    return spark.table(ident)


def register_raw_tables(spark: SparkSession, layers: Layers, lake: Lake) -> None:
    """External tables over the current generation of each raw table, and over the load ledger."""
    files, count = "OPTIONS (recursiveFileLookup 'true')", buckets(spark, lake)
    for table, schema in schemas.RAW_TABLES.items():
        _point_table(spark, layers.raw, table, schemas.nullable(schema), current_path(spark, lake, table), files, count)
    _point_table(spark, layers.raw, LEDGER_TABLE, LEDGER_SCHEMA, lake.ledger, files)


def create_staging_view(spark: SparkSession, layers: Layers, name: str) -> DataFrame:
    spark.sql(f"CREATE OR REPLACE VIEW `{layers.staging}`.`{name}` AS "
              f"{staging.view_sql(name, layers.raw)}")
    return spark.table(f"`{layers.staging}`.`{name}`")


def create_staging_views(spark: SparkSession, layers: Layers) -> dict[str, DataFrame]:
    return {name: create_staging_view(spark, layers, name) for name in staging.STAGING}


def create_sql_view(spark: SparkSession, layer: str, name: str, model: str, **upstream: str) -> DataFrame:
    """A persistent view from a SQL model; ``{name}`` placeholders stand for tables by their full names."""
    spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{name}` AS {model.format(**upstream)}")
    return spark.table(f"`{layer}`.`{name}`")


def table_exists(spark: SparkSession, layer: str, name: str) -> bool:
    return spark.catalog.tableExists(f"`{layer}`.`{name}`")


def _versions(spark: SparkSession, layer: str, name: str) -> list[int]:
    """Numbers of a table's versions in the catalog."""
    if not spark.catalog.databaseExists(layer):
        return []
    prefix = f"{name}__v".lower()
    found = [t.name.lower() for t in spark.catalog.listTables(layer, f"{name}__v*")]
    return sorted(int(t.removeprefix(prefix)) for t in found if t.startswith(prefix) and t.removeprefix(prefix).isdigit())


def _claim_version(spark: SparkSession, layer: str, name: str, warehouse: str) -> int:
    """A number above all that were claimed or written; no two writers get the same."""
    claims = f"{warehouse}/{layer}.db/_claims/{name}"
    number = max([*_versions(spark, layer, name), *(int(n) for n, _ in children(spark, f"{claims}/*"))], default=0) + 1
    while not create_new(spark, f"{claims}/{number}"):
        number += 1
    return number


def _is_table(spark: SparkSession, layer: str, name: str) -> bool:
    """If the name is a table of its own, not a view of versions."""
    return table_exists(spark, layer, name) and spark.catalog.getTable(f"`{layer}`.`{name}`").tableType != "VIEW"


def materialize_table(df: DataFrame, layer: str, name: str, warehouse: str, keep_versions: int = 2) -> DataFrame:
    """Write a new version, then show it under the table's name; all but the last versions go."""
    spark = df.sparkSession
    folder = f"{warehouse}/{layer}.db/{name}"
    number = _claim_version(spark, layer, name, warehouse)
    path = f"{folder}/v{number}"
    df.write.mode("errorifexists").parquet(path)
    version, schema = f"{name}__v{number}", schemas.nullable(df.schema)
    spark.sql(f"CREATE TABLE `{layer}`.`{version}` ({_ddl_columns(schema)}) USING parquet LOCATION '{path}'")
    if _is_table(spark, layer, name):  # of a lake built before names were views
        spark.sql(f"DROP TABLE `{layer}`.`{name}`")
    if number == _versions(spark, layer, name)[-1]:  # a build that began later may have ended sooner
        columns = ", ".join(f"`{c}`" for c in schema.fieldNames())
        spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{name}` AS SELECT {columns} FROM `{layer}`.`{version}`")
    _keep(spark, layer, name, folder, number, keep_versions)
    return spark.table(f"`{layer}`.`{name}`")


def _keep(spark: SparkSession, layer: str, name: str, folder: str, current: int, keep_versions: int) -> None:
    """Drop the versions below the current one but for the last; folders that have no table go with them."""
    kept = [n for n in _versions(spark, layer, name) if n <= current][-max(1, keep_versions):]
    for number in _versions(spark, layer, name):
        if number < kept[0]:
            spark.sql(f"DROP TABLE IF EXISTS `{layer}`.`{name}__v{number}`")
    for old in child_folders(spark, folder):
        label = old.rsplit("/", 1)[-1]
        number = int(label[1:]) if label[1:].isdigit() else -1
        if number < kept[0]:
            remove_folder(spark, old)


def drop_table(spark: SparkSession, layer: str, name: str, warehouse: str | None = None) -> None:
    """Drop the table and its versions if they exist; with ``warehouse``, their folders as well."""
    kind = "TABLE" if _is_table(spark, layer, name) else "VIEW"
    spark.sql(f"DROP {kind} IF EXISTS `{layer}`.`{name}`")
    for number in _versions(spark, layer, name):
        spark.sql(f"DROP TABLE IF EXISTS `{layer}`.`{name}__v{number}`")
    if warehouse is not None:
        remove_folder(spark, f"{warehouse}/{layer}.db/{name}")
