"""Stored tables: schemas, atomic snapshot overwrites, scans by name.

A table is an external table whose location is one version of its dataset (see ``versions``). Replacing it writes the next
version aside, commits that, points the catalog at it and then removes the old one. Whoever dies on the way leaves a whole
table behind: before the commit the old one, after it the new one, which ``read_table`` and the next overwrite
put into the catalog if the switch did not come about.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sluiceworks.operators.expectations import Expectation, Watch, metrics_frame, require_met
from sluiceworks.session import workspace
from sluiceworks.sources.files import Files
from sluiceworks.sources.versions import Commit, Version, commits, latest, sweep


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def drop_schema(spark: SparkSession, name: str) -> None:
    """Removes a schema, its tables and all their versions."""
    folder = _location(spark, name)
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
    Files(spark, folder).remove("")


def _location(spark: SparkSession, schema: str) -> str:
    return spark.catalog.getDatabase(schema).locationUri.rstrip("/")


def dataset_folder(spark: SparkSession, schema: str, dataset: str) -> str:
    return f"{_location(spark, schema)}/{dataset}"


def overwrite(df: DataFrame, table: str, expectations: Sequence[Expectation] = (), keep: int = 1) -> DataFrame:
    """Replaces the whole table, schema included, and returns it as stored.

    Running it again with the same rows leaves the same table; ``df`` may read the table it replaces. An expectation
    that fails leaves the old version. ``keep`` versions stay for readers that are still at work.
    """
    spark, (schema, name) = df.sparkSession, table.split(".")
    version = Version(spark, dataset_folder(spark, schema, name))
    watch = Watch(df, expectations)
    try:
        watch.rows.write.parquet(version.path)
        metrics = watch.metrics()
        require_met(table, metrics)
    except Exception:
        version.discard()
        raise
    for m in metrics:
        if m["action"] == "warn" and m["failed"]:
            warnings.warn(f"{table}: {m['failed']} rows miss {m['expectation']}", stacklevel=2)
    publish(spark, schema, version, {name: ("", df.schema)}, metrics, keep)
    return spark.table(table)


def publish(
    spark: SparkSession, schema: str, version: Version, tables: Mapping[str, tuple[str, StructType]],
    metrics: Sequence[dict] = (), keep: int = 1,
) -> Commit:
    """Commits a written version and shows it as ``tables``: name -> (folder within the version, columns)."""
    shown = {t: {"folder": folder, "columns": columns.jsonValue()} for t, (folder, columns) in tables.items()}
    commit = version.commit({"tables": shown, "metrics": list(metrics)})
    _show(spark, schema, version.folder, commit)
    sweep(spark, version.folder, keep)
    return commit


def _show(spark: SparkSession, schema: str, folder: str, commit: Commit) -> None:
    """Points the catalog at a commit; one that is shown already is left alone."""
    for name, entry in commit.about["tables"].items():
        table = f"{schema}.{name}"
        place = "/".join(p for p in (commit.path(folder), entry["folder"]) if p)
        columns = StructType.fromJson(entry["columns"])
        if spark.catalog.tableExists(table):
            kind, known = _placed(spark, table)
            same = [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in columns]
            if kind == "EXTERNAL" and same:
                if known != place:
                    spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
                    spark.catalog.refreshTable(table)
                continue
            # The data of an external table stay; until the next line ``read_table`` finds them by the commit.
            spark.sql(f"DROP TABLE {table}")
        spark.catalog.createTable(table, path=place, source="parquet", schema=columns)


def _placed(spark: SparkSession, table: str) -> tuple[str, str]:
    """Kind and location of a table in the catalog."""
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return rows.get("Type", ""), rows.get("Location", "").rstrip("/")


def recover(spark: SparkSession, schema: str) -> None:
    """Shows the latest commit of every dataset of a schema."""
    folder = _location(spark, schema)
    for name in Files(spark, folder).names():
        commit = latest(spark, f"{folder}/{name}")
        if commit:
            _show(spark, schema, f"{folder}/{name}", commit)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A stored table by name, as last committed."""
    if not spark.catalog.tableExists(table):
        recover(spark, table.split(".")[0])
    else:
        _, place = _placed(spark, table)
        within = re.fullmatch(r"(.*)/version-\d{8}-[0-9a-f]{32}(/.*)?", place)
        commit = latest(spark, within[1]) if within else None
        if commit and commit.version not in place:
            _show(spark, table.split(".")[0], within[1], commit)
    return spark.table(table)


def write_metrics(spark: SparkSession, schema: str) -> DataFrame:
    """``dataset, expectation, action, passed, failed`` as counted by the last write of every dataset of a schema."""
    folder, found = _location(spark, schema), {}
    for name in Files(spark, folder).names():
        commit = latest(spark, f"{folder}/{name}")
        if commit:
            found[name] = commit.about["metrics"]
    return metrics_frame(spark, found)


def history(spark: SparkSession, table: str) -> list[Commit]:
    """The commits still kept of a dataset, latest last."""
    return commits(spark, dataset_folder(spark, *table.split(".")))


def at_rest(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder: for frames that are read more than once."""
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tables_in(spark: SparkSession, schema: str) -> DataFrame:
    """``(schema, table)`` for every table of a schema."""
    return spark.sql(f"SHOW TABLES IN {schema}").selectExpr(
        "namespace AS schema_name", "tableName AS table_name"
    )
