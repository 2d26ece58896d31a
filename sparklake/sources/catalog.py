"""Catalog operations: layer namespaces, table discovery, schema evolution, listing."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparklake.operators.joins import written

LAYERS = ("bronze", "silver", "gold")
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def create_layers(spark: SparkSession, root: str, layers=LAYERS, prefix: str = "") -> list[str]:
    """One namespace per layer, each with its own location."""
    names = []
    for layer in layers:
        db = f"{prefix}{layer}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/{db}.db'")
        names.append(db)
    return names


def drop_layers(spark: SparkSession, dbs) -> None:
    """Remove namespaces with their table entries; files of external tables stay."""
    for db in dbs:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def _create(spark: SparkSession, table: str, path: str, fmt: str, options: dict, columns: str = "", by: str = "") -> None:
    opts = ", ".join(f"'{k}' '{v}'" for k, v in options.items())
    spark.sql(f"CREATE TABLE {table} {columns} USING {fmt}" + (f" OPTIONS ({opts})" if opts else "")
              + f"{by} LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)  # MSCK REPAIR TABLE


def discover_table(spark: SparkSession, db: str, name: str, path: str, fmt: str = "parquet",
                   options: dict | None = None) -> None:
    """Register files under ``path`` as a table (schema read from all files), then pick
    up partition folders, as a crawler would.  A later crawl updates the entry in place: new columns and
    folders are added to it, so that a reader finds the table at every moment.  Only where columns have gone or changed their type, or
    the place or format is another, is the entry made anew (the files are external)."""
    options = dict(options or {})
    if fmt == "parquet":
        options.setdefault("mergeSchema", "true")
    table = f"{db}.{name}"
    if spark.catalog.tableExists(table):
        about = _described(spark, table)
        found = spark.read.format(fmt).options(**options).load(path).schema
        diff = schema_diff(spark.table(table).schema, found)
        same = about["provider"] == fmt and _path_text(about["location"]) == _path_text(path) and about.get("storage_properties", {}) == options
        if same and all(change == "added" for _, change, _, _ in diff):
            _add_columns(spark, table, [(c, t) for c, _, _, t in diff])
            if about.get("partition_columns"):
                spark.catalog.recoverPartitions(table)
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    _create(spark, table, path, fmt, options)
    spark.catalog.refreshTable(table)


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """(folder, file, modified, length) of every data file below ``path``; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), F.col("path").alias("file"),
                        F.col("modificationTime").alias("modified"), "length")


def crawl(spark: SparkSession, db: str, name: str, path: str, log: str, fmt: str = "parquet", options: dict | None = None) -> dict:
    """An incremental ``discover_table``: only files that the crawl log does not know yet are looked into.

    ``log`` holds (folder, file, modified, length) of every file seen.  The first crawl reads all schemas; a later one
    lists the files, opens those in folders that hold something new (not the older ones there), adds their columns
    to the entry and registers their folders as partitions, so that the table exists at every moment.  A column whose type
    changed makes it a full crawl.  Files that have gone are left to a full crawl too.  Returns the counts of new files and folders and
    whether the crawl was full.  The log is written last: a crawl that failed is repeated.
    """
    table, known = f"{db}.{name}", _exists(spark, log)
    listed = _listing(spark, path)
    if known:
        listed = listed.join(spark.read.parquet(log), ["folder", "file", "modified", "length"], "left_anti")
    new, files = written(listed, "crawl")
    folders = [r["folder"] for r in new.select("folder").distinct().collect()]  # catalog metadata: partitions, not files
    full = not known or not spark.catalog.tableExists(table)
    if files and not full:
        full = not _merge_folders(spark, table, path, fmt, dict(options or {}), folders, new.agg(F.min("modified")).first()[0])
    if full:
        discover_table(spark, db, name, path, fmt, options)
    if files:
        new.write.mode("append").parquet(log)
    return {"files": files, "folders": len(folders), "full": full}


def _merge_folders(spark: SparkSession, table: str, path: str, fmt: str, options: dict, folders: list[str], since) -> bool:
    """Adds what the new files of ``folders`` have to the entry; False if that takes a full crawl."""
    about = _described(spark, table)
    if fmt == "parquet":
        options.setdefault("mergeSchema", "true")
    if about["provider"] != fmt or _path_text(about["location"]) != _path_text(path):
        return False
    after = (since - dt.timedelta(seconds=2)).strftime("%Y-%m-%dT%H:%M:%S")  # whole seconds, and strictly after
    found = spark.read.format(fmt).options(**options, basePath=path, modifiedAfter=after).load(folders).schema
    parts = about.get("partition_columns") or []
    plain = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    specs = [[plain(p.split("=", 1)[1]) for p in f.split("/")[-len(parts):]] for f in folders] if parts else []
    no_value = {c for i, c in enumerate(parts) if all(spec[i] == NULL_FOLDER for spec in specs)}  # their type is unknown
    # a column that the new files lack is no change
    diff = [d for d in schema_diff(spark.table(table).schema, found) if d[1] != "dropped" and d[0] not in no_value]
    if any(change == "type_changed" for _, change, _, _ in diff):
        return False
    _add_columns(spark, table, [(c, t) for c, _, _, t in diff])
    if parts:
        if any(NULL_FOLDER in spec for spec in specs):
            spark.catalog.recoverPartitions(table)
        else:
            text = ["PARTITION (" + ", ".join(f"`{c}` = '{_sql_text(v)}'" for c, v in zip(parts, spec)) + ")" for spec in specs]
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(text)}")
    spark.catalog.refreshTable(table)
    return True


def _sql_text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _path_text(path: str) -> str:
    return path.removeprefix("file:").rstrip("/").replace("///", "/")


def _described(spark: SparkSession, table: str) -> dict:
    """What the catalog holds on a table: provider, location, options, partition columns."""
    about = json.loads(spark.sql(f"DESCRIBE EXTENDED {table} AS JSON").first()[0])
    kept = about.get("storage_properties") or {}
    return about | {"storage_properties": {k: v for k, v in kept.items() if k not in ("path", "serialization.format")}}


def _add_columns(spark: SparkSession, table: str, columns: list[tuple[str, str]]) -> None:
    if columns:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{c}` {t}' for c, t in columns)})")


def list_tables(spark: SparkSession, dbs) -> DataFrame:
    """Table names per namespace, as a DataFrame (catalog metadata, a few rows)."""
    rows = []
    for db in dbs:
        for t in spark.catalog.listTables(db):
            if not t.isTemporary:  # session temp views are listed with every database
                rows.append((db, t.name, t.tableType))
    return spark.createDataFrame(rows, "database string, table_name string, table_type string")


def schema_diff(old: StructType, new: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, change, old_type, new_type) for added, dropped and retyped columns."""
    o = {f.name: f.dataType.simpleString() for f in old.fields}
    n = {f.name: f.dataType.simpleString() for f in new.fields}
    out = []
    for c in n:
        if c not in o:
            out.append((c, "added", None, n[c]))
        elif o[c] != n[c]:
            out.append((c, "type_changed", o[c], n[c]))
    for c in o:
        if c not in n:
            out.append((c, "dropped", o[c], None))
    return out


# Type changes that every stored value survives: old type -> wider types.
WIDER = {"tinyint": {"smallint", "int", "bigint"}, "smallint": {"int", "bigint"}, "int": {"bigint", "double"},
         "float": {"double"}, "date": {"timestamp_ntz"}}


def evolve_table(spark: SparkSession, table: str, new_schema: StructType) -> DataFrame:
    """Schema-change policy for an external table: new columns and wider types are applied in
    place, dropped columns and other type changes are only reported (never applied)."""
    old = spark.table(table).schema
    diff = schema_diff(old, new_schema)
    added = [(c, t) for c, ch, _, t in diff if ch == "added"]
    wider = {c: t for c, ch, o, t in diff if ch == "type_changed" and t in WIDER.get(o, ())}
    if wider:
        about = _described(spark, table)
        parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
        columns = ", ".join(f"`{f.name}` {wider.get(f.name, f.dataType.simpleString())}" for f in old.fields)
        by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
        spark.sql(f"DROP TABLE {table}")
        _create(spark, table, about["location"], about["provider"], about["storage_properties"], f"({columns})", by)
    _add_columns(spark, table, added)
    applied = {c for c, _ in added} | set(wider)
    return spark.createDataFrame(
        [(c, ch, ot, nt, "applied" if c in applied else "logged") for c, ch, ot, nt in diff],
        "column string, change string, old_type string, new_type string, action string")
