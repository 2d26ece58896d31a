"""File sources and sinks (CSV bronze, Parquet silver/gold, partitioned layouts)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from sparklake import schemas

# CSV options that keep text exactly: the writer trims blanks by default.
CSV_WRITE = {"header": "true", "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}
CSV_READ = {"header": "true", "inferSchema": "false"}


def read_bronze(spark: SparkSession, path: str, table: str = "orders",
                schema: StructType | None = None, recursive: bool = False) -> DataFrame:
    """Bronze CSV with a header, every column as text (schema on read, no inference)."""
    r = spark.read.schema(schema or schemas.BRONZE[table]).options(**CSV_READ)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.csv(path)


#: Columns of a checked read: the line as it was if it does not fit the schema, and the file it is from.
CORRUPT, ORIGIN = "_corrupt_line", "_origin_file"


def read_bronze_checked(spark: SparkSession, path: str, table: str = "orders", schema: StructType | None = None,
                        header: bool = True) -> DataFrame:
    """Bronze CSV with every line that does not fit (too few or too many values, an unclosed quote) kept as it
    was in ``CORRUPT``, NULL for good rows, and the file in ``ORIGIN``."""
    fields = schema or schemas.BRONZE[table]
    checked = StructType([*fields.fields, StructField(CORRUPT, StringType())])
    r = (spark.read.schema(checked).options(**CSV_READ).option("header", str(header).lower())
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
    return r.csv(path).select("*", F.col("_metadata.file_path").alias(ORIGIN))


def split_bronze(spark: SparkSession, path: str, out: str, table: str = "orders", schema: StructType | None = None,
                 header: bool = True) -> dict:
    """One pass over bronze CSV: good rows to ``out/quarantined=false``, lines that do not fit to ``out/quarantined=true``.

    Returns the counts ``good`` and ``quarantined`` of that pass; they add up to the lines read.
    """
    seen, bad = Observation("split_bronze"), F.col(CORRUPT).isNotNull()
    rows = read_bronze_checked(spark, path, table, schema, header).observe(
        seen, F.count_if(~bad).alias("good"), F.count_if(bad).alias("quarantined"))
    rows.withColumn("quarantined", bad).write.mode("overwrite").partitionBy("quarantined").parquet(out)
    return {k: seen.get.get(k) or 0 for k in ("good", "quarantined")}


def read_split(spark: SparkSession, out: str, table: str = "orders", schema: StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """The good rows of ``split_bronze`` and its quarantine (line, file)."""
    fields = schema or schemas.BRONZE[table]
    both = StructType([*fields.fields, StructField(CORRUPT, StringType()), StructField(ORIGIN, StringType()),
                       StructField("quarantined", BooleanType())])
    rows = spark.read.schema(both).parquet(out)
    return (rows.where("NOT quarantined").select(*fields.fieldNames()),
            rows.where("quarantined").select(F.col(CORRUPT).alias("line"), F.col(ORIGIN).alias("file")))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_WRITE).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = (), dynamic: bool = False,
                  compression: str = "snappy") -> None:
    """Parquet sink.  With ``partition_by`` the rows are clustered by the
    partition columns through a ``REBALANCE`` hint: AQE keeps a partition value
    in few files but splits a hot value (one month holding a third of the rows)
    over several tasks.  ``dynamic`` replaces only the partitions present."""
    w = df
    if partition_by:
        w = df.hint("rebalance", *partition_by)
    writer = w.write.mode(mode).option("compression", compression)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def drop_parts(spark: SparkSession, path: str, column: str, values) -> None:
    """Delete the folders of some values of a partition column, named as Spark names them."""
    jvm = spark.sparkContext._jvm
    escaped = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for value in values:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={NULL_FOLDER if value is None else escaped(str(value))}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet scan; partition folders come back as columns."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def write_sorted(df: DataFrame, path: str, order: Sequence, mode: str = "overwrite") -> None:
    """Parquet sink in a global order: part files follow each other and are sorted inside."""
    df.orderBy(*order).write.mode(mode).parquet(path)


def with_file_rows(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder read back with ``_file`` and ``_at``, the file and the row's number in it."""
    return spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))


def with_file_position(spark: SparkSession, path: str, name: str = "position") -> DataFrame:
    """A sorted sink read back, each row with its place as the files have it: its number in
    its file and the rows of the files before, summed over a table of one row a file."""
    rows = with_file_rows(spark, path)
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    placed = rows.join(F.broadcast(offsets), "_file")  # one row a file
    return placed.withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_file", "_at", "_before")


def with_date_parts(df: DataFrame, ts: str, parts=("year", "month", "day")) -> DataFrame:
    """Zero-padded text partition columns (YYYY / MM / DD / HH) from a timestamp."""
    fmt = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return df.select("*", *[F.date_format(F.col(ts), fmt[p]).alias(p) for p in parts])


def write_with_metrics(df: DataFrame, path: str, *, mode: str = "overwrite",
                       partition_by: Sequence[str] = (), name: str = "write") -> dict:
    """Write and count in the same pass (``observe``), instead of running the
    plan a second time for ``count()``."""
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows_written"))
    write_parquet(observed, path, mode=mode, partition_by=partition_by)
    return obs.get
