"""Change batches merged into a partitioned table, and aggregates kept up to date by what changed.

A merged table is four folders below its root:

* ``rows/part=<p>``: the current row of each key;
* ``places/bucket=<b>``: the part in which each key is, by a hash of the key;
* ``changes/batch_id=<n>/_sign=<s>``: what batch n changed, the rows that came with sign 1, those that went with -1;
* ``views/<name>/part=<p>``: aggregates of the rows, per part.

A batch reads the buckets of its keys, the parts that these name, and the parts into which its rows go; all
stand as literals in the scans' partition filters.  Its changes are written first and only once, and the rows, places and
views follow from them, so a batch that is run again after a failure ends in the same table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklake.sources.files import drop_parts, path_exists, write_parquet

SIGN, PART, BUCKET, OP, AS_OF, LIVE = "_sign", "part", "bucket", "op", "_as_of", "_rows"
#: The part of rows that have none.
NO_PART = "none"


@dataclass(frozen=True)
class Merged:
    """A table of one row a ``key``, stored by the text of the SQL expression ``part``."""

    root: str
    key: str
    part: str
    fields: T.StructType
    buckets: int = 64

    def _read(self, spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
        path = f"{self.root}/{folder}"
        if path_exists(spark, path):
            return spark.read.schema(schema).parquet(path)
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])  # planned away, no Python

    def rows(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "rows", T.StructType([*self.fields, T.StructField(PART, T.StringType())]))

    def places(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "places", T.StructType([self.fields[self.key], T.StructField(PART, T.StringType()),
                                                         T.StructField(BUCKET, T.IntegerType())]))

    def logged(self, batch_id: int, sign: int) -> str:
        return f"changes/batch_id={batch_id}/{SIGN}={sign}"

    def changes(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows that came and went; a delete is logged as it came, and is none of them."""
        more = [T.StructField(OP, T.StringType()), T.StructField(PART, T.StringType()), T.StructField(BUCKET, T.IntegerType()),
                T.StructField(SIGN, T.IntegerType())]
        logged = self._read(spark, f"changes/batch_id={batch_id}", T.StructType([*self.fields, *more]))
        return logged.where(~F.col(OP).eqNullSafe("D")).drop(OP)


def _values(df: DataFrame, column: str) -> list:
    """The folders that ``df`` is in: parts or buckets, not rows."""
    return [r[0] for r in df.select(column).distinct().collect()]


def _of_keys(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Rows whose key is (``left_semi``) or is not (``left_anti``) in ``keys``; NULL is a key."""
    return df.join(keys.select(F.col(key).alias("_key")), F.col(key).eqNullSafe(F.col("_key")), how)


def _log_changes(table: Merged, batch: DataFrame, batch_id: int) -> None:
    spark, names = batch.sparkSession, table.fields.fieldNames()
    bucket = F.pmod(F.xxhash64(table.key), F.lit(table.buckets)).cast("int").alias(BUCKET)
    write_parquet(batch.select(*names, OP, F.coalesce(F.expr(table.part).cast("string"), F.lit(NO_PART)).alias(PART), bucket),
                  f"{table.root}/{table.logged(batch_id, 1)}")
    went = table.rows(spark).select(*names, PART, bucket)
    if path_exists(spark, f"{table.root}/places"):  # else the table has no rows yet
        came = spark.read.parquet(f"{table.root}/{table.logged(batch_id, 1)}")
        known = table.places(spark).where(F.col(BUCKET).isin(_values(came, BUCKET)))
        parts = _values(_of_keys(known, came, table.key, "left_semi"), PART)
        went = _of_keys(went.where(F.col(PART).isin(parts)), came, table.key, "left_semi")
    write_parquet(went, f"{table.root}/{table.logged(batch_id, -1)}")


def _replace(there: DataFrame, changes: DataFrame, path: str, column: str, key: str) -> None:
    """The folders of ``column`` that ``changes`` touch, without its keys and with the rows that came."""
    gains = {r[0]: r[1] for r in changes.groupBy(column).agg(F.max(SIGN)).collect()}  # a row a folder
    if not gains:
        return
    spark, came = changes.sparkSession, changes.where(F.col(SIGN) > 0).select(*there.columns)
    if not path_exists(spark, path):
        write_parquet(came, path, partition_by=[column], dynamic=True)
        return
    kept = _of_keys(there.where(F.col(column).isin(list(gains))), changes, key, "left_anti")
    only_lost = [v for v, sign in gains.items() if sign < 0]
    gone = set(only_lost) - set(_values(kept.where(F.col(column).isin(only_lost)), column)) if only_lost else ()
    write_parquet(kept.unionByName(came), path, partition_by=[column], dynamic=True)
    drop_parts(spark, path, column, gone)


def merge_batch(table: Merged, batch: DataFrame, batch_id: int) -> None:
    """Apply a batch of one row a key, with its ``op``: a delete takes the key's row away, any other op puts
    the batch's row in its place.  Batches are applied in the order of their ids; the last may be applied again."""
    spark = batch.sparkSession
    if not path_exists(spark, f"{table.root}/{table.logged(batch_id, -1)}/_SUCCESS"):  # written last
        _log_changes(table, batch, batch_id)
    changes = table.changes(spark, batch_id)
    _replace(table.rows(spark), changes, f"{table.root}/rows", PART, table.key)
    _replace(table.places(spark), changes, f"{table.root}/places", BUCKET, table.key)


@dataclass(frozen=True)
class View:
    """Aggregates of a merged table per ``keys``: each name has its SQL expression over a row and its type.

    ``sums`` are added up (NULL as nothing), ``highs`` are the greatest values.  Distinct values are counted by
    making them a key: a key that has lost all its rows is no longer read.
    """

    name: str
    keys: dict[str, tuple[str, str]]
    sums: dict[str, tuple[str, str]]
    highs: dict[str, tuple[str, str]] = field(default_factory=dict)

    def schema(self) -> T.StructType:
        named = [f"`{n}` {kind}" for n, (_, kind) in {**self.keys, **self.sums, **self.highs}.items()]
        return T.StructType.fromDDL(", ".join([*named, f"{LIVE} bigint", f"{AS_OF} bigint", f"{PART} string"]))

    def path(self, table: Merged) -> str:
        return f"{table.root}/views/{self.name}"

    def stored(self, spark: SparkSession, table: Merged) -> DataFrame:
        return table._read(spark, f"views/{self.name}", self.schema())

    def read(self, spark: SparkSession, table: Merged) -> DataFrame:
        """A row for each key and part that has rows."""
        return self.stored(spark, table).where(F.col(LIVE) > 0).drop(LIVE, AS_OF)


def _typed(named: dict[str, tuple[str, str]]) -> list:
    return [F.expr(text).cast(kind).alias(name) for name, (text, kind) in named.items()]


def refresh_view(view: View, table: Merged, spark: SparkSession, batch_id: int) -> None:
    """Bring ``view`` up to batch ``batch_id``, which ``merge_batch`` has applied.

    What came is added and what went is taken off, so no row of the table is read, but for greatest values: where a row that
    held one went, that key's is taken anew from the key's part.  A part that has the batch already stays as it is.
    """
    keys, cell = list(view.keys), [*view.keys, PART]
    changes = table.changes(spark, batch_id)
    before = view.stored(spark, table).where(F.col(PART).isin(_values(changes, PART)))
    done = _values(before.where(F.col(AS_OF) >= batch_id), PART)
    before, changes = before.where(~F.col(PART).isin(done)), changes.where(~F.col(PART).isin(done))
    came = F.col(SIGN) > 0

    def high(name: str, of) -> list:
        return [F.when(of, F.col(name)).alias(name), F.when(~of, F.col(name)).alias(f"_lost_{name}")]

    delta = changes.select(*_typed(view.keys), *_typed(view.sums), *_typed(view.highs), SIGN, PART)
    delta = delta.select(*cell, *[F.when(came, F.col(n)).otherwise(-F.col(n)).alias(n) for n in view.sums],
                         *[c for n in view.highs for c in high(n, came)], F.col(SIGN).cast("bigint").alias(LIVE))
    old = before.select(*cell, *view.sums, *[c for n in view.highs for c in high(n, F.lit(True))], LIVE)
    now = old.unionByName(delta).groupBy(*cell).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).cast(kind).alias(n) for n, (_, kind) in view.sums.items()],
        *[F.max(c).alias(c) for n in view.highs for c in (n, f"_lost_{n}")], F.sum(LIVE).alias(LIVE))
    # a row that went and stood as high as all that are left, or higher, may have held the greatest value
    stale = F.lit(False)
    for n in view.highs:
        stale = stale | F.coalesce(F.col(f"_lost_{n}") >= F.col(n), F.lit(False))
    now = now.withColumn("_stale", stale & (F.col(LIVE) > 0)).withColumn(AS_OF, F.lit(batch_id).cast("bigint"))
    if view.highs and not changes.where(~came).isEmpty():
        written = f"{table.root}/staged_{view.name}"
        write_parquet(now, written)
        now = spark.read.parquet(written)
        now = _retaken(view, table, now, spark)
    now = now.withColumns({n: F.when(F.col(LIVE) > 0, F.col(n)) for n in view.highs})  # a key without rows has none
    write_parquet(now.select(*view.schema().fieldNames()), view.path(table), partition_by=[PART], dynamic=True)


def _retaken(view: View, table: Merged, now: DataFrame, spark: SparkSession) -> DataFrame:
    """``now`` with the greatest values of its stale keys taken from the table's rows."""
    stale = now.where("_stale")
    parts = _values(stale, PART)
    if not parts:
        return now
    cell = [*view.keys, PART]
    wanted = stale.select(*[F.col(c).alias(f"_of_{c}") for c in cell])
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in cell]
    rows = table.rows(spark).where(F.col(PART).isin(parts)).select(*_typed(view.keys), *_typed(view.highs), PART)
    anew = rows.join(wanted, same, "left_semi").groupBy(*cell).agg(*[F.max(n).alias(n) for n in view.highs])
    anew = anew.select(*[F.col(c).alias(f"_of_{c}") for c in cell], *[F.col(n).alias(f"_new_{n}") for n in view.highs])
    retaken = stale.join(anew, same, "left").select(*[F.col(f"_new_{c}").alias(c) if c in view.highs else F.col(c) for c in now.columns])
    return now.where("NOT _stale").unionByName(retaken)


def run_merge(spark: SparkSession, stream: DataFrame, table: Merged, checkpoint: str,
              transform: Callable[[DataFrame], DataFrame], views: tuple[View, ...] = ()) -> None:
    """One bookmarked run over what is new in ``stream``: each batch is transformed to one row a key with its op,
    merged, and taken into the views."""

    def step(batch: DataFrame, batch_id: int) -> None:
        merge_batch(table, transform(batch), batch_id)
        for view in views:
            refresh_view(view, table, batch.sparkSession, batch_id)

    (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
