"""Parquet tables under a lake root: full replace, day swap, upsert, drift check."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..contracts import (
    PARTITION,
    ContractError,
    bronze_schema,
    declared_schema,
    schema_diff,
)
from ..session import ship
from ..settings import Settings
from . import footers, fs


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder of rows without a partition value


def table(
    spark: SparkSession, s: Settings, layer: str, name: str, schema: StructType | None = None
) -> DataFrame:
    """A stored table by layer and name. With a declared schema it is readable before its first file."""
    path = s.path(layer, name)
    schema = schema or declared_schema(layer, name)
    if schema is None:
        return spark.read.parquet(current(spark, path))
    if not fs.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(current(spark, path))


def _partition_values(spark: SparkSession, path: str, partition: str) -> dict[str, str]:
    """Partition value -> folder, from folder names alone."""
    return {f.rsplit("=", 1)[1]: f for f in fs.glob(spark, f"{path}/{partition}=*")}


def partitions(
    spark: SparkSession,
    path: str,
    partition: str,
    schema: StructType,
    keep: Callable[[str], bool],
) -> DataFrame:
    """The partitions whose value passes ``keep``; the others are not even listed.

    Daily jobs read a few days of a long history this way, so their cost does not grow with it.
    """
    folders = [f for v, f in _partition_values(spark, path, partition).items() if keep(v)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def newest_partition(spark: SparkSession, path: str, partition: str) -> str | None:
    """Largest partition value by folder name: no file is opened."""
    values = _partition_values(spark, path, partition).keys() - {NO_VALUE}
    return max(values, default=None)


def has_table(spark: SparkSession, s: Settings, layer: str, name: str) -> bool:
    return fs.exists(spark, s.path(layer, name))


def staging_path(s: Settings, name: str) -> str:
    return s.path("_staging", f"{name}-{uuid.uuid4().hex}")


# -- full refresh ------------------------------------------------------------------------


def replace(df: DataFrame, path: str, partition: str, sort: list[str] = ()) -> None:
    """Replace a partitioned table that ``df`` does not read, day by day: a reader sees each day old
    or new, and a failure before the commit changes nothing. ``sort`` clusters the files."""
    doomed = set(_partition_values(df.sparkSession, path, partition))
    swap(df, path, partition, doomed, sort)


def _versions(spark: SparkSession, path: str) -> list[str]:
    return [m.removesuffix("/_SUCCESS") for m in fs.glob(spark, f"{path}/version=*/_SUCCESS")]


def current(spark: SparkSession, path: str) -> str:
    """The newest completely written version of a table, or the table itself if it has none."""
    done = _versions(spark, path)
    return done[-1] if done else path


def replace_self(df: DataFrame, path: str) -> None:
    """Replace a table, which ``df`` may read: write a new version beside it.

    Readers see the new version once its job committed; one older version is kept for them.
    """
    spark = df.sparkSession
    done = _versions(spark, path)
    last = int(done[-1].rsplit("=", 1)[1]) if done else 0
    df.write.mode("overwrite").parquet(f"{path}/version={last + 1:08d}")
    for old in done[:-1]:
        fs.remove(spark, old)


# -- partition writes --------------------------------------------------------------------


SPREAD = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


def _rebalanced(df: DataFrame, partition: str) -> DataFrame:
    """Group rows by partition value for few files; a huge day is split over several tasks."""
    return df.hint("rebalance", F.col(partition))


@contextmanager
def _spread(spark: SparkSession) -> Iterator[None]:
    """While a table of many days is written, the run-time rebalance may make small tasks: such a
    write is bound by its number of files, not by bytes."""
    before = spark.conf.get(SPREAD)
    spark.conf.set(SPREAD, "16k")
    try:
        yield
    finally:
        spark.conf.set(SPREAD, before)


def _folder(partition: str) -> Column:
    return F.coalesce(F.col(partition).cast("string"), F.lit(NO_VALUE))


def values_of(df: DataFrame, partition: str) -> set[str]:
    """The partition values present, as folder names spell them (one per calendar day)."""
    return {r[0] for r in df.select(_folder(partition)).distinct().collect()}


def swap(
    staged: DataFrame, path: str, partition: str, doomed: set[str], sort: list[str] = (), present: set[str] | None = None
) -> None:
    """Make ``doomed`` and every partition present in ``staged`` hold exactly the staged rows.

    ``staged`` must not read ``path``. Other partitions are untouched. Repeating the call gives
    the same table, so a failed run is simply run again. ``present``, where the caller knows them,
    are the staged partitions; they are looked up otherwise.
    """
    spark = staged.sparkSession
    if doomed and present is None:
        present = values_of(staged, partition)
    shaped = _rebalanced(staged, partition)
    if sort:
        shaped = shaped.sortWithinPartitions(partition, *sort)
    with _spread(spark):
        (
            shaped.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(path)
        )
    for value in sorted(doomed - (present or set())):
        fs.remove(spark, f"{path}/{partition}={value}")


def _finish(spark: SparkSession, path: str, staging: str, partition: str, schema: StructType, sort: list[str]) -> None:
    """Complete a merge whose staged rows are whole; the swap can be repeated."""
    touched = fs.read_text(spark, f"{staging}/_touched")
    if touched is not None:
        merged = spark.read.schema(schema).parquet(f"{staging}/merged")
        swap(merged, path, partition, {v for v in touched.split("\n") if v}, sort)
    fs.remove(spark, staging)


def upsert(
    batch: DataFrame,
    s: Settings,
    layer: str,
    name: str,
    key: str,
    partition: str,
    doomed: DataFrame | None = None,
    stale: Column | None = None,
    sort: list[str] = (),
) -> None:
    """Merge ``batch`` into a partitioned table, rewriting only the partitions it touches.

    Removed are the stored rows whose key is in the batch or in ``doomed`` (one key column) and
    those that ``stale`` holds for; then the batch is added. The merged partitions are staged, then
    marked as whole, then swapped in. A run that was cut off is finished by the next call: before
    the mark nothing has changed, after it the swap is repeated from the staged rows.
    """
    spark = batch.sparkSession
    path, staging = s.path(layer, name), s.path("_staging", f"{layer}-{name}")
    schema = batch.schema
    _finish(spark, path, staging, partition, schema, sort)
    for copy in ("batch", "keys"):
        fs.remove(spark, f"{staging}-{copy}")
    batch.write.parquet(f"{staging}-batch")
    batch = spark.read.schema(schema).parquet(f"{staging}-batch")
    if not fs.exists(spark, path):
        swap(batch, path, partition, set(), sort)
        fs.remove(spark, f"{staging}-batch")
        return
    keys = batch.select(key)
    if doomed is not None:
        keys = keys.unionByName(doomed.select(key))
    keys = keys.filter(F.col(key).isNotNull()).distinct()
    keys.write.parquet(f"{staging}-keys")  # joined twice
    keys = spark.read.schema(keys.schema).parquet(f"{staging}-keys")
    target = spark.read.schema(schema).parquet(path)
    touched = values_of(target.join(keys, key, "left_semi"), partition) | values_of(batch, partition)
    if stale is not None:
        touched |= values_of(target.filter(stale), partition)
    kept = partitions(spark, path, partition, schema, touched.__contains__)
    if stale is not None:
        kept = kept.filter(~F.coalesce(stale, F.lit(False)))
    merged = kept.join(keys, key, "left_anti").select(*schema.names).unionByName(batch)
    merged.write.parquet(f"{staging}/merged")
    fs.write_text(spark, f"{staging}/_touched", "\n".join(sorted(touched)))
    _finish(spark, path, staging, partition, schema, sort)
    for copy in ("batch", "keys"):
        fs.remove(spark, f"{staging}-{copy}")


# -- bronze ------------------------------------------------------------------------------


def _contract_file(path: str) -> str:
    return f"{path}/_contract"  # readers skip names that begin so


def _contract_text(name: str) -> str:
    return bronze_schema(name).json()


def note_contract(spark: SparkSession, path: str, name: str) -> None:
    """Keep the schema the table was last written with beside it."""
    fs.write_text(spark, _contract_file(path), _contract_text(name))


def check_drift(spark: SparkSession, path: str, name: str, partition: str) -> None:
    """A table written under another contract must be migrated, not mixed with new rows.

    The kept schema tells, whatever the table's size; without one, the newest partition does.
    """
    kept = fs.read_text(spark, _contract_file(path))
    if kept is not None:
        stored = StructType.fromJson(json.loads(kept))
    else:
        newest = newest_partition(spark, path, partition)
        folder = f"{path}/{partition}={newest}" if newest else current(spark, path)
        stored = _schema(spark, folder, path)
    differences = schema_diff(stored, bronze_schema(name))
    if differences:
        raise ContractError(f"{name}: the stored table has another shape, migrate or rebuild it (column, stored, declared): {differences}")


def _schema(spark: SparkSession, folder: str, path: str) -> StructType:
    """Schema of a partition with its partition column, or of a version as it is."""
    versioned = folder == current(spark, path)
    return spark.read.option("basePath", folder if versioned else path).parquet(folder).schema


AUDIT = "table_name string, partition string, column_name string, stored string, declared string"


def audit(spark: SparkSession, s: Settings, name: str) -> DataFrame:
    """Columns of a stored bronze table that differ from the contract, per partition.

    A job reads the footer of every data file, so that files of different shapes are reported even
    within a partition, and shapes that can't be merged with each other like any others.
    """
    path = s.path("bronze", name)
    root = current(spark, path)
    ship(spark)
    found = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.parquet").load(root)
    # where Python can't open the file system, Spark hands over the files
    found = found.select("path") if footers.can_open(root) else found.select("path", "content")
    found = found.repartition(spark.sparkContext.defaultParallelism * 4)
    return footers.differences(found, name, PARTITION, AUDIT).distinct()


def write_hive_layout(df: DataFrame, zone: str) -> None:
    """Archive bronze rows as ``zone/source_name=/year=/month=/day=``, replacing the days present."""
    day = F.col(PARTITION)
    dated = df.withColumns(
        {
            "source_name": F.col("_source_system"),
            "year": F.date_format(day, "yyyy"),
            "month": F.date_format(day, "MM"),
            "day": F.date_format(day, "dd"),
        }
    )
    (
        _rebalanced(dated, PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source_name", "year", "month", "day")
        .parquet(zone)
    )
