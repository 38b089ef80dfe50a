"""Daily files picked up as they arrive, with a Structured Streaming file source."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contracts import SOURCES, source
from ..settings import Settings
from ..sources import bronze

# Fixed value: a delivery is <source>_<day>.<csv|json>, or a folder of that name with part files.
_DELIVERY = r"([a-z_]+)_(\d{4}-\d{2}-\d{2})\.(?:csv|json)(?:/[^/]*)?$"

_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def deliveries(files: DataFrame) -> DataFrame:
    """(source, day) of each new file of a known source; contents are not looked at."""
    return files.select(
        F.regexp_extract("path", _DELIVERY, 1).alias("source"),
        F.regexp_extract("path", _DELIVERY, 2).try_cast("date").alias("day"),
    ).filter(F.col("source").isin([s.name for s in SOURCES]) & F.col("day").isNotNull())


def load_arrivals(spark: SparkSession, s: Settings):
    """foreachBatch body: load each (source, day) that got a file through the day swap.

    The whole day is read again, so a day arriving in several files and a replayed batch both
    end in the same table.
    """

    def load(batch: DataFrame, _: int) -> None:
        arrived = deliveries(batch).distinct().orderBy("day", "source").collect()
        for row in arrived:
            bronze.load_day(spark, s, source(row.source), row.day)

    return load


def ingest_arrivals(spark: SparkSession, s: Settings, checkpoint: str) -> StreamingQuery:
    """Process all files that arrived since the last call, then stop."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .load(s.raw)
        .select("path")
    )
    return (
        files.writeStream.foreachBatch(load_arrivals(spark, s))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
