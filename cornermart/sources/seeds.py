"""Reference tables with declared column types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, DecimalType, StringType, StructField, StructType

# Seed columns. Published rates have 8 places; 6 are kept.
SEEDS = {
    "exchange_rates": StructType(
        [
            StructField("currency_date", DateType()),
            StructField("currency", StringType()),
            StructField("rate_to_usd", DecimalType(10, 6)),
        ]
    ),
    "store_timezones": StructType(
        [StructField("location_id", StringType()), StructField("timezone_name", StringType())]
    ),
}


def read_seed(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Read as text, then cast, so a rate with more places is rounded and junk is an error."""
    schema = SEEDS[name]
    text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    raw = spark.read.schema(text).option("header", True).csv(path)
    return raw.select(*[raw[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
