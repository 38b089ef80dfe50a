"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPACE = r"[\x20\x09-\x0D]+"  # what separates words
WORD_CHAR = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` mentions it.

    A plain nested expression would be evaluated again at each mention, inside lambdas even once
    per array element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than space and U+0009 to U+000D; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id) == 2


def label_sample(labels: DataFrame, column: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids outside the held-out fold, chosen by a hash of the id.

    Rows without id or label don't count; an id labelled several times gets its mean, 0.5 and
    over being 1. The bound makes the result small enough to broadcast.
    """
    return (
        labels.select("doc_id", F.col(column).cast("double").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )


def unused(df: DataFrame, name: str) -> str:
    """The name, or one like it, that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the package to the Python workers, which may not have it on their path.

    Spark serves the archive to every executor, also to those that join later.
    """
    sc, package = spark.sparkContext, Path(__file__).resolve().parent.parent
    if sc.applicationId in _shipped or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with the package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
