"""Session pinning, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def pin(spark: SparkSession) -> SparkSession:
    """Silver timestamps are naive UTC, so the session zone must be UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; a temporary one only for an unset local session."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            sc.setCheckpointDir(configured)
        elif sc.master.startswith("local"):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="cornermart-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return sc.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh shared folder path for a table that one query writes and reads."""
    return f"{checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the package to the Python workers, which may not have it on their path.

    Spark serves the archive to every executor, also to those that join later.
    """
    sc, package = spark.sparkContext, Path(__file__).resolve().parent
    if sc.applicationId in _shipped or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def materialise(df: DataFrame, name: str = "cut") -> DataFrame:
    """Cut lineage into a parquet table in the shared checkpoint folder.

    It survives the loss of executors, and unlike an RDD checkpoint it is read column by column
    and its size is known to the planner.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
