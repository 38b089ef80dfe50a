"""Shapes of stored files, read from their Parquet footers by tasks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from ..contracts import bronze_schema, schema_diff

ROW_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"  # fixed value: where Spark keeps a file's schema


def can_open(uri: str) -> bool:
    """Whether Python can read from the file system of a URI; a plain path is one of this machine."""
    if "://" not in uri and not uri.startswith("file:"):
        return True
    try:
        fs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, OSError):
        return False
    return True


def schema_of(path: str, content: bytes | None = None) -> StructType:
    """Schema of one file; only its footer is read, unless its content is given."""
    if content is None:
        system, place = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
        with system.open_input_file(place) as file:
            found = pq.ParquetFile(file).schema_arrow
    else:
        found = pq.ParquetFile(pa.BufferReader(content)).schema_arrow
    written = (found.metadata or {}).get(ROW_SCHEMA)
    return StructType.fromJson(json.loads(written)) if written else from_arrow_schema(found)


def differences(files: DataFrame, name: str, partition: str, schema: str) -> DataFrame:
    """(table, partition value, column, stored, declared) for each file (path, content) that differs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        declared = bronze_schema(name)
        for batch in batches:
            rows = []
            contents = batch["content"] if "content" in batch.schema.names else [None] * batch.num_rows
            for path, content in zip(batch["path"].to_pylist(), contents, strict=True):
                stored = schema_of(path, content and content.as_py())
                value = next((part.split("=", 1)[1] for part in path.split("/") if part.startswith(f"{partition}=")), "")
                if value:  # the folder's name is the column
                    stored = StructType([*stored.fields, declared[partition]])
                rows += [(name, value, *difference) for difference in schema_diff(stored, declared)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            names = ["table_name", "partition", "column_name", "stored", "declared"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names)

    return files.mapInArrow(run, schema)
