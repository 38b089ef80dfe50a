"""Each document together with the one after it in descending id order, without a global sort.

The ids are cut into ranges of about equal size. A task gets whole ranges, sorted, and the first
document of the range below as a guest, so that every document meets its successor there; the last
document of all meets the first. Texts are shuffled once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType

from .common import ship

RANGES_PER_TASK = 4


def dealt_in_order(docs: DataFrame) -> DataFrame:
    """(range, guest, doc_id, text): partitions sorted by range, guests last, then descending id.

    Rows without id come after all others; repeated ids in descending order of text. A null text
    counts as empty.
    """
    spark = docs.sparkSession
    ship(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    n = tasks * RANGES_PER_TASK
    cuts = rows.select("doc_id").approxQuantile("doc_id", [k / n for k in range(1, n)], 1 / (4 * n))
    borders = np.unique(np.array([min(int(cut), 2**63 - 1) for cut in cuts], np.int64))

    def place(ids: pa.Array) -> pa.Array:
        # Arrow's own 64-bit integers: through pandas a missing id would make all of them floats
        at = np.searchsorted(borders, ids.fill_null(0).to_numpy(), "right")
        return pa.array(np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, at).astype(np.int32))

    own = F.arrow_udf(place, IntegerType())
    # one row per range: its highest id, null if it holds rows without id only
    heads = rows.select("doc_id").withColumn("range", own("doc_id")).groupBy("range").agg(F.max("doc_id").alias("head"))
    found = sorted((r["range"], r["head"]) for r in heads.collect())
    above = {head: found[(k + 1) % len(found)][0] for k, (_, head) in enumerate(found)}  # the head of all visits the lowest

    def guest_of(ids: pa.Array) -> pa.Array:
        return pa.array([above.get(x, -1) for x in ids.to_pylist()], pa.int32())

    visits = F.arrow_udf(guest_of, IntegerType())
    placed = rows.select("doc_id", "text", own("doc_id").alias("own"), visits("doc_id").alias("visit"))
    targets = F.when(F.col("visit") >= 0, F.array("own", "visit")).otherwise(F.array("own"))
    dealt = placed.select("doc_id", "text", F.posexplode(targets).alias("guest", "range"))
    return (
        dealt.select("range", "guest", "doc_id", "text")
        .repartition(tasks, "range")
        .sortWithinPartitions("range", "guest", F.desc_nulls_last("doc_id"), F.desc("text"))
    )
