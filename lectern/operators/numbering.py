"""Ordinals, dense ids and batch numbers without a single-partition window.

``exclusive_offsets`` is a distributed prefix sum: the (key, count) table is range
partitioned, its partition layout is pinned with a reliable checkpoint, per-partition
totals (one row per partition) are prefix-summed, and each partition then adds a
running sum inside itself.  Only the per-partition table (bounded by the partition
count) is ever ordered as a whole.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.session import checkpoint_root


ROWS_PER_RANGE = 1_000_000


def exclusive_offsets(df: DataFrame, key: str | list[str], count_col: str, partitions: int | None = None,
                      group: str | None = None) -> DataFrame:
    """(key, count, ...) -> same columns + offset = sum of counts of smaller keys
    (within the same ``group`` when given).  A key may be several columns."""
    spark = df.sparkSession
    checkpoint_root(spark)
    # one range partition per ROWS_PER_RANGE rows: a few hundred books stay one task,
    # a billion books get a thousand ranges
    n = partitions or max(1, math.ceil(df.count() / ROWS_PER_RANGE))
    keys = [key] if isinstance(key, str) else list(key)
    order = ([group] if group else []) + keys
    ranged = (df.repartitionByRange(n, *order)
              .withColumn("_p", F.spark_partition_id())).checkpoint(eager=True)
    gcols = ["_p"] + ([group] if group else [])
    totals = ranged.groupBy(*gcols).agg(F.sum(count_col).alias("_t"))
    w = (Window.partitionBy(group) if group else Window).orderBy("_p") \
        .rowsBetween(Window.unboundedPreceding, -1)
    base = totals.withColumn("_base", F.coalesce(F.sum("_t").over(w), F.lit(0)))
    within = Window.partitionBy(*gcols).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    # ``base`` has one row per (partition, group): bounded by partitions x groups
    return (ranged.join(F.broadcast(base.select(*gcols, "_base")), gcols)
            .withColumn("offset", (F.col("_base") + F.coalesce(F.sum(count_col).over(within), F.lit(0))).cast("long"))
            .drop("_p", "_base"))


def batch_number(id_col, batch_size: int):
    """Fixed-size batches over dense ids, the last one short."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.floor(c / F.lit(batch_size)).cast("long")
