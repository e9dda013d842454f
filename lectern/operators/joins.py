"""J1/J4 helpers: first-match lookup, size-checked broadcast, and lookups between bucketed tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.session import scratch_dir

# a lookup side is broadcast only when its counted size stays under this bound
MAX_BROADCAST_ROWS = 2_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after counting the side; otherwise Spark shuffles (AQE may
    still switch to a broadcast at runtime from measured sizes)."""
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def first_match(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """Keep the first row per key in catalogue order (shuffle by key, bounded groups
    are not collected: row_number with a per-key limit becomes a WindowGroupLimit)."""
    w = Window.partitionBy(key).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def lookup(left: DataFrame, catalogue: DataFrame, left_key: str, cat_key: str,
           order_cols: list[str], max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Equi lookup, first catalogue match wins, unmatched rows dropped."""
    cat = first_match(catalogue, cat_key, order_cols)
    cat = cat.withColumnRenamed(cat_key, left_key) if cat_key != left_key else cat
    return left.join(broadcast_if_small(cat, max_rows), left_key, "inner")


def save_bucketed(df: DataFrame, key: str, buckets: int, name: str | None = None, path: str | None = None) -> DataFrame:
    """Save as a table bucketed and sorted by ``key``: later lookups on the key need no exchange of it.

    One shuffle now, a file a bucket; the table is external, at ``path`` (default: a scratch folder)."""
    spark = df.sparkSession
    name = name or f"lectern_{uuid.uuid4().hex[:12]}"
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key) \
        .option("path", path or scratch_dir(spark, name)).saveAsTable(name)
    return spark.table(name)


def bucketed_lookup(left: DataFrame, catalogue: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """J1 between two tables of ``save_bucketed`` with one number of buckets: neither side is exchanged, nor
    broadcast, whatever the catalogue's size; first match wins, unmatched rows are dropped."""
    return left.join(first_match(catalogue, key, order_cols).hint("merge"), key, "inner")
