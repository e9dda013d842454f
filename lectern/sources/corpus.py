"""Landed text files, cleaned text, landing audit, train/test split.

Landed books are flat text files named by their key (``book_id_<id>.txt``), a bounded number in each
folder, read and written by the Python data source in ``landing``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.sources import landing

KEY_PATTERN = r"book_id_(-?\d+)\."
#: files in a folder, on average
FOLDER_FILES = 2000


def land_text(df: DataFrame, path: str, key: str = "book_id", text: str = "text") -> None:
    """K1: one text file per book (a newline ends each file), in folders of about ``FOLDER_FILES``."""
    landing.register(df.sparkSession)
    shards = max(1, -(-df.count() // FOLDER_FILES))
    df.select(F.col(key).cast("long").alias("book_id"), F.col(text).alias("text")).write.format("landed_books") \
        .option("path", path).option("shards", shards).mode("overwrite").save()


def scan_text(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """Every matching file as one row (book_id, file_name, text)."""
    landing.register(spark)
    return spark.read.format("landed_books").option("path", path).option("suffix", suffix).load().select("book_id", "file_name", "text")


def save_clean(clean: DataFrame, path: str) -> DataFrame:
    """K1: the cleaned text, one row a book; returns the saved table."""
    clean.write.mode("overwrite").parquet(path)
    return clean.sparkSession.read.schema(clean.schema).parquet(path)


def landing_audit(catalogue: DataFrame, landed: DataFrame) -> DataFrame:
    """Status per catalogue id: landed / missing (anti side of the join)."""
    ids = catalogue.select(F.col("id").alias("book_id")).distinct()
    have = landed.select("book_id", F.length("text").alias("chars"))
    return (ids.join(have, "book_id", "left")
            .select("book_id", F.when(F.col("chars").isNull(), F.lit("missing")).otherwise(F.lit("landed")).alias("status"),
                    F.coalesce("chars", F.lit(0)).cast("long").alias("chars")))


def missing_books(catalogue: DataFrame, landed: DataFrame) -> DataFrame:
    """Catalogue ids without landed text."""
    return catalogue.select(F.col("id").alias("book_id")).distinct().join(landed.select("book_id"), "book_id", "left_anti")


def split_bucket(key) -> F.Column:
    """Stable 0..99 bucket from md5 of the key (same value in any engine)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(100))


def write_split(df: DataFrame, path: str, key: str, train_pct: int = 80) -> None:
    """Partition column ``split`` so reading one split prunes the other's files."""
    df.withColumn("split", F.when(split_bucket(key) < train_pct, F.lit("train")).otherwise(F.lit("test"))) \
        .write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("split") == split)
