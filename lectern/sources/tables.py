"""Driver tables (parquet) and the fixtures derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.session import small_batches

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def balanced(df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has cores.

    A big corpus already arrives as many splits (one per row group / 128 MB) and is
    left alone -- no shuffle.  A small file with few large row groups would otherwise
    keep most cores idle for the per-document work (cleaning, chunking, hashing)."""
    par = df.sparkSession.sparkContext.defaultParallelism
    n = df.rdd.getNumPartitions()
    return df.repartition(2 * par) if n < par else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced(table(spark, sf_dir, "documents"))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrieval catalogue derived from the tables: documents that have a label row.

    id = doc_id, title = 'Doc <id>', author = source, context = lang; ids divisible
    by 7 get a second, later entry (title '... (second entry)') so that first-match
    lookup is exercised.  ``entry_pos`` is the catalogue order.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return catalogue_of(docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi"))


def catalogue_of(labelled: DataFrame) -> DataFrame:
    """Catalogue rows for labelled documents (doc_id, source, lang)."""
    first = labelled.select(
        F.col("doc_id").alias("id"), F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("title"),
        F.col("source").alias("author"), F.col("lang").alias("context"), F.lit(0).alias("entry_dup"))
    second = (labelled.filter(F.col("doc_id") % 7 == 0).select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("Doc "), F.col("doc_id").cast("string"), F.lit(" (second entry)")).alias("title"),
        F.col("source").alias("author"), F.col("lang").alias("context"), F.lit(1).alias("entry_dup")))
    return first.unionByName(second)


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question table from ``benchmark``: qid, question, reference.

    The reference is absent (null) for item_id % 4 = 3 and empty for item_id % 4 = 2,
    which exercises the 'evaluate only when a reference is given' rule.
    """
    b = balanced(table(spark, sf_dir, "benchmark"))
    ref = (F.when(F.col("item_id") % 4 == 3, F.lit(None).cast("string"))
           .when(F.col("item_id") % 4 == 2, F.lit("")).otherwise(F.col("text")))
    return b.select(F.col("item_id").alias("qid"), F.col("text").alias("question"), ref.alias("reference"))


def metric_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turn t (prediction) paired with assistant turn t+1 (reference), same conv_id."""
    c = balanced(table(spark, sf_dir, "conversations"))
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prediction"))
    a = c.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reference"))
    return u.join(a, ["conv_id", "turn"], "inner")
