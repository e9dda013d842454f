"""Structured Streaming re-aims of the batch jobs.

T1 -- incremental corpus build: tasks list the landed text files and write the names of new ones
to lists of ``LIST_FILES``, and these lists are the file stream, so that its source, which keeps in the
driver what it has seen, holds lists and no books; every
micro-batch is read, cleaned, chunked, embedded, looked up and upserted into the keyed
vector table (replace by book).  A rerun over the same directory only sees new
files (the checkpoint records lists and processed lists).  A micro-batch reserves its first id under
the stream's and its own number before it writes, so one that is replayed after a failure replaces
its rows by the same rows with the same ids.

T2 -- questions to answers: question files are a stream joined against the current
(static) vector table; each micro-batch runs the answer job and writes its own folder of the sink.

No event time is involved, so there are no watermarks: the stream is only a delivery
mechanism, as in the reference (a rerun over a directory / a form submit).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.operators.store import VectorStore
from lectern.plans.answers import answer_questions
from lectern.plans.corpus import build_points
from lectern.session import hadoop_fs
from lectern.sources.corpus import FOLDER_FILES, KEY_PATTERN
from lectern.sources.landing import LISTED, contents, listed

#: names in a list, at most
LIST_FILES = 20_000

QUESTION_SCHEMA = T.StructType([T.StructField("qid", T.LongType()), T.StructField("question", T.StringType()),
                                T.StructField("reference", T.StringType())])


def announce(spark: SparkSession, landing_dir: str, checkpoint: str, suffix: str = ".txt") -> str:
    """Write the names of landed files that are not announced yet to lists beside the checkpoint; returns
    the folder of the lists.  A list that was written and not read stays for the next run."""
    lists = f"{checkpoint.rstrip('/')}/landed"
    fs, p = hadoop_fs(spark, lists)
    files, done = listed(spark, landing_dir, suffix)
    try:
        new = files
        if fs.exists(p):
            new = files.join(spark.read.schema(LISTED).parquet(lists).select("path").hint("merge"), "path", "left_anti")
        if not fs.exists(p) or not new.isEmpty():
            new.write.option("maxRecordsPerFile", LIST_FILES).mode("append").parquet(lists)
    finally:
        done()
    return lists


def landed_texts(files: DataFrame, landing_dir: str) -> DataFrame:
    """Listed files -> rows (doc_id, text, landed), a task reading about ``FOLDER_FILES`` files."""
    n = max(files.sparkSession.sparkContext.defaultParallelism, -(-files.count() // FOLDER_FILES))
    return contents(files.repartition(n), landing_dir).select(
        F.regexp_extract("path", KEY_PATTERN, 1).try_cast("long").alias("doc_id"),
        F.col("content").cast("string").alias("text"), F.struct(F.col("modified_ns").alias("at"), "path").alias("landed"))


def load_batch(spark: SparkSession, batch: DataFrame, store: VectorStore, catalogue: DataFrame, load: str,
               budget: int = 512, dim: int = 384) -> None:
    """Upsert landed rows (doc_id, text, landed) as the load of that name."""
    # several actions read the micro-batch (chunk write, counts, commit): read the
    # landed files once (persist is recomputable from the source if a block is lost)
    # of a book that landed several times in the batch, the newest file counts
    docs = (batch.groupBy("doc_id").agg(F.max_by("text", "landed").alias("text"))
            .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        if docs.isEmpty():
            return
        pts = build_points(spark, docs, catalogue, budget=budget, dim=dim, materialize=False, first_id=store.reserve(load))
        store.upsert(pts, replaced_keys=docs.select(F.col("doc_id").alias("book_id")))
    finally:
        docs.unpersist()


def incremental_build(spark: SparkSession, landing_dir: str, store: VectorStore, catalogue: DataFrame,
                      checkpoint: str, budget: int = 512, dim: int = 384):
    """Start the stream with ``availableNow`` (process what is there, then stop)."""
    def apply(batch: DataFrame, epoch_id: int) -> None:
        load_batch(spark, landed_texts(batch, landing_dir), store, catalogue, f"{checkpoint}#{epoch_id}", budget, dim)

    lists = announce(spark, landing_dir, checkpoint)
    return (spark.readStream.schema(LISTED).parquet(lists).writeStream.foreachBatch(apply)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def answer_stream(spark: SparkSession, question_dir: str, store: VectorStore, sink: str, checkpoint: str,
                  k: int = 4, dim: int = 384):
    """Question files (JSON lines) -> answers in a Parquet sink, a folder per micro-batch."""
    qs = spark.readStream.schema(QUESTION_SCHEMA).option("recursiveFileLookup", True).json(question_dir)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        qb = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if qb.isEmpty():
                return
            ans = answer_questions(store.read(), qb, k=k, dim=dim)
            # a replayed micro-batch replaces its own folder, so no answer comes twice
            ans.write.mode("overwrite").parquet(f"{sink}/epoch_id={epoch_id}")
        finally:
            qb.unpersist()

    return (qs.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
