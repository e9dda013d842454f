"""Registered streaming queries (T1, T2): a stream delivered in file drops must end in
the batch result, so both have a SQL oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators.store import VectorStore
from lectern.plans import sqlparts as S
from lectern.plans.corpus import build_points
from lectern.plans.q_answers import _sql_answers
from lectern.session import scratch_dir
from lectern.sources.corpus import land_text
from lectern.sources.tables import catalogue, documents, questions
from lectern.streaming.incremental import answer_stream, incremental_build

DIM = 384
DROPS = 3


def t01_incremental_build(spark, sf):
    """All documents land in three drops (by doc_id % 3); after each drop the
    stream runs once (availableNow) and upserts what is new into the collection."""
    root = scratch_dir(spark, "t01")
    store = VectorStore(spark, f"{root}/store", DIM)
    docs, cat = documents(spark, sf), catalogue(spark, sf)
    for drop in range(DROPS):
        part = docs.filter(F.col("doc_id") % DROPS == drop).select(F.col("doc_id").alias("book_id"), "text")
        land_text(part, f"{root}/landing/drop={drop}")
        incremental_build(spark, f"{root}/landing", store, cat, f"{root}/ckpt", dim=DIM).awaitTermination()
    pts = store.read()
    ids = pts.groupBy("id").agg(F.count(F.lit(1)).alias("rows_of_id"))
    return pts.join(ids, "id").select("book_id", F.col("chunk_no").cast("long").alias("chunk_no"),
                                      F.md5(F.col("payload.text")).alias("md5_text"), "rows_of_id")


def sql_t01_incremental_build():
    # landed files end with the text writer's newline; the cleaner trims it
    return f"""WITH RECURSIVE landed AS MATERIALIZED (
  SELECT doc_id, text || chr(10) AS text, source, lang, doc_id IN (SELECT doc_id FROM labels) AS lab FROM documents),
{S.points_ctes(512, DIM, 'landed', 'lab')}
SELECT book_id, chunk_no, md5(chunk_text) AS md5_text, 1::BIGINT AS rows_of_id FROM pts"""


def t02_question_stream(spark, sf):
    """The question table arrives as two JSON drops; each micro-batch is answered
    against the stored collection and appended to a Parquet sink."""
    root = scratch_dir(spark, "t02")
    store = VectorStore(spark, f"{root}/store", DIM)
    store.create_if_absent(build_points(spark, documents(spark, sf), catalogue(spark, sf), dim=DIM,
                                        materialize=False))
    q = questions(spark, sf)
    for drop in range(2):
        q.filter(F.col("qid") % 2 == drop).write.json(f"{root}/questions/drop={drop}")
        answer_stream(spark, f"{root}/questions", store, f"{root}/answers", f"{root}/ckpt").awaitTermination()
    a = spark.read.parquet(f"{root}/answers")
    return a.select("qid", F.col("n_passages").cast("long").alias("n_passages"), F.md5("context").alias("context_md5"),
                    F.md5("summary").alias("summary_md5"), F.md5("answer").alias("answer_md5"))


def sql_t02_question_stream():
    return f"""WITH RECURSIVE {_sql_answers()}
SELECT qid, n_passages::BIGINT AS n_passages, md5(context) AS context_md5, md5(summary) AS summary_md5,
  md5(answer) AS answer_md5 FROM ans"""


QUERIES = {
    "t01_incremental_build": (t01_incremental_build, sql_t01_incremental_build),
    "t02_question_stream": (t02_question_stream, sql_t02_question_stream),
}
