"""A stream delivered in several file drops gives the batch result."""

import json
import os
import time

from pyspark.sql import functions as F

from lectern.operators.store import VectorStore
from lectern.plans.answers import answer_questions, retrieve
from lectern.plans.corpus import build_points
from lectern.sources.corpus import land_text
from lectern.sources.tables import catalogue, documents, questions
from lectern.streaming.incremental import answer_stream, incremental_build

SF = "/root/testdata/sf0.001"


def test_incremental_build_equals_batch(spark, tmp_dir):
    docs = documents(spark, SF)
    cat = catalogue(spark, SF)
    store = VectorStore(spark, f"{tmp_dir}/store", 384)
    landing = f"{tmp_dir}/landing"
    for drop in range(3):  # three file drops, one availableNow run after each
        part = docs.filter(F.col("doc_id") % 3 == drop).select(F.col("doc_id").alias("book_id"), "text")
        land_text(part, f"{landing}/drop={drop}")
        q = incremental_build(spark, landing, store, cat, f"{tmp_dir}/ckpt", budget=64)
        q.awaitTermination()
    got = sorted(map(tuple, store.read().select("book_id", "chunk_no", F.md5("payload.text")).collect()))
    batch = build_points(spark, docs.withColumn("text", F.concat("text", F.lit("\n"))), cat, budget=64)
    want = sorted(map(tuple, batch.select("book_id", "chunk_no", F.md5("payload.text")).collect()))
    assert got == want and len(got) > 0
    # ids stay unique over the drops, so a search joins each hit to one passage
    pts = store.read()
    assert pts.select("id").distinct().count() == pts.count()
    qs = questions(spark, SF)
    found = retrieve(pts, qs).groupBy("qid").agg(F.sort_array(F.collect_list("score")).alias("s"))
    wanted = retrieve(batch, qs).groupBy("qid").agg(F.sort_array(F.collect_list("score")).alias("s"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_book_landed_twice_in_one_batch(spark, tmp_dir):
    docs, cat = documents(spark, SF).filter("doc_id < 20"), catalogue(spark, SF)
    store = VectorStore(spark, f"{tmp_dir}/store", 384)
    land_text(docs.select(F.col("doc_id").alias("book_id"), "text"), f"{tmp_dir}/landing/one")
    time.sleep(1.1)  # file times of some systems are whole seconds
    land_text(docs.select(F.col("doc_id").alias("book_id"), F.lit("A newer text of the book.").alias("text")), f"{tmp_dir}/landing/two")
    incremental_build(spark, f"{tmp_dir}/landing", store, cat, f"{tmp_dir}/ckpt", budget=64).awaitTermination()
    got = store.read().select("book_id", "chunk_no", "payload.text").collect()
    assert got and {r["text"] for r in got} == {"A newer text of the book."} and len({r["book_id"] for r in got}) == len(got)


def test_stream_source_holds_lists_and_not_books(spark, tmp_dir):
    rows = [(i, f"Text of the book {i}.") for i in range(60)]
    cat = spark.createDataFrame([(i, f"t{i}", "a", "c", 0) for i in range(200)], "id long, title string, author string, context string, entry_dup int")
    store, landing = VectorStore(spark, f"{tmp_dir}/store", 384), f"{tmp_dir}/landing"
    build = lambda: incremental_build(spark, landing, store, cat, f"{tmp_dir}/ckpt", budget=64).awaitTermination()
    held = lambda: {r["book_id"]: r["payload"]["text"] for r in store.read().collect()}
    land_text(spark.createDataFrame(rows, "book_id long, text string").coalesce(1), f"{landing}/one")
    build()
    assert held() == dict(rows)
    # what the source remembers in the driver is less than the files
    seen = [line for b in os.listdir(f"{tmp_dir}/ckpt/sources/0") if not b.startswith(".")
            for line in open(f"{tmp_dir}/ckpt/sources/0/{b}").read().split("\n")[1:] if line]
    assert 0 < len(seen) < 20
    # files laid by hand in any folder, one without bytes, other extensions, hidden ones; known files are not read again
    os.makedirs(f"{landing}/two/deep/er")
    for at, text in (("two/book_id_100.txt", "By hand."), ("two/deep/er/book_id_101.txt", "Deep."), ("book_id_102.txt", "Loose."),
                     ("two/book_id_5.txt", ""), ("two/book_id_103.md", "No."), ("two/.book_id_104.txt", "No."), ("two/deep/_book_id_105.txt", "No.")):
        with open(f"{landing}/{at}", "w") as f:
            f.write(text)
    before = {r["book_id"]: r["id"] for r in store.read().collect()}
    build()
    assert held() == dict(rows) | {100: "By hand.", 101: "Deep.", 102: "Loose."}
    assert {r["book_id"]: r["id"] for r in store.read().collect()}.items() >= before.items()
    build()
    assert len(held()) == 63


def test_replayed_question_batch_writes_no_doubles(spark, tmp_dir):
    store = VectorStore(spark, f"{tmp_dir}/store", 384)
    store.create_if_absent(build_points(spark, documents(spark, SF), catalogue(spark, SF)))
    q = questions(spark, SF)
    q.write.json(f"{tmp_dir}/questions")
    for ckpt in ("one", "two"):  # a lost checkpoint replays the batch under its number
        answer_stream(spark, f"{tmp_dir}/questions", store, f"{tmp_dir}/answers", f"{tmp_dir}/{ckpt}").awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/answers").count() == q.count()


def test_question_stream_equals_batch(spark, tmp_dir):
    docs, cat = documents(spark, SF), catalogue(spark, SF)
    store = VectorStore(spark, f"{tmp_dir}/store", 384)
    store.create_if_absent(build_points(spark, docs, cat))
    qs = questions(spark, SF)
    rows = [r.asDict() for r in qs.collect()]
    qdir = f"{tmp_dir}/questions"
    os.makedirs(qdir)
    for i in range(2):
        with open(f"{qdir}/q{i}.json", "w") as f:
            for r in rows[i::2]:
                f.write(json.dumps(r) + "\n")
    answer_stream(spark, qdir, store, f"{tmp_dir}/answers", f"{tmp_dir}/ckpt").awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/answers").select("qid", F.md5("answer")).collect()))
    want = sorted(map(tuple, answer_questions(store.read(), qs).select("qid", F.md5("answer")).collect()))
    assert got == want and len(got) == len(rows)
