"""Upserts that touch only changed buckets, the contract while writing, and replayed loads."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from lectern.operators.store import VectorStore
from lectern.sources.tables import catalogue, documents
from lectern.streaming.incremental import load_batch

SF = "/root/testdata/sf0.001"


def points(spark, books, first_id, tag=1.0, chunks=2):
    return spark.createDataFrame([(first_id + i * chunks + c, b, c, [tag, float(c + 1)]) for i, b in enumerate(books) for c in range(chunks)],
                                 "id long, book_id long, chunk_no int, vector array<float>")


def files(store):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{store.points}/bucket=*/*.parquet")}


def test_small_delta_rewrites_its_buckets_only(spark, tmp_dir):
    s = VectorStore(spark, f"{tmp_dir}/s", 2, buckets=64)
    s.create_if_absent(points(spark, range(1000), 0))
    before = files(s)
    delta = [7, 300, 5000]
    touched = s.upsert(points(spark, delta, s.next_id(), tag=9.0))
    after = files(s)
    changed = {os.path.basename(os.path.dirname(f)) for f, _ in set(before.items()) ^ set(after.items())}
    assert changed == {f"bucket={b}" for b in touched} and 1 <= len(touched) <= 3
    rows = s.read()
    assert rows.count() == 2002 and rows.filter("vector[0] = 9").select("book_id").distinct().count() == 3
    assert rows.groupBy("id").count().filter("count > 1").count() == 0


def test_key_without_new_rows_goes(spark, tmp_dir):
    s = VectorStore(spark, f"{tmp_dir}/s", 2, buckets=8)
    s.create_if_absent(points(spark, range(3), 0))
    gone = spark.createDataFrame([(i,) for i in range(3)], "book_id long")
    s.upsert(points(spark, [], s.next_id()), replaced_keys=gone.filter("book_id < 2"))
    assert {r.book_id for r in s.read().collect()} == {2}  # buckets left empty are removed
    s.upsert(points(spark, [9], s.next_id()), replaced_keys=gone)
    assert {r.book_id for r in s.read().collect()} == {9}


def test_contract_is_checked_while_writing(spark, tmp_dir):
    s = VectorStore(spark, f"{tmp_dir}/s", 2)
    bad = points(spark, [1], 0).withColumn("vector", F.slice("vector", 1, 1))
    with pytest.raises(ValueError):
        s.create_if_absent(bad)
    assert not s.exists()
    s.create_if_absent(points(spark, range(10), 0))
    want = sorted(map(tuple, s.read().select("id", "book_id").collect()))
    same_ids = points(spark, [50, 51], 4)  # ids of books that stay
    twice = points(spark, [60], 100).unionByName(points(spark, [61], 100))
    zero = points(spark, [70], 200).withColumn("vector", F.array(F.lit(0.0), F.lit(0.0)).cast("array<float>"))
    for wrong in (bad, same_ids, twice, zero):
        with pytest.raises(ValueError):
            s.upsert(wrong)
    assert sorted(map(tuple, s.read().select("id", "book_id").collect())) == want
    assert not glob.glob(f"{tmp_dir}/s/_*")
    with pytest.raises(ValueError):
        VectorStore(spark, f"{tmp_dir}/s", 3).upsert(points(spark, [1], 900))


def test_ids_of_replaced_rows_may_come_again(spark, tmp_dir):
    s = VectorStore(spark, f"{tmp_dir}/s", 2)
    s.create_if_absent(points(spark, range(10), 0))
    s.upsert(points(spark, [3], 6, tag=5.0))  # book 3 had ids 6 and 7
    assert sorted(r.id for r in s.read().filter("vector[0] = 5").collect()) == [6, 7] and s.read().count() == 20


def test_replayed_batch_keeps_its_ids(spark, tmp_dir):
    docs = documents(spark, SF).filter("doc_id < 30").select("doc_id", "text", F.lit(1).alias("landed"))
    cat = catalogue(spark, SF)
    s = VectorStore(spark, f"{tmp_dir}/s", 384)
    load_batch(spark, docs.filter("doc_id < 10"), s, cat, "ckpt#0", budget=64)
    load_batch(spark, docs.filter("doc_id >= 10"), s, cat, "ckpt#1", budget=64)
    ids = lambda: sorted(map(tuple, s.read().select("id", "book_id", "chunk_no").collect()))
    want = ids()
    load_batch(spark, docs.filter("doc_id >= 10"), s, cat, "ckpt#1", budget=64)  # its end was not recorded
    load_batch(spark, docs.filter("doc_id < 10"), s, cat, "ckpt#0", budget=64)
    assert want and ids() == want
