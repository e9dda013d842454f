"""What a user's tokeniser costs is paid once, words are looked up where they are, and batches to Python are bounded."""

import pandas as pd
import pytest

from lectern.operators.chunking import chunk_documents
from lectern.operators.training import fit_vocabulary, length_batches, tokenize_batches, vocabulary_ids


def test_length_batches_tokenises_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def ids(pdf):
        seen.add(len(pdf))
        return pd.DataFrame({"doc_id": pdf["doc_id"], "ids": [[3] * (int(d) % 5) for d in pdf["doc_id"]]})

    docs = spark.range(200).selectExpr("id AS doc_id").repartition(4)
    out = length_batches(tokenize_batches(docs, ids, "doc_id long, ids array<int>"), "ids", "doc_id", 50)
    assert out.count() == 200 and out.select("batch").distinct().count() > 1
    assert seen.value == 200


def test_ids_in_place_equal_those_by_shuffle(spark):
    rows = [(1, "a b c a"), (1, "c a"), (2, None), (None, "a a"), (None, "b"), (None, "b"), (3, ""), (4, "zz a b yy"), (4, "zz a b yy")]
    docs = spark.createDataFrame(rows, "k long, text string").repartition(3)
    v = fit_vocabulary(docs, "text", 3)
    here, moved = vocabulary_ids(docs, "k", "text", v), vocabulary_ids(docs, "k", "text", v, max_bytes=0)
    assert sorted(map(str, here.collect())) == sorted(map(str, moved.collect())) and here.count() == len(rows)
    assert "posexplode" not in here._jdf.queryExecution().optimizedPlan().toString()  # no row a word


@pytest.fixture()
def wide_batches(spark):
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    had = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "10000")
    spark.conf.set(keys[1], "64m")
    yield keys
    for k, v in had.items():
        spark.conf.set(k, v)


def test_reading_a_table_bounds_batches(spark, wide_batches):
    from lectern.sources.tables import documents
    documents(spark, "/root/testdata/sf0.001")
    assert [int(spark.conf.get(k)) for k in wide_batches] == [1024, 4 << 20]


def test_chunking_bounds_batches(spark, wide_batches):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'A sentence. Another one.' AS text").coalesce(1)
    chunks = chunk_documents(docs, budget=64)
    rows = chunks.select("doc_id").mapInPandas(lambda it: (pd.DataFrame({"n": [len(p)]}) for p in it), "n long").collect()
    assert sum(r["n"] for r in rows) == 3000 and max(r["n"] for r in rows) <= 1024
