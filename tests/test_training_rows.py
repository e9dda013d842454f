"""Batches by length, fitted vocabulary, bucketed lookup and chunks handed on early."""

from collections import Counter

from pyspark.sql import functions as F

from lectern.operators import chunking
from lectern.operators.joins import bucketed_lookup, save_bucketed
from lectern.operators.training import (FIRST_WORD, UNKNOWN, fit_vocabulary, length_batches, pad_to_batch_longest, padding,
                                        vocabulary_ids)


def test_batches_of_near_equal_length(spark):
    rows = [(i, list(range(3, 3 + (i * 37) % 90))) for i in range(200)] + [(900, []), (901, list(range(3, 603)))]
    b = length_batches(spark.createDataFrame(rows, "k long, ids array<int>"), "ids", "k", 400, max_len=128)
    got = [(r.n_tokens, r.k, r.batch) for r in b.collect()]
    want, before = [], 0
    for n, k in sorted((min(len(x), 127) + 1, k) for k, x in rows):
        want.append((n, k, before // 400))
        before += n
    assert sorted(got) == want
    p = pad_to_batch_longest(b, "ids", "batch", 128).collect()
    longest = {}
    for n, _, x in want:
        longest[x] = max(n, longest.get(x, 0))
    assert all(len(r.input_ids) == longest[r.batch] and sum(r.attention_mask) == r.n_tokens for r in p)
    whole = padding(b).first()
    assert whole["tokens"] == sum(n for n, _, _ in want) and whole["padding"] == sum(longest[x] - n for n, _, x in want)
    fixed = padding(b.withColumn("batch", F.floor(F.col("k") / 4))).first()
    assert whole["padding"] < 0.3 * fixed["padding"]


def test_vocabulary(spark):
    texts = [(1, "b a a c"), (2, "a  d\nb"), (3, ""), (4, None), (5, "z z z z q")]
    df = spark.createDataFrame(texts, "k long, text string")
    v = fit_vocabulary(df, "text", 3)
    counts = Counter(w for _, t in texts for w in (t or "").split())
    top = sorted(counts, key=lambda w: (-counts[w], w))[:3]
    assert [(r.word, r.word_id) for r in v.orderBy("word_id").collect()] == [(w, i + FIRST_WORD) for i, w in enumerate(top)]
    want = {k: [top.index(w) + FIRST_WORD if w in top else UNKNOWN for w in (t or "").split()] for k, t in texts}
    for bound in (64 << 20, 0):  # broadcast, and shuffled
        assert {r.k: list(r.ids) for r in vocabulary_ids(df, "k", "text", v, bound).collect()} == want


def test_bucketed_lookup_moves_nothing(spark):
    chunks = save_bucketed(spark.range(300).selectExpr("id % 40 AS doc_id", "id AS chunk"), "doc_id", 4)
    cat = save_bucketed(spark.range(60).selectExpr("id % 30 AS doc_id", "id AS pos", "concat('t', id) AS title"), "doc_id", 4)
    j = bucketed_lookup(chunks, cat, "doc_id", ["pos"])
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert {(r.doc_id, r.title) for r in j.collect()} == {(i, f"t{i}") for i in range(30)}
    assert j.count() == sum(1 for i in range(300) if i % 40 < 30)


def test_chunks_are_handed_on(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"One two three {i}. Four five. Six.") for i in range(50)], "doc_id long, text string").coalesce(1)
    every = lambda: sorted(tuple(r) for r in chunking.chunk_documents(docs, budget=4).collect())
    want = every()
    monkeypatch.setattr(chunking, "HELD_TOKENS", 10)
    assert every() == want and len(want) == 100
