import corpus_pipeline
from lectern.llm import decontaminate, queries
from tests.llm import brute
from tests.llm.fixtures import EXTRA, awkward, corpus, frame
from tests.llm.test_tokens import check_packing

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen, parts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(f"file:{tmp_dir}/{name}")
        out = spark.read.parquet(f"file:{tmp_dir}/{name}")
        parts.append((docs, out))
        if name != "best_fit_packing":
            assert out.columns == seen
        docs = out
    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    before, after = parts[1]
    want = brute.exact(rows(before))
    assert sorted(d for d, _ in rows(after)) == sorted(d for d, v in want.items() if v[2])
    before, after = parts[2]
    want = brute.components(rows(before))
    assert sorted(d for d, _ in rows(after)) == sorted({c for _, c in want.values()})
    before, after = parts[3]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert sorted(d for d, _ in rows(after)) == sorted(x[0] for x in brute.contamination(rows(before), items) if not x[5])
    before, after = parts[4]
    check_packing(after.collect(), rows(before), 2048)
    assert corpus_pipeline.run(spark, SF).count() == after.count()


def test_queries_are_registered():
    import __spark_entry__ as e
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
    assert "pipeline" in e.queries() and set(queries.QUERIES) <= set(e.queries())
    assert decontaminate.WINDOW == 10


def _tables(spark, path, docs, labels, bench):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_awkward_tables(spark, tmp_dir):
    """Null ids and texts, repeated rows, one id with two texts, a very long text, names that the stages use."""
    docs, passage = corpus(n=20)
    rows = docs + [(d if d is None else d + 100, t) for d, t in awkward()] + [(500, passage + " very " * 60_000)]
    df = frame(spark, rows)
    _tables(spark, f"{tmp_dir}/t", df, [(1, None, None), (None, 1, 1)], [(1, passage), (None, None), (2, "")])
    found = corpus_pipeline.run(spark, f"{tmp_dir}/t")
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(found.columns)
    got = found.collect()
    kept = {r["doc_id"] for r in got}
    # copies and near copies of one text leave one document; those with the passage go
    assert not kept & {d for d, t in rows if passage in (t or "")}
    texts = {}
    for d, t in rows:
        texts.setdefault(t or "", []).append(-1 if d is None else d)
    assert all(len({-1 if k is None else k for k in kept} & set(ids)) <= 1 for t, ids in texts.items() if t.strip())
    assert all(r["offset"] + r["length"] <= 2048 for r in got)
    assert df.columns[-len(EXTRA):] == EXTRA


def test_empty_tables(spark, tmp_dir):
    df = frame(spark, [])
    _tables(spark, f"{tmp_dir}/none", df, [], [])
    assert corpus_pipeline.run(spark, f"{tmp_dir}/none").count() == 0
    one = frame(spark, [(1, None)])
    _tables(spark, f"{tmp_dir}/one", one, [], [])
    assert [(r["doc_id"], r["length"]) for r in corpus_pipeline.run(spark, f"{tmp_dir}/one").collect()] == [(1, 1)]
