"""Thresholds, question blocks and stored cells of the similarity search."""

import glob

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lectern.operators import search
from lectern.operators.search import cell_index, probed_cells, top_k


def table(spark, n, dim, seed, parts=6):
    rng = np.random.default_rng(seed)
    rows = [(i, np.round(rng.normal(size=dim), 1).tolist()) for i in range(n)]  # rounded: some scores tie
    return spark.createDataFrame(rows, "id long, vector array<double>").repartition(parts), rows


def questions(spark, n, dim, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dim).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "qid long, qvec array<double>"), rows


def brute(points, qs, k):
    out = set()
    for q, v in qs:
        s = sorted((-round(float(np.dot(v, p)), search.SCORE_DIGITS), i) for i, p in points)[:k]
        out |= {(q, r, i) for r, (_, i) in enumerate(s, 1)}
    return out


def got(df):
    return {(r.qid, r["rank"], r.id) for r in df.collect()}


def test_threshold_changes_no_hit_and_bounds_the_rows(spark):
    points, rows = table(spark, 900, 6, 1, parts=40)
    qs, qrows = questions(spark, 12, 6, 2)
    want = brute(rows, qrows, 5)
    assert got(top_k(points, qs, k=5)) == want
    assert got(top_k(points, qs, k=5, first_share=8)) == want
    assert got(top_k(points, qs, k=5, first_share=2000)) == want  # no threshold is found
    # rows that leave the tasks: without a threshold k a question and partition
    bc = spark.sparkContext.broadcast({"qids": np.array([q for q, _ in qrows]), "Q": np.array([v for _, v in qrows])})
    every = points.mapInPandas(search._partial_topk(bc, 5, "id", "vector", None), search.CAND_SCHEMA).count()
    s = np.array([v for _, v in qrows]) @ np.array([v for i, v in rows]).T
    low = np.sort(s, axis=1)[:, -40]
    bc = spark.sparkContext.broadcast({"qids": np.array([q for q, _ in qrows]), "Q": np.array([v for _, v in qrows]), "least": low})
    some = points.mapInPandas(search._partial_topk(bc, 5, "id", "vector", None), search.CAND_SCHEMA).count()
    assert every == 12 * 5 * 40 and some <= 12 * 41


def test_question_blocks(spark):
    points, rows = table(spark, 300, 8, 3)
    qs, qrows = questions(spark, 50, 8, 4)
    assert got(top_k(points, qs, k=3, max_broadcast_bytes=8 * 8 * 7)) == brute(rows, qrows, 3)
    grouped = points.withColumn("g", F.col("id") % 2)
    both = qs.withColumn("g", F.explode(F.array(F.lit(0), F.lit(1))))
    found = top_k(grouped, both, k=2, group_col="g", max_broadcast_bytes=8 * 8 * 20, first_share=3)
    for g in (0, 1):
        assert got(found.filter(F.col("g") == g)) == brute([r for r in rows if r[0] % 2 == g], qrows, 2)


def test_stored_cells(spark, tmp_dir):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(10, 12)) * 4
    rows = [(i, (centers[i % 10] + rng.normal(size=12)).tolist()) for i in range(600)]
    points = spark.createDataFrame(rows, "id long, vector array<double>").repartition(4)
    qs = spark.createDataFrame([(i, rows[i][1]) for i in range(0, 600, 50)], "qid long, qvec array<double>")
    stored, cells = cell_index(points, f"{tmp_dir}/cells", n_cells=20, nprobe=5)
    assert len(glob.glob(f"{tmp_dir}/cells/cell=*")) <= 20 and stored.count() == 600
    # every point is in the cell of its nearest centre, and hits are exact within the probed cells
    c = cells["centers"] / np.linalg.norm(cells["centers"], axis=1, keepdims=True)
    V = np.array([v for _, v in rows])
    V /= np.linalg.norm(V, axis=1, keepdims=True)
    cell = dict(stored.select("id", "cell").collect())
    assert [cell[i] for i in range(600)] == np.round(V @ c.T, 9).argmax(1).tolist()
    probed = pd.DataFrame([tuple(r) for r in probed_cells(qs, cells).collect()], columns=["qid", "cell"]).groupby("qid")["cell"].apply(set)
    assert all(len(p) == 5 for p in probed)
    hits = got(top_k(stored, qs, k=4, cells=cells))
    want = set()
    for q, v in qs.collect():
        want |= brute([r for r in rows if cell[r[0]] in probed[q]], [(q, v)], 4)
    assert hits == want
    exact = got(top_k(points, qs, k=4))
    assert len({(q, i) for q, _, i in hits} & {(q, i) for q, _, i in exact}) >= 0.9 * len(exact)
    sizes = pd.Series(cell).value_counts()
    assert sum(sizes[list(p)].sum() for p in probed) < 0.4 * 600 * len(probed)
    # a search reads the folders of the probed cells only
    one = qs.limit(1)
    plan = top_k(stored, one, k=4, cells=cells)._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "cell" in plan.split("PartitionFilters")[1][:200]
