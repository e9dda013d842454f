"""A single key holding a third of all rows: results stay whole, groups stay bounded."""

import glob
import json

from pyspark.sql import functions as F

from lectern.operators.joins import first_match, lookup
from lectern.operators.numbering import exclusive_offsets
from lectern.sources.catalogue import read_catalogue, write_catalogue


def _hot_catalogue(spark, n=3000, hot=7):
    rows = [((hot if i % 3 == 0 else i), f"T{i}", "A", "c", i) for i in range(n)]
    return spark.createDataFrame(rows, "id long, title string, author string, context string, pos long")


def test_catalogue_writer_splits_a_hot_id(spark, tmp_dir):
    cat = _hot_catalogue(spark)
    n = write_catalogue(cat, f"{tmp_dir}/cat", "root", ["pos"], max_entries=100)
    sizes = [len(json.load(open(f))["root"]) for f in glob.glob(f"{tmp_dir}/cat/part-*")]
    assert n == 30 and sum(sizes) == 3000 and max(sizes) <= 200
    back = read_catalogue(spark, f"{tmp_dir}/cat", "root")
    first = {r.id: r.title for r in first_match(back, "id", ["file", "pos"]).collect()}
    assert first[7] == "T0" and len(first) == 2000


def test_first_match_with_hot_key_is_reduced_before_the_shuffle(spark):
    cat = _hot_catalogue(spark).repartition(8)
    fm = first_match(cat, "id", ["pos"])
    plan = fm._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    left = spark.range(0, 3000).select(F.col("id").alias("doc_id"))
    got = lookup(left, cat, "doc_id", "id", ["pos"])
    assert got.count() == 2000 and got.filter("doc_id = 7").first().title == "T0"


def test_offsets_with_a_hot_group(spark):
    rows = [(0 if i % 3 == 0 else i % 5 + 1, i, 1) for i in range(900)]
    df = spark.createDataFrame(rows, "g long, k long, n long")
    out = exclusive_offsets(df, "k", "n", partitions=6, group="g").collect()
    by_g = {}
    for r in out:
        by_g.setdefault(r.g, []).append((r.k, r.offset))
    for g, lst in by_g.items():
        lst.sort()
        assert [o for _, o in lst] == list(range(len(lst)))  # dense within each group
