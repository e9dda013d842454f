"""LCS by bit rows against the full table, its memory, and the bootstrap's weights."""

import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from lectern.operators.metrics import _lcs_indices, bootstrap_means, lcs_length, poisson_weight


def table(ref, can):
    t = np.zeros((len(ref) + 1, len(can) + 1), int)
    for i in range(1, len(ref) + 1):
        for j in range(1, len(can) + 1):
            t[i, j] = t[i - 1, j - 1] + 1 if ref[i - 1] == can[j - 1] else max(t[i - 1, j], t[i, j - 1])
    return t


def walk_back(ref, can):
    t, i, j, out = table(ref, can), len(ref), len(can), []
    while i and j:
        if ref[i - 1] == can[j - 1]:
            out.append(i - 1)
            i, j = i - 1, j - 1
        elif t[i, j - 1] > t[i - 1, j]:
            j -= 1
        else:
            i -= 1
    return out[::-1]


def test_equals_the_table():
    rng = random.Random(1)
    for _ in range(1500):
        words = "abcdef"[:rng.randint(1, 6)]
        a, b = ([rng.choice(words) for _ in range(rng.randrange(25))] for _ in range(2))
        assert lcs_length(a, b) == lcs_length(b, a) == table(a, b)[-1, -1]
        assert _lcs_indices(a, b) == walk_back(a, b)


def test_long_lines_take_little_memory():
    rng = random.Random(2)
    a, b = ([f"w{rng.randrange(3000)}" for _ in range(30_000)] for _ in range(2))
    tracemalloc.start()
    n = lcs_length(a, b)
    found = _lcs_indices(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == n and peak < 200 << 20


def test_bootstrap(spark):
    df = spark.range(4000).select(F.lit("m").alias("model"), F.col("id").cast("string").alias("k"), (F.col("id") % 10 / 10.0).alias("x"))
    w = df.select(poisson_weight(F.col("k"), F.lit(3)).alias("w")).agg(F.avg("w"), F.var_pop("w")).first()
    assert abs(w[0] - 1) < 0.06 and abs(w[1] - 1) < 0.1
    r = bootstrap_means(df, "model", F.col("k"), ["x"], 100).first()
    half = 1.96 * 0.2872 / 4000 ** 0.5
    assert abs(r["x"] - 0.45) < 1e-9 and 0.6 * half < r["x"] - r["x_low"] < 1.5 * half and 0.6 * half < r["x_high"] - r["x"] < 1.5 * half
