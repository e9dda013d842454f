"""Metric edge cases (FIXTURES section 4) and LCS properties."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.operators.metrics import (corpus_bleu, lcs_length, rouge_lsum, score_pairs,
                                       summary_lcs_hits)


def naive_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            t[i][j] = t[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(t[i - 1][j], t[i][j - 1])
    return t[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=25), st.lists(st.sampled_from("abcde"), max_size=25))
def test_lcs_prefix_max_equals_dp(a, b):
    assert lcs_length(a, b) == naive_lcs(a, b)


def _score(spark, pairs, metrics=("rouge1", "rouge2", "rougeL", "bleu")):
    df = spark.createDataFrame(pairs, "pid int, prediction string, reference string")
    return score_pairs(df, "prediction", "reference", metrics=metrics)


def test_identical_texts_score_one(spark):
    t = "the cat sat on the mat today"
    s = _score(spark, [(1, t, t)])
    r = s.first()
    assert r.rouge1.fmeasure == 1.0 and r.rouge2.fmeasure == 1.0 and r.rougeL.fmeasure == 1.0
    b = corpus_bleu(s, "bleu_parts").first().bleu
    assert abs(b.bleu - 1.0) < 1e-12


def test_bleu_zero_without_common_4gram(spark):
    s = _score(spark, [(1, "a b c d e", "a b c x d e")], metrics=("bleu",))
    b = corpus_bleu(s, "bleu_parts").first().bleu
    assert b.precisions[3] == 0.0 and b.bleu == 0.0


def test_bleu_brevity_penalty(spark):
    s = _score(spark, [(1, "a b c d", "a b c d e f g h")], metrics=("bleu",))
    b = corpus_bleu(s, "bleu_parts").first().bleu
    import math
    assert abs(b.brevity_penalty - math.exp(1 - 8 / 4)) < 1e-12 and b.length_ratio == 0.5


def test_rouge_multiset_overlap_clips(spark):
    r = _score(spark, [(1, "a a a b", "a b b")], metrics=("rouge1",)).first().rouge1
    assert abs(r.precision - 2 / 4) < 1e-12 and abs(r.recall - 2 / 3) < 1e-12


def test_rouge_lsum_hand_case(spark):
    # union LCS over lines: ref line 1 "a b c" vs cand lines "a b", "c d" -> hits a, b, c
    hits, m, n = summary_lcs_hits([["a", "b", "c"]], [["a", "b"], ["c", "d"]])
    assert (hits, m, n) == (3, 3, 4)
    df = spark.createDataFrame([("a b\nc d", "a b c")], "p string, r string")
    got = df.select(rouge_lsum("p", "r").alias("s")).first().s
    assert abs(got.recall - 1.0) < 1e-12 and abs(got.precision - 0.75) < 1e-12


def test_shared_grams_without_folds(spark):
    rnd = random.Random(3)
    text = lambda n: None if n < 0 else " ".join(rnd.choice("abcd") for _ in range(n))
    refs = [text(n) for n in (-1, 0, 1, 3, 12, 40)]
    rows = [(i, text(n), r) for i, (r, n) in enumerate((r, n) for r in refs for n in (-1, 0, 1, 2, 9, 9, 30))]
    s = score_pairs(spark.createDataFrame(rows, "i long, prediction string, reference string").coalesce(2), metrics=("rouge1", "rouge2", "bleu"))
    for i, r1, r2, parts in s.select("i", "rouge1", "rouge2", "bleu_parts").collect():
        _, p, r = rows[i]
        if p is None or r is None:
            assert r1.precision is None and parts.m1 is None and (parts.m2, parts.m4, parts.p3 if p is None else 0) == (0, 0, 0)
            continue
        for n in range(1, 5):
            a, b = ([" ".join(t[k:k + n]) for k in range(len(t) - n + 1)] for t in (p.split(), r.split()))
            want = sum(min(a.count(g), b.count(g)) for g in set(a))
            assert (parts[f"m{n}"], parts[f"p{n}"]) == (want, len(a))
            if n < 3:
                got = (r1, r2)[n - 1]
                assert (got.precision, got.recall) == (want / max(len(a), 1), want / max(len(b), 1))
    # no fold over sorted n-gram strings, a row at a time
    assert "aggregate(" not in s._jdf.queryExecution().optimizedPlan().toString()
