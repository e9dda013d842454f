"""Toxic words that few documents hold each."""

import random
import zlib

import pytest

from lectern.llm import toxicity


@pytest.mark.parametrize("words, each", [(20, 30), (60, 10), (100, 6)])
def test_rare_words(spark, words, each):
    rng = random.Random(words)
    vocab = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(800)]
    bad = [f"zx{rng.choice('aeiou')}{i}q" for i in range(words)]
    marks = [b for b in bad for _ in range(each)] + [None] * (3000 - words * each)
    rng.shuffle(marks)
    docs, labels = [], []
    for i, mark in enumerate(marks):
        w = [rng.choice(vocab) for _ in range(rng.randint(30, 80))]
        if mark:
            w[rng.randrange(len(w))] = mark
        docs.append((i, " ".join(w) + "."))
        labels.append((i, int(mark is not None)))
    docs.append((9000, "b" * 30_000))  # a text without blanks is not cut short
    labels.append((9000, 0))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity_digest(df, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    held = [(t, found[i]) for i, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    caught = [p for t, p in held if t]
    wrong = [p for t, p in held if not t]
    assert sum(caught) >= 0.9 * len(caught)
    assert sum(wrong) < 0.02 * len(wrong)
