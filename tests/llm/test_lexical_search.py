"""Lexical search against scores by the formula."""

import math
import random
import re
from collections import Counter

import pytest

from lectern.llm import lexical_search
from tests.llm.brute import LOWER
from tests.llm.fixtures import awkward, corpus, empty, frame


def brute(docs, items, k):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    bags = [(d, Counter(cut(t))) for d, t in docs]
    size = [sum(b.values()) for _, b in bags]
    n_all, l_all = sum(s > 0 for s in size), sum(size)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for (d, b), n in zip(bags, size):
            m = 100 - 50 + (50 * n * n_all) // max(1, l_all)
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 20 * m))
                    for t in set(cut(text)) if t in b)
            if s > 0:
                scores.append((-s, d is not None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def items_frame(spark, items):
    return spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, score long, doc_id long")


def search(spark, docs, items, **options):
    found = lexical_search.search(frame(spark, docs), items_frame(spark, items), **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("sketch", [1 << 16, 32])
def test_search(spark, monkeypatch, sketch):
    monkeypatch.setattr(lexical_search, "SKETCH", sketch)
    monkeypatch.setattr(lexical_search, "LOOKUP", 16)
    monkeypatch.setattr(lexical_search, "PACK", 3000)
    docs, passage = corpus(n=120)
    docs += [(500 + i, "tie word " * 3) for i in range(12)] + [(600, "often " * 400)]
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice((docs[rng.randrange(100)][1] or "x").split() or ["x"]) for _ in range(12))) for i in range(8)]
    items += [(20, passage), (21, ""), (22, None), (23, "tie WORD often unheard"), (23, "tie"), (None, passage[:40])]
    assert search(spark, docs, items, k=5) == brute(docs, items, 5)


def test_blocks_and_top(spark):
    docs, passage = corpus(seed=8, n=70)
    items = [(i, docs[i][1][:80]) for i in range(12)] + [(30, passage)]
    assert search(spark, docs, items, block_bytes=400) == brute(docs, items, 50)


def test_awkward(spark):
    items = [(1, "one two"), (1, "one two"), (2, "other")]
    assert search(spark, awkward(), items, k=3) == brute(awkward(), items, 3)
    assert lexical_search.search(empty(spark), items_frame(spark, items)).count() == 0
    assert lexical_search.search(frame(spark, awkward()), items_frame(spark, [])).count() == 0
