"""Every link of a group of near copies, not only a tree of them."""

import random

import pytest

from lectern.llm import ngram_join
from tests.llm import brute
from tests.llm.fixtures import frame


@pytest.mark.parametrize("short_list", [4, ngram_join.SHORT_LIST])
def test_all_links(spark, monkeypatch, short_list):
    monkeypatch.setattr(ngram_join, "BLOCK_PAIRS", 64)
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    docs = []
    for i in range(90):
        w = list(base[:100 + rng.randrange(20)])
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    docs += [(200 + i, " ".join(f"u{rng.randrange(300)}" for _ in range(40))) for i in range(20)] + [(300, docs[0][1]), (301, "")]
    sets = {}
    for d, t in docs:
        x = frozenset(brute.shingles(t))
        if x:
            sets[x] = min(d, sets.get(x, d))
    want = sorted((min(d, e), max(d, e)) for x, d in sets.items() for y, e in sets.items()
                  if d < e and 100 * len(x & y) >= 80 * len(x | y))
    got = sorted(tuple(r) for r in ngram_join.links(frame(spark, docs), short_list=short_list).collect())
    assert len(want) > 300 and got == want
    same = [sorted((r["doc_id"], r["component_id"]) for r in ngram_join.near_duplicates(frame(spark, docs), short_list=short_list, full=f).collect())
            for f in (False, True)]
    assert same[0] == same[1]
