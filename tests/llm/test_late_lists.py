"""Shingles sent late: only the lists that they change are built again."""

import random

import numpy as np
import pandas as pd
import pytest

from lectern.llm import ngram_join
from lectern.llm.common import squeeze
from tests.llm import brute
from tests.llm.fixtures import frame


def _message(rng, n, late):
    h = np.sort(rng.integers(0, 60, n)).astype(np.uint64)
    cid = rng.integers(0, 40, n).astype(np.int64)
    return {"bucket": 3, "n": n, "data": squeeze(h, cid, (cid % 5 + 10).astype(np.int32)), "late": late}


def _sums(found):
    got = {k: found[found["kind"] == k] for k in (0, 1, 2)}
    met = lambda x: {k: v for k, v in x.groupby(["a", "b"])["met"].sum().items() if v}
    return met(got[0]), set(got[1]["a"]), met(got[2])


@pytest.mark.parametrize("seed", range(5))
def test_change_of_lists(seed):
    rng = np.random.default_rng(seed)
    old = [_message(rng, 90, False), _message(rng, 60, False)]
    late = _message(rng, 30, True)
    keys = next(ngram_join._keys([pd.DataFrame([late])]))["h"].to_numpy(np.int64).view(np.uint64)
    touched = []
    for m in old:
        h, cid, size = ngram_join.expand(m["data"], m["n"], *ngram_join._POSTING)
        i = np.isin(h, keys)
        touched.append({**m, "n": int(i.sum()), "data": squeeze(h[i], cid[i], size[i])})
    own, change = ngram_join._own(4), ngram_join._own_change(4)
    step = pd.concat([own(pd.DataFrame(old)), change(pd.DataFrame([*touched, late]))])
    assert _sums(step) == _sums(own(pd.DataFrame([*old, late])))


def test_late_rounds(spark, monkeypatch):
    """Short texts send a larger part of their shingles at first, so some of their lists grow long only
    when the long texts of a group send the rest."""
    rng = random.Random(11)
    long = [f"s{i}" for i in range(200)]
    docs = [(i, " ".join(long + [f"u{i}_{j}" for j in range(40)])) for i in range(10)]
    for i in range(100, 140):
        at = rng.randrange(185)
        docs.append((i, " ".join(long[at:at + 14] + [f"x{i // 2}_{j}" for j in range(12)])))
    taken, real = [], ngram_join._changed

    def changed(*args):
        taken.append(real(*args))
        return taken[-1]

    monkeypatch.setattr(ngram_join, "_changed", changed)
    monkeypatch.setattr(ngram_join, "HOT_LEAST", 10**6)
    rows = lambda: sorted((r["doc_id"], r["component_id"]) for r in ngram_join.near_duplicates(frame(spark, docs), short_list=3).collect())
    want = sorted((d, c) for d, (_, c) in brute.components(docs).items())
    assert rows() == want
    assert any(x is not None for x in taken)
