"""b-bit MinHash near-dedup against the exact components, and its estimate."""

import random

import numpy as np

from lectern.llm import families, minhash
from tests.llm.brute import LOWER
from tests.llm.fixtures import awkward, corpus, empty, frame


def shingles(t):
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()


def brute(docs):
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((d, len(sets[d]), find(d), find(d) == d) for d in ids)


def group(seed, n, start):
    """Copies of one text with more and more words changed: some link only through others."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(4000)}" for _ in range(150)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(12)):
            w[rng.randrange(150)] = f"v{rng.randrange(9)}"
        out.append((start + i, " ".join(w)))
    return out


def test_components(spark, monkeypatch):
    monkeypatch.setattr(families, "ASKERS", 16)
    monkeypatch.setattr(families, "MEMBERS", 32)
    docs = corpus()[0] + group(1, 150, 1000) + group(2, 40, 2000) + [(3000, "two words"), (3001, "TWO  words"), (3002, "two")]
    want = brute(docs)
    assert len({c for *_, c, _ in want if c >= 1000}) > 10 and sum(c != d for d, _, c, _ in want) > 60
    assert sorted(tuple(r) for r in minhash.near_duplicate_digest(frame(spark, docs)).collect()) == want
    kept = minhash.keep_one(frame(spark, docs))
    assert kept.columns == frame(spark, docs).columns and sorted(r["doc_id"] for r in kept.collect()) == [d for d, _, _, k in want if k]


def test_estimate():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(60):
        both = rng.integers(0, 2**64, 400, np.uint64)
        x, y = (np.unique(np.append(both, rng.integers(0, 2**64, k, np.uint64))) for k in rng.integers(0, 300, 2))
        true = len(both) / (len(x) + len(y) - len(both))
        sig = minhash.signature(minhash.minima([x, y]))
        errors.append(minhash.estimates(sig[0], sig[1:])[0] - true)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    assert minhash.estimates(sig[0], sig[:1])[0] == 1


def test_bands_find_links():
    """The share of pairs of the least similarity that no band shows."""
    rng = np.random.default_rng(1)
    missed = 0
    for _ in range(300):
        both = rng.integers(0, 2**64, 170, np.uint64)
        x, y = (np.unique(np.append(both, rng.integers(0, 2**64, 15, np.uint64))) for _ in range(2))  # 170 / 200
        m = minhash.minima([x, y])
        keys = minhash.band_keys(m)
        sig = minhash.signature(m)
        missed += not (keys[0] == keys[1]).any() or minhash.estimates(sig[0], sig[1:])[0] < minhash.ESTIMATE
    assert missed <= 1


def test_estimate_column(spark):
    rng = np.random.default_rng(2)
    sig = minhash.signature(minhash.minima([rng.integers(0, 2**64, 50, np.uint64) for _ in range(2)]))
    df = spark.createDataFrame([(sig[0].view(np.int64).tolist(), sig[1].view(np.int64).tolist())], "x array<long>, y array<long>")
    from pyspark.sql import functions as F
    assert abs(df.select(minhash.estimate_column(F.col("x"), F.col("y"))).first()[0] - minhash.estimates(sig[0], sig[1:])[0]) < 1e-12


def test_awkward(spark):
    got = [tuple(r) for r in minhash.near_duplicate_digest(frame(spark, awkward())).collect()]
    assert len(got) == 8
    assert {r[2] for r in got if r[0] in (1, 2)} == {None}  # the null id is the smallest
    assert all(r[3] for r in got if r[0] is None) and not any(r[3] for r in got if r[0] in (1, 2))
    assert minhash.near_duplicate_digest(empty(spark)).count() == 0
