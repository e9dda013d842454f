"""Feature hashing: the same vectors as the SQL definition, a token hashed once a batch."""

import hashlib

import numpy as np
import pyarrow as pa

from lectern.operators import embedding
from lectern.operators.embedding import hash_counts, hash_embed

DIM = 16


def counts(text):
    out = np.zeros(DIM)
    for t in (text or "").lower().split():
        h = hashlib.md5(t.encode()).hexdigest()
        out[int(h[:8], 16) % DIM] += 1 if h[8] < "8" else -1
    return out


def test_vectors_by_their_definition(spark):
    texts = [None, "", "...", "one", "One one two", "été Straße 日本 x1", *[" ".join(f"w{i * j % 11}" for j in range(i)) for i in range(1, 40)]]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(2)
    rows = df.select("i", hash_counts("text", DIM).alias("c"), hash_embed("text", DIM).alias("v")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.i]
        want = counts("" if text == "..." else text)
        assert r.c == want.tolist()
        norm = np.sqrt((want * want).sum())
        if norm:
            assert r.v == (want / norm).tolist()
        elif not text:
            assert r.v is None
        else:  # the whole text as one token
            assert sorted(np.abs(r.v)) == [0.0] * (DIM - 1) + [1.0]


def test_a_token_is_hashed_once_a_batch(monkeypatch):
    hashed = []
    monkeypatch.setattr(embedding, "_signed_bucket", lambda t, dim: hashed.append(t) or 1)
    out = embedding._signed_counts(pa.array([["a", "b", "a"], None, [], ["b", "b"]]), DIM)
    assert hashed == ["a", "b"] and out[:, 0].tolist() == [3, 0, 0, 2]
