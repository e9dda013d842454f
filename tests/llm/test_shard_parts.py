"""A shard of span deduplication is settled part by part, and a worker's batches are bounded."""

import hashlib

import numpy as np
import pandas as pd

from lectern.llm import span_dedup as sd
from lectern.llm.common import squeeze


def _case(n: int = 60):
    rng = np.random.default_rng(5)
    rows, text = [], []
    for k in range(n):
        body = rng.integers(97, 123, 140, dtype=np.uint8).tobytes()
        seed = int.from_bytes(hashlib.md5(body).digest()[:8], "little")
        for doc in (k, k + n):  # each context stands in two documents
            rows.append((seed, doc, 0, 3, len(body)))
            text.append(body)
    cols = [np.array(c, t) for c, t in zip(zip(*rows), sd._SHARD)]
    return pd.DataFrame({"shard": [0], "kind": [1], "n": [len(rows)], "data": [squeeze(*cols)], "text": [b"".join(text)]})


def test_shard_is_settled_in_parts(monkeypatch):
    sizes, whole = [], sd.repeated_in_shard
    monkeypatch.setattr(sd, "repeated_in_shard", lambda *a: sizes.append(len(a[-1])) or whole(*a))
    pdf = _case()
    got = sd._shard(pdf)
    assert len(sizes) == sd.SHARD_PARTS and sum(sizes) == len(pdf["text"][0]) and max(sizes) < len(pdf["text"][0]) / 2
    assert sorted(got["doc_id"]) == list(range(60, 120))
    assert all(list(a) == [3] and list(b) == [44] for a, b in zip(got["a"], got["b"]))


def test_batches_are_bounded_by_rows_and_bytes(spark):
    from lectern.llm.common import keyed
    from lectern.session import BATCH_BYTES
    before = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")}
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
        long = spark.range(40).selectExpr("id AS doc_id", "repeat('x', 1000000) AS text").coalesce(1)

        def sizes(batches):
            for pdf in batches:
                yield pd.DataFrame({"n": [int(pdf["text"].str.len().sum())]})

        held = [r["n"] for r in keyed(long).mapInPandas(sizes, "n long").collect()]
        assert sum(held) == 40_000_000 and max(held) <= 2 * BATCH_BYTES
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
