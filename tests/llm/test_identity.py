"""Words and rows that a weak hash takes for one another."""

import numpy as np

from lectern.llm import common, decontaminate, lexical_search, minhash, ngram_join, packing, span_dedup, token_output
from tests.llm import brute
from tests.llm.fixtures import frame


def pairs():
    """Thue-Morse words and their complements, which any odd polynomial base modulo 2^64 takes for one."""
    out = []
    for size in (1024, 4096):
        bits = [bin(i).count("1") & 1 for i in range(size)]
        for lead in ("", "prefix00"):
            out.append(tuple(lead + "".join("ab"[b ^ flip] for b in bits) for flip in (0, 1)))
    return out


def test_words_differ():
    table = common.byte_table(lambda b: b != 32)
    for x, y in pairs():
        buf = np.frombuffer(f"{x} {y} {x}".encode(), np.uint8)
        s, e, h, first, h2 = common.words(buf, table, np.array([0, len(buf)]), twice=True)
        assert h[0] == h[2] != h[1] and h2[0] == h2[2] != h2[1]


def test_near_duplicates(spark):
    docs = [(2 * i + j, w) for i, p in enumerate(pairs()) for j, w in enumerate(p)]
    docs += [(50 + i, f"{w} and {w}") for i, (_, w) in enumerate(docs[:4])]
    got = {r[0]: r[1:3] for r in ngram_join.near_duplicates(frame(spark, docs)).collect()}
    assert got == brute.components(docs)
    assert {r["component_id"] for r in minhash.near_duplicates(frame(spark, docs)).collect()} == {d for d, _ in docs}


def test_contamination(spark):
    items = [(i, p[0]) for i, p in enumerate(pairs())]
    docs = [(2 * i + j, "one " + w + " two") for i, p in enumerate(pairs()) for j, w in enumerate(p)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in decontaminate.contamination_digest(frame(spark, docs), bench).collect())
    assert got == sorted(brute.contamination(docs, items)) and sum(r[5] for r in got) == 4
    found = lexical_search.search(frame(spark, docs), bench).collect()
    assert sorted((r["item_id"], r["doc_id"]) for r in found) == [(i, 2 * i) for i in range(4)]


def test_tokens(spark):
    docs = [(10 * i + j, w + tail) for i, p in enumerate(pairs()) for j, w in enumerate(p) for tail in ("",)]
    docs += [(100 + i, " ".join(p)) for i, p in enumerate(pairs())]
    want = {d: brute.ids_of(t, 1) for d, t in docs}
    got = token_output.token_table(frame(spark, docs)).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in got} == {d: (len(x), brute.crc(x)) for d, x in want.items()}
    cut = packing.pieces(frame(spark, docs)).collect()
    for r in cut:
        x = brute.ids_of(dict(docs)[r["doc_id"]], 0)[r["start"]:r["start"] + r["length"]]
        assert brute.crc(x) == r["ids_crc32"]


def test_rows_without_id(spark):
    """Rows of one id, or of none, whose texts share a 32-bit hash are rows of their own."""
    from pyspark.sql import functions as F
    words = spark.range(200_000).select(F.concat(F.lit("text number "), F.col("id").cast("string"), F.lit(" "), F.repeat(F.lit("x y "), 30)).alias("t"))
    twins = (words.groupBy(F.hash("t").alias("h")).agg(F.collect_list("t").alias("ts")).filter(F.size("ts") > 1).limit(2).collect())
    assert twins
    docs = [(None, t) for r in twins for t in r["ts"]] + [(7, t) for r in twins for t in r["ts"]]
    got = span_dedup.span_digest(frame(spark, docs)).collect()
    shared = len("x y " * 30)
    assert len(got) == len(docs)
    # every row repeats the end of one that is earlier, or within itself
    assert all(r["n_removed"] >= shared - 100 for r in got)
    assert sum(r["n_removed"] == r["n_bytes"] for r in got) == len(docs) // 2  # the rows of id 7 repeat those without one
    assert len({r["kept_sha256"] for r in got if r["doc_id"] is None}) == len(docs) // 2
