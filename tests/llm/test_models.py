import zlib

import numpy as np
import pandas as pd
import pytest

from lectern.llm import chat, decontaminate, language_id, licences, toxicity
from tests.llm import brute
from tests.llm.fixtures import awkward, corpus, empty, frame

SF = "/root/testdata/sf0.1"


def test_contamination(spark):
    docs, passage = corpus()
    w = passage.split()
    items = [(1, " ".join(w[5:40])), (2, " ".join(w[30:60]) + " never seen words"), (3, "ab cd"), (4, None), (5, "..."), (10, " ".join(w[5:40])),
             (6, "x x x x x x x x x x x x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = frame(spark, docs)
    want = sorted(brute.contamination(docs, items))
    assert sorted(tuple(r) for r in decontaminate.contamination_digest(df, bench).collect()) == want
    # the same over several blocks of the benchmark
    many = decontaminate.contamination(df, bench, block_bytes=100).collect()
    assert sorted((r["doc_id"], r["n_words"], sum(r["ends"]) - sum(r["starts"]), len(set(r["items"]))) for r in many) == [x[:4] for x in want]
    kept = decontaminate.decontaminate(df, bench)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [x[0] for x in want if not x[5]]
    best = {(r["item_id"], r["item_word"]): r["match_words"] for r in decontaminate.longest_matches(df, bench).collect()}
    assert best["1", 0] == 35 and best["2", 0] == 30


def test_contamination_awkward(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    got = decontaminate.contamination_digest(frame(spark, awkward()), bench).collect()
    assert len(got) == 8 and sum(r["contaminated"] for r in got) == 4
    assert decontaminate.contamination_digest(empty(spark), bench).count() == 0
    assert decontaminate.contamination_digest(frame(spark, awkward()), bench.limit(0)).filter("contaminated").count() == 0


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    score, trans = rng.normal(size=5), rng.normal(size=(2, 2))
    p = toxicity.marginals(score, trans, np.array([0, 3]), np.array([3, 2]))
    for a, n in ((0, 3), (3, 2)):
        total, hit = 0.0, np.zeros(n)
        for k in range(2**n):
            y = [(k >> i) & 1 for i in range(n)]
            e = np.exp(sum(score[a + i] * y[i] for i in range(n)) + sum(trans[y[i - 1], y[i]] for i in range(1, n)))
            total += e
            hit += e * np.array(y)
        assert np.allclose(hit / total, p[a:a + n])


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity_digest(docs, labels).join(labels, "doc_id").toPandas()
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == h for i, h in zip(got["doc_id"], got["held_out"]))
    held = got[got["held_out"]]
    assert (held["toxic"] == held["predicted"]).mean() > 0.95
    assert (held[held["toxic"] == 0]["predicted"]).mean() < 0.02


def test_toxicity_awkward(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    df = frame(spark, awkward())
    got = toxicity.toxicity_digest(df, labels).collect()
    assert len(got) == 8 and all(0 <= r["score"] <= 1 for r in got)
    none = labels.limit(0)
    assert {r["score"] for r in toxicity.toxicity_digest(df, none).collect()} == {0.0}
    assert toxicity.toxicity_digest(empty(spark), labels).count() == 0
    assert toxicity.drop_toxic(df, none).columns == df.columns


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.98
    assert all((zlib.crc32(str(i).encode()) % 3 == 1) == h for i, h in zip(got["doc_id"], got["held_out"]))


def test_language_awkward(spark):
    docs = spark.createDataFrame([(i, t, l, 1) for i, (t, l) in enumerate(
        [("the cat and the dog sat", "en"), ("der hund und die katze", "de")] * 12 + [(None, "en"), ("", None), ("12 34 !", "de"), ("zzz", None)])],
        "doc_id long, text string, lang string, score int")
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    assert [got[i]["lang_pred"] for i in (24, 25, 26)] == ["und"] * 3 and got[24]["score"] == 0
    assert got[27]["lang_pred"] in ("en", "de") and got[0]["lang_pred"] == "en" and got[1]["lang_pred"] == "de"
    assert language_id.identify(docs.limit(0)).count() == 0


def test_licences(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 2000").select("doc_id", "text")
    got = licences.licence_digest(docs).join(docs, "doc_id").toPandas()
    marks = {"MIT License": "MIT", "Apache License": "Apache-2.0", "General Public": "GPL-3.0", "BY-NC": "CC-BY-NC-4.0"}
    want = [",".join(sorted({f for m, f in marks.items() if m in t})) for t in got["text"]]
    assert (got["licences"] == pd.Series(want)).mean() > 0.995
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "plain words\n\nLicensed under the Foobar Weird License, version 9."), (3, "MIT")],
                                "doc_id long, text string")
    res = sorted((r["doc_id"], r["licences"]) for r in licences.licence_digest(odd).collect())
    assert len(res) == 4 and res[0] == (1, "") and all(l != "MIT" for _, l in res)
    assert licences.licence_digest(odd.limit(0)).count() == 0


def test_repair_is_cheapest():
    rng = np.random.default_rng(3)
    for _ in range(300):
        roles = rng.integers(0, 4, rng.integers(1, 9)).tolist()
        cost, states = chat.repair(roles)
        assert cost == brute.repair_cost(roles), roles
        total, s = 0, 0
        for r, q in zip(roles, states.tolist()):
            total += int(chat.STEPS[r][s][q])
            s = q
        assert total == cost


@pytest.mark.parametrize("stretch", [1 << 12, 3])
def test_chat(spark, monkeypatch, stretch):
    monkeypatch.setattr(chat, "STRETCH", stretch)
    names = ["odd", "system", "user", "assistant"]
    rng = np.random.default_rng(5)
    convs = {c: rng.integers(0, 4, rng.integers(1, 20)).tolist() for c in range(12)}
    turns = [(c, i, names[r], f"t{c}.{i}", 0) for c, rs in convs.items() for i, r in enumerate(rs)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, seq int")
    got = chat.format_chat(df, rows=40).toPandas().sort_values("seq")
    assert len(got) == len(turns)
    for c, rs in convs.items():
        mine = got[got["conv_id"] == c]
        assert set(mine["conv_cost"]) == {brute.repair_cost(rs)}
        text = "".join(mine["rendered"])
        roles = [p.split("\n")[0] for p in text.split("<|im_start|>")[1:]]
        assert all(p.endswith("<|im_end|>\n") for p in text.split("<|im_start|>")[1:])
        body = roles[1:] if roles[0] == "system" else roles
        assert body == (["user", "assistant"] * len(body))[:len(body)]
        assert [t for t in mine["turn"]] == list(range(len(rs)))
    odd = spark.createDataFrame([(None, None, None, None), (None, 1, "Human", "x"), (1, 0, "user", "a"), (1, 0, "user", "a")],
                                "conv_id long, turn long, role string, text string")
    assert chat.format_chat(odd).count() == 4 and chat.format_chat(odd.limit(0)).count() == 0
