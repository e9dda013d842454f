import numpy as np
import pytest

from lectern.llm import exact_dedup, lyndon, ngram_join, span_dedup
from tests.llm import brute
from tests.llm.fixtures import awkward, corpus, empty, frame


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_golomb_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 100):
        d = np.diff(np.sort(rng.integers(0, 2**62, n).astype(np.uint64))) if n > 1 else np.zeros(n, np.uint64)
        k, rem, quo = exact_dedup.golomb_rice(d)
        assert (exact_dedup.golomb_rice_decode(len(d), k, rem, quo) == d).all()


def test_exact_groups(spark):
    docs, _ = corpus()
    got = {r[0]: r[1:] for r in rows(exact_dedup.exact_groups(frame(spark, docs)))}
    assert got == brute.exact(docs)


def test_exact_awkward(spark):
    df = frame(spark, awkward())
    got = rows(exact_dedup.exact_groups(df))
    assert len(got) == 8
    assert sum(r[3] for r in got if r[2] == 4) == 1  # of the four rows with one text, one stays
    kept = exact_dedup.exact_dedup(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in kept.collect()) == sorted(
        [(2, awkward()[0][1]), (3, "other words here"), (3, "yet another text of words"), (4, "")])
    assert exact_dedup.exact_groups(empty(spark)).count() == 0
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_lyndon_grouping_sorts_suffixes():
    rng = np.random.default_rng(1)
    for t in range(300):
        a = rng.integers(1, 1 + rng.integers(1, 5), rng.integers(0, 60))
        a = np.r_[np.tile(a[:5], 9) if t % 3 == 0 else a, 0]
        assert lyndon.suffix_array(a).tolist() == sorted(range(len(a)), key=lambda i: a[i:].tolist())


@pytest.mark.parametrize("hot", [200_000, 4])
def test_spans(spark, hot):
    docs, _ = corpus()
    df = frame(spark, docs)
    found = span_dedup.with_spans(df, hot_seed=hot, owner_bytes=8000, shard_bytes=4000)
    got = rows(found.mapInArrow(span_dedup._cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
    assert sorted(got) == brute.spans(docs)


def test_spans_awkward(spark):
    got = rows(span_dedup.span_digest(frame(spark, awkward())))
    assert len(got) == 8
    one = [r for r in got if r[0] == 1]
    assert one[0] == one[1] and one[0][2] == len(awkward()[0][1])  # a null id comes first, so its text stays
    null = [r for r in got if r[0] is None and r[1]]
    assert 0 < null[0][2] < null[0][1]  # the text repeats within itself
    assert span_dedup.span_digest(empty(spark)).count() == 0


@pytest.mark.parametrize("short", [32, 2])
def test_components(spark, short):
    docs, _ = corpus()
    got = {r[0]: r[1:3] for r in rows(ngram_join.near_duplicates(frame(spark, docs), short_list=short))}
    assert got == brute.components(docs)


def test_components_awkward(spark):
    got = rows(ngram_join.near_duplicates(frame(spark, awkward())).drop("h"))
    assert len(got) == 8
    assert {r[2] for r in got if r[0] in (1, 2)} == {None}  # the null id is the smallest
    assert ngram_join.near_duplicates(empty(spark)).count() == 0
    df = frame(spark, corpus()[0])
    kept = ngram_join.keep_one(df)
    want = brute.components(corpus()[0])
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in want.values()})


def test_divide_skip_counts():
    rng = np.random.default_rng(2)
    for _ in range(300):
        lists = [sorted(set(rng.integers(0, 12, rng.integers(1, 9)).tolist())) for _ in range(rng.integers(1, 9))]
        for least in range(1, len(lists) + 1):
            c = brute.Counter(x for y in lists for x in y)
            assert ngram_join.divide_skip(lists, least) == {k: v for k, v in c.items() if v >= least}
