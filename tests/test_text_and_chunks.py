"""Hand-computed text and chunking cases (FIXTURES section 4) and packing properties."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.functions import text as TX
from lectern.operators.chunking import chunk_bounds, chunk_documents, pack_chunks, pack_sentences


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("o")).first()["o"]


def naive_pack(lengths, budget):
    """Sequential fold exactly as described: emit on overflow even when empty."""
    chunks, cur, n = [], [], 0
    for i, ln in enumerate(lengths):
        if n + ln > budget:
            chunks.append(cur)
            cur, n = [], 0
        cur.append(i)
        n += ln
    if cur:
        chunks.append(cur)
    return chunks


def test_chunk_first_sentence_over_budget():
    out = pack_sentences(["a " * 600, "b"], [600, 10], 512)
    assert [c[0] for c in out] == ["", "a " * 600, "b"]


def test_chunk_exact_fit_is_one_chunk():
    assert len(pack_sentences(["x", "y"], [500, 12], 512)) == 1


def test_chunk_oversized_in_middle():
    out = pack_sentences(["a", "b", "c"], [10, 600, 10], 512)
    assert [c[0] for c in out] == ["a", "b", "c"]


def test_chunk_no_sentences():
    assert pack_sentences([], [], 512) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=80), max_size=60), st.integers(min_value=1, max_value=100))
def test_bounds_equal_sequential_fold(lengths, budget):
    bounds = chunk_bounds(lengths, budget)
    got = [list(range(s, e)) for s, e in bounds]
    assert got == naive_pack(lengths, budget)
    # no multi-sentence chunk exceeds the budget
    for s, e in bounds:
        if e - s > 1:
            assert sum(lengths[s:e]) <= budget


def test_pack_chunks_spark_matches_python(spark):
    rows = [(1, ["a b c.", "d e."], [3, 2]), (2, [], []), (3, ["x " * 5], [5])]
    df = spark.createDataFrame(rows, "doc_id long, sentences array<string>, lengths array<int>")
    got = sorted((r.doc_id, r.chunk_no, r.chunk_text) for r in pack_chunks(df, ["doc_id"], budget=4).collect())
    assert got == [(1, 0, "a b c."), (1, 1, "d e."), (3, 0, ""), (3, 1, "x " * 5)]


def test_nonempty_chunks_rejoin_to_clean_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ch = chunk_documents(docs, "doc_id", "text", budget=64)
    joined = (ch.filter(F.col("chunk_text") != "").groupBy("doc_id")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "chunk_text"))),
                                            lambda x: x["chunk_text"]), " ").alias("j")))
    clean = docs.select("doc_id", TX.clean_text("text").alias("c"))
    bad = joined.join(clean, "doc_id").filter(F.col("j") != F.col("c")).count()
    assert bad == 0


def test_preamble_title_without_block_unchanged(spark):
    t = "The Project Gutenberg eBook of Something\nJust a story.\n"
    assert _one(spark, lambda c: TX.strip_preamble(TX.normalize_newlines(c)), t) == t


def test_preamble_with_crlf_block_removed(spark):
    from lectern.plans.q_text import BLOCK_TAIL, TITLE_PREFIX
    t = TITLE_PREFIX + "X\r\n" + BLOCK_TAIL + "Body text."
    assert _one(spark, lambda c: TX.strip_preamble(TX.normalize_newlines(c)), t) == "Body text."


def test_email_keeps_domain_and_unicode_handle_removed(spark):
    assert _one(spark, TX.strip_handles_urls, "a@mail.example.com") == "a.example.com"
    assert _one(spark, TX.strip_handles_urls, "x @été_1 y https://a.b/c?d z") == "x  y  z"


def test_sentence_split(spark):
    got = _one(spark, TX.sentences, "  Hello there. How are you?  'Fine!' he said.\nEnd")
    assert got == ["Hello there.", "How are you?", "'Fine!'", "he said.", "End"]


def test_sentence_split_abbreviations(spark):
    t = "Mr. Smith met Dr. Jones. They talked. Mr. X left."
    got = _one(spark, lambda c: TX.sentences(c, ["Mr", "Dr"]), t)
    assert got == ["Mr. Smith met Dr. Jones.", "They talked.", "Mr. X left."]
    assert _one(spark, TX.sentences, "Mr. X left.") == ["Mr.", "X left."]


def test_pluggable_token_counter(spark):
    docs = spark.createDataFrame([(1, "a b c. d e f. g h i.")], "doc_id long, text string")
    # a counter that counts characters instead of words
    chars = lambda arr: F.transform(arr, lambda s: F.length(s))
    got = [r.chunk_text for r in chunk_documents(docs, budget=11, counter=chars).orderBy("chunk_no").collect()]
    assert got == ["a b c.", "d e f.", "g h i."]


def test_addresses_end_at_unicode_white_space(spark):
    rows = [f"see https://a.b/c{c}next words" for c in ("\u00a0", "\u3000", "\x0b", "\u2028", " ")]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = [r[0] for r in df.select(TX.strip_handles_urls("t")).collect()]
    assert got == [r.replace("https://a.b/c", "") for r in rows]


def test_mark_in_the_text_is_kept(spark):
    for text, want in [("One\u0001two. Three.", ["One\u0001two.", "Three."]),
                       ("\u0002\u0004a. b\u0002\u0003\u0001", ["\u0002\u0004a.", "b\u0002\u0003\u0001"])]:
        assert _one(spark, TX.sentences, text) == want


def test_address_ends_at_unicode_space(spark):
    for space in ("\u00a0", "\u3000", "\u000b"):
        assert _one(spark, TX.strip_handles_urls, f"see https://a.b/c{space}next") == f"see {space}next"


def test_text_whose_counts_cancel_has_a_vector(spark):
    from lectern.operators.embedding import hash_embed
    rows = [("xi xii",), ("...",), ("",), (None,)]
    got = [r["v"] for r in spark.createDataFrame(rows, "t string").select(hash_embed(F.col("t"), 384).alias("v")).collect()]
    assert [sum(x * x for x in v) for v in got[:2]] == [1.0, 1.0]
    assert got[2] is None and got[3] is None
