"""Abbreviations learnt from the corpus and the split that uses them."""

from lectern.operators import abbreviations as AB

SCHEMA = "doc_id long, text string"


def _learnt(spark, docs):
    return AB.stop_scores(AB.word_stops(docs)).filter("is_abbreviation").select("word")


def test_learnt_and_used(spark):
    rows = [(i, f"We met Dr. Name{chr(97 + i % 26)} at the house of the old man. He went to the house, and the man left the old house.") for i in range(60)]
    docs = spark.createDataFrame(rows + [(100, None), (101, ""), (102, " Dr. ")], SCHEMA)
    words = {r["word"] for r in _learnt(spark, docs).collect()}
    assert "dr" in words and not {"man", "house"} & words
    got = {(r["doc_id"], r["sent_no"]): r["sentence"] for r in AB.learnt_sentences(docs, _learnt(spark, docs)).collect()}
    assert got[(0, 0)] == "We met Dr. Namea at the house of the old man." and (0, 2) not in got
    assert got[(102, 0)] == "Dr." and not [k for k in got if k[0] in (100, 101)]
    # the same by a shuffle join
    again = AB.learnt_sentences(docs, _learnt(spark, docs), max_bytes=-1).collect()
    assert got == {(r["doc_id"], r["sent_no"]): r["sentence"] for r in again}


def test_counts_and_no_text(spark):
    docs = spark.createDataFrame([(1, "e.g. this, E.G. that. x1. e.g it")], SCHEMA)
    got = {r["word"]: (r["n_word"], r["n_stop"]) for r in AB.word_stops(docs).collect()}
    assert got == {"e.g": (3, 2), "that": (1, 1), "it": (1, 0)}
    none = spark.createDataFrame([], SCHEMA)
    assert AB.stop_scores(AB.word_stops(none)).count() == 0
    assert AB.learnt_sentences(none, _learnt(spark, none)).count() == 0
