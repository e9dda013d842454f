"""Languages whose labelled texts are all long, and more languages than a full sample has."""

from lectern.llm import language_id

EN, DE = "the cat and the dog sat on the mat ", "der hund und die katze sitzen auf dem dach "


def _lang(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs).collect()}


def test_language_of_long_texts_only(spark):
    long = DE * (1 + language_id.SAMPLE_BYTES // len(DE))
    rows = [(i, EN, "en") for i in range(30)] + [(30 + i, long + DE * i, "de") for i in range(30)] + [(100, DE, None), (101, EN, None)]
    got = _lang(spark, rows)
    assert {got[i] for i in range(30)} == {"en"} and {got[30 + i] for i in range(30)} == {"de"}
    assert got[100] == "de" and got[101] == "en"


def test_long_texts_alone(spark):
    digits = "12345 " * language_id.SAMPLE_BYTES
    rows = [(i, (EN if i % 2 else DE) * 300 + digits * (i % 3 == 0), "en" if i % 2 else "de") for i in range(40)]
    assert all(v == ("en" if i % 2 else "de") for i, v in _lang(spark, rows).items())


def test_more_languages_than_the_bound(spark, monkeypatch):
    monkeypatch.setattr(language_id, "LANGUAGES", 2)
    letters = "abcdef"
    rows = [(k * 10 + i, f"{x * 3} {x * 5} " * 20, f"l{x}") for k, x in enumerate(letters) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, per_language=5)
    assert model.languages == [f"l{x}" for x in letters]
