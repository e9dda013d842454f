"""abbreviations learnt from the corpus, and a sentence split that uses them.

A word that nearly always carries a full stop, more often than chance explains, is an
abbreviation (log-likelihood ratio of word and full stop, less for long words and for each
occurrence without the stop).  Words are counted by one aggregation with a map-side combine;
only the two totals reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import clean_sentences, ws_tokens

#: letters, also several runs with full stops between them
WORD = r"^\p{L}+(\.\p{L}+)*$"
LAST_WORD = r"([^ \t\n\r\f]+)\.$"
#: rates of a full stop after an abbreviation, and the least score of one
STOP_RATE, LEAST_SCORE = 0.99, 0.3
#: a rate of stops among all words is kept this far from 0 and 1
RATE_EDGE = 1e-6


def word_stops(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n_word, n_stop): occurrences of each lower-cased word, and those with a full stop behind."""
    t = texts.select(F.explode(ws_tokens(text_col)).alias("t"))
    w = t.select(F.lower(F.regexp_replace("t", r"\.$", "")).alias("word"), F.col("t").endswith(".").alias("stop"))
    return w.filter(F.col("word").rlike(WORD)).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_word"), F.sum(F.col("stop").cast("long")).alias("n_stop"))


def stop_scores(counts: DataFrame) -> DataFrame:
    """``counts`` (written, as it is read twice) of words met with a full stop: score, is_abbreviation."""
    total = counts.agg(F.sum("n_word").alias("n"), F.sum("n_stop").alias("k")).first()
    rate = min(max((total["k"] or 0) / max(1, total["n"] or 0), RATE_EDGE), 1 - RATE_EDGE)
    bare, letters = F.col("n_word") - F.col("n_stop"), F.length(F.replace("word", F.lit("."), F.lit("")))
    ratio = 2 * (F.col("n_stop") * F.log(F.lit(STOP_RATE / rate)) + bare * F.log(F.lit((1 - STOP_RATE) / (1 - rate))))
    stops = F.length("word") - letters + 1
    score = ratio * F.exp(-letters) * stops * F.pow(letters.cast("double"), -bare)
    return counts.filter("n_stop > 0").withColumn("score", score).withColumn("is_abbreviation", F.col("score") >= LEAST_SCORE)


def learnt_sentences(docs: DataFrame, abbreviations: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     max_bytes: int = 64 << 20) -> DataFrame:
    """(id, sent_no, sentence): pieces of the rule-based split, joined where the first ends in one of ``abbreviations`` (word).

    The list is broadcast only under its counted bytes, else both sides shuffle.  Null and blank
    texts have no sentences."""
    size = abbreviations.agg(F.sum(F.octet_length("word") + 48)).first()[0] or 0
    known = abbreviations.select("word", F.lit(True).alias("open"))
    pieces = docs.select(F.col(id_col), F.posexplode(clean_sentences(text_col)).alias("i", "s"))
    pieces = pieces.withColumn("word", F.lower(F.regexp_extract("s", LAST_WORD, 1)))
    pieces = pieces.join(F.broadcast(known) if size <= max_bytes else known, "word", "left")
    order = Window.partitionBy(id_col).orderBy("i")
    begins = F.when(F.coalesce(F.lag("open").over(order), F.lit(False)), 0).otherwise(1)
    numbered = (pieces.withColumn("begins", begins)
                .withColumn("sent_no", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1))
    parts = F.array_sort(F.collect_list(F.struct("i", "s")))
    return numbered.groupBy(id_col, "sent_no").agg(F.array_join(F.transform(parts, lambda p: p["s"]), " ").alias("sentence"))
