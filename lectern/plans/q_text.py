"""Registered queries over text: cleaning, sentences, token counts, chunks (F1-F8, A1, K2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import text as TX
from lectern.operators import abbreviations as AB
from lectern.operators.chunking import chunk_documents
from lectern.plans import sqlparts as S
from lectern.session import scratch_dir
from lectern.sources.tables import documents, table

# --- fixed values: the licence block as it appears in a landed book (eight lines) ---
PREAMBLE_BLOCK_LINES = [
    "This ebook is for the use of anyone anywhere in the United States and",
    "most other parts of the world at no cost and with almost no restrictions",
    "whatsoever. You may copy it, give it away or re-use it under the terms",
    "of the Project Gutenberg License included with this ebook or online",
    "at www.gutenberg.org. If you are not located in the United States,",
    "you will have to check the laws of the country where you are located",
    "before using this eBook.",
]
TITLE_PREFIX = "The Project Gutenberg eBook of "
# ------------------------------------------------------------------------------------
BLOCK_TAIL = "".join(line + "\r\n" for line in PREAMBLE_BLOCK_LINES)
HANDLE_SUFFIX = " @été_1 "


def _with_preamble(spark, sf):
    """documents with the CRLF licence block in front for doc_id % 3 = 0."""
    d = documents(spark, sf)
    block = F.concat(F.lit(TITLE_PREFIX), F.lit("Doc "), F.col("doc_id").cast("string"), F.lit("\r\n"), F.lit(BLOCK_TAIL))
    return d.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat(block, F.col("text")))
                    .otherwise(F.col("text")).alias("text"))


def _sql_with_preamble():
    block = f"({S.lit(TITLE_PREFIX)} || 'Doc ' || doc_id::VARCHAR || {S.lit(chr(13) + chr(10))} || {S.lit(BLOCK_TAIL)})"
    return f"(SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN {block} || text ELSE text END AS text FROM documents)"


def q05_preamble(spark, sf):
    d = _with_preamble(spark, sf)
    out = TX.strip_preamble(TX.normalize_newlines("text"))
    return d.select("doc_id", F.length("text").cast("long").alias("chars_in"),
                    F.length(out).cast("long").alias("chars_out"), F.md5(out).alias("md5_out"))


def sql_q05_preamble():
    out = S.strip_preamble(S.normalize_newlines("text"))
    return f"""SELECT doc_id, length(text)::BIGINT AS chars_in, length({out})::BIGINT AS chars_out,
  md5({out}) AS md5_out FROM {_sql_with_preamble()}"""


def _with_urls(spark, sf):
    """text + ' ' + a page URL (page_id = doc_id mod the number of pages), + ' @été_1 ' for doc_id % 5 = 0."""
    d = documents(spark, sf)
    p = table(spark, sf, "pages").select("page_id", "url")
    j = d.join(p, F.pmod(d["doc_id"], F.lit(max(1, p.count()))) == p["page_id"], "left")
    txt = F.concat(F.col("text"), F.lit(" "), F.coalesce(F.col("url"), F.lit("")),
                   F.when(F.col("doc_id") % 5 == 0, F.lit(HANDLE_SUFFIX)).otherwise(F.lit("")))
    return j.select("doc_id", txt.alias("text"))


def _sql_with_urls():
    return f"""(SELECT d.doc_id, d.text || ' ' || coalesce(p.url, '') ||
  CASE WHEN d.doc_id % 5 = 0 THEN {S.lit(HANDLE_SUFFIX)} ELSE '' END AS text
  FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id % (SELECT greatest(1, count(*)) FROM pages))"""


def q06_handles_urls(spark, sf):
    d = _with_urls(spark, sf)
    out = TX.strip_handles_urls("text")
    return d.select("doc_id", F.length(out).cast("long").alias("chars_out"), F.md5(out).alias("md5_out"))


def sql_q06_handles_urls():
    out = S.strip_handles_urls("text")
    return f"SELECT doc_id, length({out})::BIGINT AS chars_out, md5({out}) AS md5_out FROM {_sql_with_urls()}"


def q07_sentences(spark, sf):
    d = documents(spark, sf)
    s = d.select("doc_id", F.posexplode(TX.clean_sentences("text")).alias("sent_no", "sentence"))
    return s.select("doc_id", F.col("sent_no").cast("long").alias("sent_no"), "sentence",
                    TX.token_count("sentence").cast("long").alias("n_tokens"))


def sql_q07_sentences():
    return f"""WITH {S.sentence_cte('sents', 'documents', 'doc_id', 'text')}
SELECT doc_id, i - 1 AS sent_no, s AS sentence, n AS n_tokens FROM sents"""


def q08_clean(spark, sf):
    d = documents(spark, sf)
    c = TX.clean_text("text")
    return d.select("doc_id", F.length(c).cast("long").alias("chars_clean"), F.md5(c).alias("md5_clean"))


def sql_q08_clean():
    c = S.clean_text("text")
    return f"SELECT doc_id, length({c})::BIGINT AS chars_clean, md5({c}) AS md5_clean FROM documents"


def q09_token_counts(spark, sf):
    d = documents(spark, sf).select("doc_id", TX.clean_sentences("text").alias("s"))
    lens = TX.sentence_lengths("s")
    return d.select("doc_id", F.size("s").cast("long").alias("n_sentences"),
                    F.aggregate(lens, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_tokens"),
                    F.coalesce(F.array_max(lens), F.lit(0)).cast("long").alias("max_sentence_tokens"))


def sql_q09_token_counts():
    return f"""WITH {S.sentence_cte('sents', 'documents', 'doc_id', 'text')}
SELECT d.doc_id, count(s.i)::BIGINT AS n_sentences, coalesce(sum(s.n), 0)::BIGINT AS n_tokens,
       coalesce(max(s.n), 0)::BIGINT AS max_sentence_tokens
FROM documents d LEFT JOIN sents s ON s.doc_id = d.doc_id GROUP BY d.doc_id"""


def q11_chunk_stats(spark, sf):
    c = chunk_documents(documents(spark, sf), "doc_id", "text", budget=512)
    return c.groupBy("doc_id").agg(
        F.count("*").cast("long").alias("n_chunks"), F.max("n_tokens").cast("long").alias("max_tokens"),
        F.sum(F.when(F.col("chunk_text") == "", 1).otherwise(0)).cast("long").alias("n_empty"),
        F.sum("n_sentences").cast("long").alias("n_sentences"))


def sql_q11_chunk_stats():
    return f"""WITH RECURSIVE {S.sentence_cte('sents', 'documents', 'doc_id', 'text')},
{S.chunk_ctes('chunks', 'sents', 512)}
SELECT doc_id, count(*)::BIGINT AS n_chunks, max(n_tokens)::BIGINT AS max_tokens,
  sum(CASE WHEN chunk_text = '' THEN 1 ELSE 0 END)::BIGINT AS n_empty, sum(n_sentences)::BIGINT AS n_sentences
FROM chunks GROUP BY doc_id"""


def q12_chunks(spark, sf):
    c = chunk_documents(documents(spark, sf), "doc_id", "text", budget=64)
    stem = F.format_string("book_id_%d", F.col("doc_id"))
    return c.select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"),
                    TX.chunk_file_name(stem, F.col("chunk_no")).alias("file_name"),
                    F.md5("chunk_text").alias("md5_text"), F.col("n_tokens").cast("long").alias("n_tokens"))


def sql_q12_chunks():
    return f"""WITH RECURSIVE {S.sentence_cte('sents', 'documents', 'doc_id', 'text')},
{S.chunk_ctes('chunks', 'sents', 64)}
SELECT doc_id, chunk_no, 'book_id_' || doc_id::VARCHAR || '_chunk_' || chunk_no::VARCHAR || '.txt' AS file_name,
  md5(chunk_text) AS md5_text, n_tokens FROM chunks"""


def _stop_counts(spark, sf):
    counts = AB.word_stops(documents(spark, sf))
    path = scratch_dir(spark, "word-stops")
    counts.write.parquet(path)
    return spark.read.schema(counts.schema).parquet(path)


def q43_abbreviations(spark, sf):
    scores = AB.stop_scores(_stop_counts(spark, sf))
    return scores.select("word", "n_word", "n_stop", F.round(F.col("score") * 1000).cast("long").alias("score_milli"), "is_abbreviation")


def _sql_scores():
    return f"""w AS (SELECT lower(regexp_replace(t, '\.$', '')) AS word, ends_with(t, '.') AS stop
  FROM (SELECT unnest({S.ws_tokens('text')}) AS t FROM documents)),
c AS (SELECT word, count(*) AS n, count(*) FILTER (WHERE stop) AS k FROM w
  WHERE regexp_matches(word, {S.lit(AB.WORD)}) GROUP BY word),
r AS (SELECT least(greatest(sum(k)::DOUBLE / sum(n), {AB.RATE_EDGE}), 1 - {AB.RATE_EDGE}) AS p FROM c),
f AS (SELECT word, n, k, length(replace(word, '.', '')) AS len, length(word) AS whole, p FROM c, r WHERE k > 0),
scores AS (SELECT word, n, k, 2 * (k * ln({AB.STOP_RATE} / p) + (n - k) * ln({1 - AB.STOP_RATE} / (1 - p)))
  * exp(-len) * (whole - len + 1) * pow(len::DOUBLE, k - n) AS score FROM f)"""


def sql_q43_abbreviations():
    return f"""WITH {_sql_scores()}
SELECT word, n::BIGINT AS n_word, k::BIGINT AS n_stop, round(score * 1000)::BIGINT AS score_milli,
  score >= {AB.LEAST_SCORE} AS is_abbreviation FROM scores"""


def q44_learnt_sentences(spark, sf):
    known = AB.stop_scores(_stop_counts(spark, sf)).filter("is_abbreviation").select("word")
    s = AB.learnt_sentences(documents(spark, sf), known)
    return s.select("doc_id", F.col("sent_no").cast("long").alias("sent_no"), F.md5("sentence").alias("md5_sentence"))


def sql_q44_learnt_sentences():
    return f"""WITH {S.sentence_cte('sents', 'documents', 'doc_id', 'text')}, {_sql_scores()},
p AS (SELECT doc_id, i, s, lower(regexp_extract(s, {S.lit(AB.LAST_WORD)}, 1)) IN (SELECT word FROM scores WHERE score >= {AB.LEAST_SCORE}) AS open FROM sents),
b AS (SELECT doc_id, i, s, CASE WHEN coalesce(lag(open) OVER (PARTITION BY doc_id ORDER BY i), false) THEN 0 ELSE 1 END AS begins FROM p),
o AS (SELECT doc_id, i, s, sum(begins) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) - 1 AS sent_no FROM b)
SELECT doc_id, sent_no::BIGINT AS sent_no, md5(string_agg(s, ' ' ORDER BY i)) AS md5_sentence FROM o GROUP BY doc_id, sent_no"""


QUERIES = {
    "q05_preamble": (q05_preamble, sql_q05_preamble),
    "q06_handles_urls": (q06_handles_urls, sql_q06_handles_urls),
    "q07_sentences": (q07_sentences, sql_q07_sentences),
    "q08_clean": (q08_clean, sql_q08_clean),
    "q09_token_counts": (q09_token_counts, sql_q09_token_counts),
    "q11_chunk_stats": (q11_chunk_stats, sql_q11_chunk_stats),
    "q12_chunks": (q12_chunks, sql_q12_chunks),
    "q43_abbreviations": (q43_abbreviations, sql_q43_abbreviations),
    "q44_learnt_sentences": (q44_learnt_sentences, sql_q44_learnt_sentences),
}
