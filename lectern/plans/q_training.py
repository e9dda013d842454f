"""Registered training-row queries (V5-V10, U1, P1, P6, R6, B1, C2 output side)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from lectern.functions.text import NON_WS_RUN, clean_text
from lectern.operators.numbering import batch_number, exclusive_offsets
from lectern.operators.training import (EOS, FIRST_ID, FIRST_WORD, IGNORE, PAD, UNKNOWN, VOCAB, attention_mask, book_rows,
                                        collate_causal, concat_rows, encode, fit_vocabulary, length_batches, pad_to_batch_longest,
                                        padding, seq2seq_rows, token_ids, tokenize_batches, vocabulary_ids, written)
from lectern.plans import sqlparts as S
from lectern.sources.tables import documents, metric_pairs


def _md5_ints(c):
    return F.md5(F.array_join(F.transform(c, lambda x: x.cast("string")), ","))


def _clean_docs(spark, sf):
    return documents(spark, sf).select("doc_id", clean_text("text").alias("text"))


def q27_training_rows(spark, sf):
    """Causal rows (labels = inputs) and the seq2seq 150-token labels of the same text,
    from one tokenisation per document."""
    d = _clean_docs(spark, sf).withColumn("_ids", token_ids("text"))
    rows = d.select("doc_id", encode("_ids", 512).alias("input_ids"), encode("_ids", 150).alias("labels150"))
    rows = rows.withColumn("attention_mask", attention_mask("input_ids")).withColumn("labels", F.col("input_ids"))
    return rows.select("doc_id",
                       F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("input_real"),
                       _md5_ints(F.col("input_ids")).alias("input_md5"), _md5_ints(F.col("labels")).alias("labels_md5"),
                       _md5_ints(F.col("labels150")).alias("labels150_md5"),
                       F.size(F.filter("labels150", lambda x: x != PAD)).cast("long").alias("labels150_real"))


def _sql_ids(text):
    return (f"list_transform({S.ws_tokens(text)}, lambda w: "
            f"(('0x' || substr(md5(w), 1, 8))::BIGINT % {VOCAB - FIRST_ID}) + {FIRST_ID})")


def _sql_enc(ids, n):
    return f"list_resize(list_concat(list_slice({ids}, 1, {n - 1}), [{EOS}]), {n}, {PAD})"


def _sql_md5(lst):
    return f"md5(array_to_string({lst}, ','))"


def sql_q27_training_rows():
    return f"""WITH d AS (SELECT doc_id, {_sql_ids(S.clean_text('text'))} AS ids FROM documents),
e AS (SELECT doc_id, {_sql_enc('ids', 512)} AS inp, {_sql_enc('ids', 150)} AS lab FROM d)
SELECT doc_id, len(list_filter(inp, lambda x: x <> {PAD}))::BIGINT AS input_real, {_sql_md5('inp')} AS input_md5,
  {_sql_md5('inp')} AS labels_md5, {_sql_md5('lab')} AS labels150_md5,
  len(list_filter(lab, lambda x: x <> {PAD}))::BIGINT AS labels150_real FROM e"""


def q28_mixed_rows(spark, sf):
    """Book rows (labels = inputs) UNION pair rows (chapter -> summary, labels 150);
    the pair side keeps its source columns, then the causal collator masks padding."""
    books = book_rows(_clean_docs(spark, sf).withColumnRenamed("doc_id", "key"), "text", 512)
    books = books.withColumn("source", F.lit("book"))
    p = metric_pairs(spark, sf).select((F.col("conv_id") * 100 + F.col("turn")).alias("key"),
                                       F.col("prediction").alias("chapter"), F.col("reference").alias("summary_text"))
    pairs = seq2seq_rows(p, "chapter", "summary_text", 512, 150).withColumn("source", F.lit("pair"))
    rows = concat_rows(books, pairs).withColumn("collated", collate_causal("input_ids"))
    return rows.select("source", F.col("key").cast("long").alias("key"), _md5_ints(F.col("input_ids")).alias("input_md5"),
                       _md5_ints(F.col("labels")).alias("labels_md5"),
                       F.size(F.filter("collated", lambda x: x == IGNORE)).cast("long").alias("n_ignored"),
                       F.col("chapter").isNotNull().alias("has_chapter"))


def sql_q28_mixed_rows():
    return f"""WITH b AS (SELECT doc_id AS key, {_sql_enc(_sql_ids(S.clean_text('text')), 512)} AS inp FROM documents),
p AS (
  SELECT u.conv_id * 100 + u.turn AS key, u.text AS chapter, a.text AS summary_text
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'
),
pe AS (SELECT key, chapter, {_sql_enc(_sql_ids('chapter'), 512)} AS inp, {_sql_enc(_sql_ids('summary_text'), 150)} AS lab FROM p),
u AS (
  SELECT 'book' AS source, key, inp, inp AS lab, NULL AS chapter FROM b
  UNION ALL SELECT 'pair', key, inp, lab, chapter FROM pe
)
SELECT source, key::BIGINT AS key, {_sql_md5('inp')} AS input_md5, {_sql_md5('lab')} AS labels_md5,
  len(list_filter(inp, lambda x: x = {PAD}))::BIGINT AS n_ignored, chapter IS NOT NULL AS has_chapter FROM u"""


BATCH_TOKENS = 8192
FIXED_BATCH = 16


def _hashed_ids(pdf):
    """A user's batched map: word ids of a column batch."""
    import hashlib

    known: dict[str, int] = {}  # of this batch

    def one(text):
        words = re.findall(NON_WS_RUN, text)
        for w in words:
            if w not in known:
                known[w] = int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % (VOCAB - FIRST_ID) + FIRST_ID
        return [known[w] for w in words]
    return pdf.assign(ids=[one(t) for t in pdf["text"]])[["doc_id", "ids"]]


def _tokenised(spark, sf):
    return tokenize_batches(_clean_docs(spark, sf), _hashed_ids, "doc_id long, ids array<int>")


def q39_length_batches(spark, sf):
    """B1 and V6 with batch-longest padding: a user's map tokenises column batches; rows of near-equal
    length are batched by a token budget and padded to the longest of their batch."""
    b = length_batches(_tokenised(spark, sf), "ids", "doc_id", BATCH_TOKENS)
    p = pad_to_batch_longest(b, "ids", "batch")
    return p.select("doc_id", "batch", "n_tokens", F.size("input_ids").cast("long").alias("padded"),
                    _md5_ints(F.col("input_ids")).alias("input_md5"),
                    F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("real"))


def _sql_batches():
    return f"""d AS (SELECT doc_id, {_sql_ids(S.clean_text('text'))} AS ids FROM documents),
n AS (SELECT doc_id, list_concat(list_slice(ids, 1, 511), [{EOS}]) AS body, least(len(ids), 511) + 1 AS n_tokens FROM d),
b AS MATERIALIZED (SELECT *, coalesce(sum(n_tokens) OVER (ORDER BY n_tokens, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {BATCH_TOKENS} AS batch,
  (row_number() OVER (ORDER BY doc_id) - 1) // {FIXED_BATCH} AS fixed FROM n)"""


def sql_q39_length_batches():
    return f"""WITH {_sql_batches()},
p AS (SELECT *, max(n_tokens) OVER (PARTITION BY batch) AS padded FROM b),
e AS (SELECT *, list_resize(body, padded, {PAD}) AS inp FROM p)
SELECT doc_id, batch::BIGINT AS batch, n_tokens::BIGINT AS n_tokens, padded::BIGINT AS padded, {_sql_md5('inp')} AS input_md5,
  len(list_filter(inp, lambda x: x <> {PAD}))::BIGINT AS real FROM e"""


def q40_padding_share(spark, sf):
    """Padding of batches by length against batches of 16 rows in order of doc_id."""
    by_length = written(length_batches(_tokenised(spark, sf), "ids", "doc_id", BATCH_TOKENS).select("doc_id", "n_tokens", "batch"), "batches")
    ones = exclusive_offsets(by_length.select("doc_id", "n_tokens").withColumn("one", F.lit(1).cast("long")), "doc_id", "one")
    fixed = ones.select("n_tokens", batch_number("offset", FIXED_BATCH).alias("batch"))
    both = [padding(x).withColumn("scheme", F.lit(name)) for name, x in (("by_length", by_length), ("fixed", fixed))]
    return both[0].unionByName(both[1]).select("scheme", *[F.col(c).cast("long").alias(c) for c in ("batches", "tokens", "padding")],
                                               F.round(F.col("padding") / (F.col("padding") + F.col("tokens")), 9).alias("share"))


def sql_q40_padding_share():
    one = lambda name, key: (f"SELECT '{name}' AS scheme, count(*) AS batches, sum(t) AS tokens, sum(r * m - t) AS padding FROM "  # noqa: E731
                             f"(SELECT {key}, count(*) AS r, sum(n_tokens) AS t, max(n_tokens) AS m FROM b GROUP BY {key})")
    return f"""WITH {_sql_batches()}
SELECT scheme, batches::BIGINT AS batches, tokens::BIGINT AS tokens, padding::BIGINT AS padding, round(padding / (padding + tokens), 9) AS share
FROM ({one('by_length', 'batch')} UNION ALL {one('fixed', 'fixed')})"""


VOCABULARY = 5000


def q41_vocabulary_ids(spark, sf):
    """V5 with a fitted vocabulary: the most frequent words of the cleaned corpus by rank; words outside it
    have one id."""
    d = written(_clean_docs(spark, sf), "clean")  # read twice: for the vocabulary and for the ids
    ids = vocabulary_ids(d, "doc_id", "text", fit_vocabulary(d, "text", VOCABULARY))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_ids"), _md5_ints(F.col("ids")).alias("ids_md5"),
                      F.size(F.filter("ids", lambda x: x == UNKNOWN)).cast("long").alias("n_unknown"))


def sql_q41_vocabulary_ids():
    return f"""WITH d AS MATERIALIZED (SELECT doc_id, {S.ws_tokens(S.clean_text('text'))} AS w FROM documents),
t AS MATERIALIZED (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
v AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) + {FIRST_WORD - 1} AS id FROM (SELECT word, count(*) AS n FROM t GROUP BY word)
  QUALIFY row_number() OVER (ORDER BY n DESC, word) <= {VOCABULARY}),
x AS (SELECT doc_id, list(coalesce(v.id, {UNKNOWN}) ORDER BY i) AS ids FROM t LEFT JOIN v USING (word) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(ids), 0)::BIGINT AS n_ids, {_sql_md5("coalesce(ids, [])")} AS ids_md5,
  coalesce(len(list_filter(ids, lambda y: y = {UNKNOWN})), 0)::BIGINT AS n_unknown FROM d LEFT JOIN x USING (doc_id)"""


QUERIES = {
    "q39_length_batches": (q39_length_batches, sql_q39_length_batches),
    "q40_padding_share": (q40_padding_share, sql_q40_padding_share),
    "q41_vocabulary_ids": (q41_vocabulary_ids, sql_q41_vocabulary_ids),
    "q27_training_rows": (q27_training_rows, sql_q27_training_rows),
    "q28_mixed_rows": (q28_mixed_rows, sql_q28_mixed_rows),
}
