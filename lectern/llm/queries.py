"""Queries over the training-data operators, by name: (query, DuckDB SQL or None).

Each reads its whole table through the operator with its production parameters; the SQL, where
there is one, states the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import (chat, decontaminate, exact_dedup, language_id, lexical_search, licences, minhash, ngram_join, packing,
                         prefix_trie, span_dedup, token_output, toxicity)
from lectern.sources.tables import table


_WORDS = r"""coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"""


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op1_sql() -> str:
    return f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[j:j + least(len(w), 10) - 1], ' ') AS g
       FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) t(j) WHERE len(w) > 0),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM d, (SELECT DISTINCT n FROM bw), unnest(range(1, len(w) - n + 2)) t(i)),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, g)),
cov AS (SELECT doc_id, count(DISTINCT k) AS n_hit
        FROM (SELECT DISTINCT doc_id, i, n FROM hit) h, unnest(range(i, i + n)) t(k) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS s
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)"""


def op2_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.span_digest(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("h")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chat(table(spark, sf_dir, "conversations"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_digest(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op8_sql() -> str:
    return """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_table(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicate_digest(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op12_sql() -> str:
    # crc32 bit by bit; a node is named by its smallest member and its depth
    crc = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i::INT, 1))::BIGINT)),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: xor(c // 2, 3988292384 * (c % 2)))), 4294967295::BIGINT)"""
    return fr"""
WITH own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p,
                    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {crc} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
src AS (SELECT c.conv_id, 0 AS part, p, role, text FROM c JOIN own ON own.conv_id = c.conv_id - c.conv_id % 20 AND p <= h
        UNION ALL SELECT c.conv_id, 1, p, role, text FROM c JOIN own ON own.conv_id = c.conv_id AND p > h),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS d, sha256(length(role) || ':' || role || text) AS turn,
             len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM src),
pre AS (SELECT conv_id, d, words, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS path FROM t
        UNION ALL SELECT conv_id, 0, 0, '' FROM c),
len AS (SELECT conv_id, max(d) AS size FROM pre GROUP BY conv_id),
m AS (SELECT conv_id, d, words, min(conv_id) OVER (PARTITION BY d, path) AS rep FROM pre),
n AS (SELECT rep, d, count(*) AS n_convs, min(words) AS words,
             coalesce(string_agg(CASE WHEN size = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends
      FROM m JOIN len USING (conv_id) GROUP BY rep, d),
up AS (SELECT n.rep, n.d, m.rep AS parent FROM n JOIN m ON m.conv_id = n.rep AND m.d = n.d - 1),
kids AS (SELECT parent AS rep, d - 1 AS d, count(*) AS n_children FROM up GROUP BY ALL),
sub AS (SELECT m.rep, m.d, sum((n.n_convs - 1) * n.words) AS saved, count(*) FILTER (kids.rep IS NULL) AS leaves
        FROM n LEFT JOIN kids USING (rep, d) JOIN m ON m.conv_id = n.rep AND m.d <= n.d GROUP BY m.rep, m.d)
SELECT n.rep AS conv_id, n.d AS depth, parent AS parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, leaves AS n_leaves,
       saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM n LEFT JOIN up USING (rep, d) LEFT JOIN kids USING (rep, d) JOIN sub USING (rep, d)"""


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_sql() -> str:
    term = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
    return f"""
WITH d AS (SELECT doc_id, {term} AS w FROM documents),
tot AS (SELECT count(*) FILTER (len(w) > 0) AS n_all, sum(len(w))::BIGINT AS l_all FROM d),
q AS (SELECT DISTINCT item_id, unnest({term}) AS term FROM benchmark),
tf AS (SELECT doc_id, len(w)::BIGINT AS n, term, count(*) AS tf FROM d, unnest(w) u(term) WHERE term IN (SELECT term FROM q) GROUP BY doc_id, len(w), term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * n_all + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, tot),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_all) // l_all))))::BIGINT AS score
      FROM q JOIN tf USING (term) JOIN w USING (term), tot GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 50"""


QUERIES = {
    "op1_decontamination": (op1_decontamination, op1_sql),
    "op2_span_dedup": (op2_span_dedup, None),
    "op3_ngram_jaccard_join": (op3_ngram_jaccard_join, None),
    "op4_toxicity": (op4_toxicity, None),
    "op5_chat_formatting": (op5_chat_formatting, None),
    "op6_language_id": (op6_language_id, None),
    "op7_licence_scan": (op7_licence_scan, None),
    "op8_exact_dedup": (op8_exact_dedup, op8_sql),
    "op9_token_output": (op9_token_output, None),
    "op10_best_fit_packing": (op10_best_fit_packing, None),
    "op11_minhash_near_dedup": (op11_minhash_near_dedup, None),
    "op12_prefix_trie": (op12_prefix_trie, op12_sql),
    "op13_lexical_search": (op13_lexical_search, op13_sql),
}
