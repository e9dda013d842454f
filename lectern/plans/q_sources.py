"""Registered source queries: catalogue JSON (S1), landed text scan (S2-S4), landing
audit (S5, J4), split scan with partition pruning (S6), training corpus job (C2, K1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.plans import sqlparts as S
from lectern.plans.corpus import training_corpus
from lectern.session import scratch_dir
from lectern.sources.catalogue import read_catalogue, write_catalogue
from lectern.sources.corpus import land_text, landing_audit, read_split, save_clean, scan_text, write_split
from lectern.sources.tables import catalogue, documents

ROOT_KEY = "external_books_id"
NEW_ID_OFFSET = 1_000_000


def q01_catalogue_json(spark, sf):
    path = scratch_dir(spark, "catalogue")
    write_catalogue(catalogue(spark, sf), path, ROOT_KEY, ["entry_dup", "id"])
    cat = read_catalogue(spark, path, ROOT_KEY)
    return cat.select("id", "title", "author", "context")


def sql_q01_catalogue_json():
    return f"WITH {S.catalogue_ctes()} SELECT id, title, author, context FROM cat"


def _landed(spark, sf):
    """Every document landed as ``book_id_<id>.txt`` plus decoy JSON files (a per-language
    summary) that the extension filter must skip."""
    path = scratch_dir(spark, "landed")
    d = documents(spark, sf)
    land_text(d.select(F.col("doc_id").alias("book_id"), "text"), path)
    d.groupBy("lang").agg(F.count("*").alias("n")).write.mode("overwrite").json(f"{path}/decoy")
    return scan_text(spark, path)


def q02_text_scan(spark, sf):
    s = _landed(spark, sf)
    return s.select("book_id", F.col("file_name").endswith(".txt").alias("is_txt"),
                    F.length("text").cast("long").alias("chars"), F.md5("text").alias("md5_text"))


def sql_q02_text_scan():
    return """SELECT doc_id AS book_id, true AS is_txt, (length(text) + 1)::BIGINT AS chars,
  md5(text || chr(10)) AS md5_text FROM documents"""


def q03_landing_audit(spark, sf):
    """Catalogue = derived catalogue + the not-yet-landed new arrivals (labelled ids with
    doc_id % 100 = 99, re-keyed by +1,000,000)."""
    cat = catalogue(spark, sf)
    arrivals = (cat.filter((F.col("id") % 100 == 99) & (F.col("entry_dup") == 0))
                .withColumn("id", F.col("id") + NEW_ID_OFFSET))
    return landing_audit(cat.unionByName(arrivals), _landed(spark, sf))


def sql_q03_landing_audit():
    return f"""WITH {S.catalogue_ctes()},
ids AS (SELECT DISTINCT id FROM cat UNION SELECT id + {NEW_ID_OFFSET} FROM cat WHERE id % 100 = 99 AND entry_dup = 0)
SELECT i.id AS book_id, CASE WHEN d.doc_id IS NULL THEN 'missing' ELSE 'landed' END AS status,
  coalesce(length(d.text) + 1, 0)::BIGINT AS chars FROM ids i LEFT JOIN documents d ON d.doc_id = i.id"""


def q04_split_counts(spark, sf):
    path = scratch_dir(spark, "split")
    write_split(documents(spark, sf), path, "doc_id", 80)
    parts = [read_split(spark, path, s).groupBy("split", "lang").agg(
        F.count("*").cast("long").alias("n_docs"), F.sum("n_chars").cast("long").alias("n_chars"))
        for s in ("train", "test")]
    return parts[0].unionByName(parts[1])


def sql_q04_split_counts():
    b = "(('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 100)"
    return f"""SELECT CASE WHEN {b} < 80 THEN 'train' ELSE 'test' END AS split, lang, count(*)::BIGINT AS n_docs,
  sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY ALL"""


def q10_training_corpus(spark, sf):
    """Land, clean, save; the facts are read from the saved table."""
    t = save_clean(training_corpus(_landed(spark, sf), "book_id", "text"), scratch_dir(spark, "clean"))
    return t.select("book_id", F.col("chars_before").cast("long").alias("chars_before"),
                    F.col("chars_after").cast("long").alias("chars_after"),
                    F.col("n_sentences").cast("long").alias("n_sentences"),
                    F.col("n_tokens").cast("long").alias("n_tokens"), F.md5("clean_text").alias("md5_clean"))


def sql_q10_training_corpus():
    c = S.clean_text("t")
    return f"""SELECT book_id, (length(t))::BIGINT AS chars_before, length({c})::BIGINT AS chars_after,
  len({S.clean_sentences('t')})::BIGINT AS n_sentences, {S.token_count(c)}::BIGINT AS n_tokens, md5({c}) AS md5_clean
FROM (SELECT doc_id AS book_id, text || chr(10) AS t FROM documents)"""


QUERIES = {
    "q01_catalogue_json": (q01_catalogue_json, sql_q01_catalogue_json),
    "q02_text_scan": (q02_text_scan, sql_q02_text_scan),
    "q03_landing_audit": (q03_landing_audit, sql_q03_landing_audit),
    "q04_split_counts": (q04_split_counts, sql_q04_split_counts),
    "q10_training_corpus": (q10_training_corpus, sql_q10_training_corpus),
}
