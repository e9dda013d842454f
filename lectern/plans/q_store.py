"""Registered queries over the keyed vector table: contract check (K3) and upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators.store import VectorStore, contract_report
from lectern.plans import sqlparts as S
from lectern.plans.answers import retrieve
from lectern.plans.corpus import build_points
from lectern.session import scratch_dir
from lectern.sources.tables import catalogue, catalogue_of, documents, questions, table

DIM = 384
EMB_DIM = 64
REVISION_SUFFIX = " (rev 2)"
NEW_ID_OFFSET = 1_000_000


def q18_contract(spark, sf):
    """Contract of the ``embeddings`` collection (dim 64) with one bad-dimension row and
    one null row derived from vec_id 0."""
    emb = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    seed = emb.filter(F.col("id") == 0)
    bad = seed.select(F.lit(-1).cast("long").alias("id"), F.slice("vector", 1, EMB_DIM - 1).alias("vector"))
    nul = seed.select(F.lit(-2).cast("long").alias("id"), F.lit(None).cast("array<float>").alias("vector"))
    return contract_report(emb.unionByName(bad).unionByName(nul), EMB_DIM)


def sql_q18_contract():
    return f"""WITH e AS (
  SELECT vec_id AS id, embedding AS v FROM embeddings
  UNION ALL SELECT -1, list_slice(embedding, 1, {EMB_DIM - 1}) FROM embeddings WHERE vec_id = 0
  UNION ALL SELECT -2, NULL FROM embeddings WHERE vec_id = 0
),
k AS (SELECT CASE WHEN v IS NULL THEN 'null_vector' WHEN len(v) <> {EMB_DIM} THEN 'bad_dimension'
  WHEN list_dot_product(v::DOUBLE[], v::DOUBLE[]) = 0 THEN 'zero_norm' ELSE 'ok' END AS kind FROM e),
kinds AS (SELECT unnest(['ok', 'null_vector', 'bad_dimension', 'zero_norm']) AS kind)
SELECT kinds.kind, (SELECT count(*) FROM k WHERE k.kind = kinds.kind)::BIGINT AS n_rows FROM kinds
UNION ALL
SELECT 'duplicate_id', coalesce(sum(c), 0)::BIGINT FROM (SELECT id, count(*) AS c FROM e GROUP BY id HAVING count(*) > 1)"""


def _delta_documents(spark, sf):
    """Revised documents (doc_id % 10 = 0 get ' (rev 2)') and new arrivals
    (doc_id % 100 = 99 re-keyed by +1,000,000)."""
    d = documents(spark, sf)
    rev = d.filter(F.col("doc_id") % 10 == 0).withColumn("text", F.concat("text", F.lit(REVISION_SUFFIX)))
    new = d.filter(F.col("doc_id") % 100 == 99).withColumn("doc_id", F.col("doc_id") + NEW_ID_OFFSET)
    return rev.unionByName(new)


def _upserted(spark, sf) -> VectorStore:
    """C1 + K4: build the collection, then upsert the delta."""
    store = VectorStore(spark, scratch_dir(spark, "store"), DIM)
    docs = documents(spark, sf)
    store.create_if_absent(build_points(spark, docs, catalogue(spark, sf), dim=DIM, materialize=False))
    delta = _delta_documents(spark, sf)
    labelled = table(spark, sf, "labels").select("doc_id")
    new_lab = labelled.select((F.col("doc_id") + NEW_ID_OFFSET).alias("doc_id")).filter(F.col("doc_id") % 100 == 99)
    delta_cat = catalogue_of(delta.join(labelled.unionByName(new_lab), "doc_id", "left_semi"))
    store.upsert(build_points(spark, delta, delta_cat, dim=DIM, materialize=False, first_id=store.next_id()),
                 replaced_keys=delta.select(F.col("doc_id").alias("book_id")))
    return store


def q19_upsert(spark, sf):
    """Keys and texts of the collection after the upsert, and how often each id occurs."""
    pts = _upserted(spark, sf).read()
    ids = pts.groupBy("id").agg(F.count(F.lit(1)).alias("rows_of_id"))
    return pts.join(ids, "id").select("book_id", F.col("chunk_no").cast("long").alias("chunk_no"),
                                      F.md5(F.col("payload.text")).alias("md5_text"),
                                      F.col("payload.title").alias("title"), "rows_of_id")


def _sql_upserted() -> str:
    eff = f"""(SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN text || {S.lit(REVISION_SUFFIX)} ELSE text END AS text,
    source, lang, doc_id IN (SELECT doc_id FROM labels) AS lab FROM documents
  UNION ALL
  SELECT doc_id + {NEW_ID_OFFSET}, text, source, lang, doc_id IN (SELECT doc_id FROM labels) FROM documents
  WHERE doc_id % 100 = 99)"""
    return f"""effdocs AS MATERIALIZED {eff},
{S.points_ctes(512, DIM, 'effdocs', 'lab')}"""


def sql_q19_upsert():
    return f"""WITH RECURSIVE {_sql_upserted()}
SELECT book_id, chunk_no, md5(chunk_text) AS md5_text, title, 1::BIGINT AS rows_of_id FROM pts"""


def q35_search_after_upsert(spark, sf):
    """R2 over a collection that was loaded twice: top-4 of every question."""
    pts = _upserted(spark, sf).read()
    hits = retrieve(pts, questions(spark, sf), k=4, dim=DIM)
    named = hits.join(pts.select("id", "book_id", "chunk_no"), "id")
    return named.select("qid", F.col("rank").cast("long").alias("rank"), "book_id", F.col("chunk_no").cast("long").alias("chunk_no"),
                        F.round("score", 6).alias("score"), F.md5("text").alias("md5_text"))


def sql_q35_search_after_upsert():
    # equal scores: the lower id, and ids of the second load follow those of the first
    load = f"CASE WHEN p.book_id % 10 = 0 OR p.book_id >= {NEW_ID_OFFSET} THEN 1 ELSE 0 END"
    return f"""WITH RECURSIVE {_sql_upserted()},
{S.question_ctes()},
{S.topk_ctes(4, DIM, 'qs')}
SELECT qid, rank::BIGINT AS rank, book_id, chunk_no, round(score, 6) AS score, md5(chunk_text) AS md5_text FROM (
  SELECT a.qid, a.score, p.book_id, p.chunk_no, p.chunk_text,
    row_number() OVER (PARTITION BY a.qid ORDER BY a.score DESC, {load}, p.book_id, p.chunk_no) AS rank
  FROM qall a JOIN pts p ON p.id = a.id) WHERE rank <= 4"""


QUERIES = {
    "q35_search_after_upsert": (q35_search_after_upsert, sql_q35_search_after_upsert),
    "q18_contract": (q18_contract, sql_q18_contract),
    "q19_upsert": (q19_upsert, sql_q19_upsert),
}
