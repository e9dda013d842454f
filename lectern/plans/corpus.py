"""Corpus build (clean -> chunk -> embed -> lookup -> points) and training corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import chunk_file_name, clean_sentences, join_sentences, token_count
from lectern.operators.chunking import chunk_documents
from lectern.operators.embedding import DEFAULT_DIM, hash_embed
from lectern.operators.joins import broadcast_if_small, first_match
from lectern.operators.numbering import exclusive_offsets
from lectern.session import scratch_dir, small_batches
from lectern.sources.tables import balanced

DEFAULT_BUDGET = 512
#: order columns of the derived catalogue and of one read from JSON parts
CATALOGUE_ORDER = ["entry_dup", "part", "file", "pos"]


def write_chunks(spark: SparkSession, docs: DataFrame, budget: int | list[int] = DEFAULT_BUDGET,
                 path: str | None = None, id_col: str = "doc_id", text_col: str = "text", counter=None) -> DataFrame:
    """K2: chunk every document and persist the chunk table; returns the re-read table.

    The written table cuts the lineage: the book-level counts and the points both
    read it (column-pruned for the counts) instead of re-running the chunker.
    """
    path = path or scratch_dir(spark, "chunks")
    chunks = chunk_documents(docs, id_col, text_col, budget, counter=counter)
    if id_col != "doc_id":
        chunks = chunks.withColumnRenamed(id_col, "doc_id")
    chunks.write.mode("overwrite").parquet(path)
    return balanced(spark.read.parquet(path))


def book_table(chunks: DataFrame, catalogue: DataFrame, order_cols: list[str] | None = None) -> DataFrame:
    """Matched books with their first catalogue entry and the id offset of their chunks.

    R4: ids are dense over matched chunks in (book_id, chunk_no) order; unmatched
    books consume no id.  A multi-budget chunk table numbers each budget separately.
    ``order_cols`` give the catalogue order (default: those of ``CATALOGUE_ORDER`` that it has).
    """
    group = "chunk_budget" if "chunk_budget" in chunks.columns else None
    keys = ([group] if group else []) + ["doc_id"]
    # chunk 0 of every book knows how many there are: one row a book is shuffled
    counts = chunks.filter(F.col("chunk_no") == 0).groupBy(*keys).agg(F.max("n_chunks").alias("n_chunks"))
    cat = first_match(catalogue, "id", order_cols or [c for c in CATALOGUE_ORDER if c in catalogue.columns]).withColumnRenamed("id", "doc_id")
    books = counts.join(cat.select("doc_id", "title", "author", "context"), "doc_id", "inner")
    return exclusive_offsets(books, "doc_id", "n_chunks", group=group)


def points_from_chunks(chunks: DataFrame, books: DataFrame, dim: int = DEFAULT_DIM, first_id: int = 0,
                       encoder=None) -> DataFrame:
    """Vector points: (id, book_id, chunk_no, vector ARRAY<FLOAT>, payload STRUCT).

    Only the empty chunk 0 is not stored; it keeps its id slot.  ``encoder`` maps the text
    column to a vector column (default: feature hashing).
    """
    small_batches(chunks.sparkSession)
    group = ["chunk_budget"] if "chunk_budget" in chunks.columns else []
    j = chunks.join(broadcast_if_small(books), group + ["doc_id"], "inner")
    stem = F.format_string("book_id_%d", F.col("doc_id"))
    out = j.select(
        *group, (F.lit(first_id) + F.col("offset") + F.col("chunk_no")).cast("long").alias("id"),
        F.col("doc_id").alias("book_id"), "chunk_no",
        (encoder(F.col("chunk_text")) if encoder else hash_embed(F.col("chunk_text"), dim)).cast("array<float>").alias("vector"),
        F.struct(chunk_file_name(stem, F.col("chunk_no")).alias("filename"), "title", "author", "context",
                 F.col("chunk_text").alias("text")).alias("payload"))
    return out.filter((F.col("payload.text") != "") & F.col("vector").isNotNull())


def build_points(spark: SparkSession, docs: DataFrame, catalogue: DataFrame,
                 budget: int | list[int] = DEFAULT_BUDGET, dim: int = DEFAULT_DIM,
                 materialize: bool = True, first_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
                 encoder=None, counter=None, order_cols: list[str] | None = None) -> DataFrame:
    """C1 up to the point table.  ``materialize`` writes the points once (as the
    collection would be stored) and returns the stored table, so search, payload
    lookup and counts read vectors instead of re-embedding every chunk.  A list of
    budgets builds one collection per budget in the same jobs (``chunk_budget`` column).
    ``first_id``: ids start there; for a later load, one above the stored ones
    (``VectorStore.next_id``).  ``encoder`` (V1) and ``counter`` (F7) plug in a user's model and
    token count."""
    chunks = write_chunks(spark, docs, budget, id_col=id_col, text_col=text_col, counter=counter)
    pts = points_from_chunks(chunks, book_table(chunks, catalogue, order_cols), dim, first_id, encoder)
    if not materialize:
        return pts
    path = scratch_dir(spark, "points")
    pts.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def training_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Landed text -> cleaned text with simple size facts (one row per document)."""
    s = docs.select(F.col(id_col).alias("book_id"), F.col(text_col).alias("raw"),
                    clean_sentences(text_col).alias("sentences"))
    return s.select("book_id", F.length("raw").alias("chars_before"),
                    join_sentences("sentences").alias("clean_text"),
                    F.size("sentences").alias("n_sentences")).withColumn(
        "chars_after", F.length("clean_text")).withColumn("n_tokens", token_count("clean_text"))
