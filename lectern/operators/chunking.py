"""A1: greedy token-budget packing of sentences into chunks.

The fold is sequential within a document but independent across documents, so it
runs as a narrow ``mapInPandas`` (no shuffle).  Sentences and their token counts are
produced JVM-side (``lectern.functions.text``); Python receives the arrays and only
walks chunk boundaries with ``numpy.searchsorted`` over prefix sums, i.e. O(chunks)
Python steps per document rather than O(sentences).

Semantics (kept from the reference): a sentence joins the current chunk while
``current + n <= budget``; on overflow the current chunk is emitted even when empty
(so a first sentence longer than the budget yields an empty chunk 0); an oversized
later sentence gets a chunk of its own; the tail is emitted when non-empty; no
sentences -> no chunks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.text import clean_sentences, sentence_lengths
from lectern.session import small_batches


#: tokens of chunks that a task holds before it hands them on
HELD_TOKENS = 200_000


def chunk_bounds(lengths, budget: int, drop_empty: bool = False):
    """Chunk boundaries as (start, end) sentence index pairs; (0, 0) is the empty chunk."""
    n = len(lengths)
    if n == 0:
        return []
    lens = np.asarray(lengths, dtype=np.int64)
    prefix = np.concatenate(([0], np.cumsum(lens)))
    out = []
    if lens[0] > budget and not drop_empty:
        out.append((0, 0))
    s = 0
    while s < n:
        e = int(np.searchsorted(prefix, prefix[s] + budget, side="right")) - 1
        if e <= s:
            e = s + 1
        out.append((s, e))
        s = e
    return out


def pack_sentences(sents, lengths, budget: int, drop_empty: bool = False):
    """Pure-Python reference of one document: list of (chunk_text, n_tokens, n_sentences)."""
    lens = [int(x) for x in lengths]
    res = []
    for s, e in chunk_bounds(lens, budget, drop_empty):
        res.append((" ".join(sents[s:e]), int(sum(lens[s:e])), e - s))
    return res


def pack_chunks(df: DataFrame, key_cols: list[str], budget: int | list[int] = 512,
                sents_col: str = "sentences", lens_col: str = "lengths",
                drop_empty: bool = False) -> DataFrame:
    """Rows (keys..., sentences ARRAY<STRING>, lengths ARRAY<INT>) -> one row per chunk.

    With a list of budgets every document is packed once per budget in the same pass
    (one sentence split feeds all of them) and rows carry ``chunk_budget``."""
    small_batches(df.sparkSession)
    multi = isinstance(budget, (list, tuple))
    budgets = list(budget) if multi else [budget]
    key_fields = [df.schema[k] for k in key_cols]
    if multi:
        key_fields = key_fields + [T.StructField("chunk_budget", T.IntegerType(), False)]
    out_schema = T.StructType(key_fields + [
        T.StructField("chunk_no", T.IntegerType(), False),
        T.StructField("chunk_text", T.StringType(), False),
        T.StructField("n_tokens", T.IntegerType(), False),
        T.StructField("n_sentences", T.IntegerType(), False),
        T.StructField("n_chunks", T.IntegerType(), False),
    ])
    names = [f.name for f in out_schema.fields]

    def fn(batches):
        for pdf in batches:
            cols, held = {k: [] for k in names}, 0
            keys = [pdf[k].tolist() for k in key_cols]
            for i, (sents, lens) in enumerate(zip(pdf[sents_col], pdf[lens_col])):
                if sents is None or len(sents) == 0:
                    continue
                sents = list(sents)
                lens = np.asarray(lens, dtype=np.int64)
                prefix = np.concatenate(([0], np.cumsum(lens)))
                for b in budgets:
                    bounds = chunk_bounds(lens, b, drop_empty)
                    for no, (s, e) in enumerate(bounds):
                        for j, k in enumerate(key_cols):
                            cols[k].append(keys[j][i])
                        if multi:
                            cols["chunk_budget"].append(b)
                        cols["chunk_no"].append(no)
                        cols["chunk_text"].append(" ".join(sents[s:e]))
                        cols["n_tokens"].append(int(prefix[e] - prefix[s]))
                        cols["n_sentences"].append(e - s)
                        cols["n_chunks"].append(len(bounds))
                    held += int(prefix[-1])
                if held >= HELD_TOKENS:  # the chunks of a few documents at a time, however many come in a batch
                    yield pd.DataFrame(cols, columns=names)
                    cols, held = {k: [] for k in names}, 0
            if cols["chunk_no"]:
                yield pd.DataFrame(cols, columns=names)

    return df.select(*key_cols, sents_col, lens_col).mapInPandas(fn, out_schema)


def chunk_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    budget: int | list[int] = 512, cleaned: bool = False, drop_empty: bool = False,
                    counter=None) -> DataFrame:
    """Clean (unless ``cleaned``), split, count and pack; one row per chunk.

    The cleaned text is never materialised: re-splitting a cleaned text yields the
    same sentences, so one sentence array feeds both steps.  ``counter`` (F7) maps the
    sentence array column to a token-count array column (default: whitespace tokens;
    a subword tokenizer plugs in as an Arrow UDF over the array).
    """
    from lectern.functions.text import sentences
    sents = sentences(text_col) if cleaned else clean_sentences(text_col)
    count = counter or sentence_lengths
    prepared = (docs.select(F.col(id_col), sents.alias("sentences"))
                .withColumn("lengths", count(F.col("sentences"))))
    return pack_chunks(prepared, [id_col], budget=budget, drop_empty=drop_empty)
