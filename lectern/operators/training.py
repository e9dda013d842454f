"""Supervised training rows as native array expressions.

The default tokenizer is a hashed word vocabulary (md5 of the whitespace token, mod
the vocabulary size) so rows can be built without any model files; a user tokenizer
plugs in through ``B1`` (``tokenize_batches``), an Arrow map over column batches.
Ids 0 / 1 are pad / end-of-sequence; truncation keeps the first n-1 tokens and
appends EOS, padding fills to the fixed length.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import _col, ws_tokens
from lectern.operators.numbering import exclusive_offsets
from lectern.session import scratch_dir, small_batches

PAD, EOS, FIRST_ID = 0, 1, 3
VOCAB = 32000
IGNORE = -100


def token_ids(text) -> Column:
    """V5: hashed word ids (no special tokens)."""
    def one(w):
        h = F.md5(w)
        return (F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), F.lit(VOCAB - FIRST_ID))
                + FIRST_ID).cast("int")
    return F.transform(ws_tokens(_col(text)), one)


def encode(ids, max_len: int) -> Column:
    """R6 + V6: first max_len-1 ids + EOS, padded with PAD to max_len."""
    body = F.concat(F.slice(_col(ids), 1, max_len - 1), F.array(F.lit(EOS)))
    return F.concat(body, F.array_repeat(F.lit(PAD), F.lit(max_len) - F.size(body)))


def pad_to_batch_longest(df: DataFrame, ids_col: str, batch_col: str, max_len: int = 512) -> DataFrame:
    """V6 (``padding=True``): truncate to ``max_len`` (EOS kept) and pad every row to the
    longest row of its batch.  The per-batch maximum is a partial aggregate (one row per
    batch) joined back on the batch key."""
    body = F.concat(F.slice(F.col(ids_col), 1, max_len - 1), F.array(F.lit(EOS)))
    t = df.withColumn("_body", body)
    longest = t.groupBy(batch_col).agg(F.max(F.size("_body")).alias("_longest"))
    j = t.join(longest, batch_col)
    padded = F.concat(F.col("_body"), F.array_repeat(F.lit(PAD), F.col("_longest") - F.size("_body")))
    return (j.withColumn("input_ids", padded).withColumn("attention_mask", attention_mask("input_ids"))
            .drop("_body", "_longest"))


def attention_mask(encoded) -> Column:
    return F.transform(_col(encoded), lambda x: F.when(x == PAD, 0).otherwise(1))


def collate_causal(encoded) -> Column:
    """Labels rebuilt from inputs with padding masked to -100."""
    return F.transform(_col(encoded), lambda x: F.when(x == PAD, F.lit(IGNORE)).otherwise(x))


def book_rows(docs: DataFrame, text_col: str = "text", max_len: int = 512) -> DataFrame:
    """Causal flavour: input_ids (512), attention_mask, labels = copy of input_ids (V7);
    the source text column is dropped (P1)."""
    ids = docs.withColumn("_ids", token_ids(text_col))
    enc = ids.withColumn("input_ids", encode("_ids", max_len))
    return (enc.withColumn("attention_mask", attention_mask("input_ids"))
            .withColumn("labels", F.col("input_ids")).drop("_ids", text_col))


def seq2seq_rows(df: DataFrame, input_col: str, target_col: str | None = None,
                 max_len: int = 512, target_len: int = 150) -> DataFrame:
    """Seq2seq flavour: labels = first ``target_len`` tokens of the target (V9) or of
    the same text when no target is given (V8)."""
    t = df.withColumn("_ids", token_ids(input_col))
    t = t.withColumn("input_ids", encode("_ids", max_len)).withColumn("attention_mask", attention_mask("input_ids"))
    src = "_ids" if target_col is None else "_tids"
    if target_col is not None:
        t = t.withColumn("_tids", token_ids(target_col))
    return t.withColumn("labels", encode(src, target_len)).drop("_ids", "_tids")


def concat_rows(books: DataFrame, pairs: DataFrame) -> DataFrame:
    """UNION ALL by name; columns missing on one side become null."""
    return books.unionByName(pairs, allowMissingColumns=True)


def written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tokenize_batches(df: DataFrame, fn, schema) -> DataFrame:
    """B1: user batched map over Arrow column batches (``fn(pandas.DataFrame) -> DataFrame``)."""
    return df.mapInPandas(lambda it: (fn(pdf) for pdf in it), schema)


def length_batches(df: DataFrame, ids_col: str, key_col: str, budget: int, max_len: int = 512) -> DataFrame:
    """R5 by tokens: rows in order of length (then key), cut into batches of about ``budget`` tokens.

    A row's batch is the budget's multiple that the tokens before it have filled, from the
    distributed prefix sum, so a batch holds rows of near-equal length."""
    n = F.least(F.size(ids_col), F.lit(max_len - 1)) + 1
    # written once: the count, the ranges, the prefix sum and the join all read it, and what ``df`` costs
    # (a user's tokeniser) is paid once
    rows = written(df.withColumn("n_tokens", n.cast("long")), "lengths")
    at = exclusive_offsets(rows.select("n_tokens", key_col), ["n_tokens", key_col], "n_tokens")
    return rows.join(at.select(key_col, F.floor(F.col("offset") / budget).cast("long").alias("batch")), key_col)


def padding(batched: DataFrame, size_col: str = "n_tokens", batch_col: str = "batch") -> DataFrame:
    """(batches, tokens, padding) when every row is padded to the longest of its batch."""
    b = batched.groupBy(batch_col).agg(F.count(F.lit(1)).alias("r"), F.sum(size_col).alias("t"), F.max(size_col).alias("m"))
    return b.agg(F.count(F.lit(1)).alias("batches"), F.sum("t").alias("tokens"), F.sum(F.col("r") * F.col("m") - F.col("t")).alias("padding"))


#: id of a word that is in no vocabulary, and the first of those that are
UNKNOWN, FIRST_WORD = 2, 3


def fit_vocabulary(texts: DataFrame, text_col: str, size: int) -> DataFrame:
    """V5: the ``size`` most frequent words (ties by the word) -> (word, n, word_id from ``FIRST_WORD``), written."""
    counts = texts.select(F.explode(ws_tokens(text_col)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "word").limit(size)  # the vocabulary's size is a parameter
    ids = top.withColumn("word_id", (F.row_number().over(Window.orderBy(F.desc("n"), "word")) + FIRST_WORD - 1).cast("int"))
    return written(ids, "vocabulary")


def _ids_in_place(texts: DataFrame, key_col: str, text_col: str, vocabulary: DataFrame) -> DataFrame:
    """``vocabulary_ids`` with a small vocabulary: one scan, one row a text is shuffled."""
    v = vocabulary.select("word", "word_id").toPandas()
    block = texts.sparkSession.sparkContext.broadcast((v["word"].tolist(), v["word_id"].tolist()))

    def look_up(batches):
        known, number = block.value
        known, number = pa.array(known, pa.string()), pa.array(number, pa.int32())
        for b in batches:
            words = b.column("words")
            at = pc.index_in(words.flatten().cast(pa.string()), value_set=known)
            ids = pc.fill_null(pc.take(number, at), UNKNOWN)
            first = words.offsets.to_numpy()
            lists = pa.ListArray.from_arrays(pa.array(first - first[0], pa.int32()), ids)
            yield pa.RecordBatch.from_arrays([b.column("_k"), b.column("_lost"), lists], names=["_k", "_lost", "ids"])

    key = F.col(key_col)
    small_batches(texts.sparkSession)
    # rows without key are told apart, so that they do not meet in one group
    words = texts.select(key.alias("_k"), F.when(key.isNull(), F.xxhash64(text_col)).alias("_lost"),
                         F.when(key.isNotNull(), F.coalesce(ws_tokens(text_col), F.array().cast("array<string>")))
                         .otherwise(F.array().cast("array<string>")).alias("words"))
    kind = texts.schema[key_col].dataType.simpleString()
    found = words.mapInArrow(look_up, f"_k {kind}, _lost long, ids array<int>")
    rows = found.groupBy("_k", "_lost").agg(F.count(F.lit(1)).cast("int").alias("n"), F.collect_list("ids").alias("all"))
    place = F.flatten(F.transform("all", lambda x: F.transform(x, lambda i, p: F.struct(p.alias("p"), i.alias("i")))))
    merged = F.when(F.col("n") == 1, F.col("all")[0]).otherwise(F.transform(F.array_sort(place), lambda e: e["i"]))
    return (rows.select("_k", "n", merged.alias("ids")).withColumn("_c", F.explode(F.sequence(F.lit(1), F.col("n"))))
            .select(F.col("_k").alias(key_col), "ids"))


def vocabulary_ids(texts: DataFrame, key_col: str, text_col: str, vocabulary: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """(key, ids): the words' ids in their order, ``UNKNOWN`` for words outside the vocabulary.

    The vocabulary is broadcast only if its counted bytes allow it, and words are looked up where they are;
    else they are joined by a shuffle (a word's occurrences in a text travel as one row, so a frequent
    word is a row a text).  Texts of one key have their words in order of place together; rows without
    key have none."""
    size = vocabulary.agg(F.sum(F.octet_length("word") + 48)).first()[0] or 0
    if size <= max_bytes:
        return _ids_in_place(texts, key_col, text_col, vocabulary)
    words = texts.select(F.col(key_col).alias("_k"), F.posexplode(ws_tokens(text_col)).alias("pos", "word"))
    seen = words.groupBy("_k", "word").agg(F.collect_list("pos").alias("at"))
    v = vocabulary.select("word", "word_id")
    named = seen.join(v, "word", "left").withColumn("word_id", F.coalesce("word_id", F.lit(UNKNOWN)))
    placed = named.groupBy("_k").agg(F.array_sort(F.flatten(F.collect_list(
        F.transform("at", lambda p: F.struct(p.alias("p"), F.col("word_id").alias("i")))))).alias("x"))
    ids = placed.select("_k", F.transform("x", lambda e: e["i"]).alias("ids"))
    return (texts.select(F.col(key_col).alias("_k")).join(ids, "_k", "left")
            .select(F.col("_k").alias(key_col), F.coalesce("ids", F.array().cast("array<int>")).alias("ids")))
