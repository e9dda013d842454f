"""Token-id output: documents as Simple-8b coded ids in files ordered by doc_id.

Layout of a written folder (Parquet as container, ``data/``): one row per document with
``shard``, ``doc_id``, ``local_start`` (ids before it in its shard), ``n_tokens``, ``words``
(Simple-8b words, little-endian), ``blocks`` (uint32 word offset of each block of 256 ids)
and ``escapes`` (uint64).  A shard is one doc_id range, written in ascending order; shards
ascend with doc_id.  A document's global start is its shard's base plus ``local_start``.

Ranges come from the quantiles of the doc_id column alone, so texts are tokenised once and
only coded ids are shuffled.  A task looks a document's shard up in the sorted cuts; shard k is
partition k, so it is written by one task, and the files' names are in the order of doc_id.  An id that
several cuts fall on (null ones, say) is dealt over as many shards by the hash of the text.  Null text
is empty (the end id alone); a null doc_id sorts first; repeated rows are written each, those of one
shard ordered by id count and checksum.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm import simple8b
from lectern.llm.common import keyed, packs, parts_for, share, shared
from lectern.llm.tokens import encoder, tokenizer_path
from lectern.session import scratch_dir

#: documents per shard, on average
SHARD_DOCS = 20_000
#: ids coded at a time
CODE_IDS = 1 << 19

_CODED = "shard int, doc_id long, n_tokens long, crc long, words binary, blocks binary, escapes binary"
_SCHEMA = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("crc", pa.int64()), ("words", pa.binary()),
                     ("blocks", pa.binary()), ("escapes", pa.binary())])


def with_end(ids: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to every list."""
    n = len(off) - 1
    out = np.full(len(ids) + n, end_id, ids.dtype)
    keep = np.ones(len(out), bool)
    new = off + np.arange(n + 1)
    keep[new[1:] - 1] = False
    out[keep] = ids
    return out, new


def id_batches(table, path: str, end_id: int):
    """(doc_ids, ids, offsets) of a pack, a bounded number of ids at a time."""
    doc_ids = table.column("doc_id").to_pylist()
    for a, b, ids, off in _id_slices(table, path, end_id):
        yield doc_ids[a:b], ids, off


def _id_slices(table, path: str, end_id: int):
    """(first row, end, ids, offsets), a bounded number of ids at a time."""
    ids, off = with_end(*encoder(path).encode(table.column("text")), end_id)
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + CODE_IDS, "right")) - 1)
        yield a, b, ids[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


#: stands for a null doc_id
_FIRST = -(1 << 63)


def shard_of(ids: np.ndarray, h: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The number of cuts at or below an id; an id that is r cuts is dealt over their r shards by h."""
    low, high = np.searchsorted(cuts, ids, "left"), np.searchsorted(cuts, ids, "right")
    part = ((h.view(np.uint64) >> np.uint64(32)) * np.maximum(high - low, 1).astype(np.uint64)) >> np.uint64(32)
    return np.where(high > low, low + 1 + part.astype(np.int64), high)


def _code(path: str, end_id: int, block):
    def code(batches):
        cuts = shared(block)
        for table in packs(batches, 4 << 20):
            every = table.column("doc_id").to_pylist()
            key = np.array([_FIRST if x is None else x for x in every], np.int64)
            shard = shard_of(key, table.column("h").to_numpy(), cuts)
            for a, b, ids, off in _id_slices(table, path, end_id):
                doc_ids = every[a:b]
                words, wo, blocks, bo, esc = simple8b.encode(ids, off)
                eo = np.searchsorted(esc[:, 0], np.arange(len(doc_ids) + 1)) if len(esc) else np.zeros(len(doc_ids) + 1, np.int64)
                blocks = blocks.astype("<u4")
                cols = [[], [], [], []]
                for k in range(len(doc_ids)):
                    cols[0].append(zlib.crc32(ids[off[k]:off[k + 1]]))
                    cols[1].append(words[wo[k]:wo[k + 1]].tobytes())
                    cols[2].append(blocks[bo[k]:bo[k + 1]].tobytes())
                    cols[3].append(esc[eo[k]:eo[k + 1], 1].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip([shard[a:b], doc_ids, np.diff(off), *cols], _SCHEMA)], schema=_SCHEMA)
    return code


def _number(batches):
    """Ids before each document of its shard; rows come ordered by (shard, doc_id)."""
    shard, run = None, 0
    for b in batches:
        s, n = np.asarray(b.column("shard")), np.asarray(b.column("n_tokens"))
        before = np.cumsum(n) - n
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        base = np.repeat(before[first], np.diff(np.r_[first, len(s)]))
        start = before - base
        if len(s) and s[0] == shard:
            start[:first[1] if len(first) > 1 else len(s)] += run
        if len(s):
            shard, run = s[-1], int(start[-1] + n[-1])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(start, pa.int64())], names=[*b.schema.names, "local_start"])


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 1,
                      id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS) -> str:
    """Tokenise ``docs`` and write them to the folder ``path``; returns the folder."""
    src = keyed(docs, id_col=id_col, text_col=text_col).withColumn("h", F.xxhash64("text"))
    shards = parts_for(src, shard_docs)
    cuts = []
    if shards > 1:
        at = [i / shards for i in range(1, shards)]
        key = F.coalesce("doc_id", F.lit(_FIRST))
        cuts = src.select(F.percentile_approx(key, at, max(10_000, 20 * shards)).alias("q")).first()["q"] or []
    block = share(docs.sparkSession, np.sort(np.array(cuts, np.int64)))  # a number a shard
    coded = src.mapInArrow(_code(vocabulary or tokenizer_path(), end_id, block), _CODED)
    numbered = (coded.repartitionById(shards, "shard").sortWithinPartitions("shard", "doc_id", "n_tokens", "crc").drop("crc")
                .select("shard", "doc_id", "n_tokens", "words", "blocks", "escapes"))
    numbered.mapInArrow(_number, "shard int, doc_id long, n_tokens long, words binary, blocks binary, escapes binary, local_start long") \
        .write.option("compression", "none").parquet(f"{path}/data")
    return path


_FILE = "shard int, doc_id long, n_tokens long, words binary, blocks binary, escapes binary, local_start long"


def read_lists(batch) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of the coded documents of a record batch."""
    def flat(name, kind):
        parts = batch.column(name).to_pylist()
        a = np.frombuffer(b"".join(parts), kind)
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(kind).itemsize
        return a, np.concatenate([[0], np.cumsum(size)])
    counts = np.asarray(batch.column("n_tokens"), np.int64)
    words, wo = flat("words", "<u8")
    blocks, bo = flat("blocks", "<u4")
    esc, eo = flat("escapes", "<u8")
    pairs = np.stack([np.repeat(np.arange(len(counts)), np.diff(eo)).astype(np.uint64), esc], 1)
    ids = simple8b.decode(words, wo, blocks.astype(np.int64), bo, counts, pairs)
    return ids, np.concatenate([[0], np.cumsum(counts)])


def _digest(batches):
    for whole in batches:
        n = np.asarray(whole.column("n_tokens"))
        part = np.cumsum(n) // CODE_IDS
        cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(n) else []
        for a, b in zip(cut, [*cut[1:], len(n)]):
            batch = whole.slice(a, b - a)
            ids, off = read_lists(batch)
            ids = ids.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("doc_id"), batch.column("local_start"), batch.column("n_tokens"),
                 pa.array([zlib.crc32(ids[off[k]:off[k + 1]]) for k in range(batch.num_rows)], pa.int64())],
                names=["shard", "doc_id", "local_start", "n_tokens", "ids_crc32"])


def read_token_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a written folder: doc_id, start, n_tokens, ids_crc32 of the decoded ids."""
    files = spark.read.schema(_FILE).parquet(f"{path}/data")
    totals = files.groupBy("shard").agg(F.sum("n_tokens").alias("t"))
    # one row per shard: the only thing that is ordered as a whole
    base = totals.select("shard", F.coalesce(F.sum("t").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)),
                                             F.lit(0)).alias("base"))
    docs = files.mapInArrow(_digest, "shard int, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    return docs.join(F.broadcast(base), "shard").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, vocabulary: str | None = None, end_id: int = 1) -> DataFrame:
    """Write ``docs`` to a fresh folder and return the digest of what the files hold."""
    path = scratch_dir(docs.sparkSession, "llm-tokens")
    write_token_files(docs, path, vocabulary, end_id)
    return read_token_digest(docs.sparkSession, path)
