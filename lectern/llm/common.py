"""Helpers that the training-data operators share: written tables, text packs, hashes.

All of them run inside Spark tasks on one pack (a bounded slice of a partition) at a time,
or only name a table in the folder that every executor sees.
"""

from __future__ import annotations

import ctypes
import hashlib
import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import hadoop_fs, scratch_dir, small_batches

#: text bytes that a task handles at a time; a longer document is a pack of its own
PACK_BYTES = 8 << 20
#: a table is broadcast only when its counted size is below this; beyond it the join shuffles
BROADCAST_BYTES = 32 << 20


U64 = np.uint64
_C1 = U64(0x9E3779B97F4A7C15)
_C2 = U64(0xC2B2AE3D27D4EB4F)
_C3 = U64(0xD6E8FEB86659FD93)
_C4 = U64(0xFF51AFD7ED558CCD)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps start from the files,
    whichever executors are lost, and see the same rows each time."""
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that :func:`materialise` wrote, once all that reads them is written too.

    The shuffle files of finished jobs go when the driver's JVM collects what refers to them, which
    ``spark.cleaner.periodicGC.interval`` leaves to half an hour: it is asked to do so now."""
    for t in tables:
        fs, path = hadoop_fs(t.sparkSession, t.written_to)
        fs.delete(path, True)
    for t in tables[:1]:
        t.sparkSession.sparkContext._jvm.System.gc()


def keyed(docs: DataFrame, *extra: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text (null: empty) alone, so that other columns of any name cannot clash."""
    small_batches(docs.sparkSession)
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"),
                       *[docs[c] for c in extra])


def semi_join(left: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``left`` whose key (null included) is in ``ids``, a written table of that one
    column: the ids are broadcast while their counted size allows it, else both sides shuffle."""
    r = ids.select(F.col(key).alias("_k"))
    small = r.count() * 16 <= BROADCAST_BYTES
    return left.join(F.broadcast(r) if small else r, left[key].eqNullSafe(F.col("_k")), "left_semi")


def share(spark, value):
    """Broadcast ``value``, a model or test set of bounded size, so that executors without this
    package can read it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(block):
    return pickle.loads(block.value)


def parts_for(df_or_n, per_part: int) -> int:
    """Partitions so that each holds about ``per_part`` of the counted amount."""
    n = df_or_n if isinstance(df_or_n, (int, float)) else df_or_n.count()
    return max(1, -(-int(n) // per_part))


# ---------------------------------------------------------------- text inside tasks

def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of an Arrow string column (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    if len(column) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(off, np.int64 if large else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, o - o[0]


def packs(batches, limit: int = PACK_BYTES, column: str = "text"):
    """Regroup record batches into tables of about ``limit`` text bytes, rows kept whole."""
    held, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        lens = np.diff(utf8(b.column(b.schema.get_field_index(column)))[1])
        start, run = 0, 0
        for i, n in enumerate(lens):
            if size + run and size + run + n > limit:
                if i > start:
                    held.append(b.slice(start, i - start))
                yield pa.Table.from_batches(held)
                held, size, start, run = [], 0, i, 0
            run += int(n)
        held.append(b.slice(start))
        size += run
    if held:
        yield pa.Table.from_batches(held)


def release() -> None:
    """Give the memory that arrays have left behind back to the system: a Python worker serves many
    tasks, and beside it the executor and other workers need room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(fn):
    """``fn`` over a task's batches, with :func:`release` at the end."""
    def run(batches):
        yield from fn(batches)
        release()

    return run


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of two 64-bit columns (wraps by intent)."""
    x = a * _C1
    x ^= b >> U64(31)
    x += b * _C2
    x ^= x >> U64(29)
    return x


def finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(32))) * _C2
    x = (x ^ (x >> U64(29))) * _C1
    return x ^ (x >> U64(32))


#: words beyond this many bytes are hashed one by one
_LONG = 1024


def _round(state: np.ndarray, block: np.ndarray, c1: np.uint64, c2: np.uint64) -> np.ndarray:
    x = (state ^ block) * c1
    x ^= x >> U64(32)
    x *= c2
    return x ^ (x >> U64(29))


def _hash_spans(norm: np.ndarray, s: np.ndarray, e: np.ndarray, c1: np.uint64, c2: np.uint64) -> np.ndarray:
    """64-bit hash of the bytes norm[s:e] of each span, which hold no 0.

    Eight bytes at a time are xored into the state, which a bijection of 64 bits then stirs:
    spans of up to eight bytes never collide, and longer ones have no algebraic relation that
    patterns of letters could meet (a polynomial modulo 2^64 has)."""
    size = e - s
    padded = np.append(norm, np.zeros(8, np.uint8))
    eight = np.ndarray((len(norm) + 1,), "<u8", padded, 0, (1,))
    live = np.flatnonzero(size <= _LONG) if len(size) and size.max() > _LONG else np.arange(len(size))
    h = np.full(len(size), c2, np.uint64)
    at = 0
    while len(live):
        room = np.minimum(size[live] - at, 8).astype(np.uint64)
        block = eight[s[live] + at] & (U64(2**64 - 1) >> (U64(64) - room * U64(8)))
        h[live] = _round(h[live], block, c1, c2)
        at += 8
        live = live[size[live] > at]
    for i in np.flatnonzero(size > _LONG).tolist():
        h[i] = np.frombuffer(hashlib.blake2b(norm[s[i]:e[i]].tobytes(), digest_size=8, key=int(c1).to_bytes(8, "little")).digest(), "<u8")[0]
    return finish(h)


def words(buf: np.ndarray, table: np.ndarray, off: np.ndarray, twice: bool = False):
    """(start, end, 64-bit hash, first word of each text) of the words in a pack.

    ``table`` maps each byte to its normalised byte, 0 for bytes that are in no word.  Words
    do not cross texts.  Equal words have equal hashes wherever they stand; see
    ``_hash_spans``.  ``twice`` adds a second, independent hash: the two are 128 bits."""
    n = len(buf)
    norm = table[buf]
    inside = norm != 0
    first = inside.copy()
    last = inside.copy()
    if n:
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cut = off[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        first[cut] = inside[cut]
        last[cut - 1] = inside[cut - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = s, e, _hash_spans(norm, s, e, _C1, _C2), np.searchsorted(s, off)
    return (*out, _hash_spans(norm, s, e, _C3, _C4)) if twice else out


def byte_table(word_byte) -> np.ndarray:
    """Byte map for :func:`words`: A-Z lower-cased, bytes outside words to 0 (and a NUL that is
    in words to 255, which UTF-8 has no use for)."""
    t = np.zeros(256, np.uint8)
    for b in range(256):
        if word_byte(b):
            t[b] = b + 32 if 65 <= b <= 90 else b or 255
    return t


# ---------------------------------------------------------------- columns as one binary

def squeeze(*arrays: np.ndarray) -> bytes:
    """Equal-length integer columns as one binary: byte planes, zstd."""
    planes = [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes()
              for a in arrays]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def expand(blob: bytes, n: int, *types) -> list[np.ndarray]:
    kinds = [np.dtype(t) for t in types]
    raw = pa.decompress(blob, decompressed_size=n * sum(k.itemsize for k in kinds), codec="zstd", asbytes=True)
    out, at = [], 0
    for k in kinds:
        planes = np.frombuffer(raw, np.uint8, n * k.itemsize, at).reshape(k.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(k).reshape(n))
        at += n * k.itemsize
    return out


def spans(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... count[0] values, then those of start[1], ..."""
    total = int(count.sum())
    return np.arange(total) + np.repeat(start - (np.cumsum(count) - count), count)


# ---------------------------------------------------------------- decisions on rows

def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_key(docs: DataFrame, text_col: str = "text"):
    return F.xxhash64(F.coalesce(docs[text_col], F.lit("")))


def without(docs: DataFrame, bad: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose (id, text) is in ``bad``, a written table of doc_id and
    the text's ``h``; null ids match null ids.  All columns stay as they are."""
    bad_id, bad_h = fresh(docs, "_bad_id"), fresh(docs, "_bad_h")
    side = bad.select(F.col("doc_id").alias(bad_id), F.col("h").alias(bad_h))
    small = side.count() * 24 <= BROADCAST_BYTES
    return docs.join(F.broadcast(side) if small else side,
                     docs[id_col].cast("long").eqNullSafe(F.col(bad_id)) & (text_key(docs, text_col) == F.col(bad_h)),
                     "left_anti")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size_col: str, total: int) -> DataFrame:
    """Join ``rows`` to ``groups`` (written, one row per key, with the key's row count).  Groups
    that hold over a thousandth of all rows are a thousand at most and are broadcast; the others
    are too small to skew the shuffled join."""
    hot_size = max(1000, total // 1000)
    hot, cold = groups.filter(F.col(size_col) > hot_size), groups.filter(F.col(size_col) <= hot_size)
    return rows.join(F.broadcast(hot), key).unionByName(
        rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))
