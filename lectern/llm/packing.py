"""Best-fit packing with certified bin counts.

Documents are tokenised once into pieces of at most ``capacity`` ids; only piece descriptions
move from then on.  A piece that fills a sequence is a sequence.  The others are packed in
rounds: each partition packs its pieces best-fit decreasing and compares its bins with a lower
bound from dual-feasible functions.  A partition that meets its bound is certified and done, but for
its ``LOOSE`` emptiest bins, whose room others may use.  A partition with a gap hands on the pieces
of all bins with room.  In the next round these are dealt anew over fewer partitions, as long as
none gets more than ``MOST_PIECES``, and packed again, until there is one partition, the bound of all pieces is
met, or a round over as many partitions no longer lowers the number of bins.  The bound of all pieces, from the counts of their lengths, certifies the whole.

Null text is an empty document: the end id alone.  Repeated rows are packed each.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import keyed, materialise, packs, tidy
from lectern.llm.token_output import id_batches
from lectern.llm.tokens import tokenizer_path

CAPACITY = 2048
#: pieces of one partition in the first round, and in any
PART_PIECES, MOST_PIECES = 100_000, 2_000_000
#: partitions that meet in one in the next round, as far as ``MOST_PIECES`` lets them
FAN_IN = 8
#: emptiest bins that a certified partition hands on
LOOSE = 64

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = _PIECES + ", key long, sequence_id long, offset long, open boolean, bins long, bound long"


def _cut(path: str, end_id: int, capacity: int):
    def cut(batches):
        for table in packs(batches, 4 << 20):
            for doc_ids, ids, off in id_batches(table, path, end_id):
                ids = ids.astype("<u4", copy=False)
                size = np.diff(off)
                count = -(-size // capacity)
                doc = np.repeat(np.arange(len(size)), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(capacity, size[doc] - start)
                at = off[:-1][doc] + start
                crc = [zlib.crc32(ids[a:a + n]) for a, n in zip(at.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return cut


def pieces(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    return keyed(docs).mapInArrow(tidy(_cut(vocabulary or tokenizer_path(), end_id, capacity)), _PIECES)


def lower_bound(lengths: np.ndarray, capacity: int, counts: np.ndarray | None = None) -> int:
    """Bins that any packing of these lengths (as often as ``counts``) needs at least: the best of the volume bound and
    two families of dual-feasible functions (a function f with the sum of f over any bin's
    lengths at most 1 gives the bound ceil(sum of f)).

    * threshold t: 1 above capacity - t, length / capacity between, 0 below t
    * rounding k: (k + 1) x / capacity rounded down over k, exact multiples kept
    """
    if not len(lengths):
        return 0
    size, n = np.unique(lengths, return_counts=True) if counts is None else (lengths, counts)
    best = -(-int((size * n).sum()) // capacity)
    for t in np.unique(np.minimum(size, capacity - size)):
        if 0 < t <= capacity // 2:
            total = int(n[size > capacity - t].sum()) * capacity + int((size * n)[(size >= t) & (size <= capacity - t)].sum())
            best = max(best, -(-total // capacity))
    for k in range(1, 17):
        x = (k + 1) * size
        exact = x % capacity == 0
        # in units of 1 / (k * capacity), so that all stays integer
        f = np.where(exact, size * k, (x // capacity) * capacity)
        best = max(best, -(-int((f * n).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each length, offset in it, free room of each bin).

    Bins are kept by free room; a bit mask over the rooms finds the tightest that fits."""
    order = np.argsort(-lengths, kind="stable")
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, free = 0, []
    where = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fit = mask >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            room, b = capacity, len(free)
            free.append(capacity)
        where[i], offset[i] = b, capacity - room
        room -= n
        free[b] = room
        if room:
            rooms[room].append(b)
            mask |= 1 << room
    return where, offset, np.array(free, np.int64)


def _pack(capacity: int, loose: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True]).reset_index(drop=True)
        n = pdf["length"].to_numpy()
        where, offset, free = best_fit_decreasing(n, capacity)
        bound = lower_bound(n, capacity)
        handed = free > 0
        if len(free) == bound:
            handed[np.argsort(-free, kind="stable")[loose:]] = False
        pdf["sequence_id"], pdf["offset"], pdf["open"], pdf["bins"], pdf["bound"] = where, offset, handed[where], len(free), bound
        return pdf
    return pack


def certified_packing(found: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES, loose: int = LOOSE):
    """(pieces with sequence_id and offset, certificate).  Sequence ids are unique, not consecutive.

    The certificate has a row per partition and round: round, key, pieces, bins, bound, closed_bins; and
    one of round -1 for the whole: pieces, bins in use and the least number that any packing needs."""
    columns = [c.split()[0] for c in _PIECES.split(", ")]
    found = materialise(found, "pieces")
    whole = found.filter(F.col("length") >= capacity).select(
        *columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = found.filter(F.col("length") < capacity).select(*columns)
    by_length = found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("length")  # a row a length: capacity at most
    full = by_length["length"].to_numpy() >= capacity
    size, count = (by_length[c].to_numpy(np.int64) for c in ("length", "n"))
    least = int(count[full].sum()) + lower_bound(size[~full], capacity, count[~full])
    done, rounds, turn, base, before, parts, used = [], [], 0, 0, None, None, int(count[full].sum())
    while True:
        n = rest.count()
        if not n:
            break
        fewer = -(-n // part_pieces) if parts is None else max(-(-parts // FAN_IN), -(-n // MOST_PIECES))
        stuck, parts = parts is not None and fewer >= parts, fewer
        # the documents' own ids deal the pieces out, so a rerun of a lost task sees the same ones
        key = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(turn)), F.lit(parts))
        packed = materialise(rest.withColumn("key", key).groupBy("key").applyInPandas(_pack(capacity, loose), _PACKED), f"packed{turn}")
        bins = packed.groupBy("key").agg(F.count(F.lit(1)).alias("pieces"), F.max("bins").alias("bins"), F.max("bound").alias("bound"),
                                         F.countDistinct(F.when(~F.col("open"), F.col("sequence_id"))).alias("closed_bins"))
        bins = materialise(bins.select(F.lit(turn).alias("round"), "key", "pieces", "bins", "bound", "closed_bins"), f"bins{turn}")
        rounds.append(bins)
        total = bins.agg(F.sum("bins").alias("bins"), F.sum("closed_bins").alias("closed")).first()
        # ids of a round: (key, bin) behind those of the rounds before
        number = (F.lit(base) + F.col("key") * F.lit(1 << 32) + F.col("sequence_id")).alias("sequence_id")
        last = parts == 1 or used + total["bins"] == least or stuck and total["bins"] >= before
        done.append((packed if last else packed.filter(~F.col("open"))).select(*columns, number, "offset"))
        used += total["bins"] if last else total["closed"]
        base += parts << 32
        turn += 1
        if last:
            break
        before = total["bins"] - total["closed"]
        rest = packed.filter("open").select(*columns)
    out = whole
    for d in done:
        out = out.unionByName(d)
    spark = found.sparkSession
    certificate = spark.createDataFrame([(-1, None, int(count.sum()), used, least, used)],
                                        "round int, key long, pieces long, bins long, bound long, closed_bins long")
    for r in rounds:
        certificate = certificate.unionByName(r)
    return out, certificate


def pack_sequences(found: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES, loose: int = LOOSE) -> DataFrame:
    """Pieces with sequence_id and offset; n_sequences and least_sequences: sequences in all, and the bound."""
    out, certificate = certified_packing(found, capacity, part_pieces, loose)
    whole = certificate.filter("round = -1").first()
    return out.withColumn("n_sequences", F.lit(whole["bins"]).cast("long")).withColumn("least_sequences", F.lit(whole["bound"]).cast("long"))


def pack_documents(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the two counts."""
    return pack_sequences(pieces(docs, vocabulary, end_id, capacity), capacity)
