"""Exact dedup by a Golomb-coded fingerprint exchange.

1. One scan writes (doc_id, row, 64-bit fingerprint, SHA-256) per document: no text.
2. Senders (fixed slices of those rows) sort their distinct fingerprints and send each owner
   of a fingerprint range the Golomb-Rice coded gaps, with a bit for those they hold twice.
3. Owners decode all lists of their range and return a bitmap to each sender: which of its
   fingerprints another row holds too.  A sender sends a fingerprint once, so a text with any
   number of copies costs an owner one entry per sender.
4. Only the suspects' texts are shuffled, grouped by their bytes (combined before the
   shuffle, so a hot text travels once per task), and the groups are joined back.

Rows are compared by exact bytes, null text counting as empty.  Of a group the row with the
largest doc_id stays; of repeated rows with that doc_id and text, one row.  A null doc_id is
smaller than any other.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import BROADCAST_BYTES, fresh, join_groups, keyed, materialise, parts_for, semi_join

#: rows of one sender, and fingerprints of one owner, at most (owners: on average)
SENDER_ROWS = 1 << 18
OWNER_ROWS = 1 << 19

_MESSAGE = "owner int, sender long, n int, k int, base long, remainders binary, quotients binary, multi binary"


def golomb_rice(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """(k, k-bit remainders, unary quotients) of non-negative integers."""
    n = len(values)
    if not n:
        return 0, b"", b""
    mean = max(1, int(values.astype(np.float64).mean() * 0.69))
    k = max(0, mean.bit_length() - 1)
    v = values.astype(np.uint64)
    q = (v >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(q + 1)
    unary = np.ones(int(ends[-1]), np.uint8)
    unary[ends - 1] = 0
    if not k:
        return 0, b"", np.packbits(unary).tobytes()
    r = (v & np.uint64((1 << k) - 1)).astype(">u8").view(np.uint8).reshape(n, 8)
    bits = np.unpackbits(r, axis=1)[:, 64 - k:]
    return k, np.packbits(bits).tobytes(), np.packbits(unary).tobytes()


def golomb_rice_decode(n: int, k: int, remainders: bytes, quotients: bytes) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    unary = np.unpackbits(np.frombuffer(quotients, np.uint8))
    stops = np.flatnonzero(unary == 0)[:n]
    q = np.diff(stops, prepend=-1) - 1
    out = q.astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(np.frombuffer(remainders, np.uint8))[:n * k].reshape(n, k)
        wide = np.zeros((n, 64), np.uint8)
        wide[:, 64 - k:] = bits
        out |= np.packbits(wide, axis=1).view(">u8").reshape(n).astype(np.uint64)
    return out


def _owner_of(h: np.ndarray, owners: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def _send(owners: int):
    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        h, n = np.unique(pdf["h"].to_numpy().astype(np.int64).view(np.uint64), return_counts=True)
        to = _owner_of(h, owners)
        cut = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
        rows = []
        for a, b in zip(cut, np.r_[cut[1:], len(h)]):
            k, rem, quo = golomb_rice(np.diff(h[a:b]) if b - a > 1 else np.zeros(0, np.uint64))
            rows.append((int(to[a]), int(pdf["sender"].iloc[0]), int(b - a), k, int(h[a:a + 1].view(np.int64)[0]), rem, quo,
                         np.packbits(n[a:b] > 1).tobytes()))
        return pd.DataFrame(rows, columns=["owner", "sender", "n", "k", "base", "remainders", "quotients", "multi"])
    return send


def _read(m) -> np.ndarray:
    base = np.array([m.base], np.int64).view(np.uint64)
    return np.concatenate([base, base + np.cumsum(golomb_rice_decode(m.n - 1, m.k, m.remainders, m.quotients))])


def _own(pdf: pd.DataFrame) -> pd.DataFrame:
    ms = list(pdf.itertuples(index=False))
    h = np.concatenate([_read(m) for m in ms])
    multi = np.concatenate([np.unpackbits(np.frombuffer(m.multi, np.uint8))[:m.n] for m in ms])
    _, inv = np.unique(h, return_inverse=True)
    held = np.bincount(inv, weights=1 + multi)
    dup = held[inv] > 1
    at, rows = 0, []
    for m in ms:
        rows.append((m.sender, m.owner, np.packbits(dup[at:at + m.n]).tobytes()))
        at += m.n
    return pd.DataFrame(rows, columns=["sender", "owner", "bits"])


def _flag(owners: int):
    def flag(rows: pd.DataFrame, maps: pd.DataFrame) -> pd.DataFrame:
        h = rows["h"].to_numpy().astype(np.int64).view(np.uint64)
        u, inv = np.unique(h, return_inverse=True)
        to = _owner_of(u, owners)
        dup = np.zeros(len(u), bool)
        for m in maps.itertuples(index=False):
            mine = np.flatnonzero(to == m.owner)
            dup[mine] = np.unpackbits(np.frombuffer(m.bits, np.uint8))[:len(mine)].astype(bool)
        return pd.DataFrame({"row": rows["row"], "suspect": dup[inv]})
    return flag


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    src = keyed(docs, id_col=id_col, text_col=text_col)
    prints = materialise(src.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("h"),
        F.sha2("text", 256).alias("sha")), "prints")
    # a sender is a slice of a scan partition; both are fixed in the written rows
    prints = prints.withColumn("sender", F.floor(F.col("row") / SENDER_ROWS).cast("long"))
    owners = parts_for(prints, OWNER_ROWS)
    messages = prints.select("sender", "h").groupBy("sender").applyInPandas(_send(owners), _MESSAGE)
    bitmaps = messages.groupBy("owner").applyInPandas(_own, "sender long, owner int, bits binary")
    flags = (prints.select("sender", "row", "h").groupBy("sender")
             .cogroup(bitmaps.groupBy("sender")).applyInPandas(_flag(owners), "row long, suspect boolean"))
    flagged = materialise(prints.drop("sender", "h").join(flags, "row"), "flagged")

    suspects = flagged.filter("suspect").select("doc_id", "row", "sha")
    texts = semi_join(src, flagged.filter("suspect").select("doc_id"))
    # byte verification: one group per distinct text, however its digest came about
    verified = (texts.groupBy("text").agg(F.count(F.lit(1)).alias("_rows"))
                .select(F.sha2("text", 256).alias("sha")).groupBy("sha").agg(F.count(F.lit(1)).alias("texts")))
    groups = materialise(
        suspects.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"),
                                    F.max(F.struct("doc_id", "row")).alias("last"))
        .join(verified, "sha")
        .select("sha", "group_size", F.col("last.doc_id").alias("keep_id"), F.col("last.row").alias("keep_row"),
                F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts with one SHA-256"))).alias("_check")), "groups")
    joined = join_groups(suspects, groups, "sha", "group_size", flagged.count())
    out = ["doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")]
    return (joined.withColumn("kept", F.col("row") == F.col("keep_row")).filter(F.col("_check").isNull()).select(*out)
            .unionByName(flagged.filter(~F.col("suspect"))
                         .withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
                         .select(*out)))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that are copies of a row that stays.

    Repeated rows of one doc_id and text become one row: the drop is by (doc_id, text digest),
    then among rows that agree in both by a distinct over that pair.
    """
    groups = materialise(exact_groups(docs, id_col, text_col), "exact")
    # rows repeated with one doc_id and text: (doc_id, digest) pairs met more than once
    pair = ["doc_id", "text_sha256"]
    gone = groups.filter(~F.col("kept")).select(*pair).distinct()
    again = (groups.groupBy(*pair).agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept"))
             .filter((F.col("n") > 1) & F.col("kept")).select(*pair))
    gone, again = materialise(gone, "gone"), materialise(again, "again")
    cols, sha, key = docs.columns, fresh(docs, "_sha"), fresh(docs, "_key")
    keyed_docs = docs.select("*", F.sha2(F.coalesce(docs[text_col], F.lit("")), 256).alias(sha), docs[id_col].cast("long").alias(key))
    side_id, side_sha = fresh(keyed_docs, "_side_id"), fresh(keyed_docs, "_side_sha")

    def joined(ids: DataFrame, how: str) -> DataFrame:
        small = ids.count() * 100 <= BROADCAST_BYTES
        ids = ids.select(F.col("doc_id").alias(side_id), F.col("text_sha256").alias(side_sha))
        return keyed_docs.join(F.broadcast(ids) if small else ids,
                               F.col(key).eqNullSafe(F.col(side_id)) & (F.col(sha) == F.col(side_sha)), how)

    once = joined(gone.unionByName(again), "left_anti").select(*cols)
    return once.unionByName(joined(again, "left_semi").dropDuplicates([key, sha]).select(*cols))
