"""Classes of documents with one shingle set: their pairs and families checked on whole texts.

A class has a number (cid), a set size (n), a fingerprint of its set (fp) and a representative (rep, a
doc_id).  Shards and blocks hold the texts of the representatives that they need, so a check sees whole
sets; no pair of a family leaves its task unless it is a link.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import BROADCAST_BYTES, U64, byte_table, discard, finish, join_groups, materialise, mix, packs, parts_for, utf8, words

PACK = 2 << 20
SHARD_TEXT = 2 << 20
#: pairs of one label beyond which they are dealt over several shards
LABEL_PAIRS = 2048
#: askers and members of a family's block
ASKERS, MEMBERS = 1024, 4096
#: stands for a null doc_id, below all others
LOW = -(1 << 63)
_WORD = byte_table(lambda b: b not in (32, 9, 10, 11, 12, 13))


def shingle_sets(table, size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles of ``size`` words."""
    buf, off = utf8(table.column("text"))
    _, _, h, first = words(buf, _WORD, off)
    n = len(h)
    x = np.zeros(n, np.uint64)
    if n >= size:
        y = h[:n - size + 1] + U64(size)
        for j in range(1, size):
            y = mix(y, h[j:n - size + 1 + j])
        x[:n - size + 1] = finish(y)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(x[a:b - size + 1]))
        elif b > a:
            y = h[a:a + 1] + U64(b - a)
            for j in range(a + 1, b):
                y = mix(y, h[j:j + 1])
            out.append(finish(y))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(x: np.ndarray) -> bytes:
    return hashlib.blake2b(x.tobytes(), digest_size=16).digest()


def sets_by_class(pdf: pd.DataFrame, size: int) -> tuple[pd.DataFrame, list[np.ndarray]]:
    """Rows of distinct classes and their sets."""
    pdf = pdf.drop_duplicates("cid").reset_index(drop=True)
    return pdf, shingle_sets(pa.table({"text": pa.array(pdf["text"], pa.string())}), size)


def texts_of(src: DataFrame, reps: DataFrame) -> DataFrame:
    """Texts joined to written class rows that name a document; both null-safe on the lowered id."""
    size = F.lit(64) + (F.size("shards") * 128 if "shards" in reps.columns else 0)
    small = (reps.agg(F.sum(size).alias("n")).first()["n"] or 0) <= BROADCAST_BYTES
    return src.join(F.broadcast(reps) if small else reps, "doc_id")


def _fit(size: int):
    """Drop rows whose text is not the class's, under a repeated doc_id."""
    def fit(batches):
        for table in packs(batches, PACK):
            ok = [fingerprint(x) == fp for x, fp in zip(shingle_sets(table, size), table.column("fp").to_pylist())]
            yield from table.select(["shards", "cid", "text"]).filter(pa.array(ok)).to_batches()
    return fit


def _named(wanted: DataFrame, classes: DataFrame) -> DataFrame:
    return materialise(wanted.join(classes.select("cid", "fp", F.col("rep").alias("doc_id")), "cid"), "wanted")


def verified(pairs: DataFrame, src: DataFrame, classes: DataFrame, size: int, check, parts=None) -> DataFrame:
    """What ``check`` (texts by class, pairs of a shard) finds among the pairs (a, b) of classes, written.

    Pairs of one neighbourhood share a shard, by the least class next to either end; those of a large
    one are dealt over several, by their second end unless ``parts`` tells otherwise."""
    pairs = materialise(pairs.select("a", "b"), "pairs")
    n = pairs.count()
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label"))
    near = (pairs.join(least, "a").join(least.select(F.col("a").alias("b"), F.col("label").alias("other")), "b")
            .select("a", "b", F.least("label", "other").alias("label")))
    sizes = materialise(near.groupBy("label").agg(F.count(F.lit(1)).alias("k")), "labels")
    part = F.pmod(F.xxhash64("b"), F.ceil(F.col("k") / LABEL_PAIRS)) if parts is None else parts
    dealt = materialise(join_groups(near, sizes, "label", "k", n).select("a", "b", "label", part.alias("part")), "dealt")
    ends = dealt.select("label", "part", F.col("a").alias("cid")).unionByName(dealt.select("label", "part", F.col("b").alias("cid"))).distinct()
    text = (classes.agg(F.sum("n")).first()[0] or 0) * 6 / max(1, classes.count())  # bytes of a text, about
    shards = parts_for(ends.count() * text, SHARD_TEXT)
    shard = F.pmod(F.xxhash64("label", "part"), F.lit(shards))
    reps = _named(ends.groupBy("cid").agg(F.collect_set(shard).alias("shards")), classes)
    texts = texts_of(src, reps).mapInArrow(_fit(size), "shards array<long>, cid long, text string").select(F.explode("shards").alias("shard"), "cid", "text")
    out = materialise(texts.groupBy("shard").cogroup(dealt.select("a", "b", shard.alias("shard")).groupBy("shard"))
                      .applyInPandas(check, "a long, b long").distinct(), "links")
    discard(pairs, sizes, dealt, reps)
    return out


def families(rows: DataFrame) -> DataFrame:
    """rows(g, cid), written -> (p, cid), written: each class with the least class of each of its groups g."""
    pivots = materialise(rows.groupBy("g").agg(F.min("cid").alias("p"), F.count(F.lit(1)).alias("size")).filter("size > 1"), "pivots")
    out = materialise(join_groups(rows, pivots, "g", "size", rows.count()).select("p", "cid").distinct(), "families")
    discard(pivots)
    return out


def within(members: DataFrame, labels: DataFrame | None, src: DataFrame, classes: DataFrame, size: int, search, may=None) -> DataFrame:
    """Links inside families (p, cid, n and columns that ``search`` reads), written.

    With labels (of the components so far) the classes outside the largest component of a family search
    the members of other components; without, all search all.  ``may`` (of n and the least size m in the
    family) leaves out classes that can have no link.  ``search`` gets a block: some of the classes that
    ask and some members, with their texts."""
    carried = [c for c in members.columns if c not in ("p", "cid", "n")]
    fam = members.withColumn("label", F.lit(0).cast("long")) if labels is None else (
        members.join(labels.select(F.col("node").alias("cid"), "label"), "cid", "left").withColumn("label", F.coalesce("label", "cid")))
    fam = materialise(fam, "labelled")
    total = fam.count()
    groups = (fam.groupBy("p", "label").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("m")).groupBy("p")
              .agg(F.max_by("label", F.struct("k", "label")).alias("major"), F.sum("k").alias("size"), F.min("m").alias("m"),
                   F.count(F.lit(1)).alias("labels")).filter("size > 1" if labels is None else "labels > 1"))
    groups = materialise(groups, "mixed")
    rows = join_groups(fam, groups, "p", "size", total).filter(F.lit(True) if may is None else may)
    rows = rows.withColumn("asks", F.lit(True) if labels is None else F.col("label") != F.col("major"))
    rows = materialise(rows.select("p", "cid", "label", "asks", *carried), "searched")
    parts = rows.groupBy("p").agg(F.sum(F.col("asks").cast("long")).alias("u"), F.count(F.lit(1)).alias("m")).filter("u > 0")
    parts = materialise(parts.select("p", "m", F.ceil(F.col("u") / ASKERS).alias("rows"), F.ceil(F.col("m") / MEMBERS).alias("cols")), "parts")
    dealt = join_groups(rows, parts, "p", "m", total)
    i, j = F.pmod(F.xxhash64("cid"), F.col("rows")), F.pmod(F.xxhash64("cid", F.lit(1)), F.col("cols"))
    seat = lambda r, c, asks: F.struct("p", r.alias("i"), c.alias("j"), F.lit(not asks).alias("member"), F.lit(asks).alias("asks"), "label", *carried)
    every = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    as_member, as_asker = F.transform(every("rows"), lambda r: seat(r, j, False)), F.transform(every("cols"), lambda c: seat(i, c, True))
    seats = dealt.select("cid", F.when(F.col("asks"), F.concat(as_member, as_asker)).otherwise(as_member).alias("seats"))
    reps = _named(seats.groupBy("cid").agg(F.flatten(F.collect_list("seats")).alias("shards")), classes)
    kind = reps.schema["shards"].dataType.simpleString()
    texts = texts_of(src, reps).mapInArrow(_fit(size), f"shards {kind}, cid long, text string").select(F.explode("shards").alias("s"), "cid", "text")
    blocks = texts.select("cid", "text", *[F.col("s")[c].alias(c) for c in ("p", "i", "j", "member", "asks", "label", *carried)])
    out = materialise(blocks.groupBy("p", "i", "j").applyInPandas(_seated(search), "a long, b long").distinct(), "links")
    discard(fam, groups, rows, parts, reps)
    return out


def _seated(search):
    def seated(pdf: pd.DataFrame) -> pd.DataFrame:
        # a class that asks and is asked has two rows
        roles = pdf.groupby("cid")[["member", "asks"]].any()
        one = pdf.drop_duplicates("cid").drop(columns=["member", "asks"]).join(roles, on="cid").reset_index(drop=True)
        return search(one)
    return seated


def labelled_rows(signed: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``signed`` (doc_id, h, n, fp): doc_id, n_shingles, component_id, h."""
    known = classes.join(labels.select(F.col("node").alias("cid"), "label"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    least = known.groupBy("label").agg(F.min("rep").alias("component_id"))
    known = materialise(known.join(least, "label").select("fp", "component_id", "copies"), "known")
    out = (join_groups(signed.filter("n > 0"), known, "fp", "copies", signed.count()).select("doc_id", "h", "n", "component_id")
           .unionByName(signed.filter("n = 0").select("doc_id", "h", "n", F.col("doc_id").alias("component_id"))))
    null = lambda c: F.when(F.col(c) != LOW, F.col(c)).alias(c)
    return out.select(null("doc_id"), F.col("n").alias("n_shingles"), null("component_id"), "h")
