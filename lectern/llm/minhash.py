"""Near-duplicate documents by b-bit MinHash.

A document is the set of its 3-word shingles (lower-cased A-Z; with fewer words, the whole sequence);
documents with one set are a class.

1. ``PERMUTATIONS`` hash functions of the set's shingles have a minimum each.  The minima make
   ``BANDS`` band keys of ``ROWS`` of them; after that only the lowest ``BITS`` bits of each are kept, as
   bit planes packed into 64-bit words.
2. Classes that share a band key are a family: each is paired with the least class of it.
3. A pair's similarity is estimated by counting bits: the share e of minima whose kept bits agree is
   J + (1 - J) / 2^b, so J = (e - 2^-b) / (1 - 2^-b).  Pairs estimated below ``ESTIMATE`` (4.5 standard
   deviations under the least similarity) are left; the others are compared on their full sets.
4. These links are contracted.  Where classes of several components are left in a family, those
   outside its largest component are estimated against all members of other components, and the pairs
   that pass are compared on full sets, best estimate first, until one links.

So rows grow with the input and every link is confirmed; a link of the least similarity, 0.85, shares no
band with a chance of (1 - 0.85^6)^20 = 0.00008.  Texts without words, null ones among them, have no
shingles and no links; a null doc_id ranks below all others; rows that repeat a document are in one class
and judged each; texts of any length are one row and one set.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import U64, discard, finish, join_groups, keyed, materialise, mix, packs, without
from lectern.llm.components import components
from lectern.llm.families import LOW, PACK, families, fingerprint, labelled_rows, sets_by_class, shingle_sets, verified, within

WORDS = 3
#: links have 100 * intersection >= LEAST * union
LEAST = 85
PERMUTATIONS, BANDS, ROWS, BITS = 128, 20, 6, 4
ESTIMATE = 0.70
_RANDOM = np.random.default_rng(11)
_XOR = _RANDOM.integers(0, 2**64, PERMUTATIONS, np.uint64)
_TIMES = _RANDOM.integers(0, 2**64, PERMUTATIONS, np.uint64) | U64(1)
#: pairs of a task whose sets are compared one by one; more are counted over inverted lists
FEW = 8


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of the hash functions over each (not empty) set."""
    cat = np.concatenate(sets)
    start = np.cumsum([0] + [len(x) for x in sets[:-1]])
    out = np.empty((len(sets), PERMUTATIONS), np.uint64)
    hashed = np.empty_like(cat)
    for k in range(PERMUTATIONS):
        np.bitwise_xor(cat, _XOR[k], out=hashed)
        hashed *= _TIMES[k]
        out[:, k] = np.minimum.reduceat(hashed, start)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    out = np.empty((len(m), BANDS), np.uint64)
    for j in range(BANDS):
        y = np.full(len(m), j + 1, np.uint64)
        for r in range(ROWS):
            y = mix(y, finish(m[:, j * ROWS + r]))
        out[:, j] = finish(y)
    return out


def signature(m: np.ndarray) -> np.ndarray:
    """The lowest bits of the minima: ``BITS`` planes of ``PERMUTATIONS`` bits, in 64-bit words."""
    low = finish(m)
    planes = [np.packbits(((low >> U64(b)) & U64(1)).astype(np.uint8), axis=1) for b in range(BITS)]
    return np.ascontiguousarray(np.concatenate(planes, axis=1)).view("<u8")


_WORDS_A_PLANE = PERMUTATIONS // 64


def similarity(differ):
    """Estimate from the number of minima whose kept bits differ."""
    c = 2.0**-BITS
    return (1 - differ / PERMUTATIONS - c) / (1 - c)


def estimates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated similarity of one signature with each row of ``y``."""
    d = (x ^ y).reshape(len(y), BITS, _WORDS_A_PLANE)
    return similarity(np.bitwise_count(np.bitwise_or.reduce(d, axis=1)).sum(axis=1))


def estimate_column(x, y):
    """The same of two array<long> columns."""
    differ = None
    for w in range(_WORDS_A_PLANE):
        planes = [x[b * _WORDS_A_PLANE + w].bitwiseXOR(y[b * _WORDS_A_PLANE + w]) for b in range(BITS)]
        any_ = planes[0]
        for p in planes[1:]:
            any_ = any_.bitwiseOR(p)
        differ = F.bit_count(any_) if differ is None else differ + F.bit_count(any_)
    return similarity(differ)


def _lists(a: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1) * a.shape[1], pa.int32()), pa.array(a.reshape(-1).view(np.int64)))


def _sign(batches):
    for table in packs(batches, PACK):
        sets = shingle_sets(table, WORDS)
        n = np.array([len(x) for x in sets])
        m = np.zeros((len(sets), PERMUTATIONS), np.uint64)
        some = np.flatnonzero(n)
        if len(some):
            m[some] = minima([sets[i] for i in some])
        yield pa.RecordBatch.from_arrays(
            [table.column("doc_id").combine_chunks(), table.column("h").combine_chunks(), pa.array(n, pa.int64()),
             pa.array([fingerprint(x) for x in sets], pa.binary()), _lists(signature(m)), _lists(band_keys(m))],
            names=["doc_id", "h", "n", "fp", "sig", "bands"])


def _linked(met, n, m):
    """100 * intersection >= LEAST * union."""
    return 100 * met >= LEAST * (n + m - met)


def _met(x: np.ndarray, y: np.ndarray) -> int:
    """Elements that two sorted sets share."""
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum())


def _check(docs: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """Links among a shard's pairs, but for pairs that links of the shard connect already."""
    docs, sets = sets_by_class(docs, WORDS)
    of = dict(zip(docs["cid"].tolist(), sets))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    out = []
    for a, b in zip(pairs["a"].tolist(), pairs["b"].tolist()):
        if a in of and b in of and find(a) != find(b) and _linked(_met(of[a], of[b]), len(of[a]), len(of[b])):
            out.append((a, b))
            root[find(b)] = find(a)
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _search(block: pd.DataFrame) -> pd.DataFrame:
    """A link of each asking class with each component that has one, of the block's members."""
    block, sets = sets_by_class(block, WORDS)
    sig = np.stack([np.asarray(s, np.int64) for s in block["sig"]]).view(np.uint64)
    cid, label = block["cid"].to_numpy(np.int64), block["label"].to_numpy(np.int64)
    n = np.array([len(x) for x in sets], np.int64)
    member = np.flatnonzero(block["member"])
    index = None
    out = []
    for i in np.flatnonzero(block["asks"]).tolist():
        y = member[(label[member] != label[i]) & (100 * np.minimum(n[i], n[member]) >= LEAST * np.maximum(n[i], n[member]))]
        if not len(y):
            continue
        e = estimates(sig[i], sig[y])
        y, e = y[e >= ESTIMATE], e[e >= ESTIMATE]
        y = y[np.argsort(-e, kind="stable")]
        if not len(y):
            continue
        if len(y) > FEW:
            if index is None:
                index = _inverted(sets, member)
            keys, start, size, who = index
            at = np.minimum(np.searchsorted(keys, sets[i]), len(keys) - 1)
            at = at[keys[at] == sets[i]]
            hits = [who[a:a + k] for a, k in zip(start[at].tolist(), size[at].tolist())]
            met = np.bincount(np.concatenate(hits), minlength=len(sets))[y] if hits else np.zeros(len(y), np.int64)
        else:
            met = np.array([_met(sets[i], sets[j]) for j in y.tolist()])
        y = y[_linked(met, n[i], n[y])]
        for j in y[np.unique(label[y], return_index=True)[1]].tolist():
            out.append((min(cid[i], cid[j]), max(cid[i], cid[j])))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _inverted(sets, member):
    cat = np.concatenate([sets[j] for j in member])
    who = np.repeat(member, [len(sets[j]) for j in member])
    by = np.argsort(cat, kind="stable")
    start = np.flatnonzero(np.r_[True, np.diff(cat[by]) != 0])
    return cat[by][start], start, np.diff(np.append(start, len(cat))), who[by]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, h (hash of the text)."""
    src = keyed(docs, id_col=id_col, text_col=text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(LOW)))
    signed = materialise(src.withColumn("h", F.xxhash64("text")).mapInArrow(
        _sign, "doc_id long, h long, n long, fp binary, sig array<long>, bands array<long>"), "signed")
    classes = materialise(signed.filter("n > 0").groupBy("fp").agg(
        F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"), F.min("sig").alias("sig"), F.min("bands").alias("bands"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    rows = materialise(classes.select(F.explode("bands").alias("g"), "cid"), "bands")
    members = families(rows)
    discard(rows)
    about = classes.select("cid", "n", "sig")
    members = materialise(members.join(about, "cid"), "members")
    pivots = members.groupBy("p").agg(F.count(F.lit(1)).alias("size")).join(
        about.select(F.col("cid").alias("p"), F.col("n").alias("m"), F.col("sig").alias("other")), "p")
    pivots = materialise(pivots, "pivots")
    star = join_groups(members.filter("p <> cid"), pivots, "p", "size", members.count())
    star = star.filter((100 * F.least("n", "m") >= LEAST * F.greatest("n", "m")) & (estimate_column(F.col("sig"), F.col("other")) >= ESTIMATE))
    found = verified(star.select(F.col("p").alias("a"), F.col("cid").alias("b")), src, classes, WORDS, _check)
    labels = components(found)
    more = within(members, labels, src, classes, WORDS, _search)
    found = materialise(found.unionByName(more).distinct(), "all-links")
    discard(members, pivots)
    return labelled_rows(signed.select("doc_id", "h", "n", "fp"), classes, components(found))


def near_duplicate_digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one of the least doc_id."""
    found = near_duplicates(docs)
    bad = materialise(found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "h").distinct(), "near")
    return without(docs, bad)
