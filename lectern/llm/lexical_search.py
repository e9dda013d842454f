"""Ranked lexical search with hashed max-sketches.

A document's impact of a term grows with its occurrences tf and is the same function for all its terms.
The index holds per document two sketches of its impacts: each hashes the terms to ``SKETCH`` coordinates
by other bits, and a coordinate keeps the maximum over its terms (of tf, up to 254; 255 stands for any
more).  A term's impact is at most that of its coordinate in either sketch, so the sum over a query's terms
of weight times the lesser of the two is an upper bound of the score.  (With one sketch a term that is not
in the document often meets another one's impact, and most documents are scored for some query.)

1. One pass over the texts writes the index, a row per pack of documents, and the statistics: N, L and
   the document frequency of each query term.
2. A batch of queries looks up the bounds of all documents of an index row by one matrix product: documents by terms by items.  The
   documents of the highest bounds are scored exactly from their texts; their k-th score is a threshold
   that no result can fall below.
3. Every document with a bound that reaches the threshold is scored exactly, and the first k stay.

The first threshold comes from one of ``FIRST_SHARE`` documents by the hash of the id, the second from
all documents that pass the first, so that rows that leave a task do not grow with the number of tasks.  Both
only save work: the result is exact.

Queries travel in blocks of bounded text.  Null texts and texts without terms have no score and do not
count in N; items without terms have no results; a repeated item is ranked each time; a repeated row of
``docs`` is a document each time; equal scores are in order of doc_id, null first.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import BROADCAST_BYTES, U64, byte_table, discard, expand, keyed, materialise, packs, share, shared, squeeze, utf8, words

TOP = 50
#: coordinates of a sketch, as many as 16 bits number
SKETCH = 1 << 16
FIRST_SHARE = 32
#: text of the items searched together (64 bytes more are counted for each)
BLOCK_BYTES = 64 << 10
PACK = 2 << 20
#: documents whose bounds are looked up together
LOOKUP = 512
UNIT = 10**9
_WORD = byte_table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
_LOW = -(1 << 63)
_INDEX = "kind int, a long, b long, c long, d long, n int, data binary"
_INDEX_ARROW = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("d", pa.int64()), ("n", pa.int32()),
                           ("data", pa.binary())])


def coordinates(h: np.ndarray) -> list[np.ndarray]:
    """A term's coordinate in each of the two sketches."""
    return [((h >> U64(s)) & U64(SKETCH - 1)).astype(np.int64) for s in (0, 32)]


class Batch:
    """A block of items: distinct terms by two hashes, and (item, term) pairs, each once."""

    def __init__(self, item_ids: list, texts):
        buf, off = utf8(texts)
        _, _, h, first, check = words(buf, _WORD, off, twice=True)
        self.item_ids = item_ids
        self.vocab, at, term = np.unique(h, return_index=True, return_inverse=True)
        self.check = check[at]
        item = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.item, self.term = np.unique(np.stack([item, term]), axis=1) if len(term) else (np.zeros(0, np.int64),) * 2

    def weigh(self, n_docs: int, df: np.ndarray) -> None:
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)

    def spread(self) -> "Batch":
        """In a task: the weights as a matrix, terms by items; the coordinates in use and each term's place among them."""
        self.by_term = np.zeros((len(self.vocab), len(self.item_ids)), np.int64)
        self.by_term[self.term, self.item] = self.weight[self.term]
        self.coords = [np.unique(c, return_inverse=True) for c in coordinates(self.vocab)]
        return self

    def place(self, h: np.ndarray, check: np.ndarray):
        """(which of the words are terms, their numbers)."""
        at = np.minimum(np.searchsorted(self.vocab, h), max(0, len(self.vocab) - 1))
        known = (self.vocab[at] == h) & (self.check[at] == check) if len(self.vocab) else np.zeros(len(h), bool)
        return known, at[known]


def _term_counts(table):
    """Of a pack: terms in each document; and (document, term) with tf; hashes of the terms."""
    buf, off = utf8(table.column("text"))
    _, _, h, first, check = words(buf, _WORD, off, twice=True)
    code, seen = pd.factorize(h)
    second = np.zeros(len(seen), np.uint64)
    second[code] = check
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    key, tf = np.unique(doc * max(1, len(seen)) + code, return_counts=True)
    return np.diff(first), key // max(1, len(seen)), key % max(1, len(seen)), tf, seen, second


def length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 100 - 50 + (50 * n * n_docs) // max(1, n_terms)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (UNIT * tf) // (1000 * tf + 20 * m)


def _scan(block, with_index: bool):
    """Kind 0: index rows; kind 1: document frequency (b) of each query term (a) in a task; kind 2: N (a) and L (b)."""
    def scan(batches):
        batch = shared(block)
        df = np.zeros(len(batch.vocab), np.int64)
        n_docs = n_terms = 0
        for table in packs(batches, PACK):
            n, doc, term, tf, seen, second = _term_counts(table)
            n_docs += int((n > 0).sum())
            n_terms += int(n.sum())
            known = np.full(len(seen), -1)
            ok, at = batch.place(seen, second)
            known[ok] = at
            at = known[term]
            df += np.bincount(at[at >= 0], minlength=len(df))
            if not with_index:
                continue
            (size, at, most), (size2, at2, most2) = (_sketch(doc, c[term], tf, len(n)) for c in coordinates(seen))
            ids = np.array([_LOW if x is None else x for x in table.column("doc_id").to_pylist()], np.int64)
            head = squeeze(ids, table.column("h").to_numpy(), n.astype(np.int64), size, size2)
            body = squeeze(at, most)  # the sketches of a pack one after another: coordinates and values
            yield _rows([(0, len(at), len(at2), len(head), len(body), len(n), head + body + squeeze(at2, most2))])
        some = np.flatnonzero(df)
        yield _rows([(1, t, d, 0, 0, 0, b"") for t, d in zip(some.tolist(), df[some].tolist())] + [(2, n_docs, n_terms, 0, 0, 0, b"")])
    return scan


def _sketch(doc: np.ndarray, coord: np.ndarray, tf: np.ndarray, n: int):
    """(coordinates in use of each document, coordinates, maxima of tf)."""
    key = doc * SKETCH + coord
    by = np.argsort(key, kind="stable")
    if not len(by):
        return np.zeros(n, np.int64), np.zeros(0, np.uint16), np.zeros(0, np.uint8)
    cut = np.flatnonzero(np.r_[True, np.diff(key[by]) != 0])
    at = key[by][cut]
    most = np.minimum(np.maximum.reduceat(tf[by], cut), 255).astype(np.uint8)
    return np.bincount(at // SKETCH, minlength=n).astype(np.int64), (at % SKETCH).astype(np.uint16), most


def _rows(rows: list) -> pa.RecordBatch:
    """Rows of the index table; of an index row a and b are the coordinates of the sketches, c and d the bytes of
    the parts before the last."""
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _INDEX_ARROW)], schema=_INDEX_ARROW)


class Sketches:
    """An index row: doc ids, text hashes, terms in each, and their sketches."""

    def __init__(self, n: int, filled: tuple[int, int], head: int, body: int, data: bytes):
        self.ids, self.h, self.n, *sizes = expand(data[:head], n, "<i8", "<i8", "<i8", "<i8", "<i8")
        parts = data[head:head + body], data[head + body:]
        self.parts = [(np.concatenate([[0], np.cumsum(s)]), *expand(x, k, "<u2", "u1")) for s, x, k in zip(sizes, parts, filled)]

    def bounds(self, batch: Batch, n_docs: int, n_terms: int):
        """(first document, upper bounds: documents by items), some documents at a time."""
        norm = length_norm(self.n, n_docs, n_terms)
        weights = batch.by_term.astype(float)
        places = []
        for used, _ in batch.coords:
            places.append(np.full(SKETCH, -1))
            places[-1][used] = np.arange(len(used))
        for a in range(0, len(self.ids), LOOKUP):
            z = min(a + LOOKUP, len(self.ids))
            least = None
            for (first, coord, most), place, (used, of_term) in zip(self.parts, places, batch.coords):
                at = slice(first[a], first[z])
                c = place[coord[at]]
                ok = c >= 0
                doc = np.repeat(np.arange(z - a), np.diff(first[a:z + 1]))[ok]
                tf = most[at][ok].astype(np.int64)
                sketch = np.zeros((z - a, len(used)))
                # 10^6 is the limit of the impact for any tf
                sketch[doc, c[ok]] = np.where(tf == 255, UNIT // 1000, impact(tf, norm[a + doc]))
                sketch = sketch[:, of_term]
                least = sketch if least is None else np.minimum(least, sketch)
            yield a, least @ weights


def _bounded(block, n_docs: int, n_terms: int, least: list[int], share_of: int, top: int | None):
    """(doc_id, h, item, bound) of documents whose bound reaches the item's ``least`` (1 or more): all of
    them, or the ``top`` highest ones of the task; of one of ``share_of`` documents."""
    def bounded(batches):
        batch = shared(block).spread()
        floor = np.maximum(np.array(least, float), 1)
        held = []
        for b in batches:
            for n, x, y, head, body, data in zip(*(b.column(k).to_pylist() for k in ("n", "a", "b", "c", "d", "data"))):
                s = Sketches(n, (x, y), head, body, data)
                use = (s.ids.view(np.uint64) * U64(0x9E3779B97F4A7C15) >> U64(32)) % U64(share_of) == 0
                for z, bound in s.bounds(batch, n_docs, n_terms):
                    bound[~use[z:z + len(bound)]] = 0
                    low = -np.partition(-bound, top - 1, axis=0)[top - 1] if top and len(bound) > top else 0
                    d, i = np.nonzero(bound >= np.maximum(floor, low))
                    if len(d):
                        held.append(pd.DataFrame({"doc_id": s.ids[z + d], "h": s.h[z + d], "item": i.astype(np.int32), "bound": bound[d, i]}))
                if top and len(held) > 64:
                    held = [_highest(held, top)]
                    full = held[0].groupby("item")["bound"].agg(["size", "min"])
                    full = full[full["size"] == top]
                    floor[full.index] = np.maximum(floor[full.index], full["min"])
                if not top and held:
                    yield pa.RecordBatch.from_pandas(pd.concat(held), preserve_index=False)
                    held = []
        if held:
            yield pa.RecordBatch.from_pandas(_highest(held, top), preserve_index=False)
    return bounded


def _highest(parts: list[pd.DataFrame], top: int) -> pd.DataFrame:
    every = pd.concat(parts).sort_values(["item", "bound"], ascending=[True, False], kind="stable")
    return every[every.groupby("item").cumcount() < top].reset_index(drop=True)


def _rescore(block, n_docs: int, n_terms: int):
    """Exact scores of a document for the items it is wanted for."""
    def rescore(batches):
        batch = shared(block).spread()
        for table in packs(batches, PACK):
            n, doc, term, tf, seen, second = _term_counts(table)
            known = np.full(len(seen), -1)
            ok, at = batch.place(seen, second)
            known[ok] = at
            at = known[term]
            use = at >= 0
            doc, at, tf = doc[use], at[use], tf[use]
            value = impact(tf.astype(np.int64), length_norm(n, n_docs, n_terms)[doc])
            begin = np.searchsorted(doc, np.arange(len(n) + 1))
            ids, items, scores = [], [], []
            for k, (d, wanted) in enumerate(zip(table.column("doc_id").to_pylist(), table.column("items").to_pylist())):
                a, e = begin[k], begin[k + 1]
                wanted = np.array(wanted, np.int64)
                score = value[a:e] @ batch.by_term[np.ix_(at[a:e], wanted)]
                some = score > 0
                ids += [d] * int(some.sum())
                items.append(wanted[some])
                scores.append(score[some])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.concatenate(items), pa.int32()),
                                              pa.array(np.concatenate(scores), pa.int64())], names=["doc_id", "item", "score"])
    return rescore


def _exact(src: DataFrame, wanted: DataFrame, block, n_docs: int, n_terms: int, name: str) -> DataFrame:
    """Scores of the wanted (doc_id, h, item), written."""
    docs = materialise(wanted.groupBy("doc_id", "h").agg(F.collect_set("item").alias("items")), f"{name}-wanted")
    size = docs.agg(F.sum(24 + 4 * F.size("items")).alias("n")).first()["n"] or 0
    side = docs.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "items")
    text = src.join(F.broadcast(side) if size <= BROADCAST_BYTES // 4 else side, (src["doc_id"] == F.col("_d")) & (src["h"] == F.col("_h")))
    out = materialise(text.select("doc_id", "text", "items").mapInArrow(_rescore(block, n_docs, n_terms), "doc_id long, item int, score long"), name)
    discard(docs)
    return out


def _first(scores: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id"))
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _thresholds(scores: DataFrame, k: int, n_items: int) -> list[int]:
    """Each item's k-th score so far, 1 if there are fewer: a number an item of the block."""
    out = [1] * n_items
    for r in _first(scores, k).filter(F.col("rank") == k).select("item", "score").collect():
        out[r["item"]] = max(1, r["score"])
    return out


def _blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int):
    b = items.select(items[item_col].alias("item_id"), F.coalesce(items[text_col], F.lit("")).alias("text"))
    total = b.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    for i in range(n):
        part = (b.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else b).toArrow()
        if part.num_rows:
            yield Batch(part.column("item_id").to_pylist(), part.column("text"))


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k best documents of each item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    src = keyed(docs, id_col=id_col, text_col=text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(_LOW))).withColumn("h", F.xxhash64("text"))
    index, out = None, None
    for batch in _blocks(items, item_col, item_text_col, block_bytes):
        scanned = materialise(src.mapInArrow(_scan(share(spark, batch), index is None), _INDEX), "scan")
        if index is None:
            index = scanned.filter("kind = 0").select("a", "b", "c", "d", "n", "data")
        total = scanned.filter("kind = 2").agg(F.sum("a").alias("n"), F.sum("b").alias("l")).first()
        n_docs, n_terms = int(total["n"] or 0), int(total["l"] or 0)
        df = np.zeros(len(batch.vocab), np.int64)
        for r in scanned.filter("kind = 1").groupBy("a").agg(F.sum("b").alias("df")).toLocalIterator():
            df[r["a"]] = r["df"]  # as many as the block has terms
        batch.weigh(n_docs, df)
        block = share(spark, batch)
        least = [1] * len(batch.item_ids)
        row = "doc_id long, h long, item int, bound double"
        for step, share_of in (("first", FIRST_SHARE), ("second", 1)):
            found = index.mapInArrow(_bounded(block, n_docs, n_terms, least, share_of, k), row)
            w = Window.partitionBy("item").orderBy(F.col("bound").desc(), "doc_id", "h")
            high = materialise(found.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).drop("r"), f"{step}-bounds")
            scores = _exact(src, high, block, n_docs, n_terms, f"{step}-scores")
            least = [max(x) for x in zip(least, _thresholds(scores, k, len(least)))]
            discard(high, scores)
        above = materialise(index.mapInArrow(_bounded(block, n_docs, n_terms, least, 1, None), row), "above")
        scores = _exact(src, above, block, n_docs, n_terms, "scores")
        best = materialise(_first(scores, k), "best")
        discard(above, scores)
        names = spark.createDataFrame(list(enumerate(batch.item_ids)), f"item int, item_id {items.schema[item_col].dataType.simpleString()}")
        best = best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"),
                                                            F.when(F.col("doc_id") != _LOW, F.col("doc_id")).alias("doc_id"), "score")
        out = best if out is None else out.unionByName(best)
    if out is None:
        kind = items.schema[item_col].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out
