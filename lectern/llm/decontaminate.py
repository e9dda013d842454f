"""Benchmark decontamination by suffix arrays over the training texts.

Words are runs of digits, lower-cased letters and non-ASCII characters.  Each pack of
documents (a shard) becomes a sequence of word numbers in the benchmark's vocabulary; a word
outside it ends any match, so only runs of known words that are as long as the shortest
window are kept.  The task builds the suffix array of these runs by prefix doubling and
binary-searches every suffix of every benchmark item in it, one word deeper at a time: this
gives the longest verbatim match of each test suffix, its places, and the places where its
first 10 words (or the whole of a shorter item) occur.  Shards are independent, so the
results of all shards together are those of the corpus.

The benchmark travels to the tasks in blocks of at most ``BLOCK_BYTES`` of text; a larger
benchmark takes further passes over the documents.

Null or wordless texts have no words and no hits; a wordless item is in no document; a null
item_id is written ``null``; repeated rows are judged each; repeated items count once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import byte_table, keyed, materialise, packs, share, shared, spans, tidy, utf8, without, words

WINDOW = 10
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 2 << 20
_WORD = byte_table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)

_OUT = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n_words", pa.int64()), ("starts", pa.list_(pa.int64())),
                  ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
_OUT_DDL = "doc_id long, h long, n_words long, starts array<long>, ends array<long>, items array<string>"
_LONGEST = "item_id string, item_word long, match_words long, doc_id long, doc_word long"


class TestSet:
    """A benchmark block as word numbers: vocabulary hashes, items, suffixes and windows."""

    def __init__(self, item_ids: list[str], texts, window: int = WINDOW):
        buf, off = utf8(texts)
        _, _, h, first, check = words(buf, _WORD, off, twice=True)
        self.vocab, at = np.unique(h, return_index=True)
        self.check = check[at]  # a word is its two hashes, 128 bits
        self.ids = np.searchsorted(self.vocab, h).astype(np.int64) + 1
        self.item_ids = item_ids
        n = np.diff(first)
        self.item = np.repeat(np.arange(len(n)), n)  # of each suffix
        self.word = np.arange(len(h)) - np.repeat(first[:-1], n)
        self.left = np.repeat(first[1:], n) - np.arange(len(h))  # words from here to the item's end
        size = np.repeat(n, n)
        # a suffix begins a window if enough of its item follows
        self.window = np.where((self.left >= window) | ((size < window) & (self.word == 0)), np.minimum(size, window), 0)
        self.shortest = int(self.window[self.window > 0].min()) if len(h) else 0
        self.longest = int(n.max()) if len(n) else 0


def suffix_array(ids: np.ndarray, end: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by their words up to ``end`` (exclusive), to ``depth`` words at least,
    by prefix doubling.  ids: positive numbers; end[i]: end of the run that holds i."""
    n = len(ids)
    rank = ids.copy()
    reach = 1
    while reach < depth:
        nxt = np.arange(n) + reach
        tail = np.where(nxt < end, rank[np.minimum(nxt, n - 1)], 0)
        _, fresh = np.unique(rank * (int(rank.max()) + 1) + tail, return_inverse=True)
        if fresh.max() == rank.max() - 1 and reach > 1:
            rank = fresh + 1
            break
        rank = fresh + 1
        reach *= 2
    return np.argsort(rank, kind="stable")


def _bound(sa, ids, end, lo, hi, d, target, right):
    """For each search the first place in [lo, hi) whose word at depth d is >= target (> if right)."""
    lo, hi = lo.copy(), hi.copy()
    live = np.flatnonzero(lo < hi)
    while len(live):
        mid = (lo[live] + hi[live]) >> 1
        p = sa[mid] + d
        v = np.where(p < end[sa[mid]], ids[np.minimum(p, len(ids) - 1)], 0)
        up = v <= target[live] if right else v < target[live]
        lo[live[up]] = mid[up] + 1
        hi[live[~up]] = mid[~up]
        live = live[lo[live] < hi[live]]
    return lo


def search(sa, ids, end, test: TestSet):
    """Longest match of each test suffix and its interval, and the interval of its window."""
    m = len(test.ids)
    lo, hi = np.zeros(m, np.int64), np.full(m, len(sa), np.int64)
    length = np.zeros(m, np.int64)
    wlo, whi = np.zeros(m, np.int64), np.zeros(m, np.int64)
    live = np.arange(m)
    d = 0
    while len(live):
        target = test.ids[live + d]
        a = _bound(sa, ids, end, lo[live], hi[live], d, target, False)
        b = _bound(sa, ids, end, a, hi[live], d, target, True)
        ok = a < b
        live, a, b = live[ok], a[ok], b[ok]
        lo[live], hi[live], length[live] = a, b, d + 1
        d += 1
        at = test.window[live] == d
        wlo[live[at]], whi[live[at]] = a[at], b[at]
        live = live[test.left[live] > d]
    return length, lo, hi, wlo, whi


class Shard:
    """The runs of known words in a pack, their suffix array and the test suffixes' matches."""

    def __init__(self, table, test: TestSet):
        buf, off = utf8(table.column("text"))
        _, _, h, self.first, check = words(buf, _WORD, off, twice=True)
        self.n_words = np.diff(self.first)
        place = np.searchsorted(test.vocab, h)
        known = place < len(test.vocab)
        known[known] = (test.vocab[place[known]] == h[known]) & (test.check[place[known]] == check[known])
        n = len(h)
        # runs of known words of one document
        new = known.copy()
        new[1:] &= ~known[:-1]
        cut = self.first[1:-1][(self.first[1:-1] < n)]
        new[cut] = known[cut]
        stop = known.copy()
        stop[:-1] &= ~known[1:]
        cut = cut[cut > 0]
        stop[cut - 1] = known[cut - 1]
        a, b = np.flatnonzero(new), np.flatnonzero(stop) + 1
        long = (b - a) >= max(1, test.shortest)
        a, b = a[long], b[long]
        self.pos = spans(a, b - a)  # word positions in the pack
        self.any = bool(len(self.pos)) and test.shortest > 0
        if self.any:
            ids = place[self.pos] + 1
            end = np.repeat(np.cumsum(b - a), b - a)
            self.sa = suffix_array(ids, end, test.longest)
            self.length, self.lo, self.hi, self.wlo, self.whi = search(self.sa, ids, end, test)

    def doc_of(self, p: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, p, "right") - 1


def _hits(block):
    def hits(batches):
        test = shared(block)
        for table in packs(batches, SHARD_BYTES):
            shard = Shard(table, test)
            n = table.num_rows
            starts, ends, items = [[] for _ in range(n)], [[] for _ in range(n)], [[] for _ in range(n)]
            if shard.any and (found := np.flatnonzero(shard.whi > shard.wlo)).size:
                # equal windows of the benchmark have one interval
                key, which = np.unique(np.stack([shard.wlo[found], shard.whi[found], test.window[found]], 1), axis=0, return_inverse=True)
                count = key[:, 1] - key[:, 0]
                at = shard.pos[shard.sa[spans(key[:, 0], count)]]
                win = np.repeat(np.arange(len(key)), count)
                delta = np.zeros(int(shard.first[-1]) + 1, np.int64)
                np.add.at(delta, at, 1)
                np.add.at(delta, at + key[win, 2], -1)
                hit = np.cumsum(delta)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
                for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                    # a run of hits may go on into the next document: split there
                    d = int(shard.doc_of(np.array([a]))[0])
                    while a < b:
                        e = min(b, int(shard.first[d + 1]))
                        if e > a:
                            starts[d].append(a - int(shard.first[d]))
                            ends[d].append(e - int(shard.first[d]))
                        a, d = max(a, e), d + 1
                pair = np.unique(shard.doc_of(at) * len(key) + win)
                by = np.argsort(which, kind="stable")
                group = np.searchsorted(which[by], np.arange(len(key) + 1))
                w = pair % len(key)
                size = group[w + 1] - group[w]
                doc = np.repeat(pair // len(key), size)
                item = test.item[found[by[spans(group[w], size)]]]
                for d, i in np.unique(np.stack([doc, item], 1), axis=0).tolist():
                    items[d].append(test.item_ids[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip([table.column("doc_id").to_pylist(), table.column("h").to_pylist(),
                                                      shard.n_words, starts, ends, items], _OUT)], schema=_OUT)
    return hits


def _longest(block, least: int):
    def longest(batches):
        test = shared(block)
        for table in packs(batches, SHARD_BYTES):
            shard = Shard(table, test)
            if not shard.any:
                continue
            k = np.flatnonzero(shard.length >= least)
            p = shard.pos[shard.sa[shard.lo[k]]]
            d = shard.doc_of(p)
            yield pa.RecordBatch.from_arrays(
                [pa.array([test.item_ids[i] for i in test.item[k]], pa.string()), pa.array(test.word[k]), pa.array(shard.length[k]),
                 table.column("doc_id").take(pa.array(d)).combine_chunks(), pa.array(p - shard.first[d])],
                names=["item_id", "item_word", "match_words", "doc_id", "doc_word"])
    return longest


def _blocks(benchmark: DataFrame, window: int, block_bytes: int):
    """Broadcast test sets of bounded text size, made one at a time."""
    spark = benchmark.sparkSession
    b = benchmark.select(F.coalesce(benchmark["item_id"].cast("string"), F.lit("null")).alias("item_id"),
                         F.coalesce(benchmark["text"], F.lit("")).alias("text"))
    total = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-2 * int(total) // block_bytes)) if total > block_bytes else 1
    for i in range(n):
        part = b.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).toArrow() if n > 1 else b.toArrow()
        yield share(spark, TestSet(part.column("item_id").to_pylist(), part.column("text"), window))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, h, n_words, starts and ends of hit word runs, items."""
    src = keyed(docs).withColumn("h", F.xxhash64("text"))
    found, n = None, 0
    for block in _blocks(benchmark, window, block_bytes):
        part = src.mapInArrow(tidy(_hits(block)), _OUT_DDL)
        found = part if found is None else found.unionByName(part)
        n += 1
    if n == 1:
        return found
    # several passes: rows of one (doc_id, text) come once a pass; their runs are merged
    merged = found.groupBy("doc_id", "h", "n_words").agg(
        (F.count(F.lit(1)) / n).cast("int").alias("rows"),
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends")))).alias("runs"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    # a run that reaches into the last one extends it
    joined = F.aggregate("runs", F.expr("cast(array() as array<struct<starts:bigint,ends:bigint>>)"), lambda acc, r: F.when(
        (F.size(acc) > 0) & (r["starts"] <= F.element_at(acc, -1)["ends"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1),
                 F.array(F.struct(F.element_at(acc, -1)["starts"].alias("starts"),
                                  F.greatest(F.element_at(acc, -1)["ends"], r["ends"]).alias("ends")))))
        .otherwise(F.concat(acc, F.array(r))))
    return (merged.withColumn("runs", joined).withColumn("_copy", F.explode(F.sequence(F.lit(1), "rows")))
            .select("doc_id", "h", "n_words", F.col("runs.starts").alias("starts"), F.col("runs.ends").alias("ends"), "items"))


def longest_matches(docs: DataFrame, benchmark: DataFrame, least: int = WINDOW) -> DataFrame:
    """For each benchmark suffix with a match of ``least`` words or more, its longest verbatim
    match in the corpus and one place of it: item_id, item_word, match_words, doc_id, doc_word."""
    src, found = keyed(docs), None
    for block in _blocks(benchmark, least, BLOCK_BYTES):
        part = src.mapInArrow(tidy(_longest(block, least)), _LONGEST)
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("match_words", (-F.col("doc_id")).alias("d"), (-F.col("doc_word")).alias("w"))).alias("b")
    return found.groupBy("item_id", "item_word").agg(best).select(
        "item_id", "item_word", F.col("b.match_words").alias("match_words"), (-F.col("b.d")).alias("doc_id"),
        (-F.col("b.w")).alias("doc_word"))


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = contamination(docs, benchmark)
    runs = F.zip_with("ends", "starts", lambda e, s: e - s)
    n_hit = F.aggregate(runs, F.lit(0).cast("long"), lambda a, x: a + x)
    items = F.array_sort(F.array_distinct("items"))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark."""
    bad = materialise(contamination(docs, benchmark).filter(F.size("starts") > 0).select("doc_id", "h").distinct(), "contaminated")
    return without(docs, bad)
