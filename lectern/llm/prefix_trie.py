"""Conversation prefix trie from padded turn-id matrices.

A turn's id is 128 bits of the SHA-256 of its role and text; a conversation is the sequence of its
ids.  Sequences are range-partitioned in lexicographic order (equal ones by conv_id, so that copies
of one conversation are dealt over many shards), and a shard is worked on as a matrix, a row per
conversation and a column per turn, padded with 0:

1. the rows are put in order by ``numpy.lexsort`` (a slab of columns at a time, so that one long
   conversation pads only the rows that are as long);
2. a column's change mask, OR-accumulated from the left, says where a row leaves its predecessor: a
   node starts where a turn is there and the mask is set;
3. per depth, ``reduceat`` over the node starts adds up the rows that reach it.

With c the length of the prefix that a row shares with the row before it (for a shard's first row
the last one of the shard before), every figure is a sum over rows: a row adds a child to its node
of depth d if it goes on and c <= d; it adds a leaf if the next row doesn't hold it whole; it saves
the words of its turns d to c.  So the nodes that go over shard borders, which are prefixes of a
shard's first or last row, are recombined by adding up their parts, keyed by depth and path.

Turns are ordered by ``turn`` (null first), equal ones by their id; null role or text is empty; rows
that repeat a turn are turns of their own; rows without conv_id are left out; a table without
conversations has no node, not even a root.  A conversation's ids, 20 bytes a turn, are one row.
Other columns are not read; role and text of any length are only hashed and counted.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import BROADCAST_BYTES, materialise, spans

#: turns in a shard, about
SHARD_TURNS = 400_000
#: columns sorted at a time
SLAB = 16
#: ids in one row of a boundary node's ends
ENDS = 50_000
#: words of a text
WORD = r"[^\x20\x09-\x0D]+"

_NODE = ("depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, path binary, parent_path binary, shard long, part long, ends binary")
_COLUMNS = [c.split()[0] for c in _NODE.split(", ")]


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, ids array<binary>, n_words array<int>) of each conversation."""
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    rows = turns.select(turns["conv_id"].cast("long").alias("conv_id"),
                        F.struct(turns["turn"].isNotNull().alias("known"), F.coalesce(turns["turn"].cast("long"), F.lit(0)).alias("turn"),
                                 digest.alias("id"), F.regexp_count(text, F.lit(WORD)).alias("n_words")).alias("t"))
    in_order = rows.filter("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return in_order.select("conv_id", F.col("t.id").alias("ids"), F.col("t.n_words").alias("n_words"))


def rebuilt(seqs: DataFrame) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation c - c % 20;
    h = crc32(c as text) % 4."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % 4).cast("int")
    heads = seqs.filter(c % 20 == 0).select(c.alias("head"), F.slice("ids", 1, 3).alias("head_ids"), F.slice("n_words", 1, 3).alias("head_words"))
    both = seqs.withColumn("h", h).withColumn("head", c - c % 20).join(heads, "head", "left")

    def spliced(head: str, own: str, kind: str):
        return F.concat(F.coalesce(F.slice(head, F.lit(1), F.col("h")), F.array().cast(kind)),
                        F.slice(own, F.col("h") + 1, F.size(own))).alias(own)
    return both.select("conv_id", spliced("head_ids", "ids", "array<binary>"), spliced("head_words", "n_words", "array<int>"))


# ---------------------------------------------------------------- one shard

class Matrix:
    """The rows of a shard in lexicographic order of (turn ids, conv_id).

    ids: dense numbers of the turns' ids in their order, from 1; first: n + 1 offsets of the rows."""

    def __init__(self, conv: np.ndarray, first: np.ndarray, ids: np.ndarray, n_words: np.ndarray):
        size = np.diff(first)
        order = np.argsort(conv, kind="stable")
        shared = np.zeros(len(conv), np.int64)  # of each place: columns equal to those of the place before
        group = np.zeros(len(conv), np.int64)  # of each place: rows equal in the columns seen so far
        at, same = 0, np.r_[False, np.ones(max(0, len(conv) - 1), bool)]
        live = np.arange(len(conv))  # places whose rows go on
        while len(live):
            rows = order[live]
            cols = at + np.arange(SLAB)
            there = cols < size[rows][:, None]
            matrix = np.where(there, ids[np.minimum(first[rows][:, None] + cols, len(ids) - 1)], 0) if len(ids) else np.zeros((len(rows), SLAB), np.int64)
            # of rows that are equal so far, those that end come first
            by = np.lexsort((size[rows] > at + SLAB, *matrix.T[::-1], group[live]))
            order[live] = rows[by]
            matrix = matrix[by]
            # the change mask of a row against the place before it; if that has ended, all is change
            change = np.ones(matrix.shape, bool)
            next_to = np.flatnonzero(np.diff(live) == 1) + 1
            change[next_to] = matrix[next_to] != matrix[next_to - 1]
            # a place in another group than the one before it shares no further column with that
            change |= ~same[live][:, None]
            change = np.logical_or.accumulate(change, axis=1)
            shared[live] += (~change & (matrix > 0)).sum(1)
            # groups after this slab: a new one wherever a row has left its predecessor
            new = np.ones(len(live), bool)
            new[next_to] = change[next_to, -1]
            group[live] = live[np.maximum.accumulate(np.where(new, np.arange(len(live)), 0))]
            at += SLAB
            same[live] = ~new
            on = size[order[live]] > at
            live = live[on]
        self.conv, self.size, self.shared = conv[order], size[order], shared
        take = spans(first[order], self.size)
        self.ids, self.n_words = ids[take], n_words[take]
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        self.words = np.concatenate([[0], np.cumsum(self.n_words)])


def nodes(m: Matrix, digests: np.ndarray, before: int, after: int, shard: int) -> pd.DataFrame:
    """The nodes of a shard; those that go on in another one by their path and with their ends.

    before, after: shared columns of the first row with the row before the shard, and of the last
    row with the row after it; -1 without one.  digests: 16 bytes of each place of ``m.ids``."""
    n = len(m.conv)
    shared = m.shared.copy()
    shared[0] = before
    following = np.append(shared[1:], after)
    leaf = following < m.size
    saved_to = m.words[m.first[:-1] + np.maximum(shared, 0)]
    out = []
    above = np.zeros(n, np.int64)  # of each row the number of its node one depth above
    above_conv, above_path = np.zeros(0, np.int64), []
    path = {0: hashlib.blake2b(digest_size=16), n - 1: hashlib.blake2b(digest_size=16)}  # first and last row
    for depth in range(int(m.size.max()) + 1):
        rows = np.flatnonzero(m.size >= depth)
        start = shared[rows] < depth
        start[0] = True  # of this shard's part of the node
        at = np.flatnonzero(start)
        count = np.diff(np.append(at, len(rows)))
        add = lambda x: np.add.reduceat(x.astype(np.int64), at)
        conv = np.minimum.reduceat(m.conv[rows], at)
        children = add((m.size[rows] > depth) & (shared[rows] <= depth))
        below = saved_to[rows] - m.words[m.first[rows] + max(depth - 1, 0)]
        saved = add(np.where(shared[rows] >= depth, below, 0))
        ends_here = m.size[rows] == depth
        frame = pd.DataFrame({"depth": depth, "conv_id": conv, "n_convs": count, "n_children": children, "n_leaves": add(leaf[rows]),
                              "saved_tokens": saved, "shard": shard, "part": 0})
        border = [None] * len(at)
        for row in {0, n - 1}:
            if m.size[row] >= depth:
                if depth:
                    path[row].update(digests[m.first[row] + depth - 1].tobytes())
                k = int(np.searchsorted(at, np.searchsorted(rows, row), "right")) - 1
                if before >= depth and row == 0 or after >= depth and row == n - 1:
                    border[k] = path[row].digest()
        parent = above[rows[at]]
        frame["parent_conv_id"] = pd.array(above_conv[parent] if depth else [None] * len(at), "Int64")
        frame["parent_path"] = [above_path[p] for p in parent] if depth else None
        frame["path"] = border
        ends, sha, more = [None] * len(at), [None] * len(at), []
        upto = np.append(0, np.cumsum(ends_here))
        ended = m.conv[rows[ends_here]]  # within a node in order of conv_id, as equal rows are
        for k, (a, c) in enumerate(zip(upto[at].tolist(), upto[at + count].tolist())):
            if border[k] is None:
                sha[k] = hashlib.sha256(",".join(map(str, ended[a:c].tolist())).encode()).hexdigest()
            else:
                ends[k] = ended[a:min(c, a + ENDS)].tobytes()
                more += [(depth, border[k], shard, i, ended[j:min(c, j + ENDS)].tobytes())
                         for i, j in enumerate(range(a + ENDS, c, ENDS), 1)]
        frame["ends_sha256"], frame["ends"] = sha, ends
        out.append(frame)
        if more:
            rest = pd.DataFrame(more, columns=["depth", "path", "shard", "part", "ends"])
            out.append(rest.assign(conv_id=2**63 - 1, n_convs=0, n_children=0, n_leaves=0, saved_tokens=0))
        above[rows] = np.repeat(np.arange(len(at)), count)
        above_conv, above_path = conv, border
    return pd.concat(out, ignore_index=True).reindex(columns=_COLUMNS)


def _shard_nodes(pdf: pd.DataFrame) -> pd.DataFrame:
    first = np.concatenate([[0], np.cumsum([len(x) for x in pdf["ids"]])])
    raw = b"".join(d for x in pdf["ids"] for d in x)
    halves = np.frombuffer(raw, ">u8").reshape(-1, 2).astype(np.uint64)
    by = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.ones(len(by), bool)
    new[1:] = (halves[by[1:]] != halves[by[:-1]]).any(1)
    ids = np.zeros(len(by), np.int64)
    ids[by] = np.cumsum(new)
    words = np.concatenate([np.asarray(x, np.int64) for x in pdf["n_words"]]) if first[-1] else np.zeros(0, np.int64)
    m = Matrix(pdf["conv_id"].to_numpy(np.int64), first, ids, words)
    place = np.zeros(len(by) + 1, np.int64)
    place[ids[by][new]] = by[new]  # an occurrence of each id
    return nodes(m, np.frombuffer(raw, np.uint8).reshape(-1, 16)[place[m.ids]], int(pdf["before"].iloc[0]), int(pdf["after"].iloc[0]), int(pdf["shard"].iloc[0]))


# ---------------------------------------------------------------- all shards

_HASHED = pa.schema([("depth", pa.int64()), ("path", pa.binary()), ("ends_sha256", pa.string())])


def _joined_ends(batches):
    """SHA-256 of the ids of each boundary node, whose parts come in order, one after another."""
    key, state, empty, done = None, None, True, []
    for b in batches:
        for depth, path, ends in zip(b.column("depth").to_pylist(), b.column("path").to_pylist(), b.column("ends").to_pylist()):
            if (depth, path) != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state, empty = (depth, path), hashlib.sha256(), True
            if ends:
                state.update(("" if empty else ",").encode() + ",".join(map(str, np.frombuffer(ends, np.int64).tolist())).encode())
                empty = False
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _HASHED)], schema=_HASHED)
            done = []
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*key, state.hexdigest()), _HASHED)], schema=_HASHED)


def _equal_columns(a, b):
    """How many first elements two arrays share."""
    both = F.zip_with(F.slice(a, 1, F.least(F.size(a), F.size(b))), F.slice(b, 1, F.least(F.size(a), F.size(b))), lambda x, y: x != y)
    at = F.array_position(both, True)
    return F.when(at > 0, at - 1).otherwise(F.size(both))


def prefix_trie(seqs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """seqs(conv_id, ids, n_words) -> a row per node: conv_id (its smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    seqs = materialise(seqs.select("conv_id", "ids", "n_words"), "sequences")
    size = seqs.agg(F.sum(F.size("ids") + 1).alias("n")).first()["n"] or 0
    shards = max(1, -(-int(size) // shard_turns))
    # written, so that a lost task finds the same shards; equal sequences are cut by conv_id
    ranged = materialise(seqs.repartitionByRange(shards, "ids", "conv_id").withColumn("shard", F.spark_partition_id().cast("long")), "shards")
    edge = ranged.groupBy("shard").agg(F.min(F.struct("ids", "conv_id")).alias("lo"), F.max(F.struct("ids", "conv_id")).alias("hi"))
    in_order = Window.orderBy("shard")  # a row per shard
    edge = (edge.withColumn("last", F.lag("hi.ids").over(in_order)).withColumn("next", F.lead("lo.ids").over(in_order))
            .select("shard", F.coalesce(_equal_columns(F.col("last"), F.col("lo.ids")), F.lit(-1)).alias("before"),
                    F.coalesce(_equal_columns(F.col("hi.ids"), F.col("next")), F.lit(-1)).alias("after")))
    edge = materialise(edge, "borders")  # 16 bytes a shard
    found = materialise(ranged.join(F.broadcast(edge), "shard").groupBy("shard").applyInPandas(_shard_nodes, _NODE), "nodes")
    plain = found.filter("path is null")
    # nodes that go over borders: at most two a shard and depth
    pieces = found.filter("path is not null")
    sums = pieces.groupBy("depth", "path").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_path").alias("parent_path"), F.min("parent_conv_id").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    hashed = (pieces.select("depth", "path", "shard", "part", "ends").repartition("depth", "path").sortWithinPartitions("depth", "path", "shard", "part")
              .select("depth", "path", "ends").mapInArrow(_joined_ends, "depth long, path binary, ends_sha256 string"))
    border = materialise(sums.join(hashed, ["depth", "path"]), "border")
    every = plain.select(*border.columns).unionByName(border)
    # a parent on a border has its smallest member perhaps elsewhere
    up = border.select((F.col("depth") + 1).alias("depth"), F.col("path").alias("parent_path"), F.col("conv_id").alias("up"))
    small = up.count() * 64 <= BROADCAST_BYTES
    every = every.join(F.broadcast(up) if small else up, ["depth", "parent_path"], "left")
    return every.select("conv_id", "depth", F.coalesce("up", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                        "saved_tokens", "ends_sha256")


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations (see ``rebuilt``)."""
    return prefix_trie(rebuilt(materialise(sequences(conversations), "turns")))
