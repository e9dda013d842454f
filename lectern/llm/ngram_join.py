"""N-gram Jaccard join by T-occurrence search (DivideSkip), and its components.

Documents with one shingle set are a class; a class joins once.  A class of n shingles that
is to reach the threshold shares at least T = ceil(0.8 n) of them with its partner.

1. One order of all shingles is fixed: those of long lists last, the others by hash.  Of the
   first q = n - T + 1 of a class one at least is in its partner too, and among the first q of that.
   A class sends these and some more to the owners of hash ranges, which build the inverted lists.
   Which lists are long (over ``SHORT_LIST`` classes) shows only there: shingles that many
   documents of a task hold are known before (``hot``) and never sent, and a class that has sent too
   few others sends the rest of its set, until nothing changes.  When few shingles are sent late
   (``LATE_KEYS``, which are broadcast), only their lists are built again, else all are.
2. Lists that are not long are merged, which gives candidates and how often each was met.
3. Only classes of which more than four fifths lie in long lists (``core``: members of large groups
   of near copies) may have partners that no short list shows; what they share is in long lists
   alone.  In each list of their order's first shingles they are compared with its least class;
   these links are contracted, and where classes of several components are left in one family (the
   classes compared with one), those outside its largest component search the others.
4. Candidates are checked in shards, which hold the whole sets of the documents they need: a
   document is searched among its partners by DivideSkip (heap merge of short lists with
   skips, binary probes of long ones), then by 100 * intersection >= 80 * union.  Partners that
   links of the shard already connect to it are not searched again.

No list is cut or left out, and no pairs of a long list leave a task: rows grow with the input.  The
links found connect what all links connect.  ``links`` searches every family in full and returns
every link between classes, as many as there are.  Null, empty or blank texts have no shingles and no
links; a null doc_id ranks below all others (its component_id is null); rows that repeat a document
are in one class; very long texts are one row and one set.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import U64, discard, expand, join_groups, keyed, materialise, packs, parts_for, release, share, shared, spans, squeeze, tidy, without
from lectern.llm.components import components
from lectern.llm.families import LOW, PACK, families, fingerprint, labelled_rows, sets_by_class, shingle_sets, texts_of, verified, within

WORDS = 5
SHORT_LIST = 16
#: bits of a shingle by which owners know it (two that share them only make more candidates)
KEY = (1 << 48) - 1
OWNER_POSTINGS = 200_000
#: in full mode, pairs of a block: those of two parts of a label's classes
BLOCK_PAIRS = 1 << 16
#: a task reports shingles that so many of its classes hold, or one of HOT_SHARE; at most HOT_KEYS shingles
#: are hot, those of most classes (any set will do: it only fixes the order)
HOT_LEAST, HOT_SHARE, HOT_KEYS = 3, 2000, 1 << 20
#: shingles sent late up to which only the lists that they change are built again
LATE_KEYS = 1 << 20
#: partners searched at a time in full mode
ASKED = 256


def _sets(table) -> list[np.ndarray]:
    return shingle_sets(table, WORDS)


def needed(n):
    """T: least number of shingles that a class of n shares with a partner."""
    return -(-4 * n // 5)


def prefix(n):
    """q: of so many shingles, first in the common order, a partner shares one."""
    return n - needed(n) + 1


def sent(n):
    """How many shingles a class of n sends at first."""
    q = prefix(n)
    return q + (3 * q) // 10 + 2


_SIGNED = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("fp", pa.binary())])


def _add_up(keys: list, counts: list):
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return [key], [np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64)]


def _sign(batches):
    """Kind 0: a row's text hash, set size and fingerprint; kind 1: a shingle (h) that n classes of the
    task hold, counted in packs that hold it twice."""
    keys, counts, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for table in packs(batches, PACK):
        sets = _sets(table)
        prints = [fingerprint(x) for x in sets]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(len(sets), np.int32)), table.column("doc_id").combine_chunks(), table.column("h").combine_chunks(),
             pa.array([len(x) for x in sets], pa.int64()), pa.array(prints, pa.binary())], schema=_SIGNED)
        sets = list(dict(zip(prints, sets)).values())
        held += len(sets)
        k, c = np.unique(np.concatenate(sets), return_counts=True)
        keys.append(k[c > 1])
        counts.append(c[c > 1])
        if len(keys) > 32:
            keys, counts = _add_up(keys, counts)
    (key,), (count,) = _add_up(keys, counts)
    often = count >= max(HOT_LEAST, held // HOT_SHARE)
    key, count = key[often], count[often]
    yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(key), np.int32)), pa.nulls(len(key), pa.int64()), pa.array(key.view(np.int64)),
                                      pa.array(count), pa.nulls(len(key), pa.binary())], schema=_SIGNED)


def _messages(h, cid, size, buckets):
    to = (h & U64(0xFFFFFFFF)).astype(np.int64) % buckets
    o = np.lexsort((h, to))
    cut = np.searchsorted(to[o], np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(cut)):
        i = o[cut[k]:cut[k + 1]]
        yield int(k), len(i), squeeze(h[i], cid[i], size[i])


_POSTING = ("<u8", "<i8", "<i4")
_SENT = "bucket int, n long, data binary"


#: bucket of the rows that tell what a class has sent: class, size, sent, all that are not hot
_ABOUT = -1
_ABOUT_TYPES = ("<i8", "<i8", "<i8", "<i8")


def _members(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    if not len(of):
        return np.zeros(len(x), bool)
    return of[np.minimum(np.searchsorted(of, x), len(of) - 1)] == x


def _send(buckets: int, block, part: str):
    """Messages of the shingles that are not hot: the first ones, the rest, or (all) the whole sets."""
    def send(batches):
        hot = shared(block)
        for table in packs(batches, 2 * PACK):
            parts, about = [], []
            for cid, fp, x in zip(table.column("cid").to_pylist(), table.column("fp").to_pylist(), _sets(table)):
                if fingerprint(x) != fp:
                    continue  # another text under a repeated doc_id
                y, s = x, int(sent(len(x)))
                if part != "all":
                    y = x[~_members(x, hot)]
                    if part == "first":
                        about.append((cid, len(x), min(s, len(y)), len(y)))
                    y = y[:s] if part == "first" else y[s:]
                parts.append((y & U64(KEY), np.full(len(y), cid, np.int64), np.full(len(y), len(x), np.int32)))
            if parts:
                rows = list(_messages(*(np.concatenate(c) for c in zip(*parts)), buckets))
                if about:
                    rows.append((_ABOUT, len(about), squeeze(*np.array(about, np.int64).T)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary()))],
                                                     names=["bucket", "n", "data"])
    return send


def _about(batches):
    for pdf in batches:
        for n, data in zip(pdf["n"], pdf["data"]):
            yield pd.DataFrame(dict(zip(("cid", "n", "sent", "cold"), expand(data, n, *_ABOUT_TYPES))))


def _postings(pdf: pd.DataFrame):
    """Postings of a bucket ordered by shingle, size and class, each once."""
    h, cid, n = (np.concatenate(c) for c in zip(*(expand(d, k, *_POSTING) for k, d in zip(pdf["n"], pdf["data"]))))
    o = np.lexsort((cid, n, h))
    h, cid, n = h[o], cid[o], n[o]
    new = np.r_[True, (h[1:] != h[:-1]) | (cid[1:] != cid[:-1])]
    return h[new], cid[new], n[new]


def _lists(h: np.ndarray):
    s = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    return s, np.diff(np.append(s, len(h)))


def _may_link(n, m):
    return 5 * np.minimum(n, m) >= 4 * np.maximum(n, m)


_CANDIDATE = "kind int, a long, b long, met long"


def _long_counts(cid: np.ndarray, size: np.ndarray, short_list: int):
    """How many shingles of each class are in long lists of the bucket."""
    return np.unique(cid[np.repeat(size > short_list, size)], return_counts=True)


def _count_long(short_list: int):
    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        h, cid, _ = _postings(pdf)
        who, k = _long_counts(cid, _lists(h)[1], short_list)
        return pd.DataFrame({"kind": 2, "a": who, "b": 0, "met": k})
    return count


def _count_pairs(a, b) -> pd.DataFrame:
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    o = np.lexsort((hi, lo))
    lo, hi = lo[o], hi[o]
    s = np.flatnonzero(np.r_[True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]) if len(lo) else np.zeros(0, np.int64)
    return pd.DataFrame({"kind": 0, "a": lo[s], "b": hi[s], "met": np.diff(np.append(s, len(lo)))})


def _own(short_list: int):
    """Kind 0: candidates of the short lists and how often they met; kind 1: the shingles (a) of
    long lists, of bucket b; kind 2: classes (a) and how many shingles they have in long lists (met)."""
    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        h, cid, n = _postings(pdf)
        at, size = _lists(h)
        short = (size > 1) & (size <= short_list)
        s, z = at[short], size[short]
        pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for k in range(1, short_list):
            more = z > k
            s, z = s[more], z[more]
            if not len(s):
                break
            i = spans(s, z - k)
            i = i[_may_link(n[i], n[i + k])]
            pairs.append((cid[i], cid[i + k]))
        out = _count_pairs(*(np.concatenate(c) for c in zip(*pairs)))
        long = h[at[size > short_list]].view(np.int64)
        who, k = _long_counts(cid, size, short_list)
        release()
        return pd.concat([out, pd.DataFrame({"kind": 1, "a": long, "b": int(pdf["bucket"].iloc[0]), "met": 0}),
                          pd.DataFrame({"kind": 2, "a": who, "b": 0, "met": k})], ignore_index=True)
    return own


def _own_change(short_list: int):
    """What late postings change in the result of ``_own``: the lists as they are now, less as they were."""
    own = _own(short_list)

    def change(pdf: pd.DataFrame) -> pd.DataFrame:
        now, before = own(pdf), pdf[~pdf["late"]]
        if not len(before):
            return now
        was = own(before)
        was = was[was["kind"] != 1].assign(met=lambda x: -x["met"])
        return pd.concat([now, was], ignore_index=True)
    return change


def _keys(batches):
    for pdf in batches:
        for n, data in zip(pdf["n"], pdf["data"]):
            yield pd.DataFrame({"h": np.unique(expand(data, n, *_POSTING)[0]).view(np.int64)})


def _only(block):
    """Of the sent postings those of the given shingles."""
    def only(batches):
        keys = shared(block)
        for pdf in batches:
            rows = []
            for bucket, n, data in zip(pdf["bucket"], pdf["n"], pdf["data"]):
                h, cid, size = expand(data, n, *_POSTING)
                i = _members(h, keys)
                if i.any():
                    rows.append((bucket, int(i.sum()), squeeze(h[i], cid[i], size[i])))
            if rows:
                yield pd.DataFrame(rows, columns=["bucket", "n", "data"])
    return only


def _changed(posted: DataFrame, rest: DataFrame, short_list: int) -> DataFrame | None:
    """Rows to add to what the owners found in ``posted`` when ``rest`` follows; None if that is too much to broadcast."""
    if (rest.agg(F.sum("n")).first()[0] or 0) > LATE_KEYS:
        return None
    keys = rest.mapInPandas(_keys, "h long").distinct().toPandas()["h"].to_numpy(np.int64).view(np.uint64)
    block = share(rest.sparkSession, np.sort(keys))
    old = posted.mapInPandas(_only(block), _SENT).withColumn("late", F.lit(False))
    both = old.unionByName(rest.withColumn("late", F.lit(True)))
    return materialise(both.groupBy("bucket").applyInPandas(_own_change(short_list), _CANDIDATE), "changed")


def _in_long(longs: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """Of the shingles of the asking classes those that are in long lists."""
    if not len(longs) or not len(asked):
        return pd.DataFrame({"cid": [], "shingle": []}).astype("int64")
    h, cid, _ = _postings(asked)
    i = _members(h, np.sort(longs["shingle"].to_numpy(np.int64).view(np.uint64)))
    return pd.DataFrame({"cid": cid[i], "shingle": h[i].view(np.int64)})


# ---------------------------------------------------------------- T-occurrence search

def divide_skip(lists: list[list[int]], least: int) -> dict[int, int]:
    """Ids that occur in at least ``least`` of the sorted lists, with their counts.

    The L longest lists are set aside; the others are merged on a heap, skipping ids that
    cannot occur ``least`` - L times; what is left is looked up in the long lists."""
    if least < 1 or not lists:
        return {}
    lists = sorted(lists, key=len)
    # with L long lists the merge costs what the short ones hold and each find L probes
    aside = min(least - 1, int(least / (0.01 * max(1, len(lists[-1])).bit_length() + 1)))
    short, long = (lists[:-aside], lists[-aside:]) if aside else (lists, [])
    want = least - aside
    heap = [(x[0], i, 0) for i, x in enumerate(short) if x]
    heapq.heapify(heap)
    found = {}
    while heap:
        top = heap[0][0]
        count, popped = 0, []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap))
            count += 1
        if count >= want:
            total = count
            for x in long:
                j = bisect_left(x, top)
                total += j < len(x) and x[j] == top
            if total >= least:
                found[top] = total
            for _, i, j in popped:
                if j + 1 < len(short[i]):
                    heapq.heappush(heap, (short[i][j + 1], i, j + 1))
        else:
            # ids before the want-th smallest head cannot occur want times
            while heap and len(popped) < want - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                break
            head = heap[0][0]
            for _, i, j in popped:
                j = bisect_left(short[i], max(head, top + 1) if want > 1 else top + 1, j)
                if j < len(short[i]):
                    heapq.heappush(heap, (short[i][j], i, j))
    return found


def _check(docs: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """Links among a shard's pairs, as many as connect what they connect.

    The larger document of a pair searches among its partners of the shard: one of each
    component found so far, then another of each that has failed."""
    docs, found = sets_by_class(docs, WORDS)
    sets = dict(zip(docs["cid"].tolist(), found))
    partners: dict[int, list[int]] = {}
    for a, b in zip(pairs["a"].tolist(), pairs["b"].tolist()):
        if a in sets and b in sets:
            d, e = (a, b) if (len(sets[a]), a) > (len(sets[b]), b) else (b, a)
            partners.setdefault(d, []).append(e)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    out = []
    for d in sorted(partners, key=lambda d: (len(sets[d]), d)):
        x = sets[d]
        least = int(needed(len(x)))
        open_ = sorted(set(partners[d]))
        while True:
            mine = find(d)
            turn: dict[int, int] = {}
            rest = []
            for e in open_:
                r = find(e)
                if r != mine:
                    if r in turn:
                        rest.append(e)
                    else:
                        turn[r] = e
            if not turn:
                break
            asked = list(turn.values())
            size = np.array([len(sets[e]) for e in asked])
            cat = np.concatenate([sets[e] for e in asked])
            who = np.repeat(np.arange(len(asked)), size)
            at = np.minimum(np.searchsorted(x, cat), len(x) - 1)
            same = x[at] == cat
            at, who = at[same], who[same]
            if len(at) >= least:
                o = np.argsort(at, kind="stable")
                s, many = _lists(at[o])
                ids = who[o].tolist()
                lists = [ids[i:i + m] for i, m in zip(s.tolist(), many.tolist())]
                for k, met in (divide_skip(lists, least) if len(lists) >= least else {}).items():
                    if 100 * met >= 80 * (len(x) + int(size[k]) - met):
                        out.append((min(d, asked[k]), max(d, asked[k])))
                        root[find(asked[k])] = find(d)
            open_ = rest
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _check_all(docs: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """All links among a shard's pairs: the larger document searches among all its partners."""
    docs, found = sets_by_class(docs, WORDS)
    sets = dict(zip(docs["cid"].tolist(), found))
    partners: dict[int, list[int]] = {}
    for a, b in zip(pairs["a"].tolist(), pairs["b"].tolist()):
        if a in sets and b in sets:
            d, e = (a, b) if (len(sets[a]), a) > (len(sets[b]), b) else (b, a)
            partners.setdefault(d, []).append(e)
    out = []
    for d, others in partners.items():
        x = sets[d]
        least = int(needed(len(x)))
        others = sorted(set(others))
        for i in range(0, len(others), ASKED):
            asked = others[i:i + ASKED]
            size = np.array([len(sets[e]) for e in asked])
            cat = np.concatenate([sets[e] for e in asked])
            who = np.repeat(np.arange(len(asked)), size)
            at = np.minimum(np.searchsorted(x, cat), len(x) - 1)
            same = x[at] == cat
            at, who = at[same], who[same]
            if 2 * len(at) >= len(asked) * len(x):
                met = np.bincount(who, minlength=len(asked))  # full lists: a merge has nothing to skip
                found = enumerate(met.tolist())
            else:
                o = np.argsort(at, kind="stable")
                s, many = _lists(at[o]) if len(at) else (np.zeros(0, np.int64),) * 2
                ids = who[o].tolist()
                lists = [ids[j:j + m] for j, m in zip(s.tolist(), many.tolist())]
                found = (divide_skip(lists, least) if len(lists) >= least else {}).items()
            out += [(min(d, asked[k]), max(d, asked[k])) for k, met in found
                    if met >= least and 100 * met >= 80 * (len(x) + int(size[k]) - met)]
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _verified(pairs: DataFrame, src: DataFrame, classes: DataFrame, full: bool) -> DataFrame:
    """Of the pairs (a, b) of classes, all links (full) or enough to connect all that they connect."""
    if not full:
        return verified(pairs, src, classes, WORDS, _check)
    # a class is in as many blocks as there are parts, not in one for each partner
    side = F.ceil(F.sqrt(F.col("k") / BLOCK_PAIRS))
    return verified(pairs, src, classes, WORDS, _check_all, F.pmod(F.xxhash64("a"), side) * side + F.pmod(F.xxhash64("b"), side))


def _search(full: bool):
    """Links of a block of a family: each asker is searched among the members that may be linked with
    it, in connect mode those of other components, of each of which one link will do."""
    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, sets = sets_by_class(pdf, WORDS)
        cid, label, long = (pdf[c].to_numpy(np.int64) for c in ("cid", "label", "long"))
        n = np.array([len(x) for x in sets], np.int64)
        member = np.flatnonzero(pdf["member"])
        who = np.repeat(member, n[member])
        cat = np.concatenate([sets[i] for i in member]) if len(member) else np.zeros(0, np.uint64)
        o = np.lexsort((who, cat))
        who = who[o]
        start, size = _lists(cat[o]) if len(cat) else (np.zeros(0, np.int64),) * 2
        keys = cat[o][start]
        out = []
        for i in np.flatnonzero(pdf["asks"]).tolist():
            x, least = sets[i], int(needed(n[i]))
            ok = _may_link(n[i], n) & (9 * np.minimum(long[i], long) >= 4 * (n[i] + n))
            ok &= (cid > cid[i]) if full else (label != label[i])
            ok[i] = False
            if not ok.any() or not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
            at = at[keys[at] == x]
            lists = [y[ok[y]].tolist() for y in (who[a:a + k] for a, k in zip(start[at].tolist(), size[at].tolist()))]
            lists = [y for y in lists if y]
            done = set()
            for j, met in (divide_skip(lists, least) if len(lists) >= least else {}).items():
                if 100 * met >= 80 * (n[i] + n[j] - met) and (full or label[j] not in done):
                    done.add(label[j])
                    out.append((min(cid[i], cid[j]), max(cid[i], cid[j])))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")
    return search


def _state(about: DataFrame, sent_all: DataFrame | None, owned: DataFrame) -> DataFrame:
    """What each class has sent: cid, n, q, a (sent shingles in no long list), whole (all that are not hot are sent)."""
    longs = owned.filter("kind = 2").groupBy(F.col("a").alias("cid")).agg(F.sum("met").alias("k"))
    x = about.join(longs, "cid", "left")
    if sent_all is not None:
        x = x.join(sent_all.select("cid", F.lit(True).alias("more")), "cid", "left")
    else:
        x = x.withColumn("more", F.lit(False))
    more = F.coalesce("more", F.lit(False))
    q = F.col("n") - ((F.col("n") * 4 + 4) / 5).cast("long") + 1
    return materialise(x.select("cid", "n", q.alias("q"), (F.when(more, F.col("cold")).otherwise(F.col("sent")) - F.coalesce("k", F.lit(0))).alias("a"),
                                (more | (F.col("sent") == F.col("cold"))).alias("whole")), "state")


def _met_often_enough(candidates: DataFrame, state: DataFrame) -> DataFrame:
    """Pairs (a, b) met as often as linked classes are.

    At most q - 1 shingles of a class are not its partner's, so of its a sent ones in short lists
    a - q + 1 are; they are met if the partner has sent as far or all.  One less is asked for, as two
    shingles of a class may share a key."""
    met = candidates.groupBy("a", "b").agg(F.sum("met").alias("met"))
    side = lambda c: state.select(F.col("cid").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("n", "q", "a", "whole")])
    met = met.join(side("a"), "a").join(side("b"), "b")
    owed = lambda c: F.greatest(F.col(f"a_{c}") - F.col(f"q_{c}"), F.lit(1))
    both = F.col("whole_a") & F.col("whole_b")
    least = (F.when(both, F.greatest(owed("a"), owed("b"))).when(F.col("whole_a"), owed("b")).when(F.col("whole_b"), owed("a"))
             .otherwise(F.least(owed("a"), owed("b"))))
    long = F.least(F.col("n_a") - F.col("a_a"), F.col("n_b") - F.col("a_b"))
    return met.filter((F.col("met") >= least) & (~both | (9 * (F.col("met") + long + 1) >= 4 * (F.col("n_a") + F.col("n_b"))))).select("a", "b")


def _within(members: DataFrame, labels: DataFrame | None, src: DataFrame, classes: DataFrame) -> DataFrame:
    # what a class shares with a partner that no short list shows is in long lists
    may = 9 * F.col("long") >= 4 * (F.col("n") + F.greatest(F.ceil(F.col("n") * 4 / 5), F.col("m")))
    return within(members, labels, src, classes, WORDS, _search(labels is None), may)


def _hot(signed: DataFrame, short_list: int) -> DataFrame:
    """Shingles that are known to be in long lists, those of most classes, as many as are broadcast safely."""
    often = signed.filter("kind = 1").groupBy("h").agg(F.sum("n").alias("k")).filter(F.col("k") > short_list)
    often = materialise(often, "often")
    by = sorted(often.groupBy(F.floor(F.log2("k")).alias("e")).agg(F.count(F.lit(1)).alias("c")).collect(), reverse=True)
    total, least = 0, 0
    for e, c in by:
        total += c
        if total > HOT_KEYS:
            least = 1 << (e + 1)
            break
    return often.filter(F.col("k") >= least).select("h")


def _linked(docs: DataFrame, id_col: str, text_col: str, short_list: int, full: bool):
    """(rows with their fingerprints, classes, links of classes, labels of linked classes)."""
    src = keyed(docs, id_col=id_col, text_col=text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(LOW)))
    every = materialise(src.withColumn("h", F.xxhash64("text")).mapInArrow(tidy(_sign), "kind int, doc_id long, h long, n long, fp binary"), "signed")
    signed = every.filter("kind = 0").drop("kind")
    classes = materialise(signed.filter("n > 0").groupBy("fp").agg(
        F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    buckets = parts_for(int((classes.agg(F.sum("n")).first()[0] or 0) * 0.3), OWNER_POSTINGS)
    hot = materialise(_hot(every, short_list), "hot")
    block = share(src.sparkSession, np.sort(hot.toPandas()["h"].to_numpy(np.int64).view(np.uint64)))
    by_doc = materialise(classes.select("cid", "fp", F.col("rep").alias("doc_id")), "by-doc")
    first = materialise(texts_of(src, by_doc).mapInArrow(tidy(_send(buckets, block, "first")), _SENT), "postings")
    about = materialise(first.filter(F.col("bucket") == _ABOUT).mapInPandas(_about, "cid long, n long, sent long, cold long"), "about")
    posted, sent_all = first.filter(F.col("bucket") != _ABOUT), None
    written = [by_doc, first, about]
    # the first time only long lists are looked for, with some room, so that fewer classes follow later
    owned = materialise(posted.groupBy("bucket").applyInPandas(_count_long(short_list), _CANDIDATE), "owned")
    built, state = [owned], _state(about, None, owned)
    room, counted = F.floor(F.col("q") / 10), True
    while True:
        short_of = materialise(state.filter(~F.col("whole") & (F.col("a") < F.col("q") + room)).select("cid"), "short-of")
        more = short_of.limit(1).count() > 0
        if not more and not counted:
            discard(short_of)
            break
        change = None
        if more:
            who = materialise(by_doc.join(short_of, "cid"), "rest-docs")
            rest = materialise(texts_of(src, who).mapInArrow(tidy(_send(buckets, block, "rest")), _SENT), "rest")
            if not counted:
                change = _changed(posted, rest, short_list)
            posted = posted.unionByName(rest)
            written += [rest, short_of]
            discard(who)
            sent_all = short_of if sent_all is None else sent_all.unionByName(short_of)
        if change is None:
            discard(*built)
            owned = materialise(posted.groupBy("bucket").applyInPandas(_own(short_list), _CANDIDATE), "owned")
            built = [owned]
        else:
            owned = owned.unionByName(change)
            built.append(change)
        if more:
            discard(state)
            state = _state(about, sent_all, owned)
        room, counted = F.lit(0), False
    discard(*written)

    pairs = _met_often_enough(owned.filter("kind = 0").select("a", "b", "met"), state)
    found = _verified(pairs, src, classes, full)
    core = materialise(state.filter(F.col("whole") & (F.col("a") < F.col("q"))), "core")
    if core.limit(1).count():
        who = materialise(classes.join(core.select("cid"), "cid").select("cid", "fp", F.col("rep").alias("doc_id")), "core-docs")
        asked = texts_of(src, who).mapInArrow(tidy(_send(buckets, block, "all")), _SENT)
        longs = owned.filter("kind = 1").select(F.col("b").cast("int").alias("bucket"), F.col("a").alias("shingle")).unionByName(
            hot.select(F.pmod(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(buckets)).cast("int").alias("bucket"), F.col("h").bitwiseAND(F.lit(KEY)).alias("shingle")))
        lists = (longs.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInPandas(_in_long, "cid long, shingle long")
                 .groupBy("cid").agg(F.array_sort(F.collect_list("shingle")).alias("lists")))
        sets = lists.join(core.select("cid", "n", (F.col("q") - F.col("a")).cast("int").alias("p")), "cid").withColumn("long", F.size("lists").cast("long"))
        sets = materialise(sets, "core-sets")
        rows = materialise(sets.select(F.explode(F.slice("lists", F.lit(1), F.col("p"))).alias("g"), "cid"), "core-lists")
        members = materialise(families(rows).join(sets.select("cid", "n", "long"), "cid"), "members")
        if not full:
            pivots = members.groupBy("p").agg(F.count(F.lit(1)).alias("size")).join(classes.select(F.col("cid").alias("p"), F.col("n").alias("m")), "p")
            pivots = materialise(pivots, "pivots")
            star = join_groups(members.filter("p <> cid"), pivots, "p", "size", members.count()).filter(5 * F.least("n", "m") >= 4 * F.greatest("n", "m"))
            star = _verified(star.select(F.col("p").alias("a"), F.col("cid").alias("b")), src, classes, False)
            found = materialise(found.unionByName(star).distinct(), "links")
            labels = components(found)
            more = _within(members, labels, src, classes)
        else:
            more = _within(members, None, src, classes)
        found = materialise(found.unionByName(more).distinct(), "links")
    discard(*built)
    return signed, classes, found, components(found)


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", short_list: int = SHORT_LIST) -> DataFrame:
    """All links between classes (documents with one shingle set), by their least doc_ids: a < b."""
    _, classes, found, _ = _linked(docs, id_col, text_col, short_list, True)
    null = lambda c: F.when(c != LOW, c)
    reps = classes.select("cid", "rep")
    out = (found.join(reps.select(F.col("cid").alias("a"), F.col("rep").alias("x")), "a")
           .join(reps.select(F.col("cid").alias("b"), F.col("rep").alias("y")), "b"))
    return out.select(null(F.least("x", "y")).alias("a"), null(F.greatest("x", "y")).alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", short_list: int = SHORT_LIST, full: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, h (hash of the text)."""
    signed, classes, _, labels = _linked(docs, id_col, text_col, short_list, full)
    return labelled_rows(signed, classes, labels)


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one of the least doc_id."""
    found = near_duplicates(docs)
    bad = materialise(found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "h").distinct(), "near")
    return without(docs, bad)
