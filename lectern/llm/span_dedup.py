"""Removal of repeated byte spans, by suffix arrays over shards of like contexts.

A 100-byte string is ``repeated`` where it also starts earlier (smaller doc_id, or earlier in
the document).  Every string has an anchor: the position of the smallest 32-byte hash in it,
so equal strings have equal seeds at the same place.  Consecutive strings of one document with
one anchor form a context (its bytes run from the first string's start to the last one's end).

1. One scan sends the seed, context hash and place of each context to the owner of its seed
   range, packed; contexts that repeat within a pack are settled there and not sent.
2. Owners drop seeds that occur once.  Of equal contexts the earliest represents the others,
   whose strings are all repeated.  Representatives go on if their seed has several.
3. Their bytes are fetched and dealt to shards by seed.  A shard drops strings whose 64-bit
   fingerprint occurs once in it, builds the suffix array of what is left by linear grouping
   (lyndon.py), and compares the bytes of neighbours: each class of equal strings keeps its
   earliest, in every representative.
4. The repeated strings' bytes are merged per document and cut from the text.

Contexts are taken for equal when seed and context hash agree (128 bits).  A seed with very many
contexts (``hot_seed``) would fill one owner; its contexts are dealt by their hash, and its
strings by fingerprint and seed, each keeping the earliest after a map-side reduction.

Null text is empty; texts under 100 bytes are kept whole.  Rows that repeat one doc_id and
text are one document to each other (they get the same result); rows of one doc_id with
different texts are ordered by a hash of the text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import BROADCAST_BYTES, U64, expand, keyed, materialise, mix, packs, parts_for, release, spans, squeeze, tidy, utf8
from lectern.llm.lyndon import suffix_array

SPAN = 100
SEED = 32
#: k-mers of a string; its anchor is the smallest of them
_KMERS = SPAN - SEED + 1
#: text bytes hashed at a time, sent as one pack, held by one owner, and of one shard
STEP_BYTES = 1 << 20
SEND_BYTES = 8 << 20
OWNER_BYTES = 16 << 20
SHARD_BYTES = 2 << 20
HOT_SEED = 200_000
#: parts of a shard, by seed, that are settled one after another: its arrays take some 100 bytes a text byte
SHARD_PARTS = 4

_KINDS = ("<u8", "<u8", "<i8", "<i8", "<i4", "u1", "u1")  # seed, context, doc_id, h, start, strings - 1, anchor - start
_SENT = "kind string, bucket int, n long, data binary"
_PLACES = "doc_id long, h long, a array<int>, b array<int>"


def _hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-byte hashes and 64-byte hashes at every position that has them."""
    h = np.ndarray((len(buf) - 7,), "<u8", buf.tobytes(), 0, (1,)).astype(np.uint64)
    h = mix(h[:-8], h[8:])
    h32 = mix(h[:-16], h[16:])
    return h32, mix(h32[:-32], h32[32:])


def _string_hash(h64: np.ndarray, at: np.ndarray) -> np.ndarray:
    return mix(h64[at], h64[at + SPAN - 64])


def contexts(buf: np.ndarray, off: np.ndarray):
    """(document, start in it, strings, anchor - start, seed, context hash) of all contexts."""
    n = len(buf)
    none = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2
    if n < SPAN:
        return none
    h32, h64 = _hashes(buf)
    # smallest k-mer of each string, the leftmost of equals: the low half of the key is its place
    m = (h32 & U64(0xFFFFFFFF00000000)) | np.arange(len(h32), dtype=np.uint64)
    reach = 1
    while reach < _KMERS:
        step = min(reach, _KMERS - reach)
        m = np.minimum(m[:-step], m[step:])
        reach += step
    anchor = (m & U64(0xFFFFFFFF)).astype(np.int64)
    count = n - SPAN + 1
    size = np.diff(off)
    strings = np.maximum(size - SPAN + 1, 0)
    doc_at = off[:-1]
    live = np.flatnonzero(strings)
    # a context ends where the anchor changes or a document's strings end
    new = np.zeros(count + 1, bool)
    new[1:count] = anchor[1:count] != anchor[:count - 1]
    new[doc_at[live]] = True
    new[doc_at[live] + strings[live]] = True
    first = np.flatnonzero(new)
    doc = np.searchsorted(off, first, "right") - 1
    inside = first < doc_at[doc] + strings[np.minimum(doc, len(strings) - 1)] if len(first) else np.zeros(0, bool)
    last = np.append(first[1:], count) - 1
    first, last, doc = first[inside], last[inside], doc[inside]
    p = anchor[first]
    ctx = mix(_string_hash(h64, first), _string_hash(h64, last))
    ctx = mix(ctx, ((p - first) * 256 + (last - first)).astype(np.uint64))
    return doc, first - doc_at[doc], last - first + 1, p - first, h32[p], ctx


def _bucket(seed: np.ndarray, n: int) -> np.ndarray:
    # the high bits are small by choice of the anchors, so low bits deal evenly
    return (seed & U64(0xFFFFFFFF)).astype(np.int64) % n


def _settle(cols, order_only: bool = False):
    """Sorted columns and a mask of the first of each (seed, context); exact repeats of a place
    (rows that repeat a document) are dropped."""
    seed, ctx, doc, h, start = cols[:5]
    o = np.lexsort((start, h, doc, ctx, seed))
    cols = [c[o] for c in cols]
    seed, ctx, doc, h, start = cols[:5]
    if len(seed):
        same = np.zeros(len(seed), bool)
        same[1:] = ((seed[1:] == seed[:-1]) & (ctx[1:] == ctx[:-1]) & (doc[1:] == doc[:-1]) & (h[1:] == h[:-1])
                    & (start[1:] == start[:-1]))
        if same.any():
            cols = [c[~same] for c in cols]
            seed, ctx = cols[:2]
    first = np.ones(len(seed), bool)
    first[1:] = (seed[1:] != seed[:-1]) | (ctx[1:] != ctx[:-1])
    return cols, first


def _by_document(doc: np.ndarray, h: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """One row per document: lists a and b; touching ranges [a, b) are joined."""
    o = np.lexsort((a, h, doc))
    doc, h, a, b = doc[o], h[o], a[o], b[o]
    if not len(doc):
        return pd.DataFrame({"doc_id": doc, "h": h, "a": pd.Series([], dtype=object), "b": pd.Series([], dtype=object)})
    new_doc = np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]
    # ranges of one document: start a new one where a lies behind all ends so far
    base = np.cumsum(new_doc) * (1 << 33)
    reach = np.maximum.accumulate(b + base)
    new = new_doc.copy()
    new[1:] |= (a + base)[1:] > reach[:-1]
    s = np.flatnonzero(new)
    lo = a[s]
    hi = (reach - base)[np.append(s[1:], len(a)) - 1]
    d = np.flatnonzero(new_doc[s])
    cut = np.append(d, len(s))
    return pd.DataFrame({"doc_id": doc[s][d], "h": h[s][d],
                         "a": [lo[x:y].astype(np.int32) for x, y in zip(cut, cut[1:])],
                         "b": [hi[x:y].astype(np.int32) for x, y in zip(cut, cut[1:])]})


def _null_id(column) -> np.ndarray:
    """Null ids sort below all others."""
    return column.fill_null(-(1 << 63)).to_numpy()


def _scan(buckets: int):
    places = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])

    def scan(batches):
        for table in packs(batches, SEND_BYTES):
            ids, hs = _null_id(table.column("doc_id")), table.column("h").to_numpy()
            parts, at = [], 0
            for step in packs(table.to_batches(), STEP_BYTES):
                doc, start, count, lead, seed, ctx = contexts(*utf8(step.column("text")))
                parts.append((seed, ctx, ids[at + doc], hs[at + doc], start.astype(np.int32), (count - 1).astype(np.uint8), lead.astype(np.uint8)))
                at += step.num_rows
            cols, first = _settle([np.concatenate(c) for c in zip(*parts)])
            rows = []
            again = _by_document(*(c[~first] for c in (cols[2], cols[3])), cols[4][~first].astype(np.int64),
                                 cols[4][~first].astype(np.int64) + cols[5][~first].astype(np.int64) + 1)
            if len(again):
                t = pa.Table.from_pandas(again, schema=places, preserve_index=False)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_table(t)
                rows.append(("again", 0, len(again), sink.getvalue().to_pybytes()))
            cols = [c[first] for c in cols]
            seed = cols[0]
            if len(seed):
                # how many contexts a seed has here, where they are several
                s = np.flatnonzero(np.r_[True, seed[1:] != seed[:-1]])
                c = np.diff(np.append(s, len(seed)))
                if (c >= 4).any():
                    rows.append(("seeds", 0, int((c >= 4).sum()), squeeze(seed[s[c >= 4]], c[c >= 4])))
                # places in order within a bucket, as they compress better so
                o = np.lexsort((cols[4], cols[3], cols[2], b := _bucket(seed, buckets)))
                cut = np.searchsorted(b[o], np.arange(buckets + 1))
                for k in range(buckets):
                    i = o[cut[k]:cut[k + 1]]
                    if len(i):
                        rows.append(("send", k, len(i), squeeze(*(x[i].astype(t, copy=False) for x, t in zip(cols, _KINDS)))))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)] if rows else
                                             [pa.array([], pa.string()), pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.binary())],
                                             names=["kind", "bucket", "n", "data"]).cast(
                pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("n", pa.int64()), ("data", pa.binary())]))
    return scan


def _unpack_places(batches):
    for b in batches:
        for data in b.column("data").to_pylist():
            yield from pa.ipc.open_stream(data)


def _split_hot(hot: np.ndarray, buckets: int):
    """Messages with the contexts of hot seeds moved to buckets of their own, dealt by context."""
    def split(pdfs):
        for pdf in pdfs:
            rows = []
            for bucket, n, data in zip(pdf["bucket"], pdf["n"], pdf["data"]):
                cols = expand(data, n, *_KINDS)
                is_hot = np.isin(cols[0], hot)
                if not is_hot.any():
                    rows.append((bucket, n, data))
                    continue
                to = np.where(is_hot, buckets + (cols[1] % U64(buckets)).astype(np.int64), bucket)
                for k in np.unique(to):
                    i = np.flatnonzero(to == k)
                    rows.append((int(k), len(i), squeeze(*(c[i] for c in cols))))
            yield pd.DataFrame(rows, columns=["bucket", "n", "data"])
    return split


def _own(buckets: int):
    """Per bucket: repeated contexts' ranges (kind 0) and representatives by document (kind 1,
    of hot seeds kind 2): a is the start, b is strings - 1 plus 256 times anchor - start."""
    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        hot = int(pdf["bucket"].iloc[0]) >= buckets
        parts = [expand(d, n, *_KINDS) for n, d in zip(pdf["n"], pdf["data"])]
        seed = np.concatenate([p[0] for p in parts])
        if not hot:  # seeds that occur once are done with
            o = np.argsort(seed, kind="stable")
            s = seed[o]
            alone = np.r_[True, s[1:] != s[:-1]] & np.r_[s[1:] != s[:-1], True]
            keep = np.sort(o[~alone])
        else:
            keep = np.arange(len(seed))
        cols, first = _settle([np.concatenate([p[i] for p in parts])[keep] for i in range(len(_KINDS))])
        start, count = cols[4].astype(np.int64), cols[5].astype(np.int64) + 1
        again = _by_document(cols[2][~first], cols[3][~first], start[~first], (start + count)[~first])
        again["kind"] = 0
        rep = np.flatnonzero(first)
        if not hot and len(rep):
            s = cols[0][rep]
            new = np.r_[True, s[1:] != s[:-1]]
            rep = rep[np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1]
        code = (cols[5].astype(np.int64) + 256 * cols[6].astype(np.int64))[rep]
        d, h, a = cols[2][rep], cols[3][rep], start[rep]
        o = np.lexsort((a, h, d))
        d, h, a, code = d[o], h[o], a[o], code[o]
        x = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (h[1:] != h[:-1])]) if len(d) else np.zeros(0, np.int64)
        cut = np.append(x, len(d))
        reps = pd.DataFrame({"doc_id": d[x], "h": h[x], "a": [a[i:j].astype(np.int32) for i, j in zip(cut, cut[1:])],
                             "b": [code[i:j].astype(np.int32) for i, j in zip(cut, cut[1:])], "kind": 2 if hot else 1})
        release()
        return pd.concat([x for x in (again, reps) if len(x)] or [again], ignore_index=True)[["kind", "doc_id", "h", "a", "b"]]
    return own


_SHARD = ("<u8", "<i8", "<i8", "<i4", "<i4")  # seed, doc_id, h, start, bytes


def _fetch(shards: int):
    """Bytes of the representatives, by shard (kind 1), and fingerprints of hot seeds' strings
    (kind 2), the earliest of each in the pack; what repeats within it is settled (kind 0)."""
    def fetch(batches):
        for table in packs(batches, 4 * STEP_BYTES):
            buf, off = utf8(table.column("text"))
            ids, hs = _null_id(table.column("doc_id")), table.column("h").to_numpy()
            rows = []
            for kind, name in ((1, "reps"), (2, "hots")):
                lists = table.column(name).combine_chunks() if table.num_rows else None
                size = np.array([0 if x is None else len(x) for x in lists.to_pylist()], np.int64)
                if not size.sum():
                    continue
                flat = lists.flatten()
                a = flat.field("a").to_numpy().astype(np.int64)
                code = flat.field("b").to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(table.num_rows), size)
                count, lead = code % 256 + 1, code // 256
                at = off[:-1][doc] + a
                # a seed is told by its bytes
                place = at + lead
                parts = np.ndarray((len(buf) - 7,), "<u8", buf.tobytes(), 0, (1,))
                h8 = lambda p: parts[p].astype(np.uint64)
                seed = mix(mix(h8(place), h8(place + 8)), mix(h8(place + 16), h8(place + 24)))
                if kind == 1:
                    to = _bucket(seed, shards)
                    o = np.argsort(to, kind="stable")
                    cut = np.searchsorted(to[o], np.arange(shards + 1))
                    for k in np.flatnonzero(np.diff(cut)):
                        i = o[cut[k]:cut[k + 1]]
                        n = count[i] + SPAN - 1
                        rows.append((1, int(k), len(i), squeeze(seed[i], ids[doc[i]], hs[doc[i]], a[i].astype("<i4"), n.astype("<i4")),
                                     buf[spans(at[i], n)].tobytes()))
                else:
                    w_at = spans(at, count)
                    rows += _hot_strings(buf, w_at, np.repeat(seed, count), ids[np.repeat(doc, count)], hs[np.repeat(doc, count)],
                                         (w_at - off[:-1][np.repeat(doc, count)]).astype(np.int32), shards)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                    zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["kind", "shard", "n", "data", "text"])
    return fetch


def _hot_strings(buf, at, seed, ids, hs, start, shards):
    _, h64 = _hashes(buf)
    cols, first = _settle([seed, _string_hash(h64, at), ids, hs, start])
    rows = []
    i = np.flatnonzero(~first)
    if len(i):
        rows.append((0, 0, len(i), squeeze(*(c[i].astype(t, copy=False) for c, t in zip(cols, ("<u8", "<u8", "<i8", "<i8", "<i4")))), b""))
    to = (cols[1] % U64(shards)).astype(np.int64)
    for k in np.unique(to[first]):
        i = np.flatnonzero(first & (to == k))
        rows.append((2, int(k), len(i), squeeze(*(c[i].astype(t, copy=False) for c, t in zip(cols, ("<u8", "<u8", "<i8", "<i8", "<i4")))), b""))
    return rows


def _string_places(d, h, start) -> pd.DataFrame:
    start = start.astype(np.int64)
    return _by_document(d, h, start, start + 1)


def repeated_in_shard(seed, doc, h, start, size, text: np.ndarray) -> pd.DataFrame:
    """Places of repeated strings among contexts (their bytes one after another in ``text``)."""
    off = np.cumsum(size) - size
    count = size - SPAN + 1
    o = np.lexsort((start, h, doc))
    twice = np.r_[False, (doc[o][1:] == doc[o][:-1]) & (h[o][1:] == h[o][:-1]) & (start[o][1:] == start[o][:-1])]
    count[o[twice]] = 0  # the same place, from a row that repeats a document
    padded = np.append(text, np.zeros(64, np.uint8))
    _, h64 = _hashes(padded)
    at = spans(off, count)
    of = np.repeat(np.arange(len(size)), count)
    print64 = mix(_string_hash(h64, at), np.repeat(seed, count))
    del h64
    _, inv, times = np.unique(print64, return_inverse=True, return_counts=True)
    met = times[inv] > 1
    # runs of strings whose fingerprint occurs again
    edge = np.zeros(len(at), bool)
    edge[1:] = of[1:] != of[:-1]
    begin = met & (edge | np.r_[True, ~met[:-1]])
    stop = met & np.append(edge[1:] | ~met[1:], True)
    b, e = np.flatnonzero(begin), np.flatnonzero(stop)
    if not len(b):
        return _string_places(doc[:0], h[:0], start[:0])
    raw = text.tobytes()
    lo, n_str = at[b], e - b + 1
    run_start = start[of[b]].astype(np.int64) + (at[b] - off[of[b]])
    run_doc, run_h = doc[of[b]], h[of[b]]
    # equal runs of one seed are one string with several places; the earliest stands for it
    known: dict[tuple[int, bytes], int] = {}
    which = np.fromiter((known.setdefault((s, raw[x:x + n + SPAN - 1]), len(known))
                         for s, x, n in zip(seed[of[b]].tolist(), lo.tolist(), n_str.tolist())), np.int64, len(b))
    o = np.lexsort((run_start, run_h, run_doc, which))
    first = np.zeros(len(b), bool)
    first[o[np.r_[True, which[o][1:] != which[o][:-1]]]] = True
    out = [(run_doc[~first], run_h[~first], run_start[~first], (run_start + n_str)[~first])]
    # strings of seeds with several different runs: order their suffixes
    f = np.flatnonzero(first)
    s = seed[of[b]][f]
    _, g, many = np.unique(s, return_inverse=True, return_counts=True)
    f = f[many[g] > 1]
    if len(f):
        f = f[np.lexsort((run_start[f], run_h[f], run_doc[f]))]
        m = n_str[f] + SPAN - 1
        body = text[spans(lo[f], m)].astype(np.int64) + 2
        where = np.cumsum(m + 1) - (m + 1)
        symbols = np.ones(int((m + 1).sum()) + 1, np.int64)  # 1 ends a run, 0 ends all
        symbols[spans(where, m)] = body
        symbols[-1] = 0
        sa = suffix_array(symbols)
        run_of = np.searchsorted(where, sa, "right") - 1
        inside = sa - where[run_of]
        full = (inside < n_str[f][run_of]) & (sa < len(symbols) - 1)
        sa, run_of, inside = sa[full], run_of[full], inside[full]
        bytes_at = (lo[f][run_of] + inside).tolist()
        new = np.ones(len(sa), bool)
        for k in range(1, len(sa)):
            x, y = bytes_at[k - 1], bytes_at[k]
            new[k] = raw[x:x + SPAN] != raw[y:y + SPAN]
        cls = np.cumsum(new)
        p = run_start[f][run_of] + inside
        o = np.lexsort((p, run_h[f][run_of], run_doc[f][run_of], cls))
        later = o[np.r_[False, cls[o][1:] == cls[o][:-1]]]
        out.append((run_doc[f][run_of[later]], run_h[f][run_of[later]], p[later], p[later] + 1))
    return _by_document(*(np.concatenate(x) for x in zip(*out)))


def _shard(pdf: pd.DataFrame) -> pd.DataFrame:
    kind = int(pdf["kind"].iloc[0])
    kinds = _SHARD if kind == 1 else ("<u8", "<u8", "<i8", "<i8", "<i4")
    cols = [np.concatenate(c) for c in zip(*(expand(d, n, *kinds) for n, d in zip(pdf["n"], pdf["data"])))]
    if kind == 1:
        text = np.frombuffer(b"".join(pdf["text"]), np.uint8)
        seed, doc, h, start, size = cols
        start, size = start.astype(np.int64), size.astype(np.int64)
        at = np.cumsum(size) - size
        part = (seed >> U64(32)) % U64(SHARD_PARTS)  # strings of different seeds are never compared
        found = []
        for k in range(SHARD_PARTS):
            i = np.flatnonzero(part == U64(k))
            if len(i):
                found.append(repeated_in_shard(seed[i], doc[i], h[i], start[i], size[i], text[spans(at[i], size[i])]))
        release()
        return pd.concat([x for x in found if len(x)] or found[:1], ignore_index=True)
    cols, first = _settle(cols)
    i = np.flatnonzero(~first)
    return _string_places(cols[2][i], cols[3][i], cols[4][i])


def _settled(pdfs):
    for pdf in pdfs:
        for n, d in zip(pdf["n"], pdf["data"]):
            c = expand(d, n, "<u8", "<u8", "<i8", "<i8", "<i4")
            yield _string_places(c[2], c[3], c[4])


def _cover(pdf: pd.DataFrame) -> pd.DataFrame:
    """Removed byte ranges of a bucket's documents, from the starts of their repeated strings."""
    size = pdf["a"].map(len).to_numpy()
    a, b = np.concatenate(pdf["a"].to_list()).astype(np.int64), np.concatenate(pdf["b"].to_list()).astype(np.int64)
    return _by_document(np.repeat(pdf["doc_id"].to_numpy(), size), np.repeat(pdf["h"].to_numpy(), size), a, b + SPAN - 1)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_seed: int = HOT_SEED,
                   owner_bytes: int = OWNER_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, h, and the sorted disjoint byte ranges [a[i], b[i]) that repeat earlier text; only
    documents with any.  A null doc_id comes as the smallest long."""
    src = keyed(docs, id_col=id_col, text_col=text_col).withColumn("h", F.xxhash64("text"))
    spark = docs.sparkSession
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = parts_for(int(total), owner_bytes)
    sent = materialise(src.mapInArrow(tidy(_scan(buckets)), _SENT), "contexts")
    places = sent.filter("kind = 'again'").select("data").mapInArrow(_unpack_places, _PLACES)
    messages = sent.filter("kind = 'send'").select("bucket", "n", "data")
    # a hot seed has a millionth of all contexts at least: there are a million of them at most
    least = max(hot_seed, int(total) // 30 // 1_000_000)

    def seeds(pdfs):
        for pdf in pdfs:
            for n, d in zip(pdf["n"], pdf["data"]):
                s, c = expand(d, n, "<u8", "<i8")
                yield pd.DataFrame({"seed": s.view(np.int64), "c": c})

    hot = (sent.filter("kind = 'seeds'").select("n", "data").mapInPandas(seeds, "seed long, c long")
           .groupBy("seed").agg(F.sum("c").alias("c")).filter(F.col("c") >= least).select("seed").toPandas()["seed"])
    if len(hot):
        messages = messages.mapInPandas(_split_hot(hot.to_numpy().astype(np.int64).view(np.uint64), buckets), "bucket int, n long, data binary")
    owned = materialise(messages.groupBy("bucket").applyInPandas(_own(buckets), "kind int, " + _PLACES), "owned")
    places = places.unionByName(owned.filter("kind = 0").drop("kind"))

    wanted = materialise(owned.filter("kind > 0").groupBy("doc_id", "h").agg(
        F.flatten(F.collect_list(F.when(F.col("kind") == 1, F.arrays_zip("a", "b")))).alias("reps"),
        F.flatten(F.collect_list(F.when(F.col("kind") == 2, F.arrays_zip("a", "b")))).alias("hots")), "wanted")
    amount = wanted.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("reps") + F.size("hots")).alias("c")).first()
    shards = parts_for((amount["c"] or 0) * 140, shard_bytes)
    small = (amount["n"] or 0) * 100 + (amount["c"] or 0) * 20 <= 3 * BROADCAST_BYTES  # as measured
    key = src.withColumn("_id", F.coalesce("doc_id", F.lit(-(1 << 63)))).drop("doc_id").withColumnRenamed("_id", "doc_id")
    # rows that repeat a document would send its contexts twice, which _settle takes for one place
    fetched = materialise(key.join(F.broadcast(wanted) if small else wanted, ["doc_id", "h"])
                          .mapInArrow(tidy(_fetch(shards)), "kind int, shard int, n long, data binary, text binary"), "fetched")
    in_shards = fetched.filter("kind > 0").groupBy("shard", "kind").applyInPandas(_shard, _PLACES)
    settled = fetched.filter("kind = 0").select("n", "data").mapInPandas(_settled, _PLACES)
    every = places.unionByName(in_shards).unionByName(settled)
    # documents are merged many at a time, in buckets that grow in number with the text
    bucket = F.pmod(F.xxhash64("doc_id", "h"), F.lit(parts_for(int(total), owner_bytes)))
    return every.withColumn("_bucket", bucket).groupBy("_bucket").applyInPandas(lambda pdf: _cover(pdf), _PLACES)


def _cut(batches):
    for table in packs(batches, STEP_BYTES * 4):
        buf, off = utf8(table.column("text"))
        removed, runs, digest = [], [], []
        for k, (a, b) in enumerate(zip(table.column("a").to_pylist(), table.column("b").to_pylist())):
            body = buf[off[k]:off[k + 1]].tobytes()
            at, kept = 0, hashlib.sha256()
            for x, y in zip(a or (), b or ()):
                kept.update(body[at:x])
                at = y
            kept.update(body[at:])
            removed.append(sum(b or ()) - sum(a or ()))
            runs.append(len(a or ()))
            digest.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [table.column("doc_id").combine_chunks(), pa.array(np.diff(off)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest)],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def with_spans(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, text, a, b: every document with its removed byte ranges (null: none)."""
    src = keyed(docs).withColumn("h", F.xxhash64("text"))
    found = materialise(repeated_spans(docs, **settings), "spans").withColumnsRenamed({"doc_id": "_id", "h": "_h"})
    size = found.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("a")).alias("c")).first()
    small = size["n"] * 40 + (size["c"] or 0) * 8 <= BROADCAST_BYTES
    on = (F.coalesce(src["doc_id"], F.lit(-(1 << 63))) == F.col("_id")) & (src["h"] == F.col("_h"))
    return src.join(F.broadcast(found) if small else found, on, "left").select("doc_id", "text", "a", "b")


def span_digest(docs: DataFrame) -> DataFrame:
    return with_spans(docs).mapInArrow(tidy(_cut), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
