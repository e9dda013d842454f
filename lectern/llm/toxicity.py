"""Toxic spans by a linear-chain conditional random field.

Labels are of documents, so the labelled tokens are derived: a word (or its first four or five
letters) that toxic training documents hold far more often than clean ones is marked, and tagged toxic
in the toxic documents; every other word, and every word of a clean document, is tagged clean.  Words
are counted over all training documents.  A word in t of the toxic and c of the clean ones has the
evidence t log(t / (n p)) + c log(c / (n (1 - p))), with n = t + c and p the share of toxic documents:
the chance of as many toxic ones is exp(-evidence) at most.  Words are marked from the evidence on at
which a share ``FALSE`` of the marked ones is expected by chance (Benjamini-Hochberg), if their rate is
``RATIO`` times that in clean documents.  A two-tag CRF over sentences, with hashed word, stem and
neighbour features and whether the word is marked, is trained on them in numpy.  Tasks score whole texts: forward-backward marginals of all words,
from which come the offending spans and, by a logistic regression on document features, the
document's score.

Training sees only rows of ``labels`` whose crc32(doc_id as text) mod 5 is not 0.  The CRF and the
document layer are fitted on at most ``SAMPLE_DOCS`` of each label (those of the least hash) and
``SAMPLE_SENTENCES`` sentences with and without marked words; at most ``LEXICON`` words are marked, those
of the most evidence.  Scores depend on the text alone.

Null and empty texts are scored like a text without words.  Repeated rows get equal scores;
repeated labels of a document count once (the greatest).  Without training rows of both labels
every score is the share of toxic rows seen (0 without any).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import (BROADCAST_BYTES, U64, byte_table, discard, finish, keyed, materialise, packs, share, shared, tidy, utf8,
                                without, words)

FOLDS = 5
SAMPLE_DOCS = 2500
SAMPLE_SENTENCES = 4000
#: sentences longer than this are scored in parts of this many words
CHAIN = 128
BITS = 18
PACK = 1 << 20
_WORD = byte_table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
_SPLIT = r"[^\p{L}\p{N}]+"
#: expected share of marked words that are so by chance, and rate ratio that a marked word needs
FALSE, RATIO = 0.05, 20.0
#: toxic documents that a marked word is in at least, and words marked at most
LEAST, LEXICON = 3, 200_000


@dataclass
class Crf:
    weight: np.ndarray  # of features, for the toxic tag against the clean one
    trans: np.ndarray  # [from, to]
    doc: np.ndarray  # of document features
    marked: np.ndarray  # hashes of the marked words, sorted
    prior: float = 0.0
    trained: bool = True


# ---------------------------------------------------------------- features and chains

def _features(buf: np.ndarray, off: np.ndarray, marked: np.ndarray):
    """(word starts, ends, first word of each text, feature indices (n, 7), chain starts, lengths)."""
    s, e, h, first = words(buf, _WORD, off)
    n = len(s)
    norm = np.append(_WORD[buf], np.zeros(8, np.uint8))
    head = np.ndarray((len(buf) + 1,), "<u8", norm.tobytes(), 0, (1,))[s].astype(np.uint64)
    size = (e - s).astype(np.uint64)
    cols = [h]
    for k in (4, 5, 6):
        m = np.minimum(size, U64(k)) * U64(8)
        cols.append((head & (U64(2**64 - 1) >> (U64(64) - m))) + U64(k))
    # a chain is a sentence: a new one after . ! ? or a line end between two words, or a new text
    marks = np.zeros(len(buf) + 1, np.int32)
    np.cumsum((buf == 46) | (buf == 33) | (buf == 63) | (buf == 10), out=marks[1:])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
        new[1:] = marks[s[1:]] != marks[e[:-1]]
        new[first[:-1][np.diff(first) > 0]] = True
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, n))
    if len(length) and length.max() > CHAIN:
        extra = (length - 1) // CHAIN
        at = np.repeat(at, extra + 1) + (np.arange(len(at) + extra.sum()) - np.repeat(np.cumsum(extra + 1) - (extra + 1), extra + 1)) * CHAIN
        length = np.diff(np.append(at, n))
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    edge[n] = True
    cols.append(np.where(edge[:-1], U64(1), np.append(U64(0), h[:-1])))
    cols.append(np.where(edge[1:], U64(2), np.append(h[1:], U64(0))))
    at_mark = np.minimum(np.searchsorted(marked, h), max(0, len(marked) - 1))
    cols.append(np.where(marked[at_mark] == h, U64(3), U64(4)) if len(marked) else np.full(n, U64(4)))
    idx = np.stack([(finish(c + U64(1000003 * (j + 1))) >> U64(64 - BITS)).astype(np.int32) for j, c in enumerate(cols)], 1)
    return s, e, first, idx, at, length


def _passes(score: np.ndarray, trans: np.ndarray, at: np.ndarray, length: np.ndarray):
    """Log odds of the toxic tag from the left (with the word's own score) and from the right,
    all chains in step; and the words of each step."""
    n = len(score)
    a, b = np.zeros(n), np.zeros(n)
    if not n:
        return a, b, []
    o = np.argsort(-length, kind="stable")
    at, length = at[o], length[o]
    live = np.searchsorted(-length, -np.arange(1, length[0] + 1), "right")  # chains with a word at step t
    steps = [at[:k] + t for t, k in enumerate(live.tolist())]
    a[at] = score[at]
    for i in steps[1:]:
        p = a[i - 1]
        a[i] = score[i] + np.logaddexp(trans[0, 1], trans[1, 1] + p) - np.logaddexp(trans[0, 0], trans[1, 0] + p)
    for j in reversed(steps[1:]):
        q = score[j] + b[j]
        b[j - 1] = np.logaddexp(trans[1, 0], trans[1, 1] + q) - np.logaddexp(trans[0, 0], trans[0, 1] + q)
    return a, b, steps


def marginals(score: np.ndarray, trans: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Probability of the toxic tag for each word."""
    a, b, _ = _passes(score, trans, at, length)
    return 1.0 / (1.0 + np.exp(-np.clip(a + b, -40, 40)))


def train_crf(sentences: list[bytes], tags: list[np.ndarray], marked: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.4,
              decay: float = 1e-5, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions that maximise the tags' likelihood, by AdaGrad."""
    rng = np.random.default_rng(seed)
    weight, trans = np.zeros(1 << BITS), np.zeros((2, 2))
    gw, gt = np.full(1 << BITS, 1e-6), np.full((2, 2), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(sentences))
        for k in range(0, len(order), batch):
            pick = order[k:k + batch]
            body = [sentences[i] for i in pick]
            off = np.concatenate([[0], np.cumsum([len(x) for x in body])])
            _, _, _, idx, at, length = _features(np.frombuffer(b"".join(body), np.uint8), off, marked)
            y = np.concatenate([tags[i] for i in pick])
            score = weight[idx].sum(1)
            p = marginals(score, trans, at, length)
            grad = np.bincount(idx.ravel(), np.repeat(p - y, idx.shape[1]), 1 << BITS)
            hit = np.flatnonzero(grad)
            g = grad[hit] / len(pick) + decay * weight[hit]
            gw[hit] += g * g
            weight[hit] -= rate * g / np.sqrt(gw[hit])
            # transitions: expected less observed counts of neighbouring tags
            g = (_pairs(score, trans, at, length) - _observed(y, at)) / len(pick)
            gt += g * g
            trans -= rate * g / np.sqrt(gt)
    return weight, trans


def _observed(y: np.ndarray, at: np.ndarray) -> np.ndarray:
    inner = np.ones(len(y), bool)
    inner[at] = False
    i = np.flatnonzero(inner)
    return np.bincount(2 * y[i - 1].astype(int) + y[i].astype(int), minlength=4).reshape(2, 2).astype(float)


def _pairs(score: np.ndarray, trans: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Expected counts of neighbouring tags."""
    a, b, steps = _passes(score, trans, at, length)
    total = np.zeros((2, 2))
    for i in steps[1:]:
        x, y = a[i - 1], score[i] + b[i]
        z = np.stack([np.full(len(i), trans[0, 0]), trans[0, 1] + y, x + trans[1, 0], x + trans[1, 1] + y])
        z = np.exp(z - z.max(0))
        total += (z / z.sum(0)).sum(1).reshape(2, 2)
    return total


def _doc_features(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: 1, log of tagged words, greatest marginal, and logs of expected tagged words, of
    the tagged words' summed odds, and of all words."""
    def total(x):
        c = np.concatenate([[0.0], np.cumsum(x)])
        return np.maximum(c[first[1:]] - c[first[:-1]], 0)

    n = len(first) - 1
    tagged = p >= 0.5
    most = np.zeros(n)
    some = np.flatnonzero(np.diff(first) > 0)
    if len(some):
        most[some] = np.maximum.reduceat(p, first[some])
    odds = np.where(tagged, np.log(p / np.maximum(1 - p, 1e-6) + 1e-12), 0.0)
    return np.stack([np.ones(n), np.log1p(total(tagged)), most, np.log1p(total(p)), np.log1p(total(odds)),
                     np.log1p(np.diff(first))], 1)


# ---------------------------------------------------------------- training

def held_out(id_column, folds: int):
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def _training(docs: DataFrame, labels: DataFrame, folds: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text, toxic) of all training rows, and their doc_id and label, written."""
    src = keyed(docs)
    lab = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
           .filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
           .filter(held_out(F.col("doc_id"), folds) != 0))
    lab = materialise(lab.join(src.select("doc_id").distinct(), "doc_id", "left_semi"), "tox-labels")
    small = lab.count() * 16 <= BROADCAST_BYTES
    return src.join(F.broadcast(lab) if small else lab, "doc_id"), lab


def _keys(rows: DataFrame) -> DataFrame:
    """(k, key, toxic): words (k = 0) and stems of k letters, each once a document."""
    def named(x, k):
        return F.transform(x, lambda y: F.struct(F.lit(k).alias("k"), y.alias("key")))

    def stems(k):
        return F.array_distinct(F.transform(F.filter("w", lambda y: F.length(y) >= k), lambda y: F.substring(y, 1, k)))

    w = rows.select("toxic", F.array_distinct(F.split(F.lower("text"), _SPLIT)).alias("w"))
    each = [named(F.filter("w", lambda y: F.length(y) >= 3), 0), named(stems(4), 4), named(stems(5), 5)]
    return w.select("toxic", F.explode(F.concat(*each)).alias("x")).select("toxic", "x.k", "x.key")


def _lexicon(rows: DataFrame, n: dict[int, int]) -> dict[int, set]:
    """Words (0) and stems of 4 and 5 letters that mark toxic documents.

    Only words of ``LEAST`` toxic documents can be marked, so only these are looked for in clean ones."""
    seen = materialise(_keys(rows.filter("toxic = 1")).groupBy("k", "key").agg(F.count(F.lit(1)).alias("t")), "tox-words")
    tested = seen.count()
    able = materialise(seen.filter(F.col("t") >= LEAST), "tox-able")
    size = able.agg(F.sum(F.octet_length("key") + 48)).first()[0] or 0
    side = able.select("k", "key")
    clean = _keys(rows.filter("toxic = 0")).join(F.broadcast(side) if size <= BROADCAST_BYTES else side, ["k", "key"], "left_semi")
    p = n[1] / (n[0] + n[1])
    counts = able.join(clean.groupBy("k", "key").agg(F.count(F.lit(1)).alias("c")), ["k", "key"], "left").fillna(0, ["c"])
    total = F.col("t") + F.col("c")
    term = lambda x, share: F.when(x > 0, x * F.log(x / (total * share))).otherwise(0.0)
    counts = counts.filter(F.col("t") / n[1] > RATIO * F.col("c") / n[0]).withColumn("e", term(F.col("t"), p) + term(F.col("c"), 1 - p))
    counts = materialise(counts, "tox-evidence")
    # words by evidence in eighths of a nat: the least at which a share FALSE is expected by chance
    steps = counts.groupBy(F.floor(F.col("e") * 8).alias("s")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("s")).collect()
    least, marked = None, 0
    for r in steps:
        marked += r["n"]
        if tested * np.exp(-r["s"] / 8) <= FALSE * marked:
            least = r["s"] / 8
    out: dict[int, set] = {0: set(), 4: set(), 5: set()}
    if least is not None:
        for row in counts.filter(F.col("e") >= least).orderBy(F.desc("e"), "key").limit(LEXICON).collect():
            out[row["k"]].add(row["key"])
    discard(seen, able, counts)
    return out


def _hashed(lexicon: dict[int, set]) -> np.ndarray:
    """Hashes of the marked words, as the features have them."""
    body = " ".join(sorted(lexicon[0])).encode()
    h = words(np.frombuffer(body, np.uint8), _WORD, np.array([0, len(body)]))[2]
    return np.unique(h)


def _tag(sentence: str, lexicon: dict[int, set]) -> np.ndarray:
    body = sentence.encode()
    s, e, _, _ = words(np.frombuffer(body, np.uint8), _WORD, np.array([0, len(body)]))
    out = []
    for a, b in zip(s.tolist(), e.tolist()):
        w = body[a:b].decode("utf-8", "ignore").lower()
        out.append(w in lexicon[0] or w[:4] in lexicon[4] or w[:5] in lexicon[5])
    return np.array(out, np.int64)


def _logistic(x: np.ndarray, y: np.ndarray, share: float, steps: int = 50, decay: float = 1e-2) -> np.ndarray:
    """Newton steps of a ridge logistic regression; ``share``: of label 1 among all training rows."""
    w = np.zeros(x.shape[1])
    weigh = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum())) * len(y)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weigh * (p - y)) + decay * w
        hess = (x * (weigh * p * (1 - p))[:, None]).T @ x + decay * np.eye(len(w))
        step = np.linalg.solve(hess, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, sample_docs: int = SAMPLE_DOCS,
        sample_sentences: int = SAMPLE_SENTENCES) -> Crf:
    rows, lab = _training(docs, labels, folds)
    n = {0: 0, 1: 0} | {r["toxic"]: r["n"] for r in lab.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = n[1] / max(1, n[0] + n[1])
    if not n[0] or not n[1]:
        return Crf(np.zeros(1), np.zeros((2, 2)), np.zeros(6), np.zeros(0, np.uint64), share, False)
    lexicon = _lexicon(rows, n)
    marked = _hashed(lexicon)
    pick = [lab.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs) for t in (0, 1)]
    ids = materialise(pick[0].unionByName(pick[1]).select("doc_id"), "tox-sample")
    sample = materialise(rows.join(F.broadcast(ids), "doc_id", "left_semi"), "tox-texts")  # at most 2 * sample_docs ids

    def sentences(batches):
        for pdf in batches:
            out = []
            for text, toxic in zip(pdf["text"], pdf["toxic"]):
                for line in text.replace("!", ".").replace("?", ".").replace("\n", ".").split("."):
                    parts = line.split()
                    for i in range(0, len(parts), CHAIN):
                        one = " ".join(parts[i:i + CHAIN])
                        # a text without blanks is many sentences, whole words where there are any
                        while one:
                            cut = len(one) if len(one) <= 8 * CHAIN else one.rfind(" ", 0, 8 * CHAIN) + 1 or 8 * CHAIN
                            out.append((one[:cut], toxic, int(_tag(one[:cut], lexicon).any())))
                            one = one[cut:]
            if out:
                yield pd.DataFrame(out, columns=["sentence", "toxic", "marked"])

    every = materialise(sample.select("text", "toxic").mapInPandas(sentences, "sentence string, toxic int, marked int"), "tox-sentences")
    taken = [r for m in (0, 1) for r in every.filter(F.col("marked") == m).orderBy(F.xxhash64("sentence"), "sentence")
             .limit(sample_sentences).collect()]
    bodies = [r["sentence"].encode() for r in taken]
    # marked words of clean documents are clean: they show how far a word can be trusted
    tags = [_tag(r["sentence"], lexicon) * r["toxic"] for r in taken]
    keep = [i for i, t in enumerate(tags) if len(t)]
    weight, trans = train_crf([bodies[i] for i in keep], [tags[i] for i in keep], marked)
    model = Crf(weight.astype(np.float32), trans, np.zeros(6), marked)
    # the document layer, on marginals of the sampled documents
    layer = _score(sample, model, extra=True).select("f", "toxic").toPandas()
    model.doc = _logistic(np.array(layer["f"].to_list(), float), layer["toxic"].to_numpy(), share)
    return model


# ---------------------------------------------------------------- scoring

def _apply(block, extra: bool):
    def apply(batches):
        m = shared(block)
        for table in packs(batches, PACK):
            buf, off = utf8(table.column("text"))
            n = table.num_rows
            if m.trained:
                s, e, first, idx, at, length = _features(buf, off, m.marked)
                p = marginals(m.weight[idx].sum(1, dtype=np.float64), m.trans, at, length)
                f = _doc_features(p, first)
                score = 1 / (1 + np.exp(-np.clip(f @ m.doc, -30, 30)))
            else:
                s = e = np.zeros(0, np.int64)
                first, p, f, score = np.zeros(n + 1, np.int64), np.zeros(0), np.zeros((n, len(m.doc))), np.full(n, m.prior)
            # spans: runs of tagged words, as character offsets
            hit = np.flatnonzero(p >= 0.5)
            doc = np.searchsorted(first, hit, "right") - 1
            lead = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
            spans: list[list] = [[] for _ in range(n)]
            last = (-1, -2)
            for w, d in zip(hit.tolist(), doc.tolist()):
                a, b = (int(lead[x] - lead[off[d]]) for x in (s[w], e[w]))
                if last == (d, w - 1):
                    spans[d][-1]["end"] = b
                    spans[d][-1]["p"] = max(spans[d][-1]["p"], float(p[w]))
                else:
                    spans[d].append({"start": a, "end": b, "p": float(p[w])})
                last = (d, w)
            cols = {"doc_id": table.column("doc_id"), "score": pa.array(score),
                    "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))}
            if extra:
                cols |= {"f": pa.array(f.tolist(), pa.list_(pa.float64())), "toxic": table.column("toxic")}
            else:
                cols["h"] = table.column("h")
            yield from pa.table(cols).to_batches()
    return apply


def _score(rows: DataFrame, model: Crf, extra: bool = False) -> DataFrame:
    block = share(rows.sparkSession, model)  # the weights: 1 MB
    kind = "doc_id long, score double, spans array<struct<start:int,end:int,p:double>>, "
    return rows.mapInArrow(tidy(_apply(block, extra)), kind + ("f array<double>, toxic int" if extra else "h long"))


def tag_toxicity(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Per row of ``docs``: doc_id, score, spans (character offsets, marginal), h."""
    model = fit(docs, labels, **settings)
    return _score(keyed(docs).withColumn("h", F.xxhash64("text")), model)


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return tag_toxicity(docs, labels).select(
        "doc_id", (held_out(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").alias("n_spans"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``."""
    bad = materialise(tag_toxicity(docs, labels).filter(F.col("score") >= threshold).select("doc_id", "h").distinct(), "toxic")
    return without(docs, bad)
