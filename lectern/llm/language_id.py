"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its hashed byte 3- and 4-grams (lower-cased, non-word
ASCII bytes as one blank).  Embeddings and softmax are trained by stochastic gradient descent in
numpy; a temperature, fitted on the part of the sample that training does not see, calibrates
the probabilities, and a score below the rejection bound (the share ``REJECT`` of that part's
right answers lies under it) marks a prediction as ``rejected``.

Training sees only text and lang of rows with a lang whose crc32(doc_id as text) mod 3 is not 1,
at most ``SAMPLE_PER_LANGUAGE`` texts of each language (least hash first; of a text over
``SAMPLE_BYTES`` bytes a slice with a letter, chosen by hash, for fitting only); with over
``LANGUAGES`` languages, as many fewer of each.  Texts that are null or have no letter are ``und`` with score 0; so is
every text if nothing could be learnt.  Ties go to the language first in order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import packs, share, shared, small_batches, utf8
from lectern.llm.toxicity import held_out

FOLDS, HELD = 3, 1
SAMPLE_SALTS = 64
SAMPLE_PER_LANGUAGE = 600
SAMPLE_BYTES = 4000
LANGUAGES = 500
BITS, DIM = 15, 16
PACK = 1 << 20
REJECT = 0.01
_NORM = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


@dataclass
class Model:
    table: np.ndarray  # logits of each bucket: embeddings times softmax weights
    bias: np.ndarray
    languages: list[str]
    temperature: float
    reject: float


def subwords(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every subword, n + 1 offsets of the texts)."""
    x = np.concatenate([_NORM[buf], np.zeros(4, np.uint8)]).astype(np.uint32)
    n = len(buf)
    three = x[:n] | x[1:n + 1] << 8 | x[2:n + 2] << 16
    four = three | x[3:n + 3] << 24
    size = np.diff(off)
    ids = np.empty(2 * n, np.int32)
    ids[0::2] = (three * np.uint32(0x9E3779B1) + np.uint32(0x7F4A7C15)) * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS)
    ids[1::2] = (four * np.uint32(0xC2B2AE35) ^ four >> np.uint32(15)) * np.uint32(0x27D4EB2F) >> np.uint32(32 - BITS)
    # a subword lies within its text
    left = np.repeat(off[1:], size) - np.arange(n)
    keep = np.empty(2 * n, bool)
    keep[0::2] = left >= 3
    keep[1::2] = left >= 4
    count = np.concatenate([[0], np.cumsum(keep)])
    return ids[keep], count[2 * off]


def train(texts: list[bytes], y: np.ndarray, classes: int, epochs: int = 5, rate: float = 0.5, seed: int = 11):
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM))
    w, b = np.zeros((DIM, classes)), np.zeros(classes)
    parts = []
    for t in texts:
        ids, _ = subwords(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        parts.append(np.unique(ids, return_counts=True))
    steps, done = epochs * len(texts), 0
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            ids, n = parts[i]
            lr = rate * (1 - done / steps)
            done += 1
            if not len(ids):
                continue
            share = n / n.sum()
            v = share @ emb[ids]
            z = v @ w + b
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = w @ p
            w -= lr * np.outer(v, p)
            b -= lr * 0.1 * p
            emb[ids] -= lr * 20 * share[:, None] * back
    return emb, w, b


def logits(table: np.ndarray, bias: np.ndarray, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean of the subwords' rows per text, plus the bias."""
    n = len(first) - 1
    out = np.zeros((n, table.shape[1]))
    some = np.flatnonzero(np.diff(first) > 0)
    if len(some):
        rows = table[ids]
        for k in range(table.shape[1]):  # float64 sums, column by column
            out[some, k] = np.add.reduceat(rows[:, k], first[some], dtype=np.float64)
    return out / np.maximum(np.diff(first), 1)[:, None] + bias


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], docs["lang"].alias("lang"))
    src = src.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (held_out(F.col("doc_id"), FOLDS) != HELD))
    # a long text is learnt from a slice of so many characters, which has the bytes at most
    size = SAMPLE_BYTES // 4
    at = (F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - size + 1, F.lit(1))) + 1).cast("int")
    piece = F.substring("text", at, F.lit(size))
    piece = F.when(piece.rlike(r"\p{L}"), piece).otherwise(F.substring("text", F.regexp_instr("text", F.lit(r"\p{L}")), F.lit(size)))
    src = src.select("doc_id", "lang", F.xxhash64("text").alias("h"),
                     F.when(F.octet_length("text") <= SAMPLE_BYTES, F.col("text")).otherwise(piece).alias("text"))
    # the first of each language by hash: groups are cut to size while they are sorted
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("h")]
    # each scan task cuts to size what it sends; parts of the tasks are cut again, then the languages:
    # the last step reads SAMPLE_SALTS * per_language rows of a language at most, whatever the input
    part = F.pmod(F.spark_partition_id(), F.lit(SAMPLE_SALTS))
    some = src.withColumn("part", part).withColumn("r", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    some = some.filter(F.col("r") <= per_language)
    picked = some.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("r") <= per_language)
    # first one text of each language, then a second, so that no language is left out
    rows = (picked.select("text", "lang", "r").orderBy("r", "lang").limit(per_language * LANGUAGES).toPandas()
            .sort_values(["lang", "r"], ignore_index=True))
    if not len(rows):
        return None
    languages = sorted(rows["lang"].unique())
    y = np.searchsorted(languages, rows["lang"])
    texts = [t.encode() for t in rows["text"]]
    aside = rows["r"].to_numpy() % 5 == 0
    if aside.all() or not aside.any():
        aside = np.zeros(len(rows), bool)
    seen = np.flatnonzero(~aside)
    emb, w, b = train([texts[i] for i in seen], y[seen], len(languages))
    table = (emb @ w).astype(np.float32)
    temperature, reject = 1.0, 0.0
    check = np.flatnonzero(aside)
    if len(check):
        body = [texts[i] for i in check]
        ids, first = subwords(np.frombuffer(b"".join(body), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in body])]))
        z = logits(table, b, ids, first)
        loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(check)), y[check]] + 1e-12).mean()
        temperature = min(np.geomspace(0.05, 5, 60), key=loss)
        p = _softmax(z / temperature)
        right = p.argmax(1) == y[check]
        if right.any():
            reject = float(np.quantile(p.max(1)[right], REJECT))
    return Model(table, b, list(languages), float(temperature), reject)


def _apply(block):
    def apply(batches):
        m = shared(block)
        for table in packs(batches, PACK):
            buf, off = utf8(table.column("text"))
            letters = table.column("letters").to_numpy()
            if m is None:
                lang, score, low = ["und"] * table.num_rows, np.zeros(table.num_rows), np.ones(table.num_rows, bool)
            else:
                p = _softmax(logits(m.table, m.bias, *subwords(buf, off)) / m.temperature)
                best = p.argmax(1)
                score = np.where(letters, p.max(1), 0.0)
                lang = [m.languages[k] if ok else "und" for k, ok in zip(best, letters)]
                low = score < m.reject
            yield from pa.table({"doc_id": table.column("doc_id"), "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score),
                                 "rejected": pa.array(low | ~letters.astype(bool))}).to_batches()
    return apply


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score, rejected."""
    small_batches(docs.sparkSession)
    model = model or fit(docs)
    block = share(docs.sparkSession, model)  # 2^15 rows of one float per language
    text = F.coalesce(docs["text"], F.lit(""))
    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), text.rlike(r"\p{L}").alias("letters"))
    return src.mapInArrow(_apply(block), "doc_id long, lang_pred string, score double, rejected boolean").select(
        "doc_id", (held_out(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "lang_pred", "score", "rejected")
