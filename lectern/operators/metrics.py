"""ROUGE-1/2, ROUGE-L, ROUGE-Lsum, BLEU and per-model leaderboards.

ROUGE-N and BLEU clipped counts come from an Arrow UDF over the token arrays, which counts the n-grams of
all orders in one pass and those of a reference once for the models that follow one another: scoring is
a narrow map over the pair table and the only shuffle is the final (partial + final) aggregation.
``score_pairs`` projects token arrays as columns first.  LCS has no native
linear form, so ROUGE-L / Lsum use an Arrow UDF: bit-parallel, a row of the DP being one long integer
whose zero bits are the row's steps.  A length needs one row; the recovery of a common subsequence
keeps every s-th row and makes the others anew, so its memory grows with n * sqrt(m) bits.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.ngrams import bleu_tokens, fmeasure, rouge_tokens
from lectern.functions.text import _col

SCORE = T.StructType([T.StructField("precision", T.DoubleType()), T.StructField("recall", T.DoubleType()),
                      T.StructField("fmeasure", T.DoubleType())])


# ------------------------------------------------------------------ LCS (Arrow UDF)

def _places(tokens) -> dict:
    """Token -> integer with the bits of its places."""
    at: dict = {}
    for j, tok in enumerate(tokens):
        at.setdefault(tok, []).append(j)
    out = {}
    for tok, places in at.items():
        bits = bytearray((places[-1] >> 3) + 1)
        for j in places:
            bits[j >> 3] |= 1 << (j & 7)
        out[tok] = int.from_bytes(bits, "little")
    return out


def _next_row(row: int, match: int, full: int) -> int:
    """The row below: bit j is 0 where the table grows from column j to j + 1."""
    common = row & match
    return ((row + common) | (row - common)) & full


def lcs_length(a, b) -> int:
    if len(a) == 0 or len(b) == 0:
        return 0
    if len(a) > len(b):
        a, b = b, a
    both = set(a)
    match = _places([t if t in both else None for t in b])
    full = (1 << len(b)) - 1
    row = full
    for tok in a:
        m = match.get(tok)
        if m:
            row = _next_row(row, m, full)
    return len(b) - row.bit_count()


def _lcs_indices(ref, can) -> list[int]:
    """Indices of ``ref`` on one LCS, walking back with the metric library's tie rule: on equal tokens
    both ends step back, else the candidate's if the table is greater there, else the reference's."""
    m, n = len(ref), len(can)
    if not m or not n:
        return []
    both = set(ref)
    match = _places([t if t in both else None for t in can])
    full = (1 << n) - 1
    step = int(m ** 0.5) + 1
    kept, row = [full], full  # rows 0, step, 2 * step, ...
    for i, tok in enumerate(ref, start=1):
        row = _next_row(row, match.get(tok, 0), full)
        if i % step == 0:
            kept.append(row)
    block, first = [], m + 1  # rows first, first + 1, ... of the block that the walk is in

    def row_of(i: int) -> int:
        nonlocal block, first
        if i < first:
            first = i - i % step
            block = [kept[first // step]]
            for k in range(first + 1, min(first + step, m + 1)):
                block.append(_next_row(block[-1], match.get(ref[k - 1], 0), full))
        return block[i - first]

    i, j, out = m, n, []
    here = row_of(m)
    value = n - here.bit_count()
    while i > 0 and j > 0:
        if ref[i - 1] == can[j - 1]:
            out.append(i - 1)
            i, j, value = i - 1, j - 1, value - 1
            here = row_of(i)
            continue
        above = row_of(i - 1)
        up = j - (above & ((1 << j) - 1)).bit_count()
        # to the left as long as that is greater than above
        while j > 0 and ref[i - 1] != can[j - 1]:
            left = value - (~here >> (j - 1) & 1)
            if left <= up:
                break
            j, value = j - 1, left
            up -= ~above >> j & 1
        if j > 0 and ref[i - 1] != can[j - 1]:
            i, value, here = i - 1, up, above
    return out[::-1]


def summary_lcs_hits(ref_sents, can_sents) -> tuple[int, int, int]:
    """Union-LCS hits over sentence lists -> (hits, ref_tokens, cand_tokens)."""
    m = sum(len(s) for s in ref_sents)
    n = sum(len(s) for s in can_sents)
    if not ref_sents or not can_sents or m == 0 or n == 0:
        return 0, m, n
    cr, cc = Counter(), Counter()
    for s in ref_sents:
        cr.update(s)
    for s in can_sents:
        cc.update(s)
    hits = 0
    for r in ref_sents:
        union = sorted(set().union(*[_lcs_indices(r, c) for c in can_sents]))
        for t in (r[i] for i in union):
            if cc[t] > 0 and cr[t] > 0:
                hits += 1
                cc[t] -= 1
                cr[t] -= 1
    return hits, m, n


def _prf(hits, n_pred, n_ref):
    p = hits / n_pred if n_pred else 0.0
    r = hits / n_ref if n_ref else 0.0
    f = 2 * p * r / (p + r) if p + r > 0 else 0.0
    return p, r, f


@F.pandas_udf(SCORE)
def _rouge_l_udf(pred: pd.Series, ref: pd.Series) -> pd.DataFrame:
    rows = []
    for a, b in zip(pred, ref):
        a = [] if a is None else list(a)
        b = [] if b is None else list(b)
        if not a or not b:
            rows.append((0.0, 0.0, 0.0))
            continue
        rows.append(_prf(lcs_length(a, b), len(a), len(b)))
    return pd.DataFrame(rows, columns=["precision", "recall", "fmeasure"])


@F.pandas_udf(SCORE)
def _rouge_lsum_udf(pred: pd.Series, ref: pd.Series) -> pd.DataFrame:
    rows = []
    for a, b in zip(pred, ref):
        can = [list(s) for s in (a if a is not None else [])]
        rs = [list(s) for s in (b if b is not None else [])]
        hits, m, n = summary_lcs_hits(rs, can)
        rows.append(_prf(hits, n, m) if m and n else (0.0, 0.0, 0.0))
    return pd.DataFrame(rows, columns=["precision", "recall", "fmeasure"])


# ------------------------------------------------------------------ n-gram counts (Arrow UDF)

def _gram_counts(tokens, orders: int) -> list[dict]:
    """Counts of the n-grams, n = 1 to ``orders``."""
    return [Counter(tokens if n == 1 else zip(*[tokens[i:] for i in range(n)])) for n in range(1, orders + 1)]


def clipped_counts(pairs, orders: int):
    """Of each (prediction, reference) pair of token lists: for n = 1 to ``orders``, how many n-grams they share,
    each as often as in the side that has it less often.  A reference that comes again is counted once."""
    last, held = None, []
    for a, b in pairs:
        if last is None or b != last:
            last, held = b, _gram_counts(b, orders)
        yield [sum(min(n, of[g]) for g, n in c.items() if g in of) for c, of in zip(_gram_counts(a, orders), held)]


def shared_grams(pred, ref, orders: int) -> Column:
    """Struct m1, m2, ... of ``clipped_counts``; without one of the two sides m1 is null and the others are 0."""
    @F.pandas_udf(T.StructType([T.StructField(f"m{n}", T.LongType()) for n in range(1, orders + 1)]))
    def counts(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        sides = ([[] if x is None else x.tolist() for x in s] for s in (a, b))
        out = pd.DataFrame(clipped_counts(zip(*sides), orders), columns=[f"m{n}" for n in range(1, orders + 1)], dtype="Int64")
        out.loc[(a.isna() | b.isna()).to_numpy(), "m1"] = pd.NA
        return out
    return counts(pred, ref)


def _n_grams(tokens: Column, n: int) -> Column:
    """Number of n-grams: that of the tokens, less n - 1."""
    size = F.size(tokens)
    return size if n == 1 else F.when(size >= n, size - (n - 1)).otherwise(0)


def _line_tokens(c) -> Column:
    lines = F.filter(F.split(_col(c), "\n"), lambda s: F.length(s) > 0)
    return F.transform(lines, lambda s: rouge_tokens(s))


def rouge_lsum(pred, ref) -> Column:
    """A4: ROUGE-Lsum (lines split on newline, union LCS with clipped hits)."""
    return _rouge_lsum_udf(_line_tokens(pred), _line_tokens(ref))


# ------------------------------------------------------------------ BLEU

def bleu_from_sums(m: list[Column], p: list[Column], pred_len: Column, ref_len: Column) -> Column:
    """BLEU without smoothing from corpus sums -> struct(bleu, precisions, bp, ratio, lengths)."""
    prec = [F.when(pi > 0, mi.cast("double") / pi).otherwise(F.lit(0.0)) for mi, pi in zip(m, p)]
    all_pos = F.least(*prec) > 0
    geo = F.when(all_pos, F.exp(sum(F.log(F.when(all_pos, x).otherwise(F.lit(1.0))) for x in prec) / len(prec)))
    geo = F.coalesce(geo, F.lit(0.0))
    ratio = F.when(ref_len > 0, pred_len.cast("double") / ref_len)
    bp = (F.when(ratio > 1.0, F.lit(1.0))
          .when(ratio > 0, F.exp(1.0 - 1.0 / F.when(ratio > 0, ratio).otherwise(F.lit(1.0))))
          .otherwise(F.lit(0.0)))
    return F.struct((geo * bp).alias("bleu"), F.array(*prec).alias("precisions"), bp.alias("brevity_penalty"),
                    ratio.alias("length_ratio"), pred_len.alias("translation_length"),
                    ref_len.alias("reference_length"))


def corpus_bleu(df: DataFrame, parts_col: str = "bp", group_cols: list[str] | None = None,
                max_order: int = 4) -> DataFrame:
    """A5: corpus BLEU (sums over pairs, then the formula), optionally per group."""
    aggs = [F.sum(F.col(f"{parts_col}.m{n}")).alias(f"m{n}") for n in range(1, max_order + 1)]
    aggs += [F.sum(F.col(f"{parts_col}.p{n}")).alias(f"p{n}") for n in range(1, max_order + 1)]
    aggs += [F.sum(f"{parts_col}.pred_len").alias("pred_len"), F.sum(f"{parts_col}.ref_len").alias("ref_len")]
    g = df.groupBy(*(group_cols or [])).agg(*aggs)
    return g.select(*(group_cols or []), bleu_from_sums(
        [F.col(f"m{n}") for n in range(1, max_order + 1)], [F.col(f"p{n}") for n in range(1, max_order + 1)],
        F.col("pred_len"), F.col("ref_len")).alias("bleu"))


def score_pairs(df: DataFrame, pred_col: str = "prediction", ref_col: str = "reference",
                metrics=("rouge1", "rouge2", "rougeL", "bleu"), max_order: int = 4) -> DataFrame:
    """Adds one struct column per metric.  Token and n-gram arrays are projected once
    as columns (Catalyst keeps a non-cheap projection that is referenced several
    times instead of inlining it), so each regex chain runs once per row."""
    keep = [c for c in df.columns if c not in ("_rr", "_br")]
    want_r = any(m in metrics for m in ("rouge1", "rouge2", "rougeL"))
    toks = []
    # reference tokens may be projected by the caller (``_rr`` / ``_br``), e.g. once per
    # reference before it is fanned out to several models
    if want_r:
        toks.append(rouge_tokens(pred_col).alias("_rp"))
        if "_rr" not in df.columns:
            toks.append(rouge_tokens(ref_col).alias("_rr"))
    if "bleu" in metrics:
        toks.append(bleu_tokens(pred_col).alias("_bp"))
        if "_br" not in df.columns:
            toks.append(bleu_tokens(ref_col).alias("_br"))
    cur = df.select("*", *toks)
    # one pass of Python over the tokens counts the shared n-grams of every order
    shared = []
    if "rouge1" in metrics or "rouge2" in metrics:
        shared.append(shared_grams(F.col("_rp"), F.col("_rr"), 2 if "rouge2" in metrics else 1).alias("_rm"))
    if "bleu" in metrics:
        shared.append(shared_grams(F.col("_bp"), F.col("_br"), max_order).alias("_bm"))
    if "rougeL" in metrics:
        shared.append(_rouge_l_udf(F.col("_rp"), F.col("_rr")).alias("_lcs"))
    cur = cur.select("*", *shared)

    def prf(n):
        ov = F.col(f"_rm.m{n}").cast("double")
        p = ov / F.greatest(_n_grams(F.col("_rp"), n), F.lit(1))
        r = ov / F.greatest(_n_grams(F.col("_rr"), n), F.lit(1))
        return p, r

    outs = []
    if "rouge1" in metrics:
        outs.append(_prf_struct(*prf(1), "_p1"))
    if "rouge2" in metrics:
        outs.append(_prf_struct(*prf(2), "_p2"))
    if "bleu" in metrics:
        fields = []
        for n in range(1, max_order + 1):
            fields.append(F.col(f"_bm.m{n}").alias(f"m{n}"))
            fields.append(_n_grams(F.col("_bp"), n).cast("long").alias(f"p{n}"))
        fields += [F.size("_bp").cast("long").alias("pred_len"), F.size("_br").cast("long").alias("ref_len")]
        outs.append(F.struct(*fields).alias("bleu_parts"))
    cur = cur.select("*", *outs)
    final = [F.col(c) for c in keep]
    if "rouge1" in metrics:
        final.append(_finish("_p1").alias("rouge1"))
    if "rouge2" in metrics:
        final.append(_finish("_p2").alias("rouge2"))
    if "rougeL" in metrics:
        final.append(F.col("_lcs").alias("rougeL"))
    if "bleu" in metrics:
        final.append(F.col("bleu_parts"))
    return cur.select(*final)


def _prf_struct(p, r, name):
    return F.struct(p.alias("precision"), r.alias("recall")).alias(name)


def _finish(name):
    p, r = F.col(f"{name}.precision"), F.col(f"{name}.recall")
    return F.struct(p.alias("precision"), r.alias("recall"), fmeasure(p, r).alias("fmeasure"))


def leaderboard(pred: DataFrame, model_col: str = "model", pred_col: str = "prediction",
                ref_col: str = "reference", max_order: int = 4) -> DataFrame:
    """Per-model mean ROUGE-1/2/L/Lsum F-measure and the corpus BLEU struct in one aggregation
    (one pass over the scored pairs; partial aggregation before the shuffle)."""
    extra = [c for c in ("_rr", "_br") if c in pred.columns]
    scored = score_pairs(pred.select(model_col, pred_col, ref_col, *extra), pred_col, ref_col)
    scored = scored.withColumn("rougeLsum", rouge_lsum(F.col(pred_col), F.col(ref_col)))
    n = range(1, max_order + 1)
    g = scored.groupBy(model_col).agg(
        F.count("*").alias("n_pairs"), F.avg("rouge1.fmeasure").alias("rouge1"),
        F.avg("rouge2.fmeasure").alias("rouge2"), F.avg("rougeL.fmeasure").alias("rougeL"),
        F.avg("rougeLsum.fmeasure").alias("rougeLsum"),
        *[F.sum(f"bleu_parts.m{i}").alias(f"m{i}") for i in n], *[F.sum(f"bleu_parts.p{i}").alias(f"p{i}") for i in n],
        F.sum("bleu_parts.pred_len").alias("pred_len"), F.sum("bleu_parts.ref_len").alias("ref_len"))
    return g.select(model_col, "n_pairs", "rouge1", "rouge2", "rougeL", "rougeLsum", bleu_from_sums(
        [F.col(f"m{i}") for i in n], [F.col(f"p{i}") for i in n], F.col("pred_len"), F.col("ref_len")).alias("bleu"))


#: P(X <= x) of a Poisson variable of mean 1, x = 0, 1, ...: a draw is the number of these at or below u
POISSON = [sum(math.exp(-1) / math.factorial(i) for i in range(x + 1)) for x in range(9)]


def poisson_weight(key: Column, replicate: Column, seed: str = "boot") -> Column:
    """Bootstrap weight of a row in a replicate: Poisson(1) of an md5-seeded uniform (the same in any engine)."""
    h = F.md5(F.concat_ws(":", F.lit(seed), replicate.cast("string"), key))
    u = F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return sum(F.when(u >= c, 1).otherwise(0) for c in POISSON)


def bootstrap_means(scored: DataFrame, group: str, key: Column, value_cols: list[str], replicates: int = 100,
                    low: float = 0.025, high: float = 0.975) -> DataFrame:
    """Mean of each column per group with a percentile interval over Poisson bootstrap replicates.

    A row's weight in a replicate depends on its key alone, so no sample is drawn and nothing is
    shuffled but one partial sum per task, group and replicate."""
    rows = scored.select(group, key.alias("_key"), *value_cols).withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(replicates))))
    # replicate 0 is the plain mean
    w = F.when(F.col("_b") == 0, F.lit(1)).otherwise(poisson_weight(F.col("_key"), F.col("_b")))
    sums = rows.withColumn("_w", w).groupBy(group, "_b").agg(F.sum("_w").alias("_n"), *[F.sum(F.col("_w") * F.col(c)).alias(c) for c in value_cols])
    means = sums.select(group, "_b", *[(F.col(c) / F.when(F.col("_n") > 0, F.col("_n"))).alias(c) for c in value_cols])
    out = []
    for c in value_cols:
        drawn = F.array_sort(F.collect_list(F.when(F.col("_b") > 0, F.col(c))))  # replicates at most
        at = lambda share: F.get(drawn, F.floor(F.lit(share) * F.size(drawn)).cast("int"))
        out += [F.max(F.when(F.col("_b") == 0, F.col(c))).alias(c), at(low).alias(f"{c}_low"), at(high).alias(f"{c}_high")]
    return means.groupBy(group).agg(*out)


def metrics_json(df: DataFrame, key_col: str, metric_cols: list[str]) -> DataFrame:
    """K5: one JSON document per key (``to_json`` of the metric struct)."""
    return df.select(key_col, F.to_json(F.struct(*metric_cols)).alias("metrics_json"))
