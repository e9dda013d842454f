"""Registered metric queries: ROUGE-1/2/L/Lsum per pair, corpus BLEU, per-model
leaderboard (A3-A7, J3, K5, F11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions.ngrams import bleu_tokens, rouge_tokens
from lectern.functions.text import sentences, truncate_tokens
from lectern.operators.metrics import POISSON, bootstrap_means, corpus_bleu, leaderboard, metrics_json, rouge_lsum, score_pairs
from lectern.plans import sqlparts as S
from lectern.session import scratch_dir
from lectern.sources.tables import metric_pairs

# ---------------------------------------------------------------- SQL building blocks

PAIRS_SQL = """pairs AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY u.conv_id, u.turn) AS pid, u.conv_id, u.turn, u.text AS pred, a.text AS ref
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'
)"""


def overlap_ctes(prefix: str, pairs: str, tok: str, n: int) -> str:
    """(pid, ov, np, nr): clipped n-gram overlap and n-gram counts of each pair."""
    def grams(col):
        return (f"unnest(list_transform(range(1, len({col}) - {n} + 2), "
                f"lambda i: array_to_string(list_slice({col}, i, i + {n} - 1), ' ')))")
    return f"""{prefix}_t AS MATERIALIZED (SELECT pid, {tok('pred')} AS tp, {tok('ref')} AS tr FROM {pairs}),
{prefix}_gp AS (SELECT pid, g, count(*) AS c FROM (SELECT pid, {grams('tp')} AS g FROM {prefix}_t) GROUP BY ALL),
{prefix}_gr AS (SELECT pid, g, count(*) AS c FROM (SELECT pid, {grams('tr')} AS g FROM {prefix}_t) GROUP BY ALL),
{prefix}_ov AS (SELECT p.pid, sum(least(p.c, r.c)) AS ov FROM {prefix}_gp p JOIN {prefix}_gr r ON r.pid = p.pid AND r.g = p.g GROUP BY ALL),
{prefix} AS (SELECT t.pid, coalesce(o.ov, 0)::BIGINT AS ov, greatest(len(t.tp) - {n} + 1, 0)::BIGINT AS np,
  greatest(len(t.tr) - {n} + 1, 0)::BIGINT AS nr, len(t.tp)::BIGINT AS lp, len(t.tr)::BIGINT AS lr
  FROM {prefix}_t t LEFT JOIN {prefix}_ov o ON o.pid = t.pid)"""


def prf_sql(ov: str, np_: str, nr: str) -> tuple[str, str, str]:
    p = f"({ov} / greatest({np_}, 1))"
    r = f"({ov} / greatest({nr}, 1))"
    f = f"(CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END)"
    return p, r, f


def lcs_ctes(prefix: str, pairs: str, tok) -> str:
    """(pid, lcs, lp, lr): exact LCS by a DP over cells, recursing over the shorter side.

    Tokens are unnested into scalar tables so each DP step joins scalars, not lists."""
    return f"""{prefix}_ab AS MATERIALIZED (
  SELECT pid, len(tp) AS lp, len(tr) AS lr,
         CASE WHEN len(tp) <= len(tr) THEN tp ELSE tr END AS x, CASE WHEN len(tp) <= len(tr) THEN tr ELSE tp END AS y
  FROM (SELECT pid, {tok('pred')} AS tp, {tok('ref')} AS tr FROM {pairs})
),
{prefix}_x AS MATERIALIZED (SELECT pid, unnest(x) AS tok, generate_subscripts(x, 1) AS i FROM {prefix}_ab),
{prefix}_y AS MATERIALIZED (SELECT pid, unnest(y) AS tok, generate_subscripts(y, 1) AS j FROM {prefix}_ab),
{prefix}_dp AS (
  SELECT pid, 0 AS i, j, 0::BIGINT AS L FROM (SELECT pid, j FROM {prefix}_y UNION ALL SELECT pid, 0 FROM {prefix}_ab)
  UNION ALL
  SELECT pid, i, j, max(c) OVER (PARTITION BY pid ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  FROM (
    SELECT d.pid, d.i + 1 AS i, d.j,
      CASE WHEN d.j = 0 THEN 0
           WHEN yy.tok = xx.tok THEN lag(d.L) OVER (PARTITION BY d.pid ORDER BY d.j) + 1
           ELSE d.L END AS c
    FROM {prefix}_dp d
    JOIN {prefix}_x xx ON xx.pid = d.pid AND xx.i = d.i + 1
    LEFT JOIN {prefix}_y yy ON yy.pid = d.pid AND yy.j = d.j
  )
),
{prefix} AS (
  SELECT ab.pid, max(d.L)::BIGINT AS lcs, any_value(ab.lp) AS lp, any_value(ab.lr) AS lr
  FROM {prefix}_ab ab JOIN {prefix}_dp d ON d.pid = ab.pid AND d.i = len(ab.x) GROUP BY ab.pid
)"""


def rouge_l_prf(prefix: str) -> tuple[str, str, str]:
    p = f"(CASE WHEN {prefix}.lp = 0 OR {prefix}.lr = 0 THEN 0.0 ELSE {prefix}.lcs / {prefix}.lp END)"
    r = f"(CASE WHEN {prefix}.lp = 0 OR {prefix}.lr = 0 THEN 0.0 ELSE {prefix}.lcs / {prefix}.lr END)"
    f = f"(CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END)"
    return p, r, f


ROUGE_TOK = S.rouge_tokens


def bleu_sums_sql(pairs: str, group: str | None = None) -> tuple[str, str]:
    """CTEs for n = 1..4 and a SELECT body computing corpus BLEU (optionally per group)."""
    tok = S.bleu_tokens
    ctes = ",\n".join(overlap_ctes(f"b{n}", pairs, tok, n) for n in range(1, 5))
    name = group.split(".")[-1] if group else None
    g = f"{group} AS {name}, " if group else ""
    go = f"{name}, " if group else ""
    joins = " ".join(f"JOIN b{n} ON b{n}.pid = b1.pid" for n in range(2, 5))
    src = f"b1 {joins} JOIN {pairs} pp ON pp.pid = b1.pid"
    sums = ", ".join(f"sum(b{n}.ov) AS m{n}, sum(b{n}.np) AS p{n}" for n in range(1, 5))
    agg = (f"SELECT {g}{sums}, sum(b1.lp) AS pred_len, sum(b1.lr) AS ref_len FROM {src}"
           + (f" GROUP BY {group}" if group else ""))
    prec = [f"(CASE WHEN p{n} > 0 THEN m{n} / p{n} ELSE 0.0 END)" for n in range(1, 5)]
    geo = (f"(CASE WHEN least({', '.join(prec)}) > 0 THEN exp(({' + '.join(f'ln({x})' for x in prec)}) / 4) "
           f"ELSE 0.0 END)")
    ratio = "(CASE WHEN ref_len > 0 THEN pred_len / ref_len END)"
    bp = f"(CASE WHEN {ratio} > 1.0 THEN 1.0 WHEN {ratio} > 0 THEN exp(1.0 - 1.0 / {ratio}) ELSE 0.0 END)"
    body = (f"SELECT {go}round({geo} * {bp}, 9) AS bleu, "
            + ", ".join(f"round({x}, 9) AS precision_{i + 1}" for i, x in enumerate(prec))
            + f", round({bp}, 9) AS brevity_penalty, round({ratio}, 9) AS length_ratio, "
              f"pred_len::BIGINT AS translation_length, ref_len::BIGINT AS reference_length FROM ({agg})")
    return ctes, body


# ---------------------------------------------------------------- queries

def _pairs(spark, sf):
    return metric_pairs(spark, sf)


def _rouge_n_query(n):
    def q(spark, sf):
        s = score_pairs(_pairs(spark, sf), metrics=(f"rouge{n}",)).select("conv_id", "turn", F.col(f"rouge{n}").alias("r"))
        return s.select("conv_id", "turn", *[F.round(F.col(f"r.{k}"), 9).alias(k)
                                             for k in ("precision", "recall", "fmeasure")])
    return q


def _sql_rouge_n(n):
    def sql():
        p, r, f = prf_sql("o.ov", "o.np", "o.nr")
        return f"""WITH {PAIRS_SQL},
{overlap_ctes('o', 'pairs', ROUGE_TOK, n)}
SELECT pp.conv_id, pp.turn, round({p}, 9) AS precision, round({r}, 9) AS recall, round({f}, 9) AS fmeasure
FROM o JOIN pairs pp ON pp.pid = o.pid"""
    return sql


def q24_rouge_l(spark, sf):
    s = score_pairs(_pairs(spark, sf), metrics=("rougeL",)).select("conv_id", "turn", F.col("rougeL").alias("r"))
    return s.select("conv_id", "turn", *[F.round(F.col(f"r.{k}"), 9).alias(k) for k in ("precision", "recall", "fmeasure")])


def sql_q24_rouge_l():
    p, r, f = rouge_l_prf("l")
    return f"""WITH RECURSIVE {PAIRS_SQL},
{lcs_ctes('l', 'pairs', ROUGE_TOK)}
SELECT pp.conv_id, pp.turn, round({p}, 9) AS precision, round({r}, 9) AS recall, round({f}, 9) AS fmeasure
FROM l JOIN pairs pp ON pp.pid = l.pid"""


def q25_rouge_lsum(spark, sf):
    s = _pairs(spark, sf).select("conv_id", "turn", rouge_lsum("prediction", "reference").alias("r"))
    return s.select("conv_id", "turn", *[F.round(F.col(f"r.{k}"), 9).alias(k) for k in ("precision", "recall", "fmeasure")])


def lsum_ctes(pairs: str) -> str:
    """(pid, h, m, n): union-LCS hits and token counts of both sides.  Union-LCS over newline-separated lines: a DP table per (reference line, candidate
    line), a backtrack with the metric's tie rule, then hits = sum over tokens of
    min(occurrences in the union, candidate count)."""
    tok = S.rouge_tokens
    nl = "chr(10)"
    lines = lambda col: f"list_filter(string_split({col}, {nl}), lambda s: length(s) > 0)"
    return f"""ln AS MATERIALIZED (
  SELECT pid, side, li, {tok('line')} AS toks FROM (
    SELECT pid, 'c' AS side, unnest(l) AS line, generate_subscripts(l, 1) AS li FROM (SELECT pid, {lines('pred')} AS l FROM {pairs})
    UNION ALL
    SELECT pid, 'r', unnest(l), generate_subscripts(l, 1) FROM (SELECT pid, {lines('ref')} AS l FROM {pairs}))
),
lp AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY r.pid, r.li, c.li) AS lpid, r.pid, r.li AS ri, r.toks AS x, c.toks AS y
  FROM ln r JOIN ln c ON c.pid = r.pid WHERE r.side = 'r' AND c.side = 'c'
),
xt AS MATERIALIZED (SELECT lpid, unnest(x) AS tok, generate_subscripts(x, 1) AS i FROM lp),
yt AS MATERIALIZED (SELECT lpid, unnest(y) AS tok, generate_subscripts(y, 1) AS j FROM lp),
dp AS (
  SELECT lpid, 0 AS i, j, 0::BIGINT AS L FROM (SELECT lpid, j FROM yt UNION ALL SELECT lpid, 0 FROM lp)
  UNION ALL
  SELECT lpid, i, j, max(c) OVER (PARTITION BY lpid ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  FROM (
    SELECT d.lpid, d.i + 1 AS i, d.j,
      CASE WHEN d.j = 0 THEN 0
           WHEN yy.tok = xx.tok THEN lag(d.L) OVER (PARTITION BY d.lpid ORDER BY d.j) + 1
           ELSE d.L END AS c
    FROM dp d JOIN xt xx ON xx.lpid = d.lpid AND xx.i = d.i + 1
    LEFT JOIN yt yy ON yy.lpid = d.lpid AND yy.j = d.j)
),
dpm AS MATERIALIZED (SELECT * FROM dp),
bt AS (
  SELECT lpid, len(x) AS i, len(y) AS j, NULL::BIGINT AS hit FROM lp
  UNION ALL
  SELECT b.lpid,
    CASE WHEN xx.tok = yy.tok THEN b.i - 1 WHEN lf.L > up.L THEN b.i ELSE b.i - 1 END,
    CASE WHEN xx.tok = yy.tok THEN b.j - 1 WHEN lf.L > up.L THEN b.j - 1 ELSE b.j END,
    CASE WHEN xx.tok = yy.tok THEN b.i END
  FROM bt b
  JOIN xt xx ON xx.lpid = b.lpid AND xx.i = b.i
  JOIN yt yy ON yy.lpid = b.lpid AND yy.j = b.j
  JOIN dpm lf ON lf.lpid = b.lpid AND lf.i = b.i AND lf.j = b.j - 1
  JOIN dpm up ON up.lpid = b.lpid AND up.i = b.i - 1 AND up.j = b.j
  WHERE b.i > 0 AND b.j > 0
),
uni AS (SELECT DISTINCT lp.pid, lp.ri, b.hit, lp.x[b.hit] AS t FROM bt b JOIN lp ON lp.lpid = b.lpid WHERE b.hit IS NOT NULL),
occ AS (SELECT pid, t, count(*) AS o FROM uni GROUP BY ALL),
cc AS (SELECT pid, t, count(*) AS c FROM (SELECT pid, unnest(toks) AS t FROM ln WHERE side = 'c') GROUP BY ALL),
u_hits AS (SELECT o.pid, sum(least(o.o, c.c)) AS h FROM occ o JOIN cc c ON c.pid = o.pid AND c.t = o.t GROUP BY o.pid),
u_sizes AS (SELECT pid, sum(len(toks)) FILTER (WHERE side = 'r') AS m, sum(len(toks)) FILTER (WHERE side = 'c') AS n FROM ln GROUP BY pid),
lsum AS (SELECT p.pid, coalesce(h.h, 0) AS h, coalesce(z.m, 0) AS m, coalesce(z.n, 0) AS n
  FROM {pairs} p LEFT JOIN u_hits h ON h.pid = p.pid LEFT JOIN u_sizes z ON z.pid = p.pid)"""


def lsum_prf() -> tuple[str, str, str]:
    p = "(CASE WHEN m = 0 OR n = 0 THEN 0.0 ELSE h / n END)"
    r = "(CASE WHEN m = 0 OR n = 0 THEN 0.0 ELSE h / m END)"
    return p, r, "(CASE WHEN m = 0 OR n = 0 OR h = 0 THEN 0.0 ELSE 2 * (h / n) * (h / m) / ((h / n) + (h / m)) END)"


def sql_q25_rouge_lsum():
    p, r, f = lsum_prf()
    return f"""WITH RECURSIVE {PAIRS_SQL},
{lsum_ctes('pairs')}
SELECT conv_id, turn, round({p}, 9) AS precision, round({r}, 9) AS recall, round({f}, 9) AS fmeasure
FROM lsum JOIN pairs USING (pid)"""


def q26_bleu(spark, sf):
    s = score_pairs(_pairs(spark, sf), metrics=("bleu",))
    b = corpus_bleu(s, "bleu_parts")
    return b.select(F.round("bleu.bleu", 9).alias("bleu"),
                    *[F.round(F.col("bleu.precisions")[i], 9).alias(f"precision_{i + 1}") for i in range(4)],
                    F.round("bleu.brevity_penalty", 9).alias("brevity_penalty"),
                    F.round("bleu.length_ratio", 9).alias("length_ratio"),
                    F.col("bleu.translation_length").cast("long").alias("translation_length"),
                    F.col("bleu.reference_length").cast("long").alias("reference_length"))


def sql_q26_bleu():
    ctes, body = bleu_sums_sql("pairs")
    return f"WITH {PAIRS_SQL},\n{ctes}\n{body}"


# --- q31: leaderboard of three built-in generators on the metric pairs
MODELS = [("lead_1", 1), ("lead_3", 3)]
HEAD_TOKENS = 150


def _predictions(spark, sf):
    p = _pairs(spark, sf)
    gens = [F.struct(F.lit(name).alias("model"), F.array_join(F.slice(sentences("prediction"), 1, n), " ").alias("out"))
            for name, n in MODELS]
    gens.append(F.struct(F.lit("head_150").alias("model"), truncate_tokens("prediction", HEAD_TOKENS).alias("out")))
    # each reference is tokenised once, before it is paired with every model's output
    p = p.select("*", rouge_tokens("reference").alias("_rr"), bleu_tokens("reference").alias("_br"))
    e = p.select("conv_id", "turn", "reference", "_rr", "_br", F.explode(F.array(*gens)).alias("g"))
    return e.select(F.col("g.model").alias("model"), "conv_id", "turn", F.col("g.out").alias("prediction"),
                    "reference", "_rr", "_br")


METRICS_JSON = ("rouge1 double, rouge2 double, rougeL double, rougeLsum double, bleu struct<bleu:double, precisions:array<double>, "
                "brevity_penalty:double, length_ratio:double, translation_length:bigint, reference_length:bigint>")


def q31_leaderboard(spark, sf):
    """One JSON document of metrics per model, written and read back."""
    lb = leaderboard(_predictions(spark, sf))
    path = scratch_dir(spark, "metrics")
    metrics_json(lb.withColumn("model", F.concat_ws("=", "model", "n_pairs")), "model", ["rouge1", "rouge2", "rougeL", "rougeLsum", "bleu"]) \
        .write.json(path)
    back = spark.read.schema("model string, metrics_json string").json(path)
    m = back.select(F.split("model", "=").alias("k"), F.from_json("metrics_json", METRICS_JSON).alias("m"))
    return m.select(F.col("k")[0].alias("model"), F.col("k")[1].cast("long").alias("n_pairs"),
                    *[F.round(f"m.{c}", 9).alias(c) for c in ("rouge1", "rouge2", "rougeL", "rougeLsum")],
                    F.round("m.bleu.bleu", 9).alias("bleu"), *_bleu_columns("m.bleu"))


def _bleu_columns(b: str):
    return [*[F.round(F.col(f"{b}.precisions")[i], 9).alias(f"precision_{i + 1}") for i in range(4)],
            F.round(f"{b}.brevity_penalty", 9).alias("brevity_penalty"), F.round(f"{b}.length_ratio", 9).alias("length_ratio"),
            F.col(f"{b}.translation_length").cast("long").alias("translation_length"),
            F.col(f"{b}.reference_length").cast("long").alias("reference_length")]


REPLICATES = 100


def q38_score_intervals(spark, sf):
    """A6 and A7 with intervals: mean ROUGE per model, and its 95 % interval over bootstrap replicates."""
    s = score_pairs(_predictions(spark, sf).select("model", "conv_id", "turn", "prediction", "reference", "_rr"), metrics=("rouge1", "rouge2", "rougeL"))
    flat = s.select("model", F.concat_ws("/", "conv_id", "turn").alias("key"), *[F.col(f"{c}.fmeasure").alias(c) for c in ("rouge1", "rouge2", "rougeL")])
    b = bootstrap_means(flat, "model", F.col("key"), ["rouge1", "rouge2", "rougeL"], REPLICATES)
    return b.select("model", *[F.round(c, 9).alias(c) for c in b.columns if c != "model"])


def sql_q38_score_intervals():
    p1, _, f1 = prf_sql("o1.ov", "o1.np", "o1.nr")
    p2, _, f2 = prf_sql("o2.ov", "o2.np", "o2.nr")
    _, _, fl = rouge_l_prf("l")
    u = "(('0x' || substr(md5('boot:' || b::VARCHAR || ':' || conv_id::VARCHAR || '/' || turn::VARCHAR), 1, 8))::BIGINT / 4294967296.0)"
    w = " + ".join(f"(CASE WHEN {u} >= {c!r} THEN 1 ELSE 0 END)" for c in POISSON)
    cols = ("rouge1", "rouge2", "rougeL")
    ends = ", ".join(f"round(max({c}) FILTER (WHERE b = 0), 9) AS {c}, round(list_sort(list({c}) FILTER (WHERE b > 0 AND {c} IS NOT NULL))"
                     f"[floor(0.025 * count({c}) FILTER (WHERE b > 0))::INT + 1], 9) AS {c}_low, round(list_sort(list({c}) FILTER (WHERE b > 0 AND {c} IS NOT NULL))"
                     f"[floor(0.975 * count({c}) FILTER (WHERE b > 0))::INT + 1], 9) AS {c}_high" for c in cols)
    return f"""WITH RECURSIVE {_model_pairs()},
{overlap_ctes('o1', 'mpairs', ROUGE_TOK, 1)},
{overlap_ctes('o2', 'mpairs', ROUGE_TOK, 2)},
{lcs_ctes('l', 'mpairs', ROUGE_TOK)},
sc AS (SELECT pp.model, pp.conv_id, pp.turn, {f1} AS rouge1, {f2} AS rouge2, {fl} AS rougeL
  FROM mpairs pp JOIN o1 ON o1.pid = pp.pid JOIN o2 ON o2.pid = pp.pid JOIN l ON l.pid = pp.pid),
x AS (SELECT model, b, CASE WHEN b = 0 THEN 1 ELSE {w} END AS w, rouge1, rouge2, rougeL FROM sc, (SELECT unnest(range(0, {REPLICATES} + 1)) AS b)),
m AS (SELECT model, b, {', '.join(f'sum(w * {c}) / nullif(sum(w), 0) AS {c}' for c in cols)} FROM x GROUP BY model, b)
SELECT model, {ends} FROM m GROUP BY model"""


def _model_pairs() -> str:
    gens = " UNION ALL ".join(
        f"SELECT '{name}' AS model, conv_id, turn, array_to_string(list_slice({S.sentences('pred')}, 1, {n}), ' ') AS pred, ref FROM base"
        for name, n in MODELS)
    gens += f" UNION ALL SELECT 'head_150', conv_id, turn, {S.truncate_tokens('pred', HEAD_TOKENS)}, ref FROM base"
    return f"""base AS ({PAIRS_SQL.split('AS MATERIALIZED (', 1)[1].rsplit(')', 1)[0]}),
mpairs AS MATERIALIZED (SELECT row_number() OVER (ORDER BY model, conv_id, turn) AS pid, * FROM ({gens}))"""


def sql_q31_leaderboard():
    p1, _, f1 = prf_sql("o1.ov", "o1.np", "o1.nr")
    p2, _, f2 = prf_sql("o2.ov", "o2.np", "o2.nr")
    _, _, fl = rouge_l_prf("l")
    ctes, body = bleu_sums_sql("mpairs", "pp.model")
    return f"""WITH RECURSIVE {_model_pairs()},
{overlap_ctes('o1', 'mpairs', ROUGE_TOK, 1)},
{overlap_ctes('o2', 'mpairs', ROUGE_TOK, 2)},
{lcs_ctes('l', 'mpairs', ROUGE_TOK)},
{lsum_ctes('mpairs')},
{ctes},
means AS (SELECT pp.model, count(*) AS n_pairs, avg({f1}) AS rouge1, avg({f2}) AS rouge2, avg({fl}) AS rougeL, avg({lsum_prf()[2]}) AS rougeLsum
  FROM mpairs pp JOIN o1 ON o1.pid = pp.pid JOIN o2 ON o2.pid = pp.pid JOIN l ON l.pid = pp.pid JOIN lsum ON lsum.pid = pp.pid GROUP BY pp.model),
bl AS ({body})
SELECT m.model, m.n_pairs::BIGINT AS n_pairs, round(m.rouge1, 9) AS rouge1, round(m.rouge2, 9) AS rouge2,
  round(m.rougeL, 9) AS rougeL, round(m.rougeLsum, 9) AS rougeLsum, bl.* EXCLUDE (model) FROM means m JOIN bl ON bl.model = m.model"""


QUERIES = {
    "q22_rouge1": (_rouge_n_query(1), _sql_rouge_n(1)),
    "q23_rouge2": (_rouge_n_query(2), _sql_rouge_n(2)),
    "q24_rouge_l": (q24_rouge_l, sql_q24_rouge_l),
    "q25_rouge_lsum": (q25_rouge_lsum, sql_q25_rouge_lsum),
    "q26_bleu": (q26_bleu, sql_q26_bleu),
    "q38_score_intervals": (q38_score_intervals, sql_q38_score_intervals),
    "q31_leaderboard": (q31_leaderboard, sql_q31_leaderboard),
}
