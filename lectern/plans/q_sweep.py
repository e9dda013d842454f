"""Registered sweep query (W1, W2, A8, A9): trials re-aimed at this pipeline's own
parameters -- chunk budget = 32 x batch_size, passages per question = num_train_epochs, the
least number of question terms in a summary sentence = where the learning rate lies in its
range, in quarters -- with loss = 1 - mean ROUGE-1 F of the built-in summary against the reference."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from lectern.operators.metrics import score_pairs
from lectern.operators.sweep import BATCH_SIZES, EPOCHS, LR_HIGH, LR_LOW, N_TRIALS, SEED, best_trial, log_position, trial_table
from lectern.plans import sqlparts as S
from lectern.plans.answers import retrieve, with_extractive_summary
from lectern.plans.corpus import build_points
from lectern.plans.q_metrics import overlap_ctes, prf_sql
from lectern.sources.tables import catalogue, documents, questions

DIM = 384
BUDGET_PER_BATCH = 32
#: values of the least overlap: 0 and up
OVERLAPS = 4
SEP = "\n\n"


def q34_sweep(spark, sf):
    trials = (trial_table(spark).withColumn("chunk_budget", F.col("batch_size") * BUDGET_PER_BATCH)
              .withColumn("top_k", F.col("num_train_epochs"))
              .withColumn("min_overlap", F.floor(F.round(log_position(F.col("learning_rate")) * OVERLAPS, 9)).cast("int")))
    # the distinct budgets are values of a 4-way categorical parameter: bounded
    budgets = sorted(r[0] for r in trials.select("chunk_budget").distinct().collect())
    max_k = max(EPOCHS)
    q = questions(spark, sf)
    # every budget's collection is built in the same jobs (one sentence split, one
    # chunk write, one point write) and searched in one grouped top-k job
    pts = build_points(spark, documents(spark, sf), catalogue(spark, sf), budget=budgets, dim=DIM)
    hits = retrieve(pts, q, k=max_k, dim=DIM, group_col="chunk_budget", groups=budgets)
    # trials: N_TRIALS rows (a parameter), broadcast by construction; a trial has every question with
    # a reference, with an empty context where nothing was found
    t = F.broadcast(trials.select("trial_id", "chunk_budget", "top_k", "min_overlap"))
    th = hits.join(t, "chunk_budget").filter(F.col("rank") <= F.col("top_k"))
    ordered = F.array_sort(F.collect_list(F.struct("rank", "text")))
    ctx = th.groupBy("trial_id", "qid").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), SEP).alias("context"))
    asked = q.filter(F.col("reference").isNotNull() & (F.col("reference") != ""))
    ids = [r["trial_id"] for r in trials.select("trial_id").collect()]
    asked = asked.withColumn("trial_id", F.explode(F.array(*[F.lit(i) for i in ids]))).join(t, "trial_id")
    ev = asked.join(ctx, ["trial_id", "qid"], "left").withColumn("context", F.coalesce("context", F.lit("")))
    ev = with_extractive_summary(ev.select("trial_id", "qid", "reference", "question", "context", "min_overlap"),
                                 "question", "context", min_overlap="min_overlap")
    sc = score_pairs(ev, "summary", "reference", metrics=("rouge1",))
    loss = sc.groupBy("trial_id").agg((1.0 - F.avg("rouge1.fmeasure")).alias("loss"))
    res = best_trial(trials.join(loss, "trial_id", "left"))
    return res.select(F.col("trial_id").cast("long").alias("trial_id"),
                      F.round("learning_rate", 12).alias("learning_rate"),
                      F.col("batch_size").cast("long").alias("batch_size"),
                      F.col("num_train_epochs").cast("long").alias("num_train_epochs"),
                      F.col("chunk_budget").cast("long").alias("chunk_budget"), F.col("top_k").cast("long").alias("top_k"),
                      F.col("min_overlap").cast("long").alias("min_overlap"), F.round("loss", 9).alias("loss"), "is_best")


def _sql_u(tag):
    return f"(('0x' || substr(md5('{SEED}:{tag}:' || trial_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0)"


def sql_q34_sweep():
    lo, hi = math.log(LR_LOW), math.log(LR_HIGH)
    bs = "[" + ", ".join(map(str, BATCH_SIZES)) + "]"
    ep = "[" + ", ".join(map(str, EPOCHS)) + "]"
    trials = f"""trials0 AS (SELECT range::INTEGER AS trial_id FROM range({N_TRIALS})),
trials AS (SELECT trial_id, exp({lo!r} + {_sql_u('lr')} * {hi - lo!r}) AS learning_rate,
  {bs}[floor({_sql_u('batch')} * {len(BATCH_SIZES)})::INTEGER + 1] AS batch_size,
  {ep}[floor({_sql_u('epochs')} * {len(EPOCHS)})::INTEGER + 1] AS num_train_epochs FROM trials0),
trials2 AS (SELECT *, batch_size * {BUDGET_PER_BATCH} AS chunk_budget, num_train_epochs AS top_k,
  floor(round((ln(learning_rate) - {lo!r}) / {hi - lo!r} * {OVERLAPS}, 9))::INTEGER AS min_overlap FROM trials)"""
    parts = []
    for b in BATCH_SIZES:
        bud = b * BUDGET_PER_BATCH
        parts.append(S.points_ctes(bud, DIM, p=f"b{bud}_", sents="ss"))
        parts.append(S.topk_ctes(max(EPOCHS), DIM, "qs", p=f"b{bud}_", qvec="qv"))
    allhits = " UNION ALL ".join(f"SELECT {b * BUDGET_PER_BATCH} AS chunk_budget, * FROM b{b * BUDGET_PER_BATCH}_hits"
                                 for b in BATCH_SIZES)
    qterms = f"list_distinct({S.rouge_tokens('question')})"
    scored = (f"list_transform({S.sentences('context')}, lambda s, i: "
              f"{{'neg': -len(list_intersect(list_distinct({S.rouge_tokens('s')}), qt)), 'pos': i, 's': s}})")
    summary = ("array_to_string(list_transform(list_sort(list_transform(list_slice(list_sort(list_filter(sc, lambda x: -x.neg >= min_overlap)), 1, 3), "
               "lambda x: {'pos': x.pos, 's': x.s})), lambda x: x.s), ' ')")
    _, _, f = prf_sql("o.ov", "o.np", "o.nr")
    return f"""WITH RECURSIVE {trials},
{S.question_ctes()},
{S.sentence_cte('ss', 'documents', 'doc_id', 'text')},
{S.hash_ctes('qv', 'qs', 'qid', 'question', DIM)},
{(','+chr(10)).join(parts)},
allhits AS ({allhits}),
th AS (SELECT t.trial_id, h.qid, h.rank, h.text FROM trials2 t JOIN allhits h ON h.chunk_budget = t.chunk_budget WHERE h.rank <= t.top_k),
ctx AS (SELECT trial_id, qid, string_agg(text, {S.lit(SEP)} ORDER BY rank) AS context FROM th GROUP BY ALL),
g AS (SELECT t.trial_id, t.min_overlap, q.qid, q.question, q.reference, coalesce(c.context, '') AS context, {qterms} AS qt
  FROM qs q CROSS JOIN trials2 t LEFT JOIN ctx c ON c.qid = q.qid AND c.trial_id = t.trial_id WHERE q.reference IS NOT NULL AND q.reference <> ''),
g2 AS (SELECT *, {scored} AS sc FROM g),
sp AS MATERIALIZED (SELECT row_number() OVER (ORDER BY trial_id, qid) AS pid, trial_id, {summary} AS pred, reference AS ref FROM g2),
{overlap_ctes('o', 'sp', S.rouge_tokens, 1)},
loss AS (SELECT sp.trial_id, 1.0 - avg({f}) AS loss FROM o JOIN sp ON sp.pid = o.pid GROUP BY sp.trial_id),
res AS (SELECT t.*, l.loss FROM trials2 t LEFT JOIN loss l ON l.trial_id = t.trial_id)
SELECT trial_id::BIGINT AS trial_id, round(learning_rate, 12) AS learning_rate, batch_size::BIGINT AS batch_size,
  num_train_epochs::BIGINT AS num_train_epochs, chunk_budget::BIGINT AS chunk_budget, top_k::BIGINT AS top_k,
  min_overlap::BIGINT AS min_overlap, round(loss, 9) AS loss, trial_id = (SELECT arg_min(trial_id, (round(loss, 9), trial_id)) FROM res) AS is_best FROM res"""


QUERIES = {
    "q34_sweep": (q34_sweep, sql_q34_sweep),
}
