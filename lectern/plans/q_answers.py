"""Registered answer-path queries: context, prompt, built-in generation, enrichment,
scoring, system comparison, batched user generation (A2, F9, F10, R6, B2, B3, C3, C4,
P5, J5)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from lectern.operators.generation import batch_generator, make_head_model
from lectern.operators.metrics import bleu_from_sums, rouge_lsum, score_pairs
from lectern.plans import sqlparts as S
from lectern.plans.answers import PROMPT_TOKENS, answer_questions, combine, retrieve, with_extractive_summary
from lectern.plans.corpus import build_points
from lectern.plans.q_metrics import bleu_sums_sql, lcs_ctes, lsum_ctes, lsum_prf, overlap_ctes, prf_sql, rouge_l_prf
from lectern.sources.tables import catalogue, documents, questions

DIM = 384
K = 4


def _answers(spark, sf):
    pts = build_points(spark, documents(spark, sf), catalogue(spark, sf), budget=512, dim=DIM)
    return answer_questions(pts, questions(spark, sf), k=K, dim=DIM)


def q29_context_prompt(spark, sf):
    a = _answers(spark, sf)
    return a.select("qid", F.col("n_passages").cast("long").alias("n_passages"),
                    F.length("context").cast("long").alias("context_chars"), F.md5("context").alias("context_md5"),
                    F.md5("prompt").alias("prompt_md5"),
                    F.size(F.split("prompt", " ")).cast("long").alias("prompt_tokens"))


def _sql_answers() -> str:
    """CTEs up to ``ans`` (qid, question, reference, n_passages, context, prompt, summary, answer)."""
    qterms = f"list_distinct({S.rouge_tokens('question')})"
    scored = (f"list_transform({S.sentences('context')}, lambda s, i: "
              f"{{'neg': -len(list_intersect(list_distinct({S.rouge_tokens('s')}), qt)), 'pos': i, 's': s}})")
    summary = ("array_to_string(list_transform(list_sort(list_transform(list_slice(list_sort(sc), 1, 3), "
               "lambda x: {'pos': x.pos, 's': x.s})), lambda x: x.s), ' ')")
    return f"""{S.points_ctes(512, DIM)},
{S.question_ctes()},
{S.topk_ctes(K, DIM, 'qs')},
ctx AS (SELECT qid, count(*) AS n_passages, string_agg(text, {S.lit(chr(10) * 2)} ORDER BY rank) AS context FROM hits GROUP BY qid),
base AS (
  SELECT q.qid, q.question, q.reference, coalesce(c.n_passages, 0) AS n_passages, coalesce(c.context, '') AS context
  FROM qs q LEFT JOIN ctx c ON c.qid = q.qid
),
gen AS (SELECT *, {S.truncate_tokens(S.prompt('question', 'context'), PROMPT_TOKENS)} AS prompt,
  {qterms} AS qt FROM base),
gen2 AS (SELECT *, {scored} AS sc FROM gen),
ans AS MATERIALIZED (SELECT qid, question, reference, n_passages, context, prompt, {summary} AS summary,
  {S.enrich(summary, 'context')} AS answer FROM gen2)"""


def sql_q29_context_prompt():
    return f"""WITH RECURSIVE {_sql_answers()}
SELECT qid, n_passages::BIGINT AS n_passages, length(context)::BIGINT AS context_chars, md5(context) AS context_md5,
  md5(prompt) AS prompt_md5, len(string_split(prompt, ' '))::BIGINT AS prompt_tokens FROM ans"""


def q30_answer_scores(spark, sf):
    """C3 + C4 in one pass: answers with a (non-empty) reference are scored against it (P5);
    the others go through as empty texts, with null metrics."""
    has_ref = F.col("reference").isNotNull() & (F.col("reference") != "")
    a = _answers(spark, sf).select("qid", "summary", "answer", "reference",
                                   F.when(has_ref, F.col("answer")).otherwise("").alias("scored"))
    s = score_pairs(a, "scored", "reference")
    s = s.withColumn("rougeLsum", rouge_lsum(F.col("scored"), F.coalesce("reference", F.lit(""))))
    bl = bleu_from_sums([F.col(f"bleu_parts.m{n}") for n in range(1, 5)],
                        [F.col(f"bleu_parts.p{n}") for n in range(1, 5)],
                        F.col("bleu_parts.pred_len"), F.col("bleu_parts.ref_len"))
    def only(c):
        return F.when(has_ref, F.round(c, 9))
    return s.select("qid", F.md5("summary").alias("summary_md5"), F.md5("answer").alias("answer_md5"),
                    only(F.col("rouge1.fmeasure")).alias("rouge1"), only(F.col("rouge2.fmeasure")).alias("rouge2"),
                    only(F.col("rougeL.fmeasure")).alias("rougeL"), only(F.col("rougeLsum.fmeasure")).alias("rougeLsum"),
                    only(bl["bleu"]).alias("bleu"), *[only(bl["precisions"][i]).alias(f"precision_{i + 1}") for i in range(4)],
                    only(bl["brevity_penalty"]).alias("brevity_penalty"), only(bl["length_ratio"]).alias("length_ratio"),
                    F.when(has_ref, bl["translation_length"]).cast("long").alias("translation_length"),
                    F.when(has_ref, bl["reference_length"]).cast("long").alias("reference_length"))


def sql_q30_answer_scores():
    p1, _, f1 = prf_sql("o1.ov", "o1.np", "o1.nr")
    p2, _, f2 = prf_sql("o2.ov", "o2.np", "o2.nr")
    _, _, fl = rouge_l_prf("l")
    ctes, body = bleu_sums_sql("sp", "pp.pid")
    return f"""WITH RECURSIVE {_sql_answers()},
sp AS MATERIALIZED (SELECT qid AS pid, answer AS pred, reference AS ref FROM ans WHERE reference IS NOT NULL AND reference <> ''),
{overlap_ctes('o1', 'sp', S.rouge_tokens, 1)},
{overlap_ctes('o2', 'sp', S.rouge_tokens, 2)},
{lcs_ctes('l', 'sp', S.rouge_tokens)},
{lsum_ctes('sp')},
{ctes},
bl AS ({body}),
sc AS (SELECT o1.pid AS qid, round({f1}, 9) AS rouge1, round({f2}, 9) AS rouge2, round({fl}, 9) AS rougeL, round({lsum_prf()[2]}, 9) AS rougeLsum
  FROM o1 JOIN o2 ON o2.pid = o1.pid JOIN l ON l.pid = o1.pid JOIN lsum ON lsum.pid = o1.pid)
SELECT a.qid, md5(a.summary) AS summary_md5, md5(a.answer) AS answer_md5, sc.rouge1, sc.rouge2, sc.rougeL, sc.rougeLsum, bl.* EXCLUDE (pid)
FROM ans a LEFT JOIN sc ON sc.qid = a.qid LEFT JOIN bl ON bl.pid = a.qid"""


def q32_system_delta(spark, sf):
    """Every question with a reference under three systems -- without retrieval (the generator has
    the question alone), with the best passage, with the best four -- and what the context adds;
    ROUGE-1 F of each summary against the reference, pivoted per question.  A question without a
    hit has an empty context, so an empty summary."""
    pts = build_points(spark, documents(spark, sf), catalogue(spark, sf), budget=512, dim=DIM)
    q = questions(spark, sf).filter(F.col("reference").isNotNull() & (F.col("reference") != ""))
    hits = retrieve(pts, q, k=K, dim=DIM)
    systems = [(name, q.join(combine(hits.filter(F.col("rank") <= n)).select("qid", "context"), "qid", "left")) for name, n in (("k1", 1), ("k4", K))]
    systems.append(("base", q.withColumn("context", F.col("question"))))
    j = None
    for name, rows in systems:
        rows = rows.select("qid", F.lit(name).alias("system"), "reference", "question", F.coalesce("context", F.lit("")).alias("context"))
        j = rows if j is None else j.unionByName(rows)
    j = with_extractive_summary(j, "question", "context")
    s = score_pairs(j, "summary", "reference", metrics=("rouge1",))
    pv = s.groupBy("qid").pivot("system", ["base", "k1", "k4"]).agg(F.first("rouge1.fmeasure"))
    return pv.select("qid", *[F.round(c, 9).alias(f"rouge1_{c}") for c in ("base", "k1", "k4")],
                     F.round(F.col("k4") - F.col("base"), 9).alias("gain"), F.round(F.col("k4") - F.col("k1"), 9).alias("delta"))


def sql_q32_system_delta():
    qterms = f"list_distinct({S.rouge_tokens('question')})"
    scored = (f"list_transform({S.sentences('context')}, lambda s, i: "
              f"{{'neg': -len(list_intersect(list_distinct({S.rouge_tokens('s')}), qt)), 'pos': i, 's': s}})")
    summary = ("array_to_string(list_transform(list_sort(list_transform(list_slice(list_sort(sc), 1, 3), "
               "lambda x: {'pos': x.pos, 's': x.s})), lambda x: x.s), ' ')")
    p, _, f = prf_sql("o.ov", "o.np", "o.nr")
    sep = S.lit(chr(10) * 2)
    return f"""WITH RECURSIVE {S.points_ctes(512, DIM)},
{S.question_ctes()},
{S.topk_ctes(K, DIM, 'qs')},
ctx AS (
  SELECT qid, 'k1' AS system, string_agg(text, {sep} ORDER BY rank) AS context FROM hits WHERE rank <= 1 GROUP BY qid
  UNION ALL
  SELECT qid, 'k4', string_agg(text, {sep} ORDER BY rank) FROM hits GROUP BY qid
  UNION ALL
  SELECT qid, 'base', question FROM qs
),
g AS (SELECT q.qid, s.system, q.question, q.reference, coalesce(c.context, '') AS context, {qterms} AS qt
  FROM qs q CROSS JOIN (SELECT unnest(['base', 'k1', 'k4']) AS system) s LEFT JOIN ctx c ON c.qid = q.qid AND c.system = s.system
  WHERE q.reference IS NOT NULL AND q.reference <> ''),
g2 AS (SELECT *, {scored} AS sc FROM g),
sp AS MATERIALIZED (SELECT row_number() OVER (ORDER BY qid, system) AS pid, qid, system, {summary} AS pred,
  reference AS ref FROM g2),
{overlap_ctes('o', 'sp', S.rouge_tokens, 1)},
r AS (SELECT sp.qid, sp.system, {f} AS f FROM o JOIN sp ON sp.pid = o.pid)
SELECT qid, round(max(f) FILTER (WHERE system = 'base'), 9) AS rouge1_base,
  round(max(f) FILTER (WHERE system = 'k4') - max(f) FILTER (WHERE system = 'base'), 9) AS gain, round(max(f) FILTER (WHERE system = 'k1'), 9) AS rouge1_k1, round(max(f) FILTER (WHERE system = 'k4'), 9) AS rouge1_k4,
  round(max(f) FILTER (WHERE system = 'k4') - max(f) FILTER (WHERE system = 'k1'), 9) AS delta FROM r GROUP BY qid"""


HEAD_TOKENS = 150
MIN_TOKENS = 3


def q33_batch_generation(spark, sf):
    """B2 + R5: the user model runs in batches of 16; a failing row keeps "" and its error."""
    gen = batch_generator(partial(make_head_model, HEAD_TOKENS, MIN_TOKENS), batch_size=16, with_errors=True)
    d = documents(spark, sf).select("doc_id", gen(F.col("text")).alias("g"))
    return d.select("doc_id", F.md5("g.text").alias("out_md5"),
                    F.size(F.filter(F.split("g.text", " "), lambda s: F.length(s) > 0)).cast("long").alias("out_tokens"),
                    F.col("g.error").isNotNull().alias("failed"))


def sql_q33_batch_generation():
    out = (f"CASE WHEN len({S.ws_tokens('text')}) < {MIN_TOKENS} THEN '' "
           f"ELSE {S.truncate_tokens('text', HEAD_TOKENS)} END")
    return f"""SELECT doc_id, md5(o) AS out_md5, len(list_filter(string_split(o, ' '), lambda s: length(s) > 0))::BIGINT AS out_tokens,
  o = '' AS failed FROM (SELECT doc_id, {out} AS o FROM documents)"""


GENERATED_TOKENS = 150
GENERATED_MIN = 500


def q36_generated_answers(spark, sf):
    """C3 through B2: a user model writes the summary from the prompt, in batches; it fails on
    prompts of fewer than ``GENERATED_MIN`` tokens, which leaves an empty, enriched summary."""
    pts = build_points(spark, documents(spark, sf), catalogue(spark, sf), budget=512, dim=DIM)
    gen = batch_generator(partial(make_head_model, GENERATED_TOKENS, GENERATED_MIN), batch_size=16, with_errors=True)
    a = answer_questions(pts, questions(spark, sf), k=K, dim=DIM, generator=gen)
    return a.select("qid", F.md5("summary").alias("summary_md5"), F.md5("answer").alias("answer_md5"),
                    F.col("error").isNotNull().alias("failed"))


def sql_q36_generated_answers():
    short = f"len({S.ws_tokens('prompt')}) < {GENERATED_MIN}"
    out = f"CASE WHEN {short} THEN '' ELSE {S.truncate_tokens('prompt', GENERATED_TOKENS)} END"
    return f"""WITH RECURSIVE {_sql_answers()},
made AS (SELECT qid, context, {out} AS s, {short} AS failed FROM ans)
SELECT qid, md5(s) AS summary_md5, md5({S.enrich('s', 'context')}) AS answer_md5, failed FROM made"""


QUERIES = {
    "q36_generated_answers": (q36_generated_answers, sql_q36_generated_answers),
    "q29_context_prompt": (q29_context_prompt, sql_q29_context_prompt),
    "q30_answer_scores": (q30_answer_scores, sql_q30_answer_scores),
    "q32_system_delta": (q32_system_delta, sql_q32_system_delta),
    "q33_batch_generation": (q33_batch_generation, sql_q33_batch_generation),
}
