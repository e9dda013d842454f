"""Questions -> retrieved context -> prompt -> generated summary -> answer -> scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.ngrams import rouge_tokens
from lectern.functions.text import (PASSAGE_SEPARATOR, _col, enrich, prompt, sentences,
                                    truncate_tokens)
from lectern.operators.embedding import DEFAULT_DIM, hash_embed
from lectern.operators.joins import MAX_BROADCAST_ROWS
from lectern.operators.search import top_k

PROMPT_TOKENS = 512
SUMMARY_SENTENCES = 3
# size bound for broadcasting the per-question context table (questions x k passages)
PASSAGE_BYTES = 8 * 512
MAX_CONTEXT_BROADCAST_BYTES = 256 << 20


def retrieve(points: DataFrame, questions: DataFrame, k: int = 4, dim: int = DEFAULT_DIM,
             group_col: str | None = None, groups: list[int] | None = None, encoder=None) -> DataFrame:
    """R2 + P2: top-k passages per question -> (qid, rank, id, score, text).

    With ``group_col`` the points hold several collections (e.g. one per chunk budget,
    values ``groups``); every question is searched in each of them and rows carry the
    group."""
    vec = encoder(F.col("question")) if encoder else hash_embed(F.col("question"), dim)
    q = questions.select("qid", vec.alias("qvec"))
    keys = ["id"]
    if group_col:
        # one question row per collection (a parameter list, not data)
        q = q.withColumn(group_col, F.explode(F.array(*[F.lit(g) for g in groups])))
        keys = [group_col, "id"]
    hits = top_k(points, q, k=k, group_col=group_col, dim_hint=dim)
    payload = points.select(*keys, F.coalesce(F.col("payload.text"), F.lit("")).alias("text"))
    # hits hold k rows per question (and group): broadcast only under a counted bound,
    # otherwise a shuffle join (the payload side is then shuffled by id once)
    n_hits = questions.count() * k * (len(groups) if group_col else 1)
    if n_hits <= MAX_BROADCAST_ROWS:
        hits = F.broadcast(hits)
    return payload.join(hits, keys, "inner")


def combine(hits: DataFrame) -> DataFrame:
    """A2: passages joined by a blank line in rank order -> (qid, n_passages, context).

    Each group holds at most k rows (top-k), so collecting the group is bounded.
    """
    ordered = F.array_sort(F.collect_list(F.struct("rank", "text")))
    return hits.groupBy("qid").agg(
        F.count("*").cast("int").alias("n_passages"),
        F.array_join(F.transform(ordered, lambda x: x["text"]), PASSAGE_SEPARATOR).alias("context"))


def with_extractive_summary(df: DataFrame, question: str, context: str, out: str = "summary",
                            n: int = SUMMARY_SENTENCES, min_overlap: str | None = None) -> DataFrame:
    """Built-in generator -- the n context sentences sharing most distinct question
    terms (ties: earlier first), output in source order; with ``min_overlap`` (a column) only those
    that share as many terms.  Native and in-row; question
    terms and sentences are projected once before the per-sentence lambda reads them."""
    keep = df.columns
    d = df.select("*", F.array_distinct(rouge_tokens(F.col(question))).alias("_qt"),
                  sentences(F.col(context)).alias("_sents"))
    scored = F.transform("_sents", lambda s, i: F.struct(
        (-F.size(F.array_intersect(F.array_distinct(rouge_tokens(s)), F.col("_qt")))).alias("neg"),
        i.alias("pos"), s.alias("s")))
    if min_overlap:
        scored = F.filter(scored, lambda x: -x["neg"] >= F.col(min_overlap))
    top = F.slice(F.array_sort(scored), 1, n)
    ordered = F.array_sort(F.transform(top, lambda x: F.struct(x["pos"].alias("pos"), x["s"].alias("s"))))
    return d.select(*keep, F.array_join(F.transform(ordered, lambda x: x["s"]), " ").alias(out))


def answer_questions(points: DataFrame, questions: DataFrame, k: int = 4, dim: int = DEFAULT_DIM,
                     n_sentences: int = SUMMARY_SENTENCES, encoder=None, generator=None) -> DataFrame:
    """(qid, question, reference, n_passages, context, prompt, summary, answer).

    Questions without any hit keep an empty context (left join).  ``generator`` maps the prompt
    column to a (text, error) struct, as ``batch_generator(..., with_errors=True)`` does: a row
    that fails has an empty summary, is enriched all the same, and shows its ``error``.  Without
    one the built-in extractive generator writes the summary."""
    ctx = combine(retrieve(points, questions, k, dim, encoder=encoder))
    # the context table holds one row per question (k passages): when that is provably
    # small it is broadcast, so answers keep the question scan's partitioning (no
    # shuffle of the question side, no small-shuffle coalescing into a few tasks)
    if questions.count() * k * PASSAGE_BYTES <= MAX_CONTEXT_BROADCAST_BYTES:
        ctx = F.broadcast(ctx)
    j = questions.join(ctx, "qid", "left").select(
        "qid", "question", "reference", F.coalesce("n_passages", F.lit(0)).alias("n_passages"),
        F.coalesce("context", F.lit("")).alias("context"))
    j = j.withColumn("prompt", truncate_tokens(prompt(F.col("question"), F.col("context")), PROMPT_TOKENS))
    if generator:
        j = j.withColumn("_g", generator(F.col("prompt"))).select(
            "*", F.coalesce("_g.text", F.lit("")).alias("summary"), F.col("_g.error").alias("error")).drop("_g")
    else:
        j = with_extractive_summary(j, "question", "context", "summary", n_sentences)
    return j.withColumn("answer", enrich(F.col("summary"), F.col("context")))
