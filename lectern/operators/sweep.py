"""Parameter trials, evaluation of every trial in one job, best trial.

Trials are rows, not a loop over a shared model: each trial's parameters are joined
to the evaluation rows on the parameter they change (an equi-join), scored, and
aggregated per trial.  Random draws are md5-seeded uniforms, so the same trial table
comes out of any engine.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: the search space of the reference sweep ---------------------------
N_TRIALS = 10
LR_LOW, LR_HIGH = 1e-5, 5e-5          # log-uniform
BATCH_SIZES = [2, 4, 8, 16]            # categorical
EPOCHS = [3, 5, 7]                     # categorical
# -------------------------------------------------------------------------------------
SEED = "trial"


def uniform(trial_id: Column, tag: str, seed: str = SEED) -> Column:
    """u in [0, 1) from md5('<seed>:<tag>:<trial_id>')."""
    h = F.md5(F.concat(F.lit(f"{seed}:{tag}:"), trial_id.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def categorical(u: Column, choices: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (F.floor(u * len(choices)) + 1).cast("int"))


def trial_table(spark: SparkSession, n_trials: int = N_TRIALS) -> DataFrame:
    """(trial_id, learning_rate, batch_size, num_train_epochs)."""
    t = spark.range(n_trials).select(F.col("id").cast("int").alias("trial_id"))
    lo, hi = math.log(LR_LOW), math.log(LR_HIGH)
    return t.select(
        "trial_id",
        F.exp(F.lit(lo) + uniform(F.col("trial_id"), "lr") * F.lit(hi - lo)).alias("learning_rate"),
        categorical(uniform(F.col("trial_id"), "batch"), BATCH_SIZES).alias("batch_size"),
        categorical(uniform(F.col("trial_id"), "epochs"), EPOCHS).alias("num_train_epochs"))


def log_position(rate: Column, low: float = LR_LOW, high: float = LR_HIGH) -> Column:
    """Where a log-uniform parameter lies in its range, from 0 to 1."""
    return (F.log(rate) - F.lit(math.log(low))) / F.lit(math.log(high) - math.log(low))


def best_trial(scored: DataFrame, loss_col: str = "loss", digits: int = 9) -> DataFrame:
    """Flags the trial of minimum loss (ties: lower trial_id) via a global min_by.

    The loss is compared at ``digits`` decimals: a mean's last bits depend on the order
    partial sums are combined in, so equal losses must not be split by that noise."""
    key = F.struct(F.round(F.col(loss_col), digits).alias("l"), F.col("trial_id"))
    best = scored.agg(F.min_by("trial_id", key).alias("trial_id"))
    return scored.join(best.withColumn("is_best", F.lit(True)), "trial_id", "left") \
        .withColumn("is_best", F.coalesce("is_best", F.lit(False)))
