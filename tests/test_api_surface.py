"""API surface without a registered query: K5 JSON sink, B1 batched map, user encoder,
batch-longest padding."""

import json

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lectern.operators.embedding import model_encoder
from lectern.operators.metrics import leaderboard, metrics_json
from lectern.operators.training import EOS, PAD, pad_to_batch_longest, token_ids, tokenize_batches


def test_metrics_json_sink(spark, tmp_dir):
    pred = spark.createDataFrame([("m1", "a b c d", "a b c d"), ("m2", "x y", "a b c d")],
                                 "model string, prediction string, reference string")
    lb = leaderboard(pred).select("model", "rouge1", "rouge2", "rougeL", F.col("bleu.bleu").alias("bleu"))
    out = metrics_json(lb, "model", ["rouge1", "rouge2", "rougeL", "bleu"])
    out.write.json(f"{tmp_dir}/metrics")
    got = {r.model: json.loads(r.metrics_json) for r in spark.read.json(f"{tmp_dir}/metrics").collect()}
    assert got["m1"]["rouge1"] == 1.0 and got["m2"]["rouge1"] == 0.0 and abs(got["m1"]["bleu"] - 1.0) < 1e-12


def test_tokenize_batches_user_function(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c d e")], "id int, text string")

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": pdf["id"], "n": pdf["text"].str.split().str.len()})
    got = {r.id: r.n for r in tokenize_batches(df, fn, "id int, n long").collect()}
    assert got == {1: 2, 2: 3}


def test_user_encoder_through_predict_batch(spark):
    def make():
        def encode(texts: np.ndarray) -> np.ndarray:
            return np.stack([np.array([len(t), 1.0], dtype=np.float32) for t in texts])
        return encode
    enc = model_encoder(make, dim=2, batch_size=2)
    df = spark.createDataFrame([("ab",), ("abcd",), ("",)], "t string")
    got = sorted(tuple(r.v) for r in df.select(enc("t").alias("v")).collect())
    assert got == [(0.0, 1.0), (2.0, 1.0), (4.0, 1.0)]


def test_pad_to_batch_longest(spark):
    df = spark.createDataFrame([(0, "a b c"), (0, "a"), (1, "a b c d e")], "batch int, text string")
    out = pad_to_batch_longest(df.withColumn("ids", token_ids("text")), "ids", "batch", max_len=5)
    rows = {(r.batch, r.text): (r.input_ids, r.attention_mask) for r in out.collect()}
    ids, mask = rows[(0, "a")]
    assert len(ids) == 4 and ids[1] == EOS and ids[2:] == [PAD, PAD] and mask == [1, 1, 0, 0]
    ids, mask = rows[(1, "a b c d e")]
    assert len(ids) == 5 and ids[-1] == EOS and mask == [1] * 5


def test_best_trial_ignores_last_bit_noise(spark):
    from lectern.operators.sweep import best_trial
    scored = spark.createDataFrame([(7, 0.1 + 0.2), (4, 0.3), (9, 0.5)], "trial_id int, loss double")
    best = [r.trial_id for r in best_trial(scored).filter("is_best").collect()]
    assert best == [4]  # 0.30000000000000004 and 0.3 tie; the lower trial id wins
