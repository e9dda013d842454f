"""All registered queries: name -> (spark_fn(spark, sf_dir) -> DataFrame, sql_fn() | None)."""

from __future__ import annotations

import importlib

MODULES = ["q_sources", "q_text", "q_vectors", "q_store", "q_metrics", "q_answers", "q_training", "q_sweep", "q_streams"]


def registry() -> dict:
    out = {}
    for m in MODULES:
        out.update(importlib.import_module(f"lectern.plans.{m}").QUERIES)
    return dict(sorted(out.items()))
