"""B2: batch text generation through a user-supplied model.

``predict_batch_udf`` builds the model once per Python worker and feeds it fixed-size
batches (16 by default, the evaluation batch).  When a batch raises, the batch is
retried row by row and only the rows that still fail yield ``""`` -- one bad input
never blanks its neighbours.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import types as T

from lectern.functions.text import NON_WS_RUN

GEN_BATCH = 16


GEN_RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("error", T.StringType())])


def _generate(model, inputs: np.ndarray):
    """(texts, errors): the batch at once; on failure row by row, a failing row -> ""."""
    try:
        out = list(model(inputs))
        if len(out) != len(inputs):
            raise ValueError("generator returned a different number of rows")
        return out, [None] * len(out)
    except Exception:
        texts, errors = [], []
        for x in inputs:
            try:
                texts.append(list(model(np.asarray([x], dtype=object)))[0])
                errors.append(None)
            except Exception as e:  # the row keeps an empty answer and the reason
                texts.append("")
                errors.append(f"{type(e).__name__}: {e}")
        return texts, errors


def batch_generator(make_model, batch_size: int = GEN_BATCH, with_errors: bool = False):
    """``make_model() -> callable(np.ndarray[str]) -> sequence[str]`` -> Column UDF.

    Returns the generated text, or ``struct(text, error)`` with ``with_errors``."""
    from pyspark.ml.functions import predict_batch_udf

    def make_predict_fn():
        model = make_model()

        def predict(inputs: np.ndarray):
            texts, errors = _generate(model, inputs)
            if with_errors:
                return {"text": np.asarray(texts, dtype=object), "error": np.asarray(errors, dtype=object)}
            return np.asarray(texts, dtype=object)
        return predict

    return predict_batch_udf(make_predict_fn, return_type=GEN_RESULT if with_errors else T.StringType(),
                             batch_size=batch_size)


# --- a dependency-free stand-in model (used where no real model is installed) -------

_TOKEN = re.compile(NON_WS_RUN)


def make_head_model(max_tokens: int = 150, min_tokens: int = 3):
    """Returns the first ``max_tokens`` whitespace tokens of each input; raises on an
    input with fewer than ``min_tokens`` tokens (to exercise the failure path)."""
    def model(texts):
        out = []
        for t in texts:
            toks = _TOKEN.findall(t or "")
            if len(toks) < min_tokens:
                raise ValueError("input too short to summarise")
            out.append(" ".join(toks[:max_tokens]))
        return out
    return model
