"""V1/V2: text -> fixed-length vector.

Default encoder: signed feature hashing.  An ``arrow_udf`` takes each row's tokens, hashes (md5)
every different token of a batch once and makes dense vectors of the batch with one
``numpy.bincount``.  No shuffle, no Python per token of a text.

A user model plugs in through ``model_encoder`` (``predict_batch_udf``), which loads
the model once per Python worker and feeds it fixed-size batches.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.text import _col
from lectern.functions.vectors import embed_tokens, signed_bucket_ids

DEFAULT_DIM = 384


@lru_cache(maxsize=1 << 16)
def _signed_bucket(token: str, dim: int) -> int:
    """As ``signed_bucket_ids``, of one token."""
    h = md5(token.encode()).digest()
    bucket = int.from_bytes(h[:4], "big") % dim + 1
    return bucket if h[4] < 128 else -bucket


def _signed_counts(tokens: pa.ListArray, dim: int) -> np.ndarray:
    """Rows of tokens -> (rows, dim) signed counts with one bincount; a token is hashed once a batch."""
    n = len(tokens)
    words = tokens.flatten().dictionary_encode()
    if not len(words):
        return np.zeros((n, dim), dtype=np.float64)
    lens = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ids = np.fromiter((_signed_bucket(w, dim) for w in words.dictionary.to_pylist()), dtype=np.int64, count=len(words.dictionary))
    flat = ids[words.indices.to_numpy()]
    cell = np.repeat(np.arange(n, dtype=np.int64) * dim, lens) + (np.abs(flat) - 1)
    return np.bincount(cell, weights=np.sign(flat).astype(np.float64), minlength=n * dim).reshape(n, dim)


def _rows(values: np.ndarray, missing: np.ndarray | None = None) -> pa.ListArray:
    n, dim = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * dim), pa.array(values.reshape(-1)),
                                    mask=None if missing is None else pa.array(missing))


# The two functions are deterministic, but declaring them otherwise keeps Catalyst from
# copying them into pushed-down or inferred predicates (e.g. ``vector IS NOT NULL``
# below a repartition or join), which would evaluate the UDF twice.

def _counts_udf(dim: int):
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def signed_bincount(tokens: pa.Array) -> pa.Array:
        return _rows(_signed_counts(tokens, dim))
    return signed_bincount.asNondeterministic()


def _unit_udf(dim: int):
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def unit_bincount(tokens: pa.Array, spare: pa.Array) -> pa.Array:
        out = _signed_counts(tokens, dim)
        norm = np.sqrt((out * out).sum(axis=1))
        lost = np.flatnonzero((norm == 0) & spare.is_valid().to_numpy(zero_copy_only=False))
        one = spare.take(pa.array(lost)).to_numpy(zero_copy_only=False).astype(np.int64)
        out[lost, np.abs(one) - 1] = np.sign(one)
        norm[lost] = 1.0
        missing = norm == 0
        return _rows(out / np.where(missing, 1.0, norm)[:, None], missing)
    return unit_bincount.asNondeterministic()


def hash_counts(text, dim: int = DEFAULT_DIM) -> Column:
    """Dense signed bucket counts (ARRAY<DOUBLE>, integer valued)."""
    return _counts_udf(dim)(embed_tokens(_col(text)))


def hash_embed(text, dim: int = DEFAULT_DIM) -> Column:
    """Unit vector (ARRAY<DOUBLE>); null for a null or empty text.

    Where the signed counts cancel or there is no letter/digit token, the text as a whole
    counts as one token, so every other text has a direction.

    Normalised inside the same Arrow batch (sum of squares of integers is exact,
    sqrt and division are correctly rounded, so any engine agrees bit for bit)."""
    whole = F.when(F.length(_col(text)) > 0, F.get(signed_bucket_ids(F.array(_col(text)), dim), F.lit(0)))
    return _unit_udf(dim)(embed_tokens(_col(text)), whole)


def model_encoder(make_encode_fn, dim: int, batch_size: int = 64):
    """Wrap a user encoder factory ``() -> (np.ndarray[str] -> np.ndarray[n, dim])``."""
    from pyspark.ml.functions import predict_batch_udf
    return predict_batch_udf(make_encode_fn, return_type=T.ArrayType(T.FloatType()),
                             batch_size=batch_size, input_tensor_shapes=None)
