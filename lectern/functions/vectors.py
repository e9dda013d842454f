"""Vector expressions: hashed features, norms, normalisation, dot products."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.text import _col

# tokens fed to the hashing embedder: lower-cased runs of Unicode letters/digits
EMBED_TOKEN = r"[\p{L}\p{N}]+"


def embed_tokens(c) -> Column:
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(EMBED_TOKEN), 0)


def signed_bucket_ids(tokens, dim: int) -> Column:
    """Per token: sign * (bucket + 1) with bucket = md5[0:8] mod dim, sign from md5[8].

    Computed in the JVM; the Python side only has to bincount integers.
    """
    def one(h):
        bucket = F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), F.lit(dim)) + 1
        sign = F.when(F.substring(h, 9, 1) < F.lit("8"), F.lit(1)).otherwise(F.lit(-1))
        return (bucket * sign).cast("int")
    return F.transform(F.transform(_col(tokens), lambda t: F.md5(t)), one)


def sq_norm(v) -> Column:
    return F.aggregate(_col(v), F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double"))


def l2_norm(v) -> Column:
    return F.sqrt(sq_norm(v))


def l2_normalize(v) -> Column:
    """V2: unit vector; a zero vector has no direction and becomes null."""
    n = l2_norm(v)
    return F.when(n > 0, F.transform(_col(v), lambda x: x.cast("double") / n))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda s, x: s + x)


def cosine(a, b) -> Column:
    """V3: cosine similarity; null when either side has zero norm."""
    d = l2_norm(a) * l2_norm(b)
    return F.when(d > 0, dot(a, b) / d)
