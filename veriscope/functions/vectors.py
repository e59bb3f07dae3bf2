"""Vector functions: hash embedding (U4 stand-in), similarity (F8), formatting."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriscope.constants import HASH_DIM
from veriscope.functions.text import _c, words


def hash_buckets(text, dim: int = HASH_DIM) -> Column:
    """Bucket of every word: first 32 bits of md5(word) modulo ``dim`` (JVM side)."""
    return F.transform(words(text), lambda w: F.pmod(
        F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long"), F.lit(dim)).cast("int"))


def _bincount_udf(dim: int):
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def bincount(buckets: pd.Series) -> pd.Series:
        # One vectorised bincount over the whole Arrow batch.
        n = len(buckets)
        lens = np.fromiter((0 if b is None else len(b) for b in buckets), dtype=np.int64, count=n)
        out = np.zeros(n * dim, dtype=np.float32)
        if lens.sum():
            flat = np.concatenate([np.asarray(b, dtype=np.int64) for b in buckets if b is not None and len(b)])
            rows = np.repeat(np.arange(n, dtype=np.int64), lens)
            out += np.bincount(rows * dim + flat, minlength=n * dim).astype(np.float32)
        out = out.reshape(n, dim)
        return pd.Series(list(out))
    return bincount


_BINCOUNT = {}


def bucket_counts(buckets, dim: int = HASH_DIM) -> Column:
    if dim not in _BINCOUNT:
        _BINCOUNT[dim] = _bincount_udf(dim)
    return _BINCOUNT[dim](_c(buckets))


def hash_embedding(text, dim: int = HASH_DIM) -> Column:
    """Deterministic bag-of-hashed-words vector (counts per md5 bucket)."""
    return bucket_counts(hash_buckets(text, dim), dim)


def dot_expr(a, b) -> Column:
    """Dot product in double (expression form, for small inputs and single queries)."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def norm_expr(a) -> Column:
    return F.sqrt(dot_expr(a, a))


def cosine_expr(a, b) -> Column:
    """Cosine similarity dot / sqrt(|a|^2 |b|^2); 0 when either norm is zero."""
    den = dot_expr(a, a) * dot_expr(b, b)
    return F.when(den > 0, dot_expr(a, b) / F.sqrt(den)).otherwise(F.lit(0.0))


def format_similarity(score) -> Column:
    """similarity to 3 decimals, ties to even, without thousands separators."""
    return F.translate(F.format_number(_c(score), 3), ",", "")


def format_prob(prob) -> Column:
    """probability to 2 decimals, ties to even."""
    return F.translate(F.format_number(_c(prob), 2), ",", "")
