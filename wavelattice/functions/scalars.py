"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def zero_guarded_ratio(num: Column, den: Column) -> Column:
    """``num / den`` where the denominator is positive, else 0."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def keyed_uniform(key: Column, seed) -> Column:
    """Uniform number in [0, 1) that depends only on the seed and the row key.

    The first 32 bits of an MD5 digest: the value survives repartitioning and task retries.
    """
    text = F.concat(F.lit(f"{seed}|"), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def keyed_digest(key: Column, seed) -> Column:
    """Full MD5 digest of seed and key, used as a reproducible shuffle order."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def stable_sigmoid(x: Column) -> Column:
    """Logistic function that exponentiates non-positive numbers only."""
    e = F.exp(-F.abs(x))
    return F.when(x >= 0, 1.0 / (1.0 + e)).otherwise(e / (1.0 + e))


def smoothed_label(y: Column) -> Column:
    """0/1 label softened to 0.025/0.975."""
    return y * F.lit(0.95) + F.lit(0.025)


def logit_loss(logit: Column, target: Column) -> Column:
    """Binary cross-entropy of a raw logit, safe for large absolute values."""
    return F.greatest(logit, F.lit(0.0)) - logit * target + F.log1p(F.exp(-F.abs(logit)))


def predicted_class(prob: Column, threshold: float = 0.5) -> Column:
    """1 when the probability reaches the threshold (inclusive)."""
    return (prob >= F.lit(threshold)).cast("int")


def rounded(c: Column, digits: int = 6) -> Column:
    """Rounded double without a negative zero."""
    return F.round(c, digits) + F.lit(0.0)
