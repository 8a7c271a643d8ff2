"""Dense-vector expressions over ``array<double>`` columns."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from sonora.functions.text import col_


def as_doubles(v: Column | str) -> Column:
    return col_(v).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product of two columns of doubles."""
    prods = F.zip_with(col_(a), col_(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Unrounded cosine similarity; 0.0 when either vector has zero norm."""
    a, b = as_doubles(a), as_doubles(b)
    norms = norm(a) * norm(b)
    return F.when(norms > 0, dot(a, b) / norms).otherwise(F.lit(0.0))


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity rounded to 4 decimals."""
    return F.round(cosine(a, b), 4)


def percent_of_rounded(cos4: Column) -> Column:
    """``round(round(cos, 4) * 100, 1)`` in exact integer steps.

    The 4-decimal cosine is first made an integer count of 1e-4 units, then
    rounded half away from zero to a count of 1e-1 percent units, so every
    engine agrees on the tie cases.
    """
    n = F.round(cos4 * 10000).cast("bigint")
    tenths = F.signum(n) * F.floor((F.abs(n) + 5) / 10)
    return (tenths / 10.0).cast("double")


def percent(cos: Column) -> Column:
    """``round(cos * 100, 1)`` of the unrounded cosine."""
    return F.round(cos * 100.0, 1)
