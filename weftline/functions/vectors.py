"""Vector arithmetic on array columns, computed in double precision."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times.

    Spark repeats an expression wherever a lambda mentions it; a lambda variable is read
    from memory instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_double(v: Column | str) -> Column:
    return F.col(v).cast("array<double>") if isinstance(v, str) else v.cast("array<double>")


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    """Sum of products over the shorter of the two lengths."""
    return total(F.zip_with(as_double(a), as_double(b), lambda x, y: F.coalesce(x * y, F.lit(0.0))))


def norm(v) -> Column:
    return F.sqrt(total(F.transform(as_double(v), lambda x: x * x)))


def cosine(a, b) -> Column:
    """Cosine similarity; 0 when either side has no length."""
    return F.coalesce(dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0)), F.lit(0.0))


def cosine_distance(a, b) -> Column:
    return F.lit(1.0) - cosine(a, b)


def squared_l2(a, b) -> Column:
    return total(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)))


def l2(a, b) -> Column:
    return F.sqrt(squared_l2(a, b))


def unit(v, floor: float = 1e-9) -> Column:
    """L2-normalised vector; the norm is never taken below ``floor``."""
    return let(as_double(v), lambda a: let(
        F.greatest(norm(a), F.lit(floor)), lambda length: F.transform(a, lambda x: x / length)))


def softmax(logits) -> Column:
    shifted = let(as_double(logits), lambda v: let(
        F.array_max(v), lambda top: F.transform(v, lambda x: F.exp(x - top))))
    return let(shifted, lambda e: let(total(e), lambda s: F.transform(e, lambda x: x / s)))


def argmax(v) -> Column:
    """0-based place of the first largest value."""
    return let(as_double(v), lambda a: (F.array_position(a, F.array_max(a)) - 1).cast("bigint"))
