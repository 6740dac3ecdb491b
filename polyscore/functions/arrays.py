"""Array helpers for parallel per-population arrays (higher-order functions, JVM side)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_set(arr) -> Column:
    """Canonical set form of an array: distinct, sorted."""
    return F.array_sort(F.array_distinct(_c(arr)))


def set_equals(arr, values: Iterable[str]) -> Column:
    """Unordered equality of an array with a literal set."""
    vals = sorted(set(values))
    return as_set(arr) == F.array(*[F.lit(v) for v in vals])


def index_of(arr, value) -> Column:
    """0-based index of value in arr, null if absent (array_position is 1-based, 0 if absent)."""
    pos = F.array_position(_c(arr), value)
    return F.when(pos > 0, pos - 1)


def kept_indices(arr, keep) -> Column:
    """Indices i of arr whose element satisfies keep(x) (zip-with-index + filter)."""
    tagged = F.transform(_c(arr), lambda x, i: F.named_struct(F.lit("x"), x, F.lit("i"), i))
    return F.transform(F.filter(tagged, lambda s: keep(s["x"])), lambda s: s["i"])


def take_indices(arr, indices) -> Column:
    """Elements of arr at the given 0-based indices (keeps parallel arrays aligned)."""
    return F.transform(_c(indices), lambda i: F.get(_c(arr), i))


def invalid_values(arr, allowed: Iterable[str]) -> Column:
    """Elements of arr that are not in the allowed list."""
    return F.array_except(_c(arr), F.array(*[F.lit(v) for v in allowed]))
