"""Similarities of two values; null wherever either side is empty, so missing is never zero."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _both(a: Column, b: Column, value: Column) -> Column:
    return F.when((F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != ""), value)


def exact(a: Column, b: Column) -> Column:
    return _both(a, b, (a == b).cast("double"))


def edit_distance(a: Column, b: Column) -> Column:
    return _both(a, b, F.levenshtein(a, b).cast("double"))


def edit_ratio(a: Column, b: Column) -> Column:
    return _both(a, b, 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def length_ratio(a: Column, b: Column) -> Column:
    return _both(a, b, F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b)))


def set_jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct values."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def dot(a: Column, b: Column) -> Column:
    """Inner product of two dense arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit_vector(v: Column) -> Column:
    """v at length 1. Vector and norm are bound once: inside a lambda Spark would take both anew for each entry."""
    norm = lambda w: F.greatest(F.sqrt(dot(w, w)), F.lit(1e-12))
    over = lambda w: F.element_at(F.transform(F.array(norm(w)), lambda n: F.transform(w, lambda x: x.cast("double") / n)), 1)
    return F.element_at(F.transform(F.array(v), over), 1)


def sparse_cosine(a: Column, b: Column) -> Column:
    """Of two unit vectors given as maps; null where either is empty, else in [0, 1]."""
    products = F.transform(F.map_entries(a), lambda e: e["value"] * F.coalesce(F.try_element_at(b, e["key"]), F.lit(0.0)))
    total = F.aggregate(products, F.lit(0.0), lambda s, x: s + x)
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)))


def _subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence; a row of the table is one number of len(a) bits."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _sorted_ratio(a: str, b: str) -> float | None:
    if not a or not b:
        return None
    x, y = (" ".join(sorted(t.split())) for t in (a, b))
    return 2 * _subsequence(x, y) / (len(x) + len(y)) if x or y else 1.0


def _jaro_winkler(a: str, b: str) -> float | None:
    if not a or not b:
        return None
    reach = max(len(a), len(b)) // 2 - 1
    taken, of_a = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                of_a.append(c)
                break
    m = len(of_a)
    if not m:
        return 0.0
    of_b = [c for c, t in zip(b, taken, strict=True) if t]
    swapped = sum(x != y for x, y in zip(of_a, of_b, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro) if jaro > 0.7 else jaro


def _by_pair(a: pd.Series, b: pd.Series, ratio) -> pd.Series:  # noqa: ANN001
    return pd.Series([ratio(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the common subsequence of the sorted words over both lengths."""
    return _by_pair(a, b, _sorted_ratio)


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return _by_pair(a, b, _jaro_winkler)


@F.pandas_udf(T.DoubleType())
def block_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching blocks found longest first, over both lengths."""
    return _by_pair(a, b, lambda x, y: difflib.SequenceMatcher(None, x, y, autojunk=False).ratio() if x and y else None)


def f_half(true_positives: Column, predicted: Column, truth: Column) -> Column:
    """F0.5 from counts; 1 where nothing is true and nothing predicted."""
    below = 4 * predicted + truth
    # 5tp + 4fp + fn = 4(tp + fp) + (tp + fn)
    return F.when((predicted == 0) & (truth == 0), 1.0).when(below == 0, 0.0).otherwise(5.0 * true_positives / below)
