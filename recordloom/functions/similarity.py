"""Similarities of strings and token arrays as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _double(c: Column) -> Column:
    return c.cast("double")


def jaccard(a: Column, b: Column) -> Column:
    """Of token sets; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def containment(a: Column, b: Column) -> Column:
    """Shared tokens over those of the smaller set."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(overlap(a, b) / F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b))))


def _both(a: Column, b: Column, then: Column) -> Column:
    """1 for two empty strings, 0 for one."""
    return F.when((a == "") & (b == ""), F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(then)


def edit_distance(a: Column, b: Column, most: int | None = None) -> Column:
    """Levenshtein distance; beyond `most` it is most + 1."""
    if most is None:
        return F.levenshtein(a, b)
    d = F.levenshtein(a, b, most)
    return F.when(d < 0, F.lit(most + 1)).otherwise(d)


def edit_similarity(a: Column, b: Column) -> Column:
    return _both(a, b, 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def length_ratio(a: Column, b: Column) -> Column:
    return _both(a, b, F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b)))


def digits_only(tokens: Column) -> Column:
    return F.filter(tokens, lambda x: x.rlike("^[0-9]+$"))


def numeric_overlap(a: Column, b: Column) -> Column:
    return jaccard(digits_only(a), digits_only(b))


def numeric_contradiction(a: Column, b: Column, a_postal: Column, b_postal: Column) -> Column:
    """Both have numbers, and those that aren't the postal code (all, if one side has no others) are disjoint."""
    x = F.filter(a, lambda t: ~t.eqNullSafe(a_postal))
    y = F.filter(b, lambda t: ~t.eqNullSafe(b_postal))
    disjoint = F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) == 0).otherwise(F.size(F.array_intersect(a, b)) == 0)
    return (F.size(a) > 0) & (F.size(b) > 0) & disjoint


def near_numbers(a: Column, b: Column) -> Column:
    """Whether a number of a and one of b, both of two digits and more, differ by one cut-off last digit at most."""
    def cut(x: Column, y: Column) -> Column:
        return (F.length(x) >= 2) & (F.length(y) >= 2) & (x.startswith(y) | y.startswith(x)) & (F.abs(F.length(x) - F.length(y)) <= 1)

    return F.exists(a, lambda x: F.exists(b, lambda y: cut(x, y)))


def sigmoid(z: Column) -> Column:
    return F.when(z >= 0, 1 / (1 + F.exp(-z))).otherwise(F.exp(z) / (1 + F.exp(z)))
