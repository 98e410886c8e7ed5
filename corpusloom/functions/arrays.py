"""Array expressions shared by the operators. No shuffles, no Python workers.

Lengths are taken with ``array_size`` throughout: ``size`` of null is -1 outside ANSI mode.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    The optimizer merges projections, and an expression merged into a lambda would run
    again for every element. Bound to a lambda variable it cannot be merged.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def literal_array(values: list, element_type: str) -> Column:
    """A driver-side list as one constant array.

    ``from_json`` over a literal is folded by the optimizer, so the plan holds a
    single literal instead of one expression per element.
    """
    return F.from_json(F.lit(json.dumps(values)), f"array<{element_type}>")


def count_not_above(sorted_values: Column, length: int, key: Column) -> Column:
    """How many entries of a sorted array are <= ``key``: a binary search of
    ceil(log2(length + 1)) steps."""
    steps = [1 << b for b in reversed(range(length.bit_length()))]
    if not steps:
        return F.lit(0)
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda pos, step: F.when(
            F.get(sorted_values, pos + step - 1) <= key, pos + step
        ).otherwise(pos),
    )


def explode_elements(column: Column | str, pos: str, element: str) -> Column:
    """``posexplode`` of a computed array, without its empty-array filter.

    For ``explode`` the optimizer adds a size check below the projection that made the
    array, which computes it a second time; the outer form has no such check. Rows of
    empty arrays come out with a null ``pos`` and have to be dropped by it.
    """
    return F.posexplode_outer(column).alias(pos, element)
