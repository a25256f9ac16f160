"""Name similarity as a Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence: one array fold per string.

    Quadratic in the name length, meant for distinct field names only.
    """
    left = F.filter(F.split(a, ""), lambda ch: ch != "")
    right = F.filter(F.split(b, ""), lambda ch: ch != "")

    def next_row(row: Column, ch: Column) -> Column:
        def next_cell(cells: Column, other: Column, j: Column) -> Column:
            diagonal = F.element_at(row, j) + F.when(ch == other, 1).otherwise(0)
            best = F.greatest(diagonal, F.element_at(row, j + 1), F.element_at(cells, -1))
            return F.concat(cells, F.array(best))

        positions = F.transform(right, lambda other, i: F.struct(other.alias("ch"), (i + 1).alias("j")))
        return F.aggregate(
            positions,
            F.array(F.lit(0)),
            lambda cells, at: next_cell(cells, at["ch"], at["j"]),
        )

    start = F.array_repeat(F.lit(0), F.size(right) + 1)
    return F.element_at(F.aggregate(left, start, next_row), -1)


def name_ratio(a: Column, b: Column) -> Column:
    """Normalised insert/delete similarity, 0..100: ``200 * LCS / (len(a) + len(b))``."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * lcs_length(a, b) / total)


def ratio_bound(a: Column, b: Column) -> Column:
    """Upper bound of ``name_ratio`` from the lengths alone; prunes pairs before the fold."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(
        F.lit(200.0) * F.least(F.length(a), F.length(b)) / total
    )
