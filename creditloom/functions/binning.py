"""Bin conventions. Each helper names its closed side; Bucketizer and
width_bucket follow neither of them, so they are not used."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut_right(c: Column, edges: Sequence[float], labels: Sequence | None = None,
              include_lowest: bool = False) -> Column:
    """Bins (a, b]; values outside give NULL."""
    labels = list(range(len(edges) - 1)) if labels is None else labels
    low = (c >= edges[0]) if include_lowest else (c > edges[0])
    expr = F.when(low & (c <= edges[1]), F.lit(labels[0]))
    for hi, label in zip(edges[2:], labels[1:]):
        expr = expr.when((c > edges[0]) & (c <= hi), F.lit(label))
    return expr


def steps_at_or_below(c: Column, boundaries: Sequence[float]) -> Column:
    """How many boundaries are <= c: left-closed bin index, a value on a boundary moves up."""
    total = F.lit(0)
    for b in boundaries:
        total = total + F.when(c >= float(b), 1).otherwise(0)
    return total


def steps_below(c: Column, edges: Column, n: int) -> Column:
    """Right-closed bin index for up to n edges held in an array column.

    Missing array slots are NULL and never count."""
    total = F.lit(0)
    for i in range(n):
        total = total + F.when(c > F.get(edges, F.lit(i)), 1).otherwise(0)
    return total


def slice_index(c: Column, bounds: Column, n: int, strict: bool = False) -> Column:
    """How many of up to n sorted array bounds are <= c (< c if strict), by binary search; deterministic, so two passes agree."""
    steps = [1 << k for k in reversed(range(max(n, 1).bit_length()))]
    passed = (lambda b: c > b) if strict else (lambda b: c >= b)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(passed(F.get(bounds, at + step - 1)), at + step).otherwise(at))


def quantile_bin(c: Column, edges: Column, n_quantiles: int, open_ends: bool = False) -> Column:
    """Quantile bin against distinct sorted edges e0<e1<..: lowest edge included,
    bins (a, b]. With open_ends the outer edges are infinite, else outside is NULL."""
    inner = F.slice(edges, 2, F.greatest(F.size(edges) - 2, F.lit(0)))
    idx = steps_below(c, inner, n_quantiles - 1)
    if open_ends:
        return F.when(c.isNotNull(), idx)
    return F.when((c >= F.element_at(edges, 1)) & (c <= F.element_at(edges, -1)), idx)


def equal_width_bin(c: Column, low: Column, high: Column, n: int) -> Column:
    """Equal-width histogram bin: [a, b), the last bin closed on both sides, outside NULL."""
    idx = F.lit(0)
    for i in range(1, n):
        idx = idx + F.when(c >= low + (high - low) * (i / n), 1).otherwise(0)
    return F.when((c >= low) & (c <= high), idx)


def boundary_score(c: Column, boundaries: Sequence[float], lower_is_riskier: bool, if_missing: int) -> Column:
    """1..k risk score against boundaries (value on a boundary counts as reached)."""
    reached = steps_at_or_below(c, boundaries)
    score = (F.lit(len(boundaries) + 1) - reached) if lower_is_riskier else reached + 1
    return F.when(c.isNull(), F.lit(if_missing)).otherwise(score)


def lerp(c: Column, xs: Sequence[float], ys: Sequence[float]) -> Column:
    """Piecewise-linear function through (xs, ys), constant outside."""
    expr = F.when(c <= xs[0], F.lit(float(ys[0])))
    for x0, x1, y0, y1 in zip(xs, xs[1:], ys, ys[1:]):
        expr = expr.when(c <= x1, F.lit(float(y0)) + (c - x0) * ((y1 - y0) / (x1 - x0)))
    return F.when(c.isNotNull(), expr.otherwise(F.lit(float(ys[-1]))))
