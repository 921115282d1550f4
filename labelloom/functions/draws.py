"""Seeded draws: a uniform number that depends only on (seed, row key, decision name).

No draw depends on row order, partitioning or retries, so a lost executor
recomputes exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RANGE = 4294967296.0


def _text(value) -> Column:
    return value.cast("string") if isinstance(value, Column) else F.lit(str(value))


def draw(seed, key: Column, name) -> Column:
    """BIGINT, uniform on [0, 2**32)."""
    digest = F.md5(F.concat_ws("|", _text(seed), _text(key), _text(name)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def unit(seed, key: Column, name) -> Column:
    """DOUBLE, uniform on [0, 1)."""
    return draw(seed, key, name).cast("double") / F.lit(RANGE)


def pick_index(number: Column, n) -> Column:
    """0-based uniform position among ``n``; NULL when there is nothing to pick from."""
    n = n if isinstance(n, Column) else F.lit(n)
    return (number % F.nullif(n.cast("bigint"), F.lit(0).cast("bigint"))).cast("int")


def pick(values: Column, number: Column) -> Column:
    """Uniform element of an array; NULL for an empty or missing array."""
    return F.get(values, pick_index(number, F.size(values)))


def pick_literal(values: list[str], number: Column) -> Column:
    """Uniform element of a short fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), pick_index(number, len(values)) + 1)


def cumulative(weights: list[float]) -> list[float]:
    out, total = [], 0.0
    for w in weights:
        total += w
        out.append(total)
    return out


def pick_weighted(pairs: list[tuple[str, float]], u: Column) -> Column:
    """First value whose cumulative weight exceeds ``u`` times the total."""
    edges = cumulative([w for _, w in pairs])
    x = u * F.lit(edges[-1])
    expr = F.when(x < F.lit(edges[0]), F.lit(pairs[0][0]))
    for (value, _), edge in zip(pairs[1:-1], edges[1:-1]):
        expr = expr.when(x < F.lit(edge), F.lit(value))
    return expr.otherwise(F.lit(pairs[-1][0])) if len(pairs) > 1 else F.lit(pairs[0][0])
