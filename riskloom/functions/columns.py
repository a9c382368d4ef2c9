"""Column expressions. All JVM-side, all inside whole-stage codegen."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = 86400
FIRST_TX_GAP = 999999


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_sin(ts: Column | str) -> Column:
    return F.sin((_col(ts) % DAY) * F.lit(2 * math.pi / DAY))


def time_cos(ts: Column | str) -> Column:
    return F.cos((_col(ts) % DAY) * F.lit(2 * math.pi / DAY))


def log1p(x: Column | str) -> Column:
    """``ln(1 + x)``; NULL outside the domain ``x > -1``."""
    return F.log1p(_col(x))


def epoch_seconds(ts: Column | str, unit: str = "s") -> Column:
    """Event time as epoch seconds. The unit is stated, never guessed."""
    if unit == "s":
        return _col(ts).cast("long")
    if unit == "ms":
        return F.floor(_col(ts) / 1000).cast("long")
    raise ValueError(f"unknown time unit {unit!r}: use 's' or 'ms'")


def linear(intercept: float, terms: dict[str, float]) -> Column:
    """``intercept + sum(weight * column)``, in the order given."""
    return reduce(lambda acc, t: acc + F.lit(t[1]) * F.col(t[0]), terms.items(), F.lit(intercept))


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def hash_fraction(key: Column | str, seed: int) -> Column:
    """A uniform number in [0, 1) fixed by ``seed`` and ``key`` alone."""
    return hash32(key, seed) / F.lit(float(1 << 32))


def hash32(key: Column | str, seed: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), _col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def uuid_from(*parts: Column | str) -> Column:
    """A UUID-shaped id fixed by its parts, so that a retried write repeats it."""
    digest = F.md5(F.concat_ws(":", *[_col(p).cast("string") for p in parts]))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, pos, n) for pos, n in cuts])


def as_uuid(text: Column | str) -> Column:
    """The text if it is shaped like a UUID, else NULL."""
    shape = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
    return F.when(_col(text).rlike(shape), _col(text))


def spline_position_sql(x: str, low: float, high: float, n_splines: int = 8) -> list[str]:
    """Two SQL columns for :func:`spline_basis_sql`: the place of ``x`` between the edge
    knots, in knot intervals, free (``<x>_u``) and held within the edges (``<x>_e``)."""
    intervals = n_splines - 3
    u = f"(({x} - {low!r}D) * {intervals / ((high - low) or 1.0)!r}D)"
    return [f"{u} AS {x}_u", f"greatest(least({u}, {float(intervals)!r}D), 0.0D) AS {x}_e"]


def spline_basis_sql(x: str, n_splines: int = 8, prefix: str = "b") -> list[str]:
    """Uniform cubic B-spline basis of ``x`` as SQL columns ``<prefix>0 ...``.

    The columns sum to 1; outside the edge knots each continues as a straight line.
    """
    intervals = n_splines - 3
    u, edge = f"{x}_u", f"{x}_e"
    columns = []
    for j in range(n_splines):
        t = f"({edge} - {float(j - 3)!r}D)"
        inside = (
            f"CASE WHEN {t} < 0 OR {t} >= 4 THEN 0.0D"
            f" WHEN {t} < 1 THEN {t}*{t}*{t}/6"
            f" WHEN {t} < 2 THEN (-3*{t}*{t}*{t} + 12*{t}*{t} - 12*{t} + 4)/6"
            f" WHEN {t} < 3 THEN (3*{t}*{t}*{t} - 24*{t}*{t} + 60*{t} - 44)/6"
            f" ELSE (4 - {t})*(4 - {t})*(4 - {t})/6 END"
        )
        # slope of the basis at the edge knots: -1/2, 0, 1/2 on the three live columns
        slopes = [
            f"{slope}D * {side}({u} - {edge}, 0.0D)"
            for side, first in (("least", 0), ("greatest", intervals))
            for slope in [{first: -0.5, first + 2: 0.5}.get(j)]
            if slope is not None
        ]
        columns.append(f"{' + '.join([inside, *slopes])} AS {prefix}{j}")
    return columns


def add_spline_basis(
    df: DataFrame, x: str, low: float, high: float, n_splines: int = 8, prefix: str = "b"
) -> DataFrame:
    """Add the basis columns ``<prefix>0 ...`` of column ``x``."""
    placed = df.selectExpr("*", *spline_position_sql(x, low, high, n_splines))
    return placed.selectExpr("*", *spline_basis_sql(x, n_splines, prefix)).drop(f"{x}_u", f"{x}_e")
