"""Means and variances of outcome against price, from integer sums.

With x = 100 * won - price, all sums are integers, so results depend on neither partitioning nor order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def excess_sums(won: Column | str = "won", price: Column | str = "price", contracts: Column | str = "contracts", when: Column | None = None, prefix: str = "") -> list[Column]:
    """Aggregates n, sw, sp, sx, sxx, sc, scp, scx (counts, sums of won, price, x, x squared, contracts, contracts*price, contracts*x)."""
    won, price, contracts = (F.col(c) if isinstance(c, str) else c for c in (won, price, contracts))
    x = won.cast("long") * 100 - price.cast("long")
    parts = {"n": F.lit(1), "sw": won, "sp": price, "sx": x, "sxx": x * x, "sc": contracts, "scp": contracts * price, "scx": contracts * x}
    pick = (lambda c: F.when(when, c)) if when is not None else (lambda c: c)
    return [F.sum(pick(c.cast("long"))).alias(prefix + name) for name, c in parts.items()]


def _d(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b in doubles; null where b is 0."""
    return _d(a) / F.nullif(_d(b), F.lit(0.0))


def win_rate(prefix: str = "") -> Column:
    return ratio(prefix + "sw", prefix + "n")


def mean_excess(prefix: str = "") -> Column:
    return ratio(prefix + "sx", prefix + "n") / 100.0


def _central(prefix: str) -> Column:
    """n * sum of squares - square of the sum, exactly."""
    n, s, q = (F.col(prefix + c).cast("decimal(38,0)") for c in ("n", "sx", "sxx"))
    return (n * q - s * s).cast("double")


def var_pop(prefix: str = "") -> Column:
    n = _d(prefix + "n")
    return _central(prefix) / (n * n) / 1e4


def var_samp(prefix: str = "") -> Column:
    n = _d(prefix + "n")
    return _central(prefix) / F.nullif(n * (n - 1.0), F.lit(0.0)) / 1e4


def standard_error(var: Column, n: Column | str) -> Column:
    return F.sqrt(var / _d(n))


def interval(mean: Column, se: Column) -> tuple[Column, Column]:
    return mean - 1.96 * se, mean + 1.96 * se


def usd(cents: Column | str) -> Column:
    return _d(cents) / 100.0
