"""Distribution functions and small closed forms, for the driver or for Arrow functions over a few rows."""

from __future__ import annotations

import math


def normal_two_sided(z: float | None) -> float | None:
    """Two-sided p of a standard normal statistic."""
    return None if z is None else math.erfc(abs(z) / math.sqrt(2.0))


def normal_greater(z: float | None) -> float | None:
    return None if z is None else 0.5 * math.erfc(z / math.sqrt(2.0))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function, by its continued fraction (modified Lentz)."""
    if x <= 0.0 or x >= 1.0:
        return min(max(x, 0.0), 1.0)
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c, d = 1e-300, 1.0, 0.0
    total = 1.0
    for i in range(400):
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / (d if abs(d := 1.0 + term * d) > tiny else tiny)
        c = c if abs(c := 1.0 + term / c) > tiny else tiny
        total *= c * d
        if abs(1.0 - c * d) < 1e-14:
            break
    return front * (total - 1.0)


def student_two_sided(t: float | None, df: float | None) -> float | None:
    """Two-sided p of Student's t."""
    if t is None or df is None or df <= 0:
        return None
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def murphy(n: list[float], p: list[float], o: list[float]) -> dict[str, float]:
    """Murphy's decomposition of the Brier score from bins: sizes, mean forecasts, observed shares."""
    total = sum(n)
    if not n or total <= 0:
        raise ValueError("no bins")
    mean = sum(a * b for a, b in zip(n, o)) / total
    reliability = sum(a * (b - c) ** 2 for a, b, c in zip(n, p, o)) / total
    resolution = sum(a * (c - mean) ** 2 for a, c in zip(n, o)) / total
    uncertainty = mean * (1.0 - mean)
    return {"o_bar": mean, "reliability": reliability, "resolution": resolution, "uncertainty": uncertainty, "brier": reliability - resolution + uncertainty}
