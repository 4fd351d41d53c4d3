"""Distribution tails: normal, t, F, chi-squared (regularised incomplete beta and gamma)."""

from __future__ import annotations

import math


def _beta_fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + top * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + top / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def gamma_inc_upper(a: float, x: float) -> float:
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return 1 - total * front
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * h


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def t_two_sided(t: float, df: float) -> float:
    return float("nan") if df <= 0 else beta_inc(df / 2, 0.5, df / (df + t * t))


def f_upper(f: float, d1: float, d2: float) -> float:
    return beta_inc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f)) if f > 0 else 1.0


def chi2_upper(x: float, df: float) -> float:
    return gamma_inc_upper(df / 2, x / 2)


def normal_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))
