"""Special functions as columns: log-gamma, the incomplete beta function and the tail of the F distribution."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the continued fraction; it converges within about the square root of the larger parameter.
TERMS = 200
_TINY = 1e-300


def _let(value: Column, then) -> Column:
    return F.get(F.transform(F.array(value), then), 0)


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x > 0: Stirling's series at x + 10, carried back by the recurrence."""
    far = x + 10
    r = F.lit(1.0) / (far * far)
    series = (F.lit(1 / 12) - r * (F.lit(1 / 360) - r * (F.lit(1 / 1260) - r * (F.lit(1 / 1680) - r * F.lit(1 / 1188))))) / far
    stirling = (far - 0.5) * F.log(far) - far + F.lit(0.9189385332046727) + series
    product = x
    for k in range(1, 10):
        product = product * (x + k)
    return stirling - F.log(product)


def _kept(x: Column) -> Column:
    return F.when(F.abs(x) > _TINY, x).otherwise(_TINY)


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function (modified Lentz), folded over its terms."""
    start = _let(F.lit(1.0) / _kept(F.lit(1.0) - (a + b) * x / (a + 1)), lambda d: F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("value")))

    def turn(s: Column, up: Column) -> Column:
        c, d = _kept(F.lit(1.0) + up / s["c"]), F.lit(1.0) / _kept(F.lit(1.0) + up * s["d"])
        return _let(F.struct(c.alias("c"), d.alias("d")), lambda n: F.struct(n["c"].alias("c"), n["d"].alias("d"), (s["value"] * n["c"] * n["d"]).alias("value")))

    def term(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + m * 2 - 1) * (a + m * 2))
        odd = -(a + m) * (a + b + m) * x / ((a + m * 2) * (a + m * 2 + 1))
        return _let(turn(s, even), lambda t: turn(t, odd))

    terms = F.transform(F.sequence(F.lit(1), F.lit(TERMS)), lambda m: m.cast("double"))
    return F.aggregate(terms, start, term, lambda s: s["value"])


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """Regularised incomplete beta function I_x(a, b), for 0 <= x <= 1."""
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log1p(-x))
    near = front * _beta_fraction(a, b, x) / a
    far = F.lit(1.0) - front * _beta_fraction(b, a, F.lit(1.0) - x) / b
    return F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0)).when(x < (a + 1) / (a + b + 2), near).otherwise(far)


def f_survival(f: Column, dfn: Column, dfd: Column) -> Column:
    """P(F > f) of the F distribution; null where f is null or NaN."""
    n, d = dfn.cast("double"), dfd.cast("double")
    inside = incomplete_beta(d / 2, n / 2, d / (d + n * f))
    return F.when(f.isNull() | F.isnan(f), F.lit(None).cast("double")).when(f <= 0, F.lit(1.0)).when(f == float("inf"), F.lit(0.0)).otherwise(inside)
