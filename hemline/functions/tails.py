"""Tail probabilities as column expressions: error function, normal, chi-square, and two-sample Kolmogorov-Smirnov.

The sums run in built-in aggregates over short sequences, so a value costs some hundred steps and no Python.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Below this a series, from it on a continued fraction; terms of either.
NEAR = 2.5
TERMS = 90


def _fold(n: Column | int, start: Column, step) -> Column:
    """``step(state, k)`` for k from 1 to n."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(n < 1, start).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1)).cast("int")), start, step))


def erfc(x: Column) -> Column:
    """Complementary error function, for x of at least 0, to about 1e-13."""
    # Held in an array of one element, the argument is worked out once.
    return F.transform(F.array(x.cast("double")), lambda z: F.when(z < NEAR, 1 - _erf_series(z)).otherwise(_erfc_fraction(z)))[0]


def _erf_series(z: Column) -> Column:
    start = F.struct(z.alias("term"), z.alias("total"))

    def step(s: Column, k: Column) -> Column:
        term = s["term"] * 2 * z * z / (2 * k + 1)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    return _fold(TERMS, start, step)["total"] * F.exp(-z * z) * (2 / math.sqrt(math.pi))


def _erfc_fraction(z: Column) -> Column:
    # Backwards from the last term of x + (1/2)/(x + (2/2)/(x + (3/2)/(x + ...))).
    tail = _fold(TERMS, z, lambda s, k: z + (TERMS + 1 - k) / 2.0 / s)
    return F.exp(-z * z) / (tail * math.sqrt(math.pi))


def normal_two_sided(z: Column) -> Column:
    """Chance of a standard normal at least as far from 0 as z."""
    return erfc(F.abs(z) / math.sqrt(2))


def chi_square_tail(x: Column, dof: Column) -> Column:
    """Chance of a chi-square of ``dof`` (a whole number) degrees of freedom of at least x: the regularised upper incomplete gamma
    function at dof / 2, whose terms are summed by their logarithms."""

    def tail(a: Column) -> Column:
        half, odd, n = a["x"] / 2, a["dof"] % 2 == 1, F.floor(a["dof"] / 2).cast("int")
        # Powers over factorials: from 1 for an even number of degrees, from sqrt(x / pi) for an odd one.
        first = F.when(odd, F.log(half) / 2 - math.log(math.sqrt(math.pi) / 2) - half).otherwise(-half)
        start = F.struct(first.alias("log"), F.exp(first).alias("total"))

        def step(s: Column, k: Column) -> Column:
            own = s["log"] + F.log(half) - F.log(F.when(odd, k + F.lit(0.5)).otherwise(k.cast("double")))
            return F.struct(own.alias("log"), (s["total"] + F.exp(own)).alias("total"))

        summed = F.when(n > 0, _fold(n - 1, start, step)["total"]).otherwise(0.0)
        value = summed + F.when(odd, erfc(F.sqrt(half))).otherwise(0.0)
        return F.when(a["x"] <= 0, 1.0).otherwise(F.least(F.lit(1.0), value))

    given = F.struct(x.cast("double").alias("x"), dof.cast("int").alias("dof"))
    return F.transform(F.array(given), tail)[0]


def kolmogorov_tail(x: Column) -> Column:
    """Chance of a Kolmogorov-distributed value of at least x."""
    large = F.transform(F.array(x.cast("double")), lambda z: _fold(60, F.lit(0.0), lambda s, k: s + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * z * z)))[0]
    # For small x the other form of the same function converges at once.
    factor = math.sqrt(2 * math.pi)
    small = F.transform(F.array(x.cast("double")), lambda z: 1 - factor / z * _fold(20, F.lit(0.0), lambda s, k: s + F.exp(-((2 * k - 1) * (2 * k - 1)) * (math.pi**2) / (8 * z * z))))[0]
    return F.when(x <= 0, 1.0).when(x < 1.0, small).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), large)))


def ks_tail(statistic: Column, n: Column, m: Column) -> Column:
    """Two-sample Kolmogorov-Smirnov tail with the usual correction for finite samples, good to some thousandths from ten rows a side
    on."""
    root = F.sqrt(n.cast("double") * m / (n.cast("double") + m))
    return kolmogorov_tail(statistic * (root + 0.12 + 0.11 / root))
