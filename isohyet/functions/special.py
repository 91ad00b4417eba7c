"""Gamma and normal distribution functions as Column expressions, for probability-based indices."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHIFT = 8


def _shifted(x: Column, term) -> Column:
    """Sum of term(x + i) over i below the shift."""
    out = term(x)
    for i in range(1, _SHIFT):
        out = out + term(x + float(i))
    return out


def digamma(x: Column) -> Column:
    y = x + float(_SHIFT)
    z = 1 / (y * y)
    tail = z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z * (1 / 240 - z / 132))))
    return F.log(y) - 1 / (2 * y) - tail - _shifted(x, lambda v: 1 / v)


def trigamma(x: Column) -> Column:
    y = x + float(_SHIFT)
    z = 1 / (y * y)
    tail = z / y * (1 / 6 - z * (1 / 30 - z * (1 / 42 - z * (1 / 30 - z * (5 / 66)))))
    return 1 / y + z / 2 + tail + _shifted(x, lambda v: 1 / (v * v))


def log_gamma(x: Column) -> Column:
    y = x + float(_SHIFT)
    z = 1 / (y * y)
    tail = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + tail - _shifted(x, F.log)


def gamma_shape(mean: Column, mean_log: Column, steps: int = 8) -> Column:
    """Maximum-likelihood shape of a gamma sample from its mean and mean log (Newton steps); NULL where degenerate."""
    s = F.log(mean) - mean_log

    def newton(state: Column) -> Column:
        k, s = state["k"], state["s"]
        return F.struct((k - (F.log(k) - digamma(k) - s) / (1 / k - trigamma(k))).alias("k"), s.alias("s"))

    start = (3 - s + F.sqrt((s - 3) * (s - 3) + 24 * s)) / (12 * s)
    # an aggregate keeps each step a lambda over bound values instead of an expression that grows with every step
    fitted = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.struct(start.alias("k"), s.alias("s")), lambda state, _: newton(state), lambda state: state["k"])
    return F.when(s > 1e-12, fitted)


def gamma_cdf(shape: Column, x: Column) -> Column:
    """Regularised lower incomplete gamma P(shape, x) by its power series; 0 for x <= 0."""
    terms = (50 + F.ceil(20 * F.sqrt(shape)) + F.greatest(F.lit(0), F.ceil(x - shape))).cast("int")
    start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("sum"), shape.alias("k"), x.alias("x"))

    def add(acc: Column, n: Column) -> Column:
        t = acc["t"] * acc["x"] / (acc["k"] + n)
        return F.struct(t.alias("t"), (acc["sum"] + t).alias("sum"), acc["k"].alias("k"), acc["x"].alias("x"))

    series = F.aggregate(F.sequence(F.lit(1), terms), start, add, lambda acc: acc["sum"])
    value = F.exp(shape * F.log(x) - x - log_gamma(shape + 1)) * series
    return F.when(x > 0, F.least(value, F.lit(1.0))).when(x.isNotNull() & shape.isNotNull(), 0.0)


# Coefficients of algorithm AS 241 (Wichura 1988), PPND16, constant term first.
_A = (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3)
_B = (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3)
_C = (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4)
_D = (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9)
_E = (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7)
_F = (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15)


def _horner(coefficients: Sequence[float], x):
    out = coefficients[-1]
    for c in reversed(coefficients[:-1]):
        out = out * x + c
    return out


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution function for 0 < p < 1."""
    q = p - 0.5
    centre = 0.180625 - q * q
    tail = F.sqrt(-F.log(F.least(p, 1 - p)))
    near, far = tail - 1.6, tail - 5.0
    size = F.when(tail <= 5.0, _horner(_C, near) / _horner(_D, near)).otherwise(_horner(_E, far) / _horner(_F, far))
    return F.when(F.abs(q) <= 0.425, q * _horner(_A, centre) / _horner(_B, centre)).otherwise(F.signum(q) * size)
