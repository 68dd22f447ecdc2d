"""Normal and chi-squared quantiles as native column expressions.

The normal quantile follows Wichura's published algorithm AS 241 (PPND16).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of AS 241, lowest order first.
CENTRAL_NUM = [3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
               4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3]
CENTRAL_DEN = [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
               2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3]
MIDDLE_NUM = [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
              1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4]
MIDDLE_DEN = [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
              1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9]
TAIL_NUM = [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
            2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7]
TAIL_DEN = [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
            7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15]

MEDIAN_CHI2 = 0.4549364231195724


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _horner(x: Column, coefficients: list[float]) -> Column:
    return reduce(lambda total, c: total * x + F.lit(c), reversed(coefficients[:-1]), F.lit(coefficients[-1]))


def _ratio(x: Column, numerator: list[float], denominator: list[float]) -> Column:
    return let(x, lambda v: _horner(v, numerator) / _horner(v, denominator))


def normal_quantile(p: Column) -> Column:
    """Inverse normal distribution function; NULL outside (0, 1)."""

    def tails(p: Column) -> Column:
        r = F.sqrt(-F.log(F.least(p, 1.0 - p)))
        size = let(
            r,
            lambda v: F.when(v <= 5.0, _ratio(v - 1.6, MIDDLE_NUM, MIDDLE_DEN)).otherwise(
                _ratio(v - 5.0, TAIL_NUM, TAIL_DEN)
            ),
        )
        return F.when(p < 0.5, -size).otherwise(size)

    def center(p: Column) -> Column:
        return let(p - 0.5, lambda q: q * _ratio(F.lit(0.180625) - q * q, CENTRAL_NUM, CENTRAL_DEN))

    return let(p, lambda v: F.when((v > 0) & (v < 1), F.when(F.abs(v - 0.5) <= 0.425, center(v)).otherwise(tails(v))))


def chi2_upper_quantile(p: Column) -> Column:
    """Value exceeded with probability ``p`` by a chi-squared with 1 d.f."""
    return let(
        p, lambda v: F.when(v == 0, F.lit(float("inf"))).otherwise(F.pow(normal_quantile(v / 2), F.lit(2.0)))
    )


def lambda_gc(lower: Column, upper: Column) -> Column:
    """Genomic-control factor from the two middle p-values."""
    middle = (chi2_upper_quantile(lower) + chi2_upper_quantile(upper)) / 2
    return middle / F.lit(MEDIAN_CHI2)
