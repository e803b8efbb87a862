"""Regression and agreement statistics as aggregate expressions, and Student's t in closed form."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def regression(y: str, x: str) -> list[Column]:
    """Aggregates of a line through (x, y): rate, incpt, se (of the rate) and n_reg, the pairs without null."""
    b, sxx, syy, sxy, n = F.regr_slope(y, x), F.regr_sxx(y, x), F.regr_syy(y, x), F.regr_sxy(y, x), F.regr_count(y, x)
    rest = F.greatest(syy - b * sxy, F.lit(0.0))
    return [b.alias("rate"), F.regr_intercept(y, x).alias("incpt"), F.when(n > 2, F.sqrt(F.try_divide(F.try_divide(rest, n - 2), sxx))).alias("se"), n.alias("n_reg")]


def t_test(t: Column, df: Column) -> Column:
    """The two-sided p-value of Student's t for whole degrees of freedom, in closed form (Abramowitz and Stegun 26.7.3, 26.7.4).

    A finite sum in the squared cosine of atan(t / sqrt(df)): accurate to about 1e-15, which is all that a threshold needs.
    """
    angle = F.atan(F.abs(t) / F.sqrt(df))
    sine, cosine = F.sin(angle), F.cos(angle)
    odd = F.pmod(df, F.lit(2)) == 1
    first = F.when(odd, cosine).otherwise(F.lit(1.0))
    # each term is the one before times cos**2 (k - 1) / k, k from 3 or 2 in steps of two
    steps = F.sequence(F.when(odd, 3).otherwise(2).cast("long"), F.greatest((df - 1).cast("long"), F.when(odd, 3).otherwise(2).cast("long")), F.lit(2).cast("long"))
    terms = F.filter(steps, lambda k: k <= df - 1)
    total = F.aggregate(terms, F.struct(first.alias("term"), first.alias("sum")), lambda s, k: F.struct((s.term * cosine * cosine * (k - 1) / k).alias("term"), (s.sum + s.term * cosine * cosine * (k - 1) / k).alias("sum")))["sum"]
    inside = F.when(odd, (angle + F.when(df > 1, sine * total).otherwise(0.0)) * (2 / math.pi)).otherwise(sine * total)
    return F.greatest(1 - inside, F.lit(0.0))


def significance(rate: Column, se: Column, n: Column) -> Column:
    """The p-value of a regression's rate; null with fewer than three pairs. Without any scatter 0, or 1 for a rate of 0."""
    flat = F.when(rate == 0, 1.0).otherwise(0.0)
    return F.when((n > 2) & rate.isNotNull() & se.isNotNull(), F.when(se > 0, t_test(rate / F.when(se > 0, se), n - 2)).otherwise(flat))


def agreement(value: str, truth: str) -> list[Column]:
    """mae, rmse, sd of the absolute errors (sample), r2 (a coefficient of determination) and n of a prediction.

    r2 needs the sum of squares around the mean of the truth, which regr_sxx gives in the same pass.
    """
    v, t = F.col(value), F.col(truth)
    both = v.isNotNull() & t.isNotNull()
    error = F.when(both, F.abs(v - t))
    return [
        F.avg(error).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"), F.stddev_samp(error).alias("sd"),
        (1 - F.try_divide(F.sum(error * error), F.regr_sxx(v, t))).alias("r2"), F.count(error).alias("n"),
    ]


def clean_zero(value: Column) -> Column:
    """Plain zero in place of minus zero."""
    return value + F.lit(0.0)
