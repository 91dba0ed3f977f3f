"""Column expressions shared by several operators."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_share(keys: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) fixed by the keys and the seed; other engines can compute the same."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return head / F.lit(2.0**32)


def hash_bucket(keys: Sequence[str], seed: int, buckets: int) -> Column:
    return F.floor(hash_share(keys, seed) * buckets).cast("int")


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as a double, 0 when the bottom is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where the body uses it for every element of an array."""
    return F.get(F.transform(F.array(value), body), 0)


def softmax(logits: Column) -> Column:
    """Softmax of an array, shifted by its maximum so that it cannot overflow."""
    shares = lambda powers: let(
        F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x), lambda total: F.transform(powers, lambda x: x / total)
    )
    powers = lambda v: let(F.array_max(v), lambda top: F.transform(v, lambda x: F.exp(x - top)))
    return let(logits, lambda v: let(powers(v), shares))


def argmax(values: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def ks_p_value(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic p-value of the two-sample Kolmogorov-Smirnov distance."""
    root = F.sqrt(F.try_divide((n * m).cast("double"), (n + m).cast("double")))
    stretch = (root + 0.12 + F.lit(0.11) / root) * d
    sign = lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0)
    series = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.lit(terms)), lambda k: sign(k) * F.exp(-2.0 * k * k * stretch * stretch)),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
    # below 0.2 the true value is 1 to more than ten places while the series converges slowly
    return F.when(stretch < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series)))


def _upper_gamma(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function Q(a, x) for whole and half a > 0, by the series of its complement."""
    whole = F.floor(a)
    half = a != whole
    # ln Gamma(a + 1) from its recursion, starting at Gamma(1/2) = sqrt(pi) or Gamma(1) = 1
    start = F.when(half, F.lit(math.log(math.pi) / 2)).otherwise(F.lit(0.0))
    factors = F.sequence(F.lit(1).cast("long"), F.greatest(whole + half.cast("long"), F.lit(1)))
    log_gamma = F.aggregate(factors, start, lambda acc, i: acc + F.ln(i - F.when(half, 0.5).otherwise(0.0)))
    bound = a + 40 * F.sqrt(a) + 200  # beyond it Q is below 1e-30
    near = F.least(x, bound)
    share = F.exp(a * F.ln(near) - near - log_gamma)  # the sum starts at its share, so that it cannot overflow

    def step(acc, n):
        term = acc["term"] * near / (a + n)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    terms = F.sequence(F.lit(1).cast("long"), F.ceil(near + 20 * F.sqrt(near) + 60))
    lower = F.aggregate(terms, F.struct(share.alias("term"), share.alias("total")), step)["total"]
    return F.when(x <= 0, 1.0).when(x > bound, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - lower)))


def chi_square_p_value(statistic: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution; NULL without degrees of freedom. Beyond 1000 degrees the cube root is
    taken as normal, which is right to five places."""
    spread = F.lit(2.0) / (9.0 * dof)
    z = (F.pow(statistic / dof, 1 / 3) - (1.0 - spread)) / F.sqrt(spread)
    tail = _upper_gamma(F.lit(0.5), z * z / 2) / 2  # half of the complementary error function
    normal = F.when(z >= 0, tail).otherwise(1.0 - tail)
    return F.when(dof > 1000, normal).when(dof > 0, _upper_gamma(dof / 2, statistic / 2))


def two_proportion_z(x1: Column, n1: Column, x2: Column, n2: Column) -> Column:
    """z statistic of rate 1 against rate 2 with pooled variance; NULL when undefined."""
    pooled = F.try_divide((x1 + x2).cast("double"), (n1 + n2).cast("double"))
    spread = F.sqrt(pooled * (1.0 - pooled) * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    return F.try_divide(F.try_divide(x1.cast("double"), n1) - F.try_divide(x2.cast("double"), n2), spread)


def equal_width_bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based bin of x between low and high; the top edge belongs to the last bin."""
    place = F.floor((x - low) / F.nullif(high - low, F.lit(0.0)) * bins)
    return F.least(F.lit(bins - 1), F.coalesce(place, F.lit(0))).cast("int")


def log10_bin(x: Column, low: float, high: float, bins: int) -> Column:
    return equal_width_bin(F.log10(x), F.lit(math.log10(low)), F.lit(math.log10(high)), bins)
