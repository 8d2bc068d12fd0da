"""Statistics as Column expressions; all stay inside code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Rational approximation of the normal CDF (Hart 1968 / West 2005),
# highest power first.
CDF_NUMERATOR = (
    3.52624965998911e-2, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
)
CDF_DENOMINATOR = (
    8.83883476483184e-2, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
)
CDF_SPLIT = 7.07106781186547
CDF_LIMIT = 37.0
SQRT_TWO_PI = 2.506628274631

# Rational approximation of the normal quantile (Acklam 2003),
# highest power first; the denominators end in 1.
PPF_CENTRAL_NUMERATOR = (
    -39.69683028665376, 220.9460984245205, -275.9285104469687,
    138.3577518672690, -30.66479806614716, 2.506628277459239,
)
PPF_CENTRAL_DENOMINATOR = (
    -54.47609879822406, 161.5858368580409, -155.6989798598866,
    66.80131188771972, -13.28068155288572, 1.0,
)
PPF_TAIL_NUMERATOR = (
    -7.784894002430293e-3, -0.3223964580411365, -2.400758277161838,
    -2.549732539343734, 4.374664141464968, 2.938163982698783,
)
PPF_TAIL_DENOMINATOR = (
    7.784695709041462e-3, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0,
)
PPF_SPLIT = 0.02425

# The quartile of the standard normal, and the clip range of a
# difference of two probabilities.
QUARTILE_Z = 0.67448
CLIP_LOW, CLIP_HIGH = 0.001, 0.9999


def polynomial(x: Column, coefficients) -> Column:
    """Horner form, highest power first."""
    return reduce(lambda acc, c: acc * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def ratio(numerator: Column, denominator: Column, empty=None) -> Column:
    """Division that yields ``empty`` (NULL by default) for a zero denominator."""
    quotient = F.try_divide(numerator, denominator)
    return quotient if empty is None else F.coalesce(quotient, F.lit(empty))


def zscore(x: Column, mean: Column, std: Column) -> Column:
    """``(x - mean) / std``; NULL when the deviation is zero or NULL."""
    return F.try_divide(x - mean, std)


def normal_cdf(x: Column) -> Column:
    """Standard normal CDF, absolute error below 1e-15; NULL stays NULL.

    The polynomials run on a column that cannot be NULL, which keeps their generated code
    short; pass a plain column rather than a long expression, since it is used many times.
    """
    value = F.coalesce(x.cast("double"), F.lit(0.0))
    a = F.abs(value)
    density = F.exp(-a * a / 2)
    near = density * polynomial(a, CDF_NUMERATOR) / polynomial(a, CDF_DENOMINATOR)
    far = density / (a + 1 / (a + 2 / (a + 3 / (a + 4 / (a + 0.65))))) / SQRT_TWO_PI
    tail = F.when(a < CDF_SPLIT, near).when(a <= CDF_LIMIT, far).otherwise(0.0)
    upper = value > 0
    mirrored = F.when(upper, 1.0).otherwise(0.0) + F.when(upper, -1.0).otherwise(1.0) * tail
    return F.when(x.isNotNull(), mirrored)


def normal_ppf(p: Column) -> Column:
    """Standard normal quantile, absolute error below 1e-8 for 0 < p < 1; NULL outside.

    As with ``normal_cdf``, pass a plain column.
    """
    inside = (p > 0) & (p < 1)
    value = F.coalesce(p.cast("double"), F.lit(0.5))
    nearer = F.least(value, 1 - value)
    q = F.sqrt(-2 * F.ln(nearer))
    tail = polynomial(q, PPF_TAIL_NUMERATOR) / polynomial(q, PPF_TAIL_DENOMINATOR)
    centred = value - 0.5
    square = centred * centred
    central = (
        centred * polynomial(square, PPF_CENTRAL_NUMERATOR)
        / polynomial(square, PPF_CENTRAL_DENOMINATOR)
    )
    far = nearer < PPF_SPLIT
    return F.when(inside & far, F.when(value < 0.5, tail).otherwise(-tail)).when(inside, central)


def delta_zscore(df: DataFrame, x1: str, x2: str, out: str) -> DataFrame:
    """Difference of two z-scores taken in the probability domain and mapped back.

    The difference is clipped to a range that can be mapped back; NULL if either is NULL.
    Each step is a column of its own, so that no step's expression is repeated in the next.
    """
    return (
        df.withColumns({"_p1": normal_cdf(F.col(x1)), "_p2": normal_cdf(F.col(x2))})
        .withColumn("_gap", F.when(
            F.col("_p1").isNotNull() & F.col("_p2").isNotNull(),
            F.greatest(F.least(F.col("_p1") - F.col("_p2"), F.lit(CLIP_HIGH)), F.lit(CLIP_LOW)),
        ))
        .withColumn(out, normal_ppf(F.col("_gap")))
        .drop("_p1", "_p2", "_gap")
    )


def quantile_band(z: Column, mode: str = "intended") -> Column:
    """Band 1 (highest) to 4 of a z-score; NULL falls into band 4.

    ``intended`` cuts at the normal quartiles.  ``strict`` reproduces a comparison
    of z with a multiple of itself, which is a sign test: 1 for z >= 0, else 4.
    """
    if mode == "strict":
        return F.when(z >= 0, 1).otherwise(4)
    return F.when(z >= QUARTILE_Z, 1).when(z >= 0, 2).when(z >= -QUARTILE_Z, 3).otherwise(4)


def unlog10(x: Column) -> Column:
    return F.pow(F.lit(10.0), x)
