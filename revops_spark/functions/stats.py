"""Statistics as Column expressions (ST1-ST6, ST8).

Spark has no erf / erfc / normal CDF, so the two-sided p-value is built from
W. J. Cody's rational Chebyshev approximations of erfc (Math. Comp. 23, 1969).
Normal quantiles depend only on constants (alpha, power), so they are computed
once on the driver with the standard library and embedded as literals.

The expressions are written as Spark SQL text and handed to the JVM in one
`F.expr` call each: the same built-in expressions as the Column API, without
one driver round trip per operator. Arguments are column names or Spark SQL
expressions (text); every `*_sql` function returns text, its plain-named twin
a Column.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: erfc coefficients (Cody 1969), each list in order -------
# y <= 0.46875: erfc(y) = 1 - y * R(y^2)
ERF_SMALL_A = [3.16112374387056560, 113.864154151050156, 377.485237685302021,
               3209.37758913846947]
ERF_SMALL_B = [23.6012909523441209, 244.024637934444173, 1282.61652607737228,
               2844.23683343917062]
ERF_SMALL_K = 0.185777706184603153
# 0.46875 < y <= 4: erfc(y) = exp(-y^2) * R(y)
ERFC_MID_A = [0.564188496988670089, 8.88314979438837594, 66.1191906371416295,
              298.635138197400131, 881.952221241769090, 1712.04761263407058,
              2051.07837782607147, 1230.33935479799725]
ERFC_MID_B = [15.7449261107098347, 117.693950891312499, 537.181101862009858,
              1621.38957456669019, 3290.79923573345963, 4362.61909014324716,
              3439.36767414372164, 1230.33935480374942]
ERFC_MID_K = 2.15311535474403846e-8
# y > 4: erfc(y) = exp(-y^2) / y * (1/sqrt(pi) - x * R(x)), x = 1 / y^2
ERFC_TAIL_A = [0.305326634961232344, 0.360344899949804439, 0.125781726111229246,
               0.0160837851487422766, 6.58749161529837803e-4]
ERFC_TAIL_B = [2.56852019228982242, 1.87295284992346047, 0.527905102951428412,
               0.0605183413124413191, 2.33520497626869185e-3]
ERFC_TAIL_K = 0.0163153871373020978
# ---------------------------------------------------------------------------

_INV_SQRT_PI = 1.0 / math.sqrt(math.pi)


def d(x: float) -> str:
    """A double literal that round-trips exactly."""
    return f"{x!r}D"


def _arg(e: str | Column) -> str:
    if not isinstance(e, str):
        raise TypeError("pass a column name or a Spark SQL expression as text")
    return f"({e})"


def _rational(x: str, a: list[float], b: list[float], k: float) -> str:
    """(k x^n + a0 x^(n-1) + ... + a_last) / (x^n + b0 x^(n-1) + ... + b_last), Horner form."""
    num, den = f"({d(k)} * {x})", x
    for ai, bi in zip(a[:-1], b[:-1]):
        num = f"(({num} + {d(ai)}) * {x})"
        den = f"(({den} + {d(bi)}) * {x})"
    return f"(({num} + {d(a[-1])}) / ({den} + {d(b[-1])}))"


def erfc_sql(y: str) -> str:
    """Complementary error function for y >= 0 (NULL in, NULL out)."""
    y = f"CAST({_arg(y)} AS DOUBLE)"
    y2 = f"({y} * {y})"
    small = f"(1.0D - {y} * {_rational(y2, ERF_SMALL_A, ERF_SMALL_B, ERF_SMALL_K)})"
    # exp(-y^2) as exp(-a^2) * exp(-(y - a)(y + a)), a = y rounded down to 1/16:
    # a^2 is exact, so the rounding error of y^2 is not amplified in the tail
    a = f"(floor({y} * 16.0D) / 16.0D)"
    gauss = f"(exp(-({a} * {a})) * exp(-(({y} - {a}) * ({y} + {a}))))"
    mid = f"({gauss} * {_rational(y, ERFC_MID_A, ERFC_MID_B, ERFC_MID_K)})"
    x = f"(1.0D / greatest({y2}, 1.0D))"  # the guard only matters off-branch
    tail = (f"({gauss} / {y} * ({d(_INV_SQRT_PI)} - {x} * "
            f"{_rational(x, ERFC_TAIL_A, ERFC_TAIL_B, ERFC_TAIL_K)}))")
    return f"(CASE WHEN {y} <= 0.46875D THEN {small} WHEN {y} <= 4.0D THEN {mid} ELSE {tail} END)"


def erfc(y: str) -> Column:
    return F.expr(erfc_sql(y))


def two_sided_p_sql(z: str) -> str:
    """P(|Z| >= |z|) for a standard normal Z: erfc(|z| / sqrt 2)."""
    return erfc_sql(f"abs({_arg(z)}) / {d(math.sqrt(2.0))}")


def two_sided_p(z: str) -> Column:
    return F.expr(two_sided_p_sql(z))


def z_crit(alpha: float = 0.05) -> float:
    """Two-sided critical value z_(1 - alpha/2)."""
    return NormalDist().inv_cdf(1.0 - alpha / 2.0)


def z_power(power: float = 0.80) -> float:
    return NormalDist().inv_cdf(power)


def _dbl(e: str) -> str:
    return f"CAST({_arg(e)} AS DOUBLE)"


def ratio_sql(num: str, den: str) -> str:
    """num / den as double; NULL when den is 0 (ANSI mode would raise)."""
    return f"({_dbl(num)} / NULLIF({_dbl(den)}, 0.0D))"


def ratio(num: str, den: str) -> Column:
    return F.expr(ratio_sql(num, den))


def pooled_z_sql(c1: str, n1: str, c2: str, n2: str) -> str:
    """Two-proportion z statistic with the pooled proportion (ST1).

    z = (p1 - p2) / sqrt(p (1 - p) (1/n1 + 1/n2)), p = (c1 + c2) / (n1 + n2).
    NULL when an arm is empty or the pooled proportion is 0 or 1.
    """
    c1, n1, c2, n2 = (_dbl(v) for v in (c1, n1, c2, n2))
    p1, p2 = ratio_sql(c1, n1), ratio_sql(c2, n2)
    p = ratio_sql(f"{c1} + {c2}", f"{n1} + {n2}")
    var = f"({p} * (1.0D - {p}) * (1.0D / {n1} + 1.0D / {n2}))"
    return f"(({p1} - {p2}) / sqrt(NULLIF({var}, 0.0D)))"


def pooled_z(c1: str, n1: str, c2: str, n2: str) -> Column:
    return F.expr(pooled_z_sql(c1, n1, c2, n2))


def wilson_sql(c: str, n: str, alpha: float = 0.05) -> tuple[str, str]:
    """Wilson score interval for one proportion (ST3): (low, high)."""
    zc = z_crit(alpha)
    n = _dbl(n)
    q = ratio_sql(c, n)
    crit2 = d(zc * zc)
    denom = f"(1.0D + {crit2} / {n})"
    center = f"(({q} + {crit2} / (2.0D * {n})) / {denom})"
    dist = f"({d(zc)} * sqrt({q} * (1.0D - {q}) / {n} + {crit2} / (4.0D * {n} * {n})) / {denom})"
    return f"({center} - {dist})", f"({center} + {dist})"


def wilson_bounds(c: str, n: str, alpha: float = 0.05) -> tuple[Column, Column]:
    low, high = wilson_sql(c, n, alpha)
    return F.expr(low), F.expr(high)


def newcombe_sql(p1: str, l1: str, u1: str, p2: str, l2: str, u2: str) -> tuple[str, str]:
    """Interval for p1 - p2 from the two Wilson intervals (Newcombe 1998,
    method 10) (ST8), given each rate and its Wilson bounds."""
    p1, l1, u1, p2, l2, u2 = (_arg(v) for v in (p1, l1, u1, p2, l2, u2))
    diff = f"({p1} - {p2})"
    low = f"({diff} - sqrt(({p1} - {l1}) * ({p1} - {l1}) + ({u2} - {p2}) * ({u2} - {p2})))"
    high = f"({diff} + sqrt(({u1} - {p1}) * ({u1} - {p1}) + ({p2} - {l2}) * ({p2} - {l2})))"
    return low, high


def newcombe_bounds(c1: str, n1: str, c2: str, n2: str,
                    alpha: float = 0.05) -> tuple[Column, Column]:
    l1, u1 = wilson_sql(c1, n1, alpha)
    l2, u2 = wilson_sql(c2, n2, alpha)
    low, high = newcombe_sql(ratio_sql(c1, n1), l1, u1, ratio_sql(c2, n2), l2, u2)
    return F.expr(low), F.expr(high)


def cohens_h_sql(p1: str, p2: str) -> str:
    """Effect size 2 asin(sqrt p1) - 2 asin(sqrt p2) (ST5)."""
    return f"(2.0D * asin(sqrt({_arg(p1)})) - 2.0D * asin(sqrt({_arg(p2)})))"


def cohens_h(p1: str, p2: str) -> Column:
    return F.expr(cohens_h_sql(p1, p2))


def n_per_group_sql(h: str, alpha: float = 0.05, power: float = 0.80) -> str:
    """Sample size per arm for a two-sided normal test, equal arms (ST6).

    Closed form 2 ((z_(1-alpha/2) + z_power) / |h|)^2; NULL when h is 0.
    """
    r = f"({d(z_crit(alpha) + z_power(power))} / NULLIF(abs({_arg(h)}), 0.0D))"
    return f"(2.0D * ({r} * {r}))"


def n_per_group(h: str, alpha: float = 0.05, power: float = 0.80) -> Column:
    return F.expr(n_per_group_sql(h, alpha, power))


def upper_tail_sql(x: str) -> str:
    """P(Z >= x) for a standard normal Z, any sign of x."""
    x = _arg(x)
    pos = f"(0.5D * {erfc_sql(f'{x} / {d(math.sqrt(2.0))}')})"
    neg = f"(1.0D - 0.5D * {erfc_sql(f'-{x} / {d(math.sqrt(2.0))}')})"
    return f"(CASE WHEN {x} >= 0.0D THEN {pos} ELSE {neg} END)"


def density_sql(x: str) -> str:
    x = _arg(x)
    return f"(exp(-0.5D * {x} * {x}) / {d(math.sqrt(2.0 * math.pi))})"


def newton_step_sql(n: str, h: str, alpha: float = 0.05, power: float = 0.80) -> str:
    """One Newton step towards the n per group at which a two-sided normal test
    with equal arms reaches `power`, counting both tails:
    power(n) = P(Z >= c - |h| s) + P(Z >= c + |h| s), s = sqrt(n / 2)."""
    c, a = d(z_crit(alpha)), f"abs({_arg(h)})"
    s = f"sqrt({_arg(n)} / 2.0D)"
    lo, hi = f"({c} - {a} * {s})", f"({c} + {a} * {s})"
    g = f"({upper_tail_sql(lo)} + {upper_tail_sql(hi)} - {d(power)})"
    slope = f"({a} * ({density_sql(lo)} - {density_sql(hi)}) / (4.0D * {s}))"
    return f"({_arg(n)} - {g} / NULLIF({slope}, 0.0D))"
