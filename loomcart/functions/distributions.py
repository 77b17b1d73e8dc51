"""Two-sided p-values as column expressions.

Student's t with v degrees of freedom is the integral of cos(x)^(v-1) over an angle. With x = u / sqrt(v) the integrand
tends to exp(-u^2/2), so the same sum serves a few and 10^10 degrees of freedom, and dividing by the whole integral
needs no gamma function.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Z_TWO_SIDED_5_PERCENT = 1.959963984540054  # normal quantile at 0.975
Z_POWER_80_PERCENT = 0.8416212335729143  # normal quantile at 0.80
STEPS = 4000  # intervals of Simpson's rule
FAR = 45.0  # where the normal tail is below the smallest double


def _simpson(low: Column, high: Column, density) -> Column:
    step = (high - low) / STEPS
    return step / 3 * F.aggregate(
        F.sequence(F.lit(0), F.lit(STEPS)),
        F.lit(0.0),
        lambda total, i: total
        + F.when((i == 0) | (i == STEPS), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0) * density(low + i * step),
    )


def normal_p_value(z: Column) -> Column:
    """P(|Z| > |z|)."""
    low = F.least(F.abs(z), F.lit(FAR))
    tail = _simpson(low, F.lit(FAR), lambda u: F.exp(-u * u / 2)) * math.sqrt(2 / math.pi)
    return F.when(z.isNotNull(), tail)


def student_p_value(t: Column, df: Column) -> Column:
    """P(|T| > |t|) for ``df`` of at least 1."""
    root = F.sqrt(df)
    high = F.least(root * (math.pi / 2), F.lit(FAR))
    low = F.least(root * F.atan(F.abs(t) / root), high)

    def density(u: Column) -> Column:
        half = F.sin(u / root / 2)
        # ln cos x = ln(1 - 2 sin^2(x/2)); at the end of the range cos is 0 and only the power 0 counts.
        cosine = F.greatest(1 - 2 * half * half, F.lit(0.0))
        small = F.exp((df - 1) * F.log1p(-2 * half * half))
        return F.when(df == 1, 1.0).when(cosine <= 1e-15, 0.0).otherwise(small)

    share = F.try_divide(_simpson(low, high, density), _simpson(F.lit(0.0), high, density))
    return F.when(t.isNotNull() & df.isNotNull(), share)
