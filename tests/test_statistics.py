"""p-values against closed forms and limits."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from loomcart.functions.distributions import (
    Z_POWER_80_PERCENT,
    Z_TWO_SIDED_5_PERCENT,
    normal_p_value,
    student_p_value,
)


def students(spark, pairs):
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pairs)], "i int, t double, df double")
    return [r["p"] for r in df.withColumn("p", student_p_value(F.col("t"), F.col("df"))).orderBy("i").collect()]


def normals(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, z double")
    return [r["p"] for r in df.withColumn("p", normal_p_value(F.col("z"))).orderBy("i").collect()]


def test_normal(spark):
    values = [0.0, Z_TWO_SIDED_5_PERCENT, -Z_TWO_SIDED_5_PERCENT, Z_POWER_80_PERCENT, 6.0, 80.0]
    assert normals(spark, values) == pytest.approx([math.erfc(abs(z) / math.sqrt(2)) for z in values], abs=1e-11, rel=1e-9)


def test_student_closed_forms(spark):
    ts = [0.0, 0.3, -1.0, 2.5, 40.0]
    assert students(spark, [(t, 1) for t in ts]) == pytest.approx([1 - 2 * math.atan(abs(t)) / math.pi for t in ts], abs=1e-9)
    assert students(spark, [(t, 2) for t in ts]) == pytest.approx([1 - abs(t) / math.sqrt(2 + t * t) for t in ts], abs=1e-9)
    four = [1 - abs(t) / math.sqrt(4 + t * t) * (1 + 2 / (4 + t * t)) for t in ts]
    assert students(spark, [(t, 4) for t in ts]) == pytest.approx(four, abs=1e-9)


@pytest.mark.parametrize("df", [1e8, 1e10, 1e12])
def test_student_tends_to_normal(spark, df):
    ts = [0.5, 1.7, 2.0, 4.0]
    want = []
    for t in ts:  # with the first term of the expansion in 1/df
        density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
        want.append(math.erfc(t / math.sqrt(2)) + 2 * density * (t**3 + t) / (4 * df))
    assert students(spark, [(t, df) for t in ts]) == pytest.approx(want, abs=1e-10)


def test_nulls(spark):
    assert students(spark, [(2.0, 2.0)]) != [None]
    frame = spark.createDataFrame([(None, 1.0), (1.0, None)], "t double, df double")
    assert [r[0] for r in frame.select(student_p_value(F.col("t"), F.col("df"))).collect()] == [None, None]
    assert frame.select(normal_p_value(F.col("t"))).first()[0] is None
