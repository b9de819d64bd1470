"""The quick rounding of doubles gives what the rounding through decimal text gives."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tickloom.functions.numeric import stable_round, stable_round_double


@pytest.mark.parametrize("digits", [2, 4, 6, 8])
def test_quick_rounding_is_the_same_to_the_last_bit(spark, digits):
    random.seed(7)
    unit = 10.0**-digits
    near = [s * (k + 0.5) * unit + d for s in (1, -1) for k in (0, 1, 2, 17, 12345, 499999) for d in (0, 1e-15, -1e-15, 1e-10, -1e-10, -4.9e-10, -5e-10, -5.1e-10, -1e-9, 1e-9)]
    rows = near + [random.uniform(-5, 5) for _ in range(5000)] + [round(random.uniform(-5, 5), digits + 1) for _ in range(5000)] + [0.0, -0.0, -1e-12, 5.0, -5.0, 1e7, 1e15, 1e300, math.inf, -math.inf, math.nan, None]
    table = spark.createDataFrame([(x,) for x in rows], "x double")
    made = table.select("x", stable_round(F.col("x"), digits).alias("a"), stable_round_double("x", digits).alias("b"))
    assert [r for r in made.collect() if str(r["a"]) != str(r["b"])] == []
