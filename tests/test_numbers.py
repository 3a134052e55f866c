from fractions import Fraction

from pyspark.sql import functions as F

from echowire.functions.numbers import floor_percent, round_half_even, rounded_percent


def test_rounding_follows_exact_binary_value(spark):
    values = [i / 2000 * 100 for i in range(2001)] + [6.25, 0.15, 0.25, 2.675, 1.005, 33.333333, 1 / 3]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", *(round_half_even(F.col("v"), d).alias(f"r{d}") for d in (1, 2))).collect()
    for row in got:
        for digits in (1, 2):
            exact = Fraction(row.v) * 10**digits
            assert row[f"r{digits}"] == round(exact) / 10**digits, (row.v, digits)


def test_percentages_guard_zero(spark):
    df = spark.createDataFrame([(0, 0), (2, 3), (199, 200)], "part long, whole long")
    got = df.select(
        floor_percent(F.col("part"), F.col("whole")).alias("f"),
        rounded_percent(F.col("part"), F.col("whole"), 1).alias("r"),
    ).collect()
    assert [(r.f, r.r) for r in got] == [(0, 0.0), (66, 66.7), (99, 99.5)]
