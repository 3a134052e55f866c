"""Run timestamp, percentages and pair counts."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIR_COUNT = "decimal(38,0)"  # a product of two row counts outgrows BIGINT


def run_timestamp() -> datetime:
    """Now in UTC at second precision; taken once per run and passed to every step."""
    return datetime.now(timezone.utc).replace(microsecond=0)


def timestamp_literal(moment: datetime) -> Column:
    return F.timestamp_seconds(F.lit(int(moment.timestamp())))


def pair_product(left: Column, right: Column) -> Column:
    return (left.cast("decimal(19,0)") * right.cast("decimal(19,0)")).cast(PAIR_COUNT)


def pair_sum(count: Column) -> Column:
    """Sum of pair counts, 0 over no rows."""
    return F.coalesce(F.sum(count), F.lit(0)).cast(PAIR_COUNT)


def _two_sum(a: Column, b: Column) -> tuple[Column, Column]:
    """Sum of two doubles and the exact rounding error of that sum."""
    total = a + b
    part = total - a
    return total, (a - (total - part)) + (b - part)


def round_half_even(value: Column, digits: int) -> Column:
    """Round a double by its exact binary value, ties to even, to 1 or 2 digits.

    `bround` works on the shortest decimal text, so 0.15 looks like a tie to it although
    the double lies below one. Such values are told apart by the error term of an exact
    sum: 20x = 16x + 4x for one digit, 200x = 128x + 64x + 8x for two.
    """
    if digits == 1:
        scaled, error = _two_sum(value * 16, value * 4)
    elif digits == 2:
        first, error_1 = _two_sum(value * 128, value * 64)
        second, error_2 = _two_sum(first, value * 8)
        scaled, error = _two_sum(second, error_1 + error_2)
    else:
        raise ValueError("digits must be 1 or 2")
    power = float(10**digits)
    looks_tied = F.pmod(scaled, F.lit(2.0)) == 1.0
    below = F.floor(scaled / 2) / power
    return (
        F.when(looks_tied & (error < 0), below)
        .when(looks_tied & (error > 0), (F.floor(scaled / 2) + 1) / power)
        .otherwise(F.bround(value, digits))
    )


def rounded_percent(part: Column, whole: Column, digits: int) -> Column:
    """`part` of `whole` in percent, rounded; 0.0 for an empty whole."""
    share = part.cast("double") / whole.cast("double") * 100
    return F.when(whole > 0, round_half_even(share, digits)).otherwise(0.0)


def floor_percent(part: Column, whole: Column) -> Column:
    """`part` of `whole` in whole percent, rounded down; 0 for an empty whole."""
    whole = F.nullif(whole.cast(PAIR_COUNT), F.lit(0).cast(PAIR_COUNT))
    share = F.call_function("div", part.cast(PAIR_COUNT) * 100, whole)
    return F.coalesce(share, F.lit(0).cast("bigint"))
