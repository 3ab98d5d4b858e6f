"""Numbers as the report shows them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_AVAILABLE = "N/A"


def fixed(value: Column, digits: int) -> Column:
    """The double with a fixed number of decimals, an exact tie going away from zero.

    ``format_number`` rounds the exact binary value, as JavaScript does, but sends
    ties to the even digit. A double is a tie only if it is an odd multiple of
    1/2^(digits+1), which is tested exactly and nudged outwards.
    """
    halves = value * F.lit(float(2 ** (digits + 1)))
    tie = (F.abs(halves) < float(2**53)) & (F.abs(halves % F.lit(2.0)) == 1.0)
    nudge = F.lit(10.0 ** -(digits + 1)) * F.signum(value)
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function(
        "format_number", F.when(tie, value + nudge).otherwise(value), F.lit(pattern)
    )


def percent_text(value: Column) -> Column:
    number = value.cast("double")
    return F.when(number.isNull() | F.isnan(number), NOT_AVAILABLE).otherwise(
        F.concat(fixed(number * 100.0, 2), F.lit("%"))
    )


def time_text(seconds: Column) -> Column:
    """Milliseconds below one second, else seconds. Null counts as zero."""
    number = F.coalesce(seconds.cast("double"), F.lit(0.0))
    return (
        F.when(F.isnan(number), NOT_AVAILABLE)
        .when(number < 1.0, F.concat(fixed(number * 1000.0, 0), F.lit(" ms")))
        .otherwise(F.concat(fixed(number, 2), F.lit(" s")))
    )


def bar_width(value: Column) -> Column:
    return F.least(F.greatest(value * 100.0, F.lit(0.0)), F.lit(100.0))
