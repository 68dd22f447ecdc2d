"""Dates as whole epoch seconds, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400


def epoch_seconds(text: Column, pattern: str) -> Column:
    """Midnight of a date string as epoch seconds; NULL if it does not parse."""
    return F.unix_date(F.try_to_date(text, pattern)).cast("long") * DAY


def first_occurrence_seconds(text: Column, birth: Column, birth_month: Column) -> Column:
    """Seconds from birth to the recorded date.

    A number stands for itself. Fixed pseudo dates: 1901-01-01 and 2037-07-07
    mean unknown, 1902-02-02 means at birth, 1903-03-03 means within the year
    of birth (half of the time from mid birth month to the end of that year).
    """
    number = text.try_cast("double")
    year_end = epoch_seconds(F.lit("1970-12-31"), "yyyy-MM-dd")
    mid_month = epoch_seconds(F.concat(F.lit("1970-"), birth_month, F.lit("-15")), "yyyy-MM-dd")
    return (
        F.when(number.isNotNull(), number)
        .when(text.isin("1901-01-01", "2037-07-07"), F.lit(None).cast("double"))
        .when(text == "1902-02-02", F.lit(0.0))
        .when(text == "1903-03-03", (year_end - mid_month) / F.lit(2.0))
        .otherwise((epoch_seconds(text, "yyyy-MM-dd") - birth).cast("double"))
    )
