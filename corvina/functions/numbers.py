"""Figures: ratios that never divide by zero and rounding half to even."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column, *, empty: float = 0.0) -> Column:
    """part / whole, ``empty`` where whole is 0 or null."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(empty))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Hundredths of the whole, rounded half up."""
    return F.round(ratio(part, whole) * 100, digits)


def round_even(c: Column, digits: int) -> Column:
    """Rounded half to even on the exact binary value; Spark's own round works half up on the decimal form."""

    @F.pandas_udf("double")
    def f(x: pd.Series) -> pd.Series:
        return x.map(lambda v: round(v, digits), na_action="ignore")

    return f(c)


def impact(count: Column, score: Column) -> Column:
    """Rows concerned times what the score lacks to 1."""
    return count * (F.lit(1.0) - score)
