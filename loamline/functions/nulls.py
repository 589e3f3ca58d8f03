"""One missing marker: NULL. Not-a-number and infinities become NULL at every source, and rules treat NULL as "no"."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPS = 1e-6


def finite(x: Column) -> Column:
    """x, or NULL where it is NaN or infinite."""
    x = x.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def all_finite(df: DataFrame) -> DataFrame:
    """df with finite() applied to every floating column."""
    return df.withColumns({f.name: finite(F.col(f.name)).cast(f.dataType) for f in df.schema if isinstance(f.dataType, T.FloatType | T.DoubleType)})


def yes(condition: Column) -> Column:
    """The condition, false where it is NULL."""
    return F.coalesce(condition, F.lit(False))


def number(x: Column) -> Column:
    """Text to a finite double, NULL where it is none."""
    return finite(x.cast("string").try_cast("double"))


def ratio(a: Column, b: Column) -> Column:
    """a / b as doubles, NULL where b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def clipped(x: Column, low: float, high: float) -> Column:
    """x within [low, high]; NULL stays NULL (least and greatest alone would ignore it)."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def clipped_probability(x: Column) -> Column:
    return clipped(x, EPS, 1 - EPS)


def log_area(x: Column) -> Column:
    """ln(1 + max(x, 0)), NULL for NULL."""
    return F.when(x.isNotNull(), F.log1p(F.greatest(x, F.lit(0.0))))


def total_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def mean_of(columns: list[Column]) -> Column:
    """Mean of the values that are there, in the order given; NULL if none is."""
    n = total_of([c.isNotNull().cast("int") for c in columns])
    return F.when(n > 0, total_of([F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns]) / n)


def missing_count(columns: list[Column]) -> Column:
    return total_of([c.isNull().cast("int") for c in columns])


def maybe(df: DataFrame, name: str, kind: str = "double") -> Column:
    """The column, or a NULL of that kind where the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def only(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that the table has, in that order, each once."""
    return df.select([c for c in dict.fromkeys(wanted) if c in df.columns])
