"""Rounding, division, unit and NaN helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerocell.schemas import KNOTS_PER_MPS


def cents(value: Column) -> Column:
    """:func:`round2` of a value known to lie in [0, 1e9)."""
    millionths = F.rint(value * F.lit(1e6))
    return F.floor((millionths + F.lit(5000.0)) / F.lit(10000.0)) / F.lit(100.0)


def round2(value: Column) -> Column:
    """Two decimals, half away from zero on the value's six-decimal form.

    Six decimals first: that absorbs the noise a distributed sum leaves in the
    last bits, so the result does not depend on the order of partial sums. It
    equals rounding through decimals, for values of any size.
    """
    return F.round(F.round(value, 6), 2)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Division that yields null when the denominator is zero."""
    return F.try_divide(numerator, denominator)


def to_knots(mps: Column) -> Column:
    return mps * F.lit(KNOTS_PER_MPS)


def to_kb(size: Column) -> Column:
    return round2(size.cast("double") / F.lit(1024.0))


def to_mb(size: Column) -> Column:
    return round2(size.cast("double") / F.lit(1048576.0))


def without_nan(value: Column) -> Column:
    """NaN becomes null; the type stays."""
    return F.when(~F.isnan(value), value)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every floating column.

    Spark orders NaN above every number, so it must go before any comparison.
    """
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floating:
        return df
    return df.withColumns({name: without_nan(F.col(name)) for name in floating})
