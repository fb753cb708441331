"""Amounts and unit counts. Money is ``decimal(18,2)`` so that sums do not depend
on the order of the rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.schema import MONEY

SUM = T.DecimalType(MONEY.precision + 10, MONEY.scale)  # the type of a sum of MONEY


def discounted_amount(units: Column, price: Column, discount_pct: Column) -> Column:
    """units x price less a discount in whole percent, to the cent."""
    percent_paid = (F.lit(100) - discount_pct).cast(T.DecimalType(3, 0))
    return (
        units.cast(T.DecimalType(10, 0)) * price * percent_paid * F.lit(Decimal("0.01"))
    ).cast(MONEY)


def cents(amount: Column) -> Column:
    """An amount in whole cents."""
    return F.round(amount * 100).cast("long")


def from_cents(cents: Column, money: T.DecimalType = MONEY) -> Column:
    return (cents.cast(T.DecimalType(20, 0)) * F.lit(Decimal("0.01"))).cast(money)


def discounted_cents(units: Column, unit_cents: Column, discount_pct: Column) -> Column:
    """The same in whole cents, half a cent rounded away from zero. Integers stay
    in machine words, which makes long sums much cheaper than decimal ones."""
    hundredths = units.cast("long") * unit_cents * (F.lit(100) - discount_pct)
    half = F.when(hundredths < 0, F.lit(-50)).otherwise(F.lit(50))
    return F.call_function("div", hundredths + half, F.lit(100).cast("long"))


def total(df: DataFrame, name: str) -> Column:
    """Exact sum of an amount over rows, from ``<name>_cents`` if the table has it,
    else from the decimal column ``<name>_amount``.

    Either way whole cents are added, in a 64-bit buffer: several times cheaper
    than decimal sums, and good for 90,000 million million per group. Beyond that
    Spark's default (ANSI) mode stops with an error rather than wrap around.
    """
    if f"{name}_cents" in df.columns:
        whole = F.col(f"{name}_cents")
    else:
        whole = (F.col(f"{name}_amount") * 100).cast("long")
    return from_cents(F.sum(whole), SUM)


def promoted_discount(promotion_flag: Column, discount_pct: Column) -> Column:
    """The discount of a promoted line, 0 of any other."""
    return F.when(promotion_flag == 1, discount_pct).otherwise(0)


def at_least(value: Column, bound: int) -> Column:
    """``value``, but never below ``bound``; null stays null."""
    return F.when(value < bound, F.lit(bound)).otherwise(value)


def adjusted_units(units: Column, *factors: Column) -> Column:
    """Units scaled by factors, rounded half to even, at least one."""
    scaled = units.cast("double")
    for factor in factors:
        scaled = scaled * factor
    return at_least(F.rint(scaled).cast("int"), 1)


def money_as_double(df: DataFrame) -> DataFrame:
    """Every decimal column as a double, nulls kept: the form handed to readers
    that know no decimals."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])
