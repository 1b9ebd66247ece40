"""Number expressions.

Money is added up as whole smallest units in 64-bit integers. That is exact, so
a total does not depend on the order of the rows, and it stays in primitive
arithmetic where wide decimals would not. ANSI mode turns an overflow into an
error, and so is one amount of 2**53 units or more, which would not be exact.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill_rate(taken: Column, free: Column) -> Column:
    """Taken share of all places, null when there are no places."""
    return F.try_divide(taken.cast("double"), (taken + free).cast("double"))


def gross(price: Column, quantity: Column, tax: Column) -> Column:
    return price * quantity + tax


def net_line(quantity: Column, discount: Column, price: Column) -> Column:
    """Quantity times the discounted price."""
    return quantity * (F.lit(1) - discount.cast("double")) * price.cast("double")


def units(amount: Column, places: int = 2) -> Column:
    """An amount as a whole number of its smallest units; too large a one fails the job."""
    scaled = amount.cast("double") * float(10**places) + 0.5
    inexact = F.raise_error(F.lit("amount too large to add exactly")).cast("bigint")
    return F.when(F.abs(scaled) >= float(2**53), inexact).otherwise(F.floor(scaled))


def coarser(whole: Column, dropped: int = 2) -> Column:
    """Units with ``dropped`` places fewer, halves rounded away from zero."""
    step = 10**dropped
    nearest = F.floor((F.abs(whole) + step // 2) / F.lit(float(step)))
    return F.when(whole < 0, -nearest).otherwise(nearest)


def amount_of(whole: Column, places: int = 2) -> Column:
    """Units as a decimal amount."""
    one = F.lit(Decimal(1).scaleb(-places))
    return (whole.cast("decimal(20,0)") * one).cast(f"decimal(20,{places})")


def exact_sum(amount: Column, places: int = 2) -> Column:
    """Sum of amounts that have at most ``places`` decimals."""
    return amount_of(F.sum(units(amount, places)), places)


def cents_to_units(cents: Column) -> Column:
    """Cents as a decimal amount in the main unit."""
    return amount_of(cents).cast("decimal(18,2)")


def whole_percent(share: Column) -> Column:
    """A share as whole percent, the fraction cut off after exact conversion."""
    return (share.cast("decimal(10,4)") * F.lit(100)).cast("int")
