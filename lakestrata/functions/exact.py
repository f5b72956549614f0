"""Sums and averages of doubles that do not depend on the order of addition.

A distributed ``sum(double)`` changes its last digits with the order in which partitions
arrive, so a rounded money total can flip by a cent between two runs. Here every value is
turned into whole millionths and, below them, whole millionths of a millionth; these integers
are added and rounded half-up once per group, by one rule for totals of any size.

Per row everything stays BIGINT, in generated code: the millionths are added in three limbs of
21 bits, which cannot overflow below 2**34 rows per group. Finished groups are put together as
DECIMAL. A double is read as the number it is written as: one division shows whether six digits
after the point say it all, and only other values and broken ones of 9e9 or more take the slower way
through DECIMAL, which rounds to twelve digits.

Infinities, NaN and values of 9e12 or more are added as plain doubles beside the others, so any double is
taken: infinities and NaN decide the result as they do in a plain sum, and large values that cancel out leave
the exact total of the others. Where a group holds three or more different values of 9e12 and more, the last of
the result's sixteen digits can depend on the order of rows. Adding those exactly too was tried with DECIMAL limbs
and left out: it made every sum twice as slow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import as_column

UNIT_DIGITS = 6
REST_DIGITS = 6
# below it a value's millionths are fewer than 2**53, so a double holds them
_SURE = 9e9
_EXACT = 9e12
_LIMB_BITS = 21


def _whole(number: int) -> Column:
    return F.lit(str(number)).cast(f"decimal({len(str(number))},0)")


def _parts(x: Column) -> tuple[Column, Column]:
    """Whole millionths of a value and the millionths of a millionth beside them; NULL unless it is below ``_EXACT``."""
    size, point = F.abs(x), F.lit(10.0**UNIT_DIGITS)
    scaled = F.rint(F.when(size < F.lit(_EXACT), x * point))
    units = scaled.cast("long")
    written = x.cast("decimal(31,12)") - units.cast("decimal(19,0)") * F.lit("0.000001").cast("decimal(6,6)")
    rest = (
        F.when((scaled / point == x) & (size < F.lit(_SURE)), F.lit(0).cast("long"))
        # the product of a large whole number may have been rounded
        .when(scaled.isNotNull() & (F.rint(x) == x), (x.cast("long") * F.lit(10**UNIT_DIGITS) - units) * F.lit(10**REST_DIGITS))
        .when(scaled.isNotNull(), (written * _whole(10 ** (UNIT_DIGITS + REST_DIGITS))).cast("long"))
    )
    return units, rest


def _shifted(x: Column, digits: int) -> Column:
    """The double nearest to ``x`` with its point moved ``digits`` to the left.

    It goes by text, which is rounded once; a plain cast of a DECIMAL may divide two doubles and round twice.
    """
    moved = x * F.lit(f"{10**-digits:.{digits}f}").cast(f"decimal({max(digits, 1)},{digits})")
    return moved.cast("string").cast("double")


def _half_up(units: Column, rest: Column, parts: Column, digits: int) -> Column:
    """``(units + rest millionths) / parts`` (DECIMAL whole numbers) rounded half-up to ``digits``."""
    total = (units * _whole(10**REST_DIGITS) + rest).cast("decimal(38,0)")
    step = (parts.cast("decimal(20,0)") * _whole(10 ** (UNIT_DIGITS + REST_DIGITS - digits))).cast("decimal(37,0)")
    double = (F.abs(total) * 2 + step).cast("decimal(38,0)")
    size = _shifted(((double - double % (step * 2)) / (step * 2)).cast("decimal(32,0)"), digits)
    return F.when(total < 0, -size).otherwise(size)


def _combine(x: Column, parts: Column, digits: int) -> Column:
    units, rest = _parts(x)
    mask = F.lit((1 << _LIMB_BITS) - 1).cast("long")
    limbs = [units.bitwiseAND(mask), F.shiftright(units, _LIMB_BITS).bitwiseAND(mask), F.shiftright(units, 2 * _LIMB_BITS)]
    low, middle, high = [F.sum(limb).cast("decimal(19,0)") for limb in limbs]
    total = high * _whole(1 << 2 * _LIMB_BITS) + middle * _whole(1 << _LIMB_BITS) + low
    exact = _half_up(total, F.sum(rest).cast("decimal(19,0)"), parts, digits)
    beyond = F.sum(F.when(~(F.abs(x) < F.lit(_EXACT)), x))
    return F.when(beyond.isNull(), exact).otherwise(beyond / parts + F.coalesce(exact, F.lit(0.0)))


def _double(x: Column | str) -> Column:
    return as_column(x).cast("double")


def sum_rounded(x: Column | str, digits: int = 2) -> Column:
    """Exact sum rounded to ``digits``; NULL when every value is NULL."""
    return _combine(_double(x), F.lit(1), digits)


def avg_rounded(x: Column | str, digits: int = 2) -> Column:
    """Exact mean of the non-NULL values rounded to ``digits``; NULL when there is none."""
    value = _double(x)
    return _combine(value, F.greatest(F.count(value), F.lit(1)), digits)


def round_half_up(x: Column | str, digits: int) -> Column:
    """Row-wise rounding with the same rule as the aggregates; values of 9e15 and more have nothing to round."""
    value = _double(x)
    small = F.abs(value) < F.lit(9e15)
    exact = F.round(F.when(small, value).cast("decimal(33,12)"), digits)
    return F.when(small, exact.cast("string").cast("double")).otherwise(value)
