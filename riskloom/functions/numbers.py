"""Numeric expressions shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType


# Shifts and odd factors below 2^31 of the rounds that mix a 32-bit word.
MIXING = ((16, 1540483477), (15, 1103515245), (16, 668265263))
WORD = 0xFFFFFFFF


def round_half_even(col: Column, digits: int) -> Column:
    """Scale, round to the even neighbour, scale back: the rounding of numeric array libraries."""
    scale = float(10**digits)
    return F.rint(col * scale) / scale


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Ratio as double, 0 when the denominator is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def percent_rate(part: Column, total: Column, digits: int = 3) -> Column:
    """``part / total`` in percent, rounded; 0 for an empty group."""
    return round_half_even(safe_ratio(part, total) * 100, digits)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def value_bins(name: str) -> dict[str, Column]:
    """Two bin columns ``_b1, _b2`` whose order follows the numeric order of a double column.

    ``_b1`` holds sign, binary exponent and 6 bits of the mantissa: under 300,000 values over all doubles.
    ``_b2`` holds 30 bits of the mantissa: under 2^24 values per ``_b1``, and at most 2^22 different
    doubles share both. These bounds need no statistics and hold for any distribution.
    """
    # the logarithm is off by one beside some powers of two; the quotient tells, and is exact
    guess = f"floor(log2(abs({name})))"
    quotient = f"(abs({name}) / pow(2D, {guess}))"
    exponent = f"({guess} + CASE WHEN {quotient} < 1D THEN -1 WHEN {quotient} >= 2D THEN 1 ELSE 0 END)"
    mantissa = f"(abs({name}) / pow(2D, {exponent}) - 1D)"
    side = f"if({name} < 0, -1, 1)"
    edge = f"isnan({name}) OR abs({name}) = double('infinity')"
    # coalesce makes the bins non-null, so that joins on them add no filter which the optimizer would
    # evaluate on every row below the aggregate
    return {
        "_b1": F.expr(
            f"""coalesce(CASE WHEN {name} = 0 THEN 0L WHEN {edge} THEN {side} * 1000000L
                ELSE {side} * ({exponent} * 64 + floor({mantissa} * 64D) + 100000L) END, 0L)"""
        ),
        "_b2": F.expr(
            f"""coalesce(CASE WHEN {name} = 0 OR {edge} THEN 0L
                ELSE {side} * floor({mantissa} * 1073741824D) END, 0L)"""
        ),
    }


def sample_hash(df: DataFrame, row_id: str, seed: int = 42) -> Column:
    """A number in [0, 2^32) that spreads row ids; another seed gives an unrelated order.

    Both halves of the id and the seed are mixed by shifts, exclusive or and multiplications below 2^63,
    so any SQL engine gives the same value. Ids that are no integers, such as text, are hashed to one first.
    """
    integral = isinstance(df.schema[row_id].dataType, IntegralType)
    number = F.col(row_id).cast("long") if integral else F.xxhash64(row_id)

    def round_of(word: Column, shift: int, factor: int) -> Column:
        return (word.bitwiseXOR(F.shiftright(word, shift)) * F.lit(factor)).bitwiseAND(F.lit(WORD))

    upper = F.shiftright(number, 32).bitwiseAND(F.lit(WORD)).bitwiseXOR(F.lit(seed_word(seed)))
    mixed = number.bitwiseAND(F.lit(WORD)).bitwiseXOR(round_of(upper, *MIXING[-1]))
    for shift, factor in MIXING:
        mixed = round_of(mixed, shift, factor)
    return mixed.bitwiseXOR(F.shiftright(mixed, 16))


def seed_word(seed: int) -> int:
    """32 bits for a seed, far apart for seeds that are close."""
    return (seed * 2654435761 + 374761393) & WORD
