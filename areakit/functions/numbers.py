"""Exact money means.

Means are taken over whole millionths, so no addition ever rounds and the result does
not depend on the order in which partitions arrive. A sum of them is kept as two
integers (high and low bits): neither can overflow at any realistic row count,
and both are plain long additions inside hash aggregation.

Amounts, weights and conditions are SQL expressions over the frame's columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1_000_000
_LOW_BITS = 20
_LOW_MASK = (1 << _LOW_BITS) - 1
# Fractions are compared as integers of this many bits; 100 times one still fits
# in a long.
_FRACTION_BITS = 56
_FRACTION = 1 << _FRACTION_BITS


def cents(amount: str) -> str:
    """An amount of at most two decimals as whole cents."""
    return f"CAST(rint(CAST({amount} AS DOUBLE) * 100) AS BIGINT)"


def units(amount: str) -> str:
    """An amount as whole millionths; null if it is not finite or beyond 9e12."""
    value = f"CAST({amount} AS DOUBLE)"
    return f"CASE WHEN abs({value}) < 9e12D THEN CAST(rint({value} * {SCALE}D) AS BIGINT) END"


def finite(value: Column) -> Column:
    """A double, or null where it is NaN or infinite."""
    return F.when(F.abs(value) < float("inf"), value)


def high_bits(value: str) -> str:
    return f"shiftright({value}, {_LOW_BITS})"


def low_bits(value: str) -> str:
    return f"({value} & {_LOW_MASK}L)"


def mean_parts(amount: str, prefix: str, where: str | None = None) -> list[Column]:
    """Aggregates ``<prefix>_hi, _lo, _n`` from which a mean can be finished later."""
    value = units(amount)
    if where is not None:
        value = f"CASE WHEN {where} THEN {value} END"
    return [
        F.expr(f"sum({high_bits(value)}) AS {prefix}_hi"),
        F.expr(f"sum({low_bits(value)}) AS {prefix}_lo"),
        F.expr(f"count({value}) AS {prefix}_n"),
    ]


def weighted_parts(amount: str, weight: str, prefix: str) -> list[Column]:
    """Like :func:`mean_parts` for rows that stand for ``weight`` equal rows."""
    value = units(amount)
    return [
        F.expr(f"sum({high_bits(value)} * {weight}) AS {prefix}_hi"),
        F.expr(f"sum({low_bits(value)} * {weight}) AS {prefix}_lo"),
        F.expr(f"sum(CASE WHEN {value} IS NOT NULL THEN {weight} END) AS {prefix}_n"),
    ]


def merge_parts(prefix: str) -> list[Column]:
    """Aggregates that add up parts made by the functions above."""
    return [F.expr(f"sum({prefix}_{p}) AS {prefix}_{p}") for p in ("hi", "lo", "n")]


def finish_means(df: DataFrame, means: dict[str, str]) -> DataFrame:
    """Replace merged parts by their two-decimal means (``prefix`` -> column name).

    Null where nothing was counted.
    """
    parts = {f"{p}_{part}" for p in means for part in ("hi", "lo", "n")}
    exact = [
        f"CASE WHEN {p}_n > 0 THEN "
        f"(CAST({p}_hi AS DOUBLE) * {1 << _LOW_BITS}D + {p}_lo) / {SCALE}D / {p}_n END AS `{name}`"
        for p, name in means.items()
    ]
    kept = [f"`{c}`" for c in df.columns if c not in parts]
    return with_two_decimals(df.selectExpr(*kept, *exact), list(means.values()))


def with_two_decimals(df: DataFrame, columns: list[str]) -> DataFrame:
    """Round double columns to two decimals by their exact binary value.

    This is what printing with two decimals does: 2.675 is stored a little below
    that and gives 2.67; 0.125 is stored exactly and goes to the even 0.12. The
    built-in ``round`` works on the shortest decimal text instead and gives 2.68
    and 0.13. Exact from 1/16 up (smaller values have finer bits than compared).

    The scaled fraction gets a column of its own first, as it is used repeatedly.
    """

    def scaled(c: str) -> str:
        fraction = f"(abs(`{c}`) - floor(abs(`{c}`)))"
        return f"CAST({fraction} * {float(_FRACTION)!r}D AS BIGINT) * 100 AS `_scaled_{c}`"

    def rounded(c: str) -> str:
        hundredths = f"shiftright(`_scaled_{c}`, {_FRACTION_BITS})"
        rest = f"(`_scaled_{c}` & {_FRACTION - 1}L)"
        half = f"{_FRACTION // 2}L"
        up = f"({rest} > {half} OR ({rest} = {half} AND {hundredths} & 1L = 1))"
        units = f"floor(abs(`{c}`)) * 100 + {hundredths} + CASE WHEN {up} THEN 1 ELSE 0 END"
        return f"signum(`{c}`) * (({units}) / 100D) + 0D AS `{c}`"

    with_scaled = df.selectExpr("*", *(scaled(c) for c in columns))
    return with_scaled.selectExpr(
        *(rounded(c) if c in columns else f"`{c}`" for c in df.columns)
    )
