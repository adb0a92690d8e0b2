"""Currency text and money columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY_TYPE = "decimal(18,2)"


def _number(text: Column) -> Column:
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast(MONEY_TYPE))


def parse_money(col: str | Column) -> Column:
    """``$1,234.56`` -> decimal; anything that is no number -> null."""
    text = F.col(col) if isinstance(col, str) else col
    return _number(F.trim(F.translate(text.cast("string"), "$,", "")))


def parse_money_or_zero(col: str | Column, negative_parens: bool = False) -> Column:
    """As :func:`parse_money`, with parentheses stripped and every failure counted as 0.

    By default ``(5.00)`` gives 5.00; ``negative_parens`` reads it as -5.00.
    """
    text = F.trim((F.col(col) if isinstance(col, str) else col).cast("string"))
    value = _number(F.trim(F.translate(text, "$,()", "")))
    if negative_parens:
        value = F.when(text.rlike(r"^\(.*\)$"), -value).otherwise(value)
    return F.coalesce(value, F.lit(0)).cast(MONEY_TYPE)


def ledger_amount(col: str | Column) -> Column:
    """Ledger cell: ``$``, ``,`` and spaces stripped; ``-``, blank and bad text are 0."""
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.coalesce(_number(F.regexp_replace(text, r"[$,\s]", "")), F.lit(0)).cast(MONEY_TYPE)


def money_sum(col: str | Column, where: Column | None = None) -> Column:
    """Sum where no row or only nulls gives 0, optionally over the rows that satisfy ``where``."""
    if isinstance(col, str) and where is None:
        return F.expr(f"coalesce(sum(`{col}`), 0)")
    value = F.col(col) if isinstance(col, str) else col
    if where is not None:
        value = F.when(where, value)
    return F.coalesce(F.sum(value), F.lit(0))


def ratio(numerator: str | Column, denominator: str | Column, factor: float = 1.0) -> Column:
    """Unrounded double ratio; null when the denominator is 0 or null."""
    if isinstance(numerator, str) and isinstance(denominator, str):
        return F.expr(_ratio_sql(numerator, denominator, factor))
    num = (F.col(numerator) if isinstance(numerator, str) else numerator).cast("double")
    den = (F.col(denominator) if isinstance(denominator, str) else denominator).cast("double")
    value = F.try_divide(num, den)
    return value * F.lit(factor) if factor != 1.0 else value


def _ratio_sql(numerator: str, denominator: str, factor: float) -> str:
    value = f"try_divide(cast(`{numerator}` as double), cast(`{denominator}` as double))"
    return f"{value} * {factor}D" if factor != 1.0 else value


def _round_sql(value: str, digits: int) -> str:
    scale = f"{float(10**digits)}D"
    up = f"cast(floor(({value}) * {scale} + 0.5D) as double) / {scale}"
    down = f"cast(-floor(-({value}) * {scale} + 0.5D) as double) / {scale}"
    return f"case when ({value}) < 0 then {down} else {up} end"


def round_half_away(value: Column, digits: int = 2) -> Column:
    """Round a double half away from zero in plain arithmetic, equal in every engine."""
    scale = float(10**digits)
    up = F.floor(value * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)
    down = -(F.floor(-value * F.lit(scale) + F.lit(0.5))).cast("double") / F.lit(scale)
    return F.when(value < 0, down).otherwise(up)


def rounded_ratio(numerator: str, denominator: str, digits: int = 2, factor: float = 1.0) -> Column:
    """Rounded ratio of two named columns; null when the denominator is 0 or null."""
    return F.expr(_round_sql(_ratio_sql(numerator, denominator, factor), digits))


def pct(numerator: str | Column, denominator: str | Column, digits: int = 2) -> Column:
    """Rounded percentage; null when the denominator is 0 or null."""
    if isinstance(numerator, str) and isinstance(denominator, str):
        return rounded_ratio(numerator, denominator, digits, 100.0)
    return round_half_away(ratio(numerator, denominator, 100.0), digits)


def as_double(df: DataFrame) -> DataFrame:
    """Money out: every decimal column as double, for export and for charting tools."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if f.dataType.typeName() == "decimal"
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
