"""Column expressions shared by the operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Money is summed in two terms: the part that is a decimal with this many
# fraction digits, exactly, and what that leaves of each value as a double. For
# amounts of up to so many digits the second term is 0 and the sum does not
# depend on the order in which partial sums meet; finer, huge, infinite or NaN
# values keep their weight in the second term.
MONEY_SCALE = 3
MONEY_PRECISION = 28
MONEY_EXACT_BELOW = 1e15
REST = "_rest"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as a double; NULL when the denominator is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def ratio_or_zero(num: Column | str, den: Column | str) -> Column:
    """``num / den``, but 0.0 when the denominator is 0 (dashboard KPI strip)."""
    return F.coalesce(ratio(num, den), F.lit(0.0))


def flag_exact(c: Column | str) -> Column:
    """1 if the text is exactly ``Yes`` (case-sensitive, untrimmed), else 0.

    Written with a null-safe equality (never NULL), so a downstream
    ``flag == 1`` filter simplifies to ``c <=> 'Yes'`` and is pushed into the
    Parquet scan."""
    return F.when(_c(c).eqNullSafe(F.lit("Yes")), F.lit(1)).otherwise(F.lit(0))


def flag_ci(c: Column | str) -> Column:
    """1 if the lower-cased text is ``yes`` (untrimmed), else 0; NULL gives 0."""
    return F.when(F.lower(_c(c)) == F.lit("yes"), F.lit(1)).otherwise(F.lit(0))


def money_terms(c: Column | str, name: str = "_revenue", scale: int = MONEY_SCALE) -> list[Column]:
    """Aggregates ``name`` (exact decimal part) and ``name_rest`` (the remainder) of the sum of a money column."""
    value = _c(c).cast("double")
    exact = F.when(F.abs(value) < F.lit(MONEY_EXACT_BELOW), _c(c).try_cast(DecimalType(MONEY_PRECISION, scale)))
    rest = F.coalesce(value - exact.cast("double"), value)
    return [F.sum(exact).alias(name), F.sum(rest).alias(name + REST)]


def terms_sum(name: str = "_revenue") -> list[Column]:
    """Aggregates that add up the two terms of partial sums."""
    return [F.sum(name).alias(name), F.sum(name + REST).alias(name + REST)]


def money_value(name: str = "_revenue", over: WindowSpec | None = None) -> Column:
    """The double that the two terms stand for (summed over a window if given); NULL if there was no value."""
    exact, rest = F.col(name), F.col(name + REST)
    if over is not None:
        exact, rest = F.sum(exact).over(over), F.sum(rest).over(over)
    return F.coalesce(exact.cast("double"), F.lit(0.0)) + rest


def as_double(c: Column | str) -> Column:
    return _c(c).cast("double")


def bigint_sum(c: Column | str) -> Column:
    return F.sum(_c(c)).cast("long")


def day_diff(start: Column | str, end: Column | str) -> Column:
    """Whole days from ``start`` to ``end`` (end - start) as bigint."""
    return F.datediff(_c(end), _c(start)).cast("long")


def mean(c: Column | str) -> Column:
    """Average of an integral column as exact sum over count (NULLs skipped)."""
    return ratio(F.sum(_c(c)), F.count(_c(c)))


def pct_text(c: Column | str, digits: int = 2) -> Column:
    """``0.0682`` -> ``'6.82%'``."""
    return F.format_string(f"%.{digits}f%%", _c(c).cast("double") * F.lit(100.0))


def currency_text(c: Column | str, symbol: str = "\u20b9", digits: int = 0) -> Column:
    """Dashboard money: currency symbol, thousands separators, no decimals."""
    return F.concat(F.lit(symbol), F.format_number(_c(c).cast("double"), digits))


def money_text(c: Column | str, digits: int = 2) -> Column:
    """Thousands separators and fixed decimals: ``17016599.154`` -> ``'17,016,599.15'``."""
    return F.format_number(_c(c).cast("double"), digits)
