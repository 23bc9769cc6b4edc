"""Reusable column expressions (ratios, yes-flags, exact money sums, dates, formatting)."""

from .expr import (
    as_double,
    bigint_sum,
    currency_text,
    day_diff,
    flag_ci,
    flag_exact,
    mean,
    money_terms,
    money_text,
    money_value,
    pct_text,
    ratio,
    ratio_or_zero,
    terms_sum,
)

__all__ = [
    "as_double",
    "bigint_sum",
    "currency_text",
    "day_diff",
    "flag_ci",
    "flag_exact",
    "mean",
    "money_terms",
    "money_text",
    "money_value",
    "pct_text",
    "ratio",
    "ratio_or_zero",
    "terms_sum",
]
