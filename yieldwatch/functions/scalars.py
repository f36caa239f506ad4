"""Derived customer columns: interactions, clipping, seasonal factor, risk scores."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed values of the table's columns: the guard against an empty denominator, months of a
# year, the centre and unit of credit scores, and the seasonal factors.
EPSILON = 1e-6
MONTHS = 12
SCORE_CENTRE, SCORE_UNIT = 700, 50
FACTOR_RETAIL, FACTOR_OTHER, FACTOR_NONE = 1.4, 1.2, 1.0


def volatility_stress(volatility: Column, stress: Column) -> Column:
    return volatility * stress


def rate_stress(rate: Column, stress: Column) -> Column:
    return rate * stress


def balance_vol_ratio(balance: Column, volatility: Column) -> Column:
    return F.try_divide(balance, volatility + F.lit(EPSILON))


def credit_age(credit_score: Column, age_months: Column) -> Column:
    return credit_score * (age_months / MONTHS)


def squared(x: Column) -> Column:
    return x * x


def credit_score_norm(credit_score: Column) -> Column:
    return (credit_score - SCORE_CENTRE) / SCORE_UNIT


def interactions(available: Iterable[str]) -> dict[str, Column]:
    """The interaction columns whose inputs are all in `available`, in table order."""
    c = F.col
    candidates = {
        "volatility_stress": (
            ("balance_volatility", "economic_stress"),
            lambda: volatility_stress(c("balance_volatility"), c("economic_stress")),
        ),
        "rate_stress": (
            ("interest_rate_level", "economic_stress"),
            lambda: rate_stress(c("interest_rate_level"), c("economic_stress")),
        ),
        "balance_vol_ratio": (
            ("base_balance", "balance_volatility"),
            lambda: balance_vol_ratio(c("base_balance"), c("balance_volatility")),
        ),
        "credit_age": (
            ("credit_score", "account_age_months"),
            lambda: credit_age(c("credit_score"), c("account_age_months")),
        ),
        "volatility_sq": (("balance_volatility",), lambda: squared(c("balance_volatility"))),
        "stress_sq": (("economic_stress",), lambda: squared(c("economic_stress"))),
        "credit_score_norm": (("credit_score",), lambda: credit_score_norm(c("credit_score"))),
    }
    have = set(available)
    return {name: build() for name, (needs, build) in candidates.items() if have.issuperset(needs)}


def clip(x: Column, low: float, high: float) -> Column:
    """Bound a column to [low, high]; NULL stays NULL."""
    return F.when(x < low, F.lit(float(low))).when(x > high, F.lit(float(high))).otherwise(x.cast("double"))


def null_if_nan(x: Column) -> Column:
    """NaN is a missing value here, so it becomes NULL before any aggregate sees it."""
    return F.when(~F.isnan(x), x)


def seasonal_factor(segment: Column, date: Column, retail: str = "Retail") -> Column:
    """1.4 for the retail segment and 1.2 for others in October-December, else 1.0."""
    fourth_quarter = F.quarter(date) == 4
    return (
        F.when(fourth_quarter & (segment == retail), F.lit(FACTOR_RETAIL))
        .when(fourth_quarter, F.lit(FACTOR_OTHER))
        .otherwise(F.lit(FACTOR_NONE))
    )


def _logistic(linear: Column) -> Column:
    return clip(1 / (1 + F.exp(-linear)), 0.0, 1.0)


def outflow_score(
    balance_volatility: Column,
    interest_rate_level: Column,
    economic_stress: Column,
    segment: Column,
    base_balance: Column,
    account_age_months: Column,
    retail: str = "Retail",
) -> Column:
    """Outflow probability from the fixed linear score; balance must be positive."""
    # The weights of the outflow score.
    return _logistic(
        F.lit(-2.5)
        + 1.5 * balance_volatility
        + 0.3 * (interest_rate_level - 2.5)
        + 2.0 * economic_stress
        + 0.5 * (segment == retail).cast("int")
        - 0.2 * F.ln(base_balance) / 10
        - 0.1 * account_age_months / 12
    )


def early_repayment_score(
    credit_score: Column,
    interest_rate_level: Column,
    economic_stress: Column,
    segment: Column,
    corporate: str = "Corporate",
) -> Column:
    """Early-repayment probability from the fixed linear score."""
    # The weights of the early-repayment score.
    return _logistic(
        F.lit(-3.0)
        + 0.01 * (credit_score - 700)
        - 0.4 * (interest_rate_level - 2.5)
        + 1.5 * economic_stress
        + 0.3 * (segment == corporate).cast("int")
    )
