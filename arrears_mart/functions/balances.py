"""Balances, payments and who collects them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrears_mart.functions.text import blank_to_null
from arrears_mart.schemas import AGE_LABELS_CAMPAIGN, MONEY


def _or_zero(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0)).cast(MONEY)


def final_balance(debt: Column, paid: Column) -> Column:
    """Debt minus payments, missing amounts counting as zero; may be negative."""
    return (_or_zero(debt) - _or_zero(paid)).cast(MONEY)


def updated_balance(debt: Column, paid: Column, reported: Column) -> Column:
    """The reported balance, or debt minus payments without one; never below zero."""
    return F.greatest(F.coalesce(reported, final_balance(debt, paid)), F.lit(0)).cast(MONEY)


def payments(debt: Column, paid: Column, reported: Column) -> Column:
    """What the reported balance says was paid, or the portfolio's payments without one."""
    implied = F.greatest(_or_zero(debt) - updated_balance(debt, paid, reported), F.lit(0))
    return F.when(reported.isNotNull(), implied).otherwise(_or_zero(paid)).cast(MONEY)


def is_overpaid(reported: Column) -> Column:
    return F.coalesce(reported < 0, F.lit(False))


def collector(age: Column, from_portfolio: Column, from_zone: Column) -> Column:
    """Accounts of the newest campaign keep the portfolio's collector, others the zone's; each backs the other."""
    own, zonal = blank_to_null(from_portfolio), blank_to_null(from_zone)
    return F.coalesce(F.when(age == AGE_LABELS_CAMPAIGN[0], own).otherwise(zonal), zonal, own)


def is_expired(end_date: Column, run_date: Column, age: Column, paid: Column) -> Column:
    """Validity over before the run date, except unpaid accounts one campaign old; never null."""
    over = F.coalesce(end_date < run_date, F.lit(False))
    spared = F.coalesce((age == AGE_LABELS_CAMPAIGN[1]) & (_or_zero(paid) <= 0), F.lit(False))
    return over & ~spared
