"""Campaign codes and the account/campaign key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrears_mart.functions.text import digits_only, strip
from arrears_mart.schemas import AGE_LABELS_CAMPAIGN

# A code with at least this many digits carries its year.
_DIGITS_WITH_YEAR = 5


def campaign_number(campaign: Column) -> Column:
    return digits_only(campaign).try_cast("bigint")


def campaign_last2(campaign: Column) -> Column:
    """Last two digits of a campaign, `''` for a missing one: at most 111 different values."""
    return F.coalesce(F.substring(digits_only(campaign), -2, 2), F.lit(""))


def year_of_digits(digits: Column) -> Column:
    """Year part of the digits of a campaign that carries one, else null."""
    return F.when(F.length(digits) >= _DIGITS_WITH_YEAR, F.left(digits, F.length(digits) - 2))


def normal_of_digits(digits: Column, reference_year: int) -> Column:
    """Year and two-digit number; digits without a year get the reference year; no digits is null."""
    year = F.coalesce(year_of_digits(digits), F.lit(str(reference_year)))
    return F.when(digits != "", F.concat(year, F.lpad(F.substring(digits, -2, 2), 2, "0")))


def campaign_year(campaign: Column) -> Column:
    return year_of_digits(digits_only(campaign)).try_cast("bigint")


def normalise_campaign(campaign: Column, reference_year: int) -> Column:
    return normal_of_digits(digits_only(campaign), reference_year)


def account_campaign_key(account: Column, campaign: Column) -> Column:
    return F.concat(strip(account), F.lit("-"), campaign_last2(campaign))


def age_by_campaign(campaign: Column, newest: Column) -> Column:
    """Label of the distance between a campaign and the newest one; the last label is open-ended."""
    distance = newest - campaign_number(campaign)
    *exact, oldest = AGE_LABELS_CAMPAIGN
    label = F.when(distance >= len(exact), oldest)
    for steps, name in enumerate(exact):
        label = label.when(distance == steps, name)
    return label
