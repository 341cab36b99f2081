"""Score and label ladders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from amihan.params import AmlParams

# Points per customer type, nationality and account status.
CUSTOMER_TYPE_POINTS = {
    "CORPORATE": 20,
    "INDIVIDUAL": 30,
    "SOLEPROPRIETOR": 35,
    "NGO": 10,
    "GOVERNMENT": 5,
}
CUSTOMER_TYPE_OTHER = 25
BLACKLIST_NATIONALITIES = ("KP", "IR", "SY")
GREYLIST_NATIONALITIES = ("BY", "JO", "LB", "PA", "TR", "ZA")
NATIONALITY_POINTS = (90, 50, 10)
ACCOUNT_STATUS_POINTS = {
    "FROZEN": 30,
    "RESTRICTED": 25,
    "DORMANT": 15,
    "ACTIVE": 0,
    "CLOSED": 0,
}
ACCOUNT_STATUS_OTHER = 10
# KYC score limits with their points, and points above them.
KYC_POINTS = ((60, 40), (80, 25), (90, 15))
KYC_POINTS_ABOVE = 5
# Years until the KYC data of a tier must be refreshed.
REFRESH_YEARS = {"HIGH": 1, "MEDIUM": 3, "LOW": 5}


def lookup(value: Column, points: Mapping[str, int], other: int) -> Column:
    """Points by value; ``other`` for unknown values and NULL."""
    table = F.create_map(*[F.lit(x) for pair in points.items() for x in pair])
    return F.coalesce(F.try_element_at(table, value), F.lit(other))


def first_match(ladder: Sequence[tuple[Column, object]], other: object) -> Column:
    """The value of the first true step; a NULL condition is not true."""
    (condition, value), *rest = ladder
    out = F.when(condition, F.lit(value))
    for condition, value in rest:
        out = out.when(condition, F.lit(value))
    return out.otherwise(F.lit(other))


def customer_type_points(customer_type: Column) -> Column:
    return lookup(customer_type, CUSTOMER_TYPE_POINTS, CUSTOMER_TYPE_OTHER)


def geography_points(nationality: Column) -> Column:
    black, grey, other = NATIONALITY_POINTS
    return first_match(
        [
            (nationality.isin(*BLACKLIST_NATIONALITIES), black),
            (nationality.isin(*GREYLIST_NATIONALITIES), grey),
        ],
        other,
    )


def kyc_points(score: Column) -> Column:
    return first_match([(score < limit, points) for limit, points in KYC_POINTS], KYC_POINTS_ABOVE)


def account_status_points(status: Column) -> Column:
    return lookup(status, ACCOUNT_STATUS_POINTS, ACCOUNT_STATUS_OTHER)


def watchlist_points(confirmed: Column, confidence: Column, hits: Column) -> Column:
    return first_match([(confirmed > 0, 50), (confidence > 75, 40), (confidence > 50, 20), (hits > 0, 15)], 0)


def tier_label(score: Column, params: AmlParams) -> Column:
    """HIGH / MEDIUM / LOW from a score."""
    return first_match([(score >= params.high_tier_from, "HIGH"), (score >= params.medium_tier_from, "MEDIUM")], "LOW")


def refresh_due(last_update: Column, tier: Column) -> Column:
    """The day KYC data must be refreshed; any tier but HIGH and MEDIUM has the longest term."""
    years = lookup(tier, REFRESH_YEARS, REFRESH_YEARS["LOW"])
    return F.add_months(last_update, years * 12)


def refresh_overdue(last_update: Column, tier: Column, today: Column) -> Column:
    """True when the last update lies before the tier's term; FALSE for NULL or an unknown tier."""
    late = [
        (tier == name) & (last_update < F.add_months(today, -12 * years)) for name, years in REFRESH_YEARS.items()
    ]
    return F.coalesce(late[0] | late[1] | late[2], F.lit(False))


def filing_urgency(days_left: Column) -> Column:
    """Due today counts as overdue; an unknown deadline is pending."""
    return first_match([(days_left <= 0, "OVERDUE"), (days_left <= 2, "DUE_SOON")], "PENDING")


def confidence_label(indicators: Column) -> Column:
    return first_match([(indicators >= 3, "HIGH"), (indicators >= 2, "MEDIUM")], "LOW")
