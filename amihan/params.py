"""Run parameters: every threshold, score and clock reading of a run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
from zoneinfo import ZoneInfo

MANILA = "Asia/Manila"


@dataclass(frozen=True)
class AmlParams:
    """Parameters of one run.

    ``as_of`` and ``run_ts`` take the place of the wall clock, so that a run
    can be repeated and compared.
    """

    as_of: date
    run_ts: datetime

    # Thresholds (PHP), window lengths (days) and scores.
    ctr_php_threshold: int = 500_000
    ctr_forex_threshold_usd: int = 10_000
    php_per_usd: int = 56
    structuring_days: int = 7
    structuring_min_count: int = 3
    structuring_min_sum: int = 450_000
    structuring_max_single: int = 490_000
    structuring_reference_sum: int = 500_000
    structuring_score: int = 70
    layering_days: int = 2
    layering_min_leg: int = 50_000
    layering_max_net_ratio: Decimal = Decimal("0.10")
    layering_score: int = 65
    velocity_days: int = 90
    velocity_factor: int = 2
    pep_min_amount: int = 50_000
    pep_signal_score: int = 75
    blacklist_score: int = 90
    greylist_score: int = 50
    round_amounts: tuple[int, ...] = (50_000, 100_000, 500_000, 1_000_000, 5_000_000)
    round_score: int = 30
    pep_default_weight: int = 75
    high_tier_from: int = 75
    medium_tier_from: int = 50
    ctr_deadline_days: int = 1
    str_deadline_days: int = 5
    kyc_exception_below: int = 80
    branch_kyc_exceptions_above: int = 5
    retention_years: int = 10
    dormancy_days: int = 90
    dormancy_min_credit: int = 100_000
    smurfing_min_depositors: int = 3
    smurfing_banking_days: int = 3
    masked_role: str = "metabase_amlc_user"

    def __post_init__(self) -> None:
        if self.run_ts.tzinfo is None:
            object.__setattr__(self, "run_ts", self.run_ts.replace(tzinfo=timezone.utc))

    @property
    def run_micros(self) -> int:
        """The run instant in microseconds since the epoch."""
        epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
        return (self.run_ts - epoch) // timedelta(microseconds=1)

    @property
    def run_manila(self) -> str:
        """The run instant as Manila wall-clock text."""
        return self.run_ts.astimezone(ZoneInfo(MANILA)).strftime("%Y-%m-%d %H:%M:%S.%f")

    @property
    def year_start(self) -> date:
        return date(self.as_of.year, 1, 1)

    @property
    def next_year_start(self) -> date:
        return date(self.as_of.year + 1, 1, 1)
