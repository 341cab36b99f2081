"""The tables a registered query works on, each built when first asked for."""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from amihan.operators import bronze
from amihan.operators.candidates import int_str_candidates
from amihan.operators.ctr import int_ctr_candidates
from amihan.operators.kyc import int_kyc_health
from amihan.operators.layering import int_layering_detection
from amihan.operators.risk import int_customer_risk_rating
from amihan.operators.structuring import int_structuring_detection
from amihan.plans import dimensions, facts
from amihan.sources import star
from amihan.sources.seeds import Seeds, load_seeds


class Lake:
    """Landing tables derived from one star-schema folder, and all that follows."""

    params = star.STAR_PARAMS

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def params_at(self, **changes):
        return replace(self.params, **changes)

    @cached_property
    def seeds(self) -> Seeds:
        return load_seeds(self.spark)

    @cached_property
    def raw_transactions(self) -> DataFrame:
        return star.raw_transactions(self.spark, self.sf_dir)

    @cached_property
    def raw_customers(self) -> DataFrame:
        return star.raw_customers(self.spark, self.sf_dir)

    @cached_property
    def raw_kyc_documents(self) -> DataFrame:
        return star.raw_kyc_documents(self.spark, self.sf_dir)

    @cached_property
    def raw_watchlist_screening(self) -> DataFrame:
        return star.raw_watchlist_screening(self.spark, self.sf_dir)

    @cached_property
    def transactions(self) -> DataFrame:
        return bronze.stg_transactions(self.raw_transactions, self.params)

    @cached_property
    def history(self) -> DataFrame:
        """Transactions on their own dates, which span years."""
        return bronze.stg_transactions(star.raw_transactions(self.spark, self.sf_dir, folded=False), self.params)

    @cached_property
    def customers(self) -> DataFrame:
        return bronze.stg_customers(self.raw_customers, self.params)

    @cached_property
    def documents(self) -> DataFrame:
        return bronze.stg_kyc_documents(self.raw_kyc_documents, self.params)

    @cached_property
    def screening(self) -> DataFrame:
        return bronze.stg_watchlist(self.raw_watchlist_screening, self.params)

    @property
    def bronze(self) -> dict[str, DataFrame]:
        return {
            "stg_transactions": self.transactions,
            "stg_customers": self.customers,
            "stg_kyc_documents": self.documents,
            "stg_watchlist": self.screening,
        }

    @property
    def landing(self) -> dict[str, DataFrame]:
        return {
            "raw_transactions": self.raw_transactions,
            "raw_customers": self.raw_customers,
            "raw_kyc_documents": self.raw_kyc_documents,
            "raw_watchlist_screening": self.raw_watchlist_screening,
        }

    @cached_property
    def ctr(self) -> DataFrame:
        return int_ctr_candidates(self.transactions, self.params)

    @cached_property
    def structuring(self) -> DataFrame:
        return int_structuring_detection(self.transactions, self.params)

    @cached_property
    def layering(self) -> DataFrame:
        return int_layering_detection(self.transactions, self.params)

    @cached_property
    def kyc(self) -> DataFrame:
        return int_kyc_health(self.customers, self.documents, self.params)

    @cached_property
    def risk(self) -> DataFrame:
        return int_customer_risk_rating(self.customers, self.kyc, self.screening, self.seeds.weights, self.params)

    @cached_property
    def candidates(self) -> DataFrame:
        return int_str_candidates(self.transactions, self.customers, self.seeds, self.params)

    @cached_property
    def branches(self) -> DataFrame:
        return dimensions.dim_branches(self.seeds.branches, self.params)

    @cached_property
    def calendar(self) -> DataFrame:
        return dimensions.dim_date(self.spark, self.params, self.seeds.holidays)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dimensions.dim_customers(self.customers, self.risk, self.params)

    @cached_property
    def covered(self) -> DataFrame:
        return facts.fct_covered_transactions(
            self.ctr, self.branches, self.calendar, self.seeds.holidays, self.params
        )

    @cached_property
    def suspicious(self) -> DataFrame:
        return facts.fct_suspicious_transactions(
            self.candidates, self.transactions, self.seeds.indicators, self.seeds.holidays, self.params
        )

    @cached_property
    def compliance(self) -> DataFrame:
        return facts.fct_customer_compliance(
            self.customers, self.kyc, self.risk, self.covered, self.suspicious, self.params
        )

    @cached_property
    def branch_summary(self) -> DataFrame:
        return facts.fct_branch_compliance_summary(
            self.branches, self.compliance, self.covered, self.suspicious, self.params
        )


_LAKES: WeakKeyDictionary[SparkSession, dict[str, Lake]] = WeakKeyDictionary()


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake of a session and folder, built once: its tables are plans, not data."""
    return _LAKES.setdefault(spark, {}).setdefault(sf_dir, Lake(spark, sf_dir))
