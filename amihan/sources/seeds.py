"""Seed tables: small lists that the detections and marts look up.

The lists below are the defaults.  A deployment may keep its own CSV files
in shared storage and pass their folder as ``root``.
"""

from __future__ import annotations

import csv
import io
from dataclasses import dataclass
from datetime import date
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from amihan.schemas import SEEDS


# ---------------------------------------------------------------------------
# The seed lists as CSV text (empty = NULL).
# ---------------------------------------------------------------------------

PH_BRANCHES = """\
branch_code,branch_name,region_name,city_municipality,province
MKT001,Manila Corporate Center,National Capital Region,Manila,Metro Manila
MKT002,Makati Ayala Avenue Branch,National Capital Region,Makati,Metro Manila
MKT003,Quezon City Eastwood Branch,National Capital Region,Quezon City,Metro Manila
MKT004,Pasig Ortigas Center Branch,National Capital Region,Pasig,Metro Manila
MKT005,Caloocan 10th Avenue Branch,National Capital Region,Caloocan,Metro Manila
MKT006,Taguig BGC Branch,National Capital Region,Taguig,Metro Manila
MKT007,San Juan Greenhills Branch,National Capital Region,San Juan,Metro Manila
CEB001,Cebu IT Park Branch,Central Visayas,Cebu City,Cebu
CEB002,Mandaue A.S. Fortuna Branch,Central Visayas,Mandaue,Cebu
CEB003,Lapu-Lapu Mactan Branch,Central Visayas,Lapu-Lapu,Cebu
CEB004,Bohol Panglao Branch,Central Visayas,Panglao,Bohol
CEB005,Dumaguete Rizal Boulevard Branch,Central Visayas,Dumaguete City,Negros Oriental
DVO001,Davao J.P. Laurel Branch,Davao Region,Davao City,Davao del Sur
DVO002,Tagum City Branch,Davao Region,Tagum,Davao del Norte
DVO003,Panabo Branch,Davao Region,Panabo City,Davao del Norte
DVO004,Digos Branch,Davao Region,Digos,Davao del Sur
CDO001,Cagayan de Oro Centrio Mall Branch,Northern Mindanao,Cagayan de Oro,Misamis Oriental
CDO002,Iligan City Branch,Northern Mindanao,Iligan City,Lanao del Norte
CDO003,Malaybalay City Branch,Northern Mindanao,Malaybalay,Bukidnon
ILO001,Iloilo Diversion Road Branch,Western Visayas,Iloilo City,Iloilo
ILO002,Bacolod Lacson Street Branch,Western Visayas,Bacolod,Negros Occidental
ILO003,Kalibo Branch,Western Visayas,Kalibo,Aklan
LEG001,Legazpi Albay Branch,Bicol Region,Legazpi City,Albay
LEG002,Naga City Branch,Bicol Region,Naga City,Camarines Sur
PUA001,Dagupan City Branch,Ilocos Region,Dagupan City,Pangasinan
PUA002,San Fernando La Union Branch,Ilocos Region,San Fernando City,La Union
TUG001,Tuguegarao Main Branch,Cagayan Valley,Tuguegarao,Cagayan
TUG002,Bontoc Branch,Cordillera Administrative Region,Bontoc,Mountain Province
BAG001,Baguio Session Road Branch,Cordillera Administrative Region,Baguio,Benguet
VIG001,Vigan Heritage Village Branch,Ilocos Region,Vigan City,Ilocos Sur
TAC001,Tacloban City Branch,Eastern Visayas,Tacloban City,Leyte
ORM001,Ormoc Branch,Eastern Visayas,Ormoc City,Leyte
LEZ001,Leyte Branch,Eastern Visayas,Baybay,Leyte
SAM001,Samal Island Branch,Davao Region,Panabo City,Davao del Norte
PAG001,Panglao Branch,Central Visayas,Panglao,Bohol
ZAM001,Zamboanga City Branch,Zamboanga Peninsula,Zamboanga City,Zamboanga del Sur
"""

FATF_JURISDICTIONS = """\
iso2_code,country_name,fatf_list_type,inclusion_date,removal_date
KP,North Korea,BLACKLIST,2016-06-24,
IR,Iran,BLACKLIST,2015-02-28,
SY,Syria,BLACKLIST,2013-06-20,
BY,Belarus,GREYLIST,2020-06-25,
JO,Jordan,GREYLIST,2018-06-22,
LB,Lebanon,GREYLIST,2019-06-21,
PA,Panama,GREYLIST,2015-06-26,2016-05-27
TR,Turkey,GREYLIST,2020-06-25,
ZA,South Africa,GREYLIST,2018-06-22,
"""

AML_RISK_WEIGHTS = """\
risk_category,risk_subcategory,weight_value,description
GEOGRAPHY,FATF_BLACKLIST,90,Transactions to/from FATF blacklisted countries
GEOGRAPHY,FATF_GREYLIST,60,Transactions to/from FATF greylisted countries
GEOGRAPHY,OFFSHORE_FINANCIAL_CENTER,75,Transactions involving offshore financial centers
GEOGRAPHY,HIGH_RISK_REGION,45,Transactions involving regions known for AML concerns
GEOGRAPHY,MEDIUM_RISK_REGION,25,Transactions involving moderately rated jurisdictions
GEOGRAPHY,LOW_RISK_REGION,10,Transactions with established compliance frameworks
GEOGRAPHY,NON_COOPERATIVE_JURISDICTION,65,Transactions involving jurisdictions with limited AML oversight
PRODUCT,CASH,45,Cash transactions - high AML risk
PRODUCT,WIRE_TRANSFER,35,International wire transfers
PRODUCT,REMITTANCE,38,Remittance products often abused for ML/TF
PRODUCT,DEPOSIT,15,Regular deposit products
PRODUCT,INVESTMENT,22,Investment products and securities
PRODUCT,PREPAID_CARDS,30,Prepaid or stored-value instruments
PRODUCT,LOAN,28,Loan disbursement or repayment transactions
PRODUCT,TRADE_FINANCE,40,Trade finance and documentary credits
PRODUCT,CRYPTOCURRENCY,55,Virtual asset transactions with higher anonymity
PRODUCT,REAL_ESTATE,45,Real estate-related transactions
PRODUCT,INSURANCE_PREMIUM,32,Insurance premium payments and surrender values
PRODUCT,BANK_GUARANTEE,30,Bank guarantees and letters of credit
PRODUCT,FOREX_EXCHANGE,27,Foreign currency exchange and remittance
CHANNEL,BRANCH,12,In-branch transactions
CHANNEL,ATM,10,ATM withdrawals and deposits
CHANNEL,ONLINE,18,Online banking channels
CHANNEL,MOBILE,15,Mobile banking channels
CHANNEL,CALL_CENTER,20,Call center or telephone banking
CHANNEL,CASH_AGENT,35,Cash agent or remittance partner networks
CHANNEL,CORRESPONDENT_BANKING,50,Correspondent banking relationships
CHANNEL,THIRD_PARTY_PAYMENT,42,Third-party payment processors and wallets
CHANNEL,AGENT_BANKING,38,Agent banking and cash-in/cash-out services
CUSTOMER_TYPE,CORPORATE,30,Corporate customers
CUSTOMER_TYPE,INDIVIDUAL,25,Individual customers
CUSTOMER_TYPE,SOLEPROPRIETOR,38,Sole proprietor businesses
CUSTOMER_TYPE,NGO,18,Non-profit or NGO organizations
CUSTOMER_TYPE,GOVERNMENT,10,Government agencies
CUSTOMER_TYPE,NON_RESIDENT,45,Non-resident customers
CUSTOMER_TYPE,FOREIGN_ENTITY,50,Foreign entity customers
CUSTOMER_TYPE,SHELL_COMPANY,65,Shell companies with limited economic substance
CUSTOMER_TYPE,TRUST,55,Trusts and fiduciary arrangements
CUSTOMER_TYPE,PARTNERSHIP,28,Partnership business entities
CUSTOMER_BEHAVIOR,SUDDEN_INCREASE,48,Sudden large increase in transaction activity
CUSTOMER_BEHAVIOR,STRUCTURING,52,Structuring transactions just below thresholds
CUSTOMER_BEHAVIOR,UNUSUAL_LOCATION,40,Transactions from unusual locations or jurisdictions
CUSTOMER_BEHAVIOR,RAPID_MOVEMENTS,45,Rapid transfer of funds between multiple accounts
CUSTOMER_BEHAVIOR,INCONSISTENT_KYC,50,Customer details inconsistent with KYC records
CUSTOMER_BEHAVIOR,MULTIPLE_ACCOUNTS,35,Multiple accounts under same customer with overlapping activity
CUSTOMER_BEHAVIOR,HIGH_VALUE_TRANSFER,55,Very large one-time or infrequent transfers
TRANSACTION_AMOUNT,BELOW_THRESHOLD,10,Transactions below reporting thresholds
TRANSACTION_AMOUNT,NEAR_THRESHOLD,30,Transactions just below monitoring/reporting thresholds
TRANSACTION_AMOUNT,ABOVE_THRESHOLD,50,Transactions above high-value thresholds
TRANSACTION_AMOUNT,VERY_HIGH_AMOUNT,70,Very large transactions requiring enhanced review
ONBOARDING_RISK,HIGH_RISK_BUSINESS,48,High-risk business line or industry
ONBOARDING_RISK,LOW_RISK_BUSINESS,8,Low-risk business type
ONBOARDING_RISK,UNKNOWN_SOURCE_OF_FUNDS,60,Customer cannot verify source of funds
ONBOARDING_RISK,POOR_DOCUMENTATION,55,Incomplete or poor quality onboarding documentation
ONBOARDING_RISK,UNVERIFIED_ADDRESS,45,Address cannot be verified or is suspicious
ONBOARDING_RISK,CASH_INTENSIVE_BUSINESS,50,Cash-intensive customers or industries
DOCUMENTATION,INCOMPLETE_KYC,50,KYC documentation is incomplete or insufficient
DOCUMENTATION,NO_SOURCE_OF_FUNDS,60,No verifiable source of funds provided
DOCUMENTATION,EXPIRED_ID,35,Customer identification documents are expired
DOCUMENTATION,POORLY_RECORDED,30,Documentation contains errors or inconsistencies
ACTIVITY_PATTERN,INACTIVE_ACCOUNT,20,Long-dormant account reactivated with activity
ACTIVITY_PATTERN,RAPID_REACTIVATION,42,Account opened and immediately used for high-risk transactions
ACTIVITY_PATTERN,FREQUENT_CHANNEL_SWITCH,35,Frequent switching between channels without clear reason
ACTIVITY_PATTERN,CONSISTENT_SUSPICIOUS,58,Repeated suspicious behavior across transactions
PEP,PEP_CUSTOMER,80,Politically exposed person flag
PEP,PEP_RELATIVE,65,Close relatives of PEP
PEP,PEP_ASSOCIATE,55,Known associates of PEP
PEP,PEP_FORMER,52,Former politically exposed persons
PEP,PEP_DOMESTIC,70,Domestic politically exposed persons
PEP,PEP_FOREIGN,75,Foreign politically exposed persons
"""

PH_NON_WORKING_DAYS = """\
calendar_date,holiday_name,holiday_type
2025-01-01,New Year's Day,REGULAR_HOLIDAY
2025-02-10,EDSA Revolution Anniversary,REGULAR_HOLIDAY
2025-02-11,Day after EDSA Revolution,SPECIAL_NON_WORKING
2025-02-25,ARAW NG KAGITINGAN,REGULAR_HOLIDAY
2025-03-28,Maundy Thursday,REGULAR_HOLIDAY
2025-03-29,Good Friday,REGULAR_HOLIDAY
2025-03-30,Black Saturday,REGULAR_HOLIDAY
2025-03-31,Easter Sunday,REGULAR_HOLIDAY
2025-04-09,Araw ng Kagitingan,REGULAR_HOLIDAY
2025-04-12,Additional Special Day,SPECIAL_NON_WORKING
2025-06-12,Independence Day,REGULAR_HOLIDAY
2025-08-21,Ninoy Aquino Day,REGULAR_HOLIDAY
2025-08-25,National Heroes Day,REGULAR_HOLIDAY
2025-11-01,All Saints' Day,REGULAR_HOLIDAY
2025-11-30,Bonifacio Day,REGULAR_HOLIDAY
2025-12-08,Feast of the Immaculate Conception,REGULAR_HOLIDAY
2025-12-25,Christmas Day,REGULAR_HOLIDAY
2025-12-26,Additional Special Day,SPECIAL_NON_WORKING
2025-12-30,Rizal Day Observance,REGULAR_HOLIDAY
2025-12-31,New Year's Eve,SPECIAL_NON_WORKING
2026-01-01,New Year's Day,REGULAR_HOLIDAY
2026-02-09,EDSA Revolution Anniversary,REGULAR_HOLIDAY
2026-02-10,Day after EDSA Revolution,SPECIAL_NON_WORKING
2026-02-25,ARAW NG KAGITINGAN,REGULAR_HOLIDAY
2026-04-09,Araw ng Kagitingan,REGULAR_HOLIDAY
2026-04-10,Good Friday,REGULAR_HOLIDAY
2026-04-11,Black Saturday,REGULAR_HOLIDAY
2026-04-12,Easter Sunday,REGULAR_HOLIDAY
2026-06-12,Independence Day,REGULAR_HOLIDAY
2026-08-21,Ninoy Aquino Day,REGULAR_HOLIDAY
2026-08-24,National Heroes Day,REGULAR_HOLIDAY
2026-11-01,All Saints' Day,REGULAR_HOLIDAY
2026-11-30,Bonifacio Day,REGULAR_HOLIDAY
2026-12-08,Feast of the Immaculate Conception,REGULAR_HOLIDAY
2026-12-25,Christmas Day,REGULAR_HOLIDAY
2026-12-30,Rizal Day Observance,REGULAR_HOLIDAY
2026-12-31,New Year's Eve,SPECIAL_NON_WORKING
"""

STR_INDICATORS_REF = """\
indicator_code,indicator_name,indicator_category,description,base_risk_score,bsp_circular_ref
STRUCT_01,Cash structuring below PHP 500k,STRUCTURING,Multiple sub-threshold cash transactions in 7-day window summing >= PHP 450k,70,BSP Circ 706 Annex A
LAYER_01,Rapid in-out fund movement,LAYERING,Funds credited then debited within 48 hours net position < 10% of gross,65,BSP Circ 706 Annex A
DORMANCY_01,Dormant account sudden large credit,DORMANCY,Account inactive for 90+ days receives credit >= PHP 100000 in single transaction,60,BSP Circ 706 Annex A
JURIS_01,Transaction to/from FATF blacklisted jurisdiction,JURISDICTION,SWIFT/remittance to or from FATF blacklisted country - automatic high-risk flag,90,BSP Circ 706 Part IV
JURIS_02,Transaction to/from FATF greylisted jurisdiction,JURISDICTION,SWIFT/remittance to or from FATF greylisted country - enhanced monitoring required,50,BSP Circ 706 Part IV
ROUND_01,Round number transaction (possible smurfing),ROUND_NUMBER,Transaction amount is exact round number (500k 1M 5M) with no apparent business reason,30,BSP Circ 706 Annex A
PEP_01,PEP-linked transaction above PHP 50000,PEP,Transaction involving politically exposed person or close associate exceeds PHP 50000,75,BSP Circ 706 Part III
PATTERN_01,Multiple depositors to single beneficiary (smurfing),PATTERN,Three or more different depositors sending to same beneficiary account within 3 banking days,80,BSP Circ 706 Annex A
UNUSUAL_01,Unusual cash deposit vs customer profile,PATTERN,Large cash deposit inconsistent with customer's historical transaction patterns,55,BSP Circ 706 Annex A
"""


TEXTS = {
    "ph_branches": PH_BRANCHES,
    "fatf_jurisdictions": FATF_JURISDICTIONS,
    "aml_risk_weights": AML_RISK_WEIGHTS,
    "ph_non_working_days": PH_NON_WORKING_DAYS,
    "str_indicators_ref": STR_INDICATORS_REF,
}
#: Holds the text of a line that does not fit the declared columns.
BAD_LINE = "_corrupt_record"


def write_seed_files(spark: SparkSession, root: str) -> None:
    """The default lists as CSV files below a shared folder, to be edited there."""
    for name, text in TEXTS.items():
        lines = spark.createDataFrame([(text.rstrip("\n"),)], "value string")
        # One value that holds all lines of a list kept by hand: one file, in order.
        lines.write.mode("overwrite").text(f"{root.rstrip('/')}/{name}.csv")


def scan_seed_file(spark: SparkSession, name: str, root: str) -> DataFrame:
    """The lines of a seed file by its declared types, in ``_corrupt_record`` those that don't fit them.

    A missing trailing column is a bad line too.
    """
    schema = T.StructType([*SEEDS[name].fields, T.StructField(BAD_LINE, T.StringType())])
    options = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    return spark.read.schema(schema).options(**options).csv(f"{root.rstrip('/')}/{name}.csv")


def _fits(name: str, good: bool) -> Column:
    """Whether a scanned line fits; the second half is then always true.

    It names every column, and so has every value parsed: a line's bad date
    counts even where only its name is read.
    """
    line = F.col(BAD_LINE)
    values = F.concat_ws(",", *[F.col(c).cast("string") for c in SEEDS[name].fieldNames()])
    if good:
        return line.isNull() & (F.coalesce(line, values) == values)
    return line.isNotNull() & (F.length(values) >= 0)


def bad_seed_lines(spark: SparkSession, root: str) -> DataFrame:
    """(seed, line) of every line of the seed files that does not fit its declared columns."""
    parts = [
        scan_seed_file(spark, name, root).where(_fits(name, good=False)).select(F.lit(name).alias("seed"), F.col(BAD_LINE).alias("line"))
        for name in SEEDS
    ]
    return reduce(DataFrame.unionByName, parts)


def read_seed(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """One seed table with its declared types; lines of a file that don't fit them are left out.

    The default lists become a local relation, whose size Catalyst knows, so
    joins with them are broadcast by its own size check.
    """
    schema = SEEDS[name]
    if root is not None:
        return scan_seed_file(spark, name, root).where(_fits(name, good=True)).drop(BAD_LINE)
    rows = list(csv.DictReader(io.StringIO(TEXTS[name])))
    texts = pa.table({f.name: pa.array([r.get(f.name) or None for r in rows], pa.string()) for f in schema})
    return spark.createDataFrame(texts.cast(to_arrow_schema(schema)))


def listed_rows(df: DataFrame) -> list:
    """The rows of a reference list that is kept by hand and does not grow with the data; whatever its length."""
    return df.collect()


@dataclass(frozen=True)
class Jurisdiction:
    iso2_code: str
    country_name: str | None
    fatf_list_type: str | None
    removal_date: date | None = None


@dataclass(frozen=True)
class Seeds:
    """The seed tables of a run, and the two lists that become literals."""

    branches: DataFrame
    weights: DataFrame
    indicators: DataFrame
    non_working_days: DataFrame
    fatf: DataFrame
    holidays: tuple[date, ...]
    jurisdictions: tuple[Jurisdiction, ...]


def load_seeds(spark: SparkSession, root: str | None = None) -> Seeds:
    days = read_seed(spark, "ph_non_working_days", root)
    fatf = read_seed(spark, "fatf_jurisdictions", root)
    listed = fatf.filter(F.col("iso2_code").isNotNull()).select(
        "iso2_code", "country_name", "fatf_list_type", "removal_date"
    )
    return Seeds(
        branches=read_seed(spark, "ph_branches", root),
        weights=read_seed(spark, "aml_risk_weights", root),
        indicators=read_seed(spark, "str_indicators_ref", root),
        non_working_days=days,
        fatf=fatf,
        holidays=tuple(
            r[0] for r in listed_rows(days.select("calendar_date").filter("calendar_date is not null").distinct())
        ),
        jurisdictions=tuple(Jurisdiction(*r) for r in listed_rows(listed)),
    )
