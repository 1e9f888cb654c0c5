"""Data-quality rules for taxi trips, as Spark Column predicates.

A trip survives cleaning only when every rule evaluates to TRUE; FALSE and
NULL both reject it (Spark's ``filter`` semantics).  Rules are plain Column
expressions so Catalyst can push the simple conjuncts into the parquet scan
and compile the rest into the same whole-stage-codegen span as the scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference's cleaning rules exactly.
# ---------------------------------------------------------------------------
EXCLUDED_LOCATIONS = (264, 265)  # "unknown" / "outside NYC" zones
ACCEPTED_PAYMENT_TYPES = (1, 2)  # credit card, cash
KNOWN_RATE_CODES = (1, 2, 3, 4, 5)
MTA_TAX_VALUES = (0.0, 0.5)
CONGESTION_VALUES = (0.0, 2.5)
CBD_FEE_VALUES = (0.0, 0.75)
IMPROVEMENT_VALUES = (0.0, 1.0)

# Per rate code, the fee conditions that must all hold: (column, test, value).
RATE_CONDITIONS: dict[int, tuple[tuple[str, str, object], ...]] = {
    1: (
        ("improvement_surcharge", "==", 1.0),
        ("mta_tax", "in", MTA_TAX_VALUES),
        ("congestion_surcharge", "in", CONGESTION_VALUES),
        ("fare_amount", ">=", 3.0),
        ("cbd_congestion_fee", "in", CBD_FEE_VALUES),
    ),
    2: (
        ("Airport_fee", ">=", 0.0),
        ("mta_tax", "in", MTA_TAX_VALUES),
        ("improvement_surcharge", "in", IMPROVEMENT_VALUES),
        ("congestion_surcharge", "in", CONGESTION_VALUES),
        ("cbd_congestion_fee", "in", CBD_FEE_VALUES),
    ),
    3: (
        ("fare_amount", ">=", 0.0),
        ("improvement_surcharge", ">=", 0.0),
    ),
    4: (
        ("mta_tax", "==", 0.5),
        ("improvement_surcharge", "==", 1.0),
        ("congestion_surcharge", "in", CONGESTION_VALUES),
        ("cbd_congestion_fee", "in", CBD_FEE_VALUES),
    ),
    5: (
        ("mta_tax", "in", MTA_TAX_VALUES),
        ("improvement_surcharge", "==", 1.0),
        ("congestion_surcharge", "in", CONGESTION_VALUES),
        ("cbd_congestion_fee", "in", CBD_FEE_VALUES),
    ),
}

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"


@dataclass(frozen=True)
class Rule:
    """One named check; ``predicate`` is TRUE for rows that pass."""

    rule_id: str
    name: str
    predicate: Column

    @property
    def label(self) -> str:
        return f"{self.rule_id}_{self.name}"


def all_of(predicates: Iterable[Column]) -> Column:
    """AND of the predicates (TRUE for an empty list)."""
    preds = list(predicates)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def _condition(column: str, test: str, value: object) -> Column:
    c = F.col(column)
    if test == "==":
        return c == F.lit(value)
    if test == ">=":
        return c >= F.lit(value)
    if test == "in":
        return c.isin(list(value))  # type: ignore[arg-type]
    raise ValueError(f"unknown test {test!r}")


def global_rules(excluded_locations: Iterable[int] = EXCLUDED_LOCATIONS) -> list[Rule]:
    """Rules F1–F10: locations, timestamps, amounts and payment type."""
    excluded = list(excluded_locations)
    pu, do = F.col("PULocationID"), F.col("DOLocationID")
    return [
        Rule("F01", "pickup_location_present", pu.isNotNull() & (pu != 0)),
        Rule("F02", "dropoff_location_present", do.isNotNull() & (do != 0)),
        Rule("F03", "pickup_location_known", ~pu.isin(excluded)),
        Rule("F04", "dropoff_location_known", ~do.isin(excluded)),
        Rule("F05", "pickup_time_present", F.col(PICKUP).isNotNull()),
        Rule("F06", "dropoff_time_present", F.col(DROPOFF).isNotNull()),
        Rule("F07", "dropoff_after_pickup", F.col(DROPOFF) > F.col(PICKUP)),
        Rule("F08", "total_amount_positive", F.col("total_amount") > 0),
        Rule("F09", "trip_distance_not_negative", F.col("trip_distance") >= 0),
        Rule("F10", "payment_type_accepted", F.col("payment_type").isin(list(ACCEPTED_PAYMENT_TYPES))),
    ]


def rate_branch(code: int) -> Column:
    """Fee conditions of one rate code (rules F12–F16)."""
    return all_of(_condition(*cond) for cond in RATE_CONDITIONS[code])


def rate_rule() -> Column:
    """Rules F11–F17: known rate code, then that code's fee conditions.

    Unknown codes fall through to FALSE (F17).  A NULL fee fails the branch
    it belongs to, exactly like the comparison it feeds.
    """
    rate = F.col("RatecodeID")
    chain = None
    for code in KNOWN_RATE_CODES:
        cond, value = rate == code, rate_branch(code)
        chain = F.when(cond, value) if chain is None else chain.when(cond, value)
    return rate.isin(list(KNOWN_RATE_CODES)) & chain.otherwise(F.lit(False))


def rate_rules() -> list[Rule]:
    """F11–F16 as separately named rules, for reject reporting."""
    rate = F.col("RatecodeID")
    rules = [Rule("F11", "rate_code_known", rate.isin(list(KNOWN_RATE_CODES)))]
    for code in KNOWN_RATE_CODES:
        # Only meaningful for rows of this code; other rows pass the check.
        rules.append(Rule(f"F{11 + code}", f"rate_{code}_fees", (rate != code) | rate_branch(code)))
    return rules


def global_predicate(excluded_locations: Iterable[int] = EXCLUDED_LOCATIONS) -> Column:
    return all_of(r.predicate for r in global_rules(excluded_locations))


def clean_predicate(excluded_locations: Iterable[int] = EXCLUDED_LOCATIONS) -> Column:
    """Everything a silver row has to satisfy (F1–F17)."""
    return global_predicate(excluded_locations) & rate_rule()


def first_failed_rule(excluded_locations: Iterable[int] = EXCLUDED_LOCATIONS) -> Column:
    """Label of the first rule that is not TRUE for the row, NULL if it passes."""
    rules = global_rules(excluded_locations) + rate_rules()
    chain = None
    for rule in rules:
        failed = ~F.coalesce(rule.predicate, F.lit(False))
        chain = F.when(failed, rule.label) if chain is None else chain.when(failed, rule.label)
    return chain


def after_watermark(column: str, watermark: object) -> Column:
    """strictly newer than the high-water mark (a literal, so it is pushed down)."""
    return F.col(column) > F.lit(watermark)
