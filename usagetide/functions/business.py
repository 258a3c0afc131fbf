"""Business labels, lookups and display strings as native column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, functions as F

from .numeric import as_col, ratio, round_to

# Labels and thresholds that results must reproduce.
TREATMENT_SCORE = 0.55
SEVERE_TTFT_MS = 400.0
ONBOARDING_LAST_DAY = 13
ALERT_THRESHOLD = 0.75
CRITICAL_THRESHOLD = 0.85
FRICTION_BUCKETS = ["Severe", "Mild", "None"]
DAY_BINS = [
    ("Days 0-14", 0, 14),
    ("Days 15-28", 14, 28),
    ("Days 29-42", 28, 42),
    ("Days 43-56", 42, 56),
    ("Days 57-70", 56, 70),
    ("Days 71-90", 70, 90),
]
DAY_BIN_LABELS = [label for label, _, _ in DAY_BINS]
RISK_TIERS = [("Low", 0.50), ("Medium", 0.75), ("High", 0.85), ("Critical", 1.01)]
ARR_BY_TIER = {"Enterprise": 120_000, "Growth": 24_000}
ARR_DEFAULT = 24_000


class Rule(NamedTuple):
    """One prescriptive rule; ``when`` is a SQL predicate on feature columns.

    NaN is above every number in Spark, so an input that may be NaN is made NULL first.
    """

    trigger: str
    when: str
    action: str
    owner: str


# Rule texts, in order of precedence.
RULES = [
    Rule(
        "High rate limit frequency",
        "count_429_onboarding >= 3",
        "Increase RPM quota — escalate to Solutions Engineering",
        "AE + SE",
    ),
    Rule(
        "High TTFT (latency)",
        "nanvl(avg_ttft_ms_onboarding, CAST(NULL AS DOUBLE)) >= 400",
        "Route to lower-latency deployment or regional endpoint",
        "Infra + AE",
    ),
    Rule(
        "Context window saturation",
        "nanvl(max_context_saturation_onboarding, CAST(NULL AS DOUBLE)) >= 0.90D",
        "Recommend upgrade to larger context model",
        "AE",
    ),
    Rule(
        "Elevated server error rate",
        "count_500_onboarding + count_503_onboarding >= 3",
        "Flag for infrastructure investigation",
        "Engineering",
    ),
    Rule(
        "Low prompt cache utilisation",
        "avg_cache_ratio_onboarding < 0.10D",
        "Proactive prompt caching workshop",
        "Customer Success",
    ),
]
DEFAULT_RULE = Rule("Declining velocity", "true", "Proactive check-in call — use-case review", "AE")


def first_true(branches: Sequence[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    """CASE expression over (condition, value) pairs, earlier pairs first."""
    (cond, value), *rest = branches
    case = reduce(lambda acc, pair: acc.when(*pair), rest, F.when(cond, value))
    return case if otherwise is None else case.otherwise(otherwise)


# ---------------------------------------------------------------- usage


def cache_ratio(cached: Column | str, total: Column | str) -> Column:
    return round_to(ratio(cached, total), 4)


def onboarding_flag(day: Column | str, signup: Column | str, last_day: int = ONBOARDING_LAST_DAY) -> Column:
    """True up to ``last_day`` days after signup; days before signup count too."""
    return F.coalesce(as_col(day) <= F.date_add(as_col(signup), last_day), F.lit(False))


def day_since_signup(day: Column | str, signup: Column | str) -> Column:
    return F.datediff(as_col(day), as_col(signup))


def pct_change(current: Column | str, previous: Column | str, digits: int = 2) -> Column:
    current, previous = as_col(current).cast("double"), as_col(previous).cast("double")
    return round_to(ratio(current - previous, previous) * 100.0, digits)


def rounded_ratio(numerator: Column | str, denominator: Column | str, digits: int = 4) -> Column:
    return round_to(ratio(numerator, denominator), digits)


def day_bin(day: Column | str) -> Column:
    """Left-closed day range label, NULL outside 0..89."""
    day = as_col(day)
    return first_true([((day >= low) & (day < high), F.lit(label)) for label, low, high in DAY_BINS])


# ------------------------------------------------------------- friction


def treatment_flag(score: Column | str, threshold: float = TREATMENT_SCORE) -> Column:
    return F.coalesce(as_col(score) >= F.lit(threshold), F.lit(False))


def friction_bucket(
    score: Column | str,
    ttft: Column | str,
    threshold: float = TREATMENT_SCORE,
    severe_ttft: float = SEVERE_TTFT_MS,
) -> Column:
    treated = treatment_flag(score, threshold)
    return first_true(
        [(treated & (as_col(ttft) >= F.lit(severe_ttft)), F.lit("Severe")), (treated, F.lit("Mild"))],
        F.lit("None"),
    )


# -------------------------------------------------------------- scoring


def risk_tier(probability: Column | str) -> Column:
    """Right-closed tiers: exactly 0.75 is still Medium."""
    probability = as_col(probability)
    branches = [(probability <= F.lit(top), F.lit(label)) for label, top in RISK_TIERS]
    return F.when(probability > F.lit(-0.01), first_true(branches))


def prescribe(rules: Sequence[Rule] = RULES, default: Rule = DEFAULT_RULE) -> Column:
    """Struct of trigger, action and owner of the first rule that holds."""

    def as_struct(rule: Rule) -> Column:
        return F.struct(
            F.lit(rule.trigger).alias("top_friction_trigger"),
            F.lit(rule.action).alias("recommended_action"),
            F.lit(rule.owner).alias("action_owner"),
        )

    branches = [(F.coalesce(F.expr(rule.when), F.lit(False)), as_struct(rule)) for rule in rules]
    return first_true(branches, as_struct(default)) if branches else as_struct(default)


def arr_value(
    tier: Column | str,
    values: Mapping[str, int] = ARR_BY_TIER,
    default: int | None = ARR_DEFAULT,
) -> Column:
    """Yearly value of a contract tier; ``default=None`` leaves unknown tiers NULL."""
    tier = as_col(tier)
    branches = [(tier == name, F.lit(int(value)).cast("long")) for name, value in values.items()]
    return first_true(branches, F.lit(default).cast("long"))


# -------------------------------------------------------------- display


def risk_badge(score: Column | str) -> Column:
    score = as_col(score)
    mark = first_true(
        [(score >= CRITICAL_THRESHOLD, F.lit("🔴")), (score >= ALERT_THRESHOLD, F.lit("🟠"))],
        F.lit("🟡"),
    )
    return F.concat(mark, F.lit(" "), F.format_string("%.2f", score))


def milliseconds_text(value: Column | str) -> Column:
    return F.concat(F.rint(as_col(value)).cast("long").cast("string"), F.lit(" ms"))


def money_text(value: Column | str) -> Column:
    return F.concat(F.lit("$"), F.format_number(as_col(value), 0))


def account_label(name: Column | str, score: Column | str, tier: Column | str) -> Column:
    return F.format_string("%s  (%.2f risk · %s)", as_col(name), as_col(score), as_col(tier))


def risk_level(score: Column | str) -> Column:
    """Level shown on an account card; left-closed, unlike ``risk_tier``."""
    score = as_col(score)
    return first_true(
        [(score >= CRITICAL_THRESHOLD, F.lit("Critical")), (score >= ALERT_THRESHOLD, F.lit("High"))],
        F.lit("Medium"),
    )
