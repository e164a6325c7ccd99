"""Tier and discount rules in four interchangeable forms.

* native Column expressions (``CASE WHEN`` / map lookup) -- the default,
  evaluated inside whole-stage codegen;
* plain Python functions (the rule applied to one value);
* Spark UDFs wrapping those functions (row-at-a-time, or Arrow-batched);
* a pandas UDF for the discount amount and SQL functions for SQL text.

All of them read the same :class:`cartwheel.config.TierRule` tables, and
all send NULL/NaN input to the rule's default tier.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from cartwheel.config import DISCOUNT_RATES, SPEND_TIERS, UNKNOWN_TIER_RATE, TierRule


# ----------------------------------------------------------------- native
def tier_column(value: Column | str, rule: TierRule = SPEND_TIERS) -> Column:
    """``CASE WHEN value >= t1 THEN l1 ... ELSE default END``.

    ``nanvl`` turns NaN into NULL first (Spark orders NaN above every
    number, which would otherwise land NaN in the top tier)."""
    v = F.col(value) if isinstance(value, str) else value
    v = F.nanvl(v.cast("double"), F.lit(None).cast("double"))
    expr = None
    for label, threshold in rule.tiers:
        cond = v >= threshold if rule.inclusive else v > threshold
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(rule.default) if expr is not None else F.lit(rule.default)


def rate_column(tier: Column | str, rates: dict[str, float] | None = None) -> Column:
    """Rate for a tier label; unknown or NULL labels get ``UNKNOWN_TIER_RATE``."""
    t = F.col(tier) if isinstance(tier, str) else tier
    rates = DISCOUNT_RATES if rates is None else rates
    expr = None
    for label, rate in rates.items():
        expr = F.when(t == label, float(rate)) if expr is None else expr.when(t == label, float(rate))
    return F.lit(float(UNKNOWN_TIER_RATE)) if expr is None else expr.otherwise(float(UNKNOWN_TIER_RATE))


def discount_amount_column(spend: Column | str, tier: Column | str,
                           rates: dict[str, float] | None = None) -> Column:
    s = F.col(spend) if isinstance(spend, str) else spend
    return s.cast("double") * rate_column(tier, rates)


# ----------------------------------------------------------------- python
# The functions below build self-contained closures over plain data (labels,
# thresholds, a rate dict). Spark ships them to Python workers by value, so
# executors need no copy of this package on their path.
def tier_function(rule: TierRule = SPEND_TIERS):
    """The rule as a plain Python function of one value (NULL/NaN -> default)."""
    tiers = tuple((str(label), float(threshold)) for label, threshold in rule.tiers)
    default, inclusive = str(rule.default), bool(rule.inclusive)

    def discount_tier(value):
        if value is None:
            return default
        x = float(value)
        if x != x:  # NaN
            return default
        for label, threshold in tiers:
            if (x >= threshold) if inclusive else (x > threshold):
                return label
        return default

    return discount_tier


def tier_of(value, rule: TierRule = SPEND_TIERS) -> str:
    """The rule on one Python value (NULL/NaN -> default)."""
    return tier_function(rule)(value)


def discount_amount_function(rates: dict[str, float] | None = None):
    """Vectorised ``spend * rate(tier)`` over pandas Series; unknown tiers
    get the unknown rate; spend is coerced to float64 (SQL callers may pass
    decimals)."""
    table = {str(k): float(v) for k, v in (DISCOUNT_RATES if rates is None else rates).items()}
    unknown = float(UNKNOWN_TIER_RATE)

    def amounts(spend, tier):
        return spend.astype("float64") * tier.map(table).fillna(unknown).astype("float64")

    return amounts


def discount_amounts(spend: pd.Series, tier: pd.Series,
                     rates: dict[str, float] | None = None) -> pd.Series:
    return discount_amount_function(rates)(spend, tier)


# ------------------------------------------------------------------- UDFs
def tier_udf(rule: TierRule = SPEND_TIERS, use_arrow: bool = False):
    """Row-at-a-time Python UDF (``BatchEvalPython``); with ``use_arrow`` the
    rows travel in Arrow batches (``ArrowEvalPython``)."""
    return F.udf(tier_function(rule), "string", useArrow=use_arrow)


def discount_amount_pandas_udf(rates: dict[str, float] | None = None):
    """Vectorised UDF over Arrow batches: ``(double, string) -> double``."""
    amounts = discount_amount_function(rates)

    def calculate_discount_amount(spend: pd.Series, tier: pd.Series) -> pd.Series:
        return amounts(spend, tier)

    return F.pandas_udf(calculate_discount_amount, "double")


def register_python_functions(spark: SparkSession, rule: TierRule = SPEND_TIERS,
                              rates: dict[str, float] | None = None) -> None:
    """Register the Python twins by name for SQL text (session lifetime,
    re-registering replaces)."""
    spark.udf.register("discount_tier_py", tier_udf(rule))
    spark.udf.register("calculate_discount_amount", discount_amount_pandas_udf(rates))


def _sql_literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def tier_case_sql(arg: str, rule: TierRule) -> str:
    op = ">=" if rule.inclusive else ">"
    whens = " ".join(f"WHEN {arg} {op} {t!r} THEN {_sql_literal(lbl)}" for lbl, t in rule.tiers)
    return f"CASE {whens} ELSE {_sql_literal(rule.default)} END"


def register_sql_functions(spark: SparkSession, rule: TierRule = SPEND_TIERS,
                           name: str = "discount_tier", database: str | None = None) -> str:
    """``discount_tier(x)`` as a SQL-bodied function: callable from SQL text,
    inlined by the analyzer, so it stays native (no Python).

    Temporary (session lifetime) by default; with ``database`` it is a
    persistent catalog function ``database.name`` that other sessions on the
    same catalog can call. Re-registering replaces. Returns the name."""
    body = tier_case_sql("nullif(total_spend, double('NaN'))", rule)
    if database is None:
        kind, qualified = "TEMPORARY FUNCTION", name
    else:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        kind, qualified = "FUNCTION", f"{database}.{name}"
    spark.sql(f"CREATE OR REPLACE {kind} {qualified}(total_spend DOUBLE) "
              f"RETURNS STRING RETURN {body}")
    return qualified
