"""Business rules and test-data parameters, kept as data.

Every tier, rate and threshold used anywhere in the package is read from
here, so the native CASE expressions, the Python/pandas UDF twins and the
SQL functions cannot drift apart.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class TierRule:
    """Ordered threshold table: the first ``(label, threshold)`` that the
    value passes wins, otherwise ``default``. ``inclusive`` selects ``>=``
    over ``>``. NULL (and NaN) values always fall to ``default``."""

    tiers: tuple[tuple[str, float], ...]
    default: str
    inclusive: bool

    def with_thresholds(self, *thresholds: float) -> "TierRule":
        if len(thresholds) != len(self.tiers):
            raise ValueError(f"expected {len(self.tiers)} thresholds, got {len(thresholds)}")
        return replace(self, tiers=tuple((lbl, t) for (lbl, _), t in zip(self.tiers, thresholds)))


# --- fixed values: the published business rules (must equal the reference) ---
# spend tiers, inclusive:  >= 500 Platinum, >= 200 Gold, >= 100 Silver, else Bronze
# discount rates:          Platinum 0.15, Gold 0.10, Silver 0.05, Bronze 0.00, unknown 0.0
# price tiers, strict:     > 200 Premium, > 50 Standard, else Budget
# revenue tiers, strict:   > 5000 High, > 2000 Medium, else Low
# tax factor:              1.08
# filters of the tour:     region 'North'; category 'Electronics' and price > 50;
#                          category 'Electronics' and revenue > 1000 (HAVING)
# status lines:            'SUCCESS: Saved {rows} rows to {table}'
#                          'Pipeline complete. {first} | {second}'
SPEND_TIERS = TierRule((("Platinum", 500.0), ("Gold", 200.0), ("Silver", 100.0)), "Bronze", True)
DISCOUNT_RATES: dict[str, float] = {"Platinum": 0.15, "Gold": 0.10, "Silver": 0.05, "Bronze": 0.00}
UNKNOWN_TIER_RATE = 0.0
PRICE_TIERS = TierRule((("Premium", 200.0), ("Standard", 50.0)), "Budget", False)
REVENUE_TIERS = TierRule((("High", 5000.0), ("Medium", 2000.0)), "Low", False)
TAX_FACTOR = 1.08
SAVED_STATUS = "SUCCESS: Saved {rows} rows to {table}"
ALL_JOBS_STATUS = "Pipeline complete. {first} | {second}"
# --- end of fixed values ---


@dataclass(frozen=True)
class Params:
    """Parameters of the composite queries. Defaults are the published
    values; :data:`TESTDATA_PARAMS` rescales them to the test tables."""

    spend_tiers: TierRule = SPEND_TIERS
    price_tiers: TierRule = PRICE_TIERS
    revenue_tiers: TierRule = REVENUE_TIERS
    discount_rates: dict[str, float] = field(default_factory=lambda: dict(DISCOUNT_RATES))
    tax_factor: float = TAX_FACTOR
    region: str = "North"
    category: str = "Electronics"
    min_price: float = 50.0
    min_category_revenue: float = 1000.0
    top_products: int = 5
    sample_rows: int = 10
    raw_db: str = "raw"
    analytics_db: str = "analytics"
    # buckets of the raw orders/customers tables on customer_id (0 = none).
    # Opt-in for data whose key frequencies are bounded: a bucket is never
    # split, so a customer holding a third of all orders would put a third of
    # the data in one task, whereas unbucketed shuffles let AQE split it.
    # Size it to the data: about one bucket per 128-256 MB of orders.
    raw_buckets: int = 0


# The test tables hold TPC-H-like values (prices 900-2100, spend in the
# millions), so the published thresholds would put everything in one tier.
# These keep every tier populated; they are parameters, not new rules.
TESTDATA_PARAMS = Params(
    spend_tiers=SPEND_TIERS.with_thresholds(1_200_000.0, 950_000.0, 720_000.0),
    price_tiers=PRICE_TIERS.with_thresholds(975.0, 925.0),
    revenue_tiers=REVENUE_TIERS.with_thresholds(3_800_000.0, 3_300_000.0),
    region="ASIA",
    category="PROMO",
    min_price=950.0,
    min_category_revenue=47_000_000.0,
)

# E-mail addresses inside document text (fixed value shared with the oracle).
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
