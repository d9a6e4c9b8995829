"""Column functions used by the operators."""

from trendlake.functions.casts import norm_region, to_bool, to_double, to_long, to_ts, zero_if_null
from trendlake.functions.metrics import (
    DEFAULT_MOMENTUM,
    DEFAULT_TIER,
    MOMENTUM_BANDS,
    TIER_NAMES,
    UNKNOWN_CATEGORY,
    VIEWS_TIERS,
    engagement_rate,
    exact_mean,
    like_ratio,
    momentum,
    normalize_definition,
    pct,
    share_pct,
    tier_count,
    views_tier,
)

__all__ = [
    "DEFAULT_MOMENTUM", "DEFAULT_TIER", "MOMENTUM_BANDS", "TIER_NAMES", "UNKNOWN_CATEGORY",
    "VIEWS_TIERS", "engagement_rate", "exact_mean",
    "like_ratio", "momentum", "normalize_definition", "norm_region", "pct", "share_pct",
    "tier_count", "to_bool", "to_double", "to_long", "to_ts", "views_tier", "zero_if_null",
]
