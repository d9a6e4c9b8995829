"""Column-level business functions (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results.
# Views tiers, checked top-down with ">=": mega 100,000,000; viral 10,000,000;
# popular 1,000,000; trending 100,000; anything lower is emerging.
VIEWS_TIERS: tuple[tuple[str, int], ...] = (
    ("mega", 100_000_000),
    ("viral", 10_000_000),
    ("popular", 1_000_000),
    ("trending", 100_000),
)
DEFAULT_TIER = "emerging"
TIER_NAMES: tuple[str, ...] = tuple(name for name, _ in VIEWS_TIERS) + (DEFAULT_TIER,)

# Momentum bands on the rounded growth percentage, checked top-down with ">=":
# surging 20; growing 5; stable -5; declining -20; anything lower is fading.
MOMENTUM_BANDS: tuple[tuple[str, int], ...] = (
    ("surging", 20),
    ("growing", 5),
    ("stable", -5),
    ("declining", -20),
)
DEFAULT_MOMENTUM = "fading"

# Definitions kept as-is; anything else becomes "unknown".
DEFINITIONS = ("hd", "sd")
UNKNOWN_DEFINITION = "unknown"
UNKNOWN_CATEGORY = "Unknown"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct(numerator: str | Column, denominator: str | Column, scale: int) -> Column:
    """Guarded percentage: round(n / d * 100, scale) when d > 0, else 0.0."""
    n, d = col(numerator), col(denominator)
    return F.when(d > 0, F.round(n / d * 100, scale)).otherwise(F.lit(0.0))


def like_ratio(likes: str | Column = "likes", views: str | Column = "views") -> Column:
    return pct(likes, views, 4)


def engagement_rate(
    likes: str | Column = "likes",
    comments: str | Column = "comment_count",
    views: str | Column = "views",
) -> Column:
    """(likes + comments) / views, in percent; dislikes are not part of it."""
    return pct(col(likes) + col(comments), views, 4)


def _banded(value: Column, bands: Sequence[tuple[str, int]], default: str) -> Column:
    expr = None
    for label, floor in bands:
        cond = value >= F.lit(floor)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def views_tier(views: str | Column = "views") -> Column:
    return _banded(col(views), VIEWS_TIERS, DEFAULT_TIER)


def momentum(growth_pct: str | Column = "view_growth_pct") -> Column:
    return _banded(col(growth_pct), MOMENTUM_BANDS, DEFAULT_MOMENTUM)


def normalize_definition(definition: str | Column = "definition") -> Column:
    c = col(definition)
    return F.when(c.isin(*DEFINITIONS), c).otherwise(F.lit(UNKNOWN_DEFINITION))


def exact_mean(c: str | Column, scale: int) -> Column:
    """Mean accumulated in fixed-point decimal, then divided once in double.

    Double sums depend on the order rows arrive in, so a plain ``avg`` can differ in its
    last bits between runs and cluster sizes. Summing the values as ``decimal(38,
    scale)`` is exact and order-free; for inputs already rounded to ``scale`` places
    (like_ratio, engagement_rate, growth) the result is the exact mean.
    """
    x = col(c)
    total = F.sum(x.cast(f"decimal(38,{scale})")).cast("double")
    return F.try_divide(total, F.count(x).cast("double"))


def share_pct(part: str | Column, whole: str | Column, scale: int = 2) -> Column:
    """round(part / whole * 100, scale); null when whole is zero (no ANSI error)."""
    return F.round(F.try_divide(col(part), col(whole)) * 100, scale)


def tier_count(tier: str, tier_col: str | Column = "views_tier") -> Column:
    """Aggregate: rows in one tier (a fixed-column pivot)."""
    return F.count_if(col(tier_col) == F.lit(tier))
