"""Checks on a stratified sample, each with an estimate and an exact interval.

Strata (region and day) of at most ``whole`` rows are taken whole, so that none is missed; the
rows of the larger ones are taken one by one with the same chance ``rate``, by a seeded hash of
their key. Of K rows with some property in the larger strata the sample then has Bin(K, rate), so
the counts K for which that many or fewer, and that many or more, have a chance above half of
``alpha`` make an exact interval (the binomial test, inverted), to which the whole strata add what
they have. One aggregate over the sample serves all properties; the sizes of the strata come from
one count per partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import exp, lgamma, log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRATA = ("region", "trending_date")
KEY = ("video_id", "region", "trending_date")
PARTS = 1 << 30
ALPHA = 0.001
SAMPLED = "name string, n_rows long, n_sampled long, found long, estimate double, low long, high long"


def _chances(n: int, p: float, k: int, upper: bool) -> float:
    """P[Bin(n, p) >= k] if ``upper``, else P[Bin(n, p) <= k]; terms too far from the mean to show in a double are left out."""
    if k < 0 or k > n:
        return float(upper == (k < 0))
    reach = int(40 * sqrt(n * p * (1 - p))) + 40
    first, last = (k, n) if upper else (0, k)
    top = min(max(int(n * p), first), last)  # the likeliest of them, and from there both ways
    most = exp(lgamma(n + 1) - lgamma(top + 1) - lgamma(n - top + 1) + top * log(p) + (n - top) * log(1 - p))
    total, term = most, most
    for i in range(top, min(last, top + reach)):
        term *= (n - i) / (i + 1) * p / (1 - p)
        total += term
        if term < total * 1e-18:
            break
    term = most
    for i in range(top, max(first, top - reach), -1):
        term *= i / (n - i + 1) * (1 - p) / p
        total += term
        if term < total * 1e-18:
            break
    return min(1.0, total)


def interval(found: int, rate: float, size: int, alpha: float = ALPHA) -> tuple[int, int]:
    """Least and largest number of rows, of ``size``, of which ``found`` in a sample at ``rate`` are no surprise."""
    if rate >= 1:
        return found, found

    def border(inside, lo: int, hi: int) -> int:
        """Largest of lo..hi that is inside; lo is."""
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if inside(mid) else (lo, mid - 1)
        return lo

    most = border(lambda k: _chances(k, rate, found, False) > alpha / 2, found, size)
    short = border(lambda k: _chances(k, rate, found, True) <= alpha / 2, found - 1, size) if found else -1
    return min(short + 1, most), most


def stratified_sample(df: DataFrame, rate: float, whole: int, seed: int, strata: Sequence[str] = STRATA, key: Sequence[str] = KEY) -> DataFrame:
    """The sampled rows, with ``__whole``: whether all of their stratum is there."""
    sizes = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("n")).select(*[F.col(c).alias(f"__{c}") for c in strata], (F.col("n") <= whole).alias("__whole"))
    same = F.lit(True)
    for c in strata:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    spot = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(PARTS))
    return df.join(sizes, same).where(F.col("__whole") | (spot < int(rate * PARTS))).drop(*[f"__{c}" for c in strata])


def sampled_counts(
    df: DataFrame, properties: dict[str, Column], rate: float, whole: int, seed: int = 42, alpha: float = ALPHA,
    strata: Sequence[str] = STRATA, key: Sequence[str] = KEY,
) -> DataFrame:
    """Per property: rows in all, rows sampled, how many of these have it, and the estimate and interval for all rows."""
    if not 0 < rate <= 1:
        raise ValueError("the rate is a share of the rows")
    sample = stratified_sample(df, rate, whole, seed, strata, key)
    counts = [F.count_if(p & F.col("__whole")).alias(f"w_{k}") for k, p in properties.items()] + [F.count_if(p & ~F.col("__whole")).alias(f"s_{k}") for k, p in properties.items()]
    got = sample.agg(F.count(F.lit(1)).alias("n"), F.count_if("__whole").alias("whole"), *counts).first()  # one row
    total = df.count()
    share = int(rate * PARTS) / PARTS
    rows = []
    for k in properties:
        low, high = interval(got[f"s_{k}"], share, total - got["whole"], alpha)
        taken = got[f"w_{k}"]
        rows.append((k, total, got["n"], taken + got[f"s_{k}"], taken + got[f"s_{k}"] / share, taken + low, taken + high))
    return df.sparkSession.createDataFrame(rows, SAMPLED)
