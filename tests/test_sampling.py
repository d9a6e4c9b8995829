"""Stratified samples: exact intervals against the binomial test, and their cover of whole tables."""

from math import comb

import pytest
from pyspark.sql import functions as F

from trendlake.operators import sampling


@pytest.mark.parametrize(("found", "rate", "size"), [(0, 0.1, 300), (3, 0.1, 300), (40, 0.3, 200), (60, 0.3, 200), (1, 0.9, 40), (5, 0.02, 400)])
def test_intervals_invert_the_binomial_test(found, rate, size):
    def tail(n, ks):
        return sum(comb(n, i) * rate**i * (1 - rate) ** (n - i) for i in ks)

    inside = [n for n in range(found, size + 1) if tail(n, range(found + 1)) > 0.025 and tail(n, range(found, n + 1)) > 0.025]
    assert sampling.interval(found, rate, size, 0.05) == (inside[0], inside[-1])


def test_intervals_of_large_counts():
    low, high = sampling.interval(1_000_000, 0.01, 10**10, 0.01)
    assert low < 100_000_000 < high and high - low < 6 * 10**4 * 100 and sampling.interval(7, 1.0, 100) == (7, 7)


def test_samples_cover_the_table(spark):
    day = F.date_add(F.lit("2026-05-01").cast("date"), (F.col("id") % 3).cast("int"))
    rows = spark.range(60_000).select(
        F.col("id").cast("string").alias("video_id"), F.when(F.col("id") < 59_990, "us").otherwise("gb").alias("region"), day.alias("trending_date"), F.col("id"),
    )
    made = {"tenth": F.col("id") % 10 == 0, "none": F.col("id") < 0, "small": F.col("region") == "gb", "all": F.lit(True), "unknown": F.lit(None).cast("boolean")}
    got = {r.name: r for r in sampling.sampled_counts(rows, made, 0.05, 100).collect()}
    exact = {"tenth": 6000, "none": 0, "small": 10, "all": 60_000, "unknown": 0}
    for name, n in exact.items():
        assert got[name].low <= n <= got[name].high and got[name].n_rows == 60_000
    assert got["small"].low == 10 and got["small"].high < 300  # small strata are there whole, of the others some may be unseen
    assert 2000 < got["all"].n_sampled < 4000 and got["tenth"].high - got["tenth"].low < 3500
    again = sampling.stratified_sample(rows.repartition(5), 0.05, 100, 42).select("video_id").collect()
    assert set(again) == set(sampling.stratified_sample(rows, 0.05, 100, 42).select("video_id").collect())
    none = sampling.sampled_counts(rows.where("id < 0"), made, 0.05, 100).first()
    assert (none.n_rows, none.found, none.low, none.high) == (0, 0, 0, 0)
    with pytest.raises(ValueError):
        sampling.sampled_counts(rows, made, 0, 100)
