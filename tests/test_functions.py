"""Boundary cases of the column functions (FIXTURES section 3)."""

import pytest
from pyspark.sql import functions as F

from trendlake.functions import metrics as M


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


@pytest.mark.parametrize(
    "views,tier",
    [(0, "emerging"), (99_999, "emerging"), (100_000, "trending"), (999_999, "trending"),
     (1_000_000, "popular"), (9_999_999, "popular"), (10_000_000, "viral"),
     (99_999_999, "viral"), (100_000_000, "mega")],
)
def test_views_tier_edges(spark, views, tier):
    assert _one(spark, M.views_tier("v"), [(views,)], "v long") == [tier]


@pytest.mark.parametrize(
    "g,label",
    [(20.0, "surging"), (19.99, "growing"), (5.0, "growing"), (4.99, "stable"), (-5.0, "stable"),
     (-5.01, "declining"), (-20.0, "declining"), (-20.01, "fading")],
)
def test_momentum_edges(spark, g, label):
    assert _one(spark, M.momentum("g"), [(g,)], "g double") == [label]


def test_ratios(spark):
    df = spark.createDataFrame(
        [(3, 1, 0), (0, 5, 1), (100, 5, 1), (1, 5, 1)], "views long, likes long, comment_count long"
    )
    got = df.select(M.like_ratio().alias("lr"), M.engagement_rate().alias("er")).collect()
    assert [(r.lr, r.er) for r in got] == [(33.3333, 33.3333), (0.0, 0.0), (5.0, 6.0), (500.0, 600.0)]


def test_definition_normalised(spark):
    got = _one(spark, M.normalize_definition("d"), [("hd",), ("sd",), ("4k",), (None,)], "d string")
    assert got == ["hd", "sd", "unknown", "unknown"]


def test_exact_mean_is_order_free(spark):
    vals = [(0.1,), (0.2,), (0.3,), (33.3333,), (66.6667,)] * 50
    df = spark.createDataFrame(vals, "x double")
    a = df.agg(M.exact_mean("x", 4)).first()[0]
    b = df.repartition(7).agg(M.exact_mean("x", 4)).first()[0]
    c = df.orderBy(F.desc("x")).coalesce(1).agg(M.exact_mean("x", 4)).first()[0]
    assert a == b == c


def test_share_pct_zero_total_is_null(spark):
    df = spark.createDataFrame([(0, 0), (75, 100)], "p long, w long")
    assert [r[0] for r in df.select(M.share_pct("p", "w")).collect()] == [None, 75.0]
