"""DQ boundaries (FIXTURES section 3), one aggregate per table."""

import datetime as dt

from trendlake.operators import dq

NOW = dt.datetime(2026, 5, 20, 12, 0, 0)
SCHEMA = (
    "video_id string, title string, channel_title string, category_id long, views long, likes long, "
    "region string, trending_date date, engagement_rate double, like_ratio double, views_tier string, "
    "ingestion_timestamp timestamp"
)


def good(i=0, **kw):
    row = dict(video_id=f"v{i}", title="t", channel_title="c", category_id=1, views=10, likes=1,
               region="us", trending_date=dt.date(2026, 5, 20), engagement_rate=1.0, like_ratio=1.0,
               views_tier="emerging", ingestion_timestamp=NOW)
    row.update(kw)
    return tuple(row[k] for k in [f.split()[0] for f in SCHEMA.split(", ")])


def checks(spark, rows, schema=SCHEMA, table=dq.FACT_TABLE, config=None):
    df = spark.createDataFrame(rows, schema)
    res = dq.table_checks(df, table, config or dq.DQConfig(), NOW).collect()
    return {(r.check, r.column_name): r for r in res}


def test_row_count_boundary(spark):
    assert not checks(spark, [good(i) for i in range(9)])[("row_count", None)].passed
    assert checks(spark, [good(i) for i in range(10)])[("row_count", None)].passed


def test_null_pct_boundary(spark):
    rows = [good(i) for i in range(19)] + [good(19, title=None)]  # exactly 5.0 %
    r = checks(spark, rows)[("null_pct", "title")]
    assert r.passed and r.value == 5.0
    rows = [good(i) for i in range(9999)] + [good(9999 + i, title=None) for i in range(527)]  # 5.007 %
    assert not checks(spark, rows)[("null_pct", "title")].passed


def test_empty_table_null_pct_passes(spark):
    r = checks(spark, [])
    assert r[("null_pct", "title")].passed and r[("null_pct", "title")].value == 0.0
    assert not r[("row_count", None)].passed
    assert not r[("freshness", "ingestion_timestamp")].passed  # all null -> fail


def test_missing_column_fails(spark):
    r = checks(spark, [("v1",)], "video_id string")
    assert not r[("null_pct", "title")].passed
    assert not r[("schema", None)].passed
    assert r[("freshness", None)].passed  # no timestamp column -> skipped


def test_views_range(spark):
    base = [good(i) for i in range(10)]
    assert not checks(spark, base + [good(11, views=-1)])[("value_range", "views")].passed
    assert checks(spark, base + [good(11, views=50_000_000_000)])[("value_range", "views")].passed
    assert not checks(spark, base + [good(11, views=50_000_000_001)])[("value_range", "views")].passed
    assert checks(spark, base + [good(11, views=None)])[("value_range", "views")].passed


def test_rate_ranges(spark):
    base = [good(i) for i in range(10)]
    r = checks(spark, base + [good(11, engagement_rate=0.0), good(12, engagement_rate=100.0)])
    assert r[("value_range", "engagement_rate")].passed
    r = checks(spark, base + [good(11, like_ratio=100.01), good(12, engagement_rate=None)])
    assert not r[("value_range", "like_ratio")].passed
    assert r[("value_range", "engagement_rate")].passed


def test_enums(spark):
    base = [good(i) for i in range(10)]
    r = checks(spark, base + [good(11, views_tier=None), good(12, region=None)])
    assert not r[("value_range", "views_tier")].passed
    assert r[("value_range", "region")].passed
    r = checks(spark, base + [good(11, region="xx")])
    assert not r[("value_range", "region")].passed
    bad = dq.invalid_values(spark.createDataFrame(base + [good(11, region="xx"), good(12, region="xx", views_tier=None)], SCHEMA), "t", dq.DQConfig())
    assert {(b.column_name, b.invalid_value, b.n_rows) for b in bad.collect()} == {("region", "xx", 2), ("views_tier", None, 1)}


def test_freshness(spark):
    base = [good(i) for i in range(10)]
    exact = [good(i, ingestion_timestamp=NOW - dt.timedelta(hours=48)) for i in range(10)]
    assert checks(spark, exact)[("freshness", "ingestion_timestamp")].passed
    old = [good(i, ingestion_timestamp=NOW - dt.timedelta(hours=48, seconds=1)) for i in range(10)]
    assert not checks(spark, old)[("freshness", "ingestion_timestamp")].passed
    assert checks(spark, base)[("freshness", "ingestion_timestamp")].passed


def test_dimension_rules_and_verdict(spark):
    dim = spark.createDataFrame([(1, "Music", "us")] * 10, "category_id long, category_name string, region string")
    facts = spark.createDataFrame([good(i) for i in range(10)], SCHEMA)
    res = dq.run_checks(spark, {dq.FACT_TABLE: facts, dq.DIM_TABLE: dim, "absent": None}, dq.DQConfig(), NOW)
    rows = res.collect()
    dim_checks = [r.check for r in rows if r.table_name == dq.DIM_TABLE]
    assert "value_range" not in dim_checks
    assert [r for r in rows if r.table_name == dq.DIM_TABLE and r.check == "freshness"][0].passed
    assert [r.check for r in rows if r.table_name == "absent"] == ["read_table"]
    v = dq.verdict(res).first()
    assert v.quality_passed is False and v.checks_total == len(rows) and v.checks_passed == len(rows) - 1
    # 19 fact checks (10 critical columns) + 6 dimension checks + 1 failed read
    assert len(rows) == 1 + 10 + 1 + 5 + 1 + (1 + 3 + 1 + 1) + 1


def test_a_sample_checks_values_but_counts_all_rows(spark):
    facts = spark.createDataFrame([good(i, title=None if i % 4 else "t") for i in range(2000)], SCHEMA)
    a, b = (
        {(r.check, r.column_name): r for r in dq.run_checks(spark, {dq.FACT_TABLE: facts}, dq.DQConfig(), NOW, sample_fraction=0.1, seed=3).collect()}
        for _ in range(2)
    )
    assert a[("row_count", None)].value == 2000 and "sample" not in a[("row_count", None)].message
    assert 60 < a[("null_pct", "title")].value < 90 and "sample" in a[("null_pct", "title")].message
    assert a == b  # seeded: repeatable
    small = spark.createDataFrame([good(i) for i in range(50)], SCHEMA)
    assert dq.verdict(dq.run_checks(spark, {dq.FACT_TABLE: small}, dq.DQConfig(), NOW, sample_fraction=0.1)).first().quality_passed


def test_times_that_cannot_be_read_pass(spark):
    schema = SCHEMA.replace("ingestion_timestamp timestamp", "ingestion_timestamp string")
    rows = [good(i, ingestion_timestamp="not a time") for i in range(10)]
    r = checks(spark, rows, schema)[("freshness", "ingestion_timestamp")]
    assert r.passed and "10 times" in r.message
    old = checks(spark, [good(i, ingestion_timestamp="2020-01-01 00:00:00") for i in range(10)], schema)
    assert not old[("freshness", "ingestion_timestamp")].passed


def test_a_corrupt_file_fails_its_table_alone(spark, tmp_path):
    dim = tmp_path / "dim"
    spark.createDataFrame([(1, "Music", "us")], "category_id long, category_name string, region string").coalesce(1).write.parquet(str(dim))
    for part in dim.glob("part-*"):
        part.write_bytes(b"no parquet here")
    for side in dim.glob(".*.crc"):
        side.unlink()
    facts = spark.createDataFrame([good(i) for i in range(10)], SCHEMA)
    broken = spark.read.schema("category_id long, category_name string, region string").parquet(str(dim))
    rows = dq.run_checks(spark, {dq.DIM_TABLE: broken, dq.FACT_TABLE: facts}, dq.DQConfig(), NOW).collect()
    assert [r.check for r in rows if r.table_name == dq.DIM_TABLE] == ["read_table"]
    assert all(r.passed for r in rows if r.table_name == dq.FACT_TABLE)
