"""Data-quality gate: every check of a table from ONE aggregate over the whole table.

The checks run on all rows (no 10,000-row sample). Each table is scanned once: one
``agg`` computes the row count, per-column null counts, range violations, enum
violations and the newest timestamp. The single result row is then unpivoted into one row per check:

    check, table_name, column_name, value, threshold, passed, message

Boundaries (kept from the reference):
* row_count passes at ``count >= min_rows``;
* null_pct passes at ``100 * nulls / rows <= max_null_pct`` (unrounded), 0 rows -> 0.0;
  a missing column fails;
* views: no value ``< 0`` and none ``> max_views``; nulls pass;
* engagement_rate / like_ratio within [0, 100]; nulls pass;
* views_tier: only the five tiers; a null tier is invalid;
* region: only configured regions; nulls are ignored;
* freshness: newest timestamp ``>= now - freshness_hours``; all-null fails; a column with
  times that can't be read, a table without the column and the static dimension pass.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.functions.metrics import TIER_NAMES

FACT_TABLE = "clean_statistics"
DIM_TABLE = "clean_reference_data"

RESULT_SCHEMA = T.StructType([
    T.StructField("check", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("message", T.StringType()),
])


@dataclass(frozen=True)
class TableRules:
    critical_columns: tuple[str, ...]
    value_checks: bool = False  # ranges and enums (fact table only)
    freshness: bool = False  # the dimension is static: skipped


@dataclass(frozen=True)
class DQConfig:
    # Fixed values that must equal the reference's: minimum 10 rows, at most 5.0 % nulls,
    # at most 50,000,000,000 views, data newer than 48 hours; regions us, in, gb, jp, kr, ca.
    min_rows: int = 10
    max_null_pct: float = 5.0
    max_views: int = 50_000_000_000
    freshness_hours: int = 48
    valid_regions: tuple[str, ...] = ("us", "in", "gb", "jp", "kr", "ca")
    valid_tiers: tuple[str, ...] = TIER_NAMES
    # The reference preferred _processed_at, which every rewrite resets to "now" and so
    # always looks fresh; the ingestion clock is the meaningful one.
    freshness_columns: tuple[str, ...] = ("ingestion_timestamp",)
    rules: dict = field(default_factory=lambda: {
        # category_name is not a Silver fact column (it is joined in Gold), so requiring
        # it would close the gate on every run.
        FACT_TABLE: TableRules(
            ("video_id", "title", "channel_title", "category_id", "views", "likes", "region",
             "trending_date", "engagement_rate", "views_tier"),
            value_checks=True,
            freshness=True,
        ),
        DIM_TABLE: TableRules(("category_id", "category_name", "region")),
    })


def _row(check: str, table: str, column: str | None, value, threshold, passed, note=None) -> Column:
    """One result row; the message is made of the row's own parts and an optional note."""
    value = value if isinstance(value, Column) else F.lit(value)
    number, limit = value.cast("double"), F.lit(threshold).cast("double")
    passed = passed if isinstance(passed, Column) else F.lit(passed)
    subject = table if column is None else f"{table}.{column}"
    measured = F.when(number.isNotNull(), F.concat(F.lit("measured "), number.cast("string"), F.lit(", limit "), limit.cast("string")))
    outcome = F.when(passed, "passed").otherwise("failed")
    message = F.concat_ws("; ", F.concat(F.lit(f"{check} of {subject} "), outcome), measured, note if isinstance(note, Column) else F.lit(note).cast("string"))
    return F.struct(
        F.lit(check).alias("check"), F.lit(table).alias("table_name"), F.lit(column).cast("string").alias("column_name"),
        number.alias("value"), limit.alias("threshold"), passed.cast("boolean").alias("passed"), message.alias("message"),
    )


def _bad_tier(config: DQConfig) -> Column:
    return F.col("views_tier").isNull() | ~F.col("views_tier").isin(*config.valid_tiers)


def _bad_region(config: DQConfig) -> Column:
    return F.col("region").isNotNull() & ~F.col("region").isin(*config.valid_regions)


def _out_of_range(column: str, config: DQConfig) -> Column:
    number = F.col(column).try_cast("double")
    return (number < 0) | (number > (config.max_views if column == "views" else 100))


RANGES = ("views", "engagement_rate", "like_ratio")


def table_checks(df: DataFrame, table: str, config: DQConfig, now: dt.datetime | str, note: str | None = None) -> DataFrame:
    """All checks of one table from a single aggregate; returns RESULT_SCHEMA rows.

    The aggregate holds counts and one maximum, whatever the values are; the invalid values
    themselves come from ``invalid_values``.
    """
    rules: TableRules = config.rules.get(table, TableRules(()))
    have = set(df.columns)
    missing = [c for c in rules.critical_columns if c not in have]
    clock = next((c for c in config.freshness_columns if c in have), None) if rules.freshness else None
    aggs = {"n": F.count(F.lit(1))}
    aggs |= {f"null__{c}": F.count_if(F.col(c).isNull()) for c in rules.critical_columns if c in have}
    checked = have if rules.value_checks else set()
    aggs |= {f"range__{c}": F.count_if(_out_of_range(c, config)) for c in RANGES if c in checked}
    if "views_tier" in checked:
        aggs["tier_bad"] = F.count_if(_bad_tier(config))
    if "region" in checked:
        aggs["region_bad"] = F.count_distinct(F.when(_bad_region(config), F.col("region")))
    if clock:
        parsed = F.col(clock).try_cast("timestamp")
        aggs |= {"latest": F.max(parsed), "unread": F.count_if(F.col(clock).isNotNull() & parsed.isNull())}

    n = F.col("n")
    rows = [_row("row_count", table, None, n, config.min_rows, n >= config.min_rows)]
    for c in rules.critical_columns:
        if c in missing:
            rows.append(_row("null_pct", table, c, None, config.max_null_pct, False, "no such column"))
        else:
            share = F.when(n > 0, F.col(f"null__{c}") / n * 100).otherwise(F.lit(0.0))
            rows.append(_row("null_pct", table, c, F.round(share, 2), config.max_null_pct, share <= config.max_null_pct, note))
    rows.append(_row("schema", table, None, len(missing), 0, not missing, ", ".join(sorted(missing)) or None))
    for c in RANGES:
        if c in checked:
            bad = F.col(f"range__{c}")
            rows.append(_row("value_range", table, c, bad, 0, bad == 0, note))
    for c, bad in (("views_tier", "tier_bad"), ("region", "region_bad")):
        if c in checked:
            rows.append(_row("value_range", table, c, F.col(bad), 0, F.col(bad) == 0, note))
    hours = config.freshness_hours
    if clock is None:
        rows.append(_row("freshness", table, None, None, hours, True, "no clock to check" if rules.freshness else "a static table"))
    else:
        at = F.lit(str(now)).cast("timestamp")
        latest, unread = F.col("latest"), F.col("unread")
        age = F.round((F.unix_micros(at) - F.unix_micros(latest)) / F.lit(3_600_000_000), 2)
        fresh = F.coalesce(latest >= at - F.make_dt_interval(hours=F.lit(hours)), F.lit(False))
        # times that can't be read pass, as the rule has it; their number is in the note
        text = F.when(unread > 0, F.concat(unread.cast("string"), F.lit(" times can't be read")))
        rows.append(_row("freshness", table, clock, age, hours, (unread > 0) | fresh, text))
    return df.agg(*[v.alias(k) for k, v in aggs.items()]).select(F.inline(F.array(*rows)))


def invalid_values(df: DataFrame, table: str, config: DQConfig) -> DataFrame:
    """What the enum checks found, grouped: table_name, column_name, invalid_value, n_rows."""
    found = F.array(
        F.when(_bad_tier(config), F.struct(F.lit("views_tier").alias("column_name"), F.col("views_tier").alias("invalid_value"))),
        F.when(_bad_region(config), F.struct(F.lit("region").alias("column_name"), F.col("region").alias("invalid_value"))),
    )
    each = df.select(F.explode(F.array_compact(found)).alias("x")).select("x.*")
    counted = each.groupBy("column_name", "invalid_value").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(F.lit(table).alias("table_name"), "column_name", "invalid_value", "n_rows")


def read_failure(spark: SparkSession, table: str, error: str) -> DataFrame:
    return spark.createDataFrame([("read_table", table, None, None, None, False, f"{table} can't be read: {error}")], RESULT_SCHEMA)


def run_checks(
    spark: SparkSession,
    tables: dict[str, DataFrame | None | Exception],
    config: DQConfig | None = None,
    now: dt.datetime | str | None = None,
    sample_fraction: float | None = None,
    seed: int = 42,
) -> DataFrame:
    """Checks over every table, each a job of its own, side by side: one that can't be read, when it is
    opened or while its rows are, gives one failed ``read_table`` row with the error's text,
    and the others are still checked. What is gathered is one row per configured check.

    The whole table is checked by default. ``sample_fraction`` opts into a seeded Bernoulli
    sample for the checks on values, which then say so in their messages; the rows are
    always counted in full.
    """
    config = config or DQConfig()
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def checked(item: tuple[str, DataFrame | None | Exception]) -> list[Row]:
        name, df = item
        try:
            if df is None or isinstance(df, Exception):
                raise df or FileNotFoundError("missing")
            if sample_fraction is None:
                return table_checks(df, name, config, now).collect()
            part = df.sample(withReplacement=False, fraction=sample_fraction, seed=seed)
            note = f"on a sample of {sample_fraction:g} of the rows"
            total = df.agg(F.count(F.lit(1)).alias("n"))
            counted = total.select(F.inline(F.array(_row("row_count", name, None, F.col("n"), config.min_rows, F.col("n") >= config.min_rows))))
            return counted.collect() + table_checks(part, name, config, now, note).where("check <> 'row_count'").collect()
        except Exception as error:  # noqa: BLE001 - any failure to read fails this table alone
            return read_failure(spark, name, str(error)).collect()

    with ThreadPoolExecutor(max(1, len(tables))) as pool:  # a job per table, at the same time
        rows = [row for found in pool.map(checked, tables.items()) for row in found]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def verdict(results: DataFrame) -> DataFrame:
    """One row: quality_passed, checks_passed, checks_total."""
    return results.agg(
        F.coalesce(F.bool_and("passed"), F.lit(False)).alias("quality_passed"),
        F.count_if("passed").alias("checks_passed"),
        F.count(F.lit(1)).alias("checks_total"),
    )


def prewrite_warnings(df: DataFrame) -> list[Column]:
    """Non-blocking Silver warnings, as aggregate expressions (for ``observe``):
    nulls in four columns, negative views, zero views."""
    exprs = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("video_id", "title", "channel_title", "views")]
    exprs += [
        F.count_if(F.col("views") < 0).alias("negative_views"),
        F.count_if(F.col("views") == 0).alias("zero_views"),
    ]
    return exprs


STALE_HOURS = 6


def is_stale(latest: dt.datetime | None, now: dt.datetime, max_hours: int = STALE_HOURS) -> bool:
    """Whether a region's newest landing is older than ``max_hours``, or there is none."""
    return latest is None or latest < now - dt.timedelta(hours=max_hours)


def bronze_staleness(df: DataFrame, now: dt.datetime | str, max_hours: int = STALE_HOURS) -> DataFrame:
    """Per region: newest ingestion and whether it is older than ``max_hours``."""
    now_ts = F.lit(str(now)).cast("timestamp")
    return df.groupBy("region").agg(F.max("ingestion_timestamp").alias("latest")).withColumns({
        "hours_since": F.round(
            (F.unix_micros(now_ts) - F.unix_micros("latest")) / F.lit(3_600_000_000), 2
        ),
        "stale": F.col("latest") < now_ts - F.make_dt_interval(hours=F.lit(max_hours)),
    })
