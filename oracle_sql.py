"""DuckDB twins of the registered queries (independent SQL over the same parquet tables).

Each entry is plain SQL over the pre-registered views (region, nation, customer,
supplier, part, orders, lineitem, ...). The CTE chain below mirrors the pipeline layer by
layer: adapter -> silver -> lookup -> gold -> analyst queries. Parity rules used on both
sides (see FIXTURES.md section 5): averages are summed in decimal; integer division is
written as ``* 1.0e0 /``; ``+ 0e0`` after ``round`` removes negative zero; every
``row_number`` has a total order.
"""

from __future__ import annotations

# The thresholds are written out here, not taken from the code under test.
VIEWS_TIERS = (("mega", 100_000_000), ("viral", 10_000_000), ("popular", 1_000_000), ("trending", 100_000))
DEFAULT_TIER = "emerging"
TIER_NAMES = ("mega", "viral", "popular", "trending", "emerging")
MOMENTUM_BANDS = (("surging", 20), ("growing", 5), ("stable", -5), ("declining", -20))
DEFAULT_MOMENTUM = "fading"

STATS_KEYS = ("video_id", "region", "trending_date")
# Column order of the fact rows when they are deduplicated (matches the Spark frame).
DEDUP_STATS_ORDER = (
    "ingestion_timestamp", "ingestion_id", "title", "channel_title", "category_id",
    "publish_time", "description", "audio_language", "views", "likes", "dislikes",
    "comment_count", "favorite_count", "duration", "definition", "like_ratio",
    "engagement_rate", "views_tier",
)
DEDUP_CATS_ORDER = ("ingestion_timestamp", "category_name", "assignable", "etag")


def _desc(cols) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


def _band(col: str, bands, default: str) -> str:
    whens = " ".join(f"WHEN {col} >= {floor} THEN '{label}'" for label, floor in bands)
    return f"CASE {whens} ELSE '{default}' END"


def _pct(n: str, d: str, scale: int) -> str:
    return f"CASE WHEN {d} > 0 THEN round({n} * 1.0e0 / {d} * 100, {scale}) + 0e0 ELSE 0.0 END"


def _mean(c: str, scale: int) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(38,{scale}))) AS DOUBLE) / COUNT({c})"


def _imean(c: str) -> str:
    return f"CAST(SUM({c}) AS DOUBLE) / COUNT({c})"


LINES = """
lines AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
         l.l_discount, l.l_tax, l.l_returnflag, l.l_shipdate,
         lower(r.r_name) AS region, c.c_mktsegment, o.o_orderdate,
         p.p_name, p.p_brand, p.p_type, s.s_name
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

RAW_STATS = """
raw_stats AS (
  SELECT CAST(l_partkey AS VARCHAR) AS video_id,
         region,
         p_name AS title,
         s_name AS channel_title,
         CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS category_id,
         CAST(o_orderdate AS TIMESTAMP) AS publish_time,
         p_type AS description,
         lower(c_mktsegment) AS audio_language,
         CAST(CASE WHEN l_quantity = 1 THEN 0
                   ELSE floor(l_extendedprice * l_extendedprice / 50) END AS BIGINT) AS views,
         CAST(floor(l_extendedprice * l_discount * 100) AS BIGINT) AS likes,
         CAST(0 AS BIGINT) AS dislikes,
         CAST(floor(l_extendedprice * l_tax * 10) AS BIGINT) AS comment_count,
         CAST(0 AS BIGINT) AS favorite_count,
         'PT' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || 'M' AS duration,
         CASE l_returnflag WHEN 'R' THEN 'hd' WHEN 'A' THEN 'sd' ELSE 'unknown' END AS definition,
         CAST(l_shipdate AS TIMESTAMP) AS ingestion_timestamp,
         strftime(CAST(l_shipdate AS TIMESTAMP), '%Y%m%d_%H%M%S') || '_'
           || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS ingestion_id,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS trending_date
  FROM lines
)"""

CLEAN_STATS = f"""
clean_stats AS (
  SELECT video_id, lower(trim(region)) AS region, title, channel_title, category_id,
         publish_time, description, audio_language,
         coalesce(views, 0) AS views, coalesce(likes, 0) AS likes,
         coalesce(dislikes, 0) AS dislikes, coalesce(comment_count, 0) AS comment_count,
         coalesce(favorite_count, 0) AS favorite_count, duration,
         CASE WHEN definition IN ('hd', 'sd') THEN definition ELSE 'unknown' END AS definition,
         ingestion_timestamp, ingestion_id, trending_date
  FROM raw_stats
  WHERE video_id IS NOT NULL AND video_id <> ''
),
metric_stats AS (
  SELECT *,
         {_pct('likes', 'views', 4)} AS like_ratio,
         {_pct('(likes + comment_count)', 'views', 4)} AS engagement_rate,
         {_band('views', VIEWS_TIERS, DEFAULT_TIER)} AS views_tier
  FROM clean_stats
),
silver_stats AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY {', '.join(STATS_KEYS)}
      ORDER BY {_desc(DEDUP_STATS_ORDER)}) AS _rn
    FROM metric_stats)
  WHERE _rn = 1
)"""

RAW_CATS = f"""
raw_cats AS (
  SELECT CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS category_id,
         p_brand AS category_name,
         TRUE AS assignable,
         md5(p_brand) AS etag,
         region,
         CAST(l_shipdate AS TIMESTAMP) AS ingestion_timestamp
  FROM lines
),
silver_cats AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT category_id, category_name, assignable, etag, lower(trim(region)) AS region,
           ingestion_timestamp,
           row_number() OVER (PARTITION BY category_id, lower(trim(region))
                              ORDER BY {_desc(DEDUP_CATS_ORDER)}) AS _rn
    FROM raw_cats
    WHERE category_id IS NOT NULL AND category_name IS NOT NULL)
  WHERE _rn = 1
),
cat_lookup AS (
  SELECT category_id,
         arg_max(category_name, (ingestion_timestamp, region, category_name)) AS category_name
  FROM silver_cats
  WHERE category_id IS NOT NULL
  GROUP BY category_id
)"""

FACTS = """
facts AS (
  SELECT s.*, coalesce(k.category_name, 'Unknown') AS category_name
  FROM silver_stats s LEFT JOIN cat_lookup k ON s.category_id = k.category_id
  WHERE s.trending_date IS NOT NULL
)"""

TIER_COUNTS = ",\n         ".join(
    f"CAST(count_if(views_tier = '{t}') AS BIGINT) AS {t}_count" for t in TIER_NAMES
)
HD_PCT = "round(count_if(definition = 'hd') * 1.0e0 / COUNT(video_id) * 100, 2) + 0e0"

def trending_cte(name: str = "trending", src: str = "facts") -> str:
    return f"""
{name} AS (
  SELECT region, trending_date,
         CAST(COUNT(video_id) AS BIGINT) AS total_videos,
         CAST(SUM(views) AS BIGINT) AS total_views,
         CAST(SUM(likes) AS BIGINT) AS total_likes,
         CAST(SUM(comment_count) AS BIGINT) AS total_comments,
         {_imean('views')} AS avg_views_per_video,
         MAX(views) AS max_views,
         {_mean('like_ratio', 4)} AS avg_like_ratio,
         {_mean('engagement_rate', 4)} AS avg_engagement_rate,
         CAST(COUNT(DISTINCT channel_title) AS BIGINT) AS unique_channels,
         CAST(COUNT(DISTINCT category_id) AS BIGINT) AS unique_categories,
         {HD_PCT} AS hd_percentage,
         {TIER_COUNTS}
  FROM {src}
  GROUP BY region, trending_date
)"""


TRENDING = trending_cte()

CHANNEL = f"""
channel_agg AS (
  SELECT channel_title, region, trending_date,
         CAST(COUNT(video_id) AS BIGINT) AS total_videos,
         CAST(SUM(views) AS BIGINT) AS total_views,
         CAST(SUM(likes) AS BIGINT) AS total_likes,
         CAST(SUM(comment_count) AS BIGINT) AS total_comments,
         {_imean('views')} AS avg_views_per_video,
         MAX(views) AS peak_views,
         {_mean('engagement_rate', 4)} AS avg_engagement_rate,
         {_mean('like_ratio', 4)} AS avg_like_ratio,
         CAST(COUNT(DISTINCT trending_date) AS BIGINT) AS times_trending,
         MIN(trending_date) AS first_trending_date,
         MAX(trending_date) AS last_trending_date,
         list_sort(list(DISTINCT category_name)) AS categories
  FROM facts
  GROUP BY channel_title, region, trending_date
),
channel_tier_n AS (
  SELECT channel_title, region, trending_date, views_tier, COUNT(*) AS n
  FROM facts WHERE views_tier IS NOT NULL
  GROUP BY channel_title, region, trending_date, views_tier
),
channel_tier AS (
  SELECT channel_title, region, trending_date, views_tier AS primary_views_tier FROM (
    SELECT *, row_number() OVER (PARTITION BY channel_title, region, trending_date
                                 ORDER BY n DESC, views_tier ASC) AS _rn
    FROM channel_tier_n)
  WHERE _rn = 1
),
channel AS (
  SELECT a.*, t.primary_views_tier,
         CAST(row_number() OVER (PARTITION BY a.region, a.trending_date
              ORDER BY a.total_views DESC NULLS LAST, a.channel_title ASC NULLS FIRST) AS INTEGER)
           AS rank_in_region
  FROM channel_agg a
  LEFT JOIN channel_tier t
    ON a.channel_title IS NOT DISTINCT FROM t.channel_title
   AND a.region = t.region AND a.trending_date = t.trending_date
)"""

CATEGORY = f"""
category_agg AS (
  SELECT category_name, category_id, region, trending_date,
         CAST(COUNT(video_id) AS BIGINT) AS video_count,
         CAST(SUM(views) AS BIGINT) AS total_views,
         CAST(SUM(likes) AS BIGINT) AS total_likes,
         CAST(SUM(comment_count) AS BIGINT) AS total_comments,
         {_mean('engagement_rate', 4)} AS avg_engagement_rate,
         {_mean('like_ratio', 4)} AS avg_like_ratio,
         CAST(COUNT(DISTINCT channel_title) AS BIGINT) AS unique_channels,
         MAX(views) AS top_video_views,
         {HD_PCT} AS hd_percentage
  FROM facts
  GROUP BY category_name, category_id, region, trending_date
),
category AS (
  SELECT *,
         round(CASE WHEN SUM(total_views) OVER (PARTITION BY region, trending_date) = 0 THEN NULL
                    ELSE total_views * 1.0e0 / SUM(total_views) OVER (PARTITION BY region, trending_date)
               END * 100, 2) + 0e0 AS view_share_pct,
         CAST(row_number() OVER (PARTITION BY region, trending_date
              ORDER BY total_views DESC NULLS LAST, category_id ASC NULLS FIRST,
                       category_name ASC NULLS FIRST) AS INTEGER) AS rank_on_day
  FROM category_agg
)"""

VELOCITY = f"""
vel_lag AS (
  SELECT video_id, title, channel_title, category_name, region, trending_date, views, likes,
         comment_count, engagement_rate, views_tier,
         lag(views) OVER w AS prev_views,
         lag(likes) OVER w AS prev_likes,
         lag(trending_date) OVER w AS prev_trending_date
  FROM facts
  WINDOW w AS (PARTITION BY video_id, region ORDER BY trending_date)
),
vel_delta AS (
  SELECT *, views - prev_views AS view_delta, likes - prev_likes AS like_delta,
         CAST(date_diff('day', prev_trending_date, trending_date) AS INTEGER) AS days_since_prev
  FROM vel_lag WHERE prev_views IS NOT NULL
),
vel_growth AS (
  SELECT *,
         {_pct('view_delta', 'prev_views', 2)} AS view_growth_pct,
         CASE WHEN days_since_prev > 0 THEN round(view_delta * 1.0e0 / days_since_prev, 0) + 0e0
              ELSE CAST(view_delta AS DOUBLE) END AS views_per_day
  FROM vel_delta
),
velocity AS (
  SELECT video_id, title, channel_title, category_name, prev_trending_date, days_since_prev,
         views, prev_views, view_delta, view_growth_pct, views_per_day, likes, prev_likes,
         like_delta, engagement_rate, views_tier,
         {_band('view_growth_pct', MOMENTUM_BANDS, DEFAULT_MOMENTUM)} AS momentum,
         region, trending_date
  FROM vel_growth
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


BASE = (LINES, RAW_STATS, CLEAN_STATS)
GOLD_BASE = (LINES, RAW_STATS, CLEAN_STATS, RAW_CATS, FACTS)


def _channel_public(src: str = "channel") -> str:
    return f"""SELECT channel_title, total_videos, total_views, total_likes, total_comments,
       avg_views_per_video, peak_views, avg_engagement_rate, avg_like_ratio, times_trending,
       first_trending_date, last_trending_date, array_to_string(categories, ',') AS categories,
       primary_views_tier, rank_in_region, region, trending_date
FROM {src}"""


GOLD_ALL = (*GOLD_BASE, TRENDING, CHANNEL, CATEGORY, VELOCITY)

# Gold tables under the names the analyst SQL uses.
GOLD_VIEWS = """
channel_analytics AS (SELECT * FROM channel),
category_analytics AS (SELECT * FROM category),
trending_analytics AS (SELECT * FROM trending),
video_velocity AS (SELECT * FROM velocity)"""


def _mean9(c: str, scale: int = 9) -> str:
    return _mean(c, scale)


ANALYST = {
    "q1": """
SELECT channel_title,
       CAST(COUNT(DISTINCT region) AS BIGINT) AS regions_trended,
       CAST(SUM(total_views) AS BIGINT) AS total_views,
       CAST(SUM(total_videos) AS BIGINT) AS total_trending_videos
FROM channel_analytics
GROUP BY channel_title
ORDER BY total_views DESC, channel_title ASC
LIMIT 10""",
    "q2": f"""
SELECT region, category_name,
       CAST(SUM(total_views) AS BIGINT) AS total_views,
       {_mean9('avg_engagement_rate')} AS avg_engagement
FROM category_analytics
GROUP BY region, category_name""",
    "q3": """
SELECT region, rank_in_region, channel_title, total_videos,
       round(total_views / 1e6, 2) + 0e0 AS total_views_millions,
       round(avg_engagement_rate, 4) + 0e0 AS avg_engagement_rate,
       primary_views_tier, array_to_string(categories, ',') AS categories
FROM channel_analytics
WHERE trending_date = (SELECT MAX(trending_date) FROM channel_analytics)
  AND rank_in_region <= 10""",
    "q4": """
SELECT title, region, views, view_growth_pct, momentum
FROM video_velocity
WHERE momentum IN ('surging', 'growing')
ORDER BY view_growth_pct DESC, video_id, region, trending_date
LIMIT 20""",
    "q5": f"""
SELECT region,
       round({_mean9('avg_engagement_rate')}, 2) + 0e0 AS avg_engagement_rate,
       CAST(SUM(total_comments) AS BIGINT) AS total_comments,
       CAST(SUM(total_likes) AS BIGINT) AS total_likes
FROM trending_analytics
GROUP BY region""",
    "q6": f"""
SELECT momentum, CAST(COUNT(*) AS BIGINT) AS video_count,
       {_mean('view_growth_pct', 2)} AS avg_growth_pct
FROM video_velocity
GROUP BY momentum""",
    "q7": f"""
SELECT channel_title,
       round({_mean('avg_views_per_video', 4)}, 1) + 0e0 AS avg_views,
       CAST(SUM(total_videos) AS BIGINT) AS total_videos
FROM channel_analytics
GROUP BY channel_title
HAVING SUM(total_videos) >= 3
ORDER BY avg_views DESC, channel_title ASC
LIMIT 10""",
    "q8": """
SELECT title, region, view_growth_pct, momentum
FROM video_velocity
WHERE momentum IN ('declining', 'fading')
ORDER BY view_growth_pct ASC, video_id, region, trending_date
LIMIT 20""",
}


def _oracles() -> dict[str, str]:
    silver = (*BASE, )
    gold_base = GOLD_BASE
    o = {
        "silver_clean": with_ctes(*silver, body="SELECT * FROM clean_stats"),
        "derived_metrics": with_ctes(*silver, body="""
SELECT video_id, region, trending_date, ingestion_id, views, likes, comment_count,
       like_ratio, engagement_rate, views_tier
FROM metric_stats"""),
        "views_tier": with_ctes(*silver, body="""
SELECT views_tier, CAST(COUNT(*) AS BIGINT) AS videos, MIN(views) AS min_views,
       MAX(views) AS max_views
FROM silver_stats GROUP BY views_tier"""),
        "dedup_latest": with_ctes(*silver, body="SELECT * FROM silver_stats"),
        "dedup_category": with_ctes(LINES, RAW_CATS, body="SELECT * FROM silver_cats"),
        "silver_run_metrics": with_ctes(LINES, RAW_STATS, body="""
SELECT CAST(COUNT(*) AS BIGINT) AS raw_rows,
       CAST(count_if(video_id IS NULL OR video_id = '') AS BIGINT) AS null_id_dropped,
       CAST(COUNT(*) - count_if(video_id IS NULL OR video_id = '')
            - COUNT(DISTINCT CASE WHEN video_id <> '' THEN
                (video_id, lower(trim(region)), trending_date) END) AS BIGINT) AS duplicates_removed,
       CAST(COUNT(DISTINCT CASE WHEN video_id <> '' THEN
                (video_id, lower(trim(region)), trending_date) END) AS BIGINT) AS clean_rows
FROM raw_stats"""),
        "category_lookup": with_ctes(LINES, RAW_CATS, body="SELECT * FROM cat_lookup"),
        "category_join_unknown": with_ctes(*gold_base, body="""
SELECT video_id, region, trending_date, category_id, category_name FROM facts"""),
        "trending_analytics": with_ctes(*gold_base, TRENDING, body="SELECT * FROM trending"),
        "channel_analytics": with_ctes(*gold_base, CHANNEL, body=_channel_public()),
        "channel_rank": with_ctes(*gold_base, CHANNEL, body="""
SELECT channel_title, region, trending_date, total_views, rank_in_region FROM channel"""),
        "channel_lifetime": with_ctes(*gold_base, body="""
SELECT channel_title, region,
       CAST(COUNT(DISTINCT trending_date) AS BIGINT) AS times_trending,
       MIN(trending_date) AS first_trending_date, MAX(trending_date) AS last_trending_date
FROM facts GROUP BY channel_title, region"""),
        "channel_primary_tier": with_ctes(*gold_base, CHANNEL, body="""
SELECT channel_title, region, trending_date, primary_views_tier FROM channel"""),
        "channel_categories": with_ctes(*gold_base, CHANNEL, body="""
SELECT channel_title, region, trending_date, array_to_string(categories, ',') AS categories
FROM channel"""),
        "category_analytics": with_ctes(*gold_base, CATEGORY, body="SELECT * FROM category"),
        "category_share": with_ctes(*gold_base, CATEGORY, body="""
SELECT category_name, category_id, region, trending_date, total_views, view_share_pct
FROM category"""),
        "category_rank": with_ctes(*gold_base, CATEGORY, body="""
SELECT category_name, category_id, region, trending_date, total_views, rank_on_day
FROM category"""),
        "video_velocity": with_ctes(*gold_base, VELOCITY, body="SELECT * FROM velocity"),
        "momentum": with_ctes(*gold_base, VELOCITY, body="""
SELECT momentum, CAST(COUNT(*) AS BIGINT) AS videos, MIN(view_growth_pct) AS min_growth_pct,
       MAX(view_growth_pct) AS max_growth_pct
FROM velocity GROUP BY momentum"""),
    }
    o.update(_bronze_oracles())
    o.update(_incremental_oracles())
    o.update(_dq_oracles())
    for name, body in ANALYST.items():
        sql = with_ctes(*GOLD_ALL, GOLD_VIEWS, body=body)
        o[name] = sql
        o[f"{name}_sql"] = sql
    return o


def _gold_published() -> str:
    """Rows and a total per version, table, region and day. The first version is Gold of the earlier Silver; as days that
    aren't planned again had all their rows there, the second is Gold of all of it."""
    parts = []
    for version, src in ((1, "early"), (2, "facts")):
        for table, keys in (("trending_analytics", "region"), ("channel_analytics", "channel_title"), ("category_analytics", "category_name, category_id")):
            parts.append(f"""
SELECT CAST({version} AS INTEGER) AS version, '{table}' AS table_name, region, trending_date, COUNT(*) AS n_rows, CAST(SUM(v) AS BIGINT) AS total
FROM (SELECT region, trending_date, SUM(views) AS v FROM {src} GROUP BY region, trending_date, {keys}) GROUP BY region, trending_date""")
        parts.append(f"""
SELECT CAST({version} AS INTEGER), 'video_velocity', region, trending_date, COUNT(*), CAST(SUM(views - prev) AS BIGINT)
FROM (SELECT *, lag(views) OVER (PARTITION BY video_id, region ORDER BY trending_date) AS prev FROM {src})
WHERE prev IS NOT NULL GROUP BY region, trending_date""")
    return with_ctes(*GOLD_BASE, SCENARIO, body="\nUNION ALL".join(parts))


def oracle_queries() -> dict[str, str]:
    return _oracles()


ISO = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"


def _bronze_oracles() -> dict[str, str]:
    return {
        "flatten_stats": with_ctes(LINES, RAW_STATS, body=f"""
SELECT video_id, region, title, channel_title, category_id,
       {ISO.format(c='publish_time')} AS publish_time, description, audio_language,
       views, likes, dislikes, comment_count, favorite_count, duration, definition,
       {ISO.format(c='ingestion_timestamp')} AS ingestion_timestamp, ingestion_id
FROM raw_stats"""),
        "flatten_categories": with_ctes(LINES, RAW_CATS, body=f"""
SELECT category_id, category_name, assignable, etag, region,
       {ISO.format(c='ingestion_timestamp')} AS ingestion_timestamp
FROM raw_cats"""),
        "land_roundtrip": with_ctes(*BASE, body="""
SELECT * REPLACE (CAST(ingestion_timestamp AS DATE) AS trending_date) FROM clean_stats"""),
    }


ORDER_KIND = "CAST(string_split(ingestion_id, '_')[-1] AS BIGINT) % 10"
FIRST_VERSION = "year(ingestion_timestamp) < 1995"


def _whole_run() -> str:
    """Long rows: item, name, value."""
    one = "CAST({v} AS BIGINT) AS value"
    row = lambda item, name, v, rest="": f"SELECT '{item}' AS item, '{name}' AS name, {one.format(v=v)} {rest}"
    parts = [
        row("silver", "raw_rows", "COUNT(*)", "FROM raw_stats"),
        row("silver", "null_id_dropped", "count_if(video_id IS NULL OR video_id = '')", "FROM raw_stats"),
        row("silver", "duplicates_removed", "(SELECT COUNT(*) FROM clean_stats) - (SELECT COUNT(*) FROM silver_stats)"),
        row("silver", "silver_rows", "COUNT(*)", "FROM silver_stats"),
        row("silver", "quarantined", 2 * len(ADAPTER_REGIONS)),
        row("gate", "open", 1), row("gold", "ok", 1), row("second run", "noop", 1), row("gate without a region", "open", 0),
        row("gate without tables", "unread", 2), row("velocity of the first day", "rows", 0),
    ]
    for region in (*ADAPTER_REGIONS, "atlantis"):
        here = f"FROM raw_stats WHERE region = '{region}'"
        known = int(region in ADAPTER_REGIONS)
        parts += [
            row(f"region {region}", "documents", f"COUNT(DISTINCT ingestion_id) + {2 * known}", here), row(f"region {region}", "bad_documents", 2 * known),
            row(f"region {region}", "items", "COUNT(*)", here), row(f"region {region}", "missing", 1 - known), row(f"region {region}", "failed", 1 - known),
        ]
    for table, src, column in (("trending_analytics", "trending", "total_views"), ("channel_analytics", "channel", "total_views"),
                               ("category_analytics", "category", "total_views"), ("video_velocity", "velocity", "view_delta")):
        parts += [row(table, "rows", "COUNT(*)", f"FROM {src}"), row(table, column, f"SUM({column})", f"FROM {src}"), row(table, "written", "COUNT(*)", f"FROM {src}")]
    return with_ctes(*GOLD_ALL, body="\nUNION ALL\n".join(parts))


SCENARIO = """
bounds AS (SELECT MAX(trending_date) AS latest FROM facts),
early AS (
  SELECT f.* FROM facts f, bounds b
  WHERE f.trending_date < b.latest - INTERVAL 3 MONTH
     OR (f.trending_date = b.latest
         AND f.ingestion_timestamp < CAST(b.latest + INTERVAL 14 DAY AS TIMESTAMP))
),
plan AS (
  SELECT trending_date, bool_or(is_new) AS is_new, bool_or(is_today) AS is_today FROM (
    SELECT trending_date, TRUE AS is_new, FALSE AS is_today FROM (
      SELECT DISTINCT trending_date FROM facts
      EXCEPT SELECT DISTINCT trending_date FROM early)
    UNION ALL
    SELECT DISTINCT f.trending_date, FALSE, TRUE FROM facts f, bounds b
    WHERE f.trending_date = b.latest)
  GROUP BY trending_date
),
planned_facts AS (SELECT * FROM facts WHERE trending_date IN (SELECT trending_date FROM plan))"""


def _incremental_oracles() -> dict[str, str]:
    found = {
        "incremental_dates": with_ctes(*GOLD_BASE, SCENARIO, body="SELECT * FROM plan"),
        "incremental_velocity": with_ctes(*GOLD_BASE, SCENARIO, VELOCITY, body="""
SELECT * FROM velocity WHERE trending_date IN (SELECT trending_date FROM plan)"""),
        "backfill_dates": with_ctes(*GOLD_BASE, body="""
SELECT DISTINCT trending_date, FALSE AS is_new, FALSE AS is_today
FROM facts
WHERE trending_date IN ((SELECT MIN(trending_date) FROM facts),
                        (SELECT MAX(trending_date) FROM facts),
                        (SELECT CAST(date_trunc('month', MIN(trending_date)) - INTERVAL 1 MONTH AS DATE) FROM facts))"""),
        "dq_sampled": with_ctes(*BASE, body="\nUNION ALL\n".join(
            f"SELECT '{name}' AS name, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(count_if({rule}) AS BIGINT) AS n_exact, TRUE AS covered FROM silver_stats"
            for name, rule in (("null_video_id", "video_id IS NULL"), ("null_title", "title IS NULL"), ("null_views", "views IS NULL"),
                               ("zero_views", "views = 0"), ("hd", "definition = 'hd'"), *((f"tier_{t}", f"views_tier = '{t}'") for t in TIER_NAMES)))),
        "whole_run": _whole_run(),
        "quarantine_replay": with_ctes(LINES, RAW_STATS, body=f"""
SELECT stage, region, CAST(count_if(read) AS BIGINT) AS n_rows, CAST(COUNT(DISTINCT CASE WHEN read THEN video_id END) AS BIGINT) AS n_videos,
       CAST(COUNT(DISTINCT CASE WHEN NOT read THEN ingestion_id END) AS BIGINT) AS n_dead
FROM (SELECT *, {ORDER_KIND} AS kind FROM raw_stats) r,
     LATERAL (SELECT 'before' AS stage, kind > 1 AS read UNION ALL SELECT 'after', kind <> 1) s
GROUP BY stage, region"""),
        "schema_versions": with_ctes(LINES, RAW_STATS.replace("raw_stats AS", "all_stats AS"), f"""
raw_stats AS (
  SELECT * REPLACE (CASE WHEN {FIRST_VERSION} THEN NULL ELSE duration END AS duration,
                    CASE WHEN {FIRST_VERSION} THEN NULL ELSE definition END AS definition,
                    CASE WHEN {FIRST_VERSION} THEN NULL ELSE favorite_count END AS favorite_count)
  FROM all_stats)""", CLEAN_STATS, body="""
SELECT * REPLACE (CAST(ingestion_timestamp AS DATE) AS trending_date) FROM clean_stats"""),
        "velocity_daily": with_ctes(*GOLD_BASE, VELOCITY, body="SELECT * FROM velocity"),
        "velocity_late_day": with_ctes(*GOLD_BASE, VELOCITY, body="SELECT * FROM velocity"),
        "channel_with_lifetime": with_ctes(*GOLD_BASE, CHANNEL, body=f"""
SELECT p.*, l.times_trending AS lifetime_times_trending, l.first_trending_date AS lifetime_first_date,
       l.last_trending_date AS lifetime_last_date
FROM ({_channel_public()}) p
JOIN (SELECT channel_title, region, CAST(COUNT(DISTINCT trending_date) AS BIGINT) AS times_trending,
             MIN(trending_date) AS first_trending_date, MAX(trending_date) AS last_trending_date
      FROM facts GROUP BY channel_title, region) l
  ON p.channel_title IS NOT DISTINCT FROM l.channel_title AND p.region = l.region"""),
        "distinct_over_days": with_ctes(*GOLD_BASE, body="""
SELECT region, CAST(COUNT(DISTINCT channel_title) AS BIGINT) AS channels, CAST(COUNT(DISTINCT video_id) AS BIGINT) AS videos,
       TRUE AS channels_within, TRUE AS videos_within
FROM facts WHERE trending_date > (SELECT MAX(trending_date) FROM facts) - INTERVAL 12 MONTH
GROUP BY region"""),
        "silver_write": with_ctes(*BASE, body="SELECT * FROM silver_stats"),
        "category_write": with_ctes(LINES, RAW_CATS, body="SELECT * FROM silver_cats"),
        "late_region": with_ctes(*GOLD_BASE, CATEGORY, body="SELECT * FROM category"),
        "incremental_gold": with_ctes(
            *GOLD_BASE, SCENARIO, trending_cte("existing", "early"), trending_cte("updates", "planned_facts"),
            body="""
SELECT * FROM existing e
WHERE NOT EXISTS (SELECT 1 FROM updates u
                  WHERE u.region = e.region AND u.trending_date = e.trending_date)
UNION ALL
SELECT * FROM updates"""),
    }
    found["gold_by_name"] = found["incremental_gold"]
    found["gold_published"] = _gold_published()
    return found


FACT_CRITICAL = ("video_id", "title", "channel_title", "category_id", "views", "likes", "region",
                 "trending_date", "engagement_rate", "views_tier")
DIM_CRITICAL = ("category_id", "category_name", "region")
ADAPTER_REGIONS = ("africa", "america", "asia", "europe", "middle east")
CHECK_CLOCK = "2001-11-05 00:00:00"
TIERS_SQL = ", ".join(f"'{t}'" for t in TIER_NAMES)
REGIONS_SQL = ", ".join(f"'{r}'" for r in ADAPTER_REGIONS)


def _dq_rows(table: str, src: str, critical, value_checks: bool, freshness: bool) -> str:
    parts = [f"""SELECT 'row_count' AS "check", '{table}' AS table_name, CAST(NULL AS VARCHAR) AS column_name,
       CAST(COUNT(*) AS DOUBLE) AS value, 10.0e0 AS threshold, COUNT(*) >= 10 AS passed FROM {src}"""]
    for c in critical:
        pct = f"CASE WHEN COUNT(*) > 0 THEN count_if({c} IS NULL) * 1.0e0 / COUNT(*) * 100 ELSE 0.0 END"
        parts.append(f"""SELECT 'null_pct', '{table}', '{c}', round({pct}, 2) + 0e0, 5.0e0, {pct} <= 5.0 FROM {src}""")
    parts.append(f"SELECT 'schema', '{table}', NULL, 0.0e0, 0.0e0, TRUE")
    if value_checks:
        parts.append(f"""SELECT 'value_range', '{table}', 'views',
       CAST(count_if(views < 0) + count_if(views > 50000000000) AS DOUBLE), 0.0e0,
       count_if(views < 0) + count_if(views > 50000000000) = 0 FROM {src}""")
        for c in ("engagement_rate", "like_ratio"):
            parts.append(f"""SELECT 'value_range', '{table}', '{c}',
       CAST(count_if({c} < 0 OR {c} > 100) AS DOUBLE), 0.0e0, count_if({c} < 0 OR {c} > 100) = 0 FROM {src}""")
        bad = f"(views_tier IS NULL OR views_tier NOT IN ({TIERS_SQL}))"
        parts.append(f"""SELECT 'value_range', '{table}', 'views_tier',
       CAST(count_if({bad}) AS DOUBLE), 0.0e0, count_if({bad}) = 0 FROM {src}""")
        parts.append(f"""SELECT 'value_range', '{table}', 'region',
       CAST(COUNT(DISTINCT CASE WHEN region NOT IN ({REGIONS_SQL}) THEN region END) AS DOUBLE), 0.0e0,
       COUNT(DISTINCT CASE WHEN region NOT IN ({REGIONS_SQL}) THEN region END) = 0 FROM {src}""")
    if freshness:
        now = f"TIMESTAMP '{CHECK_CLOCK}'"
        parts.append(f"""SELECT 'freshness', '{table}', 'ingestion_timestamp',
       round((epoch_us({now}) - epoch_us(MAX(ingestion_timestamp))) * 1.0e0 / 3600000000, 2) + 0e0, 48.0e0,
       coalesce(MAX(ingestion_timestamp) >= {now} - INTERVAL 48 HOUR, FALSE) FROM {src}""")
    else:
        parts.append(f"SELECT 'freshness', '{table}', NULL, NULL, 48.0e0, TRUE")
    return "\nUNION ALL\n".join(parts)


DQ_ROWS = f"""
dq AS (
{_dq_rows('clean_statistics', 'silver_stats', FACT_CRITICAL, True, True)}
UNION ALL
{_dq_rows('clean_reference_data', 'silver_cats', DIM_CRITICAL, False, False)}
)"""


def _dq_oracles() -> dict[str, str]:
    base = (*BASE, RAW_CATS, DQ_ROWS)
    sel = 'SELECT "check", table_name, column_name, value, threshold, passed FROM dq WHERE '
    return {
        "dq_row_count": with_ctes(*base, body=sel + "\"check\" = 'row_count'"),
        "dq_null_pct": with_ctes(*base, body=sel + "\"check\" = 'null_pct'"),
        "dq_schema": with_ctes(*base, body=sel + "\"check\" = 'schema'"),
        "dq_ranges": with_ctes(*base, body=sel + "\"check\" = 'value_range' AND column_name IN "
                               "('views', 'engagement_rate', 'like_ratio')"),
        "dq_enums": with_ctes(*base, body=sel + "\"check\" = 'value_range' AND column_name IN "
                              "('views_tier', 'region')"),
        "dq_freshness": with_ctes(*base, body=sel + "\"check\" = 'freshness'"),
        "dq_verdict": with_ctes(*base, body="""
SELECT coalesce(bool_and(passed), FALSE) AS quality_passed,
       CAST(count_if(passed) AS BIGINT) AS checks_passed,
       CAST(COUNT(*) AS BIGINT) AS checks_total
FROM dq"""),
        "dq_invalid_values": with_ctes(*BASE, body="""
SELECT 'clean_statistics' AS table_name, 'region' AS column_name, region AS invalid_value, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM silver_stats WHERE region NOT IN ('africa', 'america') GROUP BY region"""),
        "dq_prewrite": with_ctes(*BASE, body="""
SELECT CAST(count_if(video_id IS NULL) AS BIGINT) AS null_video_id,
       CAST(count_if(title IS NULL) AS BIGINT) AS null_title,
       CAST(count_if(channel_title IS NULL) AS BIGINT) AS null_channel_title,
       CAST(count_if(views IS NULL) AS BIGINT) AS null_views,
       CAST(count_if(views < 0) AS BIGINT) AS negative_views,
       CAST(count_if(views = 0) AS BIGINT) AS zero_views
FROM silver_stats"""),
        "dq_staleness": with_ctes(*BASE, body=f"""
SELECT region, MAX(ingestion_timestamp) AS latest,
       round((epoch_us(TIMESTAMP '{CHECK_CLOCK}') - epoch_us(MAX(ingestion_timestamp))) * 1.0e0
             / 3600000000, 2) + 0e0 AS hours_since,
       MAX(ingestion_timestamp) < TIMESTAMP '{CHECK_CLOCK}' - INTERVAL 6 HOUR AS stale
FROM silver_stats GROUP BY region"""),
    }
