"""The registered queries as plain SQL over the driver's tables, for DuckDB."""

from __future__ import annotations

from chartloom.plans.testbed import CATEGORY, DAY, FETCHES, MIN_VIEWS, PAGE_SIZE, REGIONS

RETITLE_DAY = "2024-01-16"

CHART = """
per AS (
  SELECT user_id, event_type, CAST(ts AS DATE) AS d,
         min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS views,
         CAST(sum(CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 <> 0
                       THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END) AS BIGINT) AS likes
  FROM events GROUP BY ALL
),
u AS (SELECT user_id, min(first_ts) AS u_first FROM per GROUP BY user_id),
chart AS (
  SELECT CAST(per.user_id AS VARCHAR) AS video_id,
         p_name || CASE WHEN per.user_id % 7 = 0 AND d >= DATE '2024-01-16'
                        THEN ' v2' ELSE '' END AS video_title,
         strftime(u_first - p_size * INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS published_at,
         p_brand AS channel_id,
         p_brand || CASE WHEN p_brand LIKE '%3' AND d >= DATE '2024-01-20'
                         THEN ' TV' ELSE '' END AS channel_title,
         p_type AS category_id,
         CASE WHEN p_type = 'PROMO' THEN 'UNKNOWN' ELSE p_type END AS category_name,
         p_name AS video_tags,
         views AS view_count,
         likes AS like_count,
         CASE WHEN n > 1 THEN n END AS comment_count,
         CAST(row_number() OVER (PARTITION BY event_type, d
                                 ORDER BY views DESC, per.user_id) AS INTEGER) AS regional_rank,
         strftime(last_ts, '%Y-%m-%dT%H:%M:%SZ') AS pulled_at,
         event_type AS region_code,
         d AS ingest_date
  FROM per JOIN u USING (user_id) JOIN part ON p_partkey = per.user_id
),
day AS (SELECT * FROM chart WHERE ingest_date = DATE '%(DAY)s'),
tags AS (
  SELECT video_id, region_code, ingest_date, unnest(string_split(video_tags, ' ')) AS tag
  FROM chart
)
""".replace("%(DAY)s", DAY)

MEDIAN = "quantile_disc({0}, 0.5)"

HOURS = (
    "date_sub('hour', CAST(replace(replace(published_at, 'T', ' '), 'Z', '') AS TIMESTAMP),"
    " CAST(replace(replace(pulled_at, 'T', ' '), 'Z', '') AS TIMESTAMP))"
)
PUBLISH_HOUR = (
    "CAST(hour(CAST(replace(replace(published_at, 'T', ' '), 'Z', '') AS TIMESTAMP)"
    " + INTERVAL 3 HOUR) AS INTEGER)"
)

FLAT = """video_id, video_title, published_at, channel_id, channel_title, category_id,
  category_name, video_tags, view_count, like_count, comment_count, regional_rank, pulled_at,
  region_code, ingest_date"""


def versions(source: str, key: str, attr: str, date: str = "ingest_date") -> str:
    """Type-2 versions of an attribute as a subquery."""
    return f"""(
      SELECT {key}, {attr}, {date} AS valid_from,
             lead({date}) OVER (PARTITION BY {key} ORDER BY {date}) AS valid_to,
             lead({date}) OVER (PARTITION BY {key} ORDER BY {date}) IS NULL AS is_current
      FROM (SELECT *, lag({attr}) OVER w AS before, row_number() OVER w AS nth
            FROM (SELECT DISTINCT {key}, {attr}, {date} FROM {source}) AS seen
            WINDOW w AS (PARTITION BY {key} ORDER BY {date})) AS steps
      WHERE nth = 1 OR before IS DISTINCT FROM {attr})"""


VIDEO_VERSIONS = versions("chart", "video_id", "video_title")
EARLY = versions(
    f"(SELECT * FROM chart WHERE ingest_date < DATE '{RETITLE_DAY}')", "video_id", "video_title"
)
PRIORITY = versions(
    """(SELECT o_custkey, day, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority
        FROM (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders) AS o
        GROUP BY o_custkey, day)""",
    "o_custkey",
    "o_orderpriority",
    "day",
)
RETITLED = f"(SELECT DISTINCT video_id, video_title FROM chart WHERE ingest_date = DATE '{RETITLE_DAY}')"

CLOSED = f"""
  SELECT v.video_id, v.video_title, v.valid_from,
         CASE WHEN hit THEN DATE '{RETITLE_DAY}' ELSE v.valid_to END AS valid_to,
         CASE WHEN hit THEN false ELSE v.is_current END AS is_current
  FROM (SELECT e.*, coalesce(e.is_current AND b.video_id IS NOT NULL
                             AND e.video_title IS DISTINCT FROM b.video_title, false) AS hit
        FROM {EARLY} AS e LEFT JOIN {RETITLED} AS b USING (video_id)) AS v"""

OPENED = f"""
  SELECT * FROM closed
  UNION ALL
  SELECT video_id, video_title, DATE '{RETITLE_DAY}', CAST(NULL AS DATE), true
  FROM {RETITLED} AS b
  WHERE NOT EXISTS (SELECT 1 FROM closed AS c WHERE c.video_id = b.video_id AND c.is_current)"""

FIGURES = f"""count(*) AS row_count, count(DISTINCT video_id) AS unique_videos,
  count(DISTINCT channel_id) AS channels, CAST(sum(view_count) AS BIGINT) AS total_views,
  {MEDIAN.format('view_count')} AS median_views"""

FIGURE_NAMES = ("row_count", "unique_videos", "channels", "total_views", "median_views")
DELTAS = f"""
  SELECT ingest_date, {', '.join(FIGURE_NAMES)},
         {', '.join(
             f'nullif({f} - lag({f}) OVER (ORDER BY ingest_date), 0) AS {f}_delta'
             for f in FIGURE_NAMES)}
  FROM (SELECT ingest_date, {FIGURES} FROM chart GROUP BY ingest_date) AS f"""

PER_VIDEO = "(SELECT video_id, count(DISTINCT region_code) AS regions FROM {0} GROUP BY video_id)"

EXCLUSIVE = """
  SELECT m.region_code,
         CAST(sum(CASE WHEN regions = 1 THEN 1 ELSE 0 END) AS BIGINT) AS exclusive,
         CAST(sum(CASE WHEN regions > 1 THEN 1 ELSE 0 END) AS BIGINT) AS shared
  FROM {0} AS m JOIN """ + PER_VIDEO + """ AS p USING (video_id) GROUP BY m.region_code"""

PAIRS = """
  SELECT {1} a.region_code AS region_a, b.region_code AS region_b, count(*) AS shared
  FROM {0} AS a JOIN {0} AS b ON a.video_id = b.video_id AND a.ingest_date = b.ingest_date
  GROUP BY ALL"""

AVG_PAIRS = """
  SELECT a.region_code AS region_a, b.region_code AS region_b,
         round(count(*)::DOUBLE / count(DISTINCT a.ingest_date), 0) AS avg_shared
  FROM chart AS a JOIN chart AS b ON a.video_id = b.video_id AND a.ingest_date = b.ingest_date
  GROUP BY ALL"""

TOP5 = """(SELECT category_name FROM {0} GROUP BY category_name
           ORDER BY count(*) DESC, category_name LIMIT 5)"""

MIX = f"""
  SELECT region_code, category, count(*) AS videos,
         round(100::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY region_code), 1) AS pct
  FROM (SELECT region_code,
               CASE WHEN category_name IN {TOP5.format('day')} THEN category_name
                    ELSE 'Other' END AS category FROM day) AS m
  GROUP BY region_code, category"""

TREND = """
  SELECT category_name, count(*) AS videos, round(avg(h), {2}) AS avg_hours,
         round(quantile_disc(CAST(h AS DOUBLE), 0.5), {2}) AS median_hours
  FROM (SELECT category_name, """ + HOURS + """ AS h FROM {0}) AS t
  GROUP BY category_name HAVING count(*) >= {1}"""

BY_HOUR = f"""
  SELECT category_name, {PUBLISH_HOUR} AS publish_hour, count(*) AS videos
  FROM day WHERE category_name IN {TOP5.format('day')} GROUP BY ALL"""

STAYING = """
  SELECT days, count(*) AS videos
  FROM (SELECT video_id, count(DISTINCT ingest_date) AS days FROM chart GROUP BY video_id) AS p
  GROUP BY days"""

SEEN = """
  SELECT t.ingest_date, t.video_id, y.video_id IS NOT NULL AS seen_before
  FROM (SELECT DISTINCT ingest_date, video_id FROM chart) AS t
  LEFT JOIN (SELECT DISTINCT ingest_date, video_id FROM chart) AS y
    ON y.video_id = t.video_id AND y.ingest_date = t.ingest_date - 1"""

CHURN = f"""
  SELECT ingest_date, count(*) AS videos,
         CAST(sum(CASE WHEN seen_before THEN 0 ELSE 1 END) AS BIGINT) AS new_videos,
         round(100::DOUBLE * sum(CASE WHEN seen_before THEN 0 ELSE 1 END) / count(*), 1) AS new_pct
  FROM ({SEEN}) AS s GROUP BY ingest_date
  HAVING ingest_date > (SELECT min(ingest_date) FROM chart)"""

LATEST_CHANNELS = """(SELECT channel_id, arg_max(channel_title, ingest_date) AS channel_title
                      FROM {0} GROUP BY channel_id)"""

FACT = """
  SELECT video_id, region_code, ingest_date,
         CAST(strftime(ingest_date, '%Y%m%d') AS INTEGER) AS date_key,
         video_title, channel_title, category_name,
         upper(region_code[1]) || region_code[2:] AS region_name,
         view_count, like_count, comment_count, regional_rank, pulled_at
  FROM chart"""

# The titles that the raw zone's lookups give, and the chart named by the lookup of each date.
TITLES = f"""(
  SELECT DISTINCT p_type AS id, n, since, until,
         CASE n WHEN 1 THEN CASE WHEN p_type <> 'PROMO' THEN p_type END
                WHEN 2 THEN CASE WHEN p_type <> 'SMALL' THEN lower(p_type) END
                ELSE CASE p_type WHEN 'STANDARD' THEN 'STANDARD 3' WHEN 'PROMO' THEN NULL ELSE p_type END
         END AS title
  FROM part, (VALUES (1, DATE '{FETCHES[0]}', DATE '{FETCHES[1]}'), (2, DATE '{FETCHES[1]}', DATE '{FETCHES[2]}'),
                     (3, DATE '{FETCHES[2]}', CAST(NULL AS DATE))) AS f(n, since, until))"""
NAMED = f"""(
  SELECT c.* REPLACE (coalesce(t.title, 'UNKNOWN') AS category_name)
  FROM chart AS c LEFT JOIN {TITLES} AS t
    ON t.id = c.category_id AND t.since <= c.ingest_date AND (t.until > c.ingest_date OR t.until IS NULL))"""


def check(name: str, observed: str, expected: str = "0") -> str:
    return f"""
  SELECT '{name}' AS "check", CAST(o AS BIGINT) AS observed, CAST(e AS BIGINT) AS expected,
         o = e AS passed FROM (SELECT ({observed}) AS o, ({expected}) AS e) AS c"""


def matrix(pairs: str, value: str) -> str:
    cells = ", ".join(
        f"CAST(coalesce(sum(CASE WHEN region_b = '{r}' THEN {value} END), 0) AS BIGINT) AS \"{r}\""
        for r in REGIONS
    )
    names = ", ".join(f"('{r}')" for r in REGIONS)
    return f"""SELECT n.region_a, {cells}
  FROM (VALUES {names}) AS n(region_a) LEFT JOIN ({pairs}) AS p ON p.region_a = n.region_a
  GROUP BY n.region_a"""


_FLAT_ALL = f"SELECT {FLAT} FROM chart"

# Each video once a day, whatever its regions.
ONCE = "(SELECT ingest_date, video_id, max(view_count) AS once FROM chart GROUP BY ALL)"

# The first dimension that lacks a row, in tables that were thinned out for it.
MARKED = """SELECT *, CASE WHEN CAST(video_id AS BIGINT) % 11 = 0 THEN 'video'
    WHEN channel_title LIKE '%TV' THEN 'channel' WHEN category_id = 'PROMO' THEN 'category'
    WHEN region_code = 'view' THEN 'region' WHEN ingest_date < DATE '2024-01-05' THEN 'date' END AS missing FROM chart"""

# Over the chart; each gets the CTEs above in front.
ON_CHART = {
    "scan_ndjson": _FLAT_ALL,
    "scan_flat_partitioned": f"SELECT {FLAT} FROM day",
    "path_columns": "SELECT video_id AS id, region_code AS region, ingest_date FROM chart",
    "scan_manifest_batch": """SELECT video_id AS id, video_title AS title,
        CAST(view_count AS VARCHAR) AS viewCount, CAST(regional_rank AS VARCHAR) AS "rank",
        region_code AS region, ingest_date FROM chart""",
    "completeness_gate": f"""SELECT ingest_date FROM chart GROUP BY ingest_date
        HAVING count(DISTINCT region_code) = {len(REGIONS)}""",
    "raw_landing": """SELECT video_id, region_code, CAST(view_count AS VARCHAR) AS view_count,
        ingest_date FROM chart""",
    "sink_ndjson": _FLAT_ALL,
    "sink_partition_replace": f"""SELECT ingest_date, count(*) AS row_count,
        count(DISTINCT video_id) AS unique_videos,
        CAST(sum(view_count + CASE WHEN ingest_date = DATE '{DAY}' THEN 1 ELSE 0 END) AS BIGINT)
          AS total_views
        FROM chart GROUP BY ingest_date""",
    "rank_positions": """SELECT region_code, ingest_date, regional_rank AS "rank", video_id
        FROM chart""",
    "concat_pages": f"""SELECT region_code, ingest_date, page_no, n_items,
        CAST(coalesce(sum(n_items) OVER (PARTITION BY region_code, ingest_date ORDER BY page_no
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_offset
        FROM (SELECT region_code, ingest_date,
                     CAST((regional_rank - 1) // {PAGE_SIZE} AS INTEGER) AS page_no,
                     CAST(count(*) AS INTEGER) AS n_items
              FROM chart GROUP BY ALL) AS p""",
    "flatten_nested": "SELECT * EXCLUDE (category_name) FROM chart",
    "cast_counts": """SELECT video_id AS id, region_code AS region, ingest_date,
        view_count AS viewCount, like_count AS likeCount, comment_count AS commentCount
        FROM chart""",
    "array_default_empty": """SELECT video_id, region_code, ingest_date,
        CAST(CASE WHEN CAST(video_id AS BIGINT) % 5 = 0 THEN 0
             ELSE len(string_split(video_tags, ' ')) END AS INTEGER) AS n_tags FROM chart""",
    "staging_projection": _FLAT_ALL,
    "scope_filter": f"SELECT {FLAT} FROM day",
    "available_dates": "SELECT DISTINCT ingest_date FROM chart",
    "lookup_join_default": f"""SELECT video_id, region_code, ingest_date, category_id,
        category_name FROM {NAMED} AS c""",
    "lookup_versions": f"""SELECT id, title, min(since) AS valid_from, arg_max_null(until, n) AS valid_to
        FROM (SELECT *, n - row_number() OVER (PARTITION BY id, title ORDER BY n) AS period
              FROM {TITLES} AS t WHERE title IS NOT NULL) AS p GROUP BY id, title, period""",
    "lookup_unmatched": """SELECT category_id, count(*) AS row_count FROM chart
        WHERE category_name = 'UNKNOWN' GROUP BY category_id""",
    "dim_key_resolve": """SELECT category_id, category_name, count(*) AS row_count FROM chart
        GROUP BY ALL""",
    "self_pair_join": PAIRS.format("chart", "a.ingest_date,"),
    "semi_in_subquery": f"""SELECT * FROM {VIDEO_VERSIONS} AS v
        WHERE video_id IN (SELECT video_id FROM day)""",
    "anti_not_exists": f"""SELECT DISTINCT video_id, video_title FROM day AS t
        WHERE NOT EXISTS (SELECT 1 FROM chart AS c
                          WHERE c.video_id = t.video_id AND c.ingest_date < DATE '{DAY}')""",
    "left_join_previous_day": SEEN,
    "join_top_groups": f"""SELECT video_id, region_code, ingest_date, category_name FROM chart
        WHERE category_name IN {TOP5.format('chart')}""",
    "lateral_unnest": "SELECT video_id, region_code, ingest_date, tag FROM tags",
    "update_from_join": f"""SELECT t.channel_id, s.channel_title,
        t.channel_title IS DISTINCT FROM s.channel_title AS was_updated
        FROM {LATEST_CHANNELS.format(f"(SELECT * FROM chart WHERE ingest_date <= DATE '{DAY}')")} AS t
        JOIN {LATEST_CHANNELS.format('chart')} AS s USING (channel_id)""",
    "seed_insert_absent": """SELECT channel_id,
        CASE WHEN channel_id IN (SELECT channel_id FROM day) THEN 'seeded' ELSE 'added' END AS origin
        FROM (SELECT DISTINCT channel_id FROM chart) AS c""",
    "insert_absent_tags": f"""SELECT tag_name, min(ingest_date) <= DATE '{DAY}' AS was_known
        FROM (SELECT tag AS tag_name, ingest_date FROM tags UNION ALL
              SELECT 'day ' || strftime(ingest_date, '%Y-%m-%d'), ingest_date FROM chart) AS t
        GROUP BY tag_name""",
    "scd1_upsert": f"""SELECT channel_id, channel_title,
        channel_id IN (SELECT channel_id FROM day) AS kept_key
        FROM {LATEST_CHANNELS.format('chart')} AS c""",
    "scd2_close": CLOSED,
    "scd2_open": f"SELECT * FROM (WITH closed AS ({CLOSED}) {OPENED}) AS o",
    "scd2_apply_batch": f"SELECT * FROM (WITH closed AS ({CLOSED}) {OPENED}) AS o",
    "scd2_repair": "SELECT * FROM " + versions(
        f"""(SELECT video_id, ingest_date, CASE WHEN ingest_date = DATE '{RETITLE_DAY}'
                    THEN regexp_replace(video_title, ' v2$', '') ELSE video_title END AS video_title
             FROM chart WHERE ingest_date <> DATE '{RETITLE_DAY}' OR CAST(video_id AS BIGINT) % 4 <> 0)""",
        "video_id",
        "video_title",
    ) + " AS v",
    "scd2_from_history": f"SELECT * FROM {VIDEO_VERSIONS} AS v",
    "bridge_refresh": f"""
        SELECT l.video_id, v.video_title, l.tag_name
        FROM (SELECT DISTINCT video_id, unnest(list_append(string_split(video_tags, ' ')[2:], region_code)) AS tag_name
              FROM chart WHERE ingest_date = DATE '{RETITLE_DAY}'
              UNION ALL
              SELECT DISTINCT video_id, tag FROM tags
              WHERE ingest_date < DATE '{RETITLE_DAY}'
                AND video_id NOT IN (SELECT video_id FROM chart WHERE ingest_date = DATE '{RETITLE_DAY}')) AS l
        JOIN (SELECT video_id, arg_max(video_title, ingest_date) AS video_title FROM chart
              WHERE ingest_date <= DATE '{RETITLE_DAY}' GROUP BY video_id) AS v USING (video_id)""",
    "bridge_rows": f"""SELECT DISTINCT t.video_id, v.video_title, t.tag AS tag_name
        FROM tags AS t
        JOIN (SELECT video_id, max(ingest_date) AS last FROM chart GROUP BY video_id) AS l
          ON l.video_id = t.video_id AND l.last = t.ingest_date
        JOIN {VIDEO_VERSIONS} AS v ON v.video_id = t.video_id AND v.is_current""",
    "fact_load": FACT,
    "run_day": FACT,
    "stream_daily_load": f"""SELECT f.* REPLACE (l.category_name AS category_name)
        FROM ({FACT.replace('FROM chart', ', category_id FROM chart')}) AS f
        JOIN (SELECT category_id, arg_max(category_name, ingest_date) AS category_name
              FROM {NAMED} AS c GROUP BY category_id) AS l USING (category_id)""".replace(
        "f.* REPLACE", "f.* EXCLUDE (category_id) REPLACE"
    ),
    "idempotent_claim": f"""SELECT DISTINCT ingest_date FROM chart
        WHERE ingest_date > DATE '{DAY}'""",
    "backfill": f"""SELECT v.video_id, v.video_title, p.published_at, v.valid_from, v.valid_to,
        v.is_current
        FROM {VIDEO_VERSIONS} AS v
        JOIN (SELECT DISTINCT video_id, published_at FROM chart) AS p USING (video_id)""",
    "overview": f"SELECT {FIGURES} FROM day",
    "overview_delta": DELTAS,
    "overview_delta_day": f"SELECT * FROM ({DELTAS}) AS d WHERE ingest_date = DATE '{DAY}'",
    "spread": f"""SELECT count(*) AS videos,
        CAST(sum(CASE WHEN regions > 1 THEN 1 ELSE 0 END) AS BIGINT) AS shared_videos,
        100::DOUBLE * sum(CASE WHEN regions > 1 THEN 1 ELSE 0 END) / count(*) AS shared_pct
        FROM {PER_VIDEO.format('day')} AS p""",
    "category_mix": MIX,
    "category_order": f"""SELECT category, CAST(sum(videos) AS BIGINT) AS videos
        FROM ({MIX}) AS m GROUP BY category""",
    "chart_size": f"""SELECT region_code, count(*) AS videos,
        CAST(sum(view_count) AS BIGINT) AS total_views,
        {MEDIAN.format('view_count')} AS median_views FROM day GROUP BY region_code""",
    "region_overlap": PAIRS.format("day", ""),
    "exclusive_shared": EXCLUSIVE.format("day"),
    "exclusive_shared_all": EXCLUSIVE.format("chart"),
    "hours_to_trend": TREND.format("day", 5, 1),
    "hours_to_trend_all": TREND.format("chart", 30, 0),
    "publish_hour": BY_HOUR,
    "top_tags": f"""SELECT lower(tag) AS tag, count(*) AS uses FROM tags
        WHERE ingest_date = DATE '{DAY}' GROUP BY lower(tag) ORDER BY uses DESC, tag LIMIT 12""",
    "like_rate": f"""SELECT video_id, video_title, channel_title, region_code, ingest_date,
        view_count, like_count,
        round(100::DOUBLE * like_count / nullif(view_count, 0), 2) AS like_rate
        FROM day WHERE view_count > {MIN_VIEWS} AND like_count IS NOT NULL
        ORDER BY like_rate DESC, video_id, region_code LIMIT 40""",
    "cross_region": """SELECT video_id, CAST(count(DISTINCT region_code) AS INTEGER) AS regions,
        string_agg(DISTINCT region_code, ' ' ORDER BY region_code) AS charts,
        max(view_count) AS views, max(channel_title) AS channel, max(video_title) AS title
        FROM day GROUP BY video_id HAVING count(DISTINCT region_code) > 1
        ORDER BY regions DESC, views DESC NULLS LAST, video_id LIMIT 30""",
    "top_ranked": """SELECT ingest_date, region_code, regional_rank, view_count, channel_title,
        video_title FROM day WHERE regional_rank <= 5""",
    "top_channels": """SELECT channel_title, count(*) AS appearances,
        count(DISTINCT region_code) AS regions, CAST(sum(view_count) AS BIGINT) AS total_views
        FROM day GROUP BY channel_title
        ORDER BY appearances DESC, total_views DESC NULLS LAST, channel_title LIMIT 15""",
    "concentration": """SELECT CAST(sum(CASE WHEN rn <= 10 THEN n ELSE 0 END) AS BIGINT) AS top10_rows,
        CAST(sum(n) AS BIGINT) AS all_rows,
        100::DOUBLE * sum(CASE WHEN rn <= 10 THEN n ELSE 0 END) / sum(n) AS share_pct
        FROM (SELECT channel_title, count(*) AS n,
                     row_number() OVER (ORDER BY count(*) DESC, channel_title) AS rn
              FROM day GROUP BY channel_title) AS r""",
    "daily_totals": """SELECT ingest_date, count(*) AS row_count,
        count(DISTINCT video_id) AS unique_videos, CAST(sum(view_count) AS BIGINT) AS total_views
        FROM chart GROUP BY ingest_date""",
    "category_share": f"""SELECT region_code, count(*) AS rows_total,
        round(100::DOUBLE * sum(CASE WHEN category_name = '{CATEGORY}' THEN 1 ELSE 0 END)
              / count(*), 1) AS category_pct FROM chart GROUP BY region_code""",
    "avg_daily_overlap": AVG_PAIRS,
    "staying_power": STAYING,
    "one_day_share": f"""SELECT 100::DOUBLE * sum(CASE WHEN days = 1 THEN videos END) / sum(videos)
        AS one_day_pct FROM ({STAYING}) AS s HAVING sum(CASE WHEN days = 1 THEN videos END) IS NOT NULL""",
    "persistent_channels": """SELECT channel_title, count(DISTINCT ingest_date) AS days,
        count(DISTINCT video_id) AS videos, count(*) AS appearances
        FROM chart GROUP BY channel_title
        ORDER BY days DESC, appearances DESC, channel_title LIMIT 15""",
    "daily_churn": CHURN,
    "avg_turnover": f"SELECT avg(new_pct) AS avg_new_pct FROM ({CHURN}) AS c",
    "semi_additive_last": """SELECT video_id, region_code,
        CAST(weekofyear(ingest_date) AS INTEGER) AS period, max(ingest_date) AS last_date,
        arg_max_null(view_count, ingest_date) AS view_count FROM chart GROUP BY ALL""",
    "counter_delta": """SELECT video_id, ingest_date, view_count,
        lag(ingest_date) OVER w AS previous_date,
        view_count - lag(view_count) OVER w AS delta
        FROM (SELECT video_id, ingest_date, max(view_count) AS view_count FROM chart GROUP BY ALL) AS d
        WINDOW w AS (PARTITION BY video_id ORDER BY ingest_date)""",
    "dedup_region_sum": """SELECT ingest_date, count(*) AS videos,
        CAST(sum(once) AS BIGINT) AS total
        FROM (SELECT ingest_date, video_id, max(view_count) AS once FROM chart GROUP BY ALL) AS d
        GROUP BY ingest_date""",
    "tag_fanout_safe": f"""SELECT ingest_date, tag, count(*) AS videos, CAST(sum(once) AS BIGINT) AS total
        FROM (SELECT DISTINCT ingest_date, video_id, tag FROM tags) AS t JOIN {ONCE} AS o USING (ingest_date, video_id)
        GROUP BY ingest_date, tag
        UNION ALL
        SELECT ingest_date, NULL, count(*), CAST(sum(once) AS BIGINT) FROM {ONCE} AS o GROUP BY ingest_date""",
    "retitle_effect": f"""SELECT video_id, version_no, valid_from, video_title, days, avg_value,
        best_rank, avg_change
        FROM (SELECT *, count(*) OVER (PARTITION BY video_id) AS n,
                     CAST(row_number() OVER w AS INTEGER) AS version_no,
                     avg_value - lag(avg_value) OVER w AS avg_change
              FROM (SELECT v.video_id, v.valid_from, v.video_title, count(*) AS days,
                           avg(val) AS avg_value, min(rk) AS best_rank
                    FROM (SELECT video_id, ingest_date, max(view_count) AS val,
                                 min(regional_rank) AS rk FROM chart GROUP BY ALL) AS f
                    JOIN {VIDEO_VERSIONS} AS v ON v.video_id = f.video_id
                     AND v.valid_from <= f.ingest_date
                     AND (v.valid_to > f.ingest_date OR v.valid_to IS NULL)
                    GROUP BY ALL) AS p
              WINDOW w AS (PARTITION BY video_id ORDER BY valid_from)) AS r
        WHERE n > 1""",
    "rank_groups_global": """SELECT channel_title, count(*) AS appearances,
        row_number() OVER (ORDER BY count(*) DESC, channel_title) AS rn
        FROM chart GROUP BY channel_title""",
    "share_of_partition": """SELECT region_code, category_name, count(*) AS videos,
        round(100::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY region_code), 1) AS pct
        FROM chart GROUP BY region_code, category_name""",
    "top_k": """SELECT video_id, region_code, ingest_date, view_count FROM chart
        ORDER BY view_count DESC, video_id, region_code, ingest_date LIMIT 40""",
    "top_k_per_group": """SELECT region_code, ingest_date, video_id, view_count FROM chart
        QUALIFY row_number() OVER (PARTITION BY region_code
                ORDER BY view_count DESC, video_id, ingest_date) <= 5""",
    "union_regions": """SELECT region_code, count(*) AS row_count,
        CAST(sum(view_count) AS BIGINT) AS total_views FROM chart GROUP BY region_code""",
    "distinct_rows": "SELECT DISTINCT channel_id, channel_title FROM chart",
    "overlap_matrix": matrix(PAIRS.format("day", ""), "shared"),
    "avg_overlap_matrix": matrix(AVG_PAIRS, "avg_shared"),
    "publish_hour_grid": f"""SELECT category_name, {', '.join(
        f'CAST(coalesce(sum(CASE WHEN publish_hour = {h} THEN videos END), 0) AS BIGINT) AS h{h:02d}'
        for h in range(24))} FROM ({BY_HOUR}) AS b GROUP BY category_name""",
    "exclusive_shared_long": f"""SELECT region_code, 'exclusive' AS kind, exclusive AS videos
        FROM ({EXCLUSIVE.format('day')}) AS e
        UNION ALL SELECT region_code, 'shared', shared FROM ({EXCLUSIVE.format('day')}) AS e""",
    "region_names": f"""SELECT region_code, count(*) AS videos,
        CAST(sum(view_count) AS BIGINT) AS total_views,
        {MEDIAN.format('view_count')} AS median_views,
        upper(region_code[1]) || region_code[2:] AS region_name FROM chart GROUP BY region_code""",
    "check_row_reconciliation": check(
        "row_reconciliation", "SELECT count(*) FROM chart", "SELECT count(*) FROM chart"
    ),
    "check_single_current": check(
        "single_current",
        f"""SELECT count(*) FROM (SELECT video_id FROM {VIDEO_VERSIONS} AS v WHERE is_current
            GROUP BY video_id HAVING count(*) > 1) AS x""",
    ),
    "check_unique": check(
        "unique",
        """SELECT count(*) FROM (SELECT video_id, ingest_date FROM chart GROUP BY ALL
           HAVING count(*) > 1) AS x""",
    ),
    "check_not_null": check(
        "not_null", "SELECT count(*) FROM chart WHERE like_count IS NULL OR comment_count IS NULL"
    ),
    "check_row_reconciliation_broken": check(
        "row_reconciliation",
        f"SELECT count(*) FROM ({MARKED}) AS m WHERE missing IS NULL",
        "SELECT count(*) FROM chart",
    ),
    "rejected_rows": f"SELECT video_id, region_code, ingest_date, missing FROM ({MARKED}) AS m WHERE missing IS NOT NULL",
    "check_foreign_keys": check(
        "foreign_key", "SELECT count(DISTINCT category_id) FROM chart WHERE category_id = 'PROMO'"
    ),
    "check_batch_functional": check(
        "batch_functional",
        """SELECT count(*) FROM (SELECT channel_id FROM chart GROUP BY channel_id
           HAVING count(DISTINCT channel_title) > 1) AS x""",
    ),
    "check_bridge_complete": check(
        "bridge_complete", "SELECT count(*) FROM (SELECT DISTINCT video_id, region_code FROM chart) AS x"
    ),
    "stream_manifest_batches": f"SELECT {FLAT} FROM {NAMED} AS c",
    "stream_dedup_delivery": f"""SELECT ingest_date, CAST(1 AS BIGINT) AS claims,
        CASE WHEN ingest_date > DATE '{DAY}' THEN count(*) END AS merged_rows
        FROM chart GROUP BY ingest_date""",
}

# Over other tables.
ELSEWHERE = {
    "validity_join": f"""SELECT l_orderkey, l_linenumber, s.o_custkey, ship_date,
        v.valid_from AS since, v.o_orderpriority
        FROM (SELECT l_orderkey, l_linenumber, o_custkey, CAST(l_shipdate AS DATE) AS ship_date
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS s
        JOIN {PRIORITY} AS v ON v.o_custkey = s.o_custkey AND v.valid_from <= ship_date
         AND (v.valid_to > ship_date OR v.valid_to IS NULL)""",
    "scd2_customer_priority": f"SELECT * FROM {PRIORITY} AS v",
    "calendar_dim": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
        CAST(year(d) AS SMALLINT) AS "year", CAST(quarter(d) AS SMALLINT) AS "quarter",
        CAST(month(d) AS SMALLINT) AS "month", monthname(d) AS month_name,
        CAST(day(d) AS SMALLINT) AS day_of_month, CAST(dayofweek(d) AS SMALLINT) AS day_of_week,
        dayname(d) AS day_name
        FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate),
                                                 INTERVAL 1 DAY)) AS DATE) AS d FROM orders) AS s""",
    "lookup_union_last": """SELECT p_brand AS id, arg_max(p_name, p_partkey) AS title FROM part
        GROUP BY p_brand""",
    "surrogate_keys": """SELECT count(*) AS row_count, count(*) AS different_keys,
        CAST(1 AS BIGINT) AS lowest, count(*) AS highest,
        CAST(sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) AS BIGINT)
          AS kept
        FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) AS c""",
    "check_periods": check(
        "periods",
        f"""SELECT count(*) FROM (
            SELECT valid_to, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS nxt
            FROM {PRIORITY} AS v WHERE o_orderpriority <> '5-LOW') AS g
            WHERE valid_to IS DISTINCT FROM nxt""",
    ),
}

ORACLE = {
    **{name: f"WITH {CHART.strip()}\n{sql.strip()}" for name, sql in ON_CHART.items()},
    **{name: sql.strip() for name, sql in ELSEWHERE.items()},
}
