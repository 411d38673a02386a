"""Independent DuckDB SQL for every registered query.

The oracle derives the staged events straight from the flat driver
``events`` table (no nested layout), then rebuilds each model as plain
SQL.  Float sums are rounded to 2 places and averages/percentages to 6
on both sides, since summation order differs between engines.
"""

from __future__ import annotations

AS_OF = "2024-02-01 00:00:00"
STREAM_AS_OF = "2024-01-31 00:00:00"

_CHANNEL = """CASE
      WHEN lower(coalesce(src_source, '')) = '(direct)' AND lower(coalesce(src_medium, '')) = '(none)' THEN 'Direct'
      WHEN lower(coalesce(src_medium, '')) IN ('cpc', 'ppc', 'paid') AND lower(coalesce(src_source, '')) LIKE '%google%' THEN 'Paid Search'
      WHEN lower(coalesce(src_medium, '')) = 'organic' AND lower(coalesce(src_source, '')) LIKE '%google%' THEN 'Organic Search'
      WHEN lower(coalesce(src_medium, '')) IN ('cpc', 'ppc', 'paid') AND lower(coalesce(src_source, '')) LIKE '%facebook%' THEN 'Paid Social'
      WHEN lower(coalesce(src_source, '')) LIKE '%facebook%' OR lower(coalesce(src_source, '')) LIKE '%twitter%'
           OR lower(coalesce(src_source, '')) LIKE '%instagram%' THEN 'Organic Social'
      WHEN lower(coalesce(src_medium, '')) = 'email' THEN 'Email'
      WHEN lower(coalesce(src_medium, '')) = 'referral' THEN 'Referral'
      WHEN lower(coalesce(src_medium, '')) = 'affiliate' THEN 'Affiliate'
      ELSE 'Other' END"""

BASE = f"""
src AS (
  SELECT e.event_id AS src_id, e.ts, e.user_id AS uid, e.value AS val,
         CAST(regexp_extract(e.props, '[0-9]+') AS BIGINT) AS k,
         epoch_us(e.ts) AS event_timestamp,
         CASE e.event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
              WHEN 'signup' THEN 'begin_checkout' WHEN 'purchase' THEN 'purchase'
              WHEN 'error' THEN 'session_start' END AS event_name
  FROM events e
),
raw AS (
  SELECT *,
    strftime(ts, '%Y%m%d') AS event_date,
    event_timestamp // 43200000000 AS ga_session_id,
    CASE k % 10 WHEN 0 THEN 'google shopping' WHEN 1 THEN 'google maps' WHEN 2 THEN 'facebook feed' WHEN 3 THEN '(direct)'
      WHEN 4 THEN 'weekly letter' WHEN 5 THEN 'instagram' WHEN 6 THEN 'partner.example' WHEN 7 THEN 'aff.example'
      WHEN 8 THEN 'othersearch' END AS src_source,
    CASE k % 10 WHEN 0 THEN 'ppc' WHEN 1 THEN 'organic' WHEN 2 THEN 'paid' WHEN 3 THEN '(none)'
      WHEN 4 THEN 'email' WHEN 5 THEN 'profile' WHEN 6 THEN 'referral' WHEN 7 THEN 'affiliate'
      WHEN 8 THEN 'organic' END AS src_medium,
    CASE k % 10 WHEN 0 THEN 'autumn_range' WHEN 2 THEN 'come_back' WHEN 4 THEN 'digest_12' END AS src_campaign
  FROM src
  WHERE event_timestamp IS NOT NULL AND uid IS NOT NULL
),
flat AS (
  SELECT
    CAST(uid AS VARCHAR) || '-' || event_name || '-' || CAST(event_timestamp AS VARCHAR) AS event_id,
    event_date, event_timestamp, make_timestamp(event_timestamp) AS event_datetime, event_name,
    CAST(uid AS VARCHAR) AS user_pseudo_id, CAST(NULL AS VARCHAR) AS user_id,
    CAST(uid AS VARCHAR) || '-' || CAST(ga_session_id AS VARCHAR) AS session_id,
    ga_session_id, 1 + ga_session_id % 5 AS ga_session_number,
    coalesce(src_source, '(direct)') AS traffic_source,
    coalesce(src_medium, '(none)') AS traffic_medium,
    src_campaign AS traffic_campaign,
    {_CHANNEL} AS channel,
    CASE k % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_category,
    CASE k % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Windows' ELSE 'Android' END AS device_os,
    CASE k % 3 WHEN 0 THEN 'Safari' ELSE 'Chrome' END AS device_browser,
    CASE uid % 4 WHEN 0 THEN 'NO' WHEN 1 THEN 'NO' WHEN 2 THEN 'PT' ELSE 'FI' END AS country,
    CASE uid % 4 WHEN 0 THEN 'Vestland' WHEN 1 THEN 'Agder' WHEN 2 THEN 'Norte' ELSE 'Uusimaa' END AS region,
    CASE uid % 4 WHEN 0 THEN 'Bergen' WHEN 1 THEN 'Arendal' WHEN 2 THEN 'Braga' ELSE 'Espoo' END AS city,
    CASE WHEN event_name = 'purchase' THEN 'T' || CAST(src_id AS VARCHAR) END AS transaction_id,
    CASE WHEN event_name = 'purchase' THEN val END AS purchase_revenue,
    CASE WHEN event_name = 'purchase' THEN 1 + k % 3 END AS total_item_quantity,
    'https://shop.example/' || event_name AS page_location,
    CAST(NULL AS VARCHAR) AS page_title,
    1000 + 100 * k AS engagement_time_msec,
    CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS session_engaged,
    CASE WHEN event_name = 'begin_checkout' THEN CAST(floor(val) AS BIGINT) END AS event_value_param,
    coalesce(CASE WHEN event_name = 'purchase' THEN val END,
             CAST(CASE WHEN event_name = 'begin_checkout' THEN CAST(floor(val) AS BIGINT) END AS DOUBLE)) AS event_value,
    'WEB' AS platform, 'adapter-web' AS stream_id
  FROM raw
),
stg_events AS (
  SELECT *,
    coalesce(traffic_source = '(direct)' AND traffic_medium = '(none)', false) AS is_direct_traffic,
    coalesce(event_name IN ('purchase', 'begin_checkout', 'add_to_cart'), false) AS is_conversion_event,
    coalesce(event_name = 'page_view', false) AS is_pageview,
    coalesce(event_name = 'session_start' OR ga_session_number = 1, false) AS is_session_start
  FROM flat
  WHERE event_name IS NOT NULL
    AND event_datetime >= TIMESTAMP '2020-01-01 00:00:00'
    AND event_datetime <= CAST(now() AS TIMESTAMP)
),
stg_sessions AS (
  SELECT session_id, user_pseudo_id, user_id,
    CAST(min(event_datetime) AS DATE) AS session_date,
    min(event_datetime) AS session_start_time,
    max(event_datetime) AS session_end_time,
    date_sub('second', min(event_datetime), max(event_datetime)) AS session_duration_seconds,
    arg_min_null(traffic_source, event_timestamp) AS session_traffic_source,
    arg_min_null(traffic_medium, event_timestamp) AS session_traffic_medium,
    arg_min_null(traffic_campaign, event_timestamp) AS session_traffic_campaign,
    arg_min_null(channel, event_timestamp) AS session_channel,
    arg_min_null(device_category, event_timestamp) AS device_category,
    arg_min_null(device_os, event_timestamp) AS device_os,
    arg_min_null(device_browser, event_timestamp) AS device_browser,
    arg_min_null(country, event_timestamp) AS country,
    arg_min_null(region, event_timestamp) AS region,
    arg_min_null(city, event_timestamp) AS city,
    count(*) AS total_events,
    count_if(is_pageview) AS pageviews,
    count_if(is_conversion_event) AS conversion_events,
    count_if(event_name = 'purchase') AS purchases,
    sum(engagement_time_msec) / 1000 AS engagement_time_seconds,
    bool_or(coalesce(session_engaged = '1', false)) AS is_engaged_session,
    sum(CASE WHEN event_name = 'purchase' THEN coalesce(purchase_revenue, 0) ELSE 0 END) AS session_revenue,
    arg_min_null(page_location, event_timestamp) AS landing_page,
    max(ga_session_number) AS ga_session_number,
    bool_or(is_direct_traffic) AS is_direct_traffic,
    bool_or(event_name = 'purchase') AS has_purchase,
    bool_or(event_name = 'begin_checkout') AS has_checkout,
    bool_or(event_name = 'add_to_cart') AS has_add_to_cart
  FROM stg_events
  GROUP BY session_id, user_pseudo_id, user_id
),
stg_conversions AS (
  SELECT
    user_pseudo_id || '-' || event_name || '-' || CAST(event_timestamp AS VARCHAR) AS conversion_id,
    event_id,
    CAST(strptime(event_date, '%Y%m%d') AS DATE) AS conversion_date,
    event_datetime AS conversion_datetime,
    event_timestamp AS conversion_timestamp,
    event_name AS conversion_event,
    user_pseudo_id, user_id, session_id,
    coalesce(purchase_revenue, event_value, 0) AS conversion_value,
    transaction_id, total_item_quantity,
    event_datetime - INTERVAL 14 DAY AS attribution_window_start,
    event_datetime AS attribution_window_end,
    channel AS conversion_channel,
    traffic_source AS conversion_traffic_source,
    page_location AS conversion_page,
    device_category, device_os, country, city,
    CAST(CASE WHEN event_name = 'purchase' THEN 1 WHEN event_name = 'begin_checkout' THEN 2
              WHEN event_name = 'add_to_cart' THEN 3 ELSE 99 END AS INTEGER) AS conversion_priority
  FROM stg_events
  WHERE event_name IN ('purchase', 'begin_checkout')
    AND user_pseudo_id IS NOT NULL AND event_datetime IS NOT NULL
    AND event_datetime >= TIMESTAMP '2020-01-01 00:00:00'
),
int_touchpoints AS (
  SELECT
    user_pseudo_id || '-' || channel || '-' || event_date AS touchpoint_id,
    user_pseudo_id, user_id, session_id,
    CAST(strptime(event_date, '%Y%m%d') AS DATE) AS touchpoint_date,
    min(event_datetime) AS touchpoint_datetime,
    min(event_timestamp) AS touchpoint_timestamp,
    channel, traffic_source, traffic_medium, traffic_campaign,
    arg_min_null(page_location, event_timestamp) AS landing_page,
    count(*) AS touchpoint_event_count,
    count_if(is_pageview) AS touchpoint_pageviews,
    sum(engagement_time_msec) / 1000 AS touchpoint_engagement_seconds,
    arg_min_null(device_category, event_timestamp) AS device_category,
    arg_min_null(country, event_timestamp) AS country,
    bool_or(is_direct_traffic) AS is_direct_traffic
  FROM stg_events
  WHERE user_pseudo_id IS NOT NULL AND channel IS NOT NULL
  GROUP BY user_pseudo_id, user_id, session_id, event_date, channel,
           traffic_source, traffic_medium, traffic_campaign
),
journeys_raw AS (
  SELECT
    c.conversion_id || '-' || t.touchpoint_id AS journey_id,
    c.conversion_id, c.conversion_date, c.conversion_datetime, c.conversion_timestamp,
    c.conversion_event, c.conversion_value, c.transaction_id, c.user_pseudo_id, c.user_id,
    t.touchpoint_id, t.touchpoint_date, t.touchpoint_datetime, t.touchpoint_timestamp,
    t.channel, t.traffic_source, t.traffic_medium, t.traffic_campaign, t.landing_page,
    t.is_direct_traffic,
    row_number() OVER (PARTITION BY c.conversion_id
      ORDER BY t.touchpoint_timestamp ASC NULLS FIRST, t.traffic_source ASC NULLS FIRST,
               t.session_id ASC NULLS FIRST, t.touchpoint_id ASC NULLS FIRST,
               t.traffic_medium ASC NULLS FIRST, t.traffic_campaign ASC NULLS FIRST,
               t.user_id ASC NULLS FIRST) AS touchpoint_position,
    count(*) OVER (PARTITION BY c.conversion_id) AS total_touchpoints,
    date_sub('day', t.touchpoint_datetime, c.conversion_datetime) AS days_to_conversion,
    date_sub('hour', t.touchpoint_datetime, c.conversion_datetime) AS hours_to_conversion,
    t.touchpoint_datetime >= c.attribution_window_start AS is_in_attribution_window,
    c.conversion_channel,
    c.device_category AS conversion_device,
    c.country AS conversion_country
  FROM stg_conversions c
  JOIN int_touchpoints t
    ON c.user_pseudo_id = t.user_pseudo_id
   AND t.touchpoint_timestamp < c.conversion_timestamp
   AND t.touchpoint_datetime >= c.attribution_window_start
   AND t.touchpoint_datetime <= c.attribution_window_end
),
int_user_journeys AS (
  SELECT *,
    touchpoint_position = 1 AS is_first_touchpoint,
    touchpoint_position = total_touchpoints AS is_last_touchpoint,
    CASE WHEN total_touchpoints = 1 THEN 'Single Touch'
         WHEN total_touchpoints = 2 THEN 'Two Touch'
         WHEN total_touchpoints <= 5 THEN 'Short Journey (3-5)'
         WHEN total_touchpoints <= 10 THEN 'Medium Journey (6-10)'
         ELSE 'Long Journey (10+)' END AS journey_type,
    max(days_to_conversion) OVER (PARTITION BY conversion_id) AS journey_length_days
  FROM journeys_raw
  WHERE is_in_attribution_window = true
),
""" + "".join(
    f"""
mart_{m}_click AS (
  SELECT conversion_id, conversion_date, conversion_datetime, conversion_event, conversion_value,
    transaction_id, user_pseudo_id,
    channel AS attributed_channel, traffic_source AS attributed_source,
    traffic_medium AS attributed_medium, traffic_campaign AS attributed_campaign,
    landing_page AS attributed_landing_page, touchpoint_date AS attributed_touchpoint_date,
    touchpoint_datetime AS attributed_touchpoint_datetime,
    total_touchpoints, journey_type, journey_length_days,
    days_to_conversion AS {m}_touch_to_conversion_days,
    conversion_channel, conversion_device, conversion_country,
    '{label}' AS attribution_model
  FROM int_user_journeys WHERE {flag} = true
  UNION ALL
  SELECT c.conversion_id, c.conversion_date, c.conversion_datetime, c.conversion_event,
    c.conversion_value, c.transaction_id, c.user_pseudo_id,
    c.conversion_channel, c.conversion_traffic_source, 'direct', CAST(NULL AS VARCHAR),
    c.conversion_page, c.conversion_date, c.conversion_datetime,
    CAST(1 AS BIGINT), 'Single Touch', CAST(0 AS BIGINT), CAST(0 AS BIGINT),
    c.conversion_channel, c.device_category, c.country, '{label}'
  FROM stg_conversions c
  LEFT JOIN (SELECT DISTINCT conversion_id FROM int_user_journeys) j ON c.conversion_id = j.conversion_id
  WHERE j.conversion_id IS NULL
),"""
    for m, label, flag in (("first", "First-Click", "is_first_touchpoint"),
                           ("last", "Last-Click", "is_last_touchpoint"))
) + """
fc_agg AS (
  SELECT attributed_channel AS channel, conversion_date,
    count(DISTINCT conversion_id) AS first_click_conversions,
    sum(conversion_value) AS first_click_revenue,
    avg(journey_length_days) AS avg_journey_days_fc,
    avg(total_touchpoints) AS avg_touchpoints_fc
  FROM mart_first_click GROUP BY 1, 2
),
lc_agg AS (
  SELECT attributed_channel AS channel, conversion_date,
    count(DISTINCT conversion_id) AS last_click_conversions,
    sum(conversion_value) AS last_click_revenue,
    avg(journey_length_days) AS avg_journey_days_lc,
    avg(total_touchpoints) AS avg_touchpoints_lc
  FROM mart_last_click GROUP BY 1, 2
),
mart_attribution_comparison AS (
  SELECT
    coalesce(f.channel, l.channel) AS channel,
    coalesce(f.conversion_date, l.conversion_date) AS conversion_date,
    coalesce(f.first_click_conversions, 0) AS first_click_conversions,
    coalesce(f.first_click_revenue, 0) AS first_click_revenue,
    f.avg_journey_days_fc, f.avg_touchpoints_fc,
    coalesce(l.last_click_conversions, 0) AS last_click_conversions,
    coalesce(l.last_click_revenue, 0) AS last_click_revenue,
    l.avg_journey_days_lc, l.avg_touchpoints_lc,
    coalesce(l.last_click_conversions, 0) - coalesce(f.first_click_conversions, 0) AS conversion_shift,
    coalesce(l.last_click_revenue, 0) - coalesce(f.first_click_revenue, 0) AS revenue_shift,
    CASE WHEN coalesce(f.first_click_conversions, 0) > 0
         THEN (coalesce(l.last_click_conversions, 0) - coalesce(f.first_click_conversions, 0)) / f.first_click_conversions * 100 END
      AS conversion_shift_percent,
    CASE WHEN coalesce(f.first_click_revenue, 0) > 0
         THEN (coalesce(l.last_click_revenue, 0) - coalesce(f.first_click_revenue, 0)) / f.first_click_revenue * 100 END
      AS revenue_shift_percent
  FROM fc_agg f FULL OUTER JOIN lc_agg l
    ON f.channel = l.channel AND f.conversion_date = l.conversion_date
)
"""


STREAM = """,
stream_rows AS (
  SELECT substr(sha256(CAST(uid AS VARCHAR) || '-' || event_name || '-' || CAST(event_timestamp AS VARCHAR)), 1, 16) AS event_id,
    CAST(make_timestamp(event_timestamp) AS DATE) AS event_date, event_timestamp, event_name,
    CAST(uid AS VARCHAR) AS user_pseudo_id, src_source AS source, src_medium AS medium,
    make_timestamp(event_timestamp) + to_seconds(event_timestamp % 5 + 1) AS ingestion_timestamp
  FROM raw WHERE event_name IS NOT NULL
),
arrivals AS (
  SELECT * FROM stream_rows
  UNION ALL
  SELECT * REPLACE (ingestion_timestamp + INTERVAL 30 MINUTE AS ingestion_timestamp)
  FROM stream_rows WHERE event_timestamp % 10 = 0
),
stream_sink AS (
  SELECT * FROM arrivals
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_timestamp) = 1
)
"""

SESSIONS = """,
gap_flags AS (
  SELECT event_id, user_pseudo_id, event_timestamp, event_datetime,
    CAST(event_datetime AS DATE) AS session_day,
    CASE WHEN lag(event_timestamp) OVER w IS NULL
           OR event_timestamp - lag(event_timestamp) OVER w > 1800000000 THEN 1 ELSE 0 END AS new_flag
  FROM stg_events
  WINDOW w AS (PARTITION BY user_pseudo_id, CAST(event_datetime AS DATE) ORDER BY event_timestamp, event_id)
),
gap_assigned AS (
  SELECT *, CAST(sum(new_flag) OVER (PARTITION BY user_pseudo_id, session_day ORDER BY event_timestamp, event_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS gap_session_index
  FROM gap_flags
),
gap_sessions AS (
  SELECT user_pseudo_id || '-' || strftime(session_day, '%Y%m%d') || '-' || CAST(gap_session_index AS VARCHAR) AS gap_session_id,
    user_pseudo_id, session_day, min(event_datetime) AS session_start, max(event_datetime) AS session_end,
    count(*) AS events
  FROM gap_assigned GROUP BY 1, 2, 3
)
"""


# Accounts of some events' logins, the users they stitch together, and the flat events by stitched user.
IDENTITY = """, logins AS (
  SELECT *, CAST(user_pseudo_id AS BIGINT) AS device, (engagement_time_msec - 1000) // 100 AS login FROM flat
), signed AS (
  SELECT * REPLACE (CASE login WHEN 11 THEN 'p' || (device // 3) WHEN 57 THEN 'q' || (device // 5)
                                WHEN 83 THEN 'r' || (device // 2) WHEN 99 THEN 'kiosk' END AS user_id) FROM logins
), links AS (
  SELECT DISTINCT user_pseudo_id, user_id FROM signed WHERE user_id IS NOT NULL
    AND user_id IN (SELECT user_id FROM signed GROUP BY user_id HAVING count(DISTINCT user_pseudo_id) <= 20)
), identity AS (
  WITH RECURSIVE near AS (
    SELECT DISTINCT a.user_pseudo_id AS x, b.user_pseudo_id AS y FROM links a JOIN links b USING (user_id)
  ), reach AS (
    SELECT x, y FROM near UNION SELECT r.x, n.y FROM reach r JOIN near n ON r.y = n.x
  )
  SELECT user_pseudo_id, coalesce(min(y), user_pseudo_id) AS stitched_id
  FROM (SELECT DISTINCT user_pseudo_id FROM flat) LEFT JOIN reach ON x = user_pseudo_id GROUP BY user_pseudo_id
)"""
STITCHED = IDENTITY + """
SELECT s.* EXCLUDE (device, login) REPLACE (
  stitched_id || '-' || event_name || '-' || event_timestamp AS event_id, stitched_id AS user_pseudo_id,
  stitched_id || '-' || ga_session_id AS session_id)
FROM signed s JOIN identity USING (user_pseudo_id)"""


def q(select: str, flat: str | None = None) -> str:
    """Wrap a final SELECT with the shared CTE chain.

    ``flat``: what the models read instead of the flat events.
    """
    base = BASE.strip()
    if flat is not None:
        head, tail = base.split("\nflat AS (", 1)
        body, rest = tail.split("\n),", 1)
        base = f"{head}\nflat AS (WITH flat AS ({body}\n) {flat}),{rest}"
    return "WITH " + base + STREAM + SESSIONS + "\n" + select.strip()
