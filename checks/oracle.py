"""The same results in plain SQL for DuckDB, written independently of the package.

Shared common table expressions rebuild the adapted events from the ``events`` view; each
query adds its own select.  Only the expressions a query reaches are used.
"""

from __future__ import annotations

from checks.queries import AGENTS, AS_OF


def _ts(expr: str, name: str | None = None) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f') AS {name or expr}"


def _day(expr: str = "event_date", name: str | None = None) -> str:
    return f"CAST({expr} AS VARCHAR) AS {name or expr}"


def _r(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


_BASE = """
base AS (
  SELECT event_id AS id, user_id AS u, ts AS event_timestamp, event_type AS base,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k,
         CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour
  FROM events),
typed AS (
  SELECT *,
    CASE
      WHEN base = 'view' THEN ['page_view', 'feature_view', 'question_viewed', 'question_viewed'][k % 4 + 1]
      WHEN base = 'signup' THEN ['session_start', 'quiz_started', 'quiz_started', 'quiz_started'][k % 4 + 1]
      WHEN base = 'click' AND k % 5 = 4 THEN CASE WHEN k % 2 = 0 THEN 'cta_clicked' ELSE 'link_clicked' END
      WHEN base = 'click' THEN ['slider_adjusted', 'slider_adjusted', 'option_selected', 'option_deselected'][k % 5 + 1]
      WHEN base = 'purchase' THEN ['quiz_completed', 'quiz_completed', 'quiz_step_completed',
                                   'result_viewed', 'result_shared', 'result_saved'][k % 6 + 1]
      ELSE ['quiz_abandoned', 'session_end', 'unknown_type', 'quiz_step_completed', 'quiz_step_completed'][k % 5 + 1]
    END AS event_type,
    CASE WHEN (id + u) % 20 < 11 THEN 'desktop' WHEN (id + u) % 20 < 18 THEN 'mobile' ELSE 'tablet' END AS device_type,
    'u' || u || CASE WHEN u % 3 = 0 THEN '' ELSE '_' || day(event_date) END AS mapped_user,
    event_timestamp + to_milliseconds(k * 10) AS received
  FROM base),
once AS (
  SELECT id, CAST(id AS VARCHAR) AS event_id,
    CASE WHEN id % 97 <> 0 THEN mapped_user END AS user_id,
    mapped_user || '-' || event_date || CASE WHEN u % 2 = 0 AND event_hour >= 12 THEN 'b' ELSE 'a' END AS session_id,
    event_type,
    CASE WHEN id % 4 = 0 THEN 'pricing_page' ELSE 'product_configurator' END AS feature_name,
    event_timestamp, received, event_date, event_hour,
    event_timestamp + to_seconds(1 + k % 9) AS first_processed,
    CAST(CASE WHEN event_type = 'question_viewed' THEN 1 + id % 4
         WHEN event_type = 'slider_adjusted' THEN CASE WHEN id % 2 = 0 THEN 1 ELSE 4 END
         WHEN event_type LIKE 'option\\_%' ESCAPE '\\' THEN CASE WHEN id % 2 = 0 THEN 2 ELSE 3 END END AS INTEGER) AS question_id,
    CAST(CASE WHEN event_type IN ('question_viewed', 'quiz_step_completed', 'quiz_abandoned') THEN 1 + id % 4 END AS INTEGER) AS step_number,
    CASE WHEN event_type IN ('quiz_started', 'question_viewed', 'quiz_step_completed') THEN 4 END AS total_steps,
    CAST(CASE WHEN event_type = 'slider_adjusted' THEN k END AS DOUBLE) AS slider_value,
    CAST(CASE WHEN event_type = 'slider_adjusted' THEN (k * 7) % 101 END AS DOUBLE) AS previous_value,
    CASE WHEN event_type LIKE 'option\\_%' ESCAPE '\\' THEN CASE WHEN id % 2 = 0
         THEN ['analytics', 'engineering', 'ml', 'realtime'][(id // 2) % 4 + 1]
         ELSE ['opensource', 'cloud', 'sql', 'python', 'governance', 'lowcode'][(id // 2) % 6 + 1] END END AS option_id,
    CASE WHEN event_type IN ('quiz_completed', 'result_viewed', 'result_shared', 'result_saved')
         THEN ['databricks', 'snowflake', 'duckdb', 'kafka', 'airflow', 'metabase'][id % 6 + 1] END AS recommendation_id,
    CAST(CASE WHEN event_type IN ('quiz_completed', 'result_viewed') THEN 65 + k % 35 END AS DOUBLE) AS match_score,
    CASE WHEN event_type IN ('question_viewed', 'quiz_step_completed') THEN 1000 + k * 100 END AS time_on_step_ms,
    CASE WHEN event_type = 'quiz_completed' THEN 45000 + k * 750
         WHEN event_type = 'session_end' THEN 10000 + k * 500 END AS total_time_ms,
    CASE WHEN event_type = 'result_shared' THEN ['twitter', 'linkedin', 'email', 'copy_link'][id % 4 + 1] END AS share_platform,
    CASE WHEN event_type = 'cta_clicked' THEN 'learn_more' END AS cta_id,
    device_type,
    CASE device_type WHEN 'desktop' THEN 1920 WHEN 'mobile' THEN 390 ELSE 820 END AS screen_width,
    CASE device_type WHEN 'desktop' THEN 1080 WHEN 'mobile' THEN 844 ELSE 1180 END AS screen_height,
    ['UTC', 'UTC', 'Europe/Vienna', 'Australia/Perth', 'Africa/Lagos', 'Nowhere/Undeclared', 'America/Lima'][id % 7 + 1] AS user_timezone,
    ['nl-NL', 'nl-NL', 'pt-BR', 'sv-SE', 'x-test'][id % 5 + 1] AS user_locale,
    CASE WHEN id % 50 = 7 THEN 'Googlebot/2.1' WHEN id % 5 = 0 THEN NULL
         WHEN device_type = 'desktop' THEN 'Mozilla/5.0 (X11; Linux x86_64)'
         WHEN device_type = 'mobile' THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 17_0) Mobile/15E148'
         ELSE 'Mozilla/5.0 (iPad; CPU OS 17_0)' END AS user_agent
  FROM typed),
raw AS (
  SELECT *, first_processed AS processed_at FROM once
  UNION ALL
  SELECT *, first_processed + to_seconds(60) FROM once WHERE id % 20 = 0)
"""

_STG = """,
stg AS (
  SELECT * FROM raw
  WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND session_id IS NOT NULL AND event_type IS NOT NULL
    AND NOT coalesce(contains(user_agent, 'bot'), false))
"""

_FACT = (
    _STG
    + """,
categories(event_type, event_category) AS (
  VALUES ('page_view', 'view'), ('feature_view', 'view'),
    ('quiz_started', 'flow'), ('quiz_step_completed', 'flow'), ('quiz_completed', 'flow'), ('quiz_abandoned', 'flow'),
    ('slider_adjusted', 'interaction'), ('option_selected', 'interaction'),
    ('option_deselected', 'interaction'), ('question_viewed', 'interaction'),
    ('result_viewed', 'outcome'), ('result_shared', 'outcome'), ('result_saved', 'outcome'),
    ('cta_clicked', 'engagement'), ('link_clicked', 'engagement'),
    ('session_start', 'session'), ('session_end', 'session')),
fact AS (
  SELECT stg.*, coalesce(event_category, 'other') AS event_category,
    CASE WHEN total_steps > 0 THEN round(step_number::DOUBLE / total_steps * 100, 1) END AS flow_progress_pct,
    abs(slider_value - previous_value) AS slider_change_magnitude,
    CASE WHEN time_on_step_ms > 0 THEN round(time_on_step_ms / 1000.0::DOUBLE, 2) END AS time_on_step_seconds,
    CASE WHEN screen_width > 0 AND screen_height > 0
         THEN round(screen_width::DOUBLE / screen_height, 2) END AS screen_aspect_ratio
  FROM stg LEFT JOIN categories USING (event_type))
"""
)

_USERS = (
    _FACT
    + f""",
user_totals AS (
  SELECT user_id, min(event_timestamp) AS first_seen_at, max(event_timestamp) AS last_seen_at,
    count(DISTINCT session_id) AS total_sessions, count(DISTINCT event_date) AS active_days,
    count(*) AS total_events,
    count(*) FILTER (event_category = 'interaction') AS interaction_events,
    count(*) FILTER (event_category = 'flow') AS flow_events,
    count(*) FILTER (event_type = 'quiz_started') AS quizzes_started,
    count(*) FILTER (event_type = 'quiz_completed') AS quizzes_completed,
    count(*) FILTER (event_type = 'result_shared') AS results_shared,
    count(*) FILTER (event_type = 'cta_clicked') AS ctas_clicked,
    mode() WITHIN GROUP (ORDER BY device_type) AS primary_device,
    mode() WITHIN GROUP (ORDER BY user_timezone) AS primary_timezone,
    avg(match_score) AS avg_match_score, avg(total_time_ms) AS avg_completion_time_ms
  FROM fact GROUP BY user_id),
users AS (
  SELECT *,
    date_diff('day', first_seen_at, last_seen_at) AS user_tenure_days,
    date_diff('day', first_seen_at, TIMESTAMP '{AS_OF}') AS days_since_first_seen,
    date_diff('day', last_seen_at, TIMESTAMP '{AS_OF}') AS days_since_last_seen,
    round(total_events::DOUBLE / nullif(total_sessions, 0), 1) AS avg_events_per_session,
    round(total_sessions::DOUBLE / nullif(active_days, 0), 2) AS sessions_per_active_day,
    CASE WHEN quizzes_started > 0 THEN round(quizzes_completed::DOUBLE / quizzes_started * 100, 1)
         ELSE 0 END AS quiz_completion_rate,
    CASE WHEN quizzes_completed >= 3 AND results_shared >= 1 THEN 'power_user'
         WHEN quizzes_completed > 0 THEN 'engaged'
         WHEN quizzes_started > 0 THEN 'explorer' ELSE 'visitor' END AS user_segment
  FROM user_totals),
flags AS (
  SELECT user_id, user_segment, quizzes_completed > 0 AS is_completer, total_sessions, active_days,
    days_since_last_seen, (total_sessions > 1)::INTEGER AS returned,
    (active_days > 1)::INTEGER AS returned_different_day
  FROM users),
groups AS (
  SELECT CASE WHEN is_completer THEN 'completers' ELSE 'non_completers' END AS user_group,
    count(*) AS user_count, avg(total_sessions) AS avg_sessions, avg(active_days) AS avg_active_days,
    avg(returned) * 100 AS return_rate_pct, avg(returned_different_day) * 100 AS next_day_return_rate_pct
  FROM flags GROUP BY 1)
"""
)

_SESSIONS = (
    _FACT
    + """,
session_days AS (
  SELECT session_id, user_id, event_date, count(*) AS events_in_session,
    count(DISTINCT event_type) AS unique_event_types,
    count(*) FILTER (event_type = 'slider_adjusted') AS slider_adjustments,
    count(*) FILTER (event_type = 'option_selected') AS option_selections,
    max(step_number) AS max_step_reached, max(total_steps) AS total_steps,
    max(total_time_ms) AS session_duration_ms, max(match_score) AS final_match_score,
    bool_or(event_type = 'quiz_completed')::INTEGER AS completed_quiz,
    bool_or(event_type = 'result_shared')::INTEGER AS shared_result
  FROM fact GROUP BY ALL),
summary AS (
  SELECT event_date, count(*) AS total_sessions, avg(events_in_session) AS avg_events_per_session,
    avg(unique_event_types) AS avg_unique_actions, avg(slider_adjustments) AS avg_slider_adjustments,
    avg(option_selections) AS avg_option_selections,
    avg(max_step_reached::DOUBLE / total_steps * 100) FILTER (total_steps > 0) AS avg_progress_pct,
    avg(session_duration_ms) / 1000.0::DOUBLE AS avg_session_duration_seconds,
    quantile_cont(session_duration_ms::DOUBLE, 0.5) / 1000.0::DOUBLE AS median_session_duration_seconds,
    sum(completed_quiz)::BIGINT AS completed_sessions, avg(completed_quiz) * 100 AS completion_rate_pct,
    avg(final_match_score) AS avg_match_score,
    sum(shared_result)::BIGINT AS shared_sessions, avg(shared_result) * 100 AS share_rate_pct
  FROM session_days GROUP BY event_date)
"""
)

_KPIS = (
    _SESSIONS
    + """,
active AS (SELECT event_date, count(DISTINCT user_id) AS dau FROM fact GROUP BY 1),
adopted AS (
  SELECT event_date, count(DISTINCT user_id) AS feature_users, count(*) AS total_interactions
  FROM fact WHERE event_category IN ('flow', 'interaction') GROUP BY 1),
outcomes AS (
  SELECT event_date, count(DISTINCT user_id) FILTER (event_type = 'quiz_started') AS started,
    count(DISTINCT user_id) FILTER (event_type = 'quiz_completed') AS completed,
    count(DISTINCT user_id) FILTER (event_type = 'result_shared') AS shared
  FROM fact GROUP BY 1),
kpis AS (
  SELECT event_date, dau, coalesce(feature_users, 0) AS feature_users,
    round(feature_users::DOUBLE / dau * 100, 2) AS feature_adoption_rate_pct,
    coalesce(total_interactions, 0) AS total_interactions,
    coalesce(avg_events_per_session, 0) AS avg_events_per_session,
    coalesce(avg_slider_adjustments, 0) AS avg_slider_adjustments,
    coalesce(avg_progress_pct, 0) AS avg_progress_pct,
    coalesce(avg_session_duration_seconds, 0) AS avg_session_duration_seconds,
    coalesce(median_session_duration_seconds, 0) AS median_session_duration_seconds,
    coalesce(avg_match_score, 0) AS avg_match_score,
    coalesce(started, 0) AS quiz_starts, coalesce(completed, 0) AS quiz_completions,
    CASE WHEN started > 0 THEN round(completed::DOUBLE / started * 100, 2) ELSE 0 END AS quiz_completion_rate_pct,
    coalesce(shared, 0) AS result_shares, coalesce(share_rate_pct, 0) AS share_rate_pct
  FROM active LEFT JOIN adopted USING (event_date) LEFT JOIN outcomes USING (event_date)
    LEFT JOIN summary USING (event_date))
"""
)

_FUNNEL = (
    _FACT
    + """,
progress AS (
  SELECT user_id, session_id, event_date,
    bool_or(event_type IN ('page_view', 'feature_view', 'quiz_started'))::INTEGER AS reached_feature_view,
    bool_or(event_type = 'quiz_started')::INTEGER AS reached_quiz_started,
    bool_or(event_type = 'question_viewed' AND step_number = 1)::INTEGER AS reached_question_1,
    bool_or(coalesce(flow_progress_pct, 0) >= 50)::INTEGER AS reached_mid_quiz,
    bool_or(event_type = 'quiz_completed')::INTEGER AS reached_quiz_completed,
    bool_or(event_type = 'result_viewed')::INTEGER AS reached_result_viewed,
    bool_or(event_type = 'result_shared')::INTEGER AS reached_result_shared,
    max(total_time_ms) AS completion_time_ms
  FROM fact GROUP BY ALL),
daily AS (
  SELECT event_date, count(DISTINCT user_id) AS total_users,
    sum(reached_feature_view)::BIGINT AS step1_feature_view,
    sum(reached_quiz_started)::BIGINT AS step2_quiz_started,
    sum(reached_question_1)::BIGINT AS step3_first_question,
    sum(reached_mid_quiz)::BIGINT AS step4_mid_quiz,
    sum(reached_quiz_completed)::BIGINT AS step5_completed,
    sum(reached_result_viewed)::BIGINT AS step6_result_viewed,
    sum(reached_result_shared)::BIGINT AS step7_result_shared,
    avg(completion_time_ms) FILTER (reached_quiz_completed = 1) AS avg_completion_time_ms
  FROM progress GROUP BY event_date)
"""
)

_DIRTY = """,
dirty AS (
  SELECT raw.* REPLACE (
      CASE WHEN id % 90 = 7 THEN '   ' WHEN id % 30 = 2 THEN '  ' || user_id || ' ' ELSE user_id END AS user_id,
      CASE WHEN id % 120 <> 10 THEN session_id END AS session_id,
      slider_value + CASE WHEN id % 6 = 1 THEN 200 ELSE 0 END AS slider_value,
      CASE WHEN id % 80 = 5 THEN 0 ELSE step_number END AS step_number,
      CASE WHEN id % 60 = 11 THEN 'phone' ELSE device_type END AS device_type,
      CASE WHEN id % 70 = 3 THEN -1 ELSE screen_width END AS screen_width),
    id % 110 = 9 AS bad_time,
    CASE WHEN id < 1500 THEN 0 ELSE id // 400 END AS batch_id
  FROM raw),
judged AS (
  SELECT * REPLACE (trim(user_id) AS user_id),
    concat_ws(',',
      CASE WHEN user_id IS NULL THEN 'user_id:missing' WHEN trim(user_id) = '' THEN 'user_id:blank' END,
      CASE WHEN session_id IS NULL THEN 'session_id:missing' END,
      CASE WHEN event_type = 'unknown_type' THEN 'event_type:unknown' END,
      CASE WHEN device_type = 'phone' THEN 'device_type:unknown' END,
      CASE WHEN bad_time THEN 'timestamp:invalid' END,
      CASE WHEN screen_width < 0 THEN 'screen_width:range' END,
      CASE WHEN step_number < 1 THEN 'step_number:range' END,
      CASE WHEN slider_value NOT BETWEEN 0 AND 100 THEN 'slider_value:range' END) AS reasons
  FROM dirty)
"""

_STG_COLUMNS = f"""
  event_id, user_id, session_id, event_type, feature_name, {_ts('event_timestamp')}, {_ts('processed_at')},
  {_day()}, event_hour, question_id, step_number, total_steps, {_r('slider_value', 'slider_value')},
  {_r('previous_value', 'previous_value')}, option_id, NULL::VARCHAR AS option_label,
  NULL::VARCHAR AS selected_options, recommendation_id, NULL::VARCHAR AS recommendation_name,
  {_r('match_score', 'match_score')}, time_on_step_ms, total_time_ms, share_platform, cta_id,
  NULL::VARCHAR AS cta_label, NULL::VARCHAR AS page_url, NULL::VARCHAR AS page_path, NULL::VARCHAR AS referrer,
  device_type, screen_width, screen_height, user_timezone, user_locale
"""

_FACT_COLUMNS = f"""
  event_id, user_id, session_id, event_type, feature_name, {_ts('event_timestamp')}, {_day()}, event_hour,
  {_ts('processed_at')}, event_category, step_number, total_steps, {_r('flow_progress_pct', 'flow_progress_pct')},
  {_r('slider_value', 'slider_value')}, {_r('previous_value', 'previous_value')},
  {_r('slider_change_magnitude', 'slider_change_magnitude')}, option_id, NULL::VARCHAR AS option_label,
  recommendation_id, NULL::VARCHAR AS recommendation_name, {_r('match_score', 'match_score')}, share_platform,
  time_on_step_ms, total_time_ms, {_r('time_on_step_seconds', 'time_on_step_seconds')}, device_type,
  NULL::VARCHAR AS page_path, NULL::VARCHAR AS referrer, user_timezone, user_locale, screen_width, screen_height,
  {_r('screen_aspect_ratio', 'screen_aspect_ratio')}
"""

_USER_COLUMNS = f"""
  user_id, {_ts('first_seen_at')}, {_ts('last_seen_at')}, user_tenure_days, days_since_first_seen,
  days_since_last_seen, total_sessions, active_days, total_events, interaction_events, flow_events,
  {_r('avg_events_per_session', 'avg_events_per_session')}, {_r('sessions_per_active_day', 'sessions_per_active_day')},
  quizzes_started, quizzes_completed, {_r('quiz_completion_rate', 'quiz_completion_rate')}, results_shared,
  ctas_clicked, user_segment, primary_device, primary_timezone, {_r('avg_match_score', 'avg_match_score')},
  {_r('avg_completion_time_ms', 'avg_completion_time_ms')}
"""

_KPI_COLUMNS = ", ".join(
    [_day(), "dau", "feature_users", _r("feature_adoption_rate_pct", "feature_adoption_rate_pct"), "total_interactions"]
    + [
        _r(c, c)
        for c in (
            "avg_events_per_session",
            "avg_slider_adjustments",
            "avg_progress_pct",
            "avg_session_duration_seconds",
            "median_session_duration_seconds",
            "avg_match_score",
            "quiz_completion_rate_pct",
            "share_rate_pct",
        )
    ]
    + ["quiz_starts", "quiz_completions", "result_shares"]
)

_SUMMARY_COLUMNS = ", ".join(
    [_day(), "total_sessions", "completed_sessions", "shared_sessions"]
    + [
        _r(c, c)
        for c in (
            "avg_events_per_session",
            "avg_unique_actions",
            "avg_slider_adjustments",
            "avg_option_selections",
            "avg_progress_pct",
            "avg_session_duration_seconds",
            "median_session_duration_seconds",
            "completion_rate_pct",
            "avg_match_score",
            "share_rate_pct",
        )
    ]
)


def _share(part: str, whole: str) -> str:
    return f"{part}::DOUBLE / nullif({whole}, 0) * 100"


_STEPS = [
    "step1_feature_view",
    "step2_quiz_started",
    "step3_first_question",
    "step4_mid_quiz",
    "step5_completed",
    "step6_result_viewed",
    "step7_result_shared",
]
_RATE_COLUMNS = ", ".join(
    [_day(), "total_users", *_STEPS]
    + [f"round({_share(s, 'total_users')}, 2) AS step{i}_pct" for i, s in enumerate(_STEPS, 1)]
    + [f"round({_share(b, a)}, 2) AS conv_{i}_to_{i + 1}" for i, (a, b) in enumerate(zip(_STEPS, _STEPS[1:]), 1)]
    + [
        f"round(100 - {_share(b, a)}, 2) AS dropoff_{i}_to_{i + 1}"
        for i, (a, b) in enumerate(zip(_STEPS[:4], _STEPS[1:5]), 1)
    ]
    + [
        f"round({_share('step5_completed', 'step1_feature_view')}, 2) AS overall_completion_rate",
        f"round({_share('step7_result_shared', 'step5_completed')}, 2) AS share_after_completion_rate",
        "round(avg_completion_time_ms / 1000.0::DOUBLE, 1) AS avg_completion_time_seconds",
    ]
)

_LONG_STEPS = [
    ("feature_view", "Feature Viewed"),
    ("quiz_started", "Quiz Started"),
    ("question_1", "First Question"),
    ("mid_quiz", "Mid-Quiz (50%)"),
    ("quiz_completed", "Quiz Completed"),
    ("result_viewed", "Result Viewed"),
    ("result_shared", "Result Shared"),
]

_GAP = """,
ordered AS (
  SELECT *, lag(event_timestamp) OVER (PARTITION BY user_id ORDER BY event_timestamp) AS previous FROM stg),
numbered AS (
  SELECT *, sum(CASE WHEN previous IS NULL OR event_timestamp - previous >= INTERVAL {gap} THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id ORDER BY event_timestamp RANGE UNBOUNDED PRECEDING)::BIGINT AS session_seq
  FROM ordered)
"""

_ANSWERS = (
    _STG
    + """,
answers AS (
  SELECT session_id,
    coalesce(arg_max(slider_value, (event_timestamp, event_id))
      FILTER (event_type = 'slider_adjusted' AND question_id = 1), 10) AS team_size,
    coalesce(arg_max(option_id, (event_timestamp, event_id))
      FILTER (event_type = 'option_selected' AND question_id = 2), '') AS use_case,
    array_filter(['opensource', 'cloud', 'sql', 'python', 'governance', 'lowcode'],
      lambda f: list_contains(coalesce(any_value(f3.chosen), []), f)) AS features,
    coalesce(arg_max(slider_value, (event_timestamp, event_id))
      FILTER (event_type = 'slider_adjusted' AND question_id = 4), 100) AS budget
  FROM stg LEFT JOIN (
    SELECT session_id, list(option_id) AS chosen FROM (
      SELECT session_id, option_id, arg_max(event_type, (event_timestamp, event_id)) AS last_change FROM stg
      WHERE event_type IN ('option_selected', 'option_deselected') AND question_id = 3 GROUP BY session_id, option_id)
    WHERE last_change = 'option_selected' GROUP BY session_id) f3 USING (session_id)
  GROUP BY session_id)
"""
)

# Points per tool in the order databricks, snowflake, duckdb, kafka, airflow, metabase.
_SCORES = (
    _ANSWERS
    + """,
picked AS (
  SELECT *, CASE WHEN team_size = 0 THEN 10 ELSE team_size END AS team,
    CASE WHEN budget = 0 THEN 100 ELSE budget END AS spend FROM answers),
points AS (
  SELECT *,
    [CASE WHEN team <= 5 THEN 0 WHEN team <= 25 THEN 0 ELSE 25 END,
     CASE WHEN team <= 25 THEN 0 ELSE 30 END,
     CASE WHEN team <= 5 THEN 30 ELSE 0 END,
     CASE WHEN team <= 25 THEN 0 ELSE 20 END,
     CASE WHEN team > 5 AND team <= 25 THEN 20 ELSE 0 END,
     CASE WHEN team <= 5 THEN 20 WHEN team <= 25 THEN 25 ELSE 0 END] AS p1,
    CASE use_case WHEN 'analytics' THEN [0, 35, 20, 0, 0, 30] WHEN 'engineering' THEN [25, 0, 0, 0, 35, 0]
      WHEN 'ml' THEN [40, 0, 0, 0, 0, 0] WHEN 'realtime' THEN [0, 0, 0, 45, 0, 0] ELSE [0, 0, 0, 0, 0, 0] END AS p2,
    CASE WHEN list_contains(features, 'opensource') THEN [0, 0, 15, 15, 15, 15] ELSE [0, 0, 0, 0, 0, 0] END AS p3,
    CASE WHEN list_contains(features, 'cloud') THEN [15, 15, 0, 0, 0, 0] ELSE [0, 0, 0, 0, 0, 0] END AS p4,
    CASE WHEN list_contains(features, 'sql') THEN [0, 20, 20, 0, 0, 0] ELSE [0, 0, 0, 0, 0, 0] END AS p5,
    CASE WHEN list_contains(features, 'python') THEN [15, 0, 0, 0, 15, 0] ELSE [0, 0, 0, 0, 0, 0] END AS p6,
    CASE WHEN list_contains(features, 'lowcode') THEN [0, 0, 0, 0, 0, 25] ELSE [0, 0, 0, 0, 0, 0] END AS p7,
    CASE WHEN spend <= 50 THEN [0, 0, 30, 0, 0, 20] WHEN spend >= 300 THEN [20, 25, 0, 0, 0, 0]
      ELSE [0, 0, 0, 0, 0, 0] END AS p8
  FROM picked),
totals AS (
  SELECT *, list_transform([1, 2, 3, 4, 5, 6], lambda i: 50 + p1[i] + p2[i] + p3[i] + p4[i] + p5[i] + p6[i] + p7[i] + p8[i]) AS t
  FROM points)
"""
)

_JOINED_FEATURES = "coalesce(array_to_string(features, ','), '') AS features"


def _with(parts: str, select: str) -> str:
    return f"WITH {_BASE}{parts} {select}"


def oracle_sql() -> dict[str, str]:
    window = lambda width: f"time_bucket(INTERVAL '{width}', event_timestamp)"
    agent_list = "[" + ", ".join(f"'{a}'" for a in AGENTS) + "]"
    q: dict[str, str] = {}

    q["scan_raw"] = _with(
        "",
        f"SELECT {_day()}, event_hour, count(*) AS events, {_ts('min(event_timestamp)', 'first_event_at')},"
        f" {_ts('max(processed_at)', 'last_processed_at')} FROM raw GROUP BY event_date, event_hour",
    )
    q["lake_roundtrip"] = _with(
        "",
        f"SELECT event_id, user_id, event_type, {_ts('event_timestamp')}, {_ts('processed_at')}, {_day()}, event_hour,"
        f" {_r('slider_value', 'slider_value')}, device_type FROM raw",
    )
    q["ndjson_roundtrip"] = _with(
        "", f"SELECT event_id, session_id, {_ts('event_timestamp')}, {_day()}, event_hour, question_id FROM raw"
    )
    q["envelope_encode"] = _with(
        "",
        "SELECT user_id AS key, event_id, event_type, device_type,"
        " strftime(received, '%Y-%m-%dT%H:%M:%S.%fZ') AS received_at,"
        f" {_ts('received', 'sent_at')} FROM raw",
    )
    q["envelope_decode"] = _with(
        "",
        "SELECT event_id, session_id, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time_text,"
        f" {_ts('received', 'kafka_timestamp')} FROM raw",
    )
    ok = lambda expr, name: f"CASE WHEN epoch_us(received) % 211 <> 5 THEN {expr} END AS {name}"
    q["parse_events"] = _with(
        "",
        "SELECT "
        + ", ".join(
            ok(c, c)
            for c in (
                "event_id",
                "user_id",
                "session_id",
                "event_type",
                "step_number",
                "option_id",
                "device_type",
                "user_agent",
                "event_hour",
            )
        )
        + f", {ok('round(slider_value, 6)', 'slider_value')},"
        + " CASE WHEN epoch_us(received) % 211 <> 5 THEN strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') END AS event_timestamp,"
        + " CASE WHEN epoch_us(received) % 211 <> 5 THEN CAST(event_date AS VARCHAR) END AS event_date,"
        + f" {_ts('received', 'kafka_timestamp')}, '{AS_OF}.000000' AS processed_at FROM raw",
    )
    q["enrich_user_agent"] = _with(
        _DIRTY, "SELECT event_id, batch_id, coalesce(user_agent, 'hdr/' || batch_id) AS user_agent FROM dirty"
    )
    q["apply_defaults"] = _with(
        "",
        "SELECT id, id % 17 = 0 AS generated_id,"
        " CASE WHEN id % 13 = 0 THEN 'product_configurator' ELSE feature_name END AS feature_name,"
        f" CASE WHEN id % 19 = 0 THEN '{AS_OF.replace(' ', 'T')}.000000Z'"
        " ELSE strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') END AS timestamp,"
        " CASE WHEN id % 23 = 0 THEN 'unknown' ELSE device_type END AS device_type,"
        " CASE WHEN id % 29 <> 0 THEN step_number END AS step_number, 0 AS extra_size FROM raw",
    )
    q["validate_events"] = _with(_DIRTY, "SELECT event_id, user_id, reasons AS reject_reasons FROM judged")
    q["batch_receipt"] = _with(
        _DIRTY,
        """
        SELECT batch_id, coalesce(count(*) FILTER (reasons = ''), 0) > 0 AND count(*) <= 1000 AS success,
          count(*) AS total_events,
          CASE WHEN count(*) <= 1000 THEN count(*) FILTER (reasons = '') ELSE 0 END AS accepted_events,
          count(*) - CASE WHEN count(*) <= 1000 THEN count(*) FILTER (reasons = '') ELSE 0 END AS rejected_events,
          CASE WHEN count(*) <= 1000
            THEN coalesce(string_agg(event_id, ',' ORDER BY event_id) FILTER (reasons = ''), '') ELSE '' END AS event_ids,
          CASE WHEN count(*) <= 1000 THEN coalesce(string_agg(event_id || ': ' || replace(reasons, ',', ', '), ','
              ORDER BY event_id || ': ' || replace(reasons, ',', ', ')) FILTER (reasons <> ''), '')
            ELSE 'batch: more than 1000 events' END AS errors
        FROM judged GROUP BY batch_id
        """,
    )
    q["rejected_events"] = _with(
        _DIRTY,
        f"SELECT event_id, event_type, {_ts('processed_at')}, reasons AS reject_reasons FROM judged WHERE reasons <> ''",
    )
    q["reject_reasons"] = _with(
        _DIRTY,
        "SELECT reason, count(*) AS rejected_events FROM"
        " (SELECT unnest(string_split(reasons, ',')) AS reason FROM judged WHERE reasons <> '') GROUP BY reason",
    )
    q["ingest_totals"] = _with(
        _DIRTY,
        "SELECT count(*) AS total_events, count(*) FILTER (reasons = '') AS accepted_events,"
        " count(*) FILTER (reasons <> '') AS rejected_events FROM judged",
    )
    empties = "SELECT unnest([-1, -2]) AS batch_id"
    q["request_receipts"] = _with(
        _DIRTY,
        f"""
        SELECT batch_id, coalesce(count(*) FILTER (reasons = ''), 0) > 0 AND count(*) <= 1000 AS success,
          CASE WHEN count(*) > 1000 THEN 'batch:large' END AS batch_refused, count(*) AS total_events,
          CASE WHEN count(*) <= 1000 THEN count(*) FILTER (reasons = '') ELSE 0 END AS accepted_events,
          count(*) - CASE WHEN count(*) <= 1000 THEN count(*) FILTER (reasons = '') ELSE 0 END AS rejected_events,
          CASE WHEN count(*) <= 1000
            THEN coalesce(string_agg(event_id, ',' ORDER BY event_id) FILTER (reasons = ''), '') ELSE '' END AS event_ids,
          CASE WHEN count(*) <= 1000 THEN coalesce(string_agg(event_id || ': ' || replace(reasons, ',', ', '), ','
              ORDER BY event_id || ': ' || replace(reasons, ',', ', ')) FILTER (reasons <> ''), '')
            ELSE 'batch:large' END AS errors
        FROM judged GROUP BY batch_id
        UNION ALL SELECT batch_id, false, 'batch:empty', 0, 0, 0, '', 'batch:empty' FROM ({empties})
        """,
    )
    q["ingest_reconcile"] = _with(
        _DIRTY,
        """, sized AS (SELECT *, count(*) OVER (PARTITION BY batch_id) > 1000 AS refused FROM judged)
        SELECT count(*) AS total_events, count(*) FILTER (reasons = '' AND NOT refused) AS accepted_events,
          count(*) FILTER (reasons <> '' OR refused) AS rejected_events FROM sized""",
    )
    q["future_events"] = _with(
        "",
        f"""SELECT event_id, {_ts("event_timestamp + INTERVAL '2200 days'", 'event_timestamp')}, {_ts('received', 'kafka_timestamp')}
        FROM raw WHERE id % 150 = 4 AND event_timestamp + INTERVAL '2200 days' > received + INTERVAL '1 hour'""",
    )
    q["dedup_events"] = _with(
        "",
        f"SELECT event_id, user_id, event_type, {_ts('event_timestamp')}, {_ts('first_processed', 'processed_at')}"
        " FROM once",
    )
    q["stg_deduped"] = _with(
        _STG,
        f"SELECT event_id, user_id, session_id, event_type, {_ts('event_timestamp')}, {_ts('processed_at')}, device_type"
        " FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY stg.processed_at) AS copy FROM stg) WHERE copy = 1",
    )
    q["filter_bots"] = _with(
        "", "SELECT event_id, event_type, user_agent FROM raw WHERE user_agent IS NULL OR user_agent NOT LIKE '%bot%'"
    )
    q["dq_checks"] = _with(
        "",
        """
        , counted AS (
          SELECT count(*) FILTER (event_id IS NULL) AS e, count(*) FILTER (user_id IS NULL) AS u,
            count(*) FILTER (session_id IS NULL) AS s, count(*) FILTER (event_type IS NULL) AS t,
            count(*) FILTER (event_type = 'unknown_type') AS bad_type,
            count(*) FILTER (device_type NOT IN ('desktop', 'mobile', 'tablet', 'unknown')) AS bad_device
          FROM raw),
        copies AS (SELECT coalesce(sum(n), 0)::BIGINT AS n FROM
          (SELECT count(*) AS n FROM raw GROUP BY event_id HAVING count(*) > 1))
        SELECT 'not_null_event_id' AS "check", e AS failing_rows FROM counted
        UNION ALL SELECT 'not_null_user_id', u FROM counted
        UNION ALL SELECT 'not_null_session_id', s FROM counted
        UNION ALL SELECT 'not_null_event_type', t FROM counted
        UNION ALL SELECT 'accepted_values_event_type', bad_type FROM counted
        UNION ALL SELECT 'accepted_values_device_type', bad_device FROM counted
        UNION ALL SELECT 'unique_event_id', n FROM copies
        """,
    )
    q["stg_events"] = _with(_STG, f"SELECT {_STG_COLUMNS} FROM stg")
    q["device_from_user_agent"] = _with(
        "",
        f""", agents AS (SELECT {agent_list}[id % 10 + 1] AS user_agent FROM raw),
        turned AS (SELECT user_agent, lower(user_agent) AS a, reverse(lower(user_agent)) AS b FROM agents)
        SELECT user_agent, CASE
            WHEN user_agent IS NULL THEN 'unknown'
            WHEN regexp_matches(a, 'tablet|ipad|playbook|silk')
              OR (contains(b, 'diordna') AND (NOT contains(b, 'ibom') OR strpos(b, 'diordna') < strpos(b, 'ibom'))) THEN 'tablet'
            WHEN regexp_matches(a, 'mobile|android|iphone|ipod|blackberry|opera mini|iemobile') THEN 'mobile'
            ELSE 'desktop' END AS device_type, count(*) AS events
        FROM turned GROUP BY ALL""",
    )
    q["sessionize"] = _with(
        _STG + _GAP.format(gap="'30 minutes'"),
        f"SELECT event_id, user_id, {_ts('event_timestamp')}, session_seq,"
        f" {_ts('min(event_timestamp) OVER (PARTITION BY user_id, session_seq)', 'session_start')} FROM numbered",
    )
    per_gap_session = (
        f"{_ts('min(event_timestamp)', 'session_start')}, {_ts('max(event_timestamp)', 'session_end')},"
        " count(*) AS event_count FROM numbered GROUP BY user_id, session_seq"
    )
    q["gap_sessions"] = _with(
        _STG + _GAP.format(gap="'6 hours'"), f"SELECT user_id, session_seq, {per_gap_session}"
    )
    q["session_window_counts"] = _with(
        _STG + _GAP.format(gap="'30 minutes'"), f"SELECT user_id, {per_gap_session}"
    )
    q["derive_step_timing"] = _with(
        """, clean AS (
          SELECT * FROM once WHERE user_id IS NOT NULL AND NOT coalesce(contains(user_agent, 'bot'), false)),
        anchored AS (
          SELECT *,
            max(event_timestamp) FILTER (event_type IN ('session_start', 'quiz_started', 'question_viewed', 'quiz_step_completed')) OVER w AS step_from,
            max(event_timestamp) FILTER (event_type IN ('session_start', 'quiz_started')) OVER w AS flow_from
          FROM clean
          WINDOW w AS (PARTITION BY session_id ORDER BY event_timestamp, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
        """SELECT event_id, session_id, event_type,
          CASE WHEN event_type IN ('question_viewed', 'quiz_step_completed')
            THEN (epoch_us(event_timestamp) - epoch_us(step_from)) // 1000 END AS derived_time_on_step_ms,
          CASE WHEN event_type IN ('quiz_completed', 'session_end')
            THEN (epoch_us(event_timestamp) - epoch_us(flow_from)) // 1000 END AS derived_total_time_ms
        FROM anchored""",
    )
    q["quality_sessions"] = _with(
        _FACT,
        f"""SELECT session_id, user_id, count(*) AS event_count, {_ts('min(event_timestamp)', 'session_start')},
          {_ts('max(event_timestamp)', 'session_end')},
          round((epoch_us(max(event_timestamp)) - epoch_us(min(event_timestamp))) / 1000000.0::DOUBLE, 6) AS duration_seconds
        FROM fact GROUP BY session_id, user_id
        HAVING count(*) >= 2 AND max(event_timestamp) - min(event_timestamp) <= INTERVAL '6 hours'""",
    )
    q["fact_events"] = _with(_FACT, f"SELECT {_FACT_COLUMNS} FROM fact")
    q["event_category_counts"] = _with(
        _FACT, "SELECT event_category, count(*) AS event_count FROM fact GROUP BY event_category"
    )
    q["slider_stats"] = _with(
        _FACT,
        f"SELECT feature_name, {_day()}, count(*) AS slider_moves,"
        f" {_r('avg(slider_change_magnitude)', 'avg_change')}, {_r('max(slider_change_magnitude)', 'max_change')}"
        " FROM fact WHERE slider_change_magnitude IS NOT NULL GROUP BY feature_name, event_date",
    )
    q["activity_rollup"] = _with(
        _FACT,
        f"""SELECT {_day()}, user_id, session_id, device_type, user_timezone,
          CASE WHEN event_category = 'other' THEN event_type END AS other_type,
          count(*) AS events, count(*) FILTER (event_category = 'interaction') AS interaction_events,
          count(*) FILTER (event_category = 'flow') AS flow_events, max(step_number) AS max_step,
          sum(total_time_ms)::BIGINT AS total_time_ms_sum, {_r('sum(match_score)', 'match_score_sum')},
          count(DISTINCT event_type) FILTER (event_category <> 'other') AS declared_types
        FROM fact GROUP BY event_date, user_id, session_id, device_type, user_timezone, other_type""",
    )
    q["dim_users"] = _with(_USERS, f"SELECT {_USER_COLUMNS} FROM users")
    q["user_segments"] = _with(
        _USERS,
        "SELECT user_segment, count(*) AS users, sum(total_events)::BIGINT AS total_events,"
        " sum(results_shared)::BIGINT AS results_shared FROM users GROUP BY user_segment",
    )
    q["user_primary_device"] = _with(
        _FACT,
        """, per_device AS (SELECT user_id, device_type, count(*) AS n FROM fact WHERE device_type IS NOT NULL GROUP BY 1, 2)
        SELECT user_id, device_type AS primary_device, n AS device_events FROM per_device
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, device_type) = 1""",
    )
    q["daily_active_users"] = _with(
        _FACT, f"SELECT {_day()}, count(DISTINCT user_id) AS dau FROM fact GROUP BY event_date"
    )
    q["feature_adoption"] = _with(
        _FACT,
        f"SELECT {_day()}, count(DISTINCT user_id) AS feature_users, count(DISTINCT session_id) AS feature_sessions,"
        " count(*) AS total_interactions FROM fact WHERE event_category IN ('interaction', 'flow') GROUP BY event_date",
    )
    q["daily_funnel_users"] = _with(
        _FACT,
        f"SELECT {_day()}, count(DISTINCT user_id) FILTER (event_type = 'quiz_started') AS started_users,"
        " count(DISTINCT user_id) FILTER (event_type = 'quiz_completed') AS completed_users,"
        " count(DISTINCT user_id) FILTER (event_type = 'result_shared') AS shared_users FROM fact GROUP BY event_date",
    )
    q["session_engagement"] = _with(
        _SESSIONS,
        f"SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date) FROM session_days",
    )
    q["session_summary"] = _with(_SESSIONS, f"SELECT {_SUMMARY_COLUMNS} FROM summary")
    q["engagement_metrics"] = _with(_KPIS, f"SELECT {_KPI_COLUMNS} FROM kpis")
    q["marts_roundtrip"] = q["engagement_metrics"]
    q["engagement_window"] = _with(
        _FACT,
        "SELECT user_id, count(DISTINCT event_date) AS active_days, count(*) AS events FROM fact"
        f" WHERE event_date >= DATE '{AS_OF[:10]}' - 14 AND event_date < DATE '{AS_OF[:10]}' GROUP BY user_id",
    )
    q["retention_flags"] = _with(_USERS, "SELECT * FROM flags")
    q["retention_comparison"] = _with(
        _USERS,
        "SELECT user_group, user_count, "
        + ", ".join(
            _r(c, c) for c in ("avg_sessions", "avg_active_days", "return_rate_pct", "next_day_return_rate_pct")
        )
        + " FROM groups",
    )
    q["retention_lift"] = _with(
        _USERS,
        """, pair AS (
          SELECT max(return_rate_pct) FILTER (user_group = 'completers') AS a,
            max(return_rate_pct) FILTER (user_group = 'non_completers') AS b,
            max(next_day_return_rate_pct) FILTER (user_group = 'completers') AS c,
            max(next_day_return_rate_pct) FILTER (user_group = 'non_completers') AS d FROM groups)
        SELECT round(a, 6) AS completer_return_rate_pct, round(b, 6) AS non_completer_return_rate_pct,
          round(c, 6) AS completer_next_day_rate_pct, round(d, 6) AS non_completer_next_day_rate_pct,
          round((a - b) / nullif(b, 0) * 100, 6) AS retention_lift_pct,
          round((c - d) / nullif(d, 0) * 100, 6) AS next_day_lift_pct FROM pair""",
    )
    q["retention_7d"] = _with(
        _USERS,
        """, firsts AS (SELECT user_id, min(event_date) AS d0 FROM fact GROUP BY user_id),
        seconds AS (SELECT fact.user_id, min(event_date) AS d1 FROM fact JOIN firsts
          ON fact.user_id = firsts.user_id AND event_date > d0 GROUP BY fact.user_id)
        SELECT CASE WHEN quizzes_completed > 0 THEN 'completers' ELSE 'non_completers' END AS user_group,
          count(*) AS user_count, count(*) FILTER (d1 - d0 <= 7) AS returned_users,
          round(count(*) FILTER (d1 - d0 <= 7)::DOUBLE / count(*) * 100, 6) AS return_rate_pct
        FROM users JOIN firsts USING (user_id) LEFT JOIN seconds USING (user_id) GROUP BY 1""",
    )
    q["funnel_progress"] = _with(
        _FUNNEL, "SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date) FROM progress"
    )
    q["funnel_daily"] = _with(
        _FUNNEL,
        f"SELECT {_day()}, total_users, {', '.join(_STEPS)},"
        f" {_r('avg_completion_time_ms', 'avg_completion_time_ms')} FROM daily",
    )
    q["funnel_rates"] = _with(_FUNNEL, f"SELECT {_RATE_COLUMNS} FROM daily")
    q["funnel_long"] = _with(
        _FUNNEL
        + """,
        by_user AS (SELECT user_id, """
        + ", ".join(f"max(reached_{key}) AS {key}" for key, _ in _LONG_STEPS)
        + " FROM progress GROUP BY user_id), steps AS ("
        + " UNION ALL ".join(
            f"SELECT {i} AS step_order, '{key}' AS step_key, '{label}' AS step_name,"
            f" sum({key})::BIGINT AS users_reached FROM by_user"
            for i, (key, label) in enumerate(_LONG_STEPS, 1)
        )
        + """), chained AS (
          SELECT *, coalesce(users_reached::DOUBLE / nullif(lag(users_reached) OVER (ORDER BY step_order), 0),
              CASE WHEN step_order = 1 THEN 1 END) AS conversion,
            users_reached::DOUBLE / nullif(first_value(users_reached) OVER (ORDER BY step_order), 0) * 100 AS initial
          FROM steps)""",
        """SELECT step_order, step_key, step_name, users_reached, round(conversion, 6) AS conversion_from_previous,
          round(1 - conversion, 6) AS dropoff_rate, round(initial, 6) AS percent_of_initial,
          CASE WHEN step_order = 1 OR conversion IS NULL THEN NULL WHEN (1 - conversion) * 100 < 12 THEN 'green'
            WHEN (1 - conversion) * 100 < 20 THEN 'amber' ELSE 'red' END AS dropoff_band
        FROM chained""",
    )
    q["session_metrics"] = _with(
        "",
        f"""SELECT {_ts(window('1 hour'), 'window_start')}, {_ts(window('1 hour') + " + INTERVAL '1 hour'", 'window_end')},
          session_id, user_id, feature_name, device_type, count(*) AS event_count,
          {_ts('min(event_timestamp)', 'session_start')}, {_ts('max(event_timestamp)', 'session_end')},
          count(*) FILTER (event_type = 'quiz_started') AS quizzes_started,
          count(*) FILTER (event_type = 'quiz_completed') AS quizzes_completed,
          count(*) FILTER (event_type = 'slider_adjusted') AS slider_interactions,
          count(*) FILTER (event_type = 'option_selected') AS option_selections,
          max(total_time_ms) AS total_time_ms, round(max(match_score), 6) AS final_match_score,
          max(recommendation_id) AS recommendation_id, count(*) FILTER (event_type = 'result_shared') AS shares,
          epoch_us(max(event_timestamp)) // 1000000 - epoch_us(min(event_timestamp)) // 1000000 AS session_duration_seconds,
          round(coalesce(count(*) FILTER (event_type = 'quiz_completed')::DOUBLE
            / nullif(count(*) FILTER (event_type = 'quiz_started'), 0), 0), 6) AS completion_rate
        FROM raw GROUP BY {window('1 hour')}, session_id, user_id, feature_name, device_type""",
    )
    q["realtime_metrics"] = _with(
        "",
        f"""SELECT {_ts(window('1 minute'), 'window_start')},
          {_ts(window('1 minute') + " + INTERVAL '1 minute'", 'window_end')}, feature_name, event_type,
          count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
          count(DISTINCT session_id) AS unique_sessions, {_r('avg(time_on_step_ms)', 'avg_time_on_step_ms')}
        FROM raw GROUP BY {window('1 minute')}, feature_name, event_type""",
    )
    q["stream_funnel"] = _with(
        "",
        f"""SELECT {_ts(window('1 hour'), 'window_start')}, feature_name, event_type,
          count(DISTINCT user_id) AS unique_users, count(DISTINCT session_id) AS unique_sessions,
          count(*) AS total_events, list_position(['quiz_started', 'question_viewed', 'quiz_step_completed',
            'quiz_completed', 'result_viewed', 'result_shared'], event_type) AS funnel_step
        FROM raw WHERE event_type IN ('quiz_started', 'question_viewed', 'quiz_step_completed',
            'quiz_completed', 'result_viewed', 'result_shared')
        GROUP BY {window('1 hour')}, feature_name, event_type""",
    )
    q["stream_roundtrip"] = (
        f"WITH {_BASE} SELECT f.*, (SELECT count(*) FROM raw) AS raw_events FROM ("
        + q["stream_funnel"].removeprefix(f"WITH {_BASE}")
        + ") f WHERE f.window_start::TIMESTAMP + INTERVAL '1 hour' <= (SELECT max(event_timestamp) - INTERVAL '1 hour' FROM raw"
        " WHERE event_type IN ('quiz_started', 'question_viewed', 'quiz_step_completed', 'quiz_completed', 'result_viewed', 'result_shared'))"
    )
    q["fanout_roundtrip"] = q["realtime_metrics"].replace(
        "FROM raw GROUP BY",
        "FROM raw WHERE user_id IS NOT NULL AND event_type <> 'unknown_type'"
        " AND coalesce(slider_value BETWEEN 0 AND 100, true) GROUP BY",
    )
    q["active_users_5m"] = _with(
        """, slid AS (SELECT user_id, unnest(list_transform([0, 1, 2, 3, 4],
            lambda i: date_trunc('minute', event_timestamp) - to_minutes(i))) AS start FROM raw WHERE user_id IS NOT NULL)""",
        f"""SELECT {_ts('start', 'window_start')}, {_ts("start + INTERVAL '5 minutes'", 'window_end')},
          count(DISTINCT user_id) AS active_users FROM slid GROUP BY start""",
    )
    q["events_per_minute"] = _with(
        "",
        f"""SELECT {_ts(window('1 minute'), 'window_start')},
          {_ts(window('1 minute') + " + INTERVAL '1 minute'", 'window_end')}, count(*) AS event_count
        FROM raw GROUP BY {window('1 minute')}""",
    )
    q["latest_metrics"] = _with(_KPIS, f"SELECT {_KPI_COLUMNS} FROM kpis ORDER BY kpis.event_date DESC LIMIT 10")
    q["kpi_cards"] = _with(
        _KPIS,
        f"""SELECT {_day()}, feature_adoption_rate_pct AS adoption_rate_pct,
          round(feature_adoption_rate_pct - 30, 6) AS adoption_delta_pct,
          {_r('avg_events_per_session', 'avg_events_per_session')}, quiz_completion_rate_pct,
          {_r('avg_session_duration_seconds', 'avg_session_duration_seconds')},
          {_r('avg_match_score', 'avg_match_score')}, {_r('share_rate_pct', 'share_rate_pct')}
        FROM kpis WHERE event_date = (SELECT max(event_date) FROM kpis)""",
    )
    q["engagement_trends"] = _with(
        _KPIS,
        f"""SELECT {_day()}, dau, feature_adoption_rate_pct, quiz_completion_rate_pct,
          {_r('avg_events_per_session', 'avg_events_per_session')},
          {_r('avg_session_duration_seconds', 'avg_session_duration_seconds')} FROM kpis""",
    )
    q["metrics_last_n_days"] = _with(
        _KPIS,
        f"SELECT {_KPI_COLUMNS} FROM kpis WHERE kpis.event_date > (SELECT max(event_date) FROM kpis) - 7",
    )
    q["event_breakdown"] = _with(
        _FACT,
        "SELECT event_type, event_category, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,"
        " count(DISTINCT session_id) AS unique_sessions FROM fact GROUP BY event_type, event_category",
    )
    q["device_distribution"] = _with(
        _FACT,
        """, d AS (SELECT device_type, count(DISTINCT session_id) AS sessions,
            count(DISTINCT session_id) FILTER (event_type = 'quiz_completed') AS completed FROM fact GROUP BY device_type)
        SELECT device_type, sessions, round(sessions::DOUBLE / (SELECT sum(sessions) FROM d) * 100, 2) AS share_pct,
          round(completed::DOUBLE / sessions * 100, 2) AS completion_rate_pct FROM d""",
    )
    q["hourly_pattern"] = _with(
        _FACT,
        """SELECT h::INTEGER AS hour_of_day, count(fact.event_id) AS event_count
        FROM range(24) AS hours(h) LEFT JOIN fact ON fact.event_hour = h GROUP BY h""",
    )
    q["events_this_hour"] = _with(
        _FACT,
        "SELECT count(*) AS event_count FROM fact WHERE event_timestamp >= TIMESTAMP '2024-01-15 12:00:00'"
        " AND event_timestamp < TIMESTAMP '2024-01-15 13:00:00'",
    )
    q["ingest_counts"] = _with("", "SELECT event_type, count(*) AS events_ingested FROM raw GROUP BY event_type")
    q["ingest_latency_p95"] = _with(
        "",
        "SELECT round(quantile_cont(((epoch_us(received) - epoch_us(event_timestamp)) // 1000)::DOUBLE, 0.95), 6)"
        " AS latency_p95_ms FROM raw",
    )
    q["active_sessions"] = _with(
        "",
        "SELECT count(DISTINCT session_id) AS active_sessions FROM raw WHERE event_timestamp >"
        " TIMESTAMP '2024-01-15 06:00:00' AND event_timestamp <= TIMESTAMP '2024-01-15 12:00:00'",
    )
    q["events_over_time"] = _with(
        "",
        f"""SELECT {_ts(window('1 hour'), 'window_start')},
          {_ts(window('1 hour') + " + INTERVAL '1 hour'", 'window_end')}, count(*) AS event_count
        FROM raw GROUP BY {window('1 hour')}""",
    )
    q["session_answers"] = _with(
        _ANSWERS,
        f"SELECT session_id, {_r('team_size', 'team_size')}, use_case, {_JOINED_FEATURES}, {_r('budget', 'budget')}"
        " FROM answers",
    )
    tools = ["databricks", "snowflake", "duckdb", "kafka", "airflow", "metabase"]
    q["recommendation_scores"] = _with(
        _SCORES,
        f"SELECT session_id, {_r('team_size', 'team_size')}, use_case, {_JOINED_FEATURES}, {_r('budget', 'budget')}, "
        + ", ".join(f"t[{i}] AS score_{tool}" for i, tool in enumerate(tools, 1))
        + f", {tools}[list_position(t, list_max(t))] AS recommendation_id,"
        " least(99, floor(list_max(t) / 200.0::DOUBLE * 100 + 0.5))::BIGINT AS match_score FROM totals",
    )
    return q
