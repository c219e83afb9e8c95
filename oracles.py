"""DuckDB SQL for each key of ``__spark_entry__.queries()``, over the same test tables.

The statements are written the long way round (joins to grids, one aggregate per KPI,
window sums), so they check the Spark plans rather than repeat them.
"""

from __future__ import annotations

# --- the test tables as CRM tables -------------------------------------------------------

DEALS = """
d1 AS (
  SELECT o_orderkey AS k, *, o_orderdate + INTERVAL 8215 DAY + to_hours(o_orderkey % 24) AS created_at
  FROM orders),
d2 AS (
  SELECT *, CASE WHEN k % 10 <> 0 THEN created_at + to_days(CAST(k % 7 AS INT)) END AS op_detected_at
  FROM d1),
d3 AS (
  SELECT *, CASE WHEN k % 5 <> 0 THEN op_detected_at + to_hours((k % 11) * 20 - 20) END
    AS proposal_prep_at
  FROM d2),
d4 AS (
  SELECT *, CASE WHEN k % 4 <> 0 THEN proposal_prep_at + to_hours((k % 13) * 17) END
      AS proposal_sent_at,
    CASE WHEN o_orderstatus = 'F' THEN created_at + to_days(CAST(30 + k % 90 AS INT)) END
      AS closed_won_at,
    CASE WHEN o_orderstatus = 'O' AND k % 3 = 0
      THEN created_at + to_days(CAST(15 + k % 60 AS INT)) END AS closed_lost_at
  FROM d3),
d5 AS (
  SELECT *, coalesce(closed_won_at, closed_lost_at,
    CASE WHEN k % 17 = 0 THEN created_at + INTERVAL 20 DAY END) AS closed_at
  FROM d4),
deals AS (
  SELECT CAST(k AS VARCHAR) AS deal_id,
    'Deal ' || k || CASE WHEN v = 2 THEN ' v2' ELSE '' END AS deal_name,
    CASE WHEN k % 37 <> 0 THEN CAST(o_custkey % 120 AS VARCHAR) END AS owner_id,
    CASE WHEN k % 10 = 3 THEN 'gone-' ELSE '' END || o_custkey AS company_id,
    CASE WHEN k % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS contact_id,
    CASE o_orderstatus WHEN 'F' THEN 'closedwon' WHEN 'O' THEN 'closedlost'
      ELSE 'appointmentscheduled' END AS deal_stage,
    created_at, closed_at,
    coalesce(closed_at, created_at + to_days(CAST(k % 30 AS INT)))
      + CASE WHEN v = 2 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS last_modified_at,
    CASE WHEN k % 50 = 0 THEN 'n/a'
      ELSE CAST(o_totalprice AS VARCHAR) END AS amount,
    op_detected_at, proposal_prep_at, proposal_sent_at, closed_won_at, closed_lost_at,
    nullif(o_orderpriority, '') AS source,
    strftime(created_at, '%Y-%m-%d') AS dt
  FROM d5, (VALUES (1), (2)) AS versions(v)
  WHERE v = 1 OR k % 5 = 0)"""

DEAL_COLUMNS = """deal_id, deal_name, owner_id, company_id, contact_id, deal_stage, created_at,
  closed_at, last_modified_at, amount, op_detected_at, proposal_prep_at, proposal_sent_at,
  closed_won_at, closed_lost_at, source, dt"""

LATEST = (
    DEALS
    + f""",
latest AS (
  SELECT {DEAL_COLUMNS} FROM (
    SELECT *, row_number() OVER (PARTITION BY deal_id ORDER BY created_at DESC NULLS LAST,
      last_modified_at DESC NULLS LAST, dt DESC NULLS LAST, deal_name DESC NULLS LAST) AS rn
    FROM deals) WHERE rn = 1)"""
)

CLEAN = (
    LATEST
    + """,
quality(has_close, has_won, has_lost, label, issue) AS (VALUES
  (FALSE, FALSE, FALSE, 'open', 0),
  (FALSE, FALSE, TRUE, 'properly_closed_lost', 0),
  (FALSE, TRUE, FALSE, 'properly_closed_won', 0),
  (FALSE, TRUE, TRUE, 'properly_closed_won', 0),
  (TRUE, FALSE, FALSE, 'has_close_date_no_stage_transition', 1),
  (TRUE, FALSE, TRUE, 'properly_closed_lost', 0),
  (TRUE, TRUE, FALSE, 'properly_closed_won', 0),
  (TRUE, TRUE, TRUE, 'properly_closed_won', 0)),
clean AS (
  SELECT latest.*, label AS deal_status_quality, issue AS has_data_quality_issue
  FROM latest JOIN quality ON has_close = (closed_at IS NOT NULL)
    AND has_won = (closed_won_at IS NOT NULL) AND has_lost = (closed_lost_at IS NOT NULL))"""
)

OWNERS = """
owners AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS owner_id, s_name AS owner_name,
    's' || s_suppkey || '@example.com' AS owner_email FROM supplier)"""

COMPANIES = """
companies AS (
  SELECT *, strftime(coalesce(last_modified_at, created_at), '%Y-%m-%d') AS dt FROM (
    SELECT CAST(c_custkey AS VARCHAR) AS company_id, c_name AS name,
      TIMESTAMP '2023-12-01' + to_days(CAST(c_custkey % 28 AS INT)) AS created_at,
      CASE WHEN c_custkey % 7 <> 0 THEN TIMESTAMP '2024-01-01'
        + to_days(CAST(c_custkey % 20 AS INT)) + to_hours(c_custkey % 24) END AS last_modified_at
    FROM customer))"""

CONTACTS = """
contacts AS (
  SELECT *, created_at + to_days(CAST(k % 9 AS INT)) AS last_modified_at,
    strftime(created_at, '%Y-%m-%d') AS dt
  FROM (
    SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS contact_id,
      CAST(c_custkey % 120 AS VARCHAR) AS owner_id, c_mktsegment AS firstname,
      c_name AS lastname, 'c' || c_custkey || '@example.com' AS email,
      TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 30 AS INT)) + to_hours(c_custkey % 24)
        AS created_at
    FROM customer))"""

CONTACT_COLUMNS = (
    "contact_id, owner_id, firstname, lastname, email, created_at, last_modified_at, dt"
)

NOTE_BODY = """CASE k % 4 WHEN 0 THEN 'Sent via LinkedIn ' || k WHEN 1 THEN 'whatsApp call ' || k
      ELSE 'Visit ' || k END"""
DIRECTION = (
    "CASE k % 3 WHEN 0 THEN 'INCOMING_EMAIL' WHEN 1 THEN 'EMAIL' ELSE 'FORWARDED_EMAIL' END"
)
CHANNEL = "CASE k % 3 WHEN 0 THEN 'WHATS_APP' WHEN 1 THEN 'LINKEDIN_MESSAGE' ELSE 'SMS' END"

ACTIVITY_BASE = """
a1 AS (
  SELECT event_id AS k, event_type, CAST(user_id % 120 AS VARCHAR) AS owner_id,
    ts AS created_at, ts + to_hours(event_id % 5) AS last_modified_at FROM events)"""

ACTIVITIES = (
    ACTIVITY_BASE
    + f""",
activities AS (
  SELECT k, CAST(k AS VARCHAR) AS activity_id,
    CASE event_type WHEN 'signup' THEN 'NOTE'
      WHEN 'purchase' THEN CASE WHEN k % 2 = 0 THEN 'EMAIL' ELSE 'INCOMING_EMAIL' END
      WHEN 'view' THEN 'call' WHEN 'click' THEN {CHANNEL}
      ELSE CASE k % 6 WHEN 0 THEN 'MEETING' WHEN 1 THEN 'TASK' WHEN 2 THEN 'FORWARDED_EMAIL'
        WHEN 3 THEN 'Postal' WHEN 4 THEN 'Other' END END AS activity_type,
    owner_id, created_at, last_modified_at,
    CASE WHEN event_type = 'signup' AND k % 5 = 2 THEN 'about WhatsApp' END AS communication_body,
    CASE WHEN event_type = 'error' AND k % 6 > 3 THEN CASE k % 5 WHEN 0 THEN 'LinkedIn import'
      WHEN 1 THEN 'WHATSAPP import' END END AS communication_source,
    CASE WHEN event_type = 'purchase' THEN {DIRECTION} END AS email_direction,
    CASE WHEN event_type = 'signup' THEN {NOTE_BODY} END AS note_body,
    strftime(created_at, '%Y-%m-%d') AS dt
  FROM a1),
labels(type, label) AS (VALUES
  ('CALL', 'Call'), ('EMAIL', 'Email sent to contact'), ('FORWARDED_EMAIL', 'Forwarded email'),
  ('INCOMING_EMAIL', 'Email reply from contact'), ('LINKEDIN', 'LinkedIn Message'),
  ('LINKEDIN_MESSAGE', 'LinkedIn Message'), ('MEETING', 'Meeting'), ('NOTE', 'Note'),
  ('SMS', 'SMS'), ('TASK', 'Task'), ('WHATS APP', 'WhatsApp'), ('WHATS-APP', 'WhatsApp'),
  ('WHATSAPP', 'WhatsApp'), ('WHATS_APP', 'WhatsApp')),
words(needle, named, rank) AS (VALUES
  ('whatsapp', 'WhatsApp', 2), ('linkedin', 'LinkedIn Message', 1)),
-- What a text is searched for depends on the type: notes by their bodies, types without a
-- label by their source, an email by its direction.
searched AS (
  SELECT activity_id, CASE WHEN label = 'Note' THEN concat_ws(' ', note_body, communication_body)
      WHEN label IS NULL THEN communication_source END AS text,
    CASE WHEN upper(activity_type) = 'EMAIL' THEN email_direction ELSE activity_type END AS type,
    activity_type AS plain
  FROM activities LEFT JOIN labels ON type = upper(activity_type)),
found AS (
  SELECT activity_id, arg_min(named, rank) AS named
  FROM searched JOIN words ON contains(lower(text), needle) GROUP BY activity_id),
categorized AS (
  SELECT a.*, coalesce(f.named,
    CASE WHEN upper(a.activity_type) = 'EMAIL' AND upper(s.type) <> 'INCOMING_EMAIL'
      THEN 'Email sent to contact' END,
    l.label, CASE WHEN upper(a.activity_type) = 'EMAIL' THEN 'Email sent to contact' END,
    a.activity_type, 'Unknown') AS activity_category
  FROM activities a JOIN searched s USING (activity_id) LEFT JOIN found f USING (activity_id)
    LEFT JOIN labels l ON l.type = upper(s.type))"""
)

DURATIONS = (
    CLEAN
    + ","
    + OWNERS
    + """,
durations AS (
  SELECT d.deal_id, d.deal_name, d.owner_id, coalesce(o.owner_name, d.owner_id) AS owner_name,
    d.created_at, d.closed_at, d.op_detected_at, d.proposal_prep_at, d.proposal_sent_at,
    d.closed_won_at, d.closed_lost_at, TRY_CAST(d.amount AS DOUBLE) AS amount,
    date_sub('day', d.created_at, d.op_detected_at) AS created_to_op_days,
    date_sub('day', d.op_detected_at, d.proposal_prep_at) AS op_to_prep_days,
    date_sub('day', d.proposal_prep_at, d.proposal_sent_at) AS prep_to_sent_days,
    date_sub('day', d.proposal_sent_at, d.closed_won_at) AS sent_to_won_days,
    date_sub('day', d.created_at, coalesce(d.closed_won_at, d.closed_lost_at))
      AS sales_cycle_days,
    d.closed_won_at IS NOT NULL AND d.deal_status_quality = 'properly_closed_won' AS is_won
  FROM clean d LEFT JOIN owners o ON o.owner_id = d.owner_id)"""
)


def _local(ts: str) -> str:
    return f"({ts} - INTERVAL 3 HOUR)"


def _month(ts: str) -> str:
    return f"CAST(date_trunc('month', {_local(ts)}) AS DATE)"


def _gap_average(name: str, start: str, end: str) -> str:
    days = f"date_diff('day', CAST({_local(start)} AS DATE), CAST({_local(end)} AS DATE))"
    return f"""
{name} AS (
  SELECT {_month(end)} AS m, avg(CASE WHEN {days} >= 0 THEN {days} END) AS value
  FROM clean WHERE {start} IS NOT NULL AND {end} IS NOT NULL GROUP BY 1)"""


def _event_count(name: str, event: str) -> str:
    return f"""
{name} AS (SELECT {_month(event)} AS m, count(*) AS value FROM clean
  WHERE {event} IS NOT NULL GROUP BY 1)"""


MONTHLY = (
    CLEAN
    + """,
months AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2022-01-01', TIMESTAMP '2024-01-01',
  INTERVAL 1 MONTH)) AS DATE) AS month_start),"""
    + ",".join(
        [
            _event_count("e1", "op_detected_at"),
            _event_count("e2", "proposal_sent_at"),
            _event_count("e3", "closed_won_at"),
            _gap_average("g1", "op_detected_at", "proposal_prep_at"),
            _gap_average("g2", "proposal_prep_at", "proposal_sent_at"),
            _gap_average("g3", "proposal_sent_at", "closed_won_at"),
            _gap_average("g4", "created_at", "closed_won_at"),
        ]
    )
    + """,
monthly AS (
  SELECT month_start, coalesce(e1.value, 0) AS opportunities_created,
    coalesce(e2.value, 0) AS proposals_sent, coalesce(e3.value, 0) AS closed_won,
    g1.value AS avg_op_to_prep_days, g2.value AS avg_prep_to_sent_days,
    g3.value AS avg_sent_to_won_days, g4.value AS avg_sales_cycle_days
  FROM months"""
    + "".join(
        f" LEFT JOIN {t} ON {t}.m = month_start" for t in ["e1", "e2", "e3", "g1", "g2", "g3", "g4"]
    )
    + ")"
)

MONTHLY_ROWS = [
    (1, "Opportunities Created", "opportunities_created", "count"),
    (2, "Proposals Sent", "proposals_sent", "count"),
    (3, "Deals Closed (Won)", "closed_won", "count"),
    (4, "Avg Days Op Detected → Proposal Prep", "avg_op_to_prep_days", "avg_days"),
    (5, "Avg Days Proposal Prep → Proposal Sent", "avg_prep_to_sent_days", "avg_days"),
    (6, "Avg Days Proposal Sent → Won", "avg_sent_to_won_days", "avg_days"),
    (7, "Sales Cycle Avg (Create → Won)", "avg_sales_cycle_days", "avg_days"),
]

WEEKS = """
weeks AS (SELECT CAST(d AS DATE) AS week_start
  FROM (VALUES (DATE '2024-01-01'), (DATE '2024-01-08'), (DATE '2024-01-15')) AS w(d))"""

SHORT_LABEL = (
    "strftime(week_start, '%b %-d') || ' - ' || strftime(week_start + INTERVAL 6 DAY, '%b %-d')"
)


def _weekly_count(name: str, event: str, by: str = "") -> str:
    return f"""
{name} AS (
  SELECT week_start {by}, count(*) AS n FROM weeks JOIN clean
    ON CAST({_local(event)} AS DATE) BETWEEN week_start AND week_start + INTERVAL 6 DAY
  GROUP BY ALL)"""


def _weekly(by: str = "") -> str:
    events = [("w1", "op_detected_at"), ("w2", "proposal_sent_at"), ("w3", "closed_won_at")]
    return ",".join(_weekly_count(name, event, by) for name, event in events)


WEEKLY = (
    CLEAN
    + ","
    + WEEKS
    + ","
    + _weekly()
    + f""",
weekly AS (
  SELECT week_start, CAST(week_start + INTERVAL 6 DAY AS DATE) AS week_end,
    {SHORT_LABEL} AS week_label, coalesce(w1.n, 0) AS opportunities_created,
    coalesce(w2.n, 0) AS proposals_sent, coalesce(w3.n, 0) AS closed_won
  FROM weeks LEFT JOIN w1 USING (week_start) LEFT JOIN w2 USING (week_start)
    LEFT JOIN w3 USING (week_start))"""
)

WEEKLY_BY_OWNER = (
    CLEAN
    + ","
    + OWNERS
    + ","
    + WEEKS
    + ","
    + _weekly(", owner_id")
    + f"""
SELECT owner_id, coalesce(owner_name, owner_id) AS owner_name, week_start,
  CAST(week_start + INTERVAL 6 DAY AS DATE) AS week_end, {SHORT_LABEL} AS week_label,
  coalesce(w1.n, 0) AS opportunities_created, coalesce(w2.n, 0) AS proposals_sent,
  coalesce(w3.n, 0) AS closed_won
FROM owners CROSS JOIN weeks LEFT JOIN w1 USING (owner_id, week_start)
  LEFT JOIN w2 USING (owner_id, week_start) LEFT JOIN w3 USING (owner_id, week_start)"""
)

COHORT_MONTHS = """
cohorts AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2023-08-01', TIMESTAMP '2024-01-01',
  INTERVAL 1 MONTH)) AS DATE) AS cohort_month),
cohort_deals AS (
  SELECT deal_id, owner_id, c.cohort_month, coalesce(w.cohort_month, l.cohort_month) AS closed_month
  FROM latest JOIN cohorts c ON c.cohort_month = CAST(date_trunc('month', created_at - INTERVAL 3 HOUR) AS DATE)
    LEFT JOIN cohorts w ON w.cohort_month = CAST(date_trunc('month', closed_won_at - INTERVAL 3 HOUR) AS DATE)
    LEFT JOIN cohorts l ON l.cohort_month = CAST(date_trunc('month', closed_lost_at - INTERVAL 3 HOUR) AS DATE))"""

COHORTS = (
    LATEST
    + ","
    + COHORT_MONTHS
    + """,
totals AS (SELECT cohort_month, count(*) AS n FROM cohort_deals GROUP BY 1),
closed AS (SELECT cohort_month, closed_month, count(*) AS n FROM cohort_deals GROUP BY 1, 2),
rates0 AS (
  SELECT c.cohort_month, m.cohort_month AS month_start, coalesce(totals.n, 0) AS total_deals,
    coalesce(closed.n, 0) AS closed_in_month
  FROM cohorts c JOIN cohorts m ON m.cohort_month >= c.cohort_month
    LEFT JOIN totals ON totals.cohort_month = c.cohort_month
    LEFT JOIN closed ON closed.cohort_month = c.cohort_month
      AND closed.closed_month = m.cohort_month),
rates1 AS (
  SELECT *, CAST(sum(closed_in_month) OVER (PARTITION BY cohort_month ORDER BY month_start
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_closed FROM rates0),
rates AS (
  SELECT *, CASE WHEN total_deals > 0
    THEN CAST(round(cumulative_closed * 100.0 / total_deals) AS INT) ELSE 0 END AS cumulative_pct
  FROM rates1)"""
)

COHORTS_BY_OWNER = (
    LATEST
    + ","
    + OWNERS
    + ","
    + COHORT_MONTHS
    + """,
owned AS (SELECT * FROM cohort_deals WHERE owner_id IS NOT NULL),
in_scope AS (SELECT DISTINCT owner_id FROM owned),
totals AS (SELECT owner_id, cohort_month, count(*) AS n FROM owned GROUP BY 1, 2),
closed AS (SELECT owner_id, cohort_month, closed_month, count(*) AS n FROM owned GROUP BY 1, 2, 3),
rates0 AS (
  SELECT s.owner_id, c.cohort_month, m.cohort_month AS month_start,
    coalesce(totals.n, 0) AS total_deals, coalesce(closed.n, 0) AS closed_in_month
  FROM cohorts c JOIN cohorts m ON m.cohort_month >= c.cohort_month CROSS JOIN in_scope s
    LEFT JOIN totals ON totals.cohort_month = c.cohort_month AND totals.owner_id = s.owner_id
    LEFT JOIN closed ON closed.cohort_month = c.cohort_month AND closed.owner_id = s.owner_id
      AND closed.closed_month = m.cohort_month),
rates1 AS (
  SELECT *, CAST(sum(closed_in_month) OVER (PARTITION BY owner_id, cohort_month
    ORDER BY month_start ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_closed FROM rates0),
rates AS (
  SELECT r.owner_id, coalesce(o.owner_name, r.owner_id) AS owner_name, cohort_month, month_start,
    total_deals, closed_in_month, cumulative_closed, CASE WHEN total_deals > 0
    THEN CAST(round(cumulative_closed * 100.0 / total_deals) AS INT) ELSE 0 END AS cumulative_pct
  FROM rates1 r LEFT JOIN owners o ON o.owner_id = r.owner_id)"""
)

COHORT_LABELS = """'Deals created in ' || strftime(cohort_month, '%B %Y') AS cohort_label,
  strftime(month_start, '%B %Y') AS month_label"""
COHORT_PARTS = """year(cohort_month) AS cohort_year, month(cohort_month) AS cohort_month_num,
  year(month_start) AS closing_year, month(month_start) AS closing_month_num"""

ALL_EVENTS = (
    LATEST
    + ","
    + OWNERS
    + ","
    + CONTACTS
    + ","
    + ACTIVITIES
    + """,
all_events AS (
  SELECT owner_id, created_at, last_modified_at, activity_category AS activity_type, dt
  FROM categorized
  UNION ALL SELECT owner_id, created_at, last_modified_at, 'Contact created', NULL FROM contacts
  UNION ALL SELECT owner_id, last_modified_at, last_modified_at, 'Contact worked', NULL FROM contacts
  UNION ALL SELECT owner_id, created_at, last_modified_at, 'Deal created', dt FROM latest)"""
)

# --- raw objects -------------------------------------------------------------------------

RAW_DEALS = (
    DEALS
    + """,
raw AS (
  SELECT *, CAST(deal_id AS BIGINT) AS j FROM deals),
normalized AS (
  SELECT deal_id, CASE WHEN j % 11 <> 0 THEN deal_name ELSE '' END AS deal_name, owner_id,
    company_id, contact_id, deal_stage,
    created_at, CASE WHEN j % 13 <> 0 THEN closed_at END AS closed_at, last_modified_at, amount,
    op_detected_at, proposal_prep_at, proposal_sent_at, closed_won_at, closed_lost_at,
    CASE j % 6 WHEN 1 THEN 'Campaign' WHEN 2 THEN 'Fair' ELSE source END AS source, dt
  FROM raw)"""
)

RAW_ACTIVITIES = (
    ACTIVITY_BASE
    + f""",
r1 AS (
  SELECT *, CASE event_type WHEN 'signup' THEN 'notes' WHEN 'purchase' THEN 'emails'
    WHEN 'view' THEN 'calls' WHEN 'click' THEN 'communications'
    ELSE CASE WHEN k % 2 = 0 THEN 'meetings' ELSE 'tasks' END END AS object_type,
    {DIRECTION} AS direction, {CHANNEL} AS channel FROM a1),
metadata AS (
  SELECT k, CAST(k AS VARCHAR) AS activity_id, object_type,
    CASE object_type
      WHEN 'emails' THEN CASE WHEN k % 10 = 0 THEN 'EMAIL' ELSE direction END
      WHEN 'calls' THEN 'CALL' WHEN 'meetings' THEN 'MEETING' WHEN 'tasks' THEN 'TASK'
      WHEN 'notes' THEN 'NOTE' ELSE CASE WHEN k % 5 = 0 THEN 'NOTE' ELSE channel END END
      AS activity_type,
    CASE WHEN k % 9 <> 0 THEN owner_id END AS owner_id,
    CASE WHEN k % 97 <> 0 THEN created_at END AS created_at,
    CASE WHEN k % 4 <> 0 THEN last_modified_at WHEN k % 97 <> 0 THEN created_at END
      AS last_modified_at,
    CASE WHEN object_type = 'communications'
      THEN CASE WHEN k % 2 = 0 THEN 'body ' || k ELSE 'preview ' || k END END AS communication_body,
    CASE WHEN object_type = 'communications' THEN 'CRM_v3_Communications' END
      AS communication_source,
    CASE WHEN object_type = 'tasks' THEN 'Task ' || k END AS task_subject,
    CASE WHEN object_type = 'tasks' THEN '' END AS task_body,
    CASE WHEN object_type = 'tasks' THEN CASE WHEN k % 3 = 0 THEN 'WAITING' ELSE '' END END
      AS task_status,
    CASE WHEN object_type = 'calls' THEN 'Call ' || k END AS call_title,
    CASE WHEN object_type = 'calls' THEN '' END AS call_body,
    CASE WHEN object_type = 'calls' THEN CAST(k % 600 AS VARCHAR) END AS call_duration,
    CASE WHEN object_type = 'calls' THEN '' END AS call_outcome,
    CASE WHEN object_type = 'meetings' THEN 'Meeting ' || k END AS meeting_title,
    CASE WHEN object_type = 'meetings' THEN '' END AS meeting_body,
    CASE WHEN object_type = 'meetings' THEN CASE WHEN k % 4 = 0 THEN 'COMPLETED' ELSE '' END END
      AS meeting_outcome,
    CASE WHEN object_type = 'emails' THEN 'Mail ' || k END AS email_subject,
    CASE WHEN object_type = 'emails' THEN '' END AS email_body,
    CASE WHEN object_type = 'emails' THEN CASE WHEN k % 10 = 0 THEN '' ELSE direction END END
      AS email_direction,
    CASE WHEN object_type = 'notes' THEN {NOTE_BODY} END AS note_body,
    CASE WHEN k % 97 <> 0 THEN strftime(created_at, '%Y-%m-%d') END AS dt
  FROM r1)"""
)

ACTIVITY_COLUMNS = """activity_id, activity_type, owner_id, created_at, last_modified_at,
  communication_body, communication_source, task_subject, task_body, task_status, call_title,
  call_body, call_duration, call_outcome, meeting_title, meeting_body, meeting_outcome,
  email_subject, email_body, email_direction, note_body, dt"""

METADATA_COLUMNS = """communication_body, communication_source, task_subject, task_body,
  task_status, call_title, call_body, call_duration, call_outcome, meeting_title, meeting_body,
  meeting_outcome, email_subject, email_body, email_direction, note_body"""

STAGES = """
stages AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS pipeline_id, r_name AS pipeline_label,
    CAST(n_nationkey + up AS VARCHAR) AS stage_id, n_name AS stage_label,
    CAST(n_nationkey + up AS INT) AS display_order,
    CASE WHEN up = 0 THEN 'false' ELSE 'true' END AS is_closed,
    CAST(CAST((n_nationkey + up) % 10 / 10 AS DOUBLE) AS VARCHAR) AS probability
  FROM nation JOIN region ON n_regionkey = r_regionkey, (VALUES (0), (100)) AS u(up)
  WHERE n_nationkey % 6 <> 5)"""

# --- incremental load --------------------------------------------------------------------

CHANGES = (
    DEALS
    + """,
changes AS (
  SELECT *, 0 AS change_set FROM deals
    WHERE created_at BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-24'
  UNION ALL
  SELECT *, 1 FROM deals
    WHERE last_modified_at BETWEEN TIMESTAMP '2023-12-20' AND TIMESTAMP '2024-01-24')"""
)

VERSIONS = (
    DEALS
    + """,
versions AS (SELECT *, deal_name LIKE '% v2' AS is_second FROM deals)"""
)


def _keep(order: str) -> str:
    return f"""
SELECT deal_id, deal_name, last_modified_at, amount FROM (
  SELECT *, row_number() OVER (PARTITION BY deal_id ORDER BY {order}) AS rn FROM versions)
WHERE rn = 1"""


UPDATED_ACTIVITIES = (
    ACTIVITIES
    + """,
updated AS (
  SELECT activity_id, CASE WHEN k % 5 >= 3 THEN 'UPDATED' ELSE activity_type END AS activity_type,
    owner_id, created_at, last_modified_at, dt FROM activities)"""
)

SLIM_ACTIVITY = "activity_id, activity_type, owner_id, created_at, last_modified_at, dt"

def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def statements() -> dict[str, str]:
    out = {}

    # views
    out["v01_deals_latest"] = _with(LATEST, "SELECT * FROM latest")
    out["v02_deals_latest_clean"] = _with(CLEAN, "SELECT * FROM clean")
    out["v03_deals_with_company"] = _with(
        LATEST + "," + COMPANIES,
        """SELECT deal_id, deal_name, d.company_id, c.name AS company_name, owner_id, deal_stage,
          d.created_at, closed_at, amount, op_detected_at, proposal_prep_at, proposal_sent_at,
          closed_won_at, closed_lost_at, source, d.dt
        FROM latest d LEFT JOIN companies c ON c.company_id = d.company_id""",
    )
    out["v04_deal_stage_durations_per_deal"] = _with(DURATIONS, "SELECT * FROM durations")
    out["v05_deal_kpis_monthly"] = _with(
        DURATIONS,
        """SELECT CAST(date_trunc('month', created_at) AS DATE) AS month_start, owner_id,
          owner_name, count(*) AS deals_created,
          CAST(sum(CASE WHEN is_won THEN 1 ELSE 0 END) AS BIGINT) AS deals_won,
          sum(CASE WHEN is_won THEN 1 ELSE 0 END) / count(*) AS win_rate,
          avg(sales_cycle_days) AS avg_sales_cycle_days,
          avg(created_to_op_days) AS avg_created_to_op_days,
          avg(op_to_prep_days) AS avg_op_to_prep_days,
          avg(prep_to_sent_days) AS avg_prep_to_sent_days,
          avg(sent_to_won_days) AS avg_sent_to_won_days,
          CAST(sum(amount) AS DECIMAL(18, 2)) AS total_amount
        FROM durations GROUP BY 1, 2, 3""",
    )
    out["v06_deal_kpis_monthly_v2"] = _with(MONTHLY, "SELECT * FROM monthly")
    out["v07_deal_kpis_monthly_transposed"] = _with(
        MONTHLY,
        "SELECT *, year(month_start) AS sort_year, month(month_start) AS sort_month FROM ("
        + " UNION ALL ".join(
            f"""SELECT {order} AS sort_order, '{label}' AS kpi_metric, month_start,
              strftime(month_start, '%B %Y') AS month_label, CAST({column} AS DOUBLE) AS kpi_value,
              '{kind}' AS value_type FROM monthly"""
            for order, label, column, kind in MONTHLY_ROWS
        )
        + ")",
    )
    out["v08_deal_kpis_weekly_last3"] = _with(WEEKLY, "SELECT * FROM weekly")
    out["v09_deal_kpis_weekly_last3_by_owner"] = _with(WEEKLY_BY_OWNER, "")
    out["v10_deal_kpis_weekly_last3_transposed"] = _with(
        WEEKLY,
        """SELECT *, year(week_start) AS sort_year, week(week_start) AS sort_week,
          strftime(week_start, '%B %Y') AS month_label,
          dense_rank() OVER (ORDER BY week_start DESC) AS week_position FROM ("""
        + " UNION ALL ".join(
            f"""SELECT week_start, week_end, week_label, '{label}' AS kpi_metric,
              {column} AS kpi_value, '{kind}' AS value_type, {order} AS sort_order FROM weekly"""
            for order, label, column, kind in MONTHLY_ROWS[:3]
        )
        + ")",
    )
    out["v11_deal_cohort_closing_rates"] = _with(COHORTS, "SELECT * FROM rates")
    out["v05_integer_win_rate"] = out["v05_deal_kpis_monthly"].replace(
        "sum(CASE WHEN is_won THEN 1 ELSE 0 END) / count(*) AS win_rate",
        "CAST(sum(CASE WHEN is_won THEN 1 ELSE 0 END) // count(*) AS BIGINT) AS win_rate",
    )
    whole = "round(cumulative_closed * 100.0 / total_deals)"
    tenths = "round(round(CAST(cumulative_closed * 100.0 / total_deals AS DECIMAL(20, 10)), 1))"
    out["v11_stepwise_percent"] = _with(
        COHORTS.replace(whole, tenths), "SELECT * FROM rates"
    )
    out["v12_deal_cohort_closing_rates_by_owner"] = _with(
        COHORTS_BY_OWNER,
        """SELECT *, strftime(cohort_month, '%B %Y') AS cohort_label_en,
          strftime(month_start, '%B %Y') AS month_label_en FROM rates""",
    )
    out["v13_deal_cohort_closing_rates_transposed"] = _with(
        COHORTS,
        f"""SELECT cohort_month, month_start, {COHORT_LABELS},
          coalesce(cumulative_pct, 0) AS cumulative_pct, {COHORT_PARTS}
        FROM (SELECT DISTINCT cohort_month FROM rates) CROSS JOIN
          (SELECT DISTINCT month_start FROM rates)
          LEFT JOIN rates USING (cohort_month, month_start) WHERE month_start >= cohort_month""",
    )
    out["v14_deal_cohort_closing_rates_by_owner_transposed"] = _with(
        COHORTS_BY_OWNER,
        f"""SELECT owner_id, o.owner_name, cohort_month, month_start, {COHORT_LABELS},
          coalesce(cumulative_pct, 0) AS cumulative_pct, coalesce(total_deals, 0) AS total_deals,
          coalesce(cumulative_closed, 0) AS cumulative_closed, {COHORT_PARTS}
        FROM (SELECT DISTINCT owner_id, owner_name FROM rates) o
          CROSS JOIN (SELECT DISTINCT cohort_month FROM rates)
          CROSS JOIN (SELECT DISTINCT month_start FROM rates)
          LEFT JOIN rates USING (owner_id, cohort_month, month_start)
        WHERE month_start >= cohort_month""",
    )
    out["v15_activity_volume_by_owner_type_weekly"] = _with(
        ACTIVITIES + "," + OWNERS,
        """SELECT a.owner_id, coalesce(o.owner_name, a.owner_id) AS owner_name,
          CAST(date_trunc('week', a.created_at) AS DATE) AS week_start, activity_type,
          count(*) AS activity_count
        FROM activities a LEFT JOIN owners o ON o.owner_id = a.owner_id GROUP BY 1, 2, 3, 4""",
    )
    out["v16_activity_volume_by_owner"] = _with(
        ALL_EVENTS,
        """SELECT e.owner_id, coalesce(o.owner_name, e.owner_id) AS owner_name, e.created_at,
          e.last_modified_at, activity_type, count(*) AS activity_count
        FROM all_events e LEFT JOIN owners o ON o.owner_id = e.owner_id GROUP BY 1, 2, 3, 4, 5""",
    )

    def last_weeks(dt_low: str, dt_high: str) -> str:
        return _with(
            ALL_EVENTS,
            f"""SELECT e.owner_id, coalesce(o.owner_name, e.owner_id) AS owner_name, week_start,
              CAST(week_start + INTERVAL 6 DAY AS DATE) AS week_end,
              strftime(week_start, '%B %-d') || ' to '
                || strftime(week_start + INTERVAL 6 DAY, '%B %-d, %Y') AS week_label_en,
              activity_type, count(*) AS activity_count
            FROM (SELECT *, CAST(date_trunc('week', {_local("created_at")}) AS DATE) AS week_start
                FROM all_events WHERE dt IS NULL OR dt BETWEEN '{dt_low}' AND '{dt_high}') e
              LEFT JOIN owners o ON o.owner_id = e.owner_id
            WHERE e.owner_id IN ('1', '2', '3', '5', '8')
              AND week_start BETWEEN DATE '2024-01-01' AND DATE '2024-01-21' GROUP BY ALL""",
        )

    out["v17_activity_volume_by_owner_type_last3weeks_v3"] = last_weeks("2000", "2100")
    out["v17_activity_volume_last3weeks_strict_dt"] = last_weeks("2024-01-01", "2024-01-21")

    # calendar and categories
    out["c1_activity_category"] = _with(
        ACTIVITIES, "SELECT activity_id, activity_type, activity_category FROM categorized"
    )
    out["c2_week_bounds"] = _with(
        ACTIVITIES,
        f"""SELECT activity_id, local_day, CAST(local_day - CAST(dayofweek(local_day) AS INT) AS DATE)
          AS last_sunday, week_start, CAST(week_start + INTERVAL 6 DAY AS DATE) AS week_end,
          {SHORT_LABEL} AS week_label
        FROM (SELECT activity_id, CAST({_local("created_at")} AS DATE) AS local_day,
          CAST(date_trunc('week', {_local("created_at")}) AS DATE) AS week_start
          FROM activities)""",
    )
    out["c3_month_spine"] = _with(
        LATEST,
        """SELECT CAST(m AS DATE) AS month_start, count(*) AS open_deals FROM (
          SELECT unnest(generate_series(date_trunc('month', created_at)::TIMESTAMP,
            date_trunc('month', closed_at)::TIMESTAMP, INTERVAL 1 MONTH)) AS m
          FROM latest WHERE closed_at IS NOT NULL) GROUP BY 1""",
    )
    out["c4_local_month_bounds"] = _with(
        LATEST,
        f"""SELECT deal_id, month, month::TIMESTAMP + INTERVAL 3 HOUR AS start_utc,
          (month + INTERVAL 1 MONTH)::TIMESTAMP + INTERVAL 3 HOUR AS end_utc,
          CAST(date_trunc('month', created_at + INTERVAL 3 HOUR) AS DATE) AS shifted_month
        FROM (SELECT deal_id, created_at, {_month("created_at")} AS month FROM latest)""",
    )

    # normalizers
    out["n01_normalize_deals"] = _with(RAW_DEALS, f"SELECT {DEAL_COLUMNS} FROM normalized")
    out["n02_stage_timestamps"] = _with(
        RAW_DEALS,
        """SELECT deal_id, op_detected_at, proposal_prep_at, proposal_sent_at, closed_won_at,
          closed_lost_at, count(*) AS versions FROM normalized GROUP BY ALL""",
    )
    out["n03_first_filled"] = _with(
        RAW_DEALS, "SELECT deal_id, source, count(*) AS versions FROM normalized GROUP BY ALL"
    )
    out["n04_first_associated_id"] = _with(
        RAW_DEALS, "SELECT DISTINCT deal_id, company_id, contact_id FROM normalized"
    )
    out["n05_parse_mixed_timestamp"] = _with(
        RAW_DEALS, "SELECT deal_id, created_at, closed_at, last_modified_at FROM normalized"
    )
    out["n06_normalize_activities"] = _with(
        RAW_ACTIVITIES, f"SELECT {ACTIVITY_COLUMNS} FROM metadata"
    )
    out["n07_map_specific_type"] = _with(
        RAW_ACTIVITIES, "SELECT activity_id, object_type, activity_type FROM metadata"
    )
    out["n08_extract_metadata"] = _with(
        RAW_ACTIVITIES, f"SELECT activity_id, {METADATA_COLUMNS} FROM metadata"
    )
    out["n09_keep_dated_distinct"] = _with(
        RAW_ACTIVITIES, f"SELECT {ACTIVITY_COLUMNS} FROM metadata WHERE created_at IS NOT NULL"
    )
    out["n10_normalize_contacts"] = _with(CONTACTS, f"SELECT {CONTACT_COLUMNS} FROM contacts")
    out["n11_normalize_companies"] = _with(
        COMPANIES, "SELECT company_id, name, created_at, last_modified_at, dt FROM companies"
    )
    out["n12_normalize_owners"] = """
        SELECT CAST(s_suppkey AS VARCHAR) AS owner_id,
          CASE WHEN s_suppkey % 12 = 0 THEN 'Unknown' WHEN s_suppkey % 4 = 0 THEN s_name
            WHEN s_suppkey % 3 = 0 THEN 'Ana' ELSE 'Ana ' || s_name END AS owner_name,
          CASE WHEN s_suppkey % 5 <> 0 THEN 's' || s_suppkey || '@example.com' END AS owner_email,
          '2024-01-01T00:00:00.000Z' AS created_at, '2024-01-02T00:00:00.000Z' AS last_modified_at
        FROM supplier"""
    out["n13_flatten_pipelines"] = _with(STAGES, "SELECT * FROM stages")
    out["n14_normalize_activities_alternate"] = _with(
        RAW_ACTIVITIES,
        """SELECT CAST(k AS VARCHAR) AS activity_id,
          CASE object_type WHEN 'emails' THEN 'Email' WHEN 'calls' THEN 'Call'
            WHEN 'meetings' THEN 'Meeting' WHEN 'tasks' THEN 'Task' WHEN 'notes' THEN 'Note'
            ELSE CASE WHEN k % 5 = 0 THEN 'Communication' WHEN k % 3 = 0 THEN 'WhatsApp'
              WHEN k % 3 = 1 THEN 'LinkedIn Message' ELSE 'SMS' END END AS activity_type,
          object_type,
          CASE WHEN object_type = 'communications' AND k % 5 <> 0 THEN 'via ' || CASE k % 3
            WHEN 0 THEN 'whatsapp' WHEN 1 THEN 'linkedin_message' ELSE 'sms' END END AS channel,
          CASE WHEN k % 9 = 0 THEN 'creator' ELSE owner_id END AS owner_id,
          CASE WHEN k % 97 = 0 AND k % 8 <> 0 THEN 'junk'
            ELSE strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ') END AS occurred_at
        FROM r1""",
    )
    out["n15_normalize_deals_compact"] = _with(
        RAW_DEALS,
        """SELECT deal_id, CASE WHEN j % 11 <> 0 THEN deal_name END AS deal_name, owner_id,
          TRY_CAST(amount AS DOUBLE) AS amount,
          CASE WHEN j % 2 <> 0 THEN created_at END AS created_at, deal_stage AS dealstage
        FROM raw""",
    )
    out["n16_flatten_associations"] = """
        SELECT CAST(o_orderkey AS VARCHAR) AS from_id, CAST(i AS INT) AS position,
          CAST(o_custkey + i AS VARCHAR) AS to_id
        FROM orders, (VALUES (0), (1)) AS p(i)
        WHERE NOT (o_orderkey % 3 = 2 AND o_orderkey % 11 = 0) AND (i = 0 OR o_orderkey % 2 = 1)"""
    out["n17_partition_date"] = _with(
        RAW_DEALS, "SELECT dt, count(*) AS deals FROM normalized GROUP BY 1"
    )
    out["f01_timestamp_text"] = _with(
        LATEST,
        """SELECT deal_id, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%gZ') AS created_text,
          CASE WHEN CAST(deal_id AS BIGINT) % 2 = 0 THEN created_at
            ELSE date_trunc('day', created_at)::TIMESTAMP END AS created_again,
          CASE WHEN CAST(deal_id AS BIGINT) % 3 = 0 THEN 0 ELSE epoch_ms(created_at) END
            AS created_millis
        FROM latest""",
    )

    # incremental load
    out["i01_select_changes"] = _with(
        CHANGES, "SELECT deal_id, last_modified_at, change_set FROM changes"
    )
    out["i02_latest_changes"] = _with(
        CHANGES,
        """SELECT deal_id, deal_name, last_modified_at FROM (
          SELECT *, row_number() OVER (PARTITION BY deal_id
            ORDER BY change_set DESC, last_modified_at DESC) AS rn FROM changes)
        WHERE rn = 1""",
    )
    out["i03_merge_last_wins"] = _with(VERSIONS, _keep("is_second DESC"))
    out["i03_merge_greatest_timestamp"] = _with(
        VERSIONS, _keep("last_modified_at DESC NULLS LAST, is_second")
    )
    out["i03_merge_resolver"] = _with(
        VERSIONS, _keep("length(deal_name) DESC, is_second")
    )
    # A fold in row order: an ordered list per key, then what each way keeps of it.
    out["i03_merge_fold_hot_key"] = """
        WITH runs AS (
          SELECT CASE WHEN l_orderkey % 50 = 0 THEN 'order ' || l_orderkey ELSE 'hot' END AS id,
            list({'flag': l_returnflag, 'note': CASE WHEN l_linenumber % 3 = 0
              THEN 'n' || l_orderkey WHEN l_linenumber % 3 = 1 THEN '' END,
              'quantity': CAST(l_quantity AS BIGINT), 'price': l_extendedprice}
              ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS run
          FROM lineitem GROUP BY 1)
        SELECT id, run[1].flag AS first_flag, run[-1].flag AS flag,
          list_filter(run, lambda x: x.note <> '')[-1].note AS note,
          CAST(list_sum(list_transform(run, lambda x: x.quantity)) AS BIGINT) AS quantity,
          list_max(list_transform(run, lambda x: x.price)) AS price
        FROM runs"""
    out["i04_merge_upsert"] = _with(
        UPDATED_ACTIVITIES, f"SELECT {SLIM_ACTIVITY} FROM updated"
    )
    out["i04_merge_upsert_global_key"] = _with(
        COMPANIES,
        """SELECT company_id, name || CASE WHEN last_modified_at IS NOT NULL THEN ' v2' ELSE '' END
          AS name, dt FROM companies""",
    )
    out["i05_full_load"] = _with(ACTIVITIES, f"SELECT {SLIM_ACTIVITY} FROM activities")
    out["i06_high_water_marks"] = _with(
        DEALS + "," + ACTIVITIES,
        """SELECT 'deals' AS object_type,
          strftime(max(created_at), '%Y-%m-%dT%H:%M:%S.%gZ') AS max_created_at,
          strftime(max(last_modified_at), '%Y-%m-%dT%H:%M:%S.%gZ') AS max_modified_at,
          count(*) AS rows FROM deals
        UNION ALL SELECT 'activities', strftime(max(created_at), '%Y-%m-%dT%H:%M:%S.%gZ'),
          strftime(max(last_modified_at), '%Y-%m-%dT%H:%M:%S.%gZ'), count(*) FROM activities""",
    )
    out["i07_changed_since_mark"] = _with(
        ACTIVITIES,
        """SELECT activity_id, created_at, last_modified_at FROM activities
        WHERE created_at >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 2 HOUR
          OR last_modified_at >= TIMESTAMP '2024-01-20 03:00:00' - INTERVAL 2 HOUR""",
    )
    out["i08_sync_state"] = _with(
        CONTACTS + "," + ACTIVITIES,
        """SELECT 'contacts' AS object_type,
          strftime(max(created_at), '%Y-%m-%dT%H:%M:%S.%gZ') AS last_created_at,
          strftime(max(last_modified_at), '%Y-%m-%dT%H:%M:%S.%gZ') AS last_modified_at,
          0 AS records_processed, '2024-01-25T05:00:00+00:00' AS last_sync_at FROM contacts
        UNION ALL SELECT 'activities', strftime(max(created_at), '%Y-%m-%dT%H:%M:%S.%gZ'),
          strftime(max(last_modified_at), '%Y-%m-%dT%H:%M:%S.%gZ'), count(*),
          '2024-01-24T05:00:00+00:00' FROM activities""",
    )

    # sync jobs
    edited, future = "TIMESTAMP '2024-09-01 12:00:00'", "TIMESTAMP '2030-01-01 00:00:00'"
    out["j01_sync_deals"] = _with(
        DEALS,
        f"""SELECT deal_id, CASE WHEN n % 11 = 0 THEN '' WHEN n % 5 = 0 THEN 'edited'
            ELSE deal_name END AS deal_name,
          CASE WHEN n % 5 = 0 THEN {edited} WHEN n % 97 = 1 THEN {future}
            ELSE last_modified_at END AS last_modified_at
        FROM (SELECT *, CAST(deal_id AS BIGINT) AS n FROM deals) WHERE NOT contains(deal_name, 'v2')""",
    )
    out["j02_sync_activities"] = _with(
        ACTIVITY_BASE,
        f"""SELECT CASE event_type WHEN 'signup' THEN 'notes' WHEN 'purchase' THEN 'emails'
            WHEN 'view' THEN 'calls' WHEN 'click' THEN 'communications'
            ELSE CASE WHEN k % 2 = 0 THEN 'meetings' ELSE 'tasks' END END AS object_type,
          CAST(k AS VARCHAR) AS activity_id,
          CASE WHEN k % 5 = 0 THEN {edited} WHEN k % 97 = 1 THEN {future}
            WHEN k % 4 = 0 THEN created_at ELSE last_modified_at END AS last_modified_at
        FROM a1 WHERE k % 97 <> 0
        UNION ALL SELECT 'tasks', CAST(k AS VARCHAR), created_at
        FROM a1 WHERE event_type = 'view' AND k % 10 = 0 AND k % 97 <> 0""",
    )
    out["j03_sync_contacts"] = _with(
        CONTACTS,
        f"""SELECT contact_id, CASE WHEN n % 5 = 0 THEN 'edited' ELSE lastname END AS lastname,
          CASE WHEN n % 5 = 0 THEN {edited} WHEN n % 97 = 1 THEN {future}
            ELSE last_modified_at END AS last_modified_at
        FROM (SELECT *, CAST(contact_id AS BIGINT) AS n FROM contacts)""",
    )
    out["j04_sync_companies"] = _with(
        COMPANIES,
        f"""SELECT company_id, CASE WHEN n % 5 = 0 AND n % 7 <> 0 THEN 'edited' ELSE name END
            AS name,
          CASE WHEN n % 7 = 0 THEN dt WHEN n % 5 = 0 THEN '2024-09-01'
            WHEN n % 97 = 1 THEN '2030-01-01' ELSE dt END AS dt
        FROM (SELECT *, CAST(company_id AS BIGINT) AS n FROM companies)""",
    )
    out["j05_sync_owners"] = """
        SELECT CAST(s_suppkey AS VARCHAR) AS owner_id, CASE WHEN s_suppkey % 2 = 0 THEN 'New'
          WHEN s_suppkey % 4 <> 0 AND s_suppkey % 3 <> 0 THEN 'Ana ' || s_name
          WHEN s_suppkey % 4 <> 0 THEN 'Ana' ELSE 'Unnamed' END AS owner_name
        FROM supplier"""

    # sources and sinks
    out["s01_read_raw_objects"] = _with(
        RAW_DEALS,
        """SELECT deal_id AS id, deal_stage, amount, count(*) AS versions FROM normalized
        GROUP BY ALL""",
    )
    out["s01_read_landed_since"] = _with(
        CONTACTS, "SELECT contact_id AS id, lastname FROM contacts WHERE k % 2 = 0"
    )
    out["s02_read_curated"] = _with(
        ACTIVITIES,
        f"SELECT {SLIM_ACTIVITY} FROM activities WHERE dt BETWEEN '2024-01-08' AND '2024-01-14'",
    )
    out["s03_append_snapshot"] = _with(
        CONTACTS,
        """SELECT day AS dt, count(*) AS rows, count(DISTINCT contact_id) AS contacts
        FROM contacts, (VALUES ('2024-02-01'), ('2024-02-02'), ('2024-02-02')) AS d(day)
        GROUP BY 1""",
    )
    out["s04_overwrite_partitions"] = _with(
        ACTIVITIES,
        """SELECT dt, CASE WHEN dt >= '2024-01-25' THEN 'REPLACED' ELSE activity_type END
          AS activity_type, count(*) AS rows FROM activities GROUP BY 1, 2""",
    )
    out["s05_replace_snapshot"] = _with(OWNERS, "SELECT owner_id, owner_name FROM owners")
    out["s06_stage_snapshot"] = _with(STAGES, "SELECT * FROM stages")
    out["s07_register_table"] = _with(
        ACTIVITIES,
        """SELECT dt, count(*) AS rows, count(DISTINCT owner_id) AS owners,
          count(CASE WHEN dt >= '2024-01-16' THEN 1 END) AS with_region
        FROM activities GROUP BY 1""",
    )
    out["s08_view_layer"] = _with(
        MONTHLY,
        f"""SELECT m.month_start, m.opportunities_created, m.closed_won,
          coalesce(n.deals, 0) AS deals_created
        FROM monthly m LEFT JOIN (SELECT {_month("created_at")} AS mm, count(*) AS deals
          FROM latest GROUP BY 1) n ON n.mm = m.month_start""",
    )

    # dashboard datasets
    out["d01_agg_dataset"] = _with(
        DURATIONS,
        """SELECT owner_name, is_won, CAST(sum(amount) AS DECIMAL(18, 2)) AS amount_sum,
          avg(sales_cycle_days) AS sales_cycle_days_average, min(amount) AS amount_min,
          max(amount) AS amount_max, count(amount) AS amount_count,
          count(DISTINCT sales_cycle_days) AS sales_cycle_days_distinct_count
        FROM durations GROUP BY 1, 2""",
    )
    out["d02_date_granularity"] = _with(
        DURATIONS,
        """SELECT CAST(date_trunc('quarter', created_at) AS TIMESTAMP) AS created_at,
          count(*) AS deals, CAST(sum(amount) AS DECIMAL(18, 2)) AS amount_sum
        FROM durations GROUP BY 1""",
    )
    out["d03_calculated_field"] = _with(
        DURATIONS,
        """SELECT owner_id, CAST(sum(sales_cycle_days - created_to_op_days) AS BIGINT)
            AS days_after_op, CAST(sum(sales_cycle_days) / count(*) AS DECIMAL(18, 6)) AS cycle_share
        FROM durations GROUP BY 1""",
    )
    out["d04_category_filter"] = _with(
        DURATIONS,
        """SELECT deal_id, owner_name FROM durations
        WHERE owner_name IN ('Supplier#000000001', 'Supplier#000000002', '110')
          OR owner_name IS NULL""",
    )
    out["d05_numeric_equality_filter"] = _with(
        DURATIONS, "SELECT deal_id, prep_to_sent_days FROM durations WHERE prep_to_sent_days = 5"
    )
    out["d05_aggregated_filter"] = _with(
        DURATIONS,
        """SELECT owner_name, count(*) AS deals FROM durations
        GROUP BY 1 HAVING sum(CASE WHEN is_won THEN 1 ELSE 0 END) <> 50""",
    )
    out["d06_excluded_period"] = _with(
        DURATIONS,
        """SELECT deal_id, created_at FROM durations
        WHERE strftime(created_at, '%Y-%m') BETWEEN '2020-06' AND '2020-11'""",
    )
    out["d06_time_range_filter"] = _with(
        DURATIONS,
        """SELECT deal_id, closed_won_at FROM durations
        WHERE closed_won_at > TIMESTAMP '2023-06-01' OR closed_won_at IS NULL""",
    )
    out["d07_row_sort"] = _with(
        DURATIONS,
        """SELECT owner_name, count(*) AS deals, CAST(sum(amount) AS DECIMAL(18, 2)) AS amount
        FROM durations GROUP BY 1""",
    )
    out["d08_unaggregated_table"] = _with(
        DURATIONS,
        """SELECT deal_id, owner_name, strftime(created_at, '%d/%m/%Y') AS created_at,
          coalesce(strftime(closed_won_at, '%d/%m/%Y'), 'not won') AS closed_won_at
        FROM durations""",
    )
    out["d09_heat_map"] = _with(
        LATEST,
        """SELECT source, deal_stage, count(*) AS deals,
          CAST(sum(TRY_CAST(amount AS DOUBLE)) AS DECIMAL(18, 2)) AS amount_sum
        FROM latest GROUP BY 1, 2""",
    )
    out["d09_pivot"] = _with(
        LATEST,
        """SELECT source, count(CASE WHEN deal_stage = 'closedwon' THEN 1 END) AS closedwon,
          count(CASE WHEN deal_stage = 'closedlost' THEN 1 END) AS closedlost,
          count(CASE WHEN deal_stage = 'appointmentscheduled' THEN 1 END) AS appointmentscheduled
        FROM latest GROUP BY 1""",
    )
    box = """SELECT {0}, count(amount) AS n,
          CAST(quantile_cont(amount, 0.0) AS DECIMAL(18, 4)) AS minimum,
          CAST(quantile_cont(amount, 0.25) AS DECIMAL(18, 4)) AS first_quartile,
          CAST(quantile_cont(amount, 0.5) AS DECIMAL(18, 4)) AS median,
          CAST(quantile_cont(amount, 0.75) AS DECIMAL(18, 4)) AS third_quartile,
          CAST(quantile_cont(amount, 1.0) AS DECIMAL(18, 4)) AS maximum
        FROM durations WHERE amount IS NOT NULL GROUP BY 1"""
    out["d10_box_plot"] = _with(DURATIONS, box.format("is_won"))
    out["d11_kpi_target"] = _with(
        DURATIONS,
        """SELECT count(*) FILTER (is_won) AS value, count(*) AS target,
          count(*) FILTER (is_won) / count(*) AS progress FROM durations""",
    )
    out["d11_kpi_trend"] = _with(
        DURATIONS,
        """SELECT make_timestamp(year(created_at), 1, 1, 0, 0, 0) AS period,
          count(*) FILTER (is_won) AS value, count(*) AS target,
          count(*) FILTER (is_won) / count(*) AS progress FROM durations
        GROUP BY year(created_at)""",
    )
    out["d12_quartile_band"] = _with(
        DURATIONS,
        """, totals AS (SELECT owner_name, count(*) AS deals, sum(sales_cycle_days) AS days
          FROM durations GROUP BY 1),
        cuts AS (SELECT quantile_cont(days, 0.25) AS low, quantile_cont(days, 0.75) AS high
          FROM totals)
        SELECT owner_name, deals, CAST(days AS BIGINT) AS days, CASE WHEN days > high
          THEN 'TOP_25_PERCENT' WHEN days < low THEN 'BOTTOM_25_PERCENT'
          WHEN days IS NOT NULL THEN 'MIDDLE' END AS band
        FROM totals, cuts""",
    )
    out["d13_hierarchy_rollup"] = _with(
        LATEST,
        """SELECT deal_stage, source, count(*) AS deals,
          CAST(2 - grouping(deal_stage) - grouping(source) AS INT) AS level
        FROM latest GROUP BY ROLLUP (deal_stage, source)""",
    )
    out["d14_scatter_points"] = _with(
        DURATIONS,
        """SELECT owner_name, count(*) AS x, avg(sales_cycle_days) AS y FROM durations GROUP BY 1""",
    )
    out["d14_raw_points"] = _with(
        DURATIONS,
        """SELECT deal_id, sales_cycle_days AS x, CAST(amount AS DECIMAL(18, 2)) AS y
        FROM durations""",
    )
    out["d01_percentile_measure"] = _with(
        DURATIONS,
        """SELECT is_won, CAST(quantile_cont(amount, 0.9) AS DECIMAL(18, 4)) AS amount_p90,
          count(*) AS deals,
          CAST(quantile_cont(CAST(sales_cycle_days AS DOUBLE), 0.5) AS DECIMAL(18, 4))
            AS median_days
        FROM durations GROUP BY 1""",
    )
    out["d05_percentile_filter"] = _with(
        DURATIONS,
        """SELECT owner_name, count(*) AS deals FROM durations GROUP BY 1
        HAVING quantile_cont(CAST(created_to_op_days AS DOUBLE), 0.5) = 3""",
    )
    out["d04_single_value"] = _with(
        DURATIONS,
        "SELECT deal_id, owner_name FROM durations WHERE contains(owner_name, '00001')",
    )
    out["d09_open_pivot"] = _with(
        LATEST,
        """SELECT deal_stage, count(*) FILTER (k % 10 < 5) AS half,
          count(*) FILTER (k % 10 BETWEEN 5 AND 7) AS third,
          count(*) FILTER (k % 10 > 7 AND k % 40 <> 9) AS other,
          count(*) FILTER (k % 40 = 9) AS none, count(*) AS total
        FROM (SELECT *, CAST(deal_id AS BIGINT) AS k FROM latest) GROUP BY 1""",
    )
    # Only deals whose number is divisible by five have a later amount.
    out["j06_monthly_kpis_kept_up"] = out["v05_deal_kpis_monthly"].replace(
        "sum(amount)", "sum(CASE WHEN CAST(deal_id AS BIGINT) % 5 = 0 THEN 77.5 ELSE amount END)"
    )
    out["v13_shifted_months"] = out["v13_deal_cohort_closing_rates_transposed"].replace(
        COHORT_MONTHS, COHORT_MONTHS.replace("- INTERVAL 3 HOUR", "+ INTERVAL 3 HOUR")
    )
    for number, name in (
        ("v09", "deal_kpis_weekly_last3_by_owner"),
        ("v12", "deal_cohort_closing_rates_by_owner"),
        ("v17", "activity_volume_by_owner_type_last3weeks_v3"),
    ):
        out[f"{number}_narrow_first"] = out[f"{number}_{name}"]
    return out
