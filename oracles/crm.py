"""Oracles of the CRM control."""

from oracles.sql import cnt, msum, with_

DAY = "DATE '1998-06-30'"
END = "TIMESTAMP '1998-06-30 23:59:59'"

FLAGS = f"""
requests AS (SELECT o_orderkey AS request_id, o_orderdate AS created_at,
    o_orderdate + to_days(CAST(o_orderkey % 7 AS INT)) AS status_updated_at,
    CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate + to_days(CAST(o_orderkey % 5 AS INT)) END AS next_action_due_at,
    o_orderdate + to_days(10) AS close_due_at, o_orderstatus AS status, o_orderpriority AS priority, 's' || (o_orderkey % 6) AS source,
    CASE WHEN o_custkey % 13 = 0 THEN '' ELSE 'm' || (o_custkey % 40) END AS manager, 'client ' || o_custkey AS client,
    o_totalprice AS amount FROM orders),
opened AS (SELECT *, status NOT IN ('F') AS is_open, priority IN ('1-URGENT', '2-HIGH') AS is_high_priority FROM requests),
flags AS (SELECT *, CAST(created_at AS DATE) = {DAY} AS is_new_today,
    is_open AND coalesce(next_action_due_at <= {END}, false) AS is_overdue_action,
    is_open AND close_due_at <= {END} AS is_overdue_close, is_open AND manager = '' AS is_without_manager,
    is_open AND status_updated_at < TIMESTAMP '1998-06-27' AS is_stale, amount >= 150000 AS is_large_amount,
    is_open AND coalesce(next_action_due_at <= {END}, false) AND is_high_priority AS is_hot_overdue,
    greatest(date_diff('day', CAST(status_updated_at AS DATE), {DAY}), 0) AS days_without_update FROM opened),
scored AS (SELECT *, 3 * CAST(is_overdue_action AS INT) + 2 * CAST(is_overdue_close AS INT) + 2 * CAST(is_without_manager AS INT)
    + 2 * CAST(is_stale AS INT) + CAST(is_high_priority AS INT) + CAST(is_large_amount AS INT) AS risk_score FROM flags),
problems AS (SELECT * FROM scored WHERE is_overdue_action OR is_overdue_close OR is_without_manager OR is_stale)
"""

CASES = """
cases AS (SELECT request_id, client, source, CASE WHEN manager = '' THEN 'Не назначен' ELSE manager END AS manager, status, priority, amount,
    next_action_due_at, close_due_at, days_without_update, risk_score, concat_ws('; ',
        CASE WHEN is_overdue_action THEN 'просрочено следующее действие' END,
        CASE WHEN is_overdue_close THEN 'просрочен дедлайн закрытия' END,
        CASE WHEN is_without_manager THEN 'нет ответственного' END,
        CASE WHEN is_stale THEN 'статус давно не менялся' END,
        CASE WHEN is_hot_overdue THEN 'высокий приоритет' END) AS problem FROM problems)
"""

METRICS = f"""
m AS (SELECT {cnt("is_open")} AS total_open, {cnt("is_new_today")} AS new_today, {cnt("is_overdue_action")} AS overdue_action,
    {cnt("is_overdue_close")} AS overdue_close, {cnt("is_without_manager")} AS without_manager, {cnt("is_stale")} AS stale,
    {cnt("is_hot_overdue")} AS hot_overdue, (SELECT count(*) FROM problems) AS problem_cases,
    CAST(floor({msum("amount", "is_overdue_action OR is_overdue_close")}) AS BIGINT) AS risk_amount FROM scored)
"""
NAMES = (
    "total_open", "new_today", "overdue_action", "overdue_close", "without_manager", "stale", "hot_overdue",
    "problem_cases", "risk_amount",
)
# The first that holds names the problem.
DETAIL_REASONS = (
    ("is_overdue_action AND priority = '1-URGENT'", "Критично: просрочено действие по горячей заявке"),
    ("is_overdue_action", "Просрочено следующее действие"),
    ("is_overdue_close", "Просрочен дедлайн закрытия"),
    ("is_without_manager", "Нет ответственного"),
    ("is_stale", "Заявка зависла в статусе"),
)
ALERTS = {
    "hot_overdue": "'Высокоприоритетных просрочек: ' || hot_overdue",
    "without_manager": "'Заявок без ответственного: ' || without_manager",
    "stale": "'Зависших заявок без движения: ' || stale",
    "risk_amount": "'Сумма в зоне риска: ' || replace(format('{:,}', risk_amount), ',', ' ') || ' ₽'",
}


def oracles() -> dict[str, str]:
    metrics = " UNION ALL ".join(f"SELECT '{n}' AS metric, {n} AS value FROM m" for n in NAMES)
    alerts = " UNION ALL ".join(
        f"SELECT {i} AS position, '{n}' AS code, {text} AS message FROM m WHERE {n} > 0"
        for i, (n, text) in enumerate(ALERTS.items(), start=1)
    )
    return {
        "crm_flags": with_(FLAGS) + "SELECT * FROM scored",
        "crm_problem_cases": with_(FLAGS, CASES) + "SELECT * FROM cases",
        "crm_top_cases": with_(FLAGS, CASES) + """
SELECT * FROM cases ORDER BY risk_score DESC, amount DESC NULLS LAST, next_action_due_at ASC NULLS LAST, request_id LIMIT 12
""",
        "crm_metrics": with_(FLAGS, METRICS) + metrics,
        "crm_by_manager": with_(FLAGS) + f"""
SELECT CASE WHEN manager = '' THEN 'Не назначен' ELSE manager END AS manager, count(*) AS open_requests,
    {cnt("is_overdue_action")} AS overdue_action, {cnt("is_overdue_close")} AS overdue_close, {cnt("is_stale")} AS stale,
    {msum("amount")} AS risk_amount FROM scored WHERE is_open GROUP BY 1
""",
        "crm_by_manager_sql": with_(FLAGS) + f"""
SELECT manager, {cnt("is_open")} AS open_requests, {cnt("is_overdue_action")} AS overdue_actions, {cnt("is_overdue_close")} AS overdue_closings,
    {cnt("is_without_manager")} AS without_manager, {cnt("is_stale")} AS stale_requests,
    {msum("amount", "is_overdue_action OR is_overdue_close OR is_stale")} AS amount_in_risk
FROM scored WHERE created_at <= {END} GROUP BY 1
""",
        "crm_problem_detail": with_(FLAGS) + f"""
SELECT * EXCLUDE (status_updated_at, reasons), date_diff('day', CAST(status_updated_at AS DATE), {DAY}) AS days_without_update,
    [r.said FOR r IN reasons IF r.holds][1] AS problem
FROM (SELECT request_id, client, source, coalesce(nullif(manager, ''), 'Не назначен') AS manager, status, priority, amount, next_action_due_at,
        close_due_at, status_updated_at, [{', '.join(f"{{'holds': {flag}, 'said': '{said}'}}" for flag, said in DETAIL_REASONS)}] AS reasons
      FROM problems)
""",
        "crm_overdue_trend": with_(FLAGS) + f"""
SELECT CAST(d AS DATE) AS date, (SELECT count(*) FROM scored WHERE is_open AND created_at <= d + INTERVAL 1 DAY - INTERVAL 1 SECOND
    AND next_action_due_at <= d + INTERVAL 1 DAY - INTERVAL 1 SECOND) AS overdue
FROM (SELECT unnest(generate_series(TIMESTAMP '1998-06-24', TIMESTAMP '1998-06-30', INTERVAL 1 DAY)) AS d)
""",
        "crm_alerts": with_(FLAGS, METRICS, f"found AS ({alerts})") + """
SELECT * FROM found UNION ALL SELECT 0, 'none', 'Критичных просрочек не найдено' WHERE NOT EXISTS (SELECT 1 FROM found)
""",
    }
