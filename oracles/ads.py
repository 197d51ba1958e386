"""Oracles of the ads report, the spend/lead/order report and the charts."""

from oracles.sql import cnt, delta, div, lsum, msum, rnd, with_

K = "CAST(json_extract_string(props, '$.k') AS INT)"

ADS = f"""
ads AS (SELECT event_id, CAST(ts AS DATE) AS date, 'src' || (user_id % 4) AS source, 'c' || ({K} % 8) AS campaign,
    event_type, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS impressions,
    CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clicks,
    CASE WHEN event_type = 'click' THEN value ELSE 0 END AS cost,
    CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS leads,
    CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS orders,
    CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS revenue
    FROM events WHERE event_type IN ('signup', 'purchase', 'view', 'click'))
"""
DAY, BEFORE = "DATE '2024-01-15'", "DATE '2024-01-14'"

SUMS = (
    f"{lsum('impressions')} AS impressions, {lsum('clicks')} AS clicks, {lsum('leads')} AS leads, "
    f"{lsum('orders')} AS orders, {msum('cost')} AS cost, {msum('revenue')} AS revenue"
)
RATIOS = (
    f"{div('clicks', 'impressions', 4, '0.0', '100.0')} AS ctr, {div('cost', 'clicks', 4, '0.0')} AS cpc, "
    f"{div('cost', 'leads', 4, '0.0')} AS cpl, {div('cost', 'orders', 4, '0.0')} AS cpa, "
    f"{div('leads', 'clicks', 4, '0.0', '100.0')} AS lead_cr, {div('orders', 'leads', 4, '0.0', '100.0')} AS order_cr, "
    f"{div('revenue', 'cost', 4, '0.0')} AS roas"
)
CAMPAIGNS = f"""
by_campaign AS (SELECT *, {RATIOS} FROM (SELECT source, campaign, {SUMS} FROM ads WHERE date = {DAY} GROUP BY 1, 2)),
bad AS (SELECT * FROM by_campaign WHERE (orders = 0 AND cost >= 100) OR (orders > 0 AND cost / nullif(orders, 0) > 60)
    OR (revenue / nullif(cost, 0) < 1.0 AND cost >= 100))
"""


def _days() -> str:
    inner = []
    for prefix, day in (("cur", DAY), ("prev", BEFORE)):
        on = f"date = {day}"
        inner += [f"{msum(c, on)} AS {prefix}_{c}" for c in ("cost", "revenue")]
        inner += [f"{lsum(c, on)} AS {prefix}_{c}" for c in ("leads", "orders")]
    outer = []
    for p in ("cur", "prev"):
        outer += [
            f"{div(f'{p}_cost', f'{p}_leads', None, '0.0')} AS {p}_cpl",
            f"{div(f'{p}_cost', f'{p}_orders', None, '0.0')} AS {p}_cpa",
            f"{div(f'{p}_revenue', f'{p}_cost', None, '0.0')} AS {p}_roas",
        ]
    return f"days AS (SELECT *, {', '.join(outer)} FROM (SELECT {', '.join(inner)} FROM ads))"


KPIS = {
    "spend": ("cost", False, "Расход"),
    "leads": ("leads", True, "Заявки"),
    "cpl": ("cpl", False, "CPL"),
    "cpa": ("cpa", False, "CPA"),
    "roas": ("roas", True, "ROAS"),
    "revenue": ("revenue", True, "Выручка"),
}


def _kpis() -> str:
    rows = " UNION ALL ".join(
        f"SELECT {i} AS position, '{k}' AS kpi, '{title}' AS title, CAST(cur_{c} AS DOUBLE) AS v, "
        f"CAST(prev_{c} AS DOUBLE) AS p, {str(better).lower()} AS better FROM days"
        for i, (k, (c, better, title)) in enumerate(KPIS.items(), start=1)
    )
    return with_(ADS, _days(), f"k AS (SELECT *, {delta('v', 'p')} AS d FROM ({rows}))")


AD_ALERTS = {
    "leads_down": (f"{delta('cur_leads', 'prev_leads')} <= -15", "'Количество заявок снизилось больше чем на 15% к предыдущему дню'"),
    "cpl_up": (f"{delta('cur_cpl', 'prev_cpl')} >= 20", "'CPL вырос больше чем на 20%'"),
    "cpa_up": (f"{delta('cur_cpa', 'prev_cpa')} >= 20", "'CPA вырос больше чем на 20%'"),
    "roas_low": ("cur_roas < 1.0", "'ROAS ниже целевого значения 1.0x'"),
    "roas_down": (f"{delta('cur_roas', 'prev_roas')} <= -20", "'ROAS просел больше чем на 20%'"),
    "bad_campaigns": (
        "(SELECT count(*) FROM bad) > 0",
        "'Найдено кампаний с риском слива бюджета: ' || (SELECT count(*) FROM bad)",
    ),
}


def _alerts() -> str:
    rows = " UNION ALL ".join(
        f"SELECT {i} AS position, '{code}' AS code, {text} AS message FROM days WHERE {condition}"
        for i, (code, (condition, text)) in enumerate(AD_ALERTS.items(), start=1)
    )
    return with_(ADS, CAMPAIGNS, _days(), f"found AS ({rows})") + """
SELECT * FROM found
UNION ALL SELECT 0, 'none', 'Критичных отклонений не найдено' WHERE NOT EXISTS (SELECT 1 FROM found)
"""


def _positive(num: str, den: str, digits: int) -> str:
    return f"CASE WHEN {den} > 0 THEN {div(num, den, digits)} ELSE 0.0 END"


AD_SALES = f"""
spend AS (SELECT date, source AS channel, campaign, {lsum("impressions")} AS impressions, {lsum("clicks")} AS clicks,
    {msum("cost")} AS cost FROM ads WHERE event_type IN ('view', 'click') GROUP BY 1, 2, 3),
lead_rows AS (SELECT event_id, CAST(ts AS DATE) AS date, 'src' || (user_id % 4) AS channel, 'c' || ({K} % 8) AS campaign,
    event_id % 3 = 0 AS won, CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS VARCHAR) ELSE '' END AS order_id
    FROM events WHERE event_type = 'signup'),
paid AS (SELECT CAST(event_id AS VARCHAR) AS order_id, value * 10 AS revenue, value * 10 * CAST(0.3 AS DOUBLE) AS gross_profit
    FROM events WHERE event_id % 3 = 0),
gained AS (SELECT date, channel, campaign, count(DISTINCT event_id) AS leads, {cnt("won")} AS sales,
    {msum("revenue")} AS revenue, {msum("gross_profit")} AS gross_profit
    FROM lead_rows LEFT JOIN paid USING (order_id) GROUP BY 1, 2, 3),
both_sides AS (SELECT date, channel, campaign, coalesce(impressions, 0) AS impressions, coalesce(clicks, 0) AS clicks,
    coalesce(cost, 0) AS cost, coalesce(leads, 0) AS leads, coalesce(sales, 0) AS sales, coalesce(revenue, 0) AS revenue,
    coalesce(gross_profit, 0) AS gross_profit FROM spend FULL JOIN gained USING (date, channel, campaign)),
report AS (SELECT *, {_positive("clicks", "impressions", 4)} AS ctr, {_positive("cost", "leads", 4)} AS cpl,
    {_positive("cost", "sales", 4)} AS cpo, {_positive("sales", "leads", 4)} AS cr_lead_to_sale,
    {_positive("gross_profit - cost", "cost", 4)} AS romi FROM both_sides),
summary AS (SELECT *, {_positive("cost", "leads", 2)} AS cpl, {_positive("gross_profit - cost", "cost", 3)} AS romi FROM (
    SELECT channel, {msum("cost")} AS cost, {lsum("leads")} AS leads, {lsum("sales")} AS sales, {msum("revenue")} AS revenue,
        {msum("gross_profit")} AS gross_profit FROM report GROUP BY 1))
"""

CHART = """
chart AS (SELECT date, impressions AS visits, orders, revenue, leads AS installs,
    CASE WHEN orders = 1 THEN 1 + event_id % 3 ELSE 0 END AS units,
    CASE WHEN orders = 1 AND event_id % 2 = 0 THEN 1 + event_id % 3 ELSE 0 END AS paid_units FROM ads)
"""
CHART_METRICS = {
    "visits": "CAST(sum(visits) AS DOUBLE)",
    "orders": "CAST(sum(orders) AS DOUBLE)",
    "revenue": msum("revenue"),
    "units": "CAST(sum(units) AS DOUBLE)",
    "installs": "CAST(sum(installs) AS DOUBLE)",
    "buyout_rate": div("sum(paid_units)", "sum(units)", 4),
}


def _metrics(grain: str) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST(date_trunc('{grain}', date) AS DATE) AS period, '{name}' AS metric, {expression} AS value FROM chart GROUP BY 1"
        for name, expression in CHART_METRICS.items()
    )


PLAN_FACT = f"""
facts AS (SELECT CASE WHEN source = 'src0' THEN CASE WHEN campaign IN ('c1', 'c3') THEN 'src0 brand' ELSE 'src0 non-brand' END
        ELSE source END AS channel, {msum("cost")} * CAST(1.2 AS DOUBLE) AS budget_fact, {msum("revenue")} AS revenue_fact
    FROM ads WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-15' GROUP BY 1),
numbers AS (SELECT DISTINCT user_id % 4 AS n FROM events),
plans AS (SELECT 'src' || n AS channel, (100 + 10 * n) * 8.0 AS budget_plan, (300 + 50 * n) * 8.0 AS revenue_plan
    FROM (SELECT n FROM numbers UNION ALL SELECT max(n) + 1 FROM numbers)),
rows_ AS (SELECT * FROM plans FULL JOIN facts USING (channel)),
summed AS (SELECT channel, CAST(0 AS TINYINT) AS is_total, {msum("budget_plan")} AS budget_plan, {msum("budget_fact")} AS budget_fact,
    {msum("revenue_plan")} AS revenue_plan, {msum("revenue_fact")} AS revenue_fact FROM rows_ GROUP BY channel
    UNION ALL SELECT 'Total', 1, {msum("budget_plan")}, {msum("budget_fact")}, {msum("revenue_plan")}, {msum("revenue_fact")} FROM rows_)
"""


def oracles() -> dict[str, str]:
    d1 = "format('{:.1f}', d)"
    number = "replace(format('{:,.0f}', v), ',', ' ')"
    return {
        "ad_events_mart": with_(ADS) + f"""
SELECT *, {div("clicks", "impressions", 2, None, "100.0")} AS ctr, {div("cost", "clicks", 2)} AS cpc, {div("cost", "leads", 2)} AS cpl,
    {div("cost", "orders", 2)} AS cpa, {div("revenue", "cost", 2)} AS roas
FROM (SELECT date AS report_date, source, campaign, {SUMS} FROM ads WHERE date IN ({DAY}, {BEFORE}) GROUP BY 1, 2, 3)
""",
        "ad_daily_kpis": _kpis() + f"""
SELECT position, kpi, {rnd("v", 4)} AS value, {rnd("p", 4)} AS prev_value, {rnd("d", 4)} AS delta_pct,
    d = 0 OR (CASE WHEN better THEN d > 0 ELSE d < 0 END) AS is_good FROM k
""",
        "kpi_labels": _kpis() + f"""
SELECT *, title || ': ' || label || ' (' || delta_label || ' к прошлому дню)' AS message_line FROM (
    SELECT position, title, CASE kpi WHEN 'leads' THEN {number} WHEN 'roas' THEN format('{{:.2f}}', v) || 'x' ELSE {number} || ' ₽' END AS label,
        CASE WHEN p = 0 AND v = 0 THEN '0%' WHEN p = 0 THEN '+100%' ELSE (CASE WHEN d > 0 THEN '+' ELSE '' END) || {d1} || '%' END AS delta_label
    FROM k)
""",
        "ad_by_source": with_(ADS) + f"SELECT *, {RATIOS} FROM (SELECT source, {SUMS} FROM ads WHERE date = {DAY} GROUP BY 1)",
        "ad_by_campaign": with_(ADS, CAMPAIGNS) + "SELECT * FROM by_campaign",
        "ad_bad_campaigns": with_(ADS, CAMPAIGNS) + "SELECT * FROM bad",
        "top_campaigns": with_(ADS, CAMPAIGNS) + "SELECT * FROM by_campaign ORDER BY cost DESC, source, campaign LIMIT 8",
        "ad_alerts": _alerts(),
        "ad_sales_report": with_(ADS, AD_SALES) + "SELECT * FROM report",
        "ad_channel_summary": with_(ADS, AD_SALES) + "SELECT * FROM summary",
        "ad_channel_messages": with_(ADS, AD_SALES) + """
SELECT channel, '• ' || channel || ': ' || replace(format('{:,.0f}', cost), ',', ' ') || ' ₽  лиды ' || leads || '  продажи ' || sales
    || '  ROMI ' || format('{:.1f}', romi * 100) || '%' AS message FROM summary
""",
        "source_date_slice": f"""
SELECT CAST(event_id AS VARCHAR) AS lead_id, ts AS created_at, 'src' || (user_id % 4) AS channel, 'c' || ({K} % 8) AS campaign,
    CASE WHEN event_id % 3 = 0 THEN 'won' ELSE 'new' END AS status,
    CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS VARCHAR) ELSE '' END AS order_id
FROM events WHERE event_type = 'signup' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-09' AND DATE '2024-01-15'
""",
        "metric_by_period": with_(ADS, CHART) + _metrics("week"),
        "metric_revenue_by_month": with_(ADS, CHART) + f"""
SELECT CAST(date_trunc('month', date) AS DATE) AS period, {msum("revenue")} AS value FROM chart GROUP BY 1
""",
        "metric_visits_dynamics": with_(ADS, CHART, f"m AS ({_metrics('week')})") + f"""
SELECT period, {rnd(delta("value", "prev_value"), 4)} AS value FROM (
    SELECT *, lag(value) OVER (ORDER BY period) AS prev_value FROM m WHERE metric = 'visits')
""",
        "metric_dynamics": with_(ADS, CHART, f"m AS ({_metrics('day')})") + f"""
SELECT *, {rnd(delta("value", "prev_value"), 4)} AS dynamics_pct FROM (
    SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY period) AS prev_value FROM m)
""",
        "plan_fact": with_(ADS, PLAN_FACT) + f"""
SELECT *, {div("budget_plan", "revenue_plan", 4)} AS drr_plan, {div("budget_fact", "revenue_fact", 4)} AS drr_fact FROM summed
""",
    }
