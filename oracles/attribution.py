"""Oracles of the attribution dataset and the CPA segments."""

from oracles.sql import lsum, msum, with_

INPUTS = """
signups AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) % 6 AS k FROM events
    WHERE event_type = 'signup' AND user_id % 5 <> 0),
installs AS (SELECT DISTINCT ts AS install_time, CAST(user_id AS VARCHAR) AS installation_id, 'dev' || user_id AS appmetrica_device_id,
    CASE k WHEN 0 THEN 'Scaleio Network' WHEN 1 THEN 'Perfluence' WHEN 2 THEN 'Unknown (source: Advertisement Engine)' ELSE 'Organic' END AS partner,
    CASE k WHEN 0 THEN 'Scaleo_main' WHEN 1 THEN 'perfluence_app' ELSE 'tracker' || k END AS tracker,
    CASE k WHEN 0 THEN 'source=scaleo' WHEN 1 THEN '' WHEN 2 THEN 'utm=scaleo&type=cpa' WHEN 3 THEN 'source=admitad'
        WHEN 4 THEN 'source=advcake' ELSE 'source=cityads' END AS parameter,
    CASE WHEN user_id % 2 = 0 THEN 'ios' ELSE 'android' END AS os FROM signups),
raw_purchases AS (SELECT ts AS event_time, CAST(user_id AS VARCHAR) AS installation_id, 'dev' || user_id AS buyer,
    CAST(event_id // 3 AS VARCHAR) AS ecom_order_id FROM events WHERE event_type = 'purchase'),
crm AS (SELECT CAST(o_orderkey AS VARCHAR) AS increment_id, CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'O' THEN 'processing' ELSE 'canceled' END AS status,
    o_totalprice AS sum_zakaza, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS sum_oplaty,
    CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE 0 END AS sum_vozvrata, CAST(1 + o_orderkey % 5 AS INT) AS aty_sku_zakaza,
    CASE WHEN o_orderstatus = 'F' THEN CAST(1 + o_orderkey % 5 AS INT) ELSE 0 END AS aty_sku_oplaty,
    CAST(o_custkey % 4 = 0 AS INT) AS customer_is_new, TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 45 AS INT)) AS created_at_msk FROM orders),
both_orders AS (SELECT CAST(o_orderkey AS VARCHAR) AS purchase_id, CASE WHEN o_orderkey % 9 = 0 THEN 'web' ELSE 'app' END AS web_flag
    FROM orders WHERE o_orderkey % 9 < 2),
links AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CASE WHEN o_orderkey % 2 = 0 THEN 'Perfluence' ELSE 'Direct' END AS publisher_name,
    CASE WHEN o_orderkey % 2 = 0 THEN 'w2a_perfluence' ELSE 'w2a_banner' END AS tracker_name,
    CASE WHEN o_orderkey % 2 = 0 THEN 'source=perfluence' ELSE 'source=admitad' END AS url_params FROM orders WHERE o_orderkey % 7 = 0)
"""

PURCHASES = """
purchases AS (SELECT DISTINCT event_time, installation_id, buyer, ecom_order_id
    FROM raw_purchases LEFT JOIN both_orders ON ecom_order_id = purchase_id WHERE coalesce(web_flag, '') <> 'web')
"""


def _valued(match: str) -> str:
    month = {
        "month": "month(event_time) = month(created_at_msk + INTERVAL 3 HOUR)",
        "year_month": "date_trunc('month', event_time) = date_trunc('month', created_at_msk + INTERVAL 3 HOUR)",
    }[match]
    return f"""
valued AS (SELECT DISTINCT event_time, installation_id, buyer, ecom_order_id, sum_zakaza AS revenue,
    CASE WHEN status LIKE '%compl%' THEN 1 END AS completed_purchases, sum_oplaty AS completed_revenue, sum_vozvrata,
    aty_sku_zakaza, aty_sku_oplaty, CASE WHEN customer_is_new = 1 THEN 1 END AS customer_is_new,
    CASE WHEN customer_is_new = 1 THEN sum_zakaza END AS gmv_new,
    CASE WHEN customer_is_new = 1 AND status LIKE '%compl%' THEN sum_oplaty END AS revenue_ecomm_new,
    CASE WHEN customer_is_new = 1 AND sum_oplaty IS NOT NULL THEN 1 END AS purchases_new
    FROM purchases LEFT JOIN crm ON ecom_order_id = increment_id AND {month})
"""


def _dedup(keep: str) -> str:
    return f"""
numbered AS (SELECT v.*, install_time, appmetrica_device_id, partner, tracker, parameter, os, row_number() OVER (PARTITION BY ecom_order_id
    ORDER BY install_time NULLS FIRST, event_time, v.installation_id, buyer, partner NULLS FIRST, tracker NULLS FIRST, parameter NULLS FIRST,
        os NULLS FIRST, revenue NULLS FIRST) AS num
    FROM valued v LEFT JOIN installs i ON v.installation_id = i.installation_id),
dedup AS (SELECT *, CASE WHEN num = 1 THEN 1 END AS purchases, CASE WHEN install_time IS NOT NULL THEN 1 END AS installs,
    CASE WHEN install_time IS NOT NULL AND num = 1 THEN date_diff('day', install_time, event_time) END AS day_diff
    FROM numbered WHERE {keep}),
dataset AS (SELECT * EXCLUDE (partner, tracker, parameter, num, order_id, publisher_name, tracker_name, url_params),
    CASE WHEN order_id IS NOT NULL THEN publisher_name ELSE partner END AS partner,
    CASE WHEN order_id IS NOT NULL THEN tracker_name ELSE tracker END AS tracker,
    CASE WHEN order_id IS NOT NULL THEN url_params ELSE parameter END AS parameter,
    CASE WHEN order_id IS NOT NULL THEN 'w2a' END AS flag
    FROM dedup LEFT JOIN links ON ecom_order_id = order_id)
"""


NETWORK = {
    "scaleo": "lower(tracker) LIKE '%scaleo%' OR parameter LIKE '%source=scaleo%'",
    "perfluence": "lower(tracker) LIKE '%perfluence%' OR parameter LIKE '%source=perfluence%'",
    "admitad": "parameter LIKE '%source=admitad%'",
    "advcake": "parameter LIKE '%source=advcake%'",
    "cityads": "parameter LIKE '%source=cityads%'",
}


def _source() -> str:
    cases = [f"WHEN {condition} THEN '{name}' || w" for name, condition in NETWORK.items()]
    cases.insert(2, "WHEN partner LIKE '%Unknown (source: Advertisement Engine)%' THEN 'scaleo_w2a'")
    return "CASE " + " ".join(cases) + " END"


def oracles() -> dict[str, str]:
    sql_rule, strict_rule = "num <> 2", "num = 1"
    amounts = ("revenue", "completed_revenue", "sum_vozvrata", "gmv_new", "revenue_ecomm_new")
    counts = ("installs", "purchases", "completed_purchases", "aty_sku_zakaza", "aty_sku_oplaty", "customer_is_new", "purchases_new")
    sums = ", ".join([f"{lsum(c)} AS {c}" for c in counts] + [f"{msum(c)} AS {c}" for c in amounts])
    networks = " OR ".join(f"parameter LIKE '%source={n}%'" for n in NETWORK)
    return {
        "semi_join_known_orders": with_(INPUTS) + "SELECT * FROM crm WHERE increment_id IN (SELECT ecom_order_id FROM raw_purchases)",
        "attribution_installs": with_(INPUTS) + "SELECT * FROM installs",
        "attribution_purchases": with_(INPUTS, PURCHASES) + "SELECT * FROM purchases",
        "attribution_purchase_crm": with_(INPUTS, PURCHASES, _valued("month")) + "SELECT * FROM valued",
        "attribution_dedup": with_(INPUTS, PURCHASES, _valued("month"), _dedup(sql_rule)) + "SELECT * FROM dedup",
        "attribution_dataset": with_(INPUTS, PURCHASES, _valued("month"), _dedup(sql_rule))
        + "SELECT * FROM dataset WHERE CAST(event_time AS DATE) BETWEEN DATE '2024-01-07' AND DATE '2024-01-14'",
        "attribution_strict": with_(INPUTS, PURCHASES, _valued("year_month"), _dedup(strict_rule)) + "SELECT * FROM dataset",
        "cpa_segments": with_(INPUTS, PURCHASES, _valued("month"), _dedup(sql_rule)) + f"""
SELECT CAST(event_time AS DATE) AS date, 'app' AS traffic_type, 'PAID.CPA' AS chanel, tracker AS utm_campaign, {_source()} AS utm_source,
    '' AS campaign_id, CASE os WHEN 'ios' THEN 'ios' WHEN 'android' THEN 'aos' END AS os, 'ua' AS campaign,
    0 AS impressions, 0 AS clicks, {sums}, count(DISTINCT appmetrica_device_id) AS users
FROM (SELECT * REPLACE (coalesce(partner, '') AS partner, coalesce(parameter, '') AS parameter),
        CASE WHEN flag IS NULL THEN '' ELSE '_w2a' END AS w FROM dataset)
WHERE (partner LIKE '%Scaleio%' OR partner LIKE '%Perfluence%' OR (partner LIKE '%Unknown (source: Advertisement Engine)%'
        AND parameter LIKE '%scaleo%' AND parameter LIKE '%=cpa%') OR {networks})
    AND ((day_diff <= 30 AND coalesce(flag, '') <> 'w2a') OR flag = 'w2a')
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8
""",
    }
