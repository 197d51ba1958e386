"""Oracles of the marketplace stock control."""

from oracles.sql import cnt, div, lsum, msum, rnd, with_

MARKETS = ("market-a", "market-b", "market-c")

STOCK = "stock AS (" + " UNION ALL ".join(
    f"""SELECT '{m}' AS marketplace, 'sku-' || p_partkey AS sku, 'wh{i}' AS warehouse, CAST(p_size AS BIGINT) AS stock,
    CAST((p_partkey + {i}) % 5 AS BIGINT) AS reserved, p_retailprice AS price,
    (10 + p_partkey % 10) / 100.0::DOUBLE AS commission_rate,
    CASE WHEN p_partkey % 20 = 0 THEN 'paused' ELSE 'active' END AS status FROM part"""
    for i, m in enumerate(MARKETS)
) + ")"

REPORT = f"""
products AS (SELECT 'sku-' || p_partkey AS sku, p_name AS product_name, p_type AS category,
    p_retailprice * (60 + p_partkey % 25) / 100.0::DOUBLE AS cost_price
    FROM part),
sold AS (SELECT CASE l_suppkey % 3 WHEN 0 THEN 'market-a' WHEN 1 THEN 'market-b' ELSE 'market-c' END AS marketplace,
    'sku-' || l_partkey AS sku, count(*) AS orders_3d, {msum("l_extendedprice")} AS revenue_3d
    FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1998-06-28' AND DATE '1998-06-30' GROUP BY 1, 2),
base AS (SELECT s.* EXCLUDE (status), s.status, product_name, category, cost_price, stock - reserved AS available_stock,
    price * commission_rate AS commission, coalesce(orders_3d, 0) AS orders_3d, coalesce(revenue_3d, 0) AS revenue_3d
    FROM stock s LEFT JOIN products USING (sku) LEFT JOIN sold USING (marketplace, sku)),
priced AS (SELECT *, {rnd("price - commission - cost_price", 2)} AS unit_margin, {div("orders_3d", "3", 2)} AS daily_sales_avg FROM base),
ready AS (SELECT *, {div("unit_margin", "price", 4)} AS gross_margin_rate,
    {div("available_stock", "daily_sales_avg", 1, "999.0")} AS days_of_stock FROM priced),
report AS (SELECT marketplace, sku, product_name, category, warehouse, stock, reserved, available_stock, CAST(price AS DOUBLE) AS price,
    CAST(commission_rate AS DOUBLE) AS commission_rate, CAST(commission AS DOUBLE) AS commission_amount,
    CAST(price - commission AS DOUBLE) AS net_price, CAST(cost_price AS DOUBLE) AS cost_price,
    CAST(unit_margin AS DOUBLE) AS gross_margin_per_unit, gross_margin_rate, orders_3d, revenue_3d, daily_sales_avg, days_of_stock, status,
    CASE WHEN available_stock <= 0 THEN 'out_of_stock' WHEN available_stock <= 5 OR days_of_stock <= 3 THEN 'reorder'
         WHEN gross_margin_rate < 0.15 THEN 'low_margin' ELSE 'ok' END AS alert, TIMESTAMP '1998-06-30 08:00:00' AS loaded_at FROM ready)
"""


def oracles() -> dict[str, str]:
    return {
        "stock_union": with_(STOCK)
        + "SELECT * FROM stock",
        "stock_report": with_(STOCK, REPORT) + "SELECT * FROM report",
        "stock_alerts": with_(STOCK, REPORT) + "SELECT * FROM report WHERE alert <> 'ok'",
        "stock_summary": with_(STOCK, REPORT) + f"""
SELECT marketplace, count(DISTINCT sku) AS sku_count, {lsum("available_stock")} AS available_stock, {msum("revenue_3d")} AS revenue_3d,
    {cnt("alert <> 'ok'")} AS alerts_count FROM report GROUP BY 1
""",
        "stock_alert_messages": with_(STOCK, REPORT) + """
SELECT marketplace, sku, warehouse, '• ' || marketplace || ' / ' || sku || ': ' || product_name || ' — доступно ' || available_stock
    || ', статус ' || alert AS message FROM report WHERE alert <> 'ok'
""",
    }
