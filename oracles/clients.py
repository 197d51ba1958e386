"""Oracles of the client cleanup."""

from oracles.sql import div, rnd, with_


def title(x: str) -> str:
    runs = f"regexp_extract_all({x}, '\\p{{L}}+|[^\\p{{L}}]+')"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1]) || lower(w[2:])), '')"


PHONE = """CASE c_custkey % 4 WHEN 0 THEN '8' || d
    WHEN 1 THEN '+7 (' || d[1:3] || ') ' || d[4:6] || '-' || d[7:8] || '-' || d[9:10]
    WHEN 2 THEN d ELSE '12-' || c_custkey END"""
EMAIL = """CASE c_custkey % 3 WHEN 0 THEN ' Client.' || c_custkey || '@Example.COM ' WHEN 1 THEN 'client ' || c_custkey || '@example.com'
    ELSE 'клиент' || c_custkey || '@example.com' END"""
# The +7 prefix for 10 digits, or 11 digits that start with 7 or 8.
CLEAN_PHONE = """CASE WHEN length(p) = 11 AND p[1] IN ('7', '8') THEN '+7' || p[2:11] WHEN length(p) = 10 THEN '+7' || p ELSE '' END"""

RAW = f"""
base AS (SELECT *, CAST(9000000000 + c_custkey AS VARCHAR) AS d FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
copies AS (SELECT *, 0 AS copy FROM base UNION ALL SELECT *, 1 FROM base WHERE c_custkey % 6 = 0),
dirty AS (SELECT c_custkey * 2 + copy AS row_no, 'C' || (c_custkey * 2 + copy) AS client_id,
    (CASE copy WHEN 1 THEN ' пётр-иван  ' ELSE 'ПЕТР-Иван ' END) || replace(c_name, '#', ' ') AS full_name,
    {PHONE} AS phone, CASE WHEN copy = 0 THEN {EMAIL} END AS email, replace(n_name, '_', '-') AS city,
    CASE copy WHEN 1 THEN 'import' ELSE 'site' END AS source, CAST(DATE '2020-01-01' + to_days(CAST(c_custkey % 1000 AS INT)) AS DATE) AS registered_at,
    CASE WHEN c_custkey % 5 <> 0 THEN CAST(DATE '2023-01-01' + to_days(CAST(c_custkey % 300 + 10 * copy AS INT)) AS DATE) END AS last_order_at,
    CAST(c_custkey % 9 + copy AS INT) AS total_orders, c_acctbal AS revenue_rub, CASE WHEN c_custkey % 3 = 0 THEN 'gold' ELSE '' END AS loyalty_level,
    CAST(c_custkey % 2 AS INT) AS consent_email, copy AS consent_sms FROM copies)
"""

KEYED = f"""
cleaned AS (SELECT * EXCLUDE (p), {CLEAN_PHONE} AS phone_clean,
    {title("trim(regexp_replace(translate(full_name, 'ёЁ', 'еЕ'), '\\s+', ' ', 'g'))")} AS full_name_clean,
    CASE WHEN regexp_matches(lower(regexp_replace(email, '\\s+', '', 'g')), '^[a-z0-9._%+\\-]+@[a-z0-9.\\-]+\\.[a-z]{{2,}}$')
         THEN lower(regexp_replace(email, '\\s+', '', 'g')) ELSE '' END AS email_clean,
    {title("trim(regexp_replace(city, '\\s+', ' ', 'g'))")} AS city_clean
    FROM (SELECT *, regexp_replace(phone, '[^0-9]', '', 'g') AS p FROM dirty)),
keyed AS (SELECT *, CAST(full_name_clean <> '' AS INT) + CAST(phone_clean <> '' AS INT) + CAST(email_clean <> '' AS INT)
        + CAST(city_clean <> '' AS INT) + CAST(registered_at IS NOT NULL AS INT) + CAST(last_order_at IS NOT NULL AS INT)
        + CAST(coalesce(trim(loyalty_level), '') <> '' AS INT) AS completeness_score,
    CASE WHEN phone_clean <> '' THEN 'phone:' || phone_clean WHEN email_clean <> '' THEN 'email:' || email_clean
         ELSE 'name_city:' || sha1(full_name_clean || '|' || city_clean)[1:16] END AS duplicate_key FROM cleaned)
"""

MASTER = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY duplicate_key ORDER BY completeness_score DESC, last_order_at DESC NULLS LAST,
    revenue_rub DESC NULLS LAST, total_orders DESC NULLS LAST, row_no) AS rn FROM keyed),
group_values AS (SELECT duplicate_key, count(*) AS records, string_agg(client_id, ', ' ORDER BY row_no) AS merged_client_ids,
    coalesce(first(full_name_clean ORDER BY row_no) FILTER (WHERE full_name_clean <> ''), '') AS full_name,
    coalesce(first(phone_clean ORDER BY row_no) FILTER (WHERE phone_clean <> ''), '') AS phone,
    coalesce(first(email_clean ORDER BY row_no) FILTER (WHERE email_clean <> ''), '') AS email,
    coalesce(first(city_clean ORDER BY row_no) FILTER (WHERE city_clean <> ''), '') AS city
    FROM keyed GROUP BY duplicate_key),
master AS (SELECT sha1(duplicate_key)[1:12] AS client_uid, client_id, g.full_name, g.phone, g.email, g.city, source AS primary_source,
    registered_at, last_order_at, total_orders, revenue_rub, loyalty_level, consent_email, consent_sms,
    records AS raw_records_in_group, merged_client_ids FROM group_values g JOIN ranked r USING (duplicate_key) WHERE rn = 1)
"""


def _quality() -> str:
    before = div("pb + eb", "rb * 2", None)
    after = div("pa + ea", "ra * 2", None)
    qb, qa = rnd(f"{before} * 100", 1), rnd(f"{after} * 100", 1)
    rows = [
        (1, "Строк в сырой базе", "rb", "ra", "rb - ra"),
        (2, "Найдено дублей", "rb - ra", "0", "rb - ra"),
        (3, "Валидных телефонов", "pb", "pa", "pa - pb"),
        (4, "Валидных email", "eb", "ea", "ea - eb"),
        (5, "Качество контактов, %", qb, qa, rnd(f"{qa} - {qb}", 1)),
    ]
    union = " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS metric, CAST({b} AS DOUBLE) AS before, CAST({a} AS DOUBLE) AS after, "
        f"CAST({d} AS DOUBLE) AS delta FROM n"
        for i, name, b, a, d in rows
    )
    counts = """
n AS (SELECT (SELECT count(*) FROM keyed) AS rb, (SELECT count(*) FROM master) AS ra,
    (SELECT count(*) FROM keyed WHERE phone_clean <> '') AS pb, (SELECT count(*) FROM keyed WHERE email_clean <> '') AS eb,
    (SELECT count(*) FROM master WHERE phone <> '') AS pa, (SELECT count(*) FROM master WHERE email <> '') AS ea)
"""
    return with_(RAW, KEYED, MASTER, counts) + union


def _dictionary() -> str:
    from salesloom.fixed_values import CLIENT_DICTIONARY

    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", '{text}' AS description, count(*) FILTER (WHERE trim(CAST({name} AS VARCHAR)) <> '') AS filled_rows FROM master"
        for name, text in CLIENT_DICTIONARY.items()
    )
    return with_(RAW, KEYED, MASTER) + rows


def oracles() -> dict[str, str]:
    return {
        "normalize_contacts": with_(RAW, KEYED) + "SELECT row_no, client_id, full_name_clean, phone_clean, email_clean, city_clean FROM keyed",
        "client_dedup_key": with_(RAW, KEYED) + "SELECT row_no, client_id, completeness_score, duplicate_key FROM keyed",
        "client_master": with_(RAW, KEYED, MASTER) + "SELECT * EXCLUDE (merged_client_ids) FROM master",
        "client_id_list": with_(RAW, KEYED) + """
SELECT sha1(duplicate_key)[1:12] AS client_uid, duplicate_key, part, string_agg(client_id, ', ' ORDER BY row_no) AS merged_client_ids
FROM (SELECT *, (row_number() OVER (PARTITION BY duplicate_key ORDER BY row_no) - 1) // 100 AS part FROM keyed) GROUP BY duplicate_key, part
""",
        "client_id_list_sql": with_(RAW) + f"""
SELECT duplicate_key, part, string_agg(client_id, ', ' ORDER BY row_no) AS client_ids
FROM (SELECT *, (row_number() OVER (PARTITION BY duplicate_key ORDER BY row_no) - 1) // 100 AS part, count(*) OVER (PARTITION BY duplicate_key) AS n
    FROM (SELECT row_no, client_id, CASE WHEN phone <> '' THEN 'phone:' || phone WHEN email <> '' THEN 'email:' || email
            ELSE 'name_city:' || upper(md5(full_name || '|' || city)) END AS duplicate_key
        FROM (SELECT row_no, client_id, lower(trim(coalesce(email, ''))) AS email, trim(full_name) AS full_name, city, {CLEAN_PHONE} AS phone
              FROM (SELECT * EXCLUDE (phone), regexp_replace(phone, '[^0-9]', '', 'g') AS p FROM dirty))))
WHERE n > 1 GROUP BY duplicate_key, part
""",
        "client_merge_map": with_(RAW, KEYED) + "SELECT sha1(duplicate_key)[1:12] AS client_uid, duplicate_key, row_no, client_id FROM keyed",
        "client_duplicate_groups": with_(RAW, KEYED, MASTER) + """
SELECT duplicate_group_id, duplicate_key, records AS records_in_group, client_id AS selected_client_id,
    'phone/email/name_city match' AS dedup_reason
FROM (SELECT *, row_number() OVER (ORDER BY duplicate_key) AS duplicate_group_id FROM group_values)
JOIN (SELECT duplicate_key, client_id FROM ranked WHERE rn = 1) USING (duplicate_key) WHERE records > 1
""",
        "client_duplicate_groups_sql": with_(RAW) + f"""
SELECT duplicate_key, count(*) AS records_in_group, min(phone) AS phone, min(email) AS email, max(revenue_rub) AS max_revenue
FROM (SELECT *, CASE WHEN phone <> '' THEN 'phone:' || phone WHEN email <> '' THEN 'email:' || email
        ELSE 'name_city:' || upper(md5(full_name || '|' || city)) END AS duplicate_key
    FROM (SELECT client_id, lower(trim(coalesce(email, ''))) AS email, trim(full_name) AS full_name, city, revenue_rub, {CLEAN_PHONE} AS phone
          FROM (SELECT * EXCLUDE (phone), regexp_replace(phone, '[^0-9]', '', 'g') AS p FROM dirty)))
GROUP BY 1 HAVING count(*) > 1
""",
        "client_duplicate_records": with_(RAW, KEYED) + """
SELECT *, count(*) OVER (PARTITION BY duplicate_key) AS duplicate_group_size FROM keyed
QUALIFY count(*) OVER (PARTITION BY duplicate_key) > 1
""",
        "client_quality": _quality(),
        "data_dictionary": _dictionary(),
    }
