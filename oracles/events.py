"""Oracles of leads, support, notifications and contacts."""

from oracles.clients import CLEAN_PHONE, PHONE
from oracles.sql import rnd, with_

START = "TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 30 AS INT))"

FORMS = f"""
forms AS (SELECT *, regexp_replace(phone, '[^0-9]', '', 'g') AS p FROM (
    SELECT c_custkey AS form_id, {START} AS created_at, CASE WHEN c_custkey % 17 = 0 THEN 'X' ELSE c_name END AS name, {PHONE} AS phone,
    CASE WHEN c_custkey % 19 = 0 THEN 'no-address' ELSE 'c' || c_custkey || '@example.com' END AS email,
    CASE WHEN c_custkey % 23 = 0 THEN ' ' ELSE c_mktsegment END AS service,
    CASE WHEN c_custkey % 97 = 0 THEN repeat('x', 2001) ELSE 'note ' || c_custkey END AS comment, 'utm' || (c_nationkey % 4) AS utm_source,
    'cpc' AS utm_medium, 'camp' || (c_nationkey % 3) AS utm_campaign, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE '/p/' || c_custkey END AS page_url
    FROM (SELECT *, CAST(9000000000 + c_custkey AS VARCHAR) AS d FROM customer))),
checked AS (SELECT *, {CLEAN_PHONE} AS phone_ok, concat_ws(',', CASE WHEN length(name) NOT BETWEEN 2 AND 120 THEN 'name' END,
    CASE WHEN length(phone) NOT BETWEEN 7 AND 30 OR ({CLEAN_PHONE}) = '' THEN 'phone' END,
    CASE WHEN NOT regexp_matches(lower(trim(email)), '^[a-z0-9!#$%&''*+/=?^_`{{|}}~-]+([.][a-z0-9!#$%&''*+/=?^_`{{|}}~-]+)*@([a-z0-9]([a-z0-9-]*[a-z0-9])?[.])+[a-z]{{2,}}$') THEN 'email' END,
    CASE WHEN length(service) NOT BETWEEN 2 AND 160 THEN 'service' END, CASE WHEN length(comment) > 2000 THEN 'comment' END) AS errors FROM forms),
validated AS (SELECT form_id, created_at, name, CASE WHEN errors = '' THEN phone_ok ELSE phone END AS phone, email, service, comment, utm_source,
    utm_medium, utm_campaign, page_url, errors, errors = '' AS is_valid,
    'L-' || strftime(created_at, '%Y%m%d') || '-' || upper(sha1(CAST(form_id AS VARCHAR))[1:16]) AS lead_id,
    CASE WHEN errors = '' THEN 'new' ELSE 'rejected' END AS status, CASE WHEN errors = '' THEN 'queued' END AS crm_status,
    CASE WHEN errors = '' THEN 'queued' END AS telegram_status, CASE WHEN errors = '' THEN 'queued' END AS sheets_status FROM checked)
"""


def _outcome(n: int) -> str:
    return f"CASE c_custkey % {n} WHEN 0 THEN 'sent' WHEN 1 THEN 'skipped' ELSE 'error' END"


LATEST = f"""
latest AS (SELECT 'L-' || c_custkey AS lead_id, CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 2 END AS version, {START} AS created_at,
    c_mktsegment AS service, 'utm' || (c_nationkey % 4) AS utm_source,
    CASE WHEN c_custkey % 10 = 0 THEN 'queued' ELSE {_outcome(3)} END AS crm_status,
    CASE WHEN c_custkey % 10 = 0 THEN 'queued' ELSE {_outcome(4)} END AS telegram_status,
    CASE WHEN c_custkey % 10 = 0 THEN 'queued' ELSE {_outcome(5)} END AS sheets_status FROM customer)
"""

BOT = f"""
bot_raw AS (SELECT 'B-' || key AS lead_id, created_at, c_name AS name, {PHONE} AS phone,
    CASE WHEN key % 19 = 0 THEN 'no address' ELSE 'c' || key || '@example.com' END AS email, c_mktsegment AS service,
    'до ' || (50 * (1 + key % 3)) AS budget, 'note ' || key AS comment,
    CASE WHEN key % 7 = 0 THEN 'new' ELSE CASE key % 3 WHEN 0 THEN 'new' WHEN 1 THEN 'in_work' ELSE 'done' END END AS status,
    CASE WHEN key % 4 = 0 THEN 'Не назначен' ELSE 'm' || (key % 5) END AS manager, 'telegram_bot' AS source
    FROM (SELECT c.c_custkey AS key, {START.replace("c_custkey", "c.c_custkey")} AS created_at, c_name, c_mktsegment,
            c.c_custkey - c.c_custkey % 2 AS c_custkey, CAST(9000000000 + c.c_custkey - c.c_custkey % 2 AS VARCHAR) AS d FROM customer c)),
bot AS (SELECT *, errors = '' AS is_valid FROM (SELECT *, concat_ws(',', CASE WHEN service = 'FURNITURE' THEN 'service' END,
    CASE WHEN length(regexp_replace(phone, '[^0-9]', '', 'g')) NOT IN (10, 11) THEN 'phone' END,
    CASE WHEN NOT regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$') THEN 'email' END) AS errors FROM bot_raw))
"""


def _words(x: str) -> str:
    stop = "['как', 'где', 'что', 'когда', 'можно', 'нужно', 'по', 'на', 'и', 'в']"
    runs = f"list_distinct(regexp_extract_all(replace(lower({x}), 'ё', 'е'), '[\\p{{L}}\\p{{N}}]+'))"
    return f"list_filter({runs}, lambda w: NOT list_contains({stop}, w))"


FAQ = f"""
asked AS (SELECT conv_id || '-' || turn AS question_id, TIMESTAMP '2024-01-01' + to_days(CAST(conv_id % 30 AS INT)) AS created_at,
    CASE WHEN conv_id % 6 = 0 THEN 'Клиент' ELSE 'user ' || conv_id END AS client_name, 'telegram' AS channel,
    CASE WHEN conv_id % 25 = 24 THEN 'Связаться с оператором' ELSE text END AS question FROM conversations WHERE role = 'user'),
q_words AS (SELECT question_id, unnest({_words("question")}) AS word FROM asked),
f_words AS (SELECT item_id, unnest({_words("text || ' answer ' || item_id || ' c' || (item_id % 5)")}) AS word FROM benchmark),
best AS (SELECT question_id, item_id, score FROM (SELECT question_id, item_id, count(*) AS score FROM q_words JOIN f_words USING (word) GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY score DESC, item_id) = 1),
matched AS (SELECT question_id, item_id IS NOT NULL AS found, item_id, coalesce('item' || item_id, 'unknown') AS intent, 'c' || (item_id % 5) AS category,
    coalesce('answer ' || item_id, 'Я не нашел точный ответ. Передаю вопрос оператору.') AS answer,
    coalesce(score, 0) AS score, coalesce(score, 0) < 2 AS need_operator FROM asked LEFT JOIN best USING (question_id)),
tickets AS (SELECT 'T-' || strftime(created_at, '%Y%m%d') || '-' || upper(sha1(question_id)[1:16]) AS ticket_id, question_id, created_at, client_name,
    channel, trim(question) AS question, CASE WHEN op THEN 'operator_request' ELSE intent END AS detected_intent,
    CASE WHEN op OR need_operator THEN 'operator' ELSE 'answered' END AS status, CAST(op OR need_operator AS INT) AS need_operator
    FROM (SELECT *, lower(question) = 'связаться с оператором' AS op FROM asked JOIN matched USING (question_id)))
"""

NOTES = """
notes AS (SELECT 'E-' || event_id AS event_id, ts AS created_at, event_type, 'Event ' || event_type AS title, 'U-' || user_id AS entity_id,
    CASE event_type WHEN 'error' THEN 'critical' WHEN 'purchase' THEN 'high' WHEN 'signup' THEN 'normal' ELSE 'other' END AS priority,
    'team' || (user_id % 5) AS responsible, CASE WHEN event_id % 5 = 0 THEN 'queued' ELSE 'sent' END AS status, 'telegram' AS channel,
    props AS message FROM events),
queue AS (SELECT *, CASE priority WHEN 'critical' THEN 1 WHEN 'high' THEN 2 WHEN 'normal' THEN 3 WHEN 'low' THEN 4 ELSE 9 END AS priority_sort
    FROM notes WHERE status = 'queued' AND event_type IN ('click', 'signup', 'purchase', 'error'))
"""

SHEET = f"""
sheet AS (SELECT c_custkey AS row_no, 'N' || (c_custkey // 2) AS number, {PHONE} AS phone, c_name AS name, c_mktsegment AS area, n_name AS city,
    CASE WHEN c_custkey % 6 <> 0 THEN 'street ' || (c_custkey % 50) END AS street, '' AS locality, CAST(c_custkey % 90 AS VARCHAR) AS house,
    CASE WHEN c_custkey % 8 = 0 THEN 'b1' END AS build, 'note ' || c_custkey AS comment, 'patronymic ' || (c_custkey % 7) AS patronymic,
    CASE WHEN c_custkey % 5 <> 0 THEN 'surname ' || c_custkey END AS surname, '2024-01-1' || (c_custkey % 10) AS date_inst,
    CASE WHEN c_custkey % 2 = 0 THEN 'yes' ELSE 'no' END AS guarantee, CASE WHEN c_custkey % 3 = 0 THEN 'to ' || (c_custkey % 4) END AS to1,
    '2025-02-1' || (c_custkey % 10) AS date_to,
    CASE c_custkey % 3 WHEN 0 THEN 'READY' WHEN 1 THEN 'ready' ELSE 'completed' END AS status,
    CASE WHEN c_custkey % 10 = 0 THEN '{{broken' WHEN c_custkey % 10 = 1 THEN '{{"response":{{"GeoObjectCollection":{{"featureMember":[]}}}}}}'
    ELSE '{{"response":{{"GeoObjectCollection":{{"featureMember":[{{"GeoObject":{{"Point":{{"pos":"' || (30 + c_nationkey) || '.'
        || lpad(CAST(c_custkey * 7 % 1000 AS VARCHAR), 3, '0') || ' ' || (45 + c_nationkey % 10) || '.' || lpad(CAST(c_custkey * 13 % 1000 AS VARCHAR), 3, '0')
        || '"}},"metaDataProperty":{{"GeocoderMetaData":{{"Address":{{"Components":['
        || CASE WHEN c_custkey % 10 = 2 THEN '{{"kind":"street","name":"S"}}'
           ELSE '{{"kind":"country","name":"X"}},{{"kind":"area","name":"D' || (c_custkey % 12) || '"}}' END
        || ']}}}}}}}}}}]}}}}}}' END AS geocoder_reply
    FROM (SELECT *, CAST(9000000000 + c_custkey AS VARCHAR) AS d FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)),
hits AS (SELECT *, CASE WHEN json_valid(geocoder_reply) THEN json_extract(geocoder_reply, '$.response.GeoObjectCollection.featureMember[0].GeoObject') END AS hit FROM sheet),
placed AS (SELECT * EXCLUDE (hit), string_split(json_extract_string(hit, '$.Point.pos'), ' ') AS pos,
    list_filter(CAST(json_extract(hit, '$.metaDataProperty.GeocoderMetaData.Address.Components') AS STRUCT(kind VARCHAR, name VARCHAR)[]),
        lambda c: c.kind = 'area')[1].name AS district FROM hits),
located AS (SELECT * EXCLUDE (pos, district), CAST(pos[1] AS DOUBLE) AS lon, CAST(pos[2] AS DOUBLE) AS lat, district FROM placed)
"""

STORED = """
batch AS (SELECT * FROM located WHERE lower(status) = 'ready' AND lon IS NOT NULL AND lat IS NOT NULL),
newest AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY number ORDER BY row_no DESC) = 1),
oldest AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY number ORDER BY row_no) = 1),
stored AS (SELECT 'N' || s_suppkey AS number, CASE s_suppkey % 4 WHEN 0 THEN '8' || d
        WHEN 1 THEN '+7 (' || d[1:3] || ') ' || d[4:6] || '-' || d[7:8] || '-' || d[9:10] WHEN 2 THEN d ELSE '12-' || s_suppkey END AS phone,
    s_name AS name, 'old' AS area, 'old city' AS city, 'old street' AS street, '' AS locality, '1' AS house, CAST(NULL AS VARCHAR) AS build,
    'old note' AS comment, 'old patronymic' AS patronymic, 'old surname' AS surname, '2020-01-01' AS date_inst,
    'old guarantee' AS guarantee, 'old to' AS to1, '2021-01-01' AS date_to, CAST(NULL AS DOUBLE) AS lon, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS VARCHAR) AS district
    FROM (SELECT *, CAST(9000000000 + s_suppkey AS VARCHAR) AS d FROM supplier))
"""


def _upsert() -> str:
    fixed = ("phone", "city", "street", "house")
    changed = ("name", "patronymic", "surname", "area", "locality", "build", "comment", "date_inst", "guarantee", "to1", "date_to", "lon", "lat", "district")
    columns = [f"CASE WHEN s.number IS NOT NULL THEN s.{c} ELSE o.{c} END AS {c}" for c in fixed]
    columns += [f"CASE WHEN n.number IS NOT NULL THEN n.{c} ELSE s.{c} END AS {c}" for c in changed]
    return with_(SHEET, STORED) + f"""
SELECT coalesce(s.number, n.number) AS number, {", ".join(columns)}
FROM stored s FULL JOIN newest n ON s.number = n.number LEFT JOIN oldest o ON o.number = n.number
"""


HAVERSINE = (
    "2 * 6371.0 * asin(sqrt(least(pow(sin(radians(s.lat - c.lat) / 2), 2) + cos(radians(c.lat)) * cos(radians(s.lat)) "
    "* pow(sin(radians(s.lon - c.lon) / 2), 2), 1.0)))"
)


def oracles() -> dict[str, str]:
    mark = "CASE priority WHEN 'critical' THEN '🚨' WHEN 'high' THEN '⚠️' WHEN 'low' THEN '🔹' ELSE 'ℹ️' END"
    share = rnd("avg(need_operator) * 100", 1)
    return {
        "lead_validation": with_(FORMS) + "SELECT * FROM validated",
        "lead_latest": with_(LATEST) + "SELECT * FROM latest",
        "site_lead_daily": with_(LATEST) + """
SELECT CAST(created_at AS DATE) AS date, service, utm_source, count(*) AS leads, count(*) FILTER (WHERE crm_status = 'sent') AS sent_to_crm
FROM latest GROUP BY 1, 2, 3
""",
        "site_lead_summary": with_(LATEST) + "SELECT service, utm_source, count(*) AS leads_count FROM latest GROUP BY 1, 2",
        "site_lead_messages": with_(FORMS) + """
SELECT lead_id, '🆕 Новая заявка с сайта' || chr(10) || chr(10) || 'ID: ' || lead_id || chr(10) || 'Услуга: ' || service || chr(10) || 'Клиент: '
    || name || chr(10) || 'Телефон: ' || phone || chr(10) || 'Email: ' || email || chr(10) || chr(10) || 'Комментарий: ' || comment || chr(10)
    || chr(10) || 'UTM: ' || utm_source || ' / ' || utm_medium || ' / ' || utm_campaign || chr(10) || 'Страница: '
    || CASE WHEN page_url = '' THEN '—' ELSE page_url END AS message FROM validated WHERE is_valid
""",
        "bot_lead_validation": with_(BOT) + "SELECT * FROM bot",
        "bot_lead_daily": with_(BOT) + """
SELECT CAST(created_at AS DATE) AS date, service, status, count(*) AS leads, count(DISTINCT phone) AS unique_contacts FROM bot GROUP BY 1, 2, 3
""",
        "bot_lead_summary": with_(BOT) + "SELECT service, status, count(*) AS leads_count FROM bot GROUP BY 1, 2",
        "bot_lead_messages": with_(BOT) + """
SELECT lead_id, '🆕 Новая заявка' || chr(10) || chr(10) || 'ID: ' || lead_id || chr(10) || 'Услуга: ' || service || chr(10) || 'Бюджет: ' || budget
    || chr(10) || 'Клиент: ' || name || chr(10) || 'Телефон: ' || phone || chr(10) || 'Email: ' || email || chr(10) || chr(10)
    || 'Комментарий: ' || comment AS message FROM bot WHERE is_valid
""",
        "faq_match": with_(FAQ) + "SELECT * FROM matched",
        "support_tickets": with_(FAQ) + "SELECT * FROM tickets",
        "support_daily": with_(FAQ) + f"""
SELECT CAST(created_at AS DATE) AS date, detected_intent, status, count(*) AS tickets, {share} AS operator_share FROM tickets GROUP BY 1, 2, 3
""",
        "support_summary": with_(FAQ) + f"""
SELECT detected_intent, status, count(*) AS tickets_count, {share} AS operator_share FROM tickets GROUP BY 1, 2
""",
        "support_operator_messages": with_(FAQ) + """
SELECT ticket_id, '⚠️ Вопрос передан оператору' || chr(10) || chr(10) || 'ID: ' || ticket_id || chr(10) || 'Клиент: ' || client_name || chr(10)
    || 'Канал: ' || channel || chr(10) || 'Тема: ' || detected_intent || chr(10) || chr(10) || 'Вопрос: ' || question AS message
FROM tickets WHERE need_operator = 1
""",
        "notification_queue": with_(NOTES) + "SELECT * FROM queue",
        "notification_outbox": with_(NOTES) + f"""
SELECT event_id, created_at, channel, responsible, priority_sort, {mark} || ' ' || title || chr(10) || chr(10) || 'Тип: ' || event_type || chr(10)
    || 'Объект: ' || entity_id || chr(10) || 'Ответственный: ' || responsible || chr(10) || 'Приоритет: ' || priority || chr(10) || chr(10)
    || message AS text FROM queue
""",
        "notification_mark_sent": with_(NOTES) + """
SELECT * REPLACE (CASE WHEN event_id IN (SELECT event_id FROM queue) THEN 'sent' ELSE status END AS status) FROM notes
""",
        "notification_daily": with_(NOTES) + """
SELECT CAST(created_at AS DATE) AS date, event_type, priority, status, count(*) AS events FROM notes GROUP BY 1, 2, 3, 4
""",
        "notification_summary": with_(NOTES) + "SELECT event_type, priority, status, count(*) AS events_count FROM notes GROUP BY 1, 2, 3",
        "contacts_ready": with_(SHEET) + """
SELECT *, area || ', ' || city || ', ' || coalesce(street, '') || ', ' || locality || ', ' || house || ', ' || coalesce(build, '') AS address
FROM sheet WHERE lower(status) = 'ready'
""",
        "geocode_parse": with_(SHEET) + "SELECT row_no, number, lon, lat, district FROM located",
        "contacts_upsert": _upsert(),
        "contacts_nearby": with_(SHEET, STORED) + f"""
SELECT * FROM (SELECT c.row_no, c.number, c.name, c.phone, c.city, c.lon, c.lat, c.district, s.stop AS point_stop, {rnd(HAVERSINE, 3)} AS distance_km
FROM batch c, (SELECT n_name AS stop, 45.5 + n_nationkey % 10 AS lat, 30.5 + n_nationkey AS lon FROM nation) s
WHERE {HAVERSINE} <= 40.0)
""",
    }
