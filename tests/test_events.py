"""Leads, support, notifications, contacts."""

import json

import pytest
from pyspark.sql import functions as F

from salesloom import fixed_values as fv
from salesloom import schemas
from salesloom.plans import contacts, leads, notifications, support
from tests.conftest import day, moment


def form(form_id, **changes):
    base = dict(
        form_id=form_id, created_at=moment("2026-06-25T10:00"), name="Иван", phone="8 (999) 123-45-67", email="ivan@example.com",
        service="Отчеты", comment="", utm_source="y", utm_medium="cpc", utm_campaign="c", utm_content=None, utm_term=None, page_url=None, referrer=None,
    )
    return tuple({**base, **changes}.values())


@pytest.mark.parametrize(
    "changes, errors",
    [
        ({}, ""),
        ({"name": "И"}, "name"),
        ({"name": "И" * 121}, "name"),
        ({"phone": "123"}, "phone"),
        ({"phone": "+1 999 123 45 67 89"}, "phone"),
        ({"email": "no"}, "email"),
        ({"email": None, "service": "x"}, "email,service"),
        ({"comment": "x" * 2001}, "comment"),
        ({"comment": "x" * 2000}, ""),
    ],
)
def test_lead_validation(spark, changes, errors):
    row = leads.validate_leads(spark.createDataFrame([form("1", **changes)], schemas.LEAD_FORMS)).first()
    assert (row["errors"], row["is_valid"]) == (errors, errors == "")
    if not errors:
        assert (row["phone"], row["status"], row["crm_status"]) == ("+79991234567", "new", "queued")


def test_accepted_and_quarantined_cover_all(spark):
    checked = leads.validate_leads(spark.createDataFrame([form("1"), form("2", name=None)], schemas.LEAD_FORMS))
    assert leads.accepted(checked).count() == leads.quarantined(checked).count() == 1
    message = leads.site_lead_messages(leads.accepted(checked)).first()["message"]
    assert "Комментарий: —" in message and message.endswith("Страница: —")


def test_bot_leads(spark):
    data = [
        ("b1", moment("2026-06-25T10:00"), " Анна ", "12 345 678 901", " A@B.ru ", "Отчеты", "100", None, None, "", None),
        ("b2", moment("2026-06-25T10:00"), "Олег", "123", "bad", "Другое", "100", "", "done", "Мария", None),
    ]
    services = spark.createDataFrame([("Отчеты",)], "service string")
    rows = {r["lead_id"]: r for r in leads.validate_bot_leads(spark.createDataFrame(data, schemas.BOT_LEADS), services).collect()}
    assert rows["b1"]["is_valid"] and rows["b2"]["errors"] == "service,phone,email"
    assert (rows["b1"]["name"], rows["b1"]["email"], rows["b1"]["status"], rows["b1"]["manager"]) == ("Анна", "a@b.ru", "new", "Не назначен")
    assert rows["b1"]["phone"] == "12 345 678 901"


@pytest.fixture
def faq(spark):
    entries = [
        (1, "payment", "Как оплатить заказ?", "Картой или по счету.", "Оплата"),
        (2, "delivery", "Когда доставят заказ?", "Доставка три дня.", "Доставка"),
        (3, "refund", "Возврат", "Напишите номер заказа.", "Возврат"),
    ]
    return spark.createDataFrame(entries, schemas.FAQ)


@pytest.fixture
def asked(spark):
    texts = {
        "q1": "Можно ОПЛАТИТЬ заказ картой?",
        "q2": "заказ",
        "q3": "привет",
        "q4": "связаться с ОПЕРАТОРОМ",
        "q5": None,
        "q6": "возврат номер возврат",
        "q7": "",
    }
    return spark.createDataFrame(
        [(k, moment("2026-06-25T10:00"), " ", "site", v) for k, v in texts.items()],
        "question_id string, created_at timestamp_ntz, client_name string, channel string, question string",
    )


def test_faq_match(asked, faq):
    rows = {r["question_id"]: r for r in support.match_faq(asked, faq).collect()}
    assert (rows["q1"]["intent"], rows["q1"]["score"], rows["q1"]["need_operator"]) == ("payment", 3, False)
    assert (rows["q2"]["item_id"], rows["q2"]["found"], rows["q2"]["need_operator"]) == (1, True, True)
    assert (rows["q3"]["intent"], rows["q3"]["found"], rows["q3"]["score"]) == ("unknown", False, 0)
    assert (rows["q6"]["intent"], rows["q6"]["score"]) == ("refund", 2)
    answers = {r["item_id"]: (r["category"], r["answer"]) for r in faq.collect()}
    assert (rows["q1"]["category"], rows["q1"]["answer"]) == answers[rows["q1"]["item_id"]]
    assert rows["q3"]["answer"] == fv.UNKNOWN_ANSWER and rows["q3"]["category"] is None
    assert len(rows) == 7 and rows["q5"]["found"] is False


def test_tickets(asked, faq):
    tickets = support.support_tickets(asked, support.match_faq(asked, faq))
    rows = {r["question_id"]: r for r in tickets.collect()}
    assert (rows["q4"]["detected_intent"], rows["q4"]["status"]) == ("operator_request", "operator")
    assert (rows["q1"]["status"], rows["q1"]["need_operator"], rows["q1"]["client_name"]) == ("answered", 0, "Клиент")
    assert rows["q5"]["status"] == "operator"
    summary = {(r["detected_intent"], r["status"]): (r["tickets_count"], r["operator_share"]) for r in support.support_summary(tickets).collect()}
    assert summary[("unknown", "operator")] == (3, 100.0)
    assert support.operator_messages(tickets).count() == 5


@pytest.fixture
def notes(spark):
    m = moment
    base = [
        ("e1", m("2026-06-25T10:00"), "new_lead", "low", "queued"),
        ("e2", m("2026-06-25T11:00"), "overdue", "critical", "queued"),
        ("e2", m("2026-06-25T11:00"), "overdue", "critical", "queued"),
        ("e3", m("2026-06-25T09:00"), "muted", "critical", "queued"),
        ("e4", m("2026-06-25T08:00"), "new_lead", "odd", "queued"),
        ("e5", m("2026-06-25T07:00"), "new_lead", "high", "sent"),
    ]
    rows = [(i, t, kind, "T", "E", p, "R", s, "chat", "text") for i, t, kind, p, s in base]
    events = spark.createDataFrame(rows, schemas.NOTIFICATIONS)
    rules = spark.createDataFrame(
        [("r", "new_lead", "", "", "", 1), ("r", "overdue", "", "", "", 1), ("r", "muted", "", "", "", 0)], schemas.NOTIFICATION_RULES
    )
    return events, rules


def test_notification_queue(notes):
    queue = notifications.notification_queue(*notes)
    assert [(r["event_id"], r["priority_sort"]) for r in queue.collect()] == [("e2", 1), ("e2", 1), ("e1", 4), ("e4", 9)]
    text = {r["event_id"]: r["text"] for r in notifications.outbox(queue).collect()}
    assert text["e2"].startswith("🚨 T\n\nТип: overdue\n") and text["e4"].startswith("ℹ️")


def test_mark_sent(notes):
    events, rules = notes
    marked = notifications.mark_sent(events, notifications.queued_events(events, rules))
    states = sorted((r["event_id"], r["status"]) for r in marked.collect())
    assert states == [("e1", "sent"), ("e2", "sent"), ("e2", "sent"), ("e3", "queued"), ("e4", "sent"), ("e5", "sent")]
    assert notifications.queued_events(marked, rules).count() == 0


def reply(pos="37.5 55.7", components=({"kind": "area", "name": "North"},)):
    address = {} if components is None else {"Components": list(components)}
    hit = {"Point": {"pos": pos}, "metaDataProperty": {"GeocoderMetaData": {"Address": address}}}
    return json.dumps({"response": {"GeoObjectCollection": {"featureMember": [{"GeoObject": hit}]}}})


@pytest.mark.parametrize(
    "text, expected",
    [
        (reply(), (37.5, 55.7, "North")),
        (reply(components=({"kind": "country", "name": "X"}, {"kind": "area", "name": "A"}, {"kind": "area", "name": "B"})), (37.5, 55.7, "A")),
        (reply(components=()), (37.5, 55.7, None)),
        (reply(components=None), (None, None, None)),
        (reply(pos="37.5"), (None, None, None)),
        (reply(pos="1 2 3"), (None, None, None)),
        ('{"response":{"GeoObjectCollection":{"featureMember":[]}}}', (None, None, None)),
        ("{broken", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_geocoder_reply(spark, text, expected):
    df = spark.createDataFrame([(text,)], "geocoder_reply string")
    row = contacts.with_location(df).first()
    assert (row["lon"], row["lat"], row["district"]) == expected


def sheet_row(row_no, number, status="ready", geocoder_reply=None, **changes):
    base = {f.name: None for f in schemas.CONTACT_SHEET}
    base.update(row_no=row_no, number=number, status=status, city="X", street="S", geocoder_reply=geocoder_reply or reply(), **changes)
    return tuple(base.values())


def test_contact_upsert(spark):
    sheet = spark.createDataFrame(
        [
            sheet_row(1, "n1", name="first", phone="new phone"),
            sheet_row(2, "n1", status="Ready", name="second"),
            sheet_row(3, "n2", status="completed", name="skipped"),
            sheet_row(4, "n3", name="no place", geocoder_reply="{broken"),
        ],
        schemas.CONTACT_SHEET,
    )
    assert contacts.ready_contacts(sheet).first()["address"] == ", X, S, , , "
    columns = "number string, phone string, name string, city string, street string, house string, area string, locality string, build string, comment string, lon double, lat double, district string"
    stored = [("n1", "old phone", "old", "old city", "old street", "1", "a", "l", "b", "c", 1.0, 2.0, None)]
    merged = contacts.upsert_contacts(spark.createDataFrame(stored, columns), sheet)
    rows = {r["number"]: r for r in merged.collect()}
    assert set(rows) == {"n1"}
    n1 = rows["n1"]
    assert (n1["name"], n1["phone"], n1["city"], n1["lon"], n1["district"]) == ("second", "old phone", "old city", 37.5, "North")


def test_nearby_filters(spark):
    people = spark.createDataFrame([(1, "X", 55.0, 37.0), (2, "Y", 55.01, 37.0), (3, "X", None, None)], "id int, city string, lat double, lon double")
    stops = spark.createDataFrame([("s", 55.0, 37.0)], "stop string, lat double, lon double")
    near = contacts.contacts_nearby(people, stops, 5.0)
    assert sorted((r["id"], round(r["distance_km"], 2)) for r in near.collect()) == [(1, 0.0), (2, 1.11)]
    assert [r["id"] for r in contacts.contacts_nearby(people, stops, 5.0, city="Y").collect()] == [2]


def test_latest_state_before_the_summary(spark):
    log = spark.createDataFrame(
        [("l1", 1, moment("2026-06-25T10:00"), "s", "y", "queued"), ("l1", 2, moment("2026-06-25T10:00"), "s", "y", "sent"), ("l2", 1, moment("2026-06-25T10:00"), "s", "y", "queued")],
        "lead_id string, version int, created_at timestamp_ntz, service string, utm_source string, crm_status string",
    )
    daily = leads.site_daily(leads.latest_leads(log)).first()
    assert (daily["date"], daily["leads"], daily["sent_to_crm"]) == (day("2026-06-25"), 2, 1)
    assert leads.site_summary(leads.latest_leads(log)).first()["leads_count"] == 2
    assert log.agg(F.count("*")).first()[0] == 3
