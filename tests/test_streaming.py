import json
import os
import random
from pathlib import Path

from pyspark.sql import functions as F

from salesloom import schemas
from salesloom.plans import contacts, leads, notifications
from salesloom.sources.versions import BucketTable, child_folders
from salesloom.streaming import contacts as contact_stream
from salesloom.streaming import intake, outbox, statuses
from salesloom.streaming.files import landed_json
from tests.test_events import form, reply, sheet_row


def land(folder, name, schema, rows):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps(dict(zip(schema.fieldNames(), r)), default=str, ensure_ascii=False) for r in rows]
    (folder / name).write_text("\n".join(lines), encoding="utf-8")


def run(query):
    for q in query if isinstance(query, list) else [query]:
        assert q.awaitTermination(120) and q.exception() is None


def test_intake_equals_batch(spark, tmp_path):
    rows = [form(str(i), **({"name": "x"} if i % 3 == 0 else {})) for i in range(9)]
    land(tmp_path / "in", "a.json", schemas.LEAD_FORMS, rows[:5])

    def once():
        stream = landed_json(spark, str(tmp_path / "in"), schemas.LEAD_FORMS)
        run(intake.start_intake(stream, str(tmp_path / "leads"), str(tmp_path / "bad"), str(tmp_path / "cp")))

    once()
    land(tmp_path / "in", "b.json", schemas.LEAD_FORMS, rows[5:])
    once()
    once()
    batch = leads.validate_leads(spark.createDataFrame(rows, schemas.LEAD_FORMS))
    found = spark.read.parquet(str(tmp_path / "leads"))
    expected = leads.accepted(batch)
    assert sorted(r["lead_id"] for r in found.collect()) == sorted(r["lead_id"] for r in expected.collect())
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 3
    assert {r["phone"] for r in found.collect()} == {"+79991234567"}


def note(event_id, time, kind="lead", status="queued"):
    return (event_id, f"2026-06-{time}", kind, "T", "E", "high", "R", status, "chat", "text")


def test_outbox_sends_each_event_once(spark, tmp_path):
    rules = spark.createDataFrame([("r", "lead", "", "", "", 1), ("r", "off", "", "", "", 0)], schemas.NOTIFICATION_RULES)
    first = [note("e1", "25T10:00:00"), note("e1", "25T10:00:00"), note("e2", "25T11:00:00", "off"), note("e3", "01T11:00:00", status="sent")]
    second = [note("e1", "27T10:00:00"), note("e4", "02T10:00:00"), note("e4", "03T10:00:00"), note("e5", "26T10:00:00")]
    path = str(tmp_path / "outbox")

    def once(name, rows):
        land(tmp_path / "in", name, schemas.NOTIFICATIONS, rows)
        stream = landed_json(spark, str(tmp_path / "in"), schemas.NOTIFICATIONS)
        run(outbox.start_outbox(stream, rules, path, str(tmp_path / "cp")))

    once("a.json", first)
    once("b.json", second)
    sent = outbox.read_outbox(spark, path)
    assert sorted(r["event_id"] for r in sent.collect()) == ["e1", "e4", "e5"]  # e1 came again on another day, e4 three weeks late
    assert {r["event_id"]: r["created_at"].day for r in sent.collect()} == {"e1": 25, "e4": 2, "e5": 26}
    log = spark.read.schema(schemas.NOTIFICATIONS).json(str(tmp_path / "in"))
    marked = {(r["event_id"], r["status"]) for r in outbox.events_with_status(log, path).collect()}
    assert marked == {("e1", "sent"), ("e2", "queued"), ("e3", "sent"), ("e4", "sent"), ("e5", "sent")}
    batch = notifications.outbox(notifications.queued_events(log, rules)).select("event_id", "text").distinct()
    assert {tuple(r) for r in sent.select("event_id", "text").collect()} == {tuple(r) for r in batch.collect()}


def test_contact_versions_equal_one_batch(spark, tmp_path):
    rows = [
        sheet_row(1, "n1", name="first", phone="p1"),
        sheet_row(2, "n2", name="lost", geocoder_reply="{broken"),
        sheet_row(3, "n1", name="second", phone="p2", geocoder_reply=reply(pos="1 2")),
        sheet_row(4, "n3", name="third"),
    ]
    columns = [f.name for f in schemas.CONTACT_SHEET if f.name not in ("row_no", "status", "geocoder_reply")]
    empty = spark.createDataFrame([], schemas.CONTACT_SHEET).select(
        *columns, F.lit(0.0).alias("lon"), F.lit(0.0).alias("lat"), F.lit("").alias("district")
    )
    empty = spark.createDataFrame([], empty.schema)
    for i, part in enumerate((rows[:2], rows[2:])):
        land(tmp_path / "in", f"{i}.json", schemas.CONTACT_SHEET, part)
        stream = landed_json(spark, str(tmp_path / "in"), schemas.CONTACT_SHEET)
        query = contact_stream.start_upserts(stream, empty, str(tmp_path / "c"), str(tmp_path / "wait"), str(tmp_path / "cp"))
        run(query)
    latest = contact_stream.read_version(spark, str(tmp_path / "c"), 2, empty.schema)
    whole = contacts.upsert_contacts(empty, spark.createDataFrame(rows, schemas.CONTACT_SHEET))
    show = ["number", "name", "phone", "lon", "lat"]
    assert sorted(map(str, latest.select(*show).collect())) == sorted(map(str, whole.select(*show).collect()))
    assert latest.filter("number = 'n1'").first()["phone"] == "p1"
    waiting = contact_stream.read_pending(spark, str(tmp_path / "wait"), 2, schemas.CONTACT_SHEET)
    assert [r["number"] for r in waiting.collect()] == ["n2"]


def contact_columns(spark):
    columns = [f.name for f in schemas.CONTACT_SHEET if f.name not in ("row_no", "status", "geocoder_reply")]
    empty = spark.createDataFrame([], schemas.CONTACT_SHEET).select(*columns, F.lit(0.0).alias("lon"), F.lit(0.0).alias("lat"), F.lit("").alias("district"))
    return spark.createDataFrame([], empty.schema)


def test_contacts_wait_for_a_later_reply(spark, tmp_path):
    empty = contact_columns(spark)
    answers = "address string, geocoder_reply string, replied_at timestamp_ntz"

    def once(name, rows, replies):
        land(tmp_path / "in", name, schemas.CONTACT_SHEET, rows)
        stream = landed_json(spark, str(tmp_path / "in"), schemas.CONTACT_SHEET)
        run(contact_stream.start_upserts(stream, empty, str(tmp_path / "c"), str(tmp_path / "wait"), str(tmp_path / "cp"), replies=replies, buckets=8))

    def waiting(version):
        found = contact_stream.read_pending(spark, str(tmp_path / "wait"), version, schemas.CONTACT_SHEET).collect()
        return sorted((r["row_no"], r["number"]) for r in found)

    def stored(version):
        rows = contact_stream.contact_table(spark, str(tmp_path / "c"), empty.schema, 8).read(version).collect()
        return {r["number"]: (r["name"], r["lon"]) for r in rows}

    lost = {"geocoder_reply": "{broken"}
    first = [sheet_row(1, "n1", name="a", **lost), sheet_row(2, "n2", name="b", **lost), sheet_row(3, "n3", name="c"), sheet_row(4, "n1", name="d", **lost)]
    once("0.json", first, None)
    assert waiting(1) == [(2, "n2"), (4, "n1")] and set(stored(1)) == {"n3"}
    # A later row of n2 has a position, so the waiting one gives way; n1 goes on waiting.
    once("1.json", [sheet_row(5, "n2", name="later", geocoder_reply=reply(pos="3 4"))], None)
    assert waiting(2) == [(4, "n1")] and stored(2)["n2"] == ("later", 3.0)
    address = contact_stream.ready_contacts(spark.createDataFrame(first, schemas.CONTACT_SHEET)).first()["address"]
    replies = spark.createDataFrame([(address, "{old", None), (address, reply(pos="7 8"), None)], answers)
    replies = replies.withColumn("replied_at", F.when(F.col("geocoder_reply") == "{old", F.lit("2026-01-01")).otherwise(F.lit("2026-02-01")).cast("timestamp_ntz"))
    once("2.json", [sheet_row(6, "n9", name="new")], replies)
    assert waiting(3) == [] and stored(3)["n1"] == ("d", 7.0) and set(stored(3)) == {"n1", "n2", "n3", "n9"}


def test_versions_reference_what_did_not_change(spark, tmp_path):
    rows = spark.range(400).selectExpr("concat('k', id) k", "id v")
    table = BucketTable(spark, str(tmp_path / "t"), rows.schema, "k", 16)
    table.create(rows)
    table.create(rows.limit(0))
    assert len(table.manifest(0)) == 16 and table.read().count() == 400
    change = spark.createDataFrame([("k7", -1), ("new", -2)], rows.schema)

    def change_to(base, version):
        touched = table.touched(change)
        kept = table.read(base, touched).join(change, "k", "left_anti")
        table.replace(base, version, touched, kept.unionByName(change))
        return touched

    touched = change_to(0, 1)
    manifest = table.manifest(1)
    assert {b for b, v in manifest.items() if v == 1} == set(touched) and len(touched) <= 2
    assert len(child_folders(spark, f"{tmp_path}/t/data/version=1", "bucket")) == len(touched)
    want = {r["k"]: r["v"] for r in rows.collect()} | {"k7": -1, "new": -2}
    assert {r["k"]: r["v"] for r in table.read().collect()} == want
    # A run that dies between data and manifest changes nothing, and its repetition writes the same.
    change.select("k", F.lit(5).cast("long").alias("v")).withColumn("bucket", table.bucket()).write.partitionBy("bucket").parquet(f"{tmp_path}/t/data/version=2")
    assert table.versions() == [0, 1] and {r["k"]: r["v"] for r in table.read().collect()} == want
    change_to(1, 2)
    assert {r["k"]: r["v"] for r in table.read(2).collect()} == want
    table.vacuum(keep=1)
    assert table.versions() == [2] and {r["k"]: r["v"] for r in table.read().collect()} == want
    assert 1 not in child_folders(spark, f"{tmp_path}/t/data", "version")
    assert not set(touched) & set(child_folders(spark, f"{tmp_path}/t/data/version=0", "bucket"))


def test_outbox_of_many_small_batches(spark, tmp_path):
    rules = spark.createDataFrame([("r", "lead", "", "", "", 1)], schemas.NOTIFICATION_RULES)
    for n in range(12):
        # Each file brings two new events, and again one of each earlier file.
        rows = [note(f"e{n}-{k}", "25T10:00:00") for k in (0, 1)] + [note(f"e{m}-1", "24T10:00:00") for m in range(n)]
        land(tmp_path / "in", f"{n:02}.json", schemas.NOTIFICATIONS, rows)
        os.utime(tmp_path / "in" / f"{n:02}.json", (1_700_000_000 + n, 1_700_000_000 + n))  # the order of arrival
    stream = landed_json(spark, str(tmp_path / "in"), schemas.NOTIFICATIONS, files_per_batch=1)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    run(outbox.start_outbox(stream, rules, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    sent = outbox.read_outbox(spark, str(tmp_path / "out")).collect()
    assert sorted(r["event_id"] for r in sent) == sorted(f"e{n}-{k}" for n in range(12) for k in (0, 1))
    assert {r["created_at"].day for r in sent} == {25} and len({r["batch"] for r in sent}) == 12
    folders = [p for p in Path(tmp_path / "out").iterdir() if p.name.startswith("batch=")]
    assert len(folders) == 12 and all(len(list(p.glob("*.parquet"))) == 1 for p in folders)


def test_statuses_per_channel(spark, tmp_path):
    rng = random.Random(4)
    known = ["queued", "sent", "skipped", "error", "odd"]
    rows = [
        (rng.choice(["L1", "L2", "L3", "L4", None]), rng.choice(["crm", "telegram", "sheets", None]), rng.choice(known), f"2026-06-{rng.randint(1, 9):02}T10:00:00")
        for _ in range(60)
    ]
    rows += [("L9", "crm", "queued", "2026-06-01T10:00:00"), ("L9", "crm", "sent", "2026-06-01T10:00:00"), ("L9", "sheets", "error", None)]

    def once(name, part):
        land(tmp_path / "in", name, statuses.OUTCOMES, part)
        stream = landed_json(spark, str(tmp_path / "in"), statuses.OUTCOMES)
        run(statuses.start_statuses(stream, str(tmp_path / "s"), str(tmp_path / "cp"), buckets=8))

    # Late and repeated events, and a restart between batches.
    once("a.json", rows[30:])
    once("b.json", rows[:30] + rows[40:45])
    table = statuses.status_table(spark, str(tmp_path / "s"), 8)
    found = {tuple(r) for r in table.read().select(*statuses.LATEST.fieldNames()).collect()}
    batch = statuses.latest_outcomes(spark.read.schema(statuses.OUTCOMES).json(str(tmp_path / "in")))
    assert found == {tuple(r) for r in batch.select(*statuses.LATEST.fieldNames()).collect()}
    order = ["odd", "queued", "skipped", "error", "sent"]
    want = {}
    for lead, channel, status, time in rows:
        if lead and channel and time:
            want[lead, channel] = max(want.get((lead, channel), ("", 0, "")), (time, order.index(status), status))
    assert {(r["lead_id"], r["channel"]): r["status"] for r in table.read().collect()} == {k: v[2] for k, v in want.items()}
    wide = {r["lead_id"]: r for r in statuses.lead_statuses(table.read()).collect()}
    assert (wide["L9"]["crm_status"], wide["L9"]["telegram_status"], wide["L9"]["sheets_status"]) == ("sent", "queued", "queued")
