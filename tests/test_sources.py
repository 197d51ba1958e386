import json

import pytest
from pyspark.errors import AnalysisException

from salesloom import schemas
from salesloom.sources import files, sinks
from tests.conftest import day, moment


def test_csv_values_that_do_not_parse(spark, tmp_path):
    path = tmp_path / "ads.csv"
    path.write_text("campaign,date,source,impressions,clicks,cost,leads,orders,revenue\nx,2026-06-25,s,10,oops,1.5,,2,3\ny,bad,s,,1,,,,\n")
    filled = ("impressions", "clicks", "cost", "leads", "orders", "revenue")
    rows = {r["campaign"]: r for r in files.read_csv(spark, str(path), schemas.ADS_DAILY, zero_fill=filled).collect()}
    assert (rows["x"]["date"], rows["x"]["clicks"], rows["x"]["cost"], rows["x"]["leads"]) == (day("2026-06-25"), 0, 1.5, 0)
    assert (rows["y"]["date"], rows["y"]["impressions"], rows["y"]["clicks"]) == (None, 0, 1)


def test_csv_with_other_columns_is_read_by_name(spark, tmp_path):
    path = tmp_path / "leads.csv"
    path.write_text("extra,phone,lead_id\n1,+79991234567,L-1\n")
    row = files.read_csv(spark, str(path), schemas.BOT_LEADS).first()
    assert (row["lead_id"], row["phone"], row["email"]) == ("L-1", "+79991234567", None)


def test_csv_timestamp_format(spark, tmp_path):
    path = tmp_path / "crm.csv"
    path.write_text("request_id,created_at\n1,2026-06-25 09:05\n2,\n3,soon\n")
    rows = files.read_csv(spark, str(path), schemas.CRM_REQUESTS, timestamp_format="yyyy-MM-dd HH:mm").collect()
    assert [r["created_at"] for r in rows] == [moment("2026-06-25T09:05"), None, None]


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_csv(spark, str(tmp_path / "none.csv"), schemas.FAQ)


def test_json_records_and_date_slice(spark, tmp_path):
    records = [
        {"lead_id": "1", "created_at": "2026-06-24T23:59:59", "channel": "a", "campaign": "b", "status": "won", "order_id": ""},
        {"lead_id": "2", "created_at": "2026-06-25T23:59:59", "channel": "a", "campaign": "b", "status": "new"},
        {"lead_id": "3", "created_at": "2026-06-26T00:00:00", "channel": "a", "campaign": "b", "status": "new"},
    ]
    (tmp_path / "leads.json").write_text(json.dumps(records))
    df = files.read_json_records(spark, str(tmp_path / "leads.json"), schemas.CRM_LEADS)
    assert [r["lead_id"] for r in files.date_slice(df, "created_at", "2026-06-25", "2026-06-25").collect()] == ["2"]
    assert files.default_report_date(df, "created_at") == day("2026-06-26")


def test_date_slice_on_dates(spark):
    df = spark.createDataFrame([(day("2026-06-24"),), (day("2026-06-25"),)], "d date")
    assert files.date_slice(df, "d", "2026-06-25", "2026-06-30").count() == 1


def test_descriptions_are_column_metadata():
    described = schemas.described(schemas.AD_SPEND, {"cost": "spend"})
    assert described["cost"].metadata == {"description": "spend"} and described["clicks"].metadata == {}


def test_monthly_table_round_trip_and_pruning(spark, tmp_path):
    path = str(tmp_path / "mart")
    data = [(day(f"2026-{m:02d}-{d:02d}"), f"k{d % 5}", d) for m in (5, 6, 7) for d in range(1, 29)]
    df = spark.createDataFrame(data, "date date, k string, v int")
    sinks.write_monthly(df, path, "date", ["k", "date"])
    read = sinks.read_monthly(spark, path, "date", "2026-06-10", "2026-06-12")
    assert sorted(r["v"] for r in read.collect()) == [10, 11, 12]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "2026-06" in plan
    sinks.write_monthly(df.filter("date < '2026-06-01'").limit(1), path, "date", ["k"])
    months = {r["month"]: r["count"] for r in spark.read.parquet(path).groupBy("month").count().collect()}
    assert months == {"2026-05": 1, "2026-06": 28, "2026-07": 28}


def test_report_per_date_is_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "report")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    sinks.write_report(df, path, "2026-06-24")
    sinks.write_report(df, path, "2026-06-25")
    sinks.write_report(df.limit(1), path, "2026-06-25")
    counts = {str(r["report_date"]): r["count"] for r in spark.read.option("header", True).csv(path).groupBy("report_date").count().collect()}
    assert counts == {"2026-06-24": 2, "2026-06-25": 1}


def test_csv_sink_and_append_log(spark, tmp_path):
    df = spark.createDataFrame([("Кириллица, да", 1)], "k string, v int")
    sinks.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first()["k"] == "Кириллица, да"
    sinks.append_log(df, str(tmp_path / "log"))
    sinks.append_log(df.select("v", "k"), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).filter("k LIKE 'К%'").count() == 2
