"""Lead forms of the site and the bot: validation, latest state, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import fixed_values as fv
from salesloom.functions.ids import row_id
from salesloom.functions.numbers import count_when
from salesloom.functions.text import digits_only, normalize_phone, or_label
from salesloom.operators.ranking import latest_by


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _length_ok(name: str) -> Column:
    shortest, longest = fv.LEAD_LENGTHS[name]
    return F.length(_text(name)).between(shortest, longest)


def _is_email(name: str, pattern: str) -> Column:
    return F.lower(F.trim(_text(name))).rlike(pattern)


def validate_leads(forms: DataFrame) -> DataFrame:
    """Site forms with the failed checks, a stable id and the initial statuses.

    The site takes well-formed addresses only; the bot's check is looser. ``errors`` names the fields that fail, in form order; a lead is valid when it is empty.
    The phone of a valid lead is normalised.
    """
    phone = normalize_phone("phone")
    checks = {
        "name": _length_ok("name"),
        "phone": _length_ok("phone") & (phone != ""),
        "email": _is_email("email", fv.STRICT_EMAIL_PATTERN),
        "service": _length_ok("service"),
        "comment": _length_ok("comment"),
    }
    errors = F.concat_ws(",", *[F.when(~ok, F.lit(field)) for field, ok in checks.items()])
    checked = forms.withColumn("errors", errors).withColumn("is_valid", errors == "")
    queued = F.when(F.col("is_valid"), "queued")
    return checked.withColumns(
        {
            "lead_id": row_id("L", "created_at", "form_id"),
            "phone": F.when(F.col("is_valid"), phone).otherwise(F.col("phone")),
            "status": F.when(F.col("is_valid"), "new").otherwise("rejected"),
            "crm_status": queued,
            "telegram_status": queued,
            "sheets_status": queued,
        }
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter("is_valid").drop("errors", "is_valid")


def quarantined(validated: DataFrame) -> DataFrame:
    return validated.filter("NOT is_valid")


def latest_leads(log: DataFrame) -> DataFrame:
    """The last appended row of every lead."""
    return latest_by(log, ["lead_id"], ["version"])


def site_daily(leads: DataFrame) -> DataFrame:
    grouped = leads.groupBy(F.to_date("created_at").alias("date"), "service", "utm_source").agg(
        F.count(F.lit(1)).alias("leads"), count_when(F.col("crm_status") == "sent").alias("sent_to_crm")
    )
    return grouped.orderBy(F.col("date").desc(), F.col("leads").desc(), "service", "utm_source")


def site_summary(leads: DataFrame) -> DataFrame:
    grouped = leads.dropna(subset=["service", "utm_source"]).groupBy("service", "utm_source")
    return grouped.agg(F.count("lead_id").alias("leads_count")).orderBy(
        F.col("leads_count").desc(), "service", "utm_source"
    )


def validate_bot_leads(leads: DataFrame, services: DataFrame) -> DataFrame:
    """Bot answers: trimmed, with defaults, and with the failed checks.

    The phone only needs 10 or 11 digits and is stored as typed; the service has to be in
    the catalogue.
    """
    catalogue = services.select("service").distinct().withColumn("_known", F.lit(True))
    cleaned = leads.withColumns({c: F.trim(_text(c)) for c in ("name", "phone", "service", "budget", "comment")})
    cleaned = cleaned.withColumns(
        {
            "email": F.lower(F.trim(_text("email"))),
            "status": or_label("status", "new"),
            "manager": or_label("manager", fv.NO_MANAGER),
            "source": F.lit("telegram_bot"),
        }
    )
    checks = {
        "service": F.coalesce(F.col("_known"), F.lit(False)),
        "phone": F.length(digits_only("phone")).isin(10, 11),
        "email": _is_email("email", fv.LOOSE_EMAIL_PATTERN),
    }
    errors = F.concat_ws(",", *[F.when(~ok, F.lit(field)) for field, ok in checks.items()])
    return (
        cleaned.join(catalogue, "service", "left")
        .withColumn("errors", errors)
        .withColumn("is_valid", F.col("errors") == "")
        .drop("_known")
    )


def bot_daily(leads: DataFrame) -> DataFrame:
    grouped = leads.groupBy(F.to_date("created_at").alias("date"), "service", "status").agg(
        F.count(F.lit(1)).alias("leads"), F.count_distinct("phone").alias("unique_contacts")
    )
    return grouped.orderBy(F.col("date").desc(), F.col("leads").desc(), "service", "status")


def bot_summary(leads: DataFrame) -> DataFrame:
    grouped = leads.dropna(subset=["service", "status"]).groupBy("service", "status")
    return grouped.agg(F.count("lead_id").alias("leads_count")).orderBy(
        F.col("leads_count").desc(), "service", "status"
    )


def bot_lead_messages(leads: DataFrame) -> DataFrame:
    """Text for the manager, one per lead."""
    fields = ("lead_id", "service", "budget", "name", "phone", "email", "comment")
    return leads.select("lead_id", F.format_string(fv.BOT_LEAD_TEXT, *fields).alias("message"))


def site_lead_messages(leads: DataFrame) -> DataFrame:
    text = F.format_string(
        fv.SITE_LEAD_TEXT,
        "lead_id", "service", "name", "phone", "email",
        or_label("comment", fv.NO_DATE),
        _text("utm_source"), _text("utm_medium"), _text("utm_campaign"),
        or_label("page_url", fv.NO_DATE),
    )
    return leads.select("lead_id", text.alias("message"))
