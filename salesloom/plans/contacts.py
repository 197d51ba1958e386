"""Field-service contacts: ready rows, geocoder replies, upsert, clients nearby."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.operators.joins import within_distance
from salesloom.operators.upsert import upsert

_ADDRESS = ("area", "city", "street", "locality", "house", "build")
# Only the fields that are read; from_json skips everything else in the reply.
_REPLY = (
    "struct<response: struct<GeoObjectCollection: struct<featureMember: array<struct<GeoObject: struct<"
    "Point: struct<pos: string>, metaDataProperty: struct<GeocoderMetaData: struct<Address: struct<"
    "Components: array<struct<kind: string, name: string>>>>>>>>>>>"
)
# Columns that change for a known number; phone, city, street and house stay as stored.
UPDATED = (
    "name", "patronymic", "surname", "area", "locality", "build", "comment", "date_inst", "guarantee", "to1", "date_to",
    "lon", "lat", "district",
)


def ready_contacts(sheet: DataFrame) -> DataFrame:
    """Rows marked ready (in any case) with their address in one line."""
    address = F.concat_ws(", ", *[F.coalesce(F.col(c), F.lit("")) for c in _ADDRESS])
    return sheet.filter(F.lower("status") == "ready").withColumn("address", address)


def _parts(pos: Column) -> Column:
    return F.filter(F.split(F.trim(pos), r"\s+"), lambda part: part != "")


def with_location(df: DataFrame, reply: str = "geocoder_reply") -> DataFrame:
    """Longitude, latitude and district of the first hit.

    All three are NULL when the reply is broken, has no hit, or lacks a position of exactly
    two parts or the address components. The one-element ``explode`` keeps the parsed hit as
    a column of its own; otherwise a filter on the position would parse the reply again.
    """
    hit = F.get(F.from_json(F.col(reply), _REPLY)["response"]["GeoObjectCollection"]["featureMember"], F.lit(0))
    df = df.withColumn("_hit", F.explode(F.array(hit["GeoObject"])))
    pos = _parts(F.col("_hit.Point.pos"))
    components = F.col("_hit.metaDataProperty.GeocoderMetaData.Address.Components")
    usable = (F.size(pos) == 2) & components.isNotNull()
    district = F.get(F.filter(components, lambda c: c["kind"] == "area"), F.lit(0))["name"]
    return df.withColumns(
        {
            "lon": F.when(usable, F.get(pos, F.lit(0)).try_cast("double")),
            "lat": F.when(usable, F.get(pos, F.lit(1)).try_cast("double")),
            "district": F.when(usable, district),
        }
    ).drop("_hit")


def located(ready: DataFrame) -> DataFrame:
    """Ready rows with a position; the others wait for the next run."""
    return with_location(ready).filter("lon IS NOT NULL AND lat IS NOT NULL")


def upsert_contacts(target: DataFrame, sheet: DataFrame) -> DataFrame:
    """Store located ready rows; the last row of a number wins."""
    batch = located(ready_contacts(sheet)).select(*target.columns, "row_no")
    return upsert(target, batch, "number", UPDATED, order="row_no")


def contacts_nearby(
    contacts: DataFrame,
    stops: DataFrame,
    km: float,
    city: str | None = None,
    district: str | None = None,
    phone: str | None = None,
) -> DataFrame:
    """Contacts within ``km`` of a route stop, optionally of one city, district or phone."""
    for column, wanted in (("city", city), ("district", district), ("phone", phone)):
        if wanted is not None:
            contacts = contacts.filter(F.col(column) == wanted)
    near = within_distance(contacts.filter("lat IS NOT NULL AND lon IS NOT NULL"), stops, km)
    return near.drop("point_lat", "point_lon")
