"""Joins with a cardinality contract, with hot keys, and by distance."""

from __future__ import annotations

from collections.abc import Sequence
from math import degrees, pi, sin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A task should not have to hold more rows of one key than this.
ROWS_PER_TASK = 2_000_000
EARTH_RADIUS_KM = 6371.0


def key_violations(dim: DataFrame, on: Sequence[str], lookup: str) -> DataFrame:
    """Keys that occur more than once: ``(lookup, lookup_key, copies)``."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in on]).alias("lookup_key")
    return (
        dim.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select(F.lit(lookup).alias("lookup"), key, "copies")
    )


def lookup_join(fact: DataFrame, dim: DataFrame, on: Sequence[str], check: bool = False) -> DataFrame:
    """Left many-to-one join.

    No broadcast is forced: Spark broadcasts ``dim`` when its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges otherwise, where AQE splits
    the partitions of hot keys in ``fact`` (see ``session.tune``). With ``check`` a key that occurs twice in ``dim``
    fails the job that reads the lookup; nothing runs before. NULL keys match nothing and may repeat.
    """
    if check:
        dim = one_row_a_key(dim, on)
    return fact.join(dim, list(on), "left")


def one_row_a_key(dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with a complete key; a key that occurs twice fails the job that reads them."""
    rest = [c for c in dim.columns if c not in on]
    complete = F.lit(True)
    for c in on:
        complete = complete & F.col(c).isNotNull()
    found = dim.filter(complete).groupBy(*on).agg(F.count(F.lit(1)).alias("_copies"), F.first(F.struct(*rest)).alias("_row"))
    twice = F.concat_ws(" ", F.lit(f"lookup has duplicate keys on {list(on)}:"), *[F.col(c).cast("string") for c in on])
    row = F.when(F.col("_copies") > 1, F.raise_error(twice)).otherwise(F.col("_row"))
    return found.select(*on, row.alias("_row")).select(*on, *[F.col("_row")[c].alias(c) for c in rest])


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows and the number of parts to split them in.

    At most ``rows / rows_per_task`` keys qualify, so the result is small by construction:
    10^12 rows give no more than half a million keys.
    """
    return hot_from_counts(df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")), key, "_rows", rows_per_task)


def hot_from_counts(counts: DataFrame, key: str, rows: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The same from counts per key that the caller needs anyway."""
    hot = counts.filter(F.col(rows) > rows_per_task)
    parts = F.ceil(F.col(rows) / rows_per_task).cast("int")
    return hot.select(F.col(key).alias("_hot_key"), parts.alias("_parts"))


def _with_parts(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    return df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot_key")), "left").drop("_hot_key")


def salt_rows(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Spread the rows of hot keys: adds ``_salt`` (0 for all other keys).

    The salt depends on the row and its input partition. So equal copies of a row are
    spread as well, and a task that runs again gives every row the same salt as before.
    """
    placed = df.withColumn("_place", F.spark_partition_id())
    row = F.xxhash64(*[F.col(c) for c in placed.columns])
    salt = F.coalesce(F.pmod(row, F.col("_parts")).cast("int"), F.lit(0))
    return _with_parts(placed, key, hot).withColumn("_salt", salt).drop("_parts", "_place")


def fan_out(lookup: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Repeat the lookup rows of hot keys once per salt: adds ``_salt``."""
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    return _with_parts(lookup, key, hot).withColumn("_salt", F.explode(salts)).drop("_parts")


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "left",
    extra_on: Sequence[str] = (),
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join that splits keys with very many rows on the left side.

    AQE splits a skewed partition only when both sides of the join are plain shuffles. Use
    this one where a side is an aggregate or another join on the same key. ``hot`` is the result of
    ``hot_keys``; one that was counted on the source table serves all joins of a chain.
    """
    hot = hot_keys(left, on) if hot is None else hot
    joined = salt_rows(left, on, hot).join(fan_out(right, on, hot), [on, *extra_on, "_salt"], how)
    return joined.drop("_salt")


def shuffled_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Equi-join whose hot keys AQE may split also where a side is an aggregate on the key.

    Spark would keep an aggregate's partitioning, which can't be split. A second key, the hash of the
    first, has both sides shuffled plainly, and nothing is counted beforehand. Still Spark broadcasts a
    side that is small at run time.
    """
    same = F.xxhash64(on).alias("_same")
    return left.select("*", same).join(right.select("*", same), [on, "_same"], how).drop("_same")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def within_distance(contacts: DataFrame, points: DataFrame, km: float) -> DataFrame:
    """Contacts at most ``km`` from a point, with ``distance_km``.

    The globe is cut in bands of ``km`` along the latitude, and each band in cells at least
    ``km`` wide (one cell near a pole). A contact has one cell; a point is repeated for its
    own and the cells around it, so the join is an equi-join on the cell and contacts are
    never repeated. Longitudes wrap at 180 degrees.
    """
    band_deg = degrees(km / EARTH_RADIUS_KM)
    half_chord = sin(km / (2 * EARTH_RADIUS_KM))

    def band_of(lat: Column) -> Column:
        return F.floor(lat / F.lit(band_deg)).cast("long")

    def cells_in(band: Column) -> Column:
        # The edge farthest from the equator, one band further out for a neighbour.
        edge = (F.greatest(F.abs(band), F.abs(band + 1)) + 1) * F.lit(band_deg)
        narrow = F.cos(F.radians(F.least(edge, F.lit(90.0))))
        width = 2 * F.asin(F.least(F.lit(half_chord) / F.greatest(narrow, F.lit(1e-9)), F.lit(1.0)))
        return F.greatest(F.floor(F.lit(0.999 * 2 * pi) / width), F.lit(1)).cast("long")

    def cell_of(lon: Column, cells: Column) -> Column:
        turn = F.pmod(lon + F.lit(180.0), F.lit(360.0)) / F.lit(360.0)
        return F.least(F.floor(turn * cells), cells - 1).cast("long")

    left = contacts.withColumn("_band", band_of(F.col("lat")))
    left = left.withColumn("_cell", cell_of(F.col("lon"), cells_in(F.col("_band"))))

    right = points.select(*[F.col(c).alias(f"point_{c}") for c in points.columns])
    own = band_of(F.col("point_lat"))
    right = right.withColumn("_band", F.explode(F.sequence(own - 1, own + 1)))
    right = right.withColumn("_cells", cells_in(F.col("_band")))
    here = cell_of(F.col("point_lon"), F.col("_cells"))
    around = F.array(*[F.pmod(here + F.lit(step), F.col("_cells")) for step in (-1, 0, 1)])
    right = right.withColumn("_cell", F.explode(F.array_distinct(around))).drop("_cells")

    distance = haversine_km(F.col("lat"), F.col("lon"), F.col("point_lat"), F.col("point_lon"))
    return (
        left.join(right, ["_band", "_cell"])
        .withColumn("distance_km", distance)
        .filter(F.col("distance_km") <= F.lit(float(km)))
        .drop("_band", "_cell")
    )
