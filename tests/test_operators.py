import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from salesloom.operators import joins, ranking, upsert
from salesloom.operators.kpis import to_long


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows has one key, some keys and days are NULL."""
    rnd = random.Random(3)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rnd.randrange(200)}")
        date = None if i % 17 == 0 else f"2024-01-{1 + rnd.randrange(28):02d}"
        data.append((i, key, date))
    return spark.createDataFrame(data, "id int, key string, d string").withColumn("d", F.col("d").cast("date")).cache()


def test_number_in_group_equals_the_plain_window(hot):
    order = [F.col("d").asc_nulls_first(), F.col("id")]
    split = ranking.number_in_group(hot, ["key"], order, "n", bucket=F.col("d")).select("id", "n")
    plain = hot.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(*order))).select("id", "n")
    assert rows(split) == rows(plain)


def test_no_window_sees_a_whole_hot_key(hot):
    """Row windows are partitioned by key and bucket; key-wide windows only see bucket sizes."""
    df = ranking.number_in_group(hot, ["key"], [F.col("d").asc_nulls_first(), F.col("id")], "n", bucket=F.col("d"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    row_windows = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert row_windows and all("_bucket" in line.split("row_number()")[1] for line in row_windows)


def test_number_lines_equals_the_plain_window(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([7, 8, None]), i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, day int, o int, id int")
    order = [F.col(c).asc_nulls_first() for c in ("day", "o", "id")]
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    split = ranking.number_lines(df, "k", ("day", "o"), ["id"], "n")
    assert rows(split.select("id", "n")) == rows(plain.select("id", "n"))


def test_sequential_ids(spark):
    keys = [f"{random.Random(i).random():.12f}" for i in range(5000)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    found = {r["k"]: r["n"] for r in ranking.sequential_ids(df, "k", "n", side=4).collect()}
    assert found == {k: i for i, k in enumerate(sorted(keys), start=1)}


def test_sequential_ids_with_a_shared_prefix(spark):
    keys = ["the-same-20-letters-" + f"{random.Random(i).random():.12f}" for i in range(4000)] + ["", "a", "zz"]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k string").repartition(5)
    found = {r["k"]: r["n"] for r in ranking.sequential_ids(df, "k", "n", side=16).collect()}
    assert found == {None: 1, **{k: i for i, k in enumerate(sorted(keys), start=2)}}
    sizes = [r["count"] for r in ranking.key_ranges(df, "k", 16).groupBy("_range").count().collect()]
    assert len(sizes) == 256 and max(sizes) < 4004 / 25


@pytest.mark.parametrize("n", [0, 1, 3, 20])
def test_sequential_ids_of_few_keys(spark, n):
    df = spark.createDataFrame([(f"{i:03d}",) for i in range(n)], "k string")
    assert rows(ranking.sequential_ids(df, "k", "n", side=4)) == [(f"{i:03d}", i + 1) for i in range(n)]


def test_latest_and_first_filled(spark):
    df = spark.createDataFrame(
        [("a", 1, "", "x"), ("a", 2, "v2", "y"), ("a", 3, "v3", "z"), ("b", 1, " ", "q")],
        "k string, version int, value string, other string",
    )
    assert rows(ranking.latest_by(df, ["k"], ["version"])) == [("a", 3, "v3", "z"), ("b", 1, " ", "q")]
    first = df.groupBy("k").agg(ranking.first_filled("value", "version").alias("v"))
    assert rows(first) == [("a", "v2"), ("b", "")]


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_spread_join_equals_plain_join(hot, spark, how):
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4)], "key string, v int")
    heavy = joins.hot_keys(hot, "key", rows_per_task=50)
    plain = hot.join(lookup, "key", how)
    spread = joins.spread_join(hot, lookup, "key", how, hot=heavy)
    text = [F.col(c).cast("string") for c in plain.columns]
    filled = [F.coalesce(c, F.lit("-")) for c in text]
    assert rows(spread.select(*filled)) == rows(plain.select(*filled))


def test_hot_rows_are_spread_evenly(hot):
    heavy = joins.hot_keys(hot, "key", rows_per_task=50)
    salted = joins.salt_rows(hot, "key", heavy)
    sizes = [r["count"] for r in salted.groupBy("key", "_salt").count().collect()]
    assert max(sizes) <= 2 * 50
    assert salted.filter("key <> 'hot' AND _salt <> 0").count() == 0
    assert heavy.count() <= hot.count() / 50


def test_equal_copies_are_spread_too(spark):
    copies = spark.range(0, 2000, numPartitions=8).select(F.lit("same").alias("key"))
    salted = joins.salt_rows(copies, "key", joins.hot_keys(copies, "key", rows_per_task=100))
    assert salted.select("_salt").distinct().count() > 2 and salted.count() == 2000


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_limits(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _hot_fact(spark):
    return spark.range(0, 60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.sha1(F.col("id").cast("string")).alias("v")
    )


def test_aqe_splits_a_hot_key_of_a_plain_lookup(spark, small_limits):
    """The lookup join is left to Spark; with small limits its plan shows the split."""
    dim = spark.range(0, 60000, numPartitions=8).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    joined = joins.lookup_join(_hot_fact(spark), dim, ["k"])
    assert len(joined.collect()) == 60000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_aqe_splits_a_hot_key_beside_an_aggregate(spark, small_limits):
    fact = _hot_fact(spark)
    counts = fact.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = joins.shuffled_join(fact, counts, "k")
    assert joined.agg(F.sum("n")).first()[0] == 20001**2 + 39999 and joined.columns == ["k", "v", "n"]
    rows = joined.select("k", "v", "n")
    assert len(rows.collect()) == 60000
    assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()


def test_lookup_join_contract(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    good = spark.createDataFrame([("a", 10)], "k string, v int")
    assert joins.lookup_join(fact, good, ["k"], check=True).count() == 2
    with pytest.raises(Exception, match="duplicate keys"):
        joins.lookup_join(fact, good.union(good), ["k"], check=True).collect()
    assert [tuple(r) for r in joins.key_violations(good.union(good), ["k"], "dim").collect()] == [("dim", "a", 2)]


def haversine(a, b):
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(h, 1.0)))


@pytest.mark.parametrize("km", [30.0, 400.0, 3000.0])
def test_within_distance_equals_brute_force(spark, km):
    rnd = random.Random(5)
    spots = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(400)]
    spots += [(rnd.uniform(88, 90), rnd.uniform(-180, 180)) for _ in range(60)]
    spots += [(rnd.uniform(-1, 1), s * rnd.uniform(179, 180)) for s in (1, -1) for _ in range(40)]
    spots += [(55.0 + rnd.uniform(-0.3, 0.3), 37.0 + rnd.uniform(-0.5, 0.5)) for _ in range(200)]
    stops = [(55.0, 37.0), (0.0, 180.0), (0.0, -179.9), (89.9, 10.0), (-89.0, 0.0), (12.0, 12.0), (84.9, 100.0)]
    contacts = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)], "id int, lat double, lon double")
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(stops)], "stop int, lat double, lon double")
    found = rows(joins.within_distance(contacts, points, km).select("id", "point_stop"))
    expected = sorted((i, j) for i, p in enumerate(spots) for j, q in enumerate(stops) if haversine(p, q) <= km)
    assert found == expected and expected


def one_by_one(target, batch, update_cols):
    table = {r["k"]: dict(r) for r in target}
    for row in sorted(batch, key=lambda r: r["n"]):
        if row["k"] in table:
            table[row["k"]].update({c: row[c] for c in update_cols})
        else:
            table[row["k"]] = {c: v for c, v in row.items() if c != "n"}
    return sorted((r["k"], r["a"] or "", r["b"] or "") for r in table.values())


def test_upsert_equals_row_by_row(spark):
    target = [dict(k="1", a="a1", b="b1"), dict(k="2", a="a2", b="b2")]
    batch = [
        dict(k="2", a="x", b="y", n=5),
        dict(k="2", a="z", b=None, n=6),
        dict(k="3", a="new", b="first", n=7),
        dict(k="3", a="late", b="last", n=8),
    ]
    t = spark.createDataFrame([tuple(r.values()) for r in target], "k string, a string, b string")
    s = spark.createDataFrame([tuple(r.values()) for r in batch], "k string, a string, b string, n int")
    merged = upsert.upsert(t, s, "k", ["b"], order="n")
    found = sorted((r["k"], r["a"] or "", r["b"] or "") for r in merged.collect())
    assert found == one_by_one(target, batch, ["b"])
    again = upsert.upsert(merged, s, "k", ["b"], order="n")
    assert sorted((r["k"], r["a"] or "", r["b"] or "") for r in again.collect()) == found


def test_set_status_marks_every_row_of_an_id(spark):
    df = spark.createDataFrame([("e1", "queued"), ("e1", "queued"), ("e2", "queued")], "id string, status string")
    done = spark.createDataFrame([("e1",), ("e1",)], "id string")
    assert rows(upsert.set_status(df, done, "id", "sent")) == [("e1", "sent"), ("e1", "sent"), ("e2", "queued")]


def test_to_long(spark):
    row = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(to_long(row, ["a", "b"])) == [("a", 1.0), ("b", 2.0)]
