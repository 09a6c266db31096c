"""J1-J8 on the city / user / key-list fixtures (goldens G3-G7) and the skew paths."""

import random

from conftest import rows
from pyspark.sql import functions as F

from quern.operators import joins

# The city (F3), user (F4), key-list (F5), station (F6) and record (F7) fixtures.
CITY_NAMES = ["其他", "长春", "吉林", "四平", "松原", "通化", "辽源", "白城", "白山", "延吉"]
CITIES = [("0", CITY_NAMES[0], "0", "000", "0")] + [
    (str(i), CITY_NAMES[i], str(i), f"90{i}", "1") for i in range(1, 10)]
USERS = [("1", "2G", "123", "1"), ("2", "3G", "333", "2"), ("3", "3G", "555", "1"),
         ("4", "2G", "777", "3"), ("5", "3G", "666", "4")]
KEYS = ["1", "2", "3", "4"]
STATIONS = [("1", "湖北"), ("2", "湖南")]
RECORDS = [("1", "2018-05-25", "110"), ("1", "2018-05-26", "99"), ("1", "2018-05-27", "20"),
           ("2", "2018-05-25", "66"), ("2", "2018-05-26", "21"), ("2", "2018-05-27", "15")]
G3 = [("1", "长春", "1", "901", "1", "1", "2G", "123"), ("1", "长春", "1", "901", "1", "3", "3G", "555"),
      ("2", "吉林", "2", "902", "1", "2", "3G", "333"), ("3", "四平", "3", "903", "1", "4", "2G", "777"),
      ("4", "松原", "4", "904", "1", "5", "3G", "666")]
OUT = ["id", "name", "orderid", "city_code", "is_show", "userID", "network", "flow"]


def _tables(spark):
    left = spark.createDataFrame(CITIES, "id string, name string, orderid string, city_code string, is_show string")
    right = spark.createDataFrame(USERS, "userID string, network string, flow string, cityID string")
    keys = spark.createDataFrame([(k,) for k in KEYS], "join_key string")
    return left, right, keys


def test_inner_g3(spark):
    left, right, _ = _tables(spark)
    assert rows(joins.equi_join(left, right, "id", "cityID").select(*OUT)) == G3


def test_left_outer_g4(spark):
    left, right, _ = _tables(spark)
    out = rows(joins.equi_join(left, right, "id", "cityID", how="left").select(*OUT))
    assert rows(joins.equi_join(left, right, "id", "cityID", how="left", strategy="shuffle").select(*OUT)) == out
    assert len(out) == 11
    assert [r for r in out if r[5] is not None] == G3
    assert sorted(r[0] for r in out if r[5] is None) == ["0", "5", "6", "7", "8", "9"]


def test_lookup_g3_and_last_wins(spark):
    left, right, _ = _tables(spark)
    out = joins.lookup_join(right, left, "cityID", "id", ["name", "orderid", "city_code", "is_show"], order="name")
    assert rows(out.select(*OUT)) == G3
    dup = left.withColumn("ord", F.lit(0)).unionByName(
        spark.createDataFrame([("1", "新", "1", "901", "1", 1)],
                              "id string, name string, orderid string, city_code string, is_show string, ord int"))
    out = joins.lookup_join(right, dup, "cityID", "id", ["name"], order="ord")
    assert sorted(r.name for r in out.filter(F.col("id") == "1").collect()) == ["新", "新"]


def test_prefiltered_g3(spark):
    left, right, keys = _tables(spark)
    assert rows(joins.prefiltered_join(left, right, "id", "cityID", keys).select(*OUT)) == G3


def test_bloom_g5(spark):
    left, right, keys = _tables(spark)
    for exact in (True, False):
        out = joins.bloom_join(left.select("id", "name", "orderid"), right.select("cityID", "network", "flow"),
                               "id", "cityID", keys, exact=exact)
        assert rows(out.select("id", "name", "orderid", "network", "flow")) == [
            (g[0], g[1], g[2], g[6], g[7]) for g in G3]


def test_duplicate_left_id_multiplies(spark):
    left, right, keys = _tables(spark)
    left2 = left.unionByName(left.filter(F.col("id") == "1"))
    assert joins.equi_join(left2, right, "id", "cityID").count() == 7
    assert joins.prefiltered_join(left2, right, "id", "cityID", keys).count() == 7


def test_secondary_sort_g7(spark):
    st = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(STATIONS)] + [("3", "x", 9)],
                               "station_id string, station_name string, ord int")
    rec = spark.createDataFrame(RECORDS + [("9", "2018-01-01", "1")],
                                "station_id string, ts string, temperature string")
    expect = sorted((r[0], "湖北" if r[0] == "1" else "湖南", r[1], r[2]) for r in RECORDS)
    for strategy in ("auto", "window"):
        out = joins.secondary_sort_join(st, rec, "station_id", "station_id", ["station_name"],
                                        ["ts", "temperature"], dim_order="ord", strategy=strategy)
        assert rows(out) == expect
    # Two stations with one id: the first by order names the records and is never a record itself.
    st2 = st.unionByName(spark.createDataFrame([("1", "其他", 5)], st.schema))
    for strategy in ("auto", "window"):
        out2 = joins.secondary_sort_join(st2, rec, "station_id", "station_id", ["station_name"],
                                         ["ts", "temperature"], dim_order="ord", strategy=strategy)
        assert rows(out2) == expect


def test_secondary_sort_salted_equals_unsalted(spark):
    rnd = random.Random(3)
    facts = [(0 if rnd.random() < 0.6 else rnd.randint(1, 20), i) for i in range(500)]
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(0, 15)], "k long, name string")
    rec = spark.createDataFrame(facts, "fk long, v long")
    plain = joins.secondary_sort_join(dim, rec, "k", "fk", ["name"], ["v"])
    salted = joins.secondary_sort_join(dim, rec, "k", "fk", ["name"], ["v"], max_group_rows=20,
                                       strategy="window")
    expect = sorted((k, f"n{k}", v) for k, v in facts if k < 15)
    assert rows(plain) == expect
    assert rows(salted) == expect


def test_cogroup_g6(spark):
    left, right, _ = _tables(spark)
    out = joins.cogroup(left, right, "id", "cityID", ["name"], ["userID"], key_col="k").collect()
    assert {r.k: (r.n_left, r.n_right) for r in out} == {str(i): (1, {1: 2, 2: 1, 3: 1, 4: 1}.get(i, 0)) for i in range(10)}
    assert sorted((r.k, r.left_row.name) for r in out if r.side == 0) == sorted((c[0], c[1]) for c in CITIES)
    assert sorted((r.k, r.right_row.userID) for r in out if r.side == 1) == sorted((u[3], u[0]) for u in USERS)


def test_tagged_union(spark):
    st = spark.createDataFrame(STATIONS, "station_id string, station_name string")
    rec = spark.createDataFrame(RECORDS, "station_id string, ts string, temperature string")
    flow = joins.tagged_union(st, rec, "station_id", "station_id")
    assert flow.groupBy("tag").count().orderBy("tag").collect()[1]["count"] == 6
    assert flow.filter("tag = 0 and dim.station_name is null").count() == 0
