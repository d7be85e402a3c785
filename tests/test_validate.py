"""Validation operators on micro-frames: nulls, gaps on either side, empty tables."""

from pyspark.sql import functions as F

from weftline.operators import diagnostics as D
from weftline.operators import validate as V

INF, NAN = float("inf"), float("nan")


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_structural_suite(spark):
    h = spark.createDataFrame([(1, 2.0, 1, 5.0), (2, -1.0, 0, INF), (2, None, None, NAN), (None, 3.0, 2, 1.0)], "h int, w double, flag int, x double")
    p = spark.createDataFrame([(1, 1), (2, 9), (3, None), (3, 2)], "p int, h int")
    got = rows(V.structural(
        {"house": h, "person": p}, {"house": "h", "person": "p", "unit": "u"}, not_negative={"house": ["w"]}, finite={"house": ["x", "gone"]}, flags={"house": ["flag"]},
        parents=[("person", "h", "house"), ("person", "u", "unit")], ranges={("house", "w", "person"): (0.5, 1.5), ("house", "x", "person"): (0.0, 1.0), ("unit", "v", "person"): (0.0, 1.0)},
    ))
    assert got == {
        ("not negative house.w", "FAIL", 1), ("finite house.x", "FAIL", 2), ("finite house.gone", "SKIP", 0), ("flag house.flag", "FAIL", 2), ("unique house.h", "FAIL", 1), ("unique person.p", "FAIL", 1), ("unique unit.u", "SKIP", 0),
        ("person in house by h", "FAIL", 1), ("person in unit by u", "SKIP", 0), ("house.w per person", "PASS", 0), ("house.x per person", "WARN", 1), ("unit.v per person", "SKIP", 0),
    }
    empty = rows(V.structural({"house": h.where("false")}, {"house": "h"}, not_negative={"house": ["w"]}, ranges={("house", "w", "house"): (0.0, 1.0)}))
    assert empty == {("not negative house.w", "PASS", 0), ("unique house.h", "PASS", 0), ("house.w per house", "WARN", 1)}


def test_area_validation_and_additivity(spark):
    sim = spark.createDataFrame([(1, 10.0), (2, 99.0), (3, 5.0), (5, 0.0), (6, 1e9)], "a int, sim double")
    t = spark.createDataFrame([(1, "state", 10.5), (2, "state", 10.0), (4, "state", 1.0), (5, "state", 0.0), (6, "state", 1e9)], "a int, level string, target double")
    got = {r["a"]: (r["status"], r["in_training"]) for r in V.area_validation(sim, t, ["a"], {"state": 1e6}, F.col("a") > 4).collect()}
    assert got == {1: ("ok", False), 2: ("off", False), 3: ("missing", False), 4: ("missing", False), 5: ("ok", True), 6: ("implausible", True)}
    parts = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 1.0), (3, None)], "s int, v double")
    wholes = spark.createDataFrame([(1, 5.0), (2, 1.5), (4, 0.0)], "s int, v double")
    assert {r["s"]: (r["n_parts"], r["gap"], r["adds_up"]) for r in V.additive(parts, wholes, "s", "v").collect()} == {1: (2, 0.0, True), 2: (1, -0.5, False), 3: (1, 0.0, True), 4: (0, 0.0, True)}


def test_hierarchy_and_containment(spark):
    s = spark.createDataFrame([(1, None, "national", "US"), (2, 1, "state", "6"), (3, 2, "district", "601"), (4, 2, "district", "701"), (5, 1, "district", "602"), (6, 99, "state", "7")], "stratum_id int, parent_stratum_id int, geo_level string, geographic_id string")
    assert rows(V.hierarchy(s, {"national": 1, "state": 2, "district": 4}).select("geo_level", "n", "as_expected", "under_parent")) == {("national", 1, True, 1), ("state", 2, True, 1), ("district", 3, False, 1)}
    c = spark.createDataFrame([(2, "state_fips", "==", "06"), (2, "age", ">", "18.0"), (3, "congressional_district_geoid", "==", "0601"), (3, "age", ">", "18"), (4, "congressional_district_geoid", "==", "701"), (4, "age", ">=", "18")], "stratum_id int, variable string, operation string, value string")
    assert rows(V.containment(s, c).select("stratum_id", "variable", "problem")) == {(4, "state_fips", "district outside state"), (4, "age", "missing")}
    assert V.containment(s, c.where("false")).count() == 0


def test_contract_and_achievement(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, "y")], "k int, v string")
    assert rows(V.contract({"a": (a, "k"), "b": (a.where("k = 1"), "k")})) == {("a", "k", 3, 3, 2, False), ("a", "v", 2, 3, 2, False), ("b", "k", 1, 1, 1, True), ("b", "v", 1, 1, 1, True)}
    e = spark.createDataFrame([("c", 10.0, 11.0, 13.0), ("c", -10.0, -10.0, -10.0), ("c", 0.0, 1.0, 1.0), ("d", 5.0, None, 5.0)], "category string, target double, a double, b double")
    got = {r["category"]: (r["n"], r["share_a_better"], None if r["mean_gain"] is None else round(r["mean_gain"], 9)) for r in V.achievement(e).collect()}
    assert got == {"c": (2, 0.5, 0.1), "d": (1, None, None)}


def test_kendall_brute_force(spark):
    import math
    import random

    rnd = random.Random(1)
    v = [(float(rnd.randrange(8)), float(rnd.randrange(5))) for _ in range(80)]
    df = spark.createDataFrame([*v, (None, 1.0), (2.0, None)], "x double, y double")
    pairs = [((a[0] > b[0]) - (a[0] < b[0]), (a[1] > b[1]) - (a[1] < b[1])) for i, a in enumerate(v) for b in v[:i]]
    want = sum(p * q for p, q in pairs) / math.sqrt(sum(p != 0 for p, _ in pairs) * sum(q != 0 for _, q in pairs))
    assert abs(D.kendall(df, "x", "y", 50).first()[0] - want) < 1e-9
    assert D.kendall(df.where("x = 1"), "x", "y").first()[0] is None and D.kendall(df.where("false"), "x", "y").first()[0] is None
