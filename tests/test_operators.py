"""Micro-frames for the operators' stated semantics."""

import pytest
from pyspark.sql import functions as F

from weftline.functions import exprs as X
from weftline.operators import entities as E
from weftline.operators import impute as I
from weftline.operators import joins as J
from weftline.operators import solve as S
from weftline.operators import takeup as TK
from weftline.operators import targets as T

c = F.col


def one(spark, col, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")]).select(col).first()[0]


def test_constraints(spark):
    assert one(spark, X.constraint(c("a"), "==", "5.0"), a=5) is True
    assert one(spark, X.constraint(c("a"), "==", "True"), a=True) is True
    assert one(spark, X.constraint_words(c("a"), "in", "x|y"), a="y") is True
    assert one(spark, X.conjunction([("missing", ">", "1")], ["a"]), a=1) is False
    assert one(spark, X.conjunction([], ["a"]), a=1) is True
    with pytest.raises(ValueError):
        X.constraint(c("a"), "~", "1")


def test_household_passes_only_if_one_person_meets_all(spark):
    p = spark.createDataFrame([(1, 1, 30, "R"), (1, 1, 50, "N"), (2, 2, 50, "R"), (3, 3, None, "R")], "household_id int, unit_id int, age int, flag string").withColumn("v", F.lit(10.0))
    cond = X.conjunction([("age", ">", "40"), ("flag", "==", "R")], p.columns)
    got = {r["household_id"]: r["contribution"] for r in E.target_values(p, cond, "household_id", "household_id", c("v")).collect()}
    assert got == {1: 0.0, 2: 10.0, 3: 0.0}
    assert {r["household_id"]: r["contribution"] for r in E.target_values(p, cond, None, "household_id").collect()} == {1: 0.0, 2: 1.0, 3: 0.0}


def test_targets_together_equal_targets_alone(spark):
    p = spark.createDataFrame([(i % 7, i % 20, 20 + i % 50, float(i % 11)) for i in range(200)] + [(8, 99, None, None)], "household_id int, unit_id int, age int, v double")
    specs = [("a", c("age") > 60, "household", c("v")), ("b", c("age") > 65, "unit", c("v")), ("c", c("age") > 65, "unit", None), ("d", c("age") > 65, "person", None)]
    both = {(r["target"], r["household_id"]): r["contribution"] for r in E.targets_together(p, "unit_id", "household_id", specs).collect()}
    for t, cond, level, v in specs:
        alone = E.target_values(p, cond, {"household": "household_id", "unit": "unit_id", "person": None}[level], "household_id", v)
        assert {r["household_id"]: r["contribution"] for r in alone.collect()} == {h: x for (n, h), x in both.items() if n == t}


def test_bands_codes_and_labels(spark):
    assert one(spark, X.band(c("x"), [0, 10, 20], ["a", "b"]), x=10.0) == "b"
    assert one(spark, X.band(c("x"), [0, 10, 20], ["a", "b"]), x=99.0) == "b"
    assert one(spark, X.recode(c("x"), {1: "a"}, "z"), x=2) == "z"
    assert one(spark, X.amount_label(c("x")), x=2_500_000.0) == "2m"
    assert one(spark, X.amount_label(c("x")), x=float("-inf")) == "-inf"
    assert one(spark, X.guarded_ratio(c("a"), c("b"), 0.5, 1.5), a=9.0, b=0.0) == 1.0
    assert one(spark, X.severity(c("x")), x=float("nan")) == "ok"
    assert one(spark, X.relative_error_inf(c("e"), c("t")), e=3.0, t=0.0) == float("inf")
    assert tuple(spark.range(1).select(*X.ucgid_parts(F.lit("5001800US1198"))).first()) == ("district", 11, 1101)


def test_string_hash_is_stable(spark):
    got = [r[0] for r in spark.createDataFrame([("",), ("snap",), (None,)], "s string").select(X.string_hash("s")).collect()]
    assert got[0] == "0" and got[2] is None and 0 <= int(got[1]) < 1 << 64


def test_best_period_prefers_the_latest_up_to_then_the_earliest(spark):
    t = spark.createDataFrame([("a", 2022), ("a", 2023), ("a", 2026), ("b", 2025), ("b", 2027), (None, 2020)], "k string, y int")
    assert sorted((r["k"] or "", r["y"]) for r in T.best_period(t, ["k"], "y", F.lit(2024)).collect()) == [("", 2020), ("a", 2023), ("b", 2025)]


def test_reconcile_and_rescale(spark):
    rows = [("d", "v", "state", 1, None, 30.0), ("d", "v", "district", 1, 101, 5.0), ("d", "v", "district", 1, 102, 15.0), ("d", "v", "district", 2, 201, 7.0)]
    df = spark.createDataFrame(rows, "domain string, variable string, geo_level string, state int, district int, value double")
    assert {r["district"]: r["reconciled"] for r in T.reconcile(df).collect()} == {101: 7.5, 102: 22.5, 201: 7.0}
    kids = df.where("geo_level = 'district'")
    assert {r["district"]: r["rescaled"] for r in T.rescale_children(df.where("geo_level = 'state'"), kids, ["state"]).collect()} == {101: 7.5, 102: 22.5, 201: 7.0}


def test_rules_upsert_and_create(spark):
    t = spark.createDataFrame([("a", "s"), ("a", "n"), ("b", "s"), ("c", None)], "variable string, geo_level string")
    assert T.include_exclude(t).count() == 4
    assert T.include_exclude(t, [{"variable": "a"}, {"geo_level": None}], [{"geo_level": "n"}]).count() == 2
    assert sorted(map(tuple, T.upsert(t, spark.createDataFrame([("b", "new")], t.schema), ["variable"]).collect()), key=str) == sorted([("a", "s"), ("a", "n"), ("c", None), ("b", "new")], key=str)
    assert T.get_or_create(t, spark.createDataFrame([("a", "x"), ("d", "x"), ("d", "y")], t.schema), "variable").count() == 5


def test_reported_first_reaches_the_rate(spark):
    df = spark.createDataFrame([(i, i < 2, i / 10, "g", 0.5) for i in range(10)] + [(10, None, 0.99, "h", 0.0)], "i int, rep boolean, draw double, g string, rate double")
    got = {r["i"] for r in TK.reported_first(df, "draw", "rate", "rep", ["g"]).where("takes_up").collect()}
    assert got == {0, 1, 2, 3}  # 3 of 8 others: draw < 0.375


def test_band_join_meets_overlapping_and_open_bands(spark):
    inf = float("inf")
    b = spark.createDataFrame([("low", -inf, 0.0), ("a", 0.0, 10.0), ("b", 5.0, 25.0), ("top", 20.0, inf)], "n string, lo double, hi double")
    x = spark.createDataFrame([(v,) for v in (-3.0, 0.0, 5.0, 10.0, 24.9, 25.0, None)], "v double")
    got = sorted((r["v"], r["n"]) for r in J.band_join(x, b, c("v"), "lo", "hi", 5.0).collect())
    assert got == [(-3.0, "low"), (0.0, "a"), (5.0, "a"), (5.0, "b"), (10.0, "b"), (24.9, "b"), (24.9, "top"), (25.0, "top")]
    wide = spark.createDataFrame([("w", -1e6, 1e6), ("tiny", 5.0, 5.0 + 1e-9), ("empty", 7.0, 7.0), ("all", None, None)], "n string, lo double, hi double")
    got = sorted((r["v"], r["n"]) for r in J.band_join(x, wide, c("v"), "lo", "hi", 0.001).collect())
    assert got == sorted([(v, n) for v in (-3.0, 0.0, 5.0, 10.0, 24.9, 25.0) for n in ("all", "w")] + [(5.0, "tiny")])
    with pytest.raises(ValueError):
        J.checked_join(spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1,)], "k int"), "k")


def test_filing_units_pair_children_and_reference_person(spark):
    rows = [(1, 1, 2, None, 40), (1, 2, 1, None, 42), (1, 3, None, 1, 9), (1, 4, 1, None, 20), (2, 1, None, None, 12), (2, 2, None, 9, 11)]
    df = spark.createDataFrame(rows, "h int, l int, s int, p int, a int")
    got = {(r["h"], r["l"]): (r["unit_line"], r["role"]) for r in I.filing_units(df, "h", "l", "s", "p", "a").collect()}
    assert got == {(1, 1): (2, "spouse"), (1, 2): (2, "head"), (1, 3): (2, "dependant"), (1, 4): (4, "head"), (2, 1): (1, "head"), (2, 2): (2, "head")}


def test_project_to_bounds_and_allocate(spark):
    df = spark.createDataFrame([(1, "g", 5.0, 1.0), (2, "g", 9.0, 2.0), (3, "g", 0.0, 1.0)], "i int, g string, v double, w double").withColumns({"t": F.lit(40.0), "lo": F.lit(0.0), "hi": F.lit(12.0)})
    out = I.project_to_bounds(df, ["g"], "v", "w", "t", "lo", "hi")
    assert abs(out.agg(F.sum(c("v") * c("w"))).first()[0] - 40.0) < 1e-6 and out.where("v < 0 OR v > 12").count() == 0
    a = {r["i"]: r["allocated"] for r in I.allocate(df, ["g"], "v", "w", "t").collect()}
    assert abs(a[1] + 2 * a[2] + a[3] - 40) < 1e-9 and a[3] == 0.0


def test_bounds_that_cannot_meet_a_total_leave_a_residual(spark):
    rows = [(1, "a", 5.0, 1.0, 100.0), (2, "a", 9.0, 2.0, 100.0), (3, "b", 0.0, 1.0, 7.0), (4, "b", 0.0, 1.0, 7.0), (5, "c", None, 1.0, -3.0), (6, "d", 50.0, 0.0, 4.0), (7, "e", 2.0, 1.0, None)]
    df = spark.createDataFrame(rows, "i int, g string, v double, w double, t double").withColumns({"lo": F.lit(0.0), "hi": F.lit(12.0)})
    out = {r["i"]: (r["v"], r["residual"]) for r in I.project_to_bounds(df, ["g"], "v", "w", "t", "lo", "hi").collect()}
    assert out[1] == (12.0, 64.0) and out[2] == (12.0, 64.0)  # 100 wanted, 36 possible
    assert abs(out[3][0] - 3.5) < 1e-6 and abs(out[3][1]) < 1e-6
    assert out[5] == (0.0, -3.0) and out[6] == (12.0, 4.0) and out[7][0] == 2.0
    many = spark.range(60).select(F.lit("g").alias("g"), F.pow(F.lit(1.7), F.col("id") % 30).alias("v"), F.lit(1.0).alias("w"), F.lit(0.0).alias("lo"), (1 + 3 * F.pow(F.lit(1.5), F.col("id") % 30)).alias("hi"))
    most = many.agg(F.sum("hi")).first()[0]
    got = I.project_to_bounds(many.withColumn("t", F.lit(most * 0.999)), ["g"], "v", "w", "t", "lo", "hi").agg(F.max(F.abs("residual")), F.max(c("v") - c("hi"))).first()
    assert got[0] < 1e-5 and got[1] <= 1e-9


def test_tilted_draws_follow_weight_times_tilt(spark):
    """Frequencies with small tilts, where hardly any draw is kept, and with some kept: both ends are exact."""
    donors = spark.createDataFrame([(k, "g", float(1 + k % 3), float(k)) for k in range(20)] + [(99, "h", 0.0, 1.0), (98, "g", 0.0, 1.0)], "did long, g string, w double, x double")
    rows = spark.range(6000).select(c("id").alias("rid"), F.lit("g").alias("g")).unionByName(spark.createDataFrame([(-1, "h"), (-2, "none")], "rid long, g string"))
    for scale in (1e-5, 0.02):
        tilt = scale * (1 + c("x") % 4) / 4
        got = {r["did"]: r["n"] for r in I.draw_tilted(rows, donors, "rid", "did", "g", "w", tilt).groupBy("did").agg(F.count(F.lit(1)).alias("n")).collect()}
        mass = {k: (1 + k % 3) * (1 + k % 4) for k in range(20)}
        assert sum(got.values()) == 6000 and got.keys() <= mass.keys()
        chi = sum((got.get(k, 0) - 6000 * m / sum(mass.values())) ** 2 / (6000 * m / sum(mass.values())) for k, m in mass.items())
        assert chi < 45  # 19 degrees of freedom: one in a thousand is beyond 43.8


def test_weighted_draws_with_tiny_and_many_donors(spark):
    donors = spark.createDataFrame([(k, 1e-12 if k % 2 else 3.0) for k in range(3000)], "did long, w double")
    got = I.draw_weighted(spark.range(5000), donors, "did", "w", X.hash_uniform("id"))
    assert got.count() == got.select("id").distinct().count() == 5000
    per = got.groupBy("did").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)), F.max("n"), F.max(c("did") % 2)).first()
    assert per[0] > 1300 and per[1] < 20 and per[2] == 0


def test_places_without_repeat_when_one_option_holds_all_weight(spark):
    from weftline.operators import clone as C

    options = spark.createDataFrame([(1, 1.0), (2, 1e-9), (3, 3e-9), (4, 0.0), (5, 1e-9)], "o long, w double")
    got = C.draw_without_repeat(spark.range(2000).withColumnRenamed("id", "r"), options, "r", "o", "w", 3).collect()
    per = {}
    for x in got:
        per.setdefault(x["r"], {})[x["clone"]] = x["o"]
    assert len(per) == 2000 and all(len(set(v.values())) == 3 and set(v) == {0, 1, 2} and v[0] == 1 for v in per.values())
    second = [v[1] for v in per.values()]
    assert abs(second.count(3) / 2000 - 0.6) < 0.05 and 4 not in second
    with pytest.raises(ValueError):
        C.draw_without_repeat(spark.range(2).withColumnRenamed("id", "r"), options, "r", "o", "w", 5)


def test_donor_sampling_with_and_without_replacement(spark):
    d = spark.createDataFrame([(i, "a", float(i), 10.0) for i in range(6)] + [(10, "b", 1.0, 1.0), (11, "b", 2.0, 1.0)], "i long, b string, score double, amt double")
    p = I.donor_probabilities(d.withColumn("t", F.lit(10.0)), "b", "score", "amt", "t")
    assert all(abs(r["s"] - 1) < 1e-9 for r in p.groupBy("b").agg(F.sum("probability").alias("s")).collect())
    s = I.sample_donors(p, "b", "i", "probability", F.lit(4), X.hash_uniform("i")).collect()
    a, b = [r["i"] for r in s if r["b"] == "a"], [r["i"] for r in s if r["b"] == "b"]
    assert len(a) == len(set(a)) == 4 and len(b) == 4 and set(b) <= {10, 11}


def test_signatures():
    assert S.compare_signatures({"a": 1, "b": 2}, {"a": 1, "b": 3, "n": 0}, ("b",)) == {"fatal": ["b"], "soft": ["n"]}
