"""Queries that must treat all rows, against an independent computation over the whole tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import connect, differences
from tests.conftest import SF
from weftline.operators import joins, matrix, solve
from weftline.plans import geography, joining, solving

QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


_PERSON = "WITH person AS (SELECT l_orderkey AS unit_id, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp, l_quantity AS age, l_extendedprice AS gross, l_extendedprice * (1 - l_discount) AS earnings, l_returnflag AS flag, l_linestatus AS linestatus FROM lineitem JOIN orders ON o_orderkey = l_orderkey) "


def test_caps_apply_to_every_person(spark, con):
    sql = _PERSON + "SELECT unit_id, line, part, supp, age, CASE WHEN flag = 'N' THEN 0 ELSE least(greatest(earnings * 0.25, 0), CASE WHEN age >= 50 THEN 7500 ELSE 6500 END) END AS capped FROM person"
    assert differences(QUERIES["im5_caps"](spark, SF), con, sql) == []


def test_splits_apply_to_every_person(spark, con):
    sql = _PERSON + """SELECT unit_id, line, part, supp, age, earnings * 0.75::DOUBLE AS taxable, earnings * 0.25::DOUBLE AS exempt,
    (CASE WHEN flag = 'R' THEN age ELSE 0 END) + (CASE WHEN linestatus = 'R' THEN gross ELSE 0 END) AS coded,
    least(earnings, 20000) AS pool1, least(greatest(earnings - least(earnings, 20000), 0), 15000) AS pool2 FROM person"""
    assert differences(QUERIES["q12_q13_q14_splits"](spark, SF), con, sql) == []


def test_nearest_donor_among_all_other_parts(spark, con):
    """Brute force over all pairs of a kind."""
    import numpy as np

    rows = con.execute("SELECT p_partkey, split_part(p_type, ' ', 1), p_size, p_retailprice FROM part").fetchall()
    v = np.array([r[2:] for r in rows], float)
    v = (v - v.mean(axis=0)) / v.std(axis=0)
    got = {r["rid"]: r["distance"] for r in QUERIES["j22_nearest_donor"](spark, SF).collect()}
    assert set(got) == {r[0] for r in rows}
    for i, (part, kind, *_) in enumerate(rows):
        others = [j for j, r in enumerate(rows) if j != i and r[1] == kind] or [j for j in range(len(rows)) if j != i]
        assert abs(got[part] - min(((v[j] - v[i]) ** 2).sum() for j in others)) < 1e-7


def test_lone_row_of_a_group_meets_all_others(spark):
    d = spark.createDataFrame([(1, "x", 0.0), (2, "x", 5.0), (3, "x", 6.0), (4, "y", 4.0)], "id long, g string, a double")
    got = {r["rid"]: r["did"] for r in joins.nearest_donors(d, d, "id", "id", {"a": 1.0}, "g", standardise=False, block=1, others=True).collect()}
    assert got == {1: 2, 2: 3, 3: 2, 4: 2}


def test_every_place_value_counts(spark, con):
    sql = """SELECT DISTINCT l_partkey AS record, c_nationkey AS district, round(coalesce(p_retailprice * (1 + c_nationkey / 100.0::DOUBLE), 0), 4) AS val
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey LEFT JOIN part ON p_partkey = l_partkey"""
    assert differences(QUERIES["j20_j21_place_values"](spark, SF), con, sql) == []


def test_place_value_falls_back_to_parent_then_zero(spark):
    v = spark.createDataFrame([(1, 2, 8.0), (1, 7, 4.0)], "record long, district long, val double")
    asked = spark.createDataFrame([(1, 2), (1, 12), (1, 3), (9, 2)], "record long, district long")
    assert {(r["record"], r["district"]): r["val"] for r in joining._place_values(asked, v).collect()} == {(1, 2): 8.0, (1, 12): 6.0, (1, 3): 0.0, (9, 2): 0.0}


def test_place_values_are_not_broadcast(spark):
    """Exploded, a small table of records is a large one; Spark's estimate for it is that of the small one."""
    records = spark.range(1000).select(F.col("id").alias("record"), F.explode(F.sequence(F.lit(0), F.lit(24))).alias("district"))
    got = joining._place_values(spark.range(100).select(F.col("id").alias("record"), F.lit(3).alias("district")), records.withColumn("val", F.lit(1.0)))
    assert got.where("val = 1").count() == 100
    assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_raking_meets_its_targets(spark):
    x, t = solving.problem(spark, SF)
    w = QUERIES["sv1_rake_to_tolerance"](spark, SF)
    assert abs(solve.totals(x.join(w, "household_id"), solving.FEATURES, F.col("w")) / t - 1).max() < 1e-5
    for r in QUERIES["lr2_yearly_projection"](spark, SF).collect():
        assert abs(r["achieved"] / r["value"] - 1) < 1e-5


def test_raking_over_rows_and_over_distinct_features_agree(spark):
    x = spark.createDataFrame([(1.0 + i % 3, float(i % 4), float(i % 2)) for i in range(60)], "d double, a double, b double")
    t = list(solve.totals(x, ["a", "b"], F.col("d")) * [1.05, 0.97])
    one, two = (x.select(solve.rake(x, ["a", "b"], t, "d", 4, rows=n).weight.alias("w")).toPandas()["w"].to_numpy() for n in (0, 1000))
    assert abs(one - two).max() < 1e-9


def test_gates_close_and_targets_hold(spark):
    got = QUERIES["sv7_sv8_sparse_gates"](spark, SF).toPandas()
    assert 0 < got["active"].sum() < len(got) / 2
    assert (got.loc[~got["active"], "w"] == 0).all()
    x = spark.createDataFrame([(k % 2, k, 1.0) for k in range(40)], "target_idx long, col_id long, val double")
    w = x.select("col_id", F.lit(1.0).alias("w"))
    y = spark.createDataFrame([(0, 30.0), (1, 10.0)], "target_idx long, value double")
    fit = solve.sparse_gates(x, w, y, 1e-3)
    est = {r["target_idx"]: r["estimate"] for r in matrix.multiply(x, fit).collect()}
    assert abs(est[0] / 30 - 1) < 0.15 and abs(est[1] / 10 - 1) < 0.15


def test_gates_in_one_task_and_spread_agree(spark):
    x = spark.createDataFrame([(k % 2, k // 2, 1.0 + k) for k in range(12)], "target_idx long, col_id long, val double")
    w = x.select("col_id", F.lit(1.0).alias("w")).distinct()
    y = spark.createDataFrame([(0, 30.0, 0.5), (1, 10.0, 1.5)], "target_idx long, value double, mass double")
    one, two = ({r["col_id"]: r["w"] for r in solve.sparse_gates(x, w, y, 1e-3, epochs=3, local=n).collect()} for n in (0, 1000))
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-9 for k in one)


def test_closed_gates_apart_from_open_ones_agree_with_one_task(spark, tmp_path, monkeypatch):
    """Losses, open gates and the last epoch of all columns in one task, though closed columns are fitted apart; no pass over all columns an epoch."""
    monkeypatch.setattr(solve, "EPOCHS_FIRST", 8)
    x = spark.createDataFrame([(k % 3, k // 2, 1.0 + k % 7) for k in range(80)], "target_idx long, col_id long, val double")
    w = x.select("col_id", F.lit(1.0).alias("w")).distinct()
    y = spark.createDataFrame([(0, 30.0), (1, 10.0), (2, 20.0)], "target_idx long, value double")
    fits = {}
    cases = {"one": (0.1, 200, {}), "apart": (0.1, 200, {"local": 0}), "passes": (0.1, 70, {"local": 0, "held": 0}), "all closed": (0.3, 200, {}), "all closed, apart": (0.3, 200, {"local": 0})}
    for name, (penalty, epochs, how) in cases.items():
        f = f"{tmp_path}/{name}"
        fit = solve.sparse_gates(x, w, y, penalty, epochs=epochs, tol=0.1, patience=40, folder=f, every=500, **how)
        fits[name] = fit.toPandas().set_index("col_id").sort_index(), spark.read.parquet(f"{f}/log").orderBy("epoch").toPandas(), spark.read.parquet(f"{f}/state").toPandas().set_index("col_id").sort_index()
    for a, b in (("one", "apart"), ("one", "passes"), ("all closed", "all closed, apart")):
        (one, log, state), (apart, log2, state2) = fits[a], fits[b]
        n = min(len(log), cases[b][1])
        assert len(log2) == n and abs(log["loss"][:n] / log2["loss"] - 1).max() < 1e-6 and (log["open"][:n] == log2["open"]).all()
        if n == len(log):
            assert (one["active"] == apart["active"]).all() and abs(one["w"] - apart["w"]).max() < 1e-6 and (apart.loc[~apart["active"], "w"] == 0).all()
            assert all(abs(state[c] - state2[c]).max() < 1e-6 for c in ("la", "m2", "v2"))
    assert 0 < fits["one"][0]["active"].sum() < 20 and 60 < len(fits["all closed"][1]) < 200  # the one is stopped, the other settles


def test_many_gates_do_not_all_close(spark):
    """The penalty on 3,000 gates is far above the loss; two columns meet both targets, but only after their weights have grown."""
    x = spark.range(3000).select((F.col("id") % 2).alias("target_idx"), F.col("id").alias("col_id"), F.exp((F.col("id") * 7919 % 3000) / 1000.0).alias("val"))
    y = x.groupBy("target_idx").agg((F.sum("val") * 1.5).alias("value"))
    fit = solve.sparse_gates(x, x.select("col_id", F.lit(1.0).alias("w")), y, 0.02, epochs=1000)
    e = matrix.multiply(x, fit).join(y, "target_idx").select(F.abs(F.col("estimate") / F.col("value") - 1).alias("e")).collect()
    assert 0 < fit.where("active").count() < 30 and len(e) == 2 and max(r["e"] for r in e) < 0.01


def test_targets_of_the_nation_weigh_as_much_as_the_others(spark):
    _, t, x = geography._package(spark, SF)
    got = solving._gate_targets(t, x).groupBy("nation").agg(F.sum("mass").alias("m")).collect()
    assert len(got) == 2 and abs(got[0]["m"] - got[1]["m"]) < 1e-9


def test_density_counts_the_columns(spark):
    cols, t, x = geography._package(spark, SF)
    got = QUERIES["mx5_package_report"](spark, SF).first()
    assert cols.count() == 2 * 150 and abs(got["density"] - x.count() / (t.count() * 2 * 150)) < 1e-8


def test_values_do_not_depend_on_the_order_of_rows(spark, tmp_path):
    """Chunks of another order of the same rows are of the same build; a sum of doubles would differ in its last bit."""
    prices = [0.1, 0.2, 0.3]
    prints = []
    for k, ps in enumerate((prices, prices[::-1])):
        for t in ("nation", "region", "customer"):
            spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{k}/{t}.parquet")
        o = spark.read.parquet(f"{SF}/orders.parquet").limit(1).drop("o_orderkey", "o_totalprice", "o_custkey")
        rows = spark.createDataFrame([(i, 1, p) for i, p in enumerate(ps)], "o_orderkey long, o_custkey long, o_totalprice double")
        rows.join(F.broadcast(o), F.lit(True)).coalesce(1).sortWithinPartitions("o_orderkey").write.parquet(f"{tmp_path}/{k}/orders.parquet")
        prints.append(matrix.table_print(geography._package_parts(spark, f"{tmp_path}/{k}")[2]))
    assert prints[0] == prints[1]


def test_columns_stay_apart_beyond_a_million_households(spark, tmp_path):
    for t in ("nation", "region"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    n = 1_000_001
    spark.read.parquet(f"{SF}/customer.parquet").limit(2).withColumn("c_custkey", F.when(F.monotonically_increasing_id() % 2 == 0, 1).otherwise(n).cast("long")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.read.parquet(f"{SF}/orders.parquet").limit(2).withColumn("o_custkey", F.when(F.monotonically_increasing_id() % 2 == 0, 1).otherwise(n).cast("long")).write.parquet(f"{tmp_path}/orders.parquet")
    cols, _, _ = geography._package(spark, str(tmp_path))
    assert cols.count() == 4 and cols.select("col_id").distinct().count() == 4
