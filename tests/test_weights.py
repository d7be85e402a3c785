import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from weftline.operators import clone, joins, solve
from weftline.operators import weights as W


def test_cumulative_with_many_ranges(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice("ab"), rnd.choice([None, 1.0, 2.5, rnd.uniform(-9, 9)]), rnd.randrange(1, 5)) for i in range(2_000)]
    df = spark.createDataFrame(rows, "i long, g string, v double, w long")
    for ranges in (2, 40, 1024):
        got = {r["i"]: r["cum0"] for r in W.cumulative(df, "v", [F.col("w")], [F.col("i")], ["g"], ranges=ranges).collect()}
        for g in "ab":
            run = 0
            for i, _, v, w in sorted((r for r in rows if r[1] == g), key=lambda r: (r[2] is not None, r[2] or 0, r[0])):
                run += w
                assert got[i] == run
    assert W.cumulative(df.where("false"), "v", [F.col("w")], [F.col("i")]).count() == 0


def test_dense_ids_of_sparse_keys(spark):
    keys = [3, 10**12, 7, -5, 2**40]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    assert {r["k"]: r["n"] for r in clone.dense_ids(df, [], "k", "n").collect()} == {k: i for i, k in enumerate(sorted(keys))}


def test_nearest_donors_brute_force(spark):
    rnd = random.Random(6)
    donors = [(i, rnd.choice("xy"), rnd.choice([None, rnd.uniform(0, 9)]), rnd.uniform(0, 9)) for i in range(70)]
    asks = [(i, rnd.choice("xyz"), rnd.uniform(0, 9), rnd.uniform(0, 9)) for i in range(40)]
    d, r = (spark.createDataFrame(x, "id long, g string, a double, b double") for x in (donors, asks))
    for n in (0, 1000):
        got = {}
        for x in joins.nearest_donors(r, d, "id", "id", {"a": 1.0, "b": 2.0}, "g", k=2, squared=False, standardise=False, block=8, prune_from=n).collect():
            got.setdefault(x["rid"], {})[x["rank"]] = x["did"]
        pools = {g: [x for x in donors if x[1] == g] for g in "xy"} | {"z": donors}
        for i, g, a, b in asks:
            best = sorted((abs((x[2] or 0.0) - a) + 2 * abs(x[3] - b), x[0]) for x in pools[g])[:2]
            assert [got[i][1], got[i][2]] == [x[1] for x in best]


def test_solvers_meet_their_targets(spark):
    rnd = random.Random(7)
    x = spark.createDataFrame([(i, 1.0 + i % 3, float(rnd.randrange(3)), float(i % 2)) for i in range(300)], "i long, d double, a double, b double")
    t = solve.totals(x, ["a", "b"], F.col("d")) * [1.05, 0.97]
    for fit in (solve.rake(x, ["a", "b"], list(t), "d", 200), solve.linear(x, ["a", "b"], list(t), "d"), solve.entropy(x, ["a", "b"], list(t), "d")):
        assert abs(solve.totals(x, ["a", "b"], fit.weight) / t - 1).max() < 1e-4
    boxed = solve.entropy(x, ["a", "b"], list(t), "d", box=0.02)
    assert abs(solve.totals(x, ["a", "b"], boxed.weight) / t - 1).max() < 0.0201
    assert x.select(F.min(boxed.weight)).first()[0] > 0
    infeasible = [float(t[0]), -5.0]
    fit = solve.calibrate(x, ["a", "b"], infeasible, "d", "entropy", max_error=0.1)
    assert fit.path[0].startswith("entropy")
    assert solve.densify(t * 1.0, t * 1.1, t, 0.05) == 0.5 or abs(solve.densify(t * 1.0, t * 1.1, t, 0.05) - 0.5) < 1e-9


def test_nearest_donors_with_ties_and_repeats(spark):
    """Half of the donors share one place; all blocks, parts and packs are small."""
    rnd = random.Random(11)
    donors = [(i, "x", 5.0 if i % 2 else float(rnd.randrange(40)), float(rnd.randrange(3))) for i in range(300)]
    d = spark.createDataFrame(donors, "id long, g string, a double, b double")
    got = {}
    for r in joins.nearest_donors(d, d, "id", "id", {"a": 1.0, "b": 1.0}, "g", k=3, standardise=False, block=16, others=True, prune_from=0).collect():
        got.setdefault(r["rid"], {})[r["rank"]] = (r["distance"], r["did"])
    for i, _, a, b in donors:
        best = sorted(((x[2] - a) ** 2 + (x[3] - b) ** 2, x[0]) for x in donors if x[0] != i)[:3]
        assert [got[i][k] for k in (1, 2, 3)] == best


def test_a_hot_group_of_donors_is_no_single_task(spark):
    d = spark.range(6000).select(F.col("id"), F.lit("x").alias("g"), (F.col("id") * 7919 % 6000).cast("double").alias("a"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = joins.nearest_donors(d, d, "id", "id", {"a": 1.0}, "g", block=64, standardise=False, others=True, prune_from=0)
        assert out.count() == 6000 and out.where("abs(distance - 1) > 1e-9").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_cumulative_cuts_a_value_that_most_rows_share(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id").cast("double")).otherwise(3.0).alias("v"), F.lit(1).cast("long").alias("w"))
    out = W.cumulative(df, "v", [F.col("w")], [F.col("id")], ranges=64)
    rows = sorted(out.select("v", "id", "cum0").collect())
    assert [r["cum0"] for r in rows] == list(range(1, 20_001))
    down = sorted(W.cumulative(df, "v", [F.col("w")], [F.col("id")], descending=True, ranges=64).select((-F.col("v")).alias("v"), "id", "cum0").collect())
    assert [r["cum0"] for r in down] == list(range(1, 20_001))
    # one value holds nine tenths of the rows, which a single window would have sorted
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        sizes = [r["count"] for r in W.cumulative(df, "v", [F.col("w")], [F.col("id")], ranges=64).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert max(sizes) < 6_000


def test_string_hash_of_mixed_texts(spark):
    import functools

    from weftline.functions import exprs as X

    def one(t):
        m = (1 << 64) - 1
        n = functools.reduce(lambda h, b: (h * 31 + b) & m, t.encode(), 0)
        n ^= n >> 33
        n = n * 0xFF51AFD7ED558CCD & m
        return str(n ^ n >> 33)

    texts = ["", "a", "é中😀", "x" * 5000, "", "snap\n", "ab"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in [*texts, None]], "s string").coalesce(1).select(X.string_hash("s")).collect()]
    assert got == [one(t) for t in texts] + [None]


def test_fits_report_what_their_weights_do(spark):
    """Singular and impossible problems: errors are measured, and nothing that misses its targets counts as converged."""
    x = spark.createDataFrame([(i, 1.0 + i % 3, float(i % 4), float(i % 2)) for i in range(120)], "i long, d double, a double, b double").withColumn("a2", F.col("a"))
    now = solve.totals(x, ["a", "a2", "b"], F.col("d"))
    for fit in (solve.linear(x, ["a", "a2"], [200.0, 50.0], "d"), solve.rake(x, ["a", "a2"], [200.0, 50.0], "d", 100), solve.entropy(x, ["a", "a2"], [200.0, 50.0], "d")):
        assert not fit.converged
        assert abs(solve.totals(x, ["a", "a2"], fit.weight) - np.array([200.0, 50.0]) - fit.errors).max() < 1e-6 * 200
    same = solve.linear(x, ["a", "a2", "b"], [now[0] * 1.1, now[1] * 1.1, now[2] * 0.9], "d")
    assert same.converged and abs(same.errors).max() < 1e-6 * now[0]
    fit = solve.calibrate(x, ["a", "a2"], [200.0, 50.0], "d", "linear")
    assert fit.path == ["linear failed", "rake"] and not fit.converged
    lp = solve.minimax(x, ["a", "a2"], [200.0, 50.0], "d")  # |s - 200| / 200 = |s - 50| / 50 at s = 80
    assert abs(solve.relative_errors(lp.errors, [200.0, 50.0]).max() - 0.6) < 1e-6 and x.where(lp.weight < 0).count() == 0
    one, two = (x.select(solve.entropy(x, ["a", "b"], [now[0] * 1.02, now[2] * 0.97], "d", rows=n).weight.alias("w")).toPandas()["w"].to_numpy() for n in (0, 1000))
    assert abs(one - two).max() < 1e-6


def test_minimax_against_a_grid(spark):
    rnd = random.Random(2)
    x = spark.createDataFrame([(i, 1.0, float(rnd.randrange(5)), float(rnd.randrange(5)), float(rnd.randrange(-2, 3))) for i in range(60)], "i long, d double, a double, b double, c double")
    fit = solve.minimax(x, ["a", "b", "c"], [100.0, 80.0, 20.0], "d")
    assert fit.converged and fit.iterations < 50
    worse = solve.minimax(x, ["a", "b"], [100.0, -80.0], "d")
    assert abs(solve.relative_errors(worse.errors, [100.0, -80.0]).max() - 1.0) < 1e-6
    nothing = solve.minimax(x.where("false"), ["a"], [5.0], "d")
    assert nothing.errors[0] == -5.0


def test_entropy_for_five_thousand_targets(spark):
    """One-hot and numeric features; known weights give the targets, so they can be met."""
    rng = np.random.default_rng(3)
    n, m = 20_000, 5_000
    idx = np.concatenate([rng.integers(0, m - 10, (n, 3)), m - 10 + rng.integers(0, 10, (n, 1))], 1)
    val = np.concatenate([np.ones((n, 3)), rng.uniform(0.5, 2.0, (n, 1))], 1)
    d, wanted = rng.uniform(1, 3, n), rng.uniform(0.8, 1.25, n)
    y = np.bincount(idx.ravel(), (val * (d * wanted)[:, None]).ravel(), m)
    long = spark.createDataFrame(pd.DataFrame({"row": np.repeat(np.arange(n), 4), "j": idx.ravel(), "x": val.ravel()})).groupBy("row", "j").agg(F.sum("x").alias("x"))
    base = spark.createDataFrame(pd.DataFrame({"row": np.arange(n + 1), "d": np.append(d, 7.0)}))
    rows = solve.feature_rows(long, base, "row", "j", "x", "d").persist()
    beta, errors, met = solve.entropy_wide(rows, y, "d", tol=1e-7)
    assert met and (np.abs(errors) / np.maximum(y, 1)).max() < 1e-6
    w = solve.wide_weight(rows, beta, "row", "d").toPandas().set_index("row")["w"]
    assert (w > 0).all() and w[n] == 7.0
    rows.unpersist()


def test_gates_resume_and_guard(spark, tmp_path):
    x = spark.createDataFrame([(k % 2, k // 2, 1.0 + k) for k in range(12)], "target_idx long, col_id long, val double")
    w = x.select("col_id", F.lit(1.0).alias("w")).distinct()
    y = spark.createDataFrame([(0, 30.0, 0.5), (1, 10.0, 1.5)], "target_idx long, value double, mass double")
    whole = {r["col_id"]: r["w"] for r in solve.sparse_gates(x, w, y, 1e-3, epochs=24).collect()}
    for local in (1000, 0):
        f = f"{tmp_path}/{local}"
        solve.sparse_gates(x, w, y, 1e-3, epochs=11, local=local, folder=f, every=4)
        got = {r["col_id"]: r["w"] for r in solve.sparse_gates(x, w, y, 1e-3, epochs=24, local=local, folder=f, every=7).collect()}
        assert all(abs(got[k] - v) < 1e-9 for k, v in whole.items())
        log = [r["epoch"] for r in spark.read.parquet(f"{f}/log").orderBy("epoch").collect()]
        assert log == list(range(1, 25))
        told = spark.read.parquet(f"{f}/targets")
        assert {r["epoch"] for r in told.select("epoch").distinct().collect()} == {4, 8, 11, 18, 24} and told.count() == 10
        with pytest.raises(ValueError):
            solve.sparse_gates(x, w, y, 2e-3, epochs=30, local=local, folder=f)
