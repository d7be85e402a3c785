"""Calibration (SV), imputation (IM), disaggregation (DS), households (HC) and long-run support (LR)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import exprs as X
from weftline.operators import clone as C
from weftline.operators import entities as E
from weftline.operators import etl
from weftline.operators import impute as I
from weftline.operators import joins as J
from weftline.operators import solve as S
from weftline.operators import weights as W
from weftline.plans.micro import Book, Micro
from weftline.session import scratch

book = Book()
queries, oracle_sql = (lambda: book.queries), (lambda: book.sql)
c = F.col
N = lambda: F.count(F.lit(1))

_P = "WITH x AS (SELECT h.household_id, weight AS d, CAST(coalesce(u.n, 0) AS DOUBLE) AS f0, CASE WHEN segment = 'BUILDING' THEN 1.0 ELSE 0.0 END::DOUBLE AS f1, CASE WHEN wealth > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS f2 FROM household h LEFT JOIN (SELECT household_id, count(*) AS n FROM unit GROUP BY 1) u USING (household_id))"
FEATURES = ["f0", "f1", "f2"]


def problem(spark: SparkSession, d: str) -> tuple[DataFrame, list[float]]:
    """Households with three features, and targets 3%, -5% and 2% off their current totals."""
    m = Micro(spark, d)
    n = m.unit.groupBy("household_id").agg(N().cast("double").alias("f0"))
    x = J.lookup(m.household, n, "household_id", {"f0": 0.0}).select("household_id", c("weight").alias("d"), "f0", (c("segment") == "BUILDING").cast("double").alias("f1"), (c("wealth") > 0).cast("double").alias("f2"))
    t = S.totals(x, FEATURES, c("d"))
    return x, [t[0] * 1.03, t[1] * 0.95, t[2] * 1.02]


_RAKE = """, t AS (SELECT sum(d * f0) * 1.03::DOUBLE AS t0, sum(d * f1) * 0.95::DOUBLE AS t1, sum(d * f2) * 1.02::DOUBLE AS t2 FROM x),
g1 AS (SELECT ln(t0) - ln(sum(d * f0) + 1e-10) AS a, ln(t1) - ln(sum(d * f1) + 1e-10) AS b, ln(t2) - ln(sum(d * f2) + 1e-10) AS e FROM x, t GROUP BY t0, t1, t2),
w1 AS (SELECT x.*, d * CASE WHEN f0 + f1 + f2 > 0 THEN exp((f0 * a + f1 * b + f2 * e) / (f0 + f1 + f2)) ELSE 1 END AS w FROM x, g1),
g2 AS (SELECT ln(t0) - ln(sum(w * f0) + 1e-10) AS a, ln(t1) - ln(sum(w * f1) + 1e-10) AS b, ln(t2) - ln(sum(w * f2) + 1e-10) AS e FROM w1, t GROUP BY t0, t1, t2)
"""


@book.add(_P + _RAKE + "SELECT household_id, round(w * CASE WHEN f0 + f1 + f2 > 0 THEN exp((f0 * a + f1 * b + f2 * e) / (f0 + f1 + f2)) ELSE 1 END, 6) AS w FROM w1, g2")
def sv1_rake_two_rounds(spark: SparkSession, d: str) -> DataFrame:
    x, t = problem(spark, d)
    return x.select("household_id", F.round(S.rake(x, FEATURES, t, "d", iterations=2, tol=0.0).weight, 6).alias("w"))


@book.add()
def sv1_rake_to_tolerance(spark, d):
    """All rounds, until no factor is further than 1e-6 from one."""
    x, t = problem(spark, d)
    return x.select("household_id", S.rake(x, FEATURES, t, "d").weight.alias("w"))


@book.add(_P + """, s AS (SELECT sum(d * f0) * 0.03::DOUBLE AS r0, sum(d * f1) * -0.05::DOUBLE AS r1, sum(d * f0 * f0) AS a, sum(d * f0 * f1) AS b, sum(d * f1 * f1) AS e FROM x), l AS (SELECT (r0 * e - r1 * b) / (a * e - b * b) AS l0, (a * r1 - b * r0) / (a * e - b * b) AS l1 FROM s)
SELECT household_id, round(d * (1 + f0 * l0 + f1 * l1), 6) AS w FROM x, l""")
def sv2_linear(spark, d):
    x, t = problem(spark, d)
    return x.select("household_id", F.round(S.linear(x, FEATURES[:2], t[:2], "d").weight, 6).alias("w"))


@book.add()
def sv3_entropy(spark, d):
    x, t = problem(spark, d)
    return x.select("household_id", S.entropy(x, FEATURES, t, "d").weight.alias("w"))


@book.add()
def sv4_boxed_entropy(spark, d):
    x, t = problem(spark, d)
    return x.select("household_id", S.entropy(x, FEATURES, t, "d", box=0.01).weight.alias("w"))


@book.add(_P + """, s AS (SELECT sum(d * f0) * 1.03::DOUBLE AS f0, sum(d * f1) * 0.95::DOUBLE AS f1, sum(d * f2) * 1.02::DOUBLE AS f2 FROM x)
SELECT unnest(['exact', 'within 1%']) AS fit, round(f0, 2) AS t0, round(f1, 2) AS t1, round(f2, 2) AS t2, true AS met, true AS positive FROM s""")
def sv3_sv4_totals(spark, d):
    """The totals of both fits against their targets, and the sign of the weights."""
    x, t = problem(spark, d)
    rows = []
    for name, box in (("exact", 0.0), ("within 1%", 0.01)):
        w = S.entropy(x, FEATURES, t, "d", box=box).weight
        met = S.relative_errors(S.totals(x, FEATURES, w) - t, t).max() <= box + 1e-6
        rows.append((name, *(round(float(v), 2) for v in t), bool(met), bool(x.agg(F.min(w) > 0).first()[0])))
    return spark.createDataFrame(rows, "fit string, t0 double, t1 double, t2 double, met boolean, positive boolean")


@book.add(_P + """, s AS (SELECT sum(d * f0) * 1.03::DOUBLE AS f0, sum(d * f1) * 0.95::DOUBLE AS f1, sum(d * f2) * 1.02::DOUBLE AS f2 FROM x) SELECT j, round(CASE j WHEN 0 THEN f0 WHEN 1 THEN f1 ELSE f2 END, 2) AS total FROM s, range(3) r(j)""")
def sv3_entropy_wide(spark, d):
    """The same problem from long rows, without the second moments: totals of the weights by target."""
    x, t = problem(spark, d)
    long = x.unpivot("household_id", FEATURES, "f", "x").select("household_id", F.substring("f", 2, 1).cast("int").alias("j"), "x")
    rows = S.feature_rows(long, x, "household_id", "j", "x", "d")
    beta, _, _ = S.entropy_wide(rows, t, "d")
    w = S.wide_weight(rows, beta, "household_id", "d")
    return long.join(w, "household_id").groupBy(c("j").cast("long").alias("j")).agg(F.round(F.sum(c("x") * c("w")), 2).alias("total"))


@book.add("SELECT household_id, true AS within, 'entropy > least error 0.0476' AS path FROM household")
def sv5_minimax(spark, d):
    """Targets that contradict each other (a total and 1.1 times it): the least largest error is 1/21, by non-negative weights."""
    x, t = _contradiction(spark, d)
    fit = S.minimax(x, ["f0", "g0"], t, "d")
    least = S.relative_errors(fit.errors, t).max()
    ok = F.lit(bool(abs(least - 1 / 21) < 1e-6)) & (fit.weight >= 0)
    failed = S.calibrate(x, ["f0", "g0"], t, "d", "entropy", approximate=False)
    return x.select("household_id", ok.alias("within"), F.lit(" > ".join(failed.path)).alias("path"))


def _contradiction(spark: SparkSession, d: str) -> tuple[DataFrame, list[float]]:
    x, t = problem(spark, d)
    return x.withColumn("g0", c("f0")), [t[0], t[0] * 1.1]


@book.add("SELECT household_id, true AS positive, 'entropy' AS path FROM household")
def sv5_sv6_dispatch(spark, d):
    """Calibrate, then blend in as much baseline as a 1% bound allows."""
    import numpy as np

    x, t = problem(spark, d)
    fit = S.calibrate(x, FEATURES, t, "d", "entropy")
    share = S.densify(S.totals(x, FEATURES, fit.weight), S.totals(x, FEATURES, c("d")), np.array(t), 0.01)
    return x.select("household_id", ((fit.weight * (1 - share) + c("d") * share) > 0).alias("positive"), F.lit(" > ".join(fit.path)).alias("path"))


@book.add("""
SELECT * FROM (VALUES ('linear', 'linear', true, 0.0), ('contradicting, linear', 'linear failed > rake', false, 0.048809), ('entropy', 'entropy', true, 0.0), ('impossible, entropy', 'entropy > least error 1', false, 1.0),
  ('contradicting, entropy', 'entropy failed > entropy within 0.1', true, 0.1), ('contradicting, narrow', 'entropy > least error 0.0476', false, 0.1), ('rake', 'rake', true, 0.0)) v("case", path, converged, bound)""")
def sv6_fit_report(spark, d):
    """What each way came to, its largest error measured on the weights: equal to the bound known beforehand, or within it."""
    x, t = problem(spark, d)
    y, u = _contradiction(spark, d)
    cases = [
        ("linear", x, FEATURES[:2], t[:2], {"method": "linear"}, 0.0), ("contradicting, linear", y, ["f0", "g0"], u, {"method": "linear"}, 0.048809), ("entropy", x, FEATURES, t, {"method": "entropy"}, 0.0),
        ("impossible, entropy", x, FEATURES[:2], [t[0], -t[1]], {"method": "entropy"}, 1.0), ("contradicting, entropy", y, ["f0", "g0"], u, {"method": "entropy"}, 0.1),
        ("contradicting, narrow", y, ["f0", "g0"], u, {"method": "entropy", "max_error": 0.04}, 0.1), ("rake", x, FEATURES, t, {"method": "rake"}, 0.0),
    ]
    rows = []
    for name, df, features, wanted, how, bound in cases:
        fit = S.calibrate(df, features, wanted, "d", **how)
        error = float(S.relative_errors(S.totals(df, features, fit.weight) - wanted, wanted).max())
        rows.append((name, " > ".join(fit.path), fit.converged, bound if error <= bound + 1e-5 else error))
    return spark.createDataFrame(rows, "case string, path string, converged boolean, bound double")


@book.add()
def sv7_sv8_sparse_gates(spark, d):
    from weftline.plans.geography import _package

    cols, t, x = _package(spark, d)
    return S.sparse_gates(x, cols.select("col_id", F.lit(1.0).alias("w")), _gate_targets(t, x), penalty=1e-4)


@book.add("SELECT 2 * count(*) AS columns, true AS sparse, true AS closed_weigh_nothing, true AS near_targets FROM household WHERE household_id IN (SELECT household_id FROM unit)")
def sv7_sv8_rules(spark, d):
    """What the gates must come to: most columns closed and without weight, and estimates near the targets (the mean of the errors' squares below 0.01)."""
    from weftline.operators import matrix as MX
    from weftline.plans.geography import _package

    cols, t, x = _package(spark, d)
    y = _gate_targets(t, x)
    got = S.sparse_gates(x, cols.select("col_id", F.lit(1.0).alias("w")), y, penalty=1e-4)
    per = got.agg(N().alias("columns"), (F.sum(c("active").cast("long")) < N() / 2).alias("sparse"), F.min(c("active") | (c("w") == 0)).alias("closed_weigh_nothing"))
    e = MX.multiply(x, got).join(y, "target_idx").agg((F.avg(F.pow((c("estimate") - c("value")) / c("value"), F.lit(2))) < 0.01).alias("near_targets"))
    return per.join(F.broadcast(e), F.lit(True))  # one row each


def _gate_targets(t: DataFrame, x: DataFrame) -> DataFrame:
    """Targets 50% off, those of the nation together as heavy as all others."""
    est = x.groupBy("target_idx").agg((F.sum("val") * 1.5).alias("value")).join(t.select("target_idx", (c("geo_level") == "national").alias("nation")), "target_idx")
    n = est.agg(N().alias("n"), F.sum(c("nation").cast("long")).alias("k")).first()
    # of mean 1: each half of the loss has the mass n / 2
    return est.withColumn("mass", F.when(c("nation"), n["n"] / (2.0 * max(n["k"] or 0, 1))).otherwise(n["n"] / (2.0 * max(n["n"] - (n["k"] or 0), 1))))


@book.add("""
WITH e AS (SELECT value * (1 + ((target_id % 41) - 20) / 100.0) AS est, value AS t FROM target WHERE value IS NOT NULL AND NOT isnan(value) AND value <> 0), r AS (SELECT (est - t) / abs(t) AS e FROM e)
SELECT round(sum(e * e), 6) AS loss, round(avg((abs(e) <= 0.1)::INT), 3) AS within_10, round(quantile_cont(abs(e), 0.5), 8) AS median, round(max(abs(e)), 8) AS largest FROM r""")
def sv10_target_loss(spark, d):
    t = Micro(spark, d).targets.where("value IS NOT NULL AND NOT isnan(value) AND value <> 0").select(c("value").alias("t"), (c("value") * (1 + ((c("target_id") % 41) - 20) / 100.0)).alias("e"))
    return S.target_loss(t, "e", "t").select(F.round("loss", 6).alias("loss"), F.round("within_10", 3).alias("within_10"), F.round("median", 8).alias("median"), F.round("largest", 8).alias("largest"))


# ---- imputation ----


def _hot_deck(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Wealth, then weight given wealth, from the donors (odd ids) of the same segment."""
    h = Micro(spark, d).household.select("household_id", "segment", "district", "wealth", "weight")
    donors = h.where("household_id % 2 = 1")
    return I.hot_deck(h.where("household_id % 2 = 0").select("household_id", "segment"), donors, ["segment"], ["wealth", "weight"], "household_id"), donors


@book.add()
def im1_hot_deck(spark, d):
    return _hot_deck(spark, d)[0]


@book.add("SELECT segment, count(*) FILTER (household_id % 2 = 0) AS imputed, true AS from_own_segment, true AS near_donors_mean FROM household GROUP BY 1")
def im1_rules(spark, d):
    """What imputed values must keep: one per recipient, each a value of a donor of its segment, and their mean near the donors'."""
    got, donors = _hot_deck(spark, d)
    v = donors.select("segment", "wealth", F.lit(True).alias("own")).distinct()
    m = donors.groupBy("segment").agg(F.avg("wealth").alias("mean"), F.stddev_samp("wealth").alias("sd"))
    per = got.join(v, ["segment", "wealth"], "left").groupBy("segment").agg(N().alias("imputed"), F.min(F.coalesce("own", F.lit(False)) & c("weight").isNotNull()).alias("from_own_segment"), F.avg("wealth").alias("avg"))
    return per.join(m, "segment").select("segment", "imputed", "from_own_segment", (F.abs(c("avg") - c("mean")) < 5 * c("sd") / F.sqrt(c("imputed"))).alias("near_donors_mean"))


def _resample(spark: SparkSession, d: str) -> DataFrame:
    h = Micro(spark, d).household
    rows = h.select(c("household_id").alias("draw_no"))
    return I.draw_weighted(rows, h.select(c("household_id").alias("donor"), "weight"), "donor", "weight", X.hash_uniform("draw_no"))


@book.add()
def im2_weighted_resample(spark, d):
    """As many donors as households, drawn with replacement by weight."""
    return _resample(spark, d)


@book.add("SELECT weight, true AS as_expected FROM household GROUP BY 1")
def im2_shares(spark, d):
    """The share of draws by the donors' weight against the share of weight, within five standard errors."""
    h = Micro(spark, d).household
    n = h.agg(N().alias("all"), F.sum("weight").alias("mass")).first()
    got = _resample(spark, d).join(h.select(c("household_id").alias("donor"), "weight"), "donor").groupBy("weight").agg(N().alias("k"))
    p = h.groupBy("weight").agg((F.sum("weight") / n["mass"]).alias("p")).join(got, "weight", "left")
    return p.select("weight", (F.abs(F.coalesce("k", F.lit(0)) - c("p") * n["all"]) < 5 * F.sqrt(c("p") * (1 - c("p")) * n["all"])).alias("as_expected"))


@book.add("""
WITH r AS (SELECT household_id AS rid, segment, wealth FROM household WHERE household_id % 2 = 0), q AS (SELECT household_id AS did, segment, wealth, weight FROM household WHERE household_id % 2 = 1)
SELECT rid, did, weight FROM (SELECT rid, did, q.weight, row_number() OVER (PARTITION BY rid ORDER BY abs(r.wealth - q.wealth), did) AS k FROM r JOIN q USING (segment)) WHERE k = 1""")
def im3_rematch(spark, d):
    """Records take over the columns of their nearest donor of the same segment by wealth."""
    h = Micro(spark, d).household
    donors = h.where("household_id % 2 = 1")
    near = J.nearest_donors(h.where("household_id % 2 = 0"), donors, "household_id", "household_id", {"wealth": 1.0}, "segment", squared=False, standardise=False)
    return near.join(donors.select(c("household_id").alias("did"), "weight"), "did").select("rid", "did", "weight")


@book.add("""
WITH v AS (SELECT unit_id, greatest(CASE WHEN unit_id % 7 = 0 THEN 0 ELSE agi * 0.25 END, 0) AS a, greatest(CASE WHEN unit_id % 7 = 0 THEN 0 ELSE 1000 - agi * 0.001::DOUBLE END, 0) AS b, CASE WHEN status = 'P' THEN -5 ELSE agi END AS total FROM unit)
SELECT unit_id, round(CASE WHEN total > 0 THEN CASE WHEN a + b > 0 THEN a / (a + b) * total ELSE total / 2 END ELSE 0 END, 4) AS a, round(CASE WHEN total > 0 THEN CASE WHEN a + b > 0 THEN b / (a + b) * total ELSE total / 2 END ELSE 0 END, 4) AS b FROM v""")
def im4_ds7_reconcile(spark, d):
    off = c("unit_id") % 7 == 0
    v = Micro(spark, d).unit.select("unit_id", F.when(off, 0.0).otherwise(c("agi") * 0.25).alias("a"), F.when(off, 0.0).otherwise(1000 - c("agi") * 0.001).alias("b"), F.when(c("status") == "P", -5.0).otherwise(c("agi")).alias("total"))
    a, b = I.reconcile_to_total(["a", "b"], c("total"))
    return v.select("unit_id", F.round(a, 4).alias("a"), F.round(b, 4).alias("b"))


@book.add("SELECT unit_id, line, part, supp, age, CASE WHEN flag = 'N' THEN 0 ELSE least(greatest(earnings * 0.25, 0), CASE WHEN age >= 50 THEN 7500 ELSE 6500 END) END AS capped FROM person")
def im5_caps(spark, d):
    cap = F.when(c("age") >= 50, 7500.0).otherwise(6500.0)
    return Micro(spark, d).person.select("unit_id", "line", "part", "supp", "age", F.when(c("flag") == "N", 0.0).otherwise(F.least(F.greatest(c("earnings") * 0.25, F.lit(0.0)), cap)).alias("capped"))


@book.add("""
WITH r AS (SELECT household_id, agi, row_number() OVER (PARTITION BY household_id ORDER BY agi DESC, unit_id) AS k FROM unit), m AS (SELECT household_id, min(agi) AS cap FROM r WHERE k <= 2 GROUP BY 1)
SELECT household_id, round(least(greatest(wealth, 0) * 25, coalesce(cap, 0)), 4) AS childcare FROM household LEFT JOIN m USING (household_id)""")
def im6_capped_rebuild(spark, d):
    m = Micro(spark, d)
    h = J.lookup(m.household, etl.second_largest(m.unit, "household_id", "agi", "cap"), "household_id", {"cap": 0.0})
    return h.select("household_id", F.round(F.least(F.greatest(c("wealth"), F.lit(0.0)) * 25, c("cap")), 4).alias("childcare"))


_U3 = "((household_id * (1103515245 + 3) + 12345 + 3) % 2147483648) / 2147483648.0"


@book.add(f"""
WITH t AS (SELECT quantile_cont(wealth, 0.9) AS t FROM household), r AS (SELECT household_id, wealth >= t AS top, row_number() OVER (PARTITION BY wealth >= t ORDER BY {_U3}, household_id) AS k, count(*) FILTER (wealth >= t) OVER () AS n_top, count(*) OVER () AS n FROM household, t)
SELECT household_id FROM r WHERE top OR k <= n // 4 - n_top""")
def im8_keep_top_sample(spark, d):
    h = Micro(spark, d).household
    return I.keep_top_sample(h, "wealth", 0.9, h.count() // 4, X.lcg_uniform(c("household_id"), 3), "household_id").select("household_id")


@book.add(f"""
WITH b AS (SELECT household_id, CASE WHEN wealth < 0 THEN 'neg' WHEN wealth < 5000 THEN 'low' ELSE 'high' END AS bracket, weight >= 6 AS f FROM household), r AS (SELECT *, row_number() OVER (PARTITION BY bracket ORDER BY NOT f, {_U3}, household_id) AS k FROM b)
SELECT household_id, bracket FROM r WHERE k <= CASE bracket WHEN 'neg' THEN 20 WHEN 'low' THEN 50 ELSE 80 END""")
def im9_bracket_sample(spark, d):
    b = F.when(c("wealth") < 0, "neg").when(c("wealth") < 5000, "low").otherwise("high")
    return I.bracket_sample(Micro(spark, d).household, b, {"neg": 20, "low": 50, "high": 80}, c("weight") >= 6, X.lcg_uniform(c("household_id"), 3), "household_id").select("household_id", "bracket")


@book.add(f"SELECT household_id FROM household WHERE state = 2 AND {_U3} < least(abs(2000 - 1500) / (SELECT sum(weight) FROM household WHERE state = 2), 1)")
def im10_subset_to_weight(spark, d):
    h = Micro(spark, d).household.where("state = 2")
    return I.subset_to_weight(h, "weight", X.lcg_uniform(c("household_id"), 3), 2000.0, 1500.0).select("household_id")


@book.add(f"""
WITH w AS (SELECT unit_id, household_id, status, agi / (20 + unit_id % 31) / 52 AS wage FROM unit WHERE agi > 1000 AND priority <> '5-LOW'), s AS (SELECT w.*, state FROM w JOIN household USING (household_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY state ORDER BY ((unit_id * (1103515245 + 6) + 12345 + 6) % 2147483648) / 2147483648.0, unit_id) AS k, count(*) OVER (PARTITION BY state) AS n FROM s)
SELECT unit_id, state, wage, k <= round(n * CASE state WHEN 0 THEN 0.2 WHEN 1 THEN 0.1 ELSE 0.05 END) AS in_union FROM r""")
def im7_donors_and_quota(spark, d):
    """Donors with earnings and hours, their hourly wage, and membership given to a quota of each state by draw."""
    m = Micro(spark, d)
    w = m.unit.where("agi > 1000 AND priority <> '5-LOW'").select("unit_id", "household_id", (c("agi") / (20 + c("unit_id") % 31) / 52).alias("wage"))
    s = w.join(m.household.select("household_id", "state"), "household_id")
    rate = F.when(c("state") == 0, 0.2).when(c("state") == 1, 0.1).otherwise(0.05)
    inside = W.quota_sample(s, ["state"], X.lcg_uniform(c("unit_id"), 6), "unit_id", F.round(c("_n") * rate)).select("unit_id", F.lit(True).alias("in_union"))
    return s.join(inside, "unit_id", "left").select("unit_id", "state", "wage", F.coalesce("in_union", F.lit(False)).alias("in_union"))


_IM11 = f"""
WITH s AS (SELECT household_id, weight, CASE WHEN wealth < 0 THEN 'none' WHEN segment = 'MACHINERY' THEN 'worker' WHEN weight >= 6 THEN 'student' WHEN segment = 'BUILDING' AND wealth > 5000 THEN 'family' ELSE 'other' END AS status, {_U3} AS u FROM household),
t1 AS (SELECT *, CASE WHEN status = 'other' AND u < least(greatest((SELECT sum(weight) * 1.1::DOUBLE - sum(weight) FROM s WHERE status = 'worker'), 0) / (SELECT sum(weight) FROM s WHERE status = 'other'), 1) THEN 'worker' ELSE status END AS s1 FROM s),
t2 AS (SELECT *, CASE WHEN s1 = 'other' AND 1 - u < least(greatest((SELECT sum(weight) * 1.2::DOUBLE - sum(weight) FROM t1 WHERE s1 = 'student'), 0) / (SELECT sum(weight) FROM t1 WHERE s1 = 'other'), 1) THEN 'student' ELSE s1 END AS s2 FROM t1)
"""


@book.add(_IM11 + "SELECT 0 AS step, status, count(*) AS n, sum(weight) AS weighted FROM t2 GROUP BY 2 UNION ALL SELECT 1, s1, count(*), sum(weight) FROM t2 GROUP BY 2 UNION ALL SELECT 2, s2, count(*), sum(weight) FROM t2 GROUP BY 2")
def im11_status_steps(spark, d):
    """A cascade of evidence, then rows moved by draw towards two weighted targets, with the counts after each step."""
    rules = [(c("wealth") < 0, "none"), (c("segment") == "MACHINERY", "worker"), (c("weight") >= 6, "student"), ((c("segment") == "BUILDING") & (c("wealth") > 5000), "family")]
    h = Micro(spark, d).household.select("household_id", "weight", X.first_matching(rules, "other").alias("status"), X.lcg_uniform(c("household_id"), 3).alias("u"))
    log = lambda x, k: x.groupBy(F.lit(k).alias("step"), "status").agg(N().alias("n"), F.sum("weight").alias("weighted"))
    out = log(h, 0)
    for k, (to, more, draw) in enumerate((("worker", 1.1, c("u")), ("student", 1.2, 1 - c("u"))), 1):
        h = I.move_to_target(h, "status", "other", to, "weight", draw, more)
        out = out.unionByName(log(h, k))
    return out


@book.add(f"WITH x AS (SELECT household_id, weight, sum(weight) OVER (ORDER BY (CASE WHEN segment = 'BUILDING' THEN 0 ELSE 1 END) + {_U3} * 0.5, household_id) AS cum FROM household) SELECT household_id FROM x WHERE cum - weight < 1000")
def im12_greedy_selection(spark, d):
    h = Micro(spark, d).household.withColumn("score", F.when(c("segment") == "BUILDING", 0.0).otherwise(1.0) + X.lcg_uniform(c("household_id"), 3) * 0.5)
    return W.fill_to_total(h, "score", "weight", "household_id", F.lit(1000.0)).select("household_id")


@book.add("""
WITH l AS (SELECT unit_id, agi * 0.05 AS interest, greatest(CASE WHEN unit_id % 4 = 0 THEN 0 ELSE agi * 2 END, 1000.0) AS first, CASE WHEN status = 'P' THEN greatest(agi * 0.5, 1000.0) ELSE 0 END AS second FROM unit), n AS (SELECT unit_id, count(*) AS persons FROM person GROUP BY 1)
SELECT unit_id, interest * first / (first + second) AS on_first, interest * second / (first + second) AS on_second, interest / persons AS per_person FROM l JOIN n USING (unit_id)""")
def im13_mortgage_parts(spark, d):
    """Interest split over two loans by their balances, which have floors, and shared by the unit's persons."""
    m = Micro(spark, d)
    first = F.greatest(F.when(c("unit_id") % 4 == 0, 0.0).otherwise(c("agi") * 2), F.lit(1000.0))
    second = F.when(c("status") == "P", F.greatest(c("agi") * 0.5, F.lit(1000.0))).otherwise(0.0)
    l = m.unit.select("unit_id", (c("agi") * 0.05).alias("interest"), first.alias("a"), second.alias("b")).join(m.person.groupBy("unit_id").agg(N().alias("persons")), "unit_id")
    return l.select("unit_id", *[(c("interest") * c(x) / (c("a") + c("b"))).alias(n) for x, n in (("a", "on_first"), ("b", "on_second"))], (c("interest") / c("persons")).alias("per_person"))


@book.add("SELECT unit_id, line, part, supp, age, round(gross / sum(gross) OVER (PARTITION BY unit_id), 8) AS share FROM person")
def im13_person_shares(spark, d):
    return C.shares(Micro(spark, d).person, "gross", ["unit_id"]).select("unit_id", "line", "part", "supp", "age", F.round("share", 8).alias("share"))


def _lognormal(spark: SparkSession, d: str) -> DataFrame:
    u = Micro(spark, d).unit
    on = X.hash_uniform(F.lit("on"), "unit_id") < 0.3
    return u.select("unit_id", F.when(on, I.lognormal(X.hash_uniform(F.lit("a"), "unit_id"), X.hash_uniform(F.lit("b"), "unit_id"), 8.0, 1.2)).otherwise(0.0).alias("amount"))


@book.add()
def im14_lognormal_draws(spark, d):
    return _lognormal(spark, d)


@book.add("SELECT count(*) AS n, true AS share_on, true AS mean_log, true AS spread_log FROM unit")
def im14_moments(spark, d):
    """Three in ten are drawn; the logarithms have mean 8 and deviation 1.2, each within five standard errors."""
    l = F.when(c("amount") > 0, F.log("amount"))
    k = F.count(l)
    return _lognormal(spark, d).agg(N().alias("n"), (F.abs(k / N() - 0.3) < 5 * F.sqrt(0.21 / N())).alias("share_on"), (F.abs(F.avg(l) - 8.0) < 5 * 1.2 / F.sqrt(k)).alias("mean_log"), (F.abs(F.stddev_samp(l) - 1.2) < 5 * 1.2 / F.sqrt(2 * k)).alias("spread_log"))


@book.add("""
WITH r AS (SELECT unit_id, agi, CASE status WHEN 'F' THEN 2 ELSE 1 END AS filers, least(unit_id % 5, 3) AS kids FROM unit), k AS (SELECT unit_id, agi, filers, unnest(range(1, CAST(filers + kids + 1 AS INT))) AS i FROM r)
SELECT unit_id * 100 + i AS person_id, unit_id, CASE WHEN i = 1 THEN 'filer' WHEN i = 2 AND filers = 2 THEN 'spouse' ELSE 'dependant' END AS role, CASE WHEN i = 1 THEN CASE WHEN filers = 2 THEN agi * 0.75 ELSE agi END WHEN i = 2 AND filers = 2 THEN agi * 0.25 ELSE 0 END AS earnings FROM k""")
def im15_expand_persons(spark, d):
    r = Micro(spark, d).unit.select("unit_id", "agi", F.when(c("status") == "F", 2).otherwise(1).alias("filers"), F.least(c("unit_id") % 5, F.lit(3)).alias("kids"))
    k = I.expand(r, c("filers") + c("kids")).withColumn("i", c("copy") + 1)
    spouse = (c("i") == 2) & (c("filers") == 2)
    return k.select((c("unit_id") * 100 + c("i")).alias("person_id"), "unit_id", F.when(c("i") == 1, "filer").when(spouse, "spouse").otherwise("dependant").alias("role"),
                    F.when(c("i") == 1, F.when(c("filers") == 2, c("agi") * 0.75).otherwise(c("agi"))).when(spouse, c("agi") * 0.25).otherwise(0.0).alias("earnings"))


@book.add("""
WITH p AS (SELECT unit_id, line, part, supp, age, gross, age >= 18 AS adult, flag = 'A' AS partner, part % 2 = 0 AS male FROM person), n AS (SELECT unit_id, count(*) FILTER (adult) AS na, count(*) FILTER (adult AND partner) AS np, count(DISTINCT male) FILTER (adult AND partner) AS ns FROM p GROUP BY 1),
r AS (SELECT p.*, row_number() OVER (PARTITION BY unit_id ORDER BY NOT adult, NOT (na = 2 AND np = 2 AND ns = 2 AND male), age DESC, line, part, supp, gross) AS k FROM p JOIN n USING (unit_id)) SELECT unit_id, line, part, supp, age FROM r WHERE k = 1""")
def im16_reference_person(spark, d):
    p = Micro(spark, d).person
    return I.reference_person(p, "unit_id", ["line", "part", "supp", "gross"], c("age") >= 18, "age", c("flag") == "A", c("part") % 2 == 0).select("unit_id", "line", "part", "supp", "age")


# ---- disaggregation ----


@book.add("""
WITH t AS (SELECT district, sum(CAST(weight AS BIGINT)) + 137 AS total, count(*) AS n FROM household GROUP BY 1), r AS (SELECT household_id, district, row_number() OVER (PARTITION BY district ORDER BY household_id) AS k FROM household)
SELECT household_id, total // n + CASE WHEN k <= total % n THEN 1 ELSE 0 END AS w FROM r JOIN t USING (district)""")
def ds1_integer_weights(spark, d):
    h = Micro(spark, d).household
    t = h.groupBy("district").agg((F.sum(c("weight").cast("long")) + 137).alias("total"), N().alias("n"))
    r = C.dense_ids(h.select("household_id", "district"), ["district"], "household_id", "k").join(t, "district")
    return r.select("household_id", I.integer_weights(c("total"), c("n"), c("k") + 1).alias("w"))


def _bounded(spark: SparkSession, d: str) -> DataFrame:
    """Wealth within bounds, to 1.1 times its total per segment; one segment asks for more than its bounds allow."""
    h = Micro(spark, d).household.select("household_id", "segment", "wealth", "weight", F.lit(-2000.0).alias("lo"), F.lit(12000.0).alias("hi"))
    t = h.groupBy("segment").agg(F.when(c("segment") == "MACHINERY", F.sum("weight") * 12100.0).otherwise(F.sum(c("wealth") * c("weight")) * 1.1).alias("total"))
    return I.project_to_bounds(h.join(t, "segment"), ["segment"], "wealth", "weight", "total", "lo", "hi")


@book.add()
def ds2_project_to_bounds(spark, d):
    return _bounded(spark, d).select("household_id", "wealth", F.round("residual", 4).alias("residual"))


@book.add("""
SELECT segment, round(CASE segment WHEN 'MACHINERY' THEN sum(weight) * 100.0::DOUBLE ELSE 0 END, 2) AS residual, round(CASE segment WHEN 'MACHINERY' THEN sum(weight) * 12000.0::DOUBLE ELSE sum(wealth * weight) * 1.1::DOUBLE END, 2) AS achieved, true AS inside FROM household GROUP BY 1""")
def ds2_residuals(spark, d):
    """The totals met, or what the clamped values leave."""
    return _bounded(spark, d).groupBy("segment").agg(F.round(F.max("residual") + 0.0, 2).alias("residual"), F.round(F.sum(c("wealth") * c("weight")), 2).alias("achieved"), F.min(c("wealth").between(-2000.0, 12000.0)).alias("inside"))


@book.add("""
WITH t AS (SELECT segment, CASE segment WHEN 'BUILDING' THEN -100000.0 ELSE 500000.0 END::DOUBLE AS total, sum(wealth * weight) FILTER (wealth > 0) AS p, sum(-wealth * weight) FILTER (wealth < 0) AS n FROM household GROUP BY 1)
SELECT household_id, round(CASE WHEN total > 0 THEN greatest(wealth, 0) / p ELSE greatest(-wealth, 0) / n END * total + 0.0, 6) AS allocated FROM household JOIN t USING (segment)""")
def ds3_allocate(spark, d):
    h = Micro(spark, d).household.withColumn("total", F.when(c("segment") == "BUILDING", -100000.0).otherwise(500000.0))
    return I.allocate(h, ["segment"], "wealth", "weight", "total").select("household_id", F.round("allocated", 6).alias("allocated"))


_DS4 = f"""
WITH m AS (SELECT household_id, segment, greatest(abs(wealth) / 10000.0::DOUBLE, 1e-6) ** 24 * sqrt(1 / (1 + abs(ln(1 + abs(wealth)) - ln(1 + 5000.0)))) AS mass, ((household_id * (1103515245 + 4) + 12345 + 4) % 2147483648) / 2147483648.0 AS u FROM household),
p AS (SELECT *, mass / sum(mass) OVER (PARTITION BY segment) AS probability FROM m)
"""


def _ds4(spark: SparkSession, d: str) -> DataFrame:
    h = Micro(spark, d).household.select("household_id", "segment", "wealth", (F.abs("wealth") / 10000.0).alias("score"), F.lit(5000.0).alias("wanted"))
    return I.donor_probabilities(h, "segment", "score", "wealth", "wanted")


@book.add(_DS4 + "SELECT household_id, round(probability, 12) AS probability FROM p")
def ds4_donor_probabilities(spark, d):
    return _ds4(spark, d).select("household_id", F.round("probability", 12).alias("probability"))


@book.add(_DS4 + "SELECT segment, household_id FROM (SELECT segment, household_id, row_number() OVER (PARTITION BY segment ORDER BY -ln(1 - u) / probability, household_id) AS k FROM p) WHERE k <= 20")
def ds4_sample(spark, d):
    """Twenty donors of each bucket, without replacement."""
    return I.sample_donors(_ds4(spark, d), "segment", "household_id", "probability", F.lit(20), X.lcg_uniform(c("household_id"), 4)).select("segment", "household_id")


@book.add("SELECT unit_id, k AS copy, agi / (1 + unit_id % 3) AS part FROM (SELECT unit_id, agi, unnest(range(CAST(1 + unit_id % 3 AS INT))) AS k FROM unit)")
def ds5_replicate(spark, d):
    n = 1 + c("unit_id") % 3
    return I.expand(Micro(spark, d).unit, n).select("unit_id", "copy", (c("agi") / n).alias("part"))


def _tilted_donors(spark: SparkSession, d: str) -> DataFrame:
    """A donor of the household's nation for each, in proportion to a tilt towards similar size."""
    m = Micro(spark, d)
    pool = m.raw("supplier").select(c("s_suppkey").alias("donor"), c("s_nationkey").alias("district"), c("s_acctbal").alias("donor_wealth"), F.lit(1.0).alias("w"))
    tilt = F.exp(-F.abs(c("wealth") - c("donor_wealth")) / 5000.0)
    return I.draw_tilted(m.household.select("household_id", "district", "wealth"), pool, "household_id", "donor", "district", "w", tilt)


@book.add()
def ds6_probability_donors(spark, d):
    return _tilted_donors(spark, d)


@book.add("SELECT count(*) AS households, true AS own_district, true AS nearer_than_chance FROM household WHERE district IN (SELECT s_nationkey FROM supplier)")
def ds6_rules(spark, d):
    """One donor each, of the own district, and nearer in wealth than the district's donors on average."""
    m = Micro(spark, d)
    s = m.raw("supplier").select(c("s_suppkey").alias("donor"), c("s_nationkey").alias("there"), c("s_acctbal").alias("theirs"))
    got = _tilted_donors(spark, d).join(m.household.select("household_id", "district", "wealth"), "household_id").join(s, "donor")
    chance = m.household.select("district", "wealth").join(s.groupBy(c("there").alias("district")).agg(F.avg("theirs").alias("mid"), F.count("theirs").alias("k")), "district").agg(F.avg(F.abs(c("wealth") - c("mid"))).alias("gap"))
    per = got.agg(N().alias("households"), F.min(c("district") == c("there")).alias("own_district"), F.avg(F.abs(c("wealth") - c("theirs"))).alias("mean_gap"))
    wide = m.household.agg((F.max("wealth") - F.min("wealth")).alias("range"))
    return per.join(F.broadcast(chance), F.lit(True)).join(F.broadcast(wide), F.lit(True)).select("households", "own_district", (c("mean_gap") < c("range") / 3).alias("nearer_than_chance"))  # one row each


@book.add("""
WITH p AS (SELECT DISTINCT record_id, snapshot_date, left(snapshot_date, 4)::INT AS y, networth_millions AS v, coalesce(industry, 'none') AS ind FROM forbes_top_tail)
SELECT y, ind, count(*) AS n, round(sum(v), 2) AS total, round(max(v), 2) AS top FROM p GROUP BY ALL""")
def ds8_top_tail_report(spark, d):
    p = Micro(spark, d).raw("forbes_top_tail").select("record_id", "snapshot_date", F.substring("snapshot_date", 1, 4).cast("int").alias("y"), c("networth_millions").alias("v"), F.coalesce("industry", F.lit("none")).alias("ind")).distinct()
    return p.groupBy("y", "ind").agg(N().alias("n"), F.round(F.sum("v"), 2).alias("total"), F.round(F.max("v"), 2).alias("top"))


# ---- households and long-run support ----

# Persons with pointers: spouses in a third of the units, parents one or two lines up, so that young adults form chains.
_HC = """
WITH RECURSIVE p AS (SELECT unit_id AS h, line AS l, max(age) AS a, sum(gross) AS i, max(age) >= 18 AS adult, max(age) < 24 AS child, sum(gross) < 40000 AS rel, line = 1 AND unit_id % 7 = 0 AS ref, line % 2 = 0 AS kin,
  CASE WHEN unit_id % 3 = 0 THEN CASE line WHEN 1 THEN 2 WHEN 2 THEN 1 END END AS s, CASE WHEN unit_id % 2 = 0 THEN line - 1 WHEN line >= 4 THEN line - 2 END AS par FROM person GROUP BY unit_id, line),
q AS (SELECT x.*, coalesce(x.par, 0) AS pp, y.l IS NOT NULL AS paired, CASE WHEN y.l IS NOT NULL THEN CASE WHEN x.ref THEN x.l WHEN y.ref THEN y.l WHEN x.a > y.a OR (x.a = y.a AND x.l < y.l) THEN x.l ELSE y.l END WHEN x.adult THEN x.l END AS own,
  coalesce(y.i, 0) AS mi, coalesce(y.ref, false) AS mref, y.l AS ml FROM p x LEFT JOIN p y ON y.h = x.h AND y.l = x.s AND y.s = x.l),
u AS (SELECT h, l AS k, coalesce(ml, l) AS k2, i + mi AS ui, a AS ua, -least(l, coalesce(ml, l)) AS o, ref OR mref AS uref FROM q WHERE own = l),
ul AS (SELECT h, list(struct_pack(k := CAST(k AS INT), k2 := CAST(k2 AS INT), ui := ui, ua := ua, o := o, uref := uref)) AS units FROM u GROUP BY h),
c AS (SELECT h, l, pp, child, row_number() OVER (PARTITION BY h ORDER BY a, l) AS n FROM q WHERE adult AND NOT paired),
st AS (SELECT h, CAST(0 AS BIGINT) AS n, CAST([] AS STRUCT(f INT, t INT)[]) AS claims FROM ul
  UNION ALL SELECT st.h, c.n, CASE WHEN t IS NULL THEN claims ELSE list_append(claims, struct_pack(f := CAST(c.l AS INT), t := t)) END FROM (
    SELECT st.h, st.n, st.claims, CASE WHEN c.child THEN list_sort(list_transform(list_filter(units, lambda z: NOT list_contains(list_transform(st.claims, lambda w: w.f), z.k) AND z.k <> c.l AND (z.k = c.pp OR z.k2 = c.pp)), lambda z: struct_pack(ui := z.ui, ua := z.ua, o := z.o, k := z.k)), 'DESC')[1].k END AS t, c.l, c.n AS cn
    FROM st JOIN c ON c.h = st.h AND c.n = st.n + 1 JOIN ul ON ul.h = st.h) st JOIN c ON c.h = st.h AND c.n = st.cn),
fin AS (SELECT h, arg_max(claims, n) AS claims FROM st GROUP BY h),
cl AS (SELECT h, unnest(claims).f AS f, unnest(claims).t AS t FROM fin),
ch AS (SELECT h, f, t, 1 AS n FROM cl UNION ALL SELECT ch.h, ch.f, cl.t, ch.n + 1 FROM ch JOIN cl ON cl.h = ch.h AND cl.f = ch.t),
ro AS (SELECT h, f, arg_max(t, n) AS t FROM ch GROUP BY h, f),
lf AS (SELECT u.* FROM u ANTI JOIN cl ON cl.h = u.h AND cl.f = u.k),
bp AS (SELECT q.h, q.l, arg_max(lf.k, (lf.ui, lf.ua, lf.o, lf.k)) AS k FROM q JOIN lf ON lf.h = q.h AND (lf.k = q.pp OR lf.k2 = q.pp) GROUP BY ALL),
br AS (SELECT h, arg_max(k, (ui, ua, o, k)) AS k FROM lf WHERE uref GROUP BY h)
SELECT q.h AS unit_id, q.l AS line, v AS unit_line, CASE WHEN v = q.l THEN 'head' WHEN paired THEN 'spouse' ELSE 'dependant' END AS role FROM (
  SELECT q.*, CASE WHEN paired THEN own WHEN adult THEN coalesce(ro.t, q.l) ELSE coalesce(CASE WHEN child THEN coalesce(bp.k, CASE WHEN par IS NULL AND a < 15 THEN br.k END) END, CASE WHEN rel THEN coalesce(bp.k, CASE WHEN (kin OR par IS NULL) AND a < 15 THEN br.k END) END, q.l) END AS v
  FROM q LEFT JOIN ro ON ro.h = q.h AND ro.f = q.l LEFT JOIN bp ON bp.h = q.h AND bp.l = q.l LEFT JOIN br ON br.h = q.h) q
"""


@book.add(_HC)
def hc1_filing_units(spark, d):
    q = Micro(spark, d).person.groupBy("unit_id", "line").agg(F.max("age").alias("age"), F.sum("gross").alias("income"))
    spouse = F.when(c("unit_id") % 3 == 0, F.when(c("line") == 1, 2).when(c("line") == 2, 1))
    parent = F.when(c("unit_id") % 2 == 0, c("line") - 1).when(c("line") >= 4, c("line") - 2)
    return I.filing_units(
        q.withColumn("sp", spouse).withColumn("pa", parent), "unit_id", "line", "sp", "pa", "age", income="income",
        reference=(c("line") == 1) & (c("unit_id") % 7 == 0), child=c("age") < 24, relative=c("income") < 40000, kin=c("line") % 2 == 0,
    )


@book.add("""
WITH s AS (SELECT household_id, max(age) AS oldest FROM person GROUP BY 1 HAVING max(age) >= 48 AND min(age) >= 5), g AS (SELECT unnest([0, 5, 10]) AS shift)
SELECT s.household_id + (SELECT max(household_id) + 1 FROM household) * (1 + shift // 5) AS new_id, s.household_id AS donor, shift, oldest + shift AS oldest FROM s, g WHERE oldest + shift <= 58""")
def lr1_age_shifted_clones(spark, d):
    m = Micro(spark, d)
    s = m.person.groupBy("household_id").agg(F.max("age").alias("oldest"), F.min("age").alias("youngest")).where("oldest >= 48 AND youngest >= 5")
    top = m.household.agg((F.max("household_id") + 1).alias("top"))
    g = s.withColumn("shift", F.explode(F.array(F.lit(0), F.lit(5), F.lit(10)))).join(F.broadcast(top), F.lit(True)).where("oldest + shift <= 58")
    return g.select((c("household_id") + c("top") * (1 + F.floor(c("shift") / 5))).alias("new_id"), c("household_id").alias("donor"), "shift", (c("oldest") + c("shift")).alias("oldest"))


@book.add(_P + """, s AS (SELECT sum(d * f0) * 1.03::DOUBLE AS f0, sum(d * f1) * 0.95::DOUBLE AS f1, sum(d * f2) * 1.02::DOUBLE AS f2 FROM x)
SELECT 2025 + k AS year, 'f' || j AS target, round(CASE j WHEN 0 THEN f0 WHEN 1 THEN f1 ELSE f2 END * pow(1.01, k), 2) AS value, true AS met, n FROM s, range(3) r(k), range(3) q(j), (SELECT count(*) AS n FROM x)""")
def lr2_yearly_audit(spark, d):
    """Year by year: growing targets, raking, the year's weights written and read back for the audit of each target."""
    x, t = problem(spark, d)
    f, out = scratch(spark, "years"), None
    for year in range(3):
        want = [v * 1.01**year for v in t]
        x.select("household_id", *FEATURES, S.rake(x, FEATURES, want, "d").weight.alias("w")).write.parquet(f"{f}/year={2025 + year}")
    years = spark.read.parquet(f).groupBy("year").agg(N().alias("n"), *[F.sum(c(k) * c("w")).alias(k) for k in FEATURES])
    long = years.unpivot(["year", "n"], FEATURES, "target", "achieved")
    wanted = spark.createDataFrame([(2025 + y, k, float(v * 1.01**y)) for y in range(3) for k, v in zip(FEATURES, t)], "year int, target string, value double")
    return long.join(F.broadcast(wanted), ["year", "target"]).select("year", "target", F.round("value", 2).alias("value"), (F.abs(c("achieved") / c("value") - 1) < 1e-5).alias("met"), "n")


@book.add()
def lr2_yearly_projection(spark, d):
    """Raking year by year with growing targets; one audit row per year and target."""
    x, t = problem(spark, d)
    out = None
    for year in range(3):
        want = [v * 1.01**year for v in t]
        fit = S.rake(x, FEATURES, want, "d")
        got = S.totals(x, FEATURES, fit.weight)
        part = spark.createDataFrame([(2025 + year, f, float(w), float(g)) for f, w, g in zip(FEATURES, want, got)], "year int, target string, value double, achieved double")
        out = part if out is None else out.unionByName(part)
    return out


@book.add("""
WITH a AS (SELECT household_id, segment, wealth, weight, row_number() OVER (PARTITION BY segment ORDER BY wealth, household_id) - 1 AS i, count(*) OVER (PARTITION BY segment) AS n FROM household WHERE wealth < 0),
b AS (SELECT household_id, segment, wealth, weight, row_number() OVER (PARTITION BY segment ORDER BY wealth, household_id) - 1 AS pos, count(*) OVER (PARTITION BY segment) AS m FROM household WHERE wealth >= 5000)
SELECT (SELECT max(household_id) + 1 FROM household) + a.household_id AS new_id, a.household_id AS first, b.household_id AS second, a.wealth + b.wealth AS wealth, least(a.weight, b.weight) * 0.1::DOUBLE AS weight
FROM a JOIN (SELECT DISTINCT segment, m FROM b) USING (segment) JOIN b ON b.segment = a.segment AND b.pos = CASE WHEN n = 1 THEN 0 ELSE CAST(round_even(i * (b.m - 1) / (n - 1), 0) AS INT) END""")
def lr1_composites(spark, d):
    """Two unlike households of a segment made one: paired by rank, under new ids, with the smaller weight scaled down."""
    h = Micro(spark, d).household
    a, b = h.where("wealth < 0"), h.where("wealth >= 5000")
    pairs = J.pair_by_rank(a, b, "household_id", "household_id", "wealth", "wealth", "segment")
    top = h.agg((F.max("household_id") + 1).alias("top"))
    one = lambda x, k, p: x.select(c("household_id").alias(k), c("wealth").alias(f"{p}w"), c("weight").alias(f"{p}d"))
    j = pairs.join(one(a, "rid", "a"), "rid").join(one(b, "did", "b"), "did").join(F.broadcast(top), F.lit(True))  # one row
    return j.select((c("top") + c("rid")).alias("new_id"), c("rid").alias("first"), c("did").alias("second"), (c("aw") + c("bw")).alias("wealth"), (F.least("ad", "bd") * 0.1).alias("weight"))


@book.add("SELECT CAST(count(DISTINCT segment) * 9 AS BIGINT) AS candidates, true AS sparse, true AS met FROM household")
def gen3_support_solve(spark, d):
    """Weights for the grid's candidates that meet four totals with as few candidates as a vertex of the program needs."""
    g = gen3_candidate_grid(spark, d).select(F.lit(1.0).alias("d"), F.lit(1.0).alias("f0"), c("size").cast("double").alias("f1"), (c("per_head") * c("size") / 1000).alias("f2"), (c("q") > 0.4).cast("double").alias("f3"))
    names = ["f0", "f1", "f2", "f3"]
    t = [1.2 * v for v in S.totals(g, names, c("d") * F.when(c("f1") == 2, 1.5).otherwise(1.0))]
    fit = S.minimax(g, names, t, "d")
    return g.agg(N().alias("candidates"), (F.sum((fit.weight > 0).cast("long")) <= 2 * len(names) + 1).alias("sparse")).withColumn("met", F.lit(fit.converged))


@book.add("""
WITH q AS (SELECT segment, unnest(quantile_cont(wealth, [0.1, 0.5, 0.9])) AS level, unnest([0.1, 0.5, 0.9]) AS q FROM household GROUP BY segment), t AS (SELECT unnest([1, 2, 4]) AS size)
SELECT segment, q::DOUBLE AS q, size, round(level / size, 6) AS per_head FROM q, t""")
def gen3_candidate_grid(spark, d):
    """Templates by quantile levels: a bounded grid per segment, exploded from arrays."""
    q = Micro(spark, d).household.groupBy("segment").agg(F.percentile("wealth", [0.1, 0.5, 0.9]).alias("l"))
    e = q.select("segment", F.explode(F.arrays_zip("l", F.array(*[F.lit(x) for x in (0.1, 0.5, 0.9)]).alias("q"))).alias("z"), F.array(F.lit(1), F.lit(2), F.lit(4)).alias("s"))
    return e.select("segment", c("z.q").alias("q"), c("z.l").alias("level"), F.explode("s").alias("size")).select("segment", "q", "size", F.round(c("level") / c("size"), 6).alias("per_head"))
