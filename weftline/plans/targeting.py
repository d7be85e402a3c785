"""Target operators (TG), growth (UP) and administrative loading (parts of A and SRC on tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import exprs as X
from weftline.operators import growth as G
from weftline.operators import joins as J
from weftline.operators import targets as T
from weftline.plans.micro import Book, Micro

book = Book()
queries, oracle_sql = (lambda: book.queries), (lambda: book.sql)
c = F.col
N = lambda: F.count(F.lit(1))

FACTORS = [(2022, "population", 1.02), (2022, "prices", 1.11), (2023, "population", 1.01), (2023, "prices", 1.06), (2024, "prices", 1.03)]
_FACTORS = "(VALUES (2022, 'population', 1.02::DOUBLE), (2022, 'prices', 1.11), (2023, 'population', 1.01), (2023, 'prices', 1.06), (2024, 'prices', 1.03)) f(from_year, kind, factor)"


@book.add(f"""SELECT target_id, variable, period, CASE WHEN period = 2025 THEN 1 ELSE coalesce(factor, 1) END AS factor, round(value * CASE WHEN period = 2025 THEN 1 ELSE coalesce(factor, 1) END, 4) AS uprated
FROM target LEFT JOIN {_FACTORS} ON from_year = period AND kind = CASE WHEN variable LIKE '%\\_count' ESCAPE '\\' THEN 'population' ELSE 'prices' END WHERE value IS NULL OR NOT isnan(value)""")
def tg1_uprating(spark: SparkSession, d: str) -> DataFrame:
    f = spark.createDataFrame(FACTORS, "from_year int, kind string, factor double")
    t = Micro(spark, d).targets.where("value IS NULL OR NOT isnan(value)")
    return T.uprate(t, J.small(f), 2025).select("target_id", "variable", "period", c("uprating_factor").alias("factor"), F.round("uprated", 4).alias("uprated"))


_HIER = """
WITH d AS (SELECT segment AS domain, 'agi' AS variable, 'district' AS geo_level, state, district, sum(agi) AS value FROM unit JOIN household USING (household_id) GROUP BY ALL),
s AS (SELECT domain, variable, state, sum(value) * (1 + state / 10.0::DOUBLE) AS state_value FROM d WHERE state <> 2 GROUP BY domain, variable, state)
"""


def _hierarchy(spark: SparkSession, d: str) -> DataFrame:
    m = Micro(spark, d)
    u = m.unit.join(m.household.select("household_id", "segment", "state", "district"), "household_id")
    dist = u.groupBy(c("segment").alias("domain"), F.lit("agi").alias("variable"), F.lit("district").alias("geo_level"), "state", "district").agg(F.sum("agi").alias("value"))
    st = dist.where("state <> 2").groupBy("domain", "variable", "state").agg((F.sum("value") * (1 + c("state") / 10.0)).alias("value")).withColumns({"geo_level": F.lit("state"), "district": F.lit(None).cast("int")})
    return dist.unionByName(st)


@book.add(_HIER + """SELECT domain, variable, d.state, district, round(state_value / sum(value) OVER (PARTITION BY domain, variable, d.state), 8) AS hif,
round(CASE WHEN state_value IS NOT NULL THEN value * state_value / sum(value) OVER (PARTITION BY domain, variable, d.state) * CASE WHEN d.state = 1 THEN 1.25::DOUBLE ELSE 1 END ELSE value END, 4) AS reconciled FROM d LEFT JOIN s USING (domain, variable, state)""")
def tg2_reconcile(spark, d):
    f = spark.createDataFrame([(1, "agi", 1.25)], "state int, variable string, factor double")
    return T.reconcile(_hierarchy(spark, d), f).select("domain", "variable", "state", "district", F.round("hif", 8).alias("hif"), F.round("reconciled", 4).alias("reconciled"))


@book.add(_HIER + """, x AS (SELECT *, sum(value) OVER (PARTITION BY domain, state) AS t FROM d)
SELECT domain, state, district, round(CASE WHEN abs(t - state_value) > 1e-8 + 1e-3 * abs(state_value) AND t <> 0 THEN value * state_value / t ELSE value END, 4) AS rescaled FROM x LEFT JOIN s USING (domain, state)""")
def tg3_rescale_children(spark, d):
    h = _hierarchy(spark, d)
    kids = h.where("geo_level = 'district'").select("domain", "state", "district", "value")
    return T.rescale_children(h.where("geo_level = 'state'"), kids, ["domain", "state"]).select("domain", "state", "district", F.round("rescaled", 4).alias("rescaled"))


@book.add("WITH s AS (SELECT state, segment, sum(wealth) AS v FROM household GROUP BY ALL) SELECT state, segment, round(v * 1000000 / sum(v) OVER (PARTITION BY segment), 4) AS scaled FROM s")
def tg4_scale_to_national(spark, d):
    s = Micro(spark, d).household.groupBy("state", "segment").agg(F.sum("wealth").alias("v"))
    return T.scale_to_total(s, ["segment"], "v", F.lit(1000000.0)).select("state", "segment", F.round("scaled", 4).alias("scaled"))


@book.add("""
WITH t AS (SELECT DISTINCT target_id, variable, geo_level, domain_variable FROM target_overview), g AS (SELECT CASE geo_level WHEN 'national' THEN 0 WHEN 'state' THEN 1 ELSE 2 END AS level, domain_variable, variable, count(*) AS n_targets FROM t GROUP BY ALL)
SELECT level, domain_variable, variable, n_targets, CAST(row_number() OVER (ORDER BY level, domain_variable NULLS FIRST, variable) - 1 AS INT) AS group_id FROM g""")
def tg5_target_groups(spark, d):
    return T.target_groups(Micro(spark, d).raw("target_overview").select("target_id", "variable", "geo_level", "domain_variable").distinct())


@book.add("""
WITH spec AS (SELECT * FROM (VALUES ('all', 0.0::DOUBLE, 'Infinity'::DOUBLE, 'any'), ('low F', 0.0, 100000.0, 'F'), ('high F', 100000.0, 'Infinity'::DOUBLE, 'F'), ('mid O', 50000.0, 200000.0, 'O')) s(label, lo, hi, st))
SELECT household_id, label, round(sum(agi), 2) AS val, count(*) AS n FROM unit JOIN spec ON agi >= lo AND agi < hi AND (st = 'any' OR st = status) GROUP BY ALL""")
def tg6_loss_rows(spark, d):
    """Every label column of a loss matrix as long rows, from one table of specifications."""
    inf = float("inf")
    spec = spark.createDataFrame([("all", 0.0, inf, "any"), ("low F", 0.0, 100000.0, "F"), ("high F", 100000.0, inf, "F"), ("mid O", 50000.0, 200000.0, "O")], "label string, lo double, hi double, st string")
    j = J.band_join(Micro(spark, d).unit, spec, c("agi"), "lo", "hi", 50000.0).where("st = 'any' OR st = status")
    return j.groupBy("household_id", "label").agg(F.round(F.sum("agi"), 2).alias("val"), N().alias("n"))


@book.add("""
WITH k AS (SELECT unit_id, least(count(*) FILTER (age < 18), 3) AS kids FROM person GROUP BY 1), u AS (SELECT coalesce(kids, 0) AS kids, agi, weight, state FROM unit JOIN household USING (household_id) LEFT JOIN k USING (unit_id))
SELECT kids, state, sum(weight) AS returns, round(sum(weight * agi), 2) AS amount FROM u WHERE agi < 250000 GROUP BY ALL""")
def tg7_returns_by_children(spark, d):
    m = Micro(spark, d)
    k = m.person.where("age < 18").groupBy("unit_id").agg(N().alias("kids"))
    u = J.lookup(m.unit.join(m.household.select("household_id", "weight", "state"), "household_id"), k, "unit_id", {"kids": 0}).where("agi < 250000")
    return u.groupBy(X.child_bucket(c("kids")).alias("kids"), "state").agg(F.sum("weight").alias("returns"), F.round(F.sum(c("weight") * c("agi")), 2).alias("amount"))


@book.add("""
WITH b AS (SELECT * FROM (VALUES ('low', '-Infinity'::DOUBLE, 100000.0::DOUBLE, 5000.0::DOUBLE), ('mid', 100000.0, 250000.0, 0.0), ('high', 250000.0, 'Infinity'::DOUBLE, 9000.0)) b(band, lo, hi, target)), e AS (SELECT band, target, sum(weight) AS est FROM unit JOIN household USING (household_id) JOIN b ON agi >= lo AND agi < hi GROUP BY ALL)
SELECT band, est, target, abs(est - target) AS abs_error, round(CASE WHEN target = 0 THEN 0 ELSE (est - target) / abs(target) END, 8) AS rel_error FROM e""")
def tg8_replication_report(spark, d):
    inf = float("inf")
    m = Micro(spark, d)
    b = spark.createDataFrame([("low", -inf, 100000.0, 5000.0), ("mid", 100000.0, 250000.0, 0.0), ("high", 250000.0, inf, 9000.0)], "band string, lo double, hi double, target double")
    e = J.band_join(m.unit.join(m.household.select("household_id", "weight"), "household_id"), b, c("agi"), "lo", "hi", 50000.0).groupBy("band", "target").agg(F.sum("weight").alias("est"))
    return e.select("band", "est", "target", F.abs(c("est") - c("target")).alias("abs_error"), F.round(X.relative_error(c("est"), c("target")), 8).alias("rel_error"))


@book.add("""
SELECT CASE WHEN state = 'AL' THEN 'x' ELSE state END AS area, variable, CASE WHEN variable LIKE 'aptc%' THEN value ELSE value * 1000 END AS value FROM (SELECT state, unnest(['enroll_2022', 'enroll_2024', 'aptc_2022', 'aptc_2024']) AS variable, unnest([enroll_2022::DOUBLE, enroll_2024::DOUBLE, aptc_2022, aptc_2024]) AS value FROM aca_ptc_multipliers) WHERE value IS NOT NULL""")
def tg9_tg10_load_long(spark, d):
    """A wide administrative table as long target records, counts scaled by 1000."""
    from weftline.operators.targets import load_long

    w = Micro(spark, d).raw("aca_ptc_multipliers").withColumn("area", F.when(c("state") == "AL", "x").otherwise(c("state")))
    return load_long(w, "area", {"enroll_2022": 1000.0, "enroll_2024": 1000.0, "aptc_2022": 1.0, "aptc_2024": 1.0})


@book.add("""
WITH p AS (SELECT stratum_id, bool_and(variable IN ('state_fips', 'congressional_district_geoid')) AS pure, max(value) FILTER (variable = 'congressional_district_geoid') AS d, max(value) FILTER (variable = 'state_fips') AS s FROM constr GROUP BY 1)
SELECT stratum_id, coalesce(d, s, 'US') AS geographic_id FROM living LEFT JOIN p USING (stratum_id) WHERE coalesce(pure, true)""")
def tg11_geographic_strata(spark, d):
    m = Micro(spark, d)
    return T.geographic_strata(m.strata, m.constraints)


@book.add("""
WITH y AS (SELECT period, segment, sum(agi) AS v, count(*) AS pop FROM unit JOIN household USING (household_id) GROUP BY ALL), b AS (SELECT segment, v AS v0, pop AS p0 FROM y WHERE period = 1996)
SELECT segment, period, round((v / pop) / (v0 / p0), 3) AS per_head, round(v / v0, 3) AS plain FROM y JOIN b USING (segment)""")
def up1_growth_table(spark, d):
    m = Micro(spark, d)
    y = m.unit.join(m.household.select("household_id", "segment"), "household_id").groupBy("period", "segment").agg(F.sum("agi").alias("v"), N().alias("pop"))
    return G.growth_index(y, "segment", "period", "v", "pop", 1996)


@book.add("""
WITH g AS (SELECT period, sum(agi) AS v FROM unit GROUP BY 1), r AS (SELECT a.period, b.v / a.v AS f FROM g a, g b WHERE b.period = 1998) SELECT unit_id, round(agi * f, 2) AS uprated FROM unit JOIN r USING (period)""")
def up2_apply_growth(spark, d):
    u = Micro(spark, d).unit
    return G.apply_growth(u, u.groupBy("period").agg(F.sum("agi").alias("v")), "period", "v", 1998, "agi").select("unit_id", F.round("agi", 2).alias("uprated"))


@book.add("""SELECT household_id, round(CASE WHEN wealth > 0 THEN wealth * 1.2::DOUBLE / 1.05 ELSE wealth * 0.8::DOUBLE / 1.05 END, 4) AS uprated, round(weight * 1.05::DOUBLE, 4) AS weight FROM household""")
def up3_signed_uprating(spark, d):
    return G.signed_uprating(Micro(spark, d).household, "wealth", 1.2, 0.8, 1.05, "weight").select("household_id", F.round("wealth", 4).alias("uprated"), F.round("weight", 4).alias("weight"))


@book.add("""
WITH RECURSIVE g AS (SELECT * FROM (VALUES (1, 1.031), (2, 1.044), (3, 0.99), (4, 1.052), (5, 1.027)) g(i, f)), k AS (SELECT r_regionkey AS region, 0 AS i, 10000.0::DOUBLE + 137 * r_regionkey AS v FROM region UNION ALL SELECT region, k.i + 1, floor(v * f::DOUBLE / 50) * 50 FROM k JOIN g ON g.i = k.i + 1)
SELECT region, i AS step, v FROM k""")
def lr3_indexed_thresholds(spark, d):
    """Thresholds indexed year by year with rounding that compounds: a fold over the ordered growth factors."""
    r = Micro(spark, d).raw("region").select(c("r_regionkey").alias("region"), (F.lit(10000.0) + 137 * c("r_regionkey")).alias("v"))
    return G.indexed_thresholds(r, "v", [1.031, 1.044, 0.99, 1.052, 1.027], 50.0).select("region", "step", "v")


@book.add("""
WITH g AS (SELECT state, unnest([2022, 2024, 2025]) AS y, unnest([enroll_2022, enroll_2024, enroll_2025]) AS v FROM aca_ptc_multipliers)
SELECT state, round(max(v) FILTER (y = 2025) / max(v) FILTER (y = 2022), 6) AS vol_mult, coalesce(max(v) FILTER (y = 2024), 0) AS v2024 FROM g GROUP BY 1""")
def up4_ratio_to_base(spark, d):
    m = Micro(spark, d).raw("aca_ptc_multipliers").unpivot("state", ["enroll_2022", "enroll_2024", "enroll_2025"], "m", "v").withColumn("y", F.substring("m", 8, 4).cast("int"))
    at = lambda y: F.max(F.when(c("y") == y, c("v")))
    return m.groupBy("state").agg(F.round(at(2025) / at(2022), 6).alias("vol_mult"), F.coalesce(at(2024), F.lit(0)).alias("v2024"))
