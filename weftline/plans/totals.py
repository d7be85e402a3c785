"""Aggregations (A of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import exprs as X
from weftline.operators import clone as C
from weftline.operators import entities as E
from weftline.operators import etl
from weftline.operators import joins as J
from weftline.operators import targets as T
from weftline.plans.micro import Book, Micro

book = Book()
queries, oracle_sql = (lambda: book.queries), (lambda: book.sql)
c = F.col
N = lambda: F.count(F.lit(1))

_TARGETS = """
WITH hh AS (SELECT household_id, 'amount' AS target, CASE WHEN bool_or(age > 30 AND flag = 'R') THEN max(wealth) ELSE 0 END AS contribution FROM person JOIN household USING (household_id) GROUP BY 1
  UNION ALL SELECT household_id, 'unit_amount', sum(CASE WHEN ok THEN agi ELSE 0 END) FROM (SELECT household_id, unit_id, bool_or(age > 30 AND flag = 'R') AS ok FROM person GROUP BY ALL) JOIN unit USING (unit_id, household_id) GROUP BY 1
  UNION ALL SELECT household_id, 'unit_count', sum(CASE WHEN ok THEN 1 ELSE 0 END) FROM (SELECT household_id, unit_id, bool_or(age > 30 AND flag = 'R') AS ok FROM person GROUP BY ALL) GROUP BY 1
  UNION ALL SELECT household_id, 'person_count', count(*) FILTER (age > 30 AND flag = 'R') FROM person GROUP BY 1),
e AS (SELECT target, contribution * weight AS v, state, district FROM hh JOIN household USING (household_id)),
a AS (SELECT target, 'national' AS geo_level, 'US' AS geographic_id, sum(v) AS estimate FROM e GROUP BY 1
  UNION ALL SELECT target, 'state', CAST(state AS VARCHAR), sum(v) FROM e GROUP BY 1, 3 UNION ALL SELECT target, 'district', CAST(district AS VARCHAR), sum(v) FROM e GROUP BY 1, 3)
"""


def target_table(spark: SparkSession, d: str) -> DataFrame:
    """Four entity-aware targets under one two-constraint stratum, for nation, states and districts."""
    m = Micro(spark, d)
    p = m.person.join(m.unit.select("unit_id", "agi"), "unit_id").join(m.household.select("household_id", "wealth"), "household_id")
    cond = X.conjunction([("age", ">", "30"), ("flag", "==", "R")], p.columns)
    specs = [("amount", cond, "household", c("wealth")), ("unit_amount", cond, "unit", c("agi")), ("unit_count", cond, "unit", None), ("person_count", cond, "person", None)]
    both = E.targets_together(p, "unit_id", "household_id", specs)
    return E.by_geography(both, m.household)


@book.add(_TARGETS + "SELECT target, geo_level, geographic_id, round(estimate, 2) AS estimate, 1000000.0::DOUBLE AS value, round((estimate - 1000000.0) / 1000000.0, 6) AS rel_error FROM a")
def a3_entity_targets(spark, d):
    """The flagship: estimate, target and relative error of every target and geography."""
    t = target_table(spark, d)
    v = F.lit(1000000.0)
    return t.select("target", "geo_level", "geographic_id", F.round("estimate", 2).alias("estimate"), v.alias("value"), F.round(X.relative_error(c("estimate"), v), 6).alias("rel_error"))


@book.add("SELECT segment, round(sum(wealth * weight), 2) AS total, sum(weight) FILTER (wealth > 0) AS positives FROM household GROUP BY 1")
def a1_a2_weighted_totals(spark: SparkSession, d: str) -> DataFrame:
    return Micro(spark, d).household.groupBy("segment").agg(F.round(F.sum(c("wealth") * c("weight")), 2).alias("total"), F.sum(F.when(c("wealth") > 0, c("weight"))).alias("positives"))


@book.add("""
WITH h AS (SELECT household_id, max(wealth) AS base, bool_or(flag = 'A') AS ok FROM person JOIN household USING (household_id) GROUP BY 1)
SELECT household_id, round(CASE WHEN ok THEN base * 0.9::DOUBLE - base ELSE 0 END, 4) AS delta FROM h""")
def a6_reform_delta(spark, d):
    m = Micro(spark, d)
    p = m.person.join(m.household.select("household_id", "wealth"), "household_id")
    return E.target_values(p, c("flag") == "A", "household_id", "household_id", c("wealth") * 0.9 - c("wealth")).select("household_id", F.round("contribution", 4).alias("delta"))


@book.add("""
WITH b AS (SELECT CASE WHEN agi < 10000 THEN 'under 10k' WHEN agi < 50000 THEN '10k-50k' WHEN agi < 100000 THEN '50k-100k' WHEN agi < 250000 THEN '100k-250k' ELSE '250k+' END AS band, status, agi, weight FROM unit JOIN household USING (household_id)),
g AS (SELECT band, status, sum(weight) AS w, sum(agi * weight) AS a FROM b GROUP BY ALL),
k AS (SELECT x.band, y.status FROM (SELECT unnest(['under 10k', '10k-50k', '50k-100k', '100k-250k', '250k+']) AS band) x, (SELECT unnest(['F', 'O', 'P', 'X']) AS status) y)
SELECT band, status, coalesce(w, 0) AS units, round(coalesce(a, 0), 2) AS amount FROM k LEFT JOIN g USING (band, status)
UNION ALL SELECT band, 'all', coalesce(sum(w), 0), round(coalesce(sum(a), 0), 2) FROM k LEFT JOIN g USING (band, status) GROUP BY 1""")
def a7_zero_filled_table(spark, d):
    """Bands by status with their margin from one pass (grouping sets by rollup); empty cells are zero."""
    from weftline.plans.rules import BANDS, LABELS

    m = Micro(spark, d)
    u = m.unit.join(m.household.select("household_id", "weight"), "household_id").withColumn("band", X.band(c("agi"), BANDS, LABELS))
    g = u.rollup("band", "status").agg(F.grouping("status").alias("margin"), F.sum("weight").alias("units"), F.sum(c("agi") * c("weight")).alias("amount")).where(c("band").isNotNull())
    g = g.select("band", F.when(c("margin") == 1, "all").otherwise(c("status")).alias("status"), "units", "amount")
    keys = spark.createDataFrame([(b, s) for b in LABELS for s in ("F", "O", "P", "X", "all")], "band string, status string")
    return J.lookup(keys, g, ["band", "status"], {"units": 0.0, "amount": 0.0}).select("band", "status", "units", F.round("amount", 2).alias("amount"))


@book.add("""
WITH k AS (SELECT stratum_id, max((variable = 'congressional_district_geoid' OR (variable = 'ucgid_str' AND length(value) = 13))::INT) AS d, max((variable = 'state_fips' OR (variable = 'ucgid_str' AND length(value) = 11))::INT) AS s,
  coalesce(max(value) FILTER (variable = 'congressional_district_geoid'), max(value) FILTER (variable = 'state_fips'), max(value) FILTER (variable = 'ucgid_str'), 'US') AS geographic_id,
  string_agg(DISTINCT variable, ',' ORDER BY variable) FILTER (variable NOT IN ('state_fips', 'congressional_district_geoid', 'tax_unit_is_filer', 'ucgid_str')) AS domain_variable FROM constr GROUP BY 1)
SELECT target_id, variable, period, CASE WHEN d = 1 THEN 'district' WHEN s = 1 THEN 'state' ELSE 'national' END AS geo_level, coalesce(geographic_id, 'US') AS geographic_id, domain_variable FROM target LEFT JOIN k USING (stratum_id)""")
def a8_a9_target_overview(spark, d):
    m = Micro(spark, d)
    return T.target_overview(m.targets, m.constraints).select("target_id", "variable", "period", "geo_level", "geographic_id", "domain_variable")


@book.add("""SELECT variable, period, round(sum(value) FILTER (geo_level = 'national'), 2) AS national_sum, count(value) FILTER (geo_level = 'national') AS national_n, round(sum(value) FILTER (geo_level = 'state'), 2) AS state_sum, count(value) FILTER (geo_level = 'state') AS state_n,
round(sum(value) FILTER (geo_level = 'district'), 2) AS district_sum, count(value) FILTER (geo_level = 'district') AS district_n FROM (SELECT DISTINCT target_id, variable, period, geo_level, value FROM target_overview WHERE value IS NOT NULL AND NOT isnan(value)) GROUP BY ALL""")
def a10_pivot_levels(spark, d):
    t = Micro(spark, d).raw("target_overview").where("value IS NOT NULL AND NOT isnan(value)").select("target_id", "variable", "period", "geo_level", "value").distinct()
    p = t.groupBy("variable", "period").pivot("geo_level", ["national", "state", "district"]).agg(F.round(F.sum("value"), 2).alias("sum"), F.count("value").alias("n"))
    return p.fillna(0, ["national_n", "state_n", "district_n"])


@book.add("SELECT segment, round(sum(agi) FILTER (period = 1996), 2) AS \"1996\", round(sum(agi) FILTER (period = 1997), 2) AS \"1997\", round(sum(agi) FILTER (period = 1998), 2) AS \"1998\" FROM unit JOIN household USING (household_id) GROUP BY 1")
def a11_pivot_years(spark, d):
    m = Micro(spark, d)
    return m.unit.join(m.household.select("household_id", "segment"), "household_id").groupBy("segment").pivot("period", [1996, 1997, 1998]).agg(F.round(F.sum("agi"), 2))


@book.add("SELECT state, unnest(['enroll_2022', 'enroll_2024', 'enroll_2025']) AS measure, unnest([enroll_2022, enroll_2024, enroll_2025]) AS value FROM aca_ptc_multipliers")
def a12_melt(spark, d):
    return Micro(spark, d).raw("aca_ptc_multipliers").unpivot("state", ["enroll_2022", "enroll_2024", "enroll_2025"], "measure", "value")


@book.add("""
WITH k AS (SELECT cd_geoid, left(block_geoid, 5) AS county, sum(probability) AS p FROM block_distribution GROUP BY ALL), f AS (SELECT * FROM k WHERE p > 0.0005)
SELECT county, cd_geoid, round(p / sum(p) OVER (PARTITION BY county), 10) AS share FROM f""")
def a13_a14_group_share(spark, d):
    k = Micro(spark, d).raw("block_distribution").groupBy("cd_geoid", F.substring("block_geoid", 1, 5).alias("county")).agg(F.sum("probability").alias("p")).where("p > 0.0005")
    return C.shares(k, "p", ["county"]).select("county", "cd_geoid", F.round("share", 10).alias("share"))


@book.add("""
WITH mapping AS (SELECT n_nationkey AS old, CASE WHEN n_nationkey < 20 THEN n_nationkey + 100 ELSE n_nationkey END AS new, 0.75::DOUBLE AS share FROM nation UNION ALL SELECT n_nationkey, (n_nationkey * 3) % 20 + 100, 0.25 FROM nation), v AS (SELECT district, sum(wealth) AS v FROM household GROUP BY 1)
SELECT new AS district, round(sum(v * share), 4) AS v FROM v JOIN mapping ON old = district GROUP BY 1""")
def a15_redistribute(spark, d):
    m = Micro(spark, d)
    n = c("n_nationkey")
    a = m.raw("nation").select(n.alias("old"), F.when(n < 20, n + 100).otherwise(n).alias("new"), F.lit(0.75).alias("share"))
    b = m.raw("nation").select(n.alias("old"), ((n * 3) % 20 + 100).alias("new"), F.lit(0.25).alias("share"))
    v = m.household.groupBy("district").agg(F.sum("wealth").alias("v"))
    return etl.redistribute(v, a.unionByName(b), "district", "v").select("district", F.round("v", 4).alias("v"))


@book.add("SELECT household_id, max(wealth) OVER (PARTITION BY state) AS top, count(*) OVER (PARTITION BY district) AS n FROM household")
def a16_a19_group_broadcast(spark, d):
    h = Micro(spark, d).household
    return h.join(h.groupBy("state").agg(F.max("wealth").alias("top")), "state").join(h.groupBy("district").agg(N().alias("n")), "district").select("household_id", "top", "n")


@book.add("""SELECT household_id, max(age) AS oldest, round(sum(earnings), 4) AS earnings, count(*) AS members, count(*) FILTER (age < 18) AS minors, round(arg_max(gross, (age, -line, -part, -supp, gross)), 2) AS reference_gross,
bool_or(flag = 'A') AND bool_or(flag = 'R') AS mixed FROM person GROUP BY 1""")
def a17_a18_a21_household_summary(spark, d):
    return Micro(spark, d).person.groupBy("household_id").agg(
        F.max("age").alias("oldest"), F.round(F.sum("earnings"), 4).alias("earnings"), N().alias("members"), F.count(F.when(c("age") < 18, 1)).alias("minors"),
        F.round(F.max(F.struct("age", (-c("line")).alias("l"), (-c("part")).alias("p"), (-c("supp")).alias("s"), "gross"))["gross"], 2).alias("reference_gross"), (F.max(c("flag") == "A") & F.max(c("flag") == "R")).alias("mixed"))


@book.add("SELECT household_id, CAST(CASE WHEN least(age, 45) >= 45 THEN 45 ELSE floor(age / 5) * 5 END AS INT) AS bin, count(*) AS n FROM person GROUP BY ALL")
def a20_age_histogram(spark, d):
    return etl.age_histogram(Micro(spark, d).person, "household_id", "age", 5, 45)


@book.add("SELECT segment, district, max(weight) AS weight FROM household GROUP BY ALL")
def a22_group_max(spark, d):
    return Micro(spark, d).household.groupBy("segment", "district").agg(F.max("weight").alias("weight"))


@book.add("""
WITH r AS (SELECT household_id, agi, row_number() OVER (PARTITION BY household_id ORDER BY agi DESC, unit_id) AS k FROM unit), m AS (SELECT household_id, min(agi) AS v FROM r WHERE k <= 2 GROUP BY 1)
SELECT household_id, coalesce(v, 0) AS cap FROM household LEFT JOIN m USING (household_id)""")
def a23_min_of_top_two(spark, d):
    """By keeping the two largest of each group in one mergeable aggregate, without ranking the group."""
    m = Micro(spark, d)
    return J.lookup(m.household.select("household_id"), etl.second_largest(m.unit, "household_id", "agi", "cap"), "household_id", {"cap": 0.0})


@book.add("""
WITH t AS (SELECT DISTINCT target_id, variable, geo_level, value FROM target_overview) SELECT variable, geo_level, count(*) AS n, count(*) FILTER (value > 50000 AND NOT isnan(value)) AS achieved, count(*) FILTER (NOT coalesce(value > 50000 AND NOT isnan(value), false)) AS impossible FROM t GROUP BY ALL""")
def a24_achievable_counts(spark, d):
    t = Micro(spark, d).raw("target_overview").select("target_id", "variable", "geo_level", "value").distinct()
    ok = F.coalesce((c("value") > 50000) & ~F.isnan("value"), F.lit(False))
    return t.groupBy("variable", "geo_level").agg(N().alias("n"), F.sum(ok.cast("long")).alias("achieved"), F.sum((~ok).cast("long")).alias("impossible"))


@book.add("SELECT district, round(sum(weight * (CASE WHEN wealth < 0 THEN 500 ELSE wealth * 0.01::DOUBLE END)), 2) AS impact, count(*) FILTER (wealth < 0) AS helped FROM household GROUP BY 1")
def a25_area_impact(spark, d):
    change = F.when(c("wealth") < 0, 500.0).otherwise(c("wealth") * 0.01)
    return Micro(spark, d).household.groupBy("district").agg(F.round(F.sum(c("weight") * change), 2).alias("impact"), F.count(F.when(c("wealth") < 0, 1)).alias("helped"))


@book.add("""
WITH r AS (SELECT wealth, weight, sum(weight) OVER (ORDER BY wealth, household_id) AS cum, sum(weight) OVER () AS tot FROM household), d AS (SELECT least(CAST(floor((cum - weight / 2) / tot * 10) AS INT) + 1, 10) AS decile, wealth, weight FROM r)
SELECT decile, round(sum(greatest(wealth, 0) * 0.2::DOUBLE * weight) / sum(abs(wealth) * weight), 8) AS rate FROM d GROUP BY 1""")
def a26_rate_by_decile(spark, d):
    from weftline.operators.weights import weighted_rank_share

    h = weighted_rank_share(Micro(spark, d).household, "wealth", "weight", "household_id")
    dec = F.least(F.floor(c("mid_share") * 10).cast("int") + 1, F.lit(10))
    return h.groupBy(dec.alias("decile")).agg(F.round(F.sum(F.greatest(c("wealth"), F.lit(0.0)) * 0.2 * c("weight")) / F.sum(F.abs("wealth") * c("weight")), 8).alias("rate"))


@book.add("SELECT t AS threshold, count(*) AS n, round(sum(agi), 2) AS total FROM unit, (SELECT unnest([100000.0, 250000.0, 400000.0])::DOUBLE AS t) WHERE agi >= t GROUP BY 1")
def a27_thresholds(spark, d):
    """Overlapping thresholds as sums of disjoint bands, so that no row is repeated."""
    return etl.at_or_above(Micro(spark, d).unit, "agi", [100000.0, 250000.0, 400000.0]).select("threshold", "n", F.round("total", 2).alias("total"))


@book.add("""
WITH f AS (SELECT household_id, weight, wealth > 5000 AS rich, segment = 'BUILDING' AS builder, weight >= 4 AS heavy FROM household), l AS (SELECT household_id, weight, unnest(['rich', 'builder', 'heavy']) AS p, unnest([rich, builder, heavy]) AS v FROM f)
SELECT a.p AS first, b.p AS second, sum(a.weight) AS joint FROM l a JOIN l b USING (household_id) WHERE a.v AND b.v AND a.p < b.p GROUP BY ALL""")
def a28_joint_participation(spark, d):
    h = Micro(spark, d).household.select("weight", (c("wealth") > 5000).alias("rich"), (c("segment") == "BUILDING").alias("builder"), (c("weight") >= 4).alias("heavy"))
    return etl.joint_flags(h, ["builder", "heavy", "rich"], "weight")


@book.add("""
WITH a AS (SELECT segment, sum(wealth * weight) AS survey FROM household GROUP BY 1) SELECT segment, round(survey, 2) AS survey, round(5000000 / survey, 8) AS factor, segment IN ('BUILDING', 'MACHINERY') AS listed FROM a""")
def a29_under_reporting(spark, d):
    a = Micro(spark, d).household.groupBy("segment").agg(F.sum(c("wealth") * c("weight")).alias("survey"))
    return a.select("segment", F.round("survey", 2).alias("survey"), F.round(F.coalesce(F.try_divide(F.lit(5000000.0), c("survey")), F.lit(float("inf"))), 8).alias("factor"), c("segment").isin("BUILDING", "MACHINERY").alias("listed"))


@book.add("SELECT state, round(sum(wealth * weight), 2) AS total, sum(weight) AS households FROM household GROUP BY 1")
def a30_state_totals(spark, d):
    return Micro(spark, d).household.groupBy("state").agg(F.round(F.sum(c("wealth") * c("weight")), 2).alias("total"), F.sum("weight").alias("households"))


@book.add("""
WITH r AS (SELECT CASE WHEN agi / 15000 < 1.38 THEN 'low' WHEN agi / 15000 < 4 THEN 'middle' ELSE 'high' END AS bracket, agi FROM unit) SELECT bracket, count(*) AS n, round(avg(agi), 4) AS mean FROM r GROUP BY 1""")
def a31_ratio_bands(spark, d):
    inf = float("inf")
    return Micro(spark, d).unit.groupBy(X.band(c("agi") / 15000, [-inf, 1.38, 4.0, inf], ["low", "middle", "high"]).alias("bracket")).agg(N().alias("n"), F.round(F.avg("agi"), 4).alias("mean"))


@book.add("""
WITH t AS (SELECT state, count(*) AS n FROM household GROUP BY 1), b AS (SELECT state, count(*) AS n FROM household WHERE segment = 'BUILDING' GROUP BY 1) SELECT state, round(b.n / t.n, 10) AS share FROM t JOIN b USING (state) WHERE t.n > 0""")
def a32_a33_rates(spark, d):
    h = Micro(spark, d).household.groupBy("state").agg(N().alias("n"), F.count(F.when(c("segment") == "BUILDING", 1)).alias("b"))
    return h.where("b > 0").select("state", F.round(c("b") / c("n"), 10).alias("share"))


@book.add("SELECT CAST(age AS INT) AS age, sum(weight) AS population FROM person JOIN household USING (household_id) GROUP BY 1")
def a34_population_by_age(spark, d):
    m = Micro(spark, d)
    return m.person.join(m.household.select("household_id", "weight"), "household_id").groupBy(c("age").cast("int").alias("age")).agg(F.sum("weight").alias("population"))


@book.add("""SELECT segment, round(CASE WHEN sum(weight) = 0 THEN 0 ELSE sum(wealth * weight) / sum(weight) END, 6) AS mean, round(sum(weight) / sum(sum(weight)) OVER (), 10) AS share, round(avg(wealth), 6) AS plain FROM household GROUP BY 1""")
def a35_weighted_profile(spark, d):
    from weftline.operators.weights import weighted_profile

    p = weighted_profile(Micro(spark, d).household, "segment", "wealth", "weight")
    return p.select("segment", F.round("mean", 6).alias("mean"), F.round("share", 10).alias("share"), F.round("plain", 6).alias("plain"))


@book.add("""
WITH s AS (SELECT household_id, sum(agi) AS agi, count(*) AS n FROM unit GROUP BY 1), h AS (SELECT household_id, unit_id, priority FROM (SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY agi DESC, unit_id) AS k FROM unit) WHERE k = 1)
SELECT household_id, round(agi, 2) AS agi, n, unit_id AS head, priority FROM s JOIN h USING (household_id)""")
def a36_head_join(spark, d):
    """Aggregate and head in one pass: the head is the aggregate's largest entry."""
    top = F.max(F.struct("agi", (-c("unit_id")).alias("o"), "unit_id", "priority")).alias("h")
    return Micro(spark, d).unit.groupBy("household_id").agg(F.sum("agi").alias("agi"), N().alias("n"), top).select("household_id", F.round("agi", 2).alias("agi"), "n", c("h.unit_id").alias("head"), c("h.priority").alias("priority"))


@book.add("SELECT o_custkey AS household_id, CAST(year(o_orderdate) AS INT) AS y, round_even(round(sum(o_totalprice), 2) * 12 / count(DISTINCT month(o_orderdate)), 0) AS annual FROM orders GROUP BY ALL")
def a37_annualise(spark, d):
    o = Micro(spark, d).raw("orders")
    return etl.annualise(o, [c("o_custkey").alias("household_id"), F.year("o_orderdate").alias("y")], F.month("o_orderdate"), c("o_totalprice"), "annual")
