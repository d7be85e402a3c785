"""Validation and diagnostics (V), sources (SRC), sinks (SNK) and the streaming extension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import exprs as X
from weftline.operators import etl
from weftline.operators import targets as T
from weftline.operators import validate as V
from weftline.operators import matrix as MX
from weftline.plans.geography import _MX, _package
from weftline.plans.micro import Book, Micro
from weftline.session import driver_folder, scratch
from weftline.sources import files as FS
from weftline.streaming import events as EV

book = Book()
queries, oracle_sql = (lambda: book.queries), (lambda: book.sql)
c = F.col
N = lambda: F.count(F.lit(1))


@book.add("""
WITH x AS (SELECT count(*) FILTER (coalesce(household_weight < 0, false)) AS a, count(*) FILTER (household_weight IS NULL OR isnan(household_weight)) AS b, count(*) FILTER (length(block_geoid) <> 15) AS k, count(*) FILTER (county_fips <> left(block_geoid, 5)) AS d, count(*) FILTER (state_fips IS NOT NULL AND lpad(CAST(state_fips AS VARCHAR), 2, '0') <> left(block_geoid, 2)) AS e FROM geography_assignment)
SELECT "check", failing, CASE WHEN failing = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT unnest(['negative weight', 'missing weight', 'bad block', 'county differs', 'state differs']) AS "check", unnest([a, b, k, d, e]) AS failing FROM x)""")
def v1_sanity(spark: SparkSession, d: str) -> DataFrame:
    """All structural checks of a table in one pass."""
    w = c("household_weight")
    return V.sanity(Micro(spark, d).raw("geography_assignment"), {
        "negative weight": w < 0, "missing weight": w.isNull() | F.isnan(w), "bad block": F.length("block_geoid") != 15,
        "county differs": c("county_fips") != F.substring("block_geoid", 1, 5), "state differs": F.lpad(c("state_fips").cast("string"), 2, "0") != F.substring("block_geoid", 1, 2),
    })


@book.add("""
SELECT * FROM (VALUES ('skipped', 'not negative household.rent', 'SKIP', 0), ('skipped', 'household.rent per household', 'SKIP', 0), ('skipped', 'person in household by household', 'SKIP', 0)) v(part, "check", status, failing)
UNION ALL SELECT 'weight', 'not negative household.weight', 'PASS', 0 UNION ALL SELECT 'wealth', 'not negative household.wealth', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, n FROM (SELECT count(*) FILTER (wealth < 0) AS n FROM household)
UNION ALL SELECT 'finite', 'finite household.wealth', 'PASS', 0 UNION ALL SELECT 'flag', 'flag household.late', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, n FROM (SELECT count(*) FILTER (household_id % 100 = 99) AS n FROM household)
UNION ALL SELECT 'unique', 'unique household.household_id', 'PASS', 0 UNION ALL SELECT 'unique', 'unique unit.household_id', 'FAIL', count(*) - count(DISTINCT household_id) FROM unit
UNION ALL SELECT 'orphan', 'unit in household by household_id', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, n FROM (SELECT count(*) AS n FROM unit WHERE household_id % 10 = 0)
UNION ALL SELECT 'range', 'unit.agi per household', CASE WHEN sum(agi) / (SELECT count(*) FROM household WHERE household_id % 10 <> 0) BETWEEN 1 AND 10 THEN 'PASS' ELSE 'WARN' END, CASE WHEN sum(agi) / (SELECT count(*) FROM household WHERE household_id % 10 <> 0) BETWEEN 1 AND 10 THEN 0 ELSE 1 END FROM unit""")
def v1_structural(spark, d):
    """The suite on households (a tenth of which is left out of the table), filing units and persons."""
    m = Micro(spark, d)
    h = m.household.where("household_id % 10 <> 0").withColumn("late", (c("household_id") % 100 == 99).cast("int") * 2)
    whole = m.household.withColumn("late", (c("household_id") % 100 == 99).cast("int") * 2)
    a = V.structural({"household": whole, "unit": m.unit}, {"household": "household_id", "unit": "household_id"}, not_negative={"household": ["weight", "wealth", "rent"]}, finite={"household": ["wealth"]}, flags={"household": ["late"]})
    b = V.structural({"household": h, "unit": m.unit}, {}, parents=[("unit", "household_id", "household"), ("person", "household", "household")], ranges={("unit", "agi", "household"): (1.0, 10.0), ("household", "rent", "household"): (0.0, 1.0)})
    x = a.unionByName(b)
    part = X.first_matching([(c("status") == "SKIP", "skipped"), (c("check").startswith("unique"), "unique"), (c("check").endswith(".weight"), "weight"), (c("check").startswith("finite"), "finite"), (c("check").startswith("flag"), "flag"), (c("check").contains(" in "), "orphan"), (c("check").contains(" per "), "range")], "wealth")
    return x.select(part.alias("part"), "check", "status", "failing")


@book.add("""
WITH s AS (SELECT district, sum(agi * weight) AS sim FROM unit JOIN household USING (household_id) GROUP BY 1), t AS (SELECT district, sum(agi) * 4 AS target FROM unit JOIN household USING (household_id) WHERE district <> 3 GROUP BY 1 UNION ALL SELECT 99, 5.0)
SELECT district, CASE WHEN target IS NOT NULL THEN 'district' END AS level, round(sim, 2) AS sim, round(target, 2) AS target, round(sim - target, 2) AS error, round((sim - target) / abs(target), 6) AS relative_error,
CASE WHEN sim IS NULL OR target IS NULL THEN 'missing' WHEN abs(sim) > 5e9 THEN 'implausible' WHEN abs((sim - target) / target) <= 0.05 THEN 'ok' ELSE 'off' END AS status, district % 2 = 0 AS in_training FROM s FULL JOIN t USING (district)""")
def v2_area_validation(spark, d):
    m = Micro(spark, d)
    u = m.unit.join(m.household.select("household_id", "district", "weight"), "household_id")
    sim = u.groupBy("district").agg(F.sum(c("agi") * c("weight")).alias("sim"))
    t = u.where("district <> 3").groupBy("district").agg((F.sum("agi") * 4).alias("target")).unionByName(spark.createDataFrame([(99, 5.0)], "district int, target double")).withColumn("level", F.lit("district"))
    r = V.area_validation(sim, t, ["district"], {"district": 5e9}, c("district") % 2 == 0, tol=0.05)
    return r.select("district", "level", *[F.round(x, 2).alias(x) for x in ("sim", "target", "error")], F.round("relative_error", 6).alias("relative_error"), "status", "in_training")


@book.add("""
WITH s AS (SELECT state, district, sum(agi * weight) AS v FROM unit JOIN household USING (household_id) GROUP BY ALL), p AS (SELECT state, sum(v) AS by_parts, count(*) AS n_parts FROM s GROUP BY 1), w AS (SELECT state, sum(agi * weight) * CASE state WHEN 2 THEN 1.01::DOUBLE ELSE 1 END AS whole FROM unit JOIN household USING (household_id) WHERE state <> 4 GROUP BY 1)
SELECT state, round(by_parts, 2) AS by_parts, n_parts, round(whole, 2) AS whole, round(by_parts - coalesce(whole, 0), 2) + 0.0 AS gap, state NOT IN (2, 4) AS adds_up FROM p LEFT JOIN w USING (state)""")
def v3_additive_states(spark, d):
    """States from their districts, against state totals of which one is off and one is not there."""
    m = Micro(spark, d)
    u = m.unit.join(m.household.select("household_id", "state", "district", "weight"), "household_id").withColumn("v", c("agi") * c("weight"))
    parts = u.groupBy("state", "district").agg(F.sum("v").alias("v"))
    wholes = u.where("state <> 4").groupBy("state").agg((F.sum("v") * F.when(c("state") == 2, 1.01).otherwise(1.0)).alias("v"))
    return V.additive(parts, wholes, "state", "v").select("state", F.round("by_parts", 2).alias("by_parts"), "n_parts", F.round("whole", 2).alias("whole"), (F.round("gap", 2) + 0.0).alias("gap"), "adds_up")


@book.add("""
WITH t AS (SELECT DISTINCT target_id, variable, period, geo_level, value FROM target_overview WHERE value IS NOT NULL AND NOT isnan(value)), p AS (SELECT variable, period, sum(value) FILTER (geo_level = 'national') AS n, sum(value) FILTER (geo_level = 'state') AS s, sum(value) FILTER (geo_level = 'district') AS d FROM t GROUP BY ALL)
SELECT variable, period, round((s - n) / n * 100, 4) AS state_gap, round((d - n) / n * 100, 4) AS district_gap, CASE WHEN abs((s - n) / n * 100) < 1 OR (s - n) / n IS NULL THEN 'ok' WHEN abs((s - n) / n * 100) < 5 THEN 'flag' WHEN abs((s - n) / n * 100) < 15 THEN 'significant' ELSE 'critical' END AS severity
FROM p WHERE (n IS NOT NULL)::INT + (s IS NOT NULL)::INT + (d IS NOT NULL)::INT >= 2""")
def v4_cross_level(spark, d):
    t = Micro(spark, d).raw("target_overview").where("value IS NOT NULL AND NOT isnan(value)").select("target_id", "variable", "period", "geo_level", "value").distinct()
    p = t.groupBy("variable", "period").pivot("geo_level", ["national", "state", "district"]).agg(F.sum("value"))
    p = p.where((c("national").isNotNull().cast("int") + c("state").isNotNull().cast("int") + c("district").isNotNull().cast("int")) >= 2)
    gap = lambda x: F.try_divide(c(x) - c("national"), c("national")) * 100
    return p.select("variable", "period", F.round(gap("state"), 4).alias("state_gap"), F.round(gap("district"), 4).alias("district_gap"), X.severity(gap("state")).alias("severity"))


@book.add("""
WITH b AS (SELECT r_regionkey AS g, i, CASE i WHEN 0 THEN '-Infinity'::DOUBLE ELSE i * 100 END AS lo, CASE WHEN i = 3 THEN 'Infinity'::DOUBLE ELSE (i + 1) * 100 + CASE WHEN r_regionkey = 2 AND i = 1 THEN 5 ELSE 0 END END AS hi FROM region, range(4) r(i)),
k AS (SELECT g, hi, lead(lo) OVER (PARTITION BY g ORDER BY lo) AS nx, lo, row_number() OVER (PARTITION BY g ORDER BY lo) AS r FROM b)
SELECT g, count(*) AS n_buckets, NOT bool_or(coalesce(nx <> hi, hi <> 'Infinity'::DOUBLE) OR (r = 1 AND lo <> '-Infinity'::DOUBLE)) AS covers FROM k GROUP BY 1""")
def v5_bucket_cover(spark, d):
    inf = float("inf")
    r = Micro(spark, d).raw("region").select(c("r_regionkey").alias("g"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("i"))
    b = r.select("g", F.when(c("i") == 0, -inf).otherwise(c("i") * 100.0).alias("lo"), F.when(c("i") == 3, inf).otherwise((c("i") + 1) * 100.0 + F.when((c("g") == 2) & (c("i") == 1), 5.0).otherwise(0.0)).alias("hi"))
    return V.buckets_cover(b, ["g"], "lo", "hi")


@book.add("""SELECT definition_hash, count(*) AS n FROM (SELECT DISTINCT stratum_id, definition_hash FROM strata) GROUP BY 1 HAVING count(*) > 1""")
def v7_hash_uniqueness(spark, d):
    return V.duplicate_keys(Micro(spark, d).raw("strata").select("stratum_id", "definition_hash").distinct(), ["definition_hash"])


@book.add("""
WITH x AS (SELECT stratum_id, bool_and(variable IN ('state_fips', 'congressional_district_geoid')) AS pure, max(value) FILTER (variable = 'state_fips') AS s, max(value) FILTER (variable = 'congressional_district_geoid') AS d FROM constr GROUP BY 1),
g AS (SELECT l.stratum_id, parent_stratum_id, CASE WHEN d IS NOT NULL THEN 'district' WHEN s IS NOT NULL THEN 'state' ELSE 'national' END AS lv, coalesce(d, s, 'US') AS id FROM living l LEFT JOIN x USING (stratum_id) WHERE coalesce(pure, true)),
j AS (SELECT g.*, u.lv AS ulv, u.id AS uid FROM g LEFT JOIN g u ON u.stratum_id = g.parent_stratum_id)
SELECT lv AS geo_level, count(DISTINCT id) AS n, CASE lv WHEN 'national' THEN 1 WHEN 'state' THEN 51 ELSE 436 END AS expected, count(DISTINCT id) = CASE lv WHEN 'national' THEN 1 WHEN 'state' THEN 51 ELSE 436 END AS as_expected,
CAST(count(*) FILTER (CASE lv WHEN 'national' THEN parent_stratum_id IS NULL WHEN 'state' THEN ulv = 'national' ELSE ulv = 'state' AND TRY_CAST(id AS INT) // 100 = TRY_CAST(uid AS INT) END) AS BIGINT) AS under_parent FROM j GROUP BY 1""")
def v6_hierarchy(spark, d):
    """Geographic strata by level against the nation, 51 states and 436 districts, and how many hang under the right parent."""
    m = Micro(spark, d)
    s = T.geographic_strata(m.strata, m.constraints).join(m.strata.select("stratum_id", "parent_stratum_id"), "stratum_id")
    k = m.constraints.where("variable = 'congressional_district_geoid'").select("stratum_id", F.lit(True).alias("is_d")).distinct()
    level = F.when(c("is_d"), "district").when(c("geographic_id") != "US", "state").otherwise("national")
    return V.hierarchy(s.join(k, "stratum_id", "left").withColumn("geo_level", level), {"national": 1, "state": 51, "district": 436})


@book.add("""
WITH k AS (SELECT *, coalesce(CAST(TRY_CAST(value AS DOUBLE) AS VARCHAR), value) AS n FROM constr), d AS (SELECT stratum_id, max(TRY_CAST(value AS INT)) AS d FROM constr WHERE variable = 'congressional_district_geoid' AND operation = '==' GROUP BY 1),
j AS (SELECT l.stratum_id, p.variable, p.operation, p.value AS parent_value, EXISTS (SELECT 1 FROM k WHERE k.stratum_id = l.stratum_id AND k.variable = p.variable AND k.operation = p.operation AND k.n = p.n) AS has, p.variable = 'state_fips' AND p.operation = '==' AND d IS NOT NULL AS st, coalesce(d // 100 = TRY_CAST(p.value AS INT), false) AS inside
  FROM living l JOIN k p ON p.stratum_id = l.parent_stratum_id LEFT JOIN d ON d.stratum_id = l.stratum_id)
SELECT stratum_id, variable, operation, parent_value, CASE WHEN st AND NOT inside THEN 'district outside state' ELSE 'missing' END AS problem FROM j WHERE (st AND NOT inside) OR (NOT has AND NOT (st AND inside))""")
def v8_containment(spark, d):
    m = Micro(spark, d)
    return V.containment(m.strata, m.constraints)


@book.add("SELECT operation, count(*) AS n FROM stratum_constraints WHERE operation NOT IN ('==', '!=', '>', '>=', '<', '<=') GROUP BY 1")
def v9_allowed_values(spark, d):
    allowed = spark.createDataFrame([(o,) for o in ("==", "!=", ">", ">=", "<", "<=")], "operation string")
    return Micro(spark, d).raw("stratum_constraints").join(F.broadcast(allowed), "operation", "left_anti").groupBy("operation").agg(N().alias("n"))


@book.add("""
WITH e AS (SELECT segment, abs(sum(wealth * weight) - 1e6) / 1e6 * 100 AS err, min(weight) AS lo FROM household GROUP BY 1) SELECT segment, round(err, 6) AS err, CASE WHEN lo < 0 THEN 'invalid' WHEN err < 0.1 THEN 'exact' WHEN err < 200 THEN 'approximate' ELSE 'aggregate' END AS quality FROM e""")
def v10_quality_class(spark, d):
    e = Micro(spark, d).household.groupBy("segment").agg((F.abs(F.sum(c("wealth") * c("weight")) - 1e6) / 1e6 * 100).alias("err"), F.min("weight").alias("lo"))
    return e.select("segment", F.round("err", 6).alias("err"), X.first_matching([(c("lo") < 0, "invalid"), (c("err") < 0.1, "exact"), (c("err") < 200, "approximate")], "aggregate").alias("quality"))


@book.add("""
SELECT 'strata' AS entity, unnest(['stratum_id', 'parent_stratum_id', 'deleted_at']) AS column_name, unnest([count(stratum_id), count(parent_stratum_id), count(deleted_at)]) AS n_values, count(*) AS n_rows, count(DISTINCT stratum_id) AS n_keys, unnest([count(stratum_id), count(parent_stratum_id), count(deleted_at)]) = count(*) AND count(*) = count(DISTINCT stratum_id) AS complete FROM strata
UNION ALL SELECT 'unit', unnest(['unit_id', 'agi']), unnest([count(unit_id), count(agi)]), count(*), count(DISTINCT unit_id), true FROM unit""")
def v11_contract(spark, d):
    m = Micro(spark, d)
    return V.contract({"strata": (m.raw("strata").select("stratum_id", "parent_stratum_id", "deleted_at"), "stratum_id"), "unit": (m.unit.select("unit_id", "agi"), "unit_id")})


@book.add("""
WITH s AS (SELECT min(wealth) AS a, max(wealth) AS b, min(weight) AS e, max(weight) AS f FROM household), g AS (SELECT least(CAST(floor((wealth - a) / (b - a) * 20) AS INT), 19) AS i, least(CAST(floor((weight - e) / (f - e) * 20) AS INT), 19) AS j, count(*)::DOUBLE AS n FROM household, s GROUP BY ALL),
p AS (SELECT sum(x.n * y.n * sign(y.j - x.j)) AS cd FROM g x JOIN g y ON y.i > x.i), t AS (SELECT sum(n) AS n FROM g), r AS (SELECT sum(n * (n - 1) / 2) AS v FROM (SELECT sum(n) AS n FROM g GROUP BY i)), q AS (SELECT sum(n * (n - 1) / 2) AS v FROM (SELECT sum(n) AS n FROM g GROUP BY j))
SELECT round(cd / sqrt((n * (n - 1) / 2 - r.v) * (n * (n - 1) / 2 - q.v)), 8) AS tau FROM p, t, r, q""")
def v12_kendall(spark, d):
    from weftline.operators.diagnostics import kendall

    return kendall(Micro(spark, d).household, "wealth", "weight", 20).select(F.round("tau", 8).alias("tau"))


_TWO = "WITH ab AS (SELECT household_id % 2 AS side, wealth AS x, weight FROM household), s AS (SELECT min(x) AS lo, max(x) AS hi FROM ab)"


@book.add(_TWO + """, b AS (SELECT side, least(CAST(floor((x - lo) / (hi - lo) * 50) AS INT), 49) AS bin FROM ab, s), h AS (SELECT bin, count(*) FILTER (side = 0) / sum(count(*) FILTER (side = 0)) OVER () AS p, count(*) FILTER (side = 1) / sum(count(*) FILTER (side = 1)) OVER () AS q FROM b GROUP BY 1),
k AS (SELECT x, sum(count(*) FILTER (side = 0)) OVER (ORDER BY x) / sum(count(*) FILTER (side = 0)) OVER () AS f, sum(count(*) FILTER (side = 1)) OVER (ORDER BY x) / sum(count(*) FILTER (side = 1)) OVER () AS g FROM ab GROUP BY 1)
SELECT round((SELECT sum(least(p, q)) FROM h), 8) AS overlap, round((SELECT max(abs(f - g)) FROM k), 8) AS ks, round((SELECT abs(avg(x) FILTER (side = 0) - avg(x) FILTER (side = 1)) / sqrt((var_samp(x) FILTER (side = 0) + var_samp(x) FILTER (side = 1)) / 2) FROM ab), 8) AS smd,
round((SELECT corr(x, weight) FILTER (side = 0) - corr(x, weight) FILTER (side = 1) FROM ab), 6) AS corr_diff""")
def v12_distribution_distance(spark, d):
    """Histogram overlap, Kolmogorov-Smirnov distance, standardised mean and correlation difference of two halves."""
    from weftline.operators.diagnostics import compare_distributions

    h = Micro(spark, d).household.select((c("household_id") % 2).alias("side"), c("wealth").alias("x"), "weight")
    r = compare_distributions(h, "side", "x", "weight")
    return r.select(F.round("overlap", 8).alias("overlap"), F.round("ks", 8).alias("ks"), F.round("smd", 8).alias("smd"), F.round("corr_diff", 6).alias("corr_diff"))


@book.add("""
WITH p AS (SELECT segment, wealth AS y, avg(wealth) OVER (PARTITION BY segment) AS m, quantile_cont(wealth, 0.1) OVER (PARTITION BY segment) AS lo, quantile_cont(wealth, 0.9) OVER (PARTITION BY segment) AS hi FROM household)
SELECT segment, round(avg(abs(y - m)), 6) AS mae, round(sqrt(avg((y - m) * (y - m))), 6) AS rmse, round(avg((y BETWEEN lo AND hi)::INT), 6) AS coverage FROM p GROUP BY 1""")
def v13_accuracy(spark, d):
    h = Micro(spark, d).household
    s = h.groupBy("segment").agg(F.avg("wealth").alias("m"), F.percentile("wealth", 0.1).alias("lo"), F.percentile("wealth", 0.9).alias("hi"))
    e = h.join(s, "segment")
    return e.groupBy("segment").agg(F.round(F.avg(F.abs(c("wealth") - c("m"))), 6).alias("mae"), F.round(F.sqrt(F.avg((c("wealth") - c("m")) * (c("wealth") - c("m")))), 6).alias("rmse"), F.round(F.avg(c("wealth").between(c("lo"), c("hi")).cast("double")), 6).alias("coverage"))


@book.add(_MX + """, e AS (SELECT value_key, geo_level, target_idx, sum(val) AS a, sum(val * (1 + col_id % 3)) AS b FROM x GROUP BY ALL), r AS (SELECT value_key || ' ' || geo_level AS category, abs(a - t) / t AS ea, abs(b - t) / t AS eb FROM (SELECT *, a * 1.5 AS t FROM e))
SELECT category, count(*) AS n, round(avg((ea < eb)::INT), 8) AS share_a_better, round(avg(eb - ea), 8) AS mean_gain FROM r GROUP BY 1""")
def v14_achievement(spark, d):
    """Two sets of weights, by their estimates of the matrix's targets (1.5 times the row sums)."""
    cols, t, x = _package(spark, d)
    w = cols.select("col_id", (1 + c("col_id") % 3).cast("double").alias("w"))
    e = MX.multiply(x, w).join(t, "target_idx").select(F.concat_ws(" ", "value_key", "geo_level").alias("category"), (c("row_sum") * 1.5).alias("target"), c("row_sum").alias("a"), c("estimate").alias("b"))
    return V.achievement(e).select("category", "n", F.round("share_a_better", 8).alias("share_a_better"), F.round("mean_gain", 8).alias("mean_gain"))


@book.add("""
WITH u AS (SELECT CASE WHEN agi < 100000 THEN 'low' ELSE 'high' END AS band, agi * weight AS a, agi * CASE WHEN status = 'F' THEN 0.875 ELSE 1 END * weight AS r FROM unit JOIN household USING (household_id))
SELECT band, round(sum(a), 2) AS baseline, round(sum(r), 2) AS reform, round(sum(a) - sum(r), 2) AS delta, round(sum(a) / sum(sum(a)) OVER (), 8) AS share FROM u GROUP BY 1""")
def v15_reform_tables(spark, d):
    m = Micro(spark, d)
    u = m.unit.join(m.household.select("household_id", "weight"), "household_id")
    r = c("agi") * F.when(c("status") == "F", 0.875).otherwise(1.0) * c("weight")
    g = u.groupBy(F.when(c("agi") < 100000, "low").otherwise("high").alias("band")).agg(F.sum(c("agi") * c("weight")).alias("a"), F.sum(r).alias("r"))
    return g.join(F.broadcast(g.agg(F.sum("a").alias("t"))), F.lit(True)).select("band", F.round("a", 2).alias("baseline"), F.round("r", 2).alias("reform"), F.round(c("a") - c("r"), 2).alias("delta"), F.round(c("a") / c("t"), 8).alias("share"))


@book.add("""
WITH p AS (SELECT unit_id, line, min(part) % 3 AS a, min(supp) % 3 AS b FROM person GROUP BY ALL), g AS (SELECT unit_id, a, b, count(*) AS n FROM p GROUP BY ALL), s AS (SELECT sum(n * (n - 1) / 2) AS ab FROM g), x AS (SELECT sum(n * (n - 1) / 2) AS a FROM (SELECT unit_id, a, sum(n) AS n FROM g GROUP BY ALL)), y AS (SELECT sum(n * (n - 1) / 2) AS b FROM (SELECT unit_id, b, sum(n) AS n FROM g GROUP BY ALL))
SELECT CAST(ab AS BIGINT) AS pairs_in_both, CAST(a AS BIGINT) AS pairs_in_a, CAST(b AS BIGINT) AS pairs_in_b FROM s, x, y""")
def v16_grouping_agreement(spark, d):
    """Agreement of two groupings of persons: pairs together in both, from counts, without forming pairs."""
    from weftline.operators.diagnostics import pair_agreement

    p = Micro(spark, d).person.groupBy("unit_id", "line").agg((F.min("part") % 3).alias("a"), (F.min("supp") % 3).alias("b"))
    return pair_agreement(p, ["unit_id"], "a", "b")


@book.add("""SELECT household_id % 2 AS half, count(*) AS n, round(avg(wealth), 6) AS mean, count(*) FILTER (wealth < 0) AS below_zero, count(*) FILTER (wealth > 9000) AS above_cap FROM household GROUP BY 1""")
def v17_halves(spark, d):
    return Micro(spark, d).household.groupBy((c("household_id") % 2).alias("half")).agg(N().alias("n"), F.round(F.avg("wealth"), 6).alias("mean"), F.count(F.when(c("wealth") < 0, 1)).alias("below_zero"), F.count(F.when(c("wealth") > 9000, 1)).alias("above_cap"))


@book.add("""
WITH a AS (SELECT period, status, count(*) AS n FROM unit WHERE unit_id % 2 = 0 GROUP BY ALL), b AS (SELECT period, status, count(*) AS n FROM unit WHERE unit_id % 2 = 1 AND status <> 'P' GROUP BY ALL)
SELECT period, status, coalesce(a.n, 0) AS run_a, coalesce(b.n, 0) AS run_b, coalesce(a.n, 0) - coalesce(b.n, 0) AS change FROM a FULL JOIN b USING (period, status)""")
def v18_compare_runs(spark, d):
    g = lambda df, n: df.groupBy("period", "status").agg(N().alias(n))
    u = Micro(spark, d).unit
    j = g(u.where("unit_id % 2 = 0"), "run_a").join(g(u.where("unit_id % 2 = 1 AND status <> 'P'"), "run_b"), ["period", "status"], "full_outer").fillna(0)
    return j.withColumn("change", c("run_a") - c("run_b"))


# ---- sources and sinks ----


@book.add("SELECT p_partkey AS \"P_PARTKEY\", p_size AS \"P_SIZE\", 0.0::DOUBLE AS \"BONUS\" FROM part")
def src1_src3_delimited(spark, d):
    """Written as two delimited parts with different column orders, read back with an optional column that is absent."""
    f = scratch(spark, "delimited")
    p = Micro(spark, d).raw("part")
    p.where("p_partkey % 2 = 0").select("p_partkey", "p_name", "p_size").write.option("header", True).csv(f"{f}/a")
    p.where("p_partkey % 2 = 1").select("p_size", "p_partkey").write.option("header", True).csv(f"{f}/b")
    return FS.read_delimited(spark, [f"{f}/a", f"{f}/b"], {"p_partkey": "long", "p_size": "int"}, {"bonus": 0.0}, fill=0)


@book.add("SELECT 'unit' AS kind, unit_id AS id FROM unit SEMI JOIN person USING (unit_id) UNION ALL SELECT DISTINCT 'person', unit_id FROM person SEMI JOIN unit USING (unit_id)")
def src2_src4_mutual(spark, d):
    m = Micro(spark, d)
    u, p = FS.mutual(m.unit.select("unit_id"), m.person.select("unit_id"), "unit_id")
    return u.select(F.lit("unit").alias("kind"), c("unit_id").alias("id")).unionByName(p.distinct().select(F.lit("person").alias("kind"), c("unit_id").alias("id")))


@book.add("SELECT household_id, unit_id, status FROM (SELECT household_id, unit_id, status, row_number() OVER (PARTITION BY household_id ORDER BY unit_id) AS k FROM unit) WHERE k = 1")
def src5_first_row(spark, d):
    return etl.first_row(Micro(spark, d).unit.select("household_id", "unit_id", "status"), ["household_id"], ["unit_id"])


@book.add("SELECT s_suppkey AS \"S_SUPPKEY\", s_name AS \"S_NAME\" FROM supplier")
def src6_piped(spark, d):
    f = scratch(spark, "piped")
    Micro(spark, d).raw("supplier").select("s_suppkey", "s_name", "s_acctbal").write.option("header", True).option("sep", "|").csv(f)
    return FS.read_delimited(spark, f, {"s_suppkey": "long", "s_name": "string"}, sep="|")


@book.add("SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region FROM nation")
def src7_fixed_width(spark, d):
    f = scratch(spark, "fixed")
    Micro(spark, d).raw("nation").select(F.concat(F.lpad(c("n_nationkey").cast("string"), 4, " "), F.rpad("n_name", 30, " "), F.lpad(c("n_regionkey").cast("string"), 3, " "))).write.text(f)
    return FS.read_fixed_width(spark, f, {"id": (1, 4, "int"), "name": (5, 30, "string"), "region": (35, 3, "int")})


@book.add("SELECT n_nationkey AS id, n_regionkey AS region, n_nationkey * 0.5::DOUBLE AS half FROM nation")
def src8_stata(spark, d):
    """A table of fixed size as a zipped Stata file, read back."""
    import os
    import zipfile

    from weftline.sources import legacy

    f = driver_folder(spark, "stata")
    n = Micro(spark, d).raw("nation").select(c("n_nationkey").cast("int").alias("id"), c("n_regionkey").cast("int").alias("region"), (c("n_nationkey") * 0.5).alias("half")).toPandas()
    n.to_stata(os.path.join(f, "n.dta"), write_index=False)
    with zipfile.ZipFile(os.path.join(f, "n.zip"), "w") as z:
        z.write(os.path.join(f, "n.dta"), "n.dta")
    return legacy.read_stata(spark, os.path.join(f, "n.zip"), ["id", "region", "half"])


@book.add("SELECT n_regionkey AS region, count(*) AS n, min(n_name) AS first FROM nation GROUP BY 1")
def src12_sqlite(spark, d):
    """A table of fixed size in a SQLite file, and a query on it."""
    import os
    import sqlite3

    path = os.path.join(driver_folder(spark, "sqlite"), "t.db")
    rows = [tuple(r) for r in Micro(spark, d).raw("nation").select("n_nationkey", "n_regionkey", "n_name").collect()]
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE nation (id INT, region INT, name TEXT)")
        con.executemany("INSERT INTO nation VALUES (?, ?, ?)", rows)
    return FS.read_sqlite(spark, path, "SELECT region, count(*), min(name) FROM nation GROUP BY 1", "region int, n long, first string")


@book.add("SELECT * FROM (VALUES (2019, 'soi_2020.csv'), (2021, 'soi_2020.csv'), (2023, 'soi_2023.csv'), (2030, 'soi_2024.csv')) v(year, file)")
def src15_year_files(spark, d):
    names = ["soi_2023.csv", "notes.txt", "soi_2020.csv", "soi_2024.csv"]
    return spark.createDataFrame([(y, FS.pick_year(names, y)) for y in (2019, 2021, 2023, 2030)], "year int, file string")


@book.add("SELECT * FROM (VALUES ('beta', 'soft'), ('n_targets', 'fatal'), ('targets', 'fatal')) v(key, mismatch)")
def sv9_signatures(spark, d):
    """Mismatches of a checkpoint's signature: those that forbid going on, and those that do not."""
    from weftline.operators.solve import compare_signatures

    old, new = {"n_targets": 3, "targets": "a1", "beta": 0.5, "rate": 0.1}, {"n_targets": 4, "beta": 0.6, "rate": 0.1}
    differ = compare_signatures(old, new, ("n_targets", "targets"))
    return spark.createDataFrame([(k, kind) for kind, ks in differ.items() for k in ks], "key string, mismatch string")


@book.add("SELECT n_name AS item, r_name AS section FROM nation JOIN region ON r_regionkey = n_regionkey")
def src9_sections(spark, d):
    """A sheet: each region's name as a section header above its nations."""
    m = Micro(spark, d)
    head = m.raw("region").select((c("r_regionkey") * 1000).alias("row"), c("r_name").alias("item"), F.lit(True).alias("head"))
    body = m.raw("nation").select((c("n_regionkey") * 1000 + 1 + c("n_nationkey")).alias("row"), c("n_name").alias("item"), F.lit(False).alias("head"))
    return FS.forward_sections(head.unionByName(body), "row", c("head"), c("item"), "section").select("item", "section")


@book.add("SELECT n_nationkey AS district, coalesce(CASE n_regionkey WHEN 0 THEN 0.4::DOUBLE WHEN 1 THEN 0.55 END, 0.8) AS rate FROM nation")
def src14_parameters(spark, d):
    t = FS.parameters(spark, {"0": {2020: 0.3, 2023: 0.4}, "1": {2022: 0.55, 2026: 0.9}, "2": {2026: 0.1}}, 2024, "state")
    n = Micro(spark, d).district.withColumn("state", c("state").cast("string"))
    return n.join(F.broadcast(t), "state", "left").select("district", F.coalesce("value", F.lit(0.8)).alias("rate"))


@book.add("SELECT state, household_id, weight FROM household")
def snk1_area_tables(spark, d):
    """Household tables written by area and read back."""
    f = scratch(spark, "areas")
    FS.write_area({"household": Micro(spark, d).household.select("state", "household_id", "weight")}, f, "state")
    return spark.read.parquet(f"{f}/household").select(c("state").cast("int").alias("state"), "household_id", "weight")


@book.add("SELECT household_id AS col_id, segment AS target, weight AS val, CAST(state % 2 AS INT) AS chunk FROM household")
def snk2_shards(spark, d):
    f = scratch(spark, "shards")
    h = Micro(spark, d).household
    for chunk in (0, 1, 1):  # the second chunk is written twice: it is replaced, not doubled
        FS.append_shard(h.where(c("state") % 2 == chunk).select(c("household_id").alias("col_id"), c("segment").alias("target"), c("weight").alias("val")), f, chunk)
    return spark.read.parquet(f)


@book.add("SELECT n_nationkey AS \"N_NATIONKEY\", n_name AS \"N_NAME\" FROM nation")
def snk3_sorted_csv(spark, d):
    f = scratch(spark, "csv")
    FS.write_sorted_csv(Micro(spark, d).raw("nation").select("n_nationkey", "n_name"), f, ["n_nationkey"])
    return FS.read_delimited(spark, f, {"n_nationkey": "int", "n_name": "string"})


@book.add("SELECT household_id, weight, 'v1' AS version FROM household")
def snk4_package(spark, d):
    f = scratch(spark, "package")
    FS.write_package({"columns": Micro(spark, d).household.select("household_id", "weight")}, {"version": "v1", "targets": 3}, f)
    t, meta = FS.read_package(spark, ["columns"], f)
    return t["columns"].withColumn("version", F.lit(meta["version"]))


@book.add("""
WITH new AS (SELECT stratum_id, variable, period, 0 AS reform_id, 1.0::DOUBLE AS value FROM target WHERE variable = 'snap' AND reform_id = 0 UNION SELECT 999999, 'snap', 2024, 0, 2.0), old AS (SELECT stratum_id, variable, period, reform_id, value FROM target)
SELECT * FROM old ANTI JOIN new USING (stratum_id, variable, period, reform_id) UNION ALL SELECT stratum_id, variable, period, reform_id, value FROM new""")
def snk5_upsert(spark, d):
    t = Micro(spark, d).targets.select("stratum_id", "variable", "period", "reform_id", "value")
    new = t.where("variable = 'snap' AND reform_id = 0").withColumn("value", F.lit(1.0)).distinct().unionByName(spark.createDataFrame([(999999, "snap", 2024, 0, 2.0)], t.schema))
    return T.upsert(t, new, ["stratum_id", "variable", "period", "reform_id"])


@book.add("SELECT definition_hash FROM living UNION ALL SELECT 'new one'")
def snk6_get_or_create(spark, d):
    s = Micro(spark, d).strata.select("definition_hash")
    new = s.unionByName(spark.createDataFrame([("new one",), ("new one",)], "definition_hash string"))
    return T.get_or_create(s, new, "definition_hash")


@book.add("SELECT release, CAST(n AS BIGINT) AS n FROM (VALUES ('first', 1), ('second', 2)) v(release, k), (SELECT count(*) AS n FROM nation)")
def snk7_releases(spark, d):
    """Two releases staged, checked and promoted, the second rolled back and the registry read."""
    f = scratch(spark, "releases")
    n = Micro(spark, d).raw("nation")
    for v in ("first", "second"):
        FS.stage(spark, {"nation": n}, f, v)
        FS.promote(spark, f, v)
    if FS.rollback(spark, f) != "first" or FS.releases(spark, f) != ["first"]:
        raise RuntimeError("the first release should be current again")
    return spark.read.parquet(f"{f}/releases/first/nation", f"{f}/releases/second/nation").groupBy(F.regexp_extract(F.input_file_name(), "releases/([a-z]+)/", 1).alias("release")).agg(N().alias("n"))


@book.add("SELECT * FROM (VALUES ('before', 0), ('after', 1)) v(moment, problems)")
def snk8_manifest(spark, d):
    """Hashes of a folder's files, compared before and after a file is added."""
    f = scratch(spark, "manifest")
    n = Micro(spark, d).raw("nation")
    n.coalesce(1).write.parquet(f"{f}/a")
    old = spark.createDataFrame(FS.file_hashes(spark, f).collect(), "file string, length long, sha256 string")  # a few files
    before = FS.verify_hashes(FS.file_hashes(spark, f), old).count()
    n.coalesce(1).write.parquet(f"{f}/b")
    after = FS.verify_hashes(FS.file_hashes(spark, f), old).where("file LIKE '%.parquet'").count()
    return spark.createDataFrame([("before", before), ("after", after)], "moment string, problems long")


# ---- streaming extension ----

_WIN = "SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS \"end\", event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL"


@book.add(_WIN)
def st1_tumbling(spark, d):
    e = Micro(spark, d).raw("events").withColumn("ts", c("ts").cast("timestamp"))
    return EV.window_totals(e, "1 day").select(c("start").cast("timestamp_ntz").alias("start"), c("end").cast("timestamp_ntz").alias("end"), "event_type", "n", F.round("total", 2).alias("total"))


@book.add("""
WITH g AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS n, round(sum(value), 2) AS total FROM s GROUP BY user_id, k""")
def st2_sessions(spark, d):
    e = Micro(spark, d).raw("events").withColumn("ts", c("ts").cast("timestamp"))
    return EV.session_totals(e, "6 hours").select("user_id", c("start").cast("timestamp_ntz").alias("start"), c("end").cast("timestamp_ntz").alias("end"), "n", F.round("total", 2).alias("total"))


@book.add("SELECT user_id, event_id, value FROM events WHERE value > 50")
def st3_stream_run(spark, d):
    """The events file as a stream until it is used up, filtered and appended."""
    e = Micro(spark, d).raw("events")
    f = scratch(spark, "stream")
    e.write.parquet(f"{f}/in")
    return EV.run_available(spark, f"{f}/in", e.schema, lambda s: s.where("value > 50").select("user_id", "event_id", "value"), f"{f}/out", f"{f}/state")
