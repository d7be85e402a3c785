"""Windows, ranks, sorts and set operations (W, T, U of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import exprs as X
from weftline.operators import clone as C
from weftline.operators import targets as T
from weftline.operators import weights as W
from weftline.plans.micro import Book, Micro

book = Book()
queries, oracle_sql = (lambda: book.queries), (lambda: book.sql)
c = F.col
N = lambda: F.count(F.lit(1))


@book.add("SELECT unit_id, row_number() OVER (ORDER BY unit_id) - 1 AS dense FROM unit")
def w1_dense_ids(spark: SparkSession, d: str) -> DataFrame:
    return C.dense_ids(Micro(spark, d).unit.select("unit_id"), [], "unit_id", "dense")


@book.add("SELECT household_id, unit_id, k FROM (SELECT household_id, unit_id, row_number() OVER (PARTITION BY household_id ORDER BY agi DESC, unit_id) AS k FROM unit) WHERE k <= 2")
def w2_top_two(spark, d):
    w = Window.partitionBy("household_id").orderBy(F.desc("agi"), "unit_id")
    return Micro(spark, d).unit.withColumn("k", F.row_number().over(w)).where("k <= 2").select("household_id", "unit_id", "k")


@book.add("SELECT user_id, event_id, last_value(CASE WHEN value > 50 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events")
def w3_forward_fill(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return Micro(spark, d).raw("events").select("user_id", "event_id", F.last(F.when(c("value") > 50, c("value")), ignorenulls=True).over(w).alias("filled"))


_DRAW = "((household_id * (1103515245 + 3) + 12345 + 3) % 2147483648) / 2147483648.0"


@book.add(f"WITH x AS (SELECT household_id, weight, sum(weight) OVER (ORDER BY {_DRAW}, household_id) AS cum FROM household) SELECT household_id FROM x WHERE cum - weight < 2000")
def w4_w5_fill_to_weight(spark, d):
    h = Micro(spark, d).household.withColumn("draw", X.lcg_uniform(c("household_id"), 3))
    return W.fill_to_total(h, "draw", "weight", "household_id", F.lit(2000.0)).select("household_id")


@book.add("""
WITH x AS (SELECT segment, wealth, sum(weight) OVER (PARTITION BY segment ORDER BY wealth) AS cum, sum(weight) OVER (PARTITION BY segment) AS tot FROM household)
SELECT segment, q, min(wealth) AS quantile FROM x, (SELECT unnest([0.1, 0.5, 0.9])::DOUBLE AS q) WHERE cum >= q * tot GROUP BY ALL""")
def w6_weighted_quantile(spark, d):
    return W.weighted_quantiles(Micro(spark, d).household, "wealth", "weight", [0.1, 0.5, 0.9], ["segment"])


@book.add("""
WITH v AS (SELECT greatest(wealth, 0) AS x, sum(weight) AS w FROM household GROUP BY 1), k AS (SELECT x, w, sum(w * x) OVER (ORDER BY x) AS cx, sum(w) OVER () AS tw, sum(w * x) OVER () AS tx FROM v)
SELECT round(1 - 2 * sum(w * (2 * cx - w * x) / 2) / (max(tw) * max(tx)), 8) AS gini FROM k""")
def w7_gini(spark, d):
    return W.gini(Micro(spark, d).household, "wealth", "weight").select(F.round("gini", 8).alias("gini"))


@book.add("""
WITH v AS (SELECT wealth, sum(weight) AS w FROM household GROUP BY 1), k AS (SELECT wealth, sum(w) OVER (ORDER BY wealth) AS cw, sum(w) OVER () AS tw FROM v), q AS (SELECT min(wealth) AS t FROM k WHERE cw >= 0.9::DOUBLE * tw)
SELECT round(sum(CASE WHEN wealth >= t THEN wealth * weight ELSE 0 END) / sum(wealth * weight), 8) AS share FROM household, q""")
def w8_top_share(spark, d):
    return W.top_share(Micro(spark, d).household, "wealth", "weight", 0.1).select(F.round("share", 8).alias("share"))


@book.add("SELECT segment, round(quantile_cont(wealth, 0.25), 6) AS p25, round(quantile_cont(wealth, 0.9), 6) AS p90 FROM household GROUP BY 1")
def w9_percentiles(spark, d):
    return Micro(spark, d).household.groupBy("segment").agg(F.round(F.percentile("wealth", 0.25), 6).alias("p25"), F.round(F.percentile("wealth", 0.9), 6).alias("p90"))


@book.add("SELECT household_id, round(cume_dist() OVER (PARTITION BY segment ORDER BY wealth), 10) AS score FROM household")
def w10_ecdf_score(spark, d):
    """Share of values at or below, from per-value counts, so that equal values and large groups cost one row each."""
    h = Micro(spark, d).household
    per = h.groupBy("segment", "wealth").agg(N().alias("n"))
    s = W.cumulative(per, "wealth", [c("n")], [], ["segment"]).select("segment", "wealth", F.round(c("cum0") / c("tot0"), 10).alias("score"))
    return h.join(s, ["segment", "wealth"]).select("household_id", "score")


@book.add("SELECT round(sum(weight) * sum(weight) / sum(weight * weight), 6) AS ess, round((SELECT sum(weight) FROM (SELECT weight FROM household ORDER BY weight DESC LIMIT 10)) / sum(weight), 10) AS top_10_share, round((SELECT sum(weight) FROM (SELECT weight FROM household ORDER BY weight DESC LIMIT 100)) / sum(weight), 10) AS top_100_share FROM household")
def w11_concentration(spark, d):
    r = W.concentration(Micro(spark, d).household, "weight", [10, 100])
    return r.select(F.round("ess", 6).alias("ess"), F.round("top_10_share", 10).alias("top_10_share"), F.round("top_100_share", 10).alias("top_100_share"))


@book.add("""
WITH t AS (SELECT household_id, wealth FROM household ORDER BY wealth DESC, household_id LIMIT 20) SELECT household_id, wealth, coalesce((SELECT string_agg(CAST(CAST(age AS INT) AS VARCHAR), ',' ORDER BY age) FROM person p WHERE p.household_id = t.household_id), '') AS ages FROM t""")
def w12_top_households(spark, d):
    m = Micro(spark, d)
    t = m.household.select("household_id", "wealth").orderBy(F.desc("wealth"), "household_id").limit(20)
    a = m.person.join(F.broadcast(t.select("household_id")), "household_id", "left_semi").groupBy("household_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("age")), lambda x: x.cast("int").cast("string")), ",").alias("ages"))
    return t.join(a, "household_id", "left").fillna({"ages": ""})


@book.add("WITH y AS (SELECT period, sum(agi) AS v FROM unit GROUP BY 1) SELECT period, round(v / lag(v) OVER (ORDER BY period) - 1, 3) AS growth FROM y")
def w13_growth(spark, d):
    y = Micro(spark, d).unit.groupBy("period").agg(F.sum("agi").alias("v"))
    return y.select("period", F.round(c("v") / F.lag("v").over(Window.partitionBy(F.lit(0)).orderBy("period")) - 1, 3).alias("growth"))  # one row per year


@book.add(f"""
WITH k AS (SELECT household_id, state, -ln(greatest({_DRAW}, 1e-18)) / weight AS key FROM household), r AS (SELECT household_id, state, row_number() OVER (PARTITION BY state ORDER BY key, household_id) AS i, count(*) OVER (PARTITION BY state) AS n FROM k)
SELECT household_id, state FROM r WHERE i <= round_even(n * 0.1::DOUBLE, 0)""")
def w14_quota_sample(spark, d):
    h = Micro(spark, d).household
    key = -F.log(F.greatest(X.lcg_uniform(c("household_id"), 3), F.lit(1e-18))) / c("weight")
    return W.quota_sample(h, ["state"], key, "household_id", F.rint(c("_n") * 0.1)).select("household_id", "state")


@book.add("SELECT DISTINCT round(unnest(quantile_cont(agi, [0.0, 0.25, 0.5, 0.75, 1.0])), 2) AS level FROM unit")
def w15_quantile_levels(spark, d):
    return Micro(spark, d).unit.agg(F.percentile("agi", [0.0, 0.25, 0.5, 0.75, 1.0]).alias("l")).select(F.explode(F.array_distinct(F.transform("l", lambda x: F.round(x, 2)))).alias("level"))


@book.add("""
WITH t AS (SELECT DISTINCT target_id, variable, reform_id, geo_level, geographic_id FROM target_overview WHERE target_id % 2 = 0 OR target_id % 2 = 1)
SELECT target_id, variable, row_number() OVER (ORDER BY CASE geo_level WHEN 'national' THEN 0 WHEN 'state' THEN 1 ELSE 2 END, variable, reform_id, geographic_id, target_id) - 1 AS target_idx FROM t""")
def t1_target_order(spark, d):
    """Dense index in a total order, by ranges: rows are ranked within (level, variable) and the sizes before are added."""
    t = Micro(spark, d).raw("target_overview").select("target_id", "variable", "reform_id", "geo_level", "geographic_id").distinct()
    lvl = F.when(c("geo_level") == "national", 0).when(c("geo_level") == "state", 1).otherwise(2)
    t = t.withColumn("lvl", lvl)
    n = t.groupBy("lvl", "variable").agg(N().alias("n")).withColumn("before", F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("lvl", "variable")) - c("n")).drop("n")
    w = Window.partitionBy("lvl", "variable").orderBy("reform_id", "geographic_id", "target_id")
    return t.withColumn("r", F.row_number().over(w) - 1).join(n, ["lvl", "variable"]).select("target_id", "variable", (c("before") + c("r")).alias("target_idx"))


@book.add("""
WITH s AS (SELECT period, status, priority, sum(agi) AS row_sum, 1000000.0 + 10000 * count(*) AS target FROM unit GROUP BY ALL)
SELECT period, status, priority, round(row_sum / target, 8) AS ratio FROM s WHERE row_sum > 0 ORDER BY row_sum / target, period, status, priority LIMIT 10""")
def t2_t3_hardest(spark, d):
    s = Micro(spark, d).unit.groupBy("period", "status", "priority").agg(F.sum("agi").alias("row_sum"), (F.lit(1000000.0) + 10000 * N()).alias("target"))
    s = s.where("row_sum > 0").withColumn("x", c("row_sum") / c("target")).orderBy("x", "period", "status", "priority").limit(10)
    return s.select("period", "status", "priority", F.round("x", 8).alias("ratio"))


@book.add("SELECT household_id, arg_max(unit_id, (CASE status WHEN 'F' THEN 100 WHEN 'O' THEN 80 ELSE 60 END, agi, -unit_id)) AS chosen FROM unit GROUP BY 1")
def t4_priority_choice(spark, d):
    p = F.when(c("status") == "F", 100).when(c("status") == "O", 80).otherwise(60)
    return Micro(spark, d).unit.groupBy("household_id").agg(F.max_by("unit_id", F.struct(p, c("agi"), -c("unit_id"))).alias("chosen"))


@book.add("""
WITH RECURSIVE a AS (SELECT district, sum(weight) AS load, row_number() OVER (ORDER BY sum(weight) DESC, district) AS n FROM household GROUP BY 1),
s AS (SELECT 0::BIGINT AS n, [0.0, 0.0, 0.0, 0.0]::DOUBLE[] AS loads, 0 AS district, 0.0::DOUBLE AS load, 0 AS worker UNION ALL
  SELECT a.n, list_transform(loads, lambda x, i: CASE WHEN i = list_position(loads, list_min(loads)) THEN x + a.load ELSE x END), a.district, a.load, CAST(list_position(loads, list_min(loads)) - 1 AS INT) FROM s JOIN a ON a.n = s.n + 1)
SELECT district, load, worker FROM s WHERE n > 0""")
def t5_balanced_parts(spark, d):
    """Areas dealt to workers, heaviest first to the least loaded."""
    from weftline.operators.entities import sum_to

    a = sum_to(Micro(spark, d).household, "district", load=c("weight")).orderBy(F.desc("load"), "district").collect()  # one row per district, about 500
    loads = [0.0] * 4
    rows = []
    for r in a:
        w = min(range(4), key=lambda i: (loads[i], i))
        loads[w] += r["load"]
        rows.append((r["district"], float(r["load"]), w))
    return spark.createDataFrame(rows, "district int, load double, worker int")


@book.add("""SELECT 'state' AS kind, CAST(state AS VARCHAR) AS area, count(*) AS n FROM household GROUP BY ALL UNION ALL SELECT 'district', CAST(district AS VARCHAR), count(*) FROM household GROUP BY ALL UNION ALL SELECT 'nation', 'US', count(*) FROM household""")
def u1_union_levels(spark, d):
    h = Micro(spark, d).household.groupBy("state", "district").agg(N().alias("n"))
    a = h.groupBy(F.lit("state").alias("kind"), c("state").cast("string").alias("area")).agg(F.sum("n").alias("n"))
    b = h.groupBy(F.lit("district").alias("kind"), c("district").cast("string").alias("area")).agg(F.sum("n").alias("n"))
    return a.unionByName(b).unionByName(h.groupBy(F.lit("nation").alias("kind"), F.lit("US").alias("area")).agg(F.sum("n").alias("n")))


@book.add("SELECT DISTINCT domain_variable, variable FROM target_overview")
def u2_distinct_pairs(spark, d):
    return Micro(spark, d).raw("target_overview").select("domain_variable", "variable").distinct()


@book.add("SELECT DISTINCT stratum_id, variable AS domain_variable FROM constr WHERE variable NOT IN ('state_fips', 'congressional_district_geoid', 'tax_unit_is_filer', 'ucgid_str')")
def u3_stratum_domain(spark, d):
    return T.stratum_domains(Micro(spark, d).constraints)


@book.add("""SELECT stratum_id, 'without constraints' AS kind FROM (SELECT stratum_id FROM living EXCEPT SELECT stratum_id FROM constr) UNION ALL SELECT stratum_id, 'both' FROM (SELECT stratum_id FROM constr INTERSECT SELECT stratum_id FROM target)""")
def u4_u5_set_operations(spark, d):
    m = Micro(spark, d)
    k = m.constraints.select("stratum_id")
    a = m.strata.select("stratum_id").subtract(k).withColumn("kind", F.lit("without constraints"))
    return a.unionByName(k.intersect(m.targets.select("stratum_id")).withColumn("kind", F.lit("both")))


@book.add("""SELECT unit_id, agi FROM unit WHERE unit_id % 1000 <> 999 UNION ALL SELECT unit_id + 1000000000, agi / 2 FROM unit WHERE unit_id % 1000 = 999""")
def u6_replace_rows(spark, d):
    u = Micro(spark, d).unit.select("unit_id", "agi")
    old = u.where("unit_id % 1000 = 999")
    return u.join(old.select("unit_id"), "unit_id", "left_anti").unionByName(old.select((c("unit_id") + 1000000000).alias("unit_id"), (c("agi") / 2).alias("agi")))
