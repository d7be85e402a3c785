"""Joins and entity mapping (J of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.operators import entities as E
from weftline.operators import joins as J
from weftline.operators import targets as T
from weftline.plans.micro import Book, Micro

book = Book()
queries, oracle_sql = (lambda: book.queries), (lambda: book.sql)
c = F.col
N = lambda: F.count(F.lit(1))


@book.add("SELECT unit_id, round(coalesce(weight, 0), 4) AS weight FROM unit LEFT JOIN (SELECT * FROM household WHERE segment <> 'MACHINERY') USING (household_id)")
def j1_weight_lookup(spark: SparkSession, d: str) -> DataFrame:
    m = Micro(spark, d)
    return J.lookup(m.unit, m.household.where("segment <> 'MACHINERY'").select("household_id", "weight"), "household_id", {"weight": 0.0}).select("unit_id", "weight")


@book.add("SELECT supp, count(*) AS n, round(sum(gross), 2) AS total FROM person JOIN part ON p_partkey = part JOIN supplier ON s_suppkey = supp AND s_nationkey = p_size % 25 GROUP BY supp")
def j2_multi_key_join(spark, d):
    m = Micro(spark, d)
    p = m.person.join(m.raw("part").select(c("p_partkey").alias("part"), (c("p_size") % 25).alias("key")), "part")
    return p.join(m.raw("supplier").select(c("s_suppkey").alias("supp"), c("s_nationkey").alias("key")), ["supp", "key"]).groupBy("supp").agg(N().alias("n"), F.round(F.sum("gross"), 2).alias("total"))


@book.add("SELECT household_id, coalesce(kids, 0) AS kids FROM household LEFT JOIN (SELECT household_id, count(*) AS kids FROM person WHERE age < 18 GROUP BY 1) USING (household_id)")
def j3_left_default(spark, d):
    m = Micro(spark, d)
    return J.lookup(m.household.select("household_id"), m.person.where("age < 18").groupBy("household_id").agg(N().alias("kids")), "household_id", {"kids": 0})


@book.add("""
WITH pairs AS (SELECT unit_id, 1 + part % 7 AS parent FROM person UNION ALL SELECT unit_id, 1 + supp % 7 FROM person), n AS (SELECT unit_id, parent AS line, count(*) AS children FROM pairs GROUP BY ALL)
SELECT unit_id, line, part, supp, age, coalesce(children, 0) AS children FROM person LEFT JOIN n USING (unit_id, line)""")
def j4_parent_pointers(spark, d):
    p = Micro(spark, d).person
    both = p.select("unit_id", (c("part") % 7 + 1).alias("line")).unionByName(p.select("unit_id", (c("supp") % 7 + 1).alias("line")))
    counts = both.groupBy("unit_id", "line").agg(N().alias("children"))
    return J.lookup(p.select("unit_id", "line", "part", "supp", "age"), counts.withColumn("line", c("line").cast("int")), ["unit_id", "line"], {"children": 0})


@book.add("""
WITH y AS (SELECT household_id, period, sum(agi) AS agi FROM unit WHERE status <> 'P' GROUP BY ALL)
SELECT a.household_id, a.period, round(coalesce(b.agi, -1), 2) AS previous, b.agi IS NOT NULL AS matched FROM y a LEFT JOIN y b ON a.household_id = b.household_id AND b.period = a.period - 1""")
def j5_previous_year(spark, d):
    y = Micro(spark, d).unit.where("status <> 'P'").groupBy("household_id", "period").agg(F.sum("agi").alias("agi"))
    b = y.select("household_id", (c("period") + 1).alias("period"), c("agi").alias("previous"))
    return y.select("household_id", "period").join(b, ["household_id", "period"], "left").select("household_id", "period", F.round(F.coalesce("previous", F.lit(-1.0)), 2).alias("previous"), c("previous").isNotNull().alias("matched"))


@book.add("SELECT unit_id, 'with' AS kind FROM unit SEMI JOIN person USING (unit_id) WHERE status = 'P' UNION ALL SELECT unit_id, 'without' FROM unit ANTI JOIN person USING (unit_id)")
def j6_semi_anti(spark, d):
    m = Micro(spark, d)
    u, p = m.unit, m.person.select("unit_id")
    return u.where("status = 'P'").join(p, "unit_id", "left_semi").select("unit_id", F.lit("with").alias("kind")).unionByName(u.join(p, "unit_id", "left_anti").select("unit_id", F.lit("without").alias("kind")))


@book.add("""SELECT block_geoid, coalesce(CAST(a.cd AS VARCHAR), '') AS first_district, coalesce(CAST(c.n AS VARCHAR), '') AS county_blocks FROM block_distribution b
LEFT JOIN (SELECT left(block_geoid, 11) AS tract, min(cd_geoid) AS cd FROM block_distribution GROUP BY 1) a ON a.tract = left(b.block_geoid, 11)
LEFT JOIN (SELECT left(block_geoid, 5) AS county, count(*) AS n FROM block_distribution WHERE probability > 0.0001 GROUP BY 1) c ON c.county = left(b.block_geoid, 5)""")
def j7_crosswalk_chain(spark, d):
    b = Micro(spark, d).raw("block_distribution").select("block_geoid", "cd_geoid", "probability", F.substring("block_geoid", 1, 11).alias("tract"), F.substring("block_geoid", 1, 5).alias("county"))
    t = b.groupBy("tract").agg(F.min("cd_geoid").cast("string").alias("first_district"))
    k = b.where("probability > 0.0001").groupBy("county").agg(N().cast("string").alias("county_blocks"))
    return b.join(t, "tract", "left").join(k, "county", "left").select("block_geoid", "first_district", "county_blocks").fillna("")


@book.add("""
WITH m AS (SELECT c_nationkey AS old, s_nationkey AS new, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL)
SELECT old, new, n, round(n / sum(n) OVER (PARTITION BY old), 10) AS share FROM m""")
def j8_three_way_shares(spark, d):
    m = Micro(spark, d)
    p = m.person.join(m.household.select("household_id", c("district").alias("old")), "household_id").join(m.raw("supplier").select(c("s_suppkey").alias("supp"), c("s_nationkey").alias("new")), "supp")
    return p.groupBy("old", "new").agg(N().alias("n")).withColumn("share", F.round(c("n") / F.sum("n").over(Window.partitionBy("old")), 10))


@book.add("""
WITH b AS (SELECT stratum_id, variable, reform_id, coalesce(max(period) FILTER (period <= 2024), min(period)) AS period FROM target GROUP BY ALL)
SELECT target_id, stratum_id, variable, reform_id, period FROM target JOIN b USING (stratum_id, variable, reform_id, period)""")
def j9_best_period(spark, d):
    return T.best_period(Micro(spark, d).targets, ["stratum_id", "variable", "reform_id"], "period", F.lit(2024)).select("target_id", "stratum_id", "variable", "reform_id", "period")


@book.add("WITH b AS (SELECT variable, coalesce(max(period) FILTER (period <= 2023), min(period)) AS period FROM target GROUP BY 1) SELECT variable, period, count(*) AS n, round(sum(value), 2) AS total FROM target JOIN b USING (variable, period) GROUP BY ALL")
def j10_best_year(spark, d):
    return T.best_period(Micro(spark, d).targets, ["variable"], "period", F.lit(2023)).groupBy("variable", "period").agg(N().alias("n"), F.round(F.sum("value"), 2).alias("total"))


@book.add("WITH y AS (SELECT household_id, period, sum(CASE WHEN status = 'F' THEN agi ELSE 0 END) AS v FROM unit GROUP BY ALL) SELECT household_id, round(coalesce(arg_max(v, period) FILTER (v <> 0), 0), 2) AS v FROM y GROUP BY 1")
def j11_latest_nonzero(spark, d):
    y = Micro(spark, d).unit.groupBy("household_id", "period").agg(F.sum(F.when(c("status") == "F", c("agi")).otherwise(0.0)).alias("v"))
    return T.latest_reported(y, ["household_id"], "period", "v").select("household_id", F.round("v", 2).alias("v"))


@book.add("SELECT target_id, t.variable, t.value, k.variable AS constraint_variable, operation, k.value AS constraint_value FROM target t JOIN living USING (stratum_id) JOIN constr k USING (stratum_id) WHERE active AND reform_id = 0 AND t.variable LIKE '%income%'")
def j12_target_constraints(spark, d):
    m = Micro(spark, d)
    t = m.targets.where(c("active") & (c("reform_id") == 0) & c("variable").like("%income%")).join(m.strata.select("stratum_id"), "stratum_id")
    k = m.constraints.select("stratum_id", c("variable").alias("constraint_variable"), "operation", c("value").alias("constraint_value"))
    return t.join(k, "stratum_id").select("target_id", "variable", "value", "constraint_variable", "operation", "constraint_value")


BANDS = "(VALUES ('all', '-Infinity'::DOUBLE, 'Infinity'::DOUBLE), ('low', '-Infinity'::DOUBLE, 50000.0::DOUBLE), ('mid', 50000.0, 150000.0), ('upper', 150000.0, 300000.0), ('overlap', 100000.0, 200000.0), ('top', 300000.0, 'Infinity'::DOUBLE)) b(band, lo, hi)"


def bands(spark: SparkSession) -> DataFrame:
    inf = float("inf")
    return spark.createDataFrame([("all", -inf, inf), ("low", -inf, 50000.0), ("mid", 50000.0, 150000.0), ("upper", 150000.0, 300000.0), ("overlap", 100000.0, 200000.0), ("top", 300000.0, inf)], "band string, lo double, hi double")


@book.add(f"SELECT band, status, count(*) AS n, round(sum(agi * weight), 2) AS amount FROM unit JOIN household USING (household_id) JOIN {BANDS} ON agi >= lo AND agi < hi GROUP BY ALL")
def j13_band_join(spark, d):
    m = Micro(spark, d)
    u = m.unit.join(m.household.select("household_id", "weight"), "household_id")
    return J.band_join(u, bands(spark), c("agi"), "lo", "hi", 50000.0).groupBy("band", "status").agg(N().alias("n"), F.round(F.sum(c("agi") * c("weight")), 2).alias("amount"))


@book.add("SELECT household_id, round(sum(earnings), 4) AS earnings, arg_min(gross, (line, part, supp, age, gross)) AS first_gross, bool_or(age > 49) AS any_old FROM person GROUP BY 1")
def j14_j15_j16_climb(spark, d):
    p = Micro(spark, d).person
    s = E.sum_to(p, "household_id", earnings=c("earnings")).withColumn("earnings", F.round("earnings", 4))
    f = E.first_member(p, "household_id", ["line", "part", "supp", "age"], first_gross=c("gross"))
    return s.join(f, "household_id").join(E.any_member(p, "household_id", any_old=c("age") > 49), "household_id")


@book.add("""
WITH u AS (SELECT unit_id, household_id, agi, EXISTS (SELECT 1 FROM person p WHERE p.unit_id = unit.unit_id AND flag = 'R') AS ok FROM unit)
SELECT household_id, round(sum(CASE WHEN ok THEN agi ELSE 0 END), 2) AS total FROM u GROUP BY 1""")
def j17_scatter_add(spark, d):
    m = Micro(spark, d)
    u = E.to_members(m.unit, E.any_member(m.person, "unit_id", ok=c("flag") == "R"), "unit_id", {"ok": False})
    return u.groupBy("household_id").agg(F.round(F.sum(F.when(c("ok"), c("agi")).otherwise(0.0)), 2).alias("total"))


@book.add("""
WITH k AS (SELECT clone, household_id FROM household, (SELECT unnest([0, 1, 2]) AS clone) WHERE (household_id + clone) % 3 = 0), n AS (SELECT *, row_number() OVER (PARTITION BY clone ORDER BY household_id) - 1 AS new_id FROM k)
SELECT clone, unit_id, new_id FROM n JOIN unit USING (household_id)""")
def j18_relabel(spark, d):
    from weftline.operators.clone import dense_ids

    m = Micro(spark, d)
    k = m.household.select("household_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("clone")).where("(household_id + clone) % 3 = 0")
    return dense_ids(k, ["clone"], "household_id", "new_id").join(m.unit.select("unit_id", "household_id"), "household_id").select("clone", "unit_id", "new_id")


@book.add("SELECT unit_id, segment FROM unit JOIN household USING (household_id)")
def j19_checked_join(spark, d):
    m = Micro(spark, d)
    return J.checked_join(m.unit, m.household, "household_id").select("unit_id", "segment")


@book.add("""
WITH v AS (SELECT p_partkey AS record, n_nationkey AS place, p_retailprice * (1 + n_nationkey / 100.0::DOUBLE) AS val FROM part, nation), s AS (SELECT record, place % 5 AS st, avg(val) AS sval FROM v GROUP BY ALL)
SELECT part AS record, district, round(coalesce(val, sval, 0), 4) AS val FROM (SELECT DISTINCT part, district FROM person JOIN household USING (household_id)) LEFT JOIN v ON record = part AND place = district LEFT JOIN s ON s.record = part AND st = district % 5""")
def j20_j21_place_values(spark, d):
    """A record's value for its place, else for the place's parent, else 0."""
    m = Micro(spark, d)
    v = m.raw("part").select(c("p_partkey").alias("record"), "p_retailprice").withColumn("district", F.explode(F.sequence(F.lit(0), F.lit(24)))).select("record", "district", (c("p_retailprice") * (1 + c("district") / 100.0)).alias("val"))
    asked = m.person.join(m.household.select("household_id", "district"), "household_id").select(c("part").alias("record"), "district").distinct()
    return _place_values(asked, v).withColumn("val", F.round("val", 4))


def _place_values(asked: DataFrame, v: DataFrame) -> DataFrame:
    """``v`` has as many rows as records times places, though Spark takes it for about as small as the table of records: never broadcast."""
    s = v.groupBy("record", (c("district") % 5).alias("st")).agg(F.avg("val").alias("sval"))
    j = asked.withColumn("st", c("district") % 5).join(v.hint("merge"), ["record", "district"], "left").join(s.hint("merge"), ["record", "st"], "left")
    return j.select("record", "district", F.coalesce("val", "sval", F.lit(0.0)).alias("val"))


_KNN = """
WITH st AS (SELECT stddev_pop(p_size) AS ss, stddev_pop(p_retailprice) AS sp FROM part), p AS (SELECT p_partkey AS id, split_part(p_type, ' ', 1) AS g, p_size, p_retailprice FROM part), n AS (SELECT g, count(*) AS n FROM p GROUP BY 1),
x AS (SELECT r.id AS rid, round(pow((r.p_size - d.p_size) / ss, 2) + pow((r.p_retailprice - d.p_retailprice) / sp, 2), 8) AS dist FROM p r JOIN n USING (g) JOIN p d ON d.id <> r.id AND (d.g = r.g OR n = 1), st)
"""


@book.add(_KNN + "SELECT rid, min(dist) AS distance FROM x GROUP BY rid")
def j22_nearest_donor(spark, d):
    """Each part's nearest other part of its kind."""
    p = Micro(spark, d).raw("part").withColumn("g", F.split("p_type", " ")[0])
    found = J.nearest_donors(p, p, "p_partkey", "p_partkey", {"p_size": 1.0, "p_retailprice": 1.0}, "g", others=True)
    return found.select("rid", F.round("distance", 8).alias("distance"))


@book.add("""
WITH x AS (SELECT s.s_suppkey AS rid, p_partkey AS did, abs(p_size - s_suppkey % 50) * 2 + abs(ln(1 + p_retailprice) - ln(1 + abs(s_acctbal))) AS dist FROM supplier s JOIN part ON p_partkey % 25 = s_nationkey)
SELECT rid, did, k FROM (SELECT rid, did, row_number() OVER (PARTITION BY rid ORDER BY round(dist, 8), did) AS k FROM x) WHERE k <= 3""")
def j23_top_donors(spark, d):
    m = Micro(spark, d)
    r = m.raw("supplier").select(c("s_suppkey").alias("rid"), c("s_nationkey").cast("long").alias("g"), (c("s_suppkey") % 50).alias("size"), F.log1p(F.abs("s_acctbal")).alias("log_amount"))
    p = m.raw("part").select(c("p_partkey").alias("did"), (c("p_partkey") % 25).alias("g"), c("p_size").alias("size"), F.log1p("p_retailprice").alias("log_amount"))
    return J.nearest_donors(r, p, "rid", "did", {"size": 2.0, "log_amount": 1.0}, "g", k=3, squared=False, standardise=False).select("rid", "did", c("rank").alias("k"))


@book.add("""
WITH r AS (SELECT segment, household_id AS rid, row_number() OVER (PARTITION BY segment ORDER BY wealth, household_id) - 1 AS i, count(*) OVER (PARTITION BY segment) AS n FROM household WHERE household_id % 2 = 0),
q AS (SELECT segment, household_id AS did, row_number() OVER (PARTITION BY segment ORDER BY wealth, household_id) - 1 AS pos, count(*) OVER (PARTITION BY segment) AS m FROM household WHERE household_id % 2 = 1)
SELECT r.segment, rid, did FROM r JOIN (SELECT DISTINCT segment, m FROM q) USING (segment) JOIN q ON q.segment = r.segment AND q.pos = CASE WHEN n = 1 THEN 0 ELSE CAST(round_even(i * (q.m - 1) / (n - 1), 0) AS INT) END""")
def j24_pair_by_rank(spark, d):
    h = Micro(spark, d).household
    return J.pair_by_rank(h.where("household_id % 2 = 0"), h.where("household_id % 2 = 1"), "household_id", "household_id", "wealth", "wealth", "segment")


@book.add("""
WITH n AS (SELECT *, count(*) OVER (PARTITION BY segment, district) AS near FROM household), a AS (SELECT segment, avg(wealth) AS w FROM household GROUP BY 1), b AS (SELECT segment, district, avg(wealth) AS w FROM household GROUP BY ALL)
SELECT household_id, round(CASE WHEN near >= 13 THEN b.w ELSE a.w END, 4) AS reference, near >= 13 AS local FROM n JOIN a USING (segment) JOIN b USING (segment, district)""")
def j25_fallback_neighbourhood(spark, d):
    h = Micro(spark, d).household
    b = h.groupBy("segment", "district").agg(F.avg("wealth").alias("b"), N().alias("near"))
    a = h.groupBy("segment").agg(F.avg("wealth").alias("a"))
    return h.join(b, ["segment", "district"]).join(a, "segment").select("household_id", F.round(F.when(c("near") >= 13, c("b")).otherwise(c("a")), 4).alias("reference"), (c("near") >= 13).alias("local"))


@book.add("SELECT record_id, residence_state, r_regionkey AS region FROM (SELECT DISTINCT record_id, residence_state FROM forbes_top_tail) JOIN (SELECT upper(left(n_name, 2)) AS code, min(n_regionkey) AS r_regionkey FROM nation GROUP BY 1) ON code = residence_state")
def j26_label_mapping(spark, d):
    m = Micro(spark, d)
    codes = m.raw("nation").groupBy(F.upper(F.substring("n_name", 1, 2)).alias("residence_state")).agg(F.min("n_regionkey").alias("region"))
    return m.raw("forbes_top_tail").select("record_id", "residence_state").distinct().join(J.small(codes), "residence_state").select("record_id", "residence_state", "region")


@book.add("""
WITH a AS (SELECT segment, count(*) / sum(count(*)) OVER () AS s FROM household WHERE wealth > 0 AND segment <> 'BUILDING' GROUP BY 1), b AS (SELECT segment, count(*) / sum(count(*)) OVER () AS s FROM household WHERE wealth <= 0 AND segment <> 'MACHINERY' GROUP BY 1)
SELECT segment, round(coalesce(a.s, 0), 10) AS synthetic, round(coalesce(b.s, 0), 10) AS actual, round(coalesce(a.s, 0) - coalesce(b.s, 0), 10) AS gap FROM a FULL JOIN b USING (segment)""")
def j27_full_outer(spark, d):
    h = Micro(spark, d).household

    def shares(x: DataFrame, name: str) -> DataFrame:
        n = x.groupBy("segment").agg(N().alias("n"))
        return n.join(F.broadcast(n.agg(F.sum("n").alias("t"))), F.lit(True)).select("segment", (c("n") / c("t")).alias(name))  # the total is one row

    j = shares(h.where("wealth > 0 AND segment <> 'BUILDING'"), "s").join(shares(h.where("wealth <= 0 AND segment <> 'MACHINERY'"), "a"), "segment", "full_outer").fillna(0.0)
    return j.select("segment", F.round("s", 10).alias("synthetic"), F.round("a", 10).alias("actual"), F.round(c("s") - c("a"), 10).alias("gap"))


@book.add("SELECT s AS severity, count(household_id) AS n FROM (SELECT unnest(['ok', 'flag', 'significant', 'critical']) AS s) LEFT JOIN household ON s = CASE WHEN abs(wealth) < 100 THEN 'ok' WHEN abs(wealth) < 1000 THEN 'flag' WHEN abs(wealth) < 20000 THEN 'significant' ELSE 'critical' END GROUP BY 1")
def j28_reindex(spark, d):
    h = Micro(spark, d).household
    w = F.abs("wealth")
    n = h.groupBy(F.when(w < 100, "ok").when(w < 1000, "flag").when(w < 20000, "significant").otherwise("critical").alias("severity")).agg(N().alias("n"))
    keys = spark.createDataFrame([("ok",), ("flag",), ("significant",), ("critical",)], "severity string")
    return J.lookup(keys, n, "severity", {"n": 0})
