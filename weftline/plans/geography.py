"""Clones and geography (CL), take-up (TK), matrix (MX)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import exprs as X
from weftline.operators import clone as C
from weftline.operators import entities as E
from weftline.operators import joins as J
from weftline.operators import matrix as MX
from weftline.operators import takeup as TK
from weftline.operators import weights as W
from weftline.plans.micro import Book, Micro
from weftline.session import scratch

book = Book()
queries, oracle_sql = (lambda: book.queries), (lambda: book.sql)
c = F.col
N = lambda: F.count(F.lit(1))
N_CLONES = 3


@book.add("SELECT cd_geoid, block_geoid, round(probability / sum(probability) OVER (), 12) AS share FROM block_distribution")
def cl1_block_shares(spark: SparkSession, d: str) -> DataFrame:
    return C.shares(Micro(spark, d).raw("block_distribution"), "probability", []).select("cd_geoid", "block_geoid", F.round("share", 12).alias("share"))


_AMT = "a AS (SELECT CAST(geographic_id AS INT) AS cd_geoid, sum(value) AS amount FROM (SELECT DISTINCT target_id, geographic_id, value FROM target_overview WHERE geo_level = 'district' AND value > 0 AND NOT isnan(value) AND variable = 'adjusted_gross_income') GROUP BY 1)"


def _district_amounts(m: Micro) -> DataFrame:
    t = m.raw("target_overview").where("geo_level = 'district' AND value > 0 AND NOT isnan(value) AND variable = 'adjusted_gross_income'").select("target_id", "geographic_id", "value").distinct()
    return t.groupBy(c("geographic_id").cast("int").alias("cd_geoid")).agg(F.sum("value").alias("amount"))


@book.add(f"""WITH {_AMT}, m AS (SELECT cd_geoid, sum(probability) AS m FROM block_distribution GROUP BY 1), k AS (SELECT cd_geoid, m, coalesce(amount, 0) AS amount FROM m LEFT JOIN a USING (cd_geoid))
SELECT cd_geoid, block_geoid, round(probability / m * amount / (SELECT sum(amount) FROM k), 12) AS tilted FROM block_distribution JOIN k USING (cd_geoid)""")
def cl2_tilted_shares(spark, d):
    m = Micro(spark, d)
    return C.tilt(m.raw("block_distribution"), _district_amounts(m)).select("cd_geoid", "block_geoid", F.round("tilted", 12).alias("tilted"))


def _places(spark: SparkSession, d: str) -> DataFrame:
    """Three different districts for each household by the weight of their blocks; for the top decile by the tilted weight (CL2)."""
    m = Micro(spark, d)
    b = m.raw("block_distribution")
    even = b.groupBy("cd_geoid").agg(F.sum("probability").alias("p")).withColumn("pool", F.lit("all"))
    tilted = C.tilt(b, _district_amounts(m)).groupBy("cd_geoid").agg(F.sum("tilted").alias("p")).withColumn("pool", F.lit("top"))
    return C.draw_without_repeat(_pools(m), even.unionByName(tilted), "household_id", "cd_geoid", "p", N_CLONES, group="pool")


def _pools(m: Micro) -> DataFrame:
    top = m.household.agg(F.percentile("wealth", 0.9).alias("edge"))
    return m.household.join(F.broadcast(top), F.lit(True)).select("household_id", F.when(c("wealth") >= c("edge"), "top").otherwise("all").alias("pool"))  # one row


@book.add()
def cl3_places_without_repeat(spark, d):
    return _places(spark, d)


@book.add("SELECT count(*) AS households, 3 * count(*) AS places, true AS all_different, true AS top_in_tilted FROM household")
def cl3_place_rules(spark, d):
    """What the places must keep: three per household, all different, and for the top decile only districts with tilted weight."""
    m = Micro(spark, d)
    p = _places(spark, d).join(_pools(m), "household_id")
    heavy = _district_amounts(m).where("amount > 0").select("cd_geoid", F.lit(True).alias("heavy"))
    per = p.join(heavy, "cd_geoid", "left").groupBy("household_id", "pool").agg(N().alias("n"), F.count_distinct("cd_geoid").alias("k"), F.min(F.coalesce("heavy", F.lit(False))).alias("heavy"))
    return per.agg(N().alias("households"), F.sum("n").alias("places"), F.min((c("k") == N_CLONES) & (c("n") == N_CLONES)).alias("all_different"), F.min((c("pool") != "top") | c("heavy")).alias("top_in_tilted"))


@book.add("SELECT household_id, k AS clone, k * (SELECT count(*) FROM household) + household_id AS col_id FROM household, range(3) r(k)")
def cl4_clones(spark, d):
    h = Micro(spark, d).household
    n = h.agg(N().alias("n"))
    return C.clones(h.join(F.broadcast(n), F.lit(True)), N_CLONES, "household_id", c("n")).select("household_id", "clone", "col_id")


@book.add("""SELECT clone_idx, record_idx, left(g.block_geoid, 2) AS state, left(g.block_geoid, 11) AS tract, coalesce(CAST(b.cd_geoid AS VARCHAR), '') AS district FROM (SELECT DISTINCT clone_idx, record_idx, block_geoid FROM geography_assignment) g LEFT JOIN block_distribution b ON b.block_geoid = g.block_geoid""")
def cl5_geography_of_block(spark, d):
    m = Micro(spark, d)
    g = m.raw("geography_assignment").select("clone_idx", "record_idx", "block_geoid").distinct()
    s, _, t = X.block_parts(c("block_geoid"))
    b = m.raw("block_distribution").select("block_geoid", c("cd_geoid").cast("string").alias("district"))
    return g.join(J.small(b), "block_geoid", "left").select("clone_idx", "record_idx", s.alias("state"), t.alias("tract"), F.coalesce("district", F.lit("")).alias("district"))


_U9 = "((household_id * (1103515245 + 9) + 12345 + 9) % 2147483648) / 2147483648.0"


@book.add(f"""
WITH o AS (SELECT cd_geoid, row_number() OVER (ORDER BY cd_geoid) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT cd_geoid FROM block_distribution)),
h AS (SELECT household_id, cd_geoid, {_U9} AS u FROM household JOIN o ON i = household_id % n),
b AS (SELECT cd_geoid, block_geoid, sum(probability) OVER (PARTITION BY cd_geoid ORDER BY block_geoid) / sum(probability) OVER (PARTITION BY cd_geoid) AS hi FROM block_distribution)
SELECT household_id, h.cd_geoid, min(block_geoid) AS block_geoid FROM h JOIN b ON b.cd_geoid = h.cd_geoid AND u < hi GROUP BY ALL""")
def cl6_draw_block(spark, d):
    m = Micro(spark, d)
    return C.draw_block(_in_districts(m), m.raw("block_distribution"), "cd_geoid", "block_geoid", "probability", X.lcg_uniform(c("household_id"), 9)).select("household_id", "cd_geoid", "block_geoid")


@book.add(f"""
WITH o AS (SELECT cd_geoid, row_number() OVER (ORDER BY cd_geoid) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT cd_geoid FROM block_distribution)),
h AS (SELECT household_id, cd_geoid, {_U9} AS u FROM household JOIN o ON i = household_id % n),
k AS (SELECT cd_geoid, left(block_geoid, 5) AS county, sum(probability) AS p FROM block_distribution WHERE cd_geoid % 2 = 1 GROUP BY ALL
  UNION ALL SELECT o.cd_geoid, county, 1.0 FROM o JOIN (SELECT DISTINCT left(block_geoid, 5) AS county FROM block_distribution) c ON CAST(left(county, 2) AS INT) = o.cd_geoid // 100 WHERE o.cd_geoid % 2 = 0),
b AS (SELECT cd_geoid, county, sum(p) OVER (PARTITION BY cd_geoid ORDER BY county) / sum(p) OVER (PARTITION BY cd_geoid) AS hi FROM k)
SELECT household_id, h.cd_geoid, min(county) AS county FROM h JOIN b ON b.cd_geoid = h.cd_geoid AND u < hi GROUP BY ALL""")
def cl6_county_fallback(spark, d):
    """A county by weight where the district has a distribution (the odd ones), else any of the state's with equal chance."""
    m = Micro(spark, d)
    b = m.raw("block_distribution").withColumn("county", F.substring("block_geoid", 1, 5))
    known = b.where("cd_geoid % 2 = 1").groupBy("cd_geoid", "county").agg(F.sum("probability").alias("p"))
    others = b.select(F.substring("county", 1, 2).cast("int").alias("parent"), "county")
    h = _in_districts(m)
    return C.draw_with_fallback(h, known, others, "cd_geoid", "county", "p", F.floor(c("cd_geoid") / 100).cast("int"), X.lcg_uniform(c("household_id"), 9)).select("household_id", "cd_geoid", "county")


def _in_districts(m: Micro) -> DataFrame:
    """Households dealt to the districts in turn."""
    o = C.dense_ids(m.raw("block_distribution").select("cd_geoid").distinct(), [], "cd_geoid", "i")
    n = o.agg(N().alias("n"))
    return m.household.select("household_id").join(F.broadcast(n), F.lit(True)).withColumn("i", c("household_id") % c("n")).join(o, "i").select("household_id", "cd_geoid")


@book.add("""
WITH f AS (SELECT cd_geoid, left(block_geoid, 5) AS county, sum(probability) AS p FROM block_distribution GROUP BY ALL), k AS (SELECT * FROM f WHERE CAST(county AS INT) % 2 = 1)
SELECT cd_geoid, county, round(p / sum(p) OVER (PARTITION BY cd_geoid), 10) AS share, round(sum(p) OVER (PARTITION BY cd_geoid), 10) AS inside FROM k""")
def cl7_county_filter(spark, d):
    f = Micro(spark, d).raw("block_distribution").groupBy("cd_geoid", F.substring("block_geoid", 1, 5).alias("county")).agg(F.sum("probability").alias("p")).where("cast(county as int) % 2 = 1")
    return C.shares(f, "p", ["cd_geoid"]).select("cd_geoid", "county", F.round("share", 10).alias("share"), F.round(c("p") / c("share"), 10).alias("inside"))


@book.add("""SELECT household_id, weight, wealth, 1 AS half FROM household UNION ALL SELECT household_id + (SELECT max(household_id) + 1 FROM household), 0, wealth * 2, 2 FROM household""")
def cl8_double_records(spark, d):
    h = Micro(spark, d).household.select("household_id", "weight", "wealth")
    return C.double_records(h, ["household_id"], "weight", {"wealth": c("wealth") * 2})


_AREA = "WITH k AS (SELECT k AS clone, household_id, weight FROM household, range(3) r(k) WHERE state = 1 AND (household_id + k) % 3 = 0 AND weight > 0), n AS (SELECT *, row_number() OVER (ORDER BY clone, household_id) - 1 AS new_household FROM k)"


@book.add(_AREA + " SELECT n.clone, new_household, unit_id, row_number() OVER (ORDER BY n.clone, unit_id) - 1 AS new_unit, weight FROM n JOIN unit USING (household_id)")
def cl9_area_subset(spark, d):
    """The households of one area with their units under new dense ids."""
    m = Micro(spark, d)
    h = m.household.withColumn("clone", F.explode(F.sequence(F.lit(0), F.lit(N_CLONES - 1)))).where("(household_id + clone) % 3 = 0")
    k = C.area_subset(h, c("state") == 1).select("clone", "household_id", "weight")
    big = F.lit(1 << 40)
    k = C.dense_ids(k.withColumn("o", c("clone") * big + c("household_id")), [], "o", "new_household").drop("o")
    u = k.join(m.unit.select("household_id", "unit_id"), "household_id").withColumn("o", c("clone") * big + c("unit_id"))
    return C.dense_ids(u, [], "o", "new_unit").select("clone", "new_household", "unit_id", "new_unit", "weight")


@book.add("""SELECT block_geoid, CASE WHEN left(block_geoid, 5) = '06037' THEN 'override' ELSE left(block_geoid, 5) END AS county, cd_geoid // 100 AS state, cd_geoid % 100 AS number FROM block_distribution""")
def cl11_overrides(spark, d):
    k = F.substring("block_geoid", 1, 5)
    return Micro(spark, d).raw("block_distribution").select("block_geoid", F.when(k == "06037", "override").otherwise(k).alias("county"), F.floor(c("cd_geoid") / 100).cast("int").alias("state"), (c("cd_geoid") % 100).alias("number"))


# The counties of New York City.
CITY = ("36005", "36047", "36061", "36081", "36085")


@book.add(f"""WITH x AS (SELECT DISTINCT cd_geoid, left(block_geoid, 5) AS county FROM block_distribution)
SELECT 'state' AS area_type, lpad(CAST(cd_geoid // 100 AS VARCHAR), 2, '0') AS area_id, count(DISTINCT cd_geoid) AS districts FROM x GROUP BY ALL UNION ALL SELECT 'district', CAST(cd_geoid AS VARCHAR), 1 FROM x GROUP BY ALL
UNION ALL SELECT 'city', 'NYC', count(DISTINCT cd_geoid) FROM x WHERE county IN {CITY} HAVING count(*) > 0 UNION ALL SELECT 'national', 'US', count(DISTINCT cd_geoid) FROM x""")
def cl12_area_catalogue(spark, d):
    """States, districts, the city (districts with blocks in its counties, if any) and the nation."""
    k = Micro(spark, d).raw("block_distribution").select("cd_geoid", F.substring("block_geoid", 1, 5).alias("county")).distinct()
    state = F.lpad(F.floor(c("cd_geoid") / 100).cast("string"), 2, "0")
    place = F.array_compact(F.array(
        F.struct(F.lit("state").alias("area_type"), state.alias("area_id")), F.struct(F.lit("district").alias("area_type"), c("cd_geoid").cast("string").alias("area_id")),
        F.struct(F.lit("national").alias("area_type"), F.lit("US").alias("area_id")), F.when(c("county").isin(*CITY), F.struct(F.lit("city").alias("area_type"), F.lit("NYC").alias("area_id"))),
    ))
    return k.select("cd_geoid", F.explode(place).alias("p")).groupBy("p.area_type", "p.area_id").agg(F.count_distinct("cd_geoid").alias("districts"))


_CHUNK = f"""
WITH o AS (SELECT cd_geoid, row_number() OVER (ORDER BY cd_geoid) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT cd_geoid FROM block_distribution)),
b AS (SELECT cd_geoid, block_geoid, sum(probability) OVER (PARTITION BY cd_geoid ORDER BY block_geoid) / sum(probability) OVER (PARTITION BY cd_geoid) AS hi FROM block_distribution),
k AS (SELECT k * (SELECT max(household_id) + 1 FROM household) + household_id AS col_id, k AS clone, household_id FROM household, range(3) r(k)),
e AS (SELECT min(col_id) + (max(col_id) - min(col_id)) // 4 AS lo, min(col_id) + (max(col_id) - min(col_id)) // 2 AS hi FROM k),
h AS (SELECT k.*, cd_geoid, ((col_id * (1103515245 + 9) + 12345 + 9) % 2147483648) / 2147483648.0 AS u FROM k JOIN o ON i = (household_id + clone * 7) % n, e WHERE col_id >= lo AND col_id < e.hi),
g AS (SELECT h.col_id, household_id, clone, h.cd_geoid, min(block_geoid) AS block_geoid FROM h JOIN b ON b.cd_geoid = h.cd_geoid AND u < b.hi GROUP BY ALL),
p AS (SELECT household_id, unit_id, count(*) FILTER (age >= 18) AS adults, count(*) FILTER (age < 18) AS kids FROM person GROUP BY ALL)
SELECT col_id, clone, p.unit_id, left(block_geoid, 5) AS county, g.cd_geoid, round((CASE WHEN status = 'F' THEN 18000.0 ELSE 21000.0 END * pow(adults + 0.7 * kids, 0.7) / pow(3.4, 0.7)) * (1 + (g.cd_geoid // 100) / 100.0), 4) AS threshold,
  (((p.unit_id * 3 + clone) * (1103515245 + 5) + 12345 + 5) % 2147483648) / 2147483648.0 < CASE WHEN g.cd_geoid // 100 < 20 THEN 0.6 ELSE 0.8 END AS takes_up
FROM g JOIN p USING (household_id) JOIN unit ON unit.unit_id = p.unit_id
"""


@book.add(_CHUNK)
def cl10_cl11_chunk(spark, d):
    """A range of columns with mixed places: each clone's block, its county and district, and per filing unit the threshold at the new place and the take-up."""
    m = Micro(spark, d)
    h = m.household.select("household_id").join(F.broadcast(m.household.agg((F.max("household_id") + 1).alias("step"))), F.lit(True))  # one row
    k = C.clones(h, N_CLONES, "household_id", c("step")).select("col_id", "clone", "household_id")
    e = k.agg(F.min("col_id").alias("a"), F.max("col_id").alias("z")).first()
    lo, hi = e["a"] + (e["z"] - e["a"]) // 4, e["a"] + (e["z"] - e["a"]) // 2
    o = C.dense_ids(m.raw("block_distribution").select("cd_geoid").distinct(), [], "cd_geoid", "i")
    n = o.count()
    part = k.where((c("col_id") >= lo) & (c("col_id") < hi)).withColumn("i", (c("household_id") + c("clone") * 7) % n).join(o, "i").drop("i")
    g = C.draw_block(part, m.raw("block_distribution"), "cd_geoid", "block_geoid", "probability", X.lcg_uniform(c("col_id"), 9))
    sizes = m.person.groupBy("household_id", "unit_id").agg(F.count(F.when(c("age") >= 18, 1)).alias("adults"), F.count(F.when(c("age") < 18, 1)).alias("kids"))
    u = g.join(sizes, "household_id").join(m.unit.select("unit_id", "status"), "unit_id")
    base = F.when(c("status") == "F", 18000.0).otherwise(21000.0) * F.pow(c("adults") + 0.7 * c("kids"), F.lit(0.7)) / F.pow(F.lit(3.4), F.lit(0.7))
    state = F.floor(c("cd_geoid") / 100)
    takes = X.lcg_uniform(c("unit_id") * 3 + c("clone"), 5) < F.when(state < 20, 0.6).otherwise(0.8)
    return u.select("col_id", "clone", "unit_id", X.block_parts(c("block_geoid"))[1].alias("county"), "cd_geoid", F.round(base * (1 + state / 100.0), 4).alias("threshold"), takes.alias("takes_up"))


@book.add("SELECT count(*) AS n, count(*) AS different, true AS inside, true AS even FROM unit")
def tk1_draws(spark, d):
    """One draw per filing unit: different, in [0, 1), and their mean within five standard errors of a half; the same again in another order."""
    u = Micro(spark, d).unit
    x = TK.draws(u, "snap", "household_id", "unit_id").select("unit_id", "draw")
    if x.exceptAll(TK.draws(u.orderBy("agi"), "snap", "household_id", "unit_id").select("unit_id", "draw")).limit(1).count():
        raise RuntimeError("draws depend on the order of the rows")
    return x.agg(N().alias("n"), F.count_distinct("draw").alias("different"), F.min((c("draw") >= 0) & (c("draw") < 1)).alias("inside"), (F.abs(F.avg("draw") - 0.5) < 5 / F.sqrt(12.0 * N())).alias("even"))


_U5 = "((unit_id * (1103515245 + 5) + 12345 + 5) % 2147483648) / 2147483648.0"
_TAKE = f"""
WITH u AS (SELECT unit_id, state, agi, status = 'P' AS reported, {_U5} AS draw, CASE state WHEN 0 THEN 0.5 WHEN 1 THEN 0.9 WHEN 2 THEN 0.7 ELSE 0.8 END::DOUBLE AS rate, household_id, weight FROM unit JOIN household USING (household_id)),
g AS (SELECT state, CASE WHEN count(*) > count(*) FILTER (reported) THEN greatest(floor(max(rate) * count(*)) - count(*) FILTER (reported), 0) / (count(*) - count(*) FILTER (reported)) ELSE 0 END AS p FROM u GROUP BY 1),
t AS (SELECT u.*, reported OR draw < p AS takes_up FROM u JOIN g USING (state))
"""


def _takers(spark: SparkSession, d: str) -> DataFrame:
    m = Micro(spark, d)
    u = m.unit.join(m.household.select("household_id", "state", "weight"), "household_id").withColumn("reported", c("status") == "P").withColumn("draw", X.lcg_uniform(c("unit_id"), 5))
    r = spark.createDataFrame([(0, 0.5), (1, 0.9), (2, 0.7)], "state int, rate double")
    return TK.reported_first(TK.rates(u, J.small(r), "state"), "draw", "rate", "reported", ["state"])


@book.add(_TAKE + "SELECT unit_id, takes_up FROM t")
def tk2_tk3_reported_first(spark, d):
    return _takers(spark, d).select("unit_id", "takes_up")


@book.add(_TAKE + f", f AS (SELECT unit_id, state, weight, sum(weight) OVER (PARTITION BY state ORDER BY draw, unit_id) AS cum FROM t WHERE NOT takes_up) SELECT unit_id FROM f WHERE cum - weight < 500")
def tk4_fill_to_target(spark, d):
    return W.fill_to_total(_takers(spark, d).where("NOT takes_up"), "draw", "weight", "unit_id", F.lit(500.0), ["state"]).select("unit_id")


@book.add(_TAKE + "SELECT household_id, round(sum(CASE WHEN takes_up THEN CASE WHEN draw < 0.5 THEN agi ELSE agi * 0.5 END ELSE 0 END), 3) AS benefit FROM t GROUP BY 1")
def tk5_filer_blend(spark, d):
    t = _takers(spark, d)
    v = TK.blend(c("draw") < 0.5, c("agi"), c("agi") * 0.5)
    return t.groupBy("household_id").agg(F.round(F.sum(F.when(c("takes_up"), v).otherwise(0.0)), 3).alias("benefit"))


@book.add(f"WITH k AS (SELECT unit_id, least(count(*) FILTER (age < 18), 2) AS kids FROM person GROUP BY 1) SELECT unit_id, {_U5} < CASE coalesce(kids, 0) WHEN 0 THEN 0.65 WHEN 1 THEN 0.86 ELSE 0.85 END AS claims FROM unit LEFT JOIN k USING (unit_id)")
def tk6_rates_by_children(spark, d):
    m = Micro(spark, d)
    k = m.person.groupBy("unit_id").agg(F.least(F.count(F.when(c("age") < 18, 1)), F.lit(2)).alias("kids"))
    u = J.lookup(m.unit, k, "unit_id", {"kids": 0})
    return u.select("unit_id", (X.lcg_uniform(c("unit_id"), 5) < X.recode(c("kids").cast("int"), {0: 0.65, 1: 0.86, 2: 0.85})).alias("claims"))


_MX = """
WITH col AS (SELECT k * 1000000 + household_id AS col_id, household_id AS record, (district + k * 7) % 25 AS district FROM household, range(2) r(k)), cols AS (SELECT col_id, record, col.district, d.state FROM col JOIN district d USING (district)),
vals AS (SELECT 'agi' AS value_key, household_id AS record, sum(agi) AS val FROM unit GROUP BY 2 UNION ALL SELECT 'units', household_id, count(*) FROM unit WHERE status = 'F' GROUP BY 2),
tg AS (SELECT row_number() OVER (ORDER BY value_key, lv, geographic_id) - 1 AS target_idx, * FROM (SELECT v AS value_key, 0 AS lv, 'national' AS geo_level, 'US' AS geographic_id FROM (SELECT unnest(['agi', 'units']) AS v)
  UNION ALL SELECT v, 1, 'state', CAST(r_regionkey AS VARCHAR) FROM region, (SELECT unnest(['agi', 'units']) AS v) UNION ALL SELECT v, 2, 'district', CAST(n_nationkey AS VARCHAR) FROM nation, (SELECT unnest(['agi', 'units']) AS v))),
x AS (SELECT target_idx, value_key, geo_level, geographic_id, col_id, val FROM cols JOIN tg ON CASE geo_level WHEN 'national' THEN 'US' WHEN 'state' THEN CAST(state AS VARCHAR) ELSE CAST(district AS VARCHAR) END = geographic_id JOIN vals USING (value_key, record) WHERE val <> 0)
"""


def _package(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Columns, targets and matrix of a small package: two clones, two value keys, three levels."""
    cols, t, vals = _package_parts(spark, d)
    return cols, t, MX.build(cols, t.select("target_idx", "value_key", "geo_level", "geographic_id"), vals)


def _package_parts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Columns, targets and values per key and record."""
    m = Micro(spark, d)
    h = m.household.select("household_id", "district")
    # the factor of the clone number is beyond all ids, and 1,000,000 at least, so that ids up to that size stay as they were
    step = h.agg(F.greatest(F.max("household_id") + 1, F.lit(1000000)).alias("step"))
    col = C.clones(h.join(F.broadcast(step), F.lit(True)), 2, "household_id", c("step")).select("col_id", c("household_id").alias("record"), ((c("district") + c("clone") * 7) % 25).alias("district"))
    cols = col.join(m.district.select("district", "state"), "district")
    u = m.unit
    vals = u.groupBy(F.lit("agi").alias("value_key"), c("household_id").alias("record")).agg(X.ordered_sum("agi").alias("val")).unionByName(u.where("status = 'F'").groupBy(F.lit("units").alias("value_key"), c("household_id").alias("record")).agg(N().cast("double").alias("val")))
    keys = F.explode(F.array(F.lit("agi"), F.lit("units"))).alias("value_key")
    t = spark.range(1).select(keys, F.lit(0).alias("lv"), F.lit("national").alias("geo_level"), F.lit("US").alias("geographic_id"))
    t = t.unionByName(m.raw("region").select(keys, F.lit(1).alias("lv"), F.lit("state").alias("geo_level"), c("r_regionkey").cast("string").alias("geographic_id")))
    t = t.unionByName(m.raw("nation").select(keys, F.lit(2).alias("lv"), F.lit("district").alias("geo_level"), c("n_nationkey").cast("string").alias("geographic_id")))
    from pyspark.sql import Window

    t = t.withColumn("target_idx", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("value_key", "lv", "geographic_id")) - 1)  # one row per target
    return cols, t, vals


@book.add(_MX + "SELECT target_idx, col_id, round(val, 2) AS val FROM x")
def mx1_mx2_matrix(spark, d):
    return _package(spark, d)[2].withColumn("val", F.round("val", 2))


@book.add(_MX + "SELECT target_idx, round(sum(val * (1 + col_id % 3)), 2) AS estimate, round(sum(val), 2) AS row_sum, sum(val) > 0 AS achievable FROM x GROUP BY 1")
def mx3_estimates(spark, d):
    cols, _, x = _package(spark, d)
    w = cols.select("col_id", (1 + c("col_id") % 3).cast("double").alias("w"))
    return MX.multiply(x, w).select("target_idx", F.round("estimate", 2).alias("estimate"), F.round("row_sum", 2).alias("row_sum"), (c("row_sum") > 0).alias("achievable"))


@book.add(_MX + ", n AS (SELECT district, count(DISTINCT col_id) AS n FROM cols GROUP BY 1) SELECT col_id, round(CASE WHEN district < 20 THEN (1000 + 10 * district) / n ELSE 100 END, 8) AS w FROM cols JOIN n USING (district)")
def mx4_initial_weights(spark, d):
    cols, _, _ = _package(spark, d)
    people = Micro(spark, d).district.where("district < 20").select("district", (F.lit(1000) + 10 * c("district")).alias("people"))
    return MX.initial_weights(cols, people).select("col_id", F.round("w", 8).alias("w"))


@book.add(_MX + "SELECT (SELECT count(*) FROM tg) AS n_targets, count(*) AS entries, (SELECT count(*) FROM tg) - count(DISTINCT target_idx) AS impossible, round(count(*) / ((SELECT count(*) FROM tg) * (SELECT count(*) FROM cols)), 8) AS density FROM x")
def mx5_package_report(spark, d):
    cols, t, x = _package(spark, d)
    return MX.package_report(x, t, cols.count()).withColumn("density", F.round("density", 8))


@book.add(_MX + ", e AS (SELECT target_idx, sum(val) AS xw FROM x GROUP BY 1), k AS (SELECT value_key, geo_level, geographic_id, sum(val) AS direct FROM x GROUP BY ALL) SELECT value_key, geo_level, geographic_id, round(xw, 2) AS xw, round(direct, 2) AS direct FROM e JOIN tg USING (target_idx) JOIN k USING (value_key, geo_level, geographic_id)")
def mx3_xw_identity(spark, d):
    """X w against a direct aggregate over the cloned rows."""
    cols, t, x = _package(spark, d)
    m = Micro(spark, d)
    xw = MX.multiply(x, cols.select("col_id", F.lit(1.0).alias("w"))).join(t, "target_idx")
    u = m.unit.join(cols.select("col_id", c("record").alias("household_id"), "district", "state"), "household_id")
    direct = u.groupBy("district", "state").agg(F.sum("agi").alias("agi"), F.sum((c("status") == "F").cast("double")).alias("units"))
    long = direct.unpivot(["district", "state"], ["agi", "units"], "value_key", "v")
    place = F.explode(F.array(F.struct(F.lit("national").alias("geo_level"), F.lit("US").alias("geographic_id")), F.struct(F.lit("state").alias("geo_level"), c("state").cast("string").alias("geographic_id")), F.struct(F.lit("district").alias("geo_level"), c("district").cast("string").alias("geographic_id"))))
    dsum = long.select("value_key", "v", place.alias("p")).groupBy("value_key", "p.geo_level", "p.geographic_id").agg(F.sum("v").alias("direct"))
    return xw.join(dsum, ["value_key", "geo_level", "geographic_id"]).select("value_key", "geo_level", "geographic_id", F.round("estimate", 2).alias("xw"), F.round("direct", 2).alias("direct"))


@book.add(_MX + "SELECT target_idx, col_id, round(val, 2) AS val FROM x")
def mx6_chunked_build(spark, d):
    """Built by chunks, stopped after two batches, and resumed: equal to the matrix built at once."""
    cols, t, vals = _package_parts(spark, d)
    t = t.select("target_idx", "value_key", "geo_level", "geographic_id")
    f = scratch(spark, "chunks")
    size = -(-(cols.agg(F.max("col_id")).first()[0] + 1) // 40)
    MX.build_chunks(cols, t, vals, f, size, batch=8, stop_after=2, period=2024)
    x, done = MX.build_chunks(cols, t, vals, f, size, batch=8, resume=True, period=2024)
    if done["found"] != 2:
        raise RuntimeError("the chunks of the first run were not found")
    return x.withColumn("val", F.round("val", 2))
