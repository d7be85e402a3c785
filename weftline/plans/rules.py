"""Predicates, codes, scalar functions (Q and F of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import exprs as X
from weftline.plans.micro import Book, Micro

book = Book()
queries, oracle_sql = (lambda: book.queries), (lambda: book.sql)
c = F.col
N = lambda: F.count(F.lit(1))

RULES = [("age", ">=", "18"), ("flag", "==", "R"), ("earnings", "<", "50000.5")]


@book.add("SELECT unit_id, line, part, supp, age, count(*) AS n FROM person WHERE age >= 18 AND flag = 'R' AND earnings < 50000.5 GROUP BY ALL")
def q1_q2_constraints(spark: SparkSession, d: str) -> DataFrame:
    p = Micro(spark, d).person
    return p.where(X.conjunction(RULES, p.columns)).groupBy("unit_id", "line", "part", "supp", "age").agg(F.count(F.lit(1)).alias("n"))


@book.add("SELECT variable, operation, count(*) AS n_cells, count(*) FILTER (TRY_CAST(value AS DOUBLE) <= 30) AS passing FROM constr WHERE variable = 'age' GROUP BY ALL")
def q1_data_operators(spark, d):
    """Constraints whose operator is data: which cells does the value 30 exceed or equal?"""
    k = Micro(spark, d).constraints.where("variable = 'age'")
    ok = X.holds(F.lit(30.0), F.lit(">="), c("value").try_cast("double"))
    return k.groupBy("variable", "operation").agg(F.count(F.lit(1)).alias("n_cells"), F.sum(ok.cast("long")).alias("passing"))


@book.add("SELECT status, count(*) AS n, round(sum(agi), 2) AS total FROM unit WHERE status IN ('F', 'P') AND agi > 100000 AND priority <> '5-LOW' GROUP BY status")
def q3_word_operators(spark, d):
    u = Micro(spark, d).unit
    return u.where(X.constraint_words(c("status"), "in", "F|P") & X.constraint_words(c("agi"), "greater_than", "100000") & X.constraint_words(c("priority"), "<>", "5-LOW")).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("agi"), 2).alias("total"))


@book.add("""
WITH b AS (SELECT stratum_id, variable, bool_or(operation IN ('==', '!=')) AND count(DISTINCT operation) > 1 AS mixed, bool_or(operation = '>') AND bool_or(operation = '>=') AS two_low, bool_or(operation = '<') AND bool_or(operation = '<=') AS two_high,
  coalesce(max(TRY_CAST(value AS DOUBLE)) FILTER (operation IN ('>', '>=')), '-Infinity'::DOUBLE) AS lo, coalesce(min(TRY_CAST(value AS DOUBLE)) FILTER (operation IN ('<', '<=')), 'Infinity'::DOUBLE) AS hi,
  bool_or(operation = '>=') AS lo_in, bool_or(operation = '<=') AS hi_in FROM constr GROUP BY ALL)
SELECT stratum_id, variable, CASE WHEN mixed THEN 'equality combined' WHEN two_low THEN 'two lower bounds' WHEN two_high THEN 'two upper bounds' WHEN lo > hi OR (lo = hi AND NOT (lo_in AND hi_in)) THEN 'empty range' END AS problem
FROM b WHERE mixed OR two_low OR two_high OR lo > hi OR (lo = hi AND NOT (lo_in AND hi_in))""")
def q4_inconsistent_constraints(spark, d):
    from weftline.operators.validate import inconsistent_constraints

    return inconsistent_constraints(Micro(spark, d).constraints)


@book.add("""SELECT target_id, variable, geo_level FROM (SELECT DISTINCT target_id, variable, geo_level, domain_variable FROM target_overview)
WHERE (variable = 'employment_income' OR (geo_level = 'state' AND domain_variable = 'age') OR variable = 'snap') AND NOT (variable = 'snap' AND geo_level = 'national')""")
def q5_include_exclude(spark, d):
    from weftline.operators.targets import include_exclude

    t = Micro(spark, d).raw("target_overview").select("target_id", "variable", "geo_level", "domain_variable").distinct()
    include = [{"variable": "employment_income"}, {"geo_level": "state", "domain_variable": "age"}, {"variable": "snap"}]
    return include_exclude(t, include, [{"variable": "snap", "geo_level": "national"}]).select("target_id", "variable", "geo_level")


BANDS = [float("-inf"), 10000.0, 50000.0, 100000.0, 250000.0, float("inf")]
LABELS = ["under 10k", "10k-50k", "50k-100k", "100k-250k", "250k+"]


@book.add("""SELECT CASE WHEN agi < 10000 THEN 'under 10k' WHEN agi < 50000 THEN '10k-50k' WHEN agi < 100000 THEN '50k-100k' WHEN agi < 250000 THEN '100k-250k' ELSE '250k+' END AS band,
CAST(least(floor(agi / 100000) * 100000, 400000) AS INT) AS decade, count(*) AS n FROM unit GROUP BY ALL""")
def q6_q7_q8_bands(spark, d):
    return Micro(spark, d).unit.groupBy(X.band(c("agi"), BANDS, LABELS).alias("band"), X.closed_band(c("agi"), 100000, 400000).alias("decade")).agg(F.count(F.lit(1)).alias("n"))


@book.add("SELECT least(n, 3) AS children, count(*) AS units FROM (SELECT unit_id, count(*) AS n FROM person WHERE age < 18 GROUP BY 1) GROUP BY 1")
def q9_child_buckets(spark, d):
    return Micro(spark, d).person.where("age < 18").groupBy("unit_id").agg(F.count(F.lit(1)).alias("n")).groupBy(X.child_bucket(c("n")).alias("children")).agg(F.count(F.lit(1)).alias("units"))


@book.add("""SELECT unit_id, CASE status WHEN 'F' THEN 'filed' WHEN 'O' THEN 'open' ELSE 'other' END AS state_name, CASE WHEN priority = '1-URGENT' THEN 'urgent' WHEN agi > 300000 THEN 'large' WHEN status = 'F' THEN 'closed' ELSE 'plain' END AS reason FROM unit""")
def q10_q11_codes(spark, d):
    rules = [(c("priority") == "1-URGENT", "urgent"), (c("agi") > 300000, "large"), (c("status") == "F", "closed")]
    return Micro(spark, d).unit.select("unit_id", X.recode(c("status"), {"F": "filed", "O": "open"}, "other").alias("state_name"), X.first_matching(rules, "plain").alias("reason"))


@book.add("""SELECT unit_id, line, part, supp, age, earnings * 0.75::DOUBLE AS taxable, earnings * 0.25::DOUBLE AS exempt,
(CASE WHEN flag = 'R' THEN age ELSE 0 END) + (CASE WHEN linestatus = 'R' THEN gross ELSE 0 END) AS coded,
least(earnings, 20000) AS pool1, least(greatest(earnings - least(earnings, 20000), 0), 15000) AS pool2 FROM person""")
def q12_q13_q14_splits(spark, d):
    p = Micro(spark, d).person
    pools = X.waterfall(c("earnings"), [F.lit(20000.0), F.lit(15000.0)])
    return p.select("unit_id", "line", "part", "supp", "age", (c("earnings") * 0.75).alias("taxable"), (c("earnings") * 0.25).alias("exempt"),
                    X.where_code([(c("flag"), c("age")), (c("linestatus"), c("gross"))], "R").alias("coded"), pools[0].alias("pool1"), pools[1].alias("pool2"))


@book.add("""SELECT household_id, greatest(wealth, 0) AS gains, greatest(-wealth, 0) AS losses, (wealth < 0 OR segment = 'BUILDING') AS any_flag, (wealth < 0)::INT + (segment = 'BUILDING')::INT + (weight > 4)::INT > 1 AS multi,
CASE WHEN wealth > 0 THEN least(greatest(1000 / wealth, 0.5), 1.5) ELSE 1 END AS ratio FROM household""")
def q15_q16_q17_flags(spark, d):
    flags = [c("wealth") < 0, c("segment") == "BUILDING", c("weight") > 4]
    return Micro(spark, d).household.select(
        "household_id", X.positive_part(c("wealth")).alias("gains"), X.negative_part(c("wealth")).alias("losses"), (flags[0] | flags[1]).alias("any_flag"),
        (sum(f.cast("int") for f in flags) > 1).alias("multi"), X.guarded_ratio(F.lit(1000.0), c("wealth"), 0.5, 1.5).alias("ratio"))


@book.add("""SELECT event_id, CASE WHEN value >= user_id AND value >= event_id % 100 THEN 'value' WHEN user_id >= event_id % 100 THEN 'user_id' ELSE 'rest' END AS largest,
CAST(18 + floor((((event_id * (1103515245 + 7) + 12345 + 7) % 2147483648) / 2147483648.0) * (65 - 18)) AS INT) AS age FROM events""")
def q18_q19_argmax_draw(spark, d):
    e = Micro(spark, d).raw("events").select("event_id", "value", c("user_id").cast("double").alias("user_id"), (c("event_id") % 100).cast("double").alias("rest"))
    return e.select("event_id", X.largest_of(["value", "user_id", "rest"]).alias("largest"), (F.lit(18) + F.floor(X.lcg_uniform(c("event_id"), 7) * (65 - 18))).cast("int").alias("age"))


@book.add("SELECT household_id, CASE WHEN wealth > 0 THEN wealth * 1.1 ELSE wealth * 0.9 END AS uprated, CASE WHEN wealth < -500 THEN 0 ELSE wealth END AS recoded FROM household")
def q20_q21_conditional_update(spark, d):
    return Micro(spark, d).household.select("household_id", F.when(c("wealth") > 0, c("wealth") * 1.1).otherwise(c("wealth") * 0.9).alias("uprated"), F.when(c("wealth") < -500, 0.0).otherwise(c("wealth")).alias("recoded"))


@book.add("SELECT DISTINCT target_id, variable, geo_level FROM target_overview WHERE NOT (geo_level = 'district' AND lower(variable) LIKE '%income%')")
def q22_drop_groups(spark, d):
    t = Micro(spark, d).raw("target_overview").select("target_id", "variable", "geo_level").distinct()
    groups = t.select("variable", "geo_level").distinct().where((c("geo_level") == "district") & F.lower("variable").contains("income"))
    return t.join(groups, ["variable", "geo_level"], "left_anti").select("target_id", "variable", "geo_level")


@book.add("SELECT household_id, wealth AS wealth_input, segment FROM household")
def q23_rename_before_drop(spark, d):
    return Micro(spark, d).household.withColumnRenamed("wealth", "wealth_input").drop("district", "state", "weight", "wealth")


@book.add("""SELECT unit_id, CASE WHEN agi >= 1000 THEN CAST(CAST(round_even(agi / 1000, 0) AS BIGINT) AS VARCHAR) || 'k' ELSE CAST(CAST(round_even(agi, 0) AS BIGINT) AS VARCHAR) END AS label,
CASE WHEN agi - 100000 <= 0 THEN '-inf' ELSE CASE WHEN agi - 100000 >= 1000 THEN CAST(CAST(round_even((agi - 100000) / 1000, 0) AS BIGINT) AS VARCHAR) || 'k' ELSE CAST(CAST(round_even(agi - 100000, 0) AS BIGINT) AS VARCHAR) END END || '_inf' AS band_label FROM unit""")
def f1_f2_labels(spark, d):
    return Micro(spark, d).unit.select("unit_id", X.amount_label(c("agi")).alias("label"), X.range_label(c("agi") - 100000, F.lit(float("inf"))).alias("band_label"))


@book.add("""
WITH f AS (SELECT stratum_id, string_agg(variable || operation || value, ',' ORDER BY variable || operation || value) AS txt FROM constr WHERE variable NOT IN ('state_fips', 'congressional_district_geoid', 'ucgid_str') GROUP BY 1),
g AS (SELECT stratum_id, coalesce(max(value) FILTER (variable = 'congressional_district_geoid'), max(value) FILTER (variable = 'state_fips'), max(value) FILTER (variable = 'ucgid_str'), 'US') AS geo FROM constr GROUP BY 1)
SELECT target_id, coalesce(geo, 'US') || '/' || variable || '/[' || coalesce(txt, '') || ']' AS name FROM target LEFT JOIN f USING (stratum_id) LEFT JOIN g USING (stratum_id)""")
def f3_target_names(spark, d):
    from weftline.operators.targets import target_names

    m = Micro(spark, d)
    return target_names(m.targets, m.constraints).select("target_id", "name")


@book.add("""
WITH n AS (SELECT DISTINCT geographic_id || '/' || variable || '/[age>=' || period || ',age<' || (period + 5) || ',' || geo_level || '=1]' AS name, geographic_id, variable, period, geo_level FROM target_overview)
SELECT name, geographic_id AS geo, variable, CAST(period AS DOUBLE) AS lower, CAST(period + 5 AS DOUBLE) AS upper, geo_level || '=1' AS rest FROM n""")
def f4_f5_split_names(spark, d):
    t = Micro(spark, d).raw("target_overview").select(F.concat(c("geographic_id"), F.lit("/"), c("variable"), F.lit("/[age>="), c("period").cast("string"), F.lit(",age<"), (c("period") + 5).cast("string"), F.lit(","), c("geo_level"), F.lit("=1]")).alias("name")).distinct()
    geo, var, flt = X.split_label(c("name"))
    lo, hi, rest = X.filter_bounds(flt, "age")
    return t.select("name", geo.alias("geo"), var.alias("variable"), lo.alias("lower"), hi.alias("upper"), rest.alias("rest"))


@book.add("""SELECT DISTINCT geo_level, geographic_id, CASE geo_level WHEN 'national' THEN '0100000US' WHEN 'state' THEN '0400000US' || lpad(geographic_id, 2, '0') ELSE '5001800US' || lpad(geographic_id, 4, '0') END AS ucgid,
CASE geo_level WHEN 'state' THEN CAST(geographic_id AS INT) WHEN 'district' THEN CAST(geographic_id AS INT) // 100 END AS state,
CASE WHEN geo_level = 'district' THEN CASE WHEN CAST(geographic_id AS INT) % 100 IN (0, 98) THEN CAST(geographic_id AS INT) // 100 * 100 + 1 ELSE CAST(geographic_id AS INT) END END AS district,
CASE WHEN geographic_id = 'US' THEN 0 WHEN TRY_CAST(geographic_id AS INT) < 100 THEN 1 WHEN TRY_CAST(geographic_id AS INT) IS NULL THEN 3 ELSE 2 END AS geo_rank FROM target_overview WHERE geographic_id = 'US' OR TRY_CAST(geographic_id AS INT) IS NOT NULL""")
def f6_ucgid(spark, d):
    t = Micro(spark, d).raw("target_overview").select("geo_level", "geographic_id").distinct().where((c("geographic_id") == "US") | c("geographic_id").try_cast("int").isNotNull())
    t = t.withColumn("ucgid", X.ucgid_of(c("geo_level"), c("geographic_id")))
    _, state, district = X.ucgid_parts(c("ucgid"))
    return t.select("geo_level", "geographic_id", "ucgid", state.alias("state"), district.alias("district"), X.geo_rank(c("geographic_id")).alias("geo_rank"))


@book.add("SELECT block_geoid, left(block_geoid, 2) AS state, left(block_geoid, 5) AS county, left(block_geoid, 11) AS tract, 'S' || left(block_geoid, 2) || '-' || lpad(CAST(cd_geoid % 100 AS VARCHAR), 2, '0') AS district_name FROM block_distribution")
def f7_f8_geo_keys(spark, d):
    s, k, t = X.block_parts(c("block_geoid"))
    return Micro(spark, d).raw("block_distribution").select("block_geoid", s.alias("state"), k.alias("county"), t.alias("tract"), F.concat(F.lit("S"), s, F.lit("-"), F.lpad((c("cd_geoid") % 100).cast("string"), 2, "0")).alias("district_name"))


@book.add("SELECT p_partkey, p_size AS lo, CASE WHEN p_size < 45 THEN p_size + 4 END AS hi FROM part")
def f9_age_ranges(spark, d):
    text = F.when(c("p_size") < 45, F.concat_ws("-", c("p_size").cast("string"), (c("p_size") + 4).cast("string"))).otherwise(F.concat(c("p_size").cast("string"), F.lit("+")))
    lo, hi = X.age_bounds(text)
    return Micro(spark, d).raw("part").select("p_partkey", lo.alias("lo"), hi.alias("hi"))


@book.add("""
WITH h AS (SELECT p_partkey, list_reduce(list_transform(string_split(p_name, ''), lambda ch: ord(ch)::HUGEINT), lambda x, b: (x * 31 + b) % 18446744073709551616::HUGEINT, 0::HUGEINT)::UBIGINT AS a FROM part),
m AS (SELECT p_partkey, ((xor(a, a >> 33)::UHUGEINT * 18397679294719823053::UHUGEINT) % 18446744073709551616::UHUGEINT)::UBIGINT AS b FROM h) SELECT p_partkey, CAST(xor(b, b >> 33) AS VARCHAR) AS h FROM m""")
def f10_string_hash(spark, d):
    return Micro(spark, d).raw("part").select("p_partkey", X.string_hash("p_name").alias("h"))


@book.add("SELECT o_orderkey, ((o_orderkey * (1103515245 + 17) + 12345 + 17) % 2147483648) / 2147483648.0 AS u FROM orders")
def f11_lcg_uniform(spark, d):
    return Micro(spark, d).raw("orders").select("o_orderkey", X.lcg_uniform(c("o_orderkey"), 17).alias("u"))


@book.add("SELECT count(*) AS n, count(*) AS different, true AS inside, true AS even FROM household")
def f12_hash_uniform(spark, d):
    """The draws of all households: different, in [0, 1), and their mean within five standard errors of a half."""
    u = Micro(spark, d).household.select(X.hash_uniform("household_id", "segment").alias("u"))
    return u.agg(N().alias("n"), F.count_distinct("u").alias("different"), F.min((c("u") >= 0) & (c("u") < 1)).alias("inside"), (F.abs(F.avg("u") - 0.5) < 5 / F.sqrt(12.0 * N())).alias("even"))


@book.add("""
WITH x AS (SELECT household_id, wealth, CASE WHEN wealth < 0 THEN '-' ELSE '' END AS s, abs(wealth) AS a FROM household)
SELECT household_id, s || '$' || CASE WHEN a >= 1000 THEN printf('%.1f', round(a / 1000.0, 1)) || 'K' ELSE printf('%.0f', round(a, 0)) END AS money, printf('%.2f', wealth / 7777.0 * 100) || '%' AS share, repeat('#', CAST(round_even(least(a / 10000.0, 1) * 28, 0) AS INT)) || repeat('.', 28 - CAST(round_even(least(a / 10000.0, 1) * 28, 0) AS INT)) AS bar FROM x""")
def f22_report_texts(spark, d):
    w = c("wealth")
    return Micro(spark, d).household.select("household_id", X.money_text(w).alias("money"), X.percent_text(w / 7777.0).alias("share"), X.bar_text(w, F.lit(10000.0)).alias("bar"))


@book.add("""SELECT l.stratum_id, sha256(coalesce(CAST(parent_stratum_id AS VARCHAR), '') || coalesce(chr(10) || string_agg(variable || '|' || operation || '|' || value, chr(10) ORDER BY variable || '|' || operation || '|' || value), '')) AS hash
FROM living l LEFT JOIN constr USING (stratum_id) GROUP BY l.stratum_id, parent_stratum_id""")
def f13_definition_hash(spark, d):
    from weftline.operators.targets import definition_hashes

    m = Micro(spark, d)
    return definition_hashes(m.strata, m.constraints)


@book.add("SELECT household_id, round(asinh(wealth), 5) AS a, round(ln(1 + greatest(wealth, 0)), 5) AS l, sign(wealth)::DOUBLE AS s, round_even(wealth, 0) AS r FROM household")
def f14_math(spark, d):
    w = c("wealth")
    return Micro(spark, d).household.select("household_id", F.round(F.asinh(w), 5).alias("a"), F.round(F.log1p(F.greatest(w, F.lit(0.0))), 5).alias("l"), F.signum(w).alias("s"), F.rint(w).alias("r"))


@book.add("""
WITH e AS (SELECT target_id, value AS t, value * (1 + ((target_id % 41) - 20) / 100.0) AS e FROM target WHERE value IS NOT NULL AND NOT isnan(value))
SELECT target_id, round(CASE WHEN t <> 0 THEN (e - t) / abs(t) ELSE 0 END, 8) AS rel, round(((e - t + 1) / (t + 1)) * ((e - t + 1) / (t + 1)), 8) AS sq,
CASE WHEN abs(((target_id % 41) - 20)) < 1 THEN 'ok' WHEN abs(((target_id % 41) - 20)) < 5 THEN 'flag' WHEN abs(((target_id % 41) - 20)) < 15 THEN 'significant' ELSE 'critical' END AS severity FROM e""")
def f15_f16_errors(spark, d):
    t = Micro(spark, d).targets.where(c("value").isNotNull() & ~F.isnan("value")).select("target_id", c("value").alias("t"), (c("value") * (1 + ((c("target_id") % 41) - 20) / 100.0)).alias("e"))
    return t.select("target_id", F.round(X.relative_error(c("e"), c("t")), 8).alias("rel"), F.round(X.smoothed_square_error(c("e"), c("t")), 8).alias("sq"), X.severity(((c("target_id") % 41) - 20).cast("double")).alias("severity"))


@book.add("SELECT unit_id, CASE WHEN period < 1996 THEN 0.05 WHEN period < 1999 THEN 0.06 ELSE 0.07 END AS rate FROM unit")
def f17_rate_by_year(spark, d):
    rate = F.when(c("period") < 1996, F.lit(0.05)).when(c("period") < 1999, F.lit(0.06)).otherwise(F.lit(0.07))
    return Micro(spark, d).unit.select("unit_id", rate.alias("rate"))


@book.add("""
WITH n AS (SELECT unit_id, count(*) FILTER (age >= 18) AS adults, count(*) FILTER (age < 18) AS kids FROM person GROUP BY 1)
SELECT unit_id, round(CASE WHEN status = 'F' THEN 18000.0 ELSE 21000.0 END * pow(adults + 0.7 * kids, 0.7) / pow(3.4, 0.7), 4) AS threshold FROM n JOIN unit USING (unit_id)""")
def f18_threshold(spark, d):
    m = Micro(spark, d)
    n = m.person.groupBy("unit_id").agg(F.count(F.when(c("age") >= 18, 1)).alias("adults"), F.count(F.when(c("age") < 18, 1)).alias("kids"))
    base = F.when(c("status") == "F", 18000.0).otherwise(21000.0)
    return n.join(m.unit, "unit_id").select("unit_id", F.round(base * F.pow(c("adults") + 0.7 * c("kids"), F.lit(0.7)) / F.pow(F.lit(3.4), F.lit(0.7)), 4).alias("threshold"))


@book.add("""
WITH s AS (SELECT household_id, max(age) AS oldest, sum(CASE WHEN age < 18 THEN 1 ELSE 0 END) AS kids, sum(earnings) AS e FROM person GROUP BY 1)
SELECT household_id, CASE WHEN oldest >= 49 AND kids = 0 THEN 'older' WHEN kids >= 3 AND e > 1000000 THEN 'large working' WHEN kids > 0 THEN 'family' ELSE 'other' END AS archetype FROM s""")
def f19_f20_archetypes(spark, d):
    s = Micro(spark, d).person.groupBy("household_id").agg(F.max("age").alias("oldest"), F.count(F.when(c("age") < 18, 1)).alias("kids"), F.sum("earnings").alias("e"))
    rules = [((c("oldest") >= 49) & (c("kids") == 0), "older"), ((c("kids") >= 3) & (c("e") > 1000000), "large working"), (c("kids") > 0, "family")]
    return s.select("household_id", X.first_matching(rules, "other").alias("archetype"))


@book.add("SELECT p_partkey, CASE split_part(p_type, ' ', 1) WHEN 'ECONOMY' THEN 1 WHEN 'PROMO' THEN 2 WHEN 'STANDARD' THEN 3 ELSE 0 END AS code, p_brand IN ('Brand#11', 'Brand#22') AS listed FROM part")
def f21_code_map(spark, d):
    return Micro(spark, d).raw("part").select("p_partkey", X.recode(F.split("p_type", " ")[0], {"ECONOMY": 1, "PROMO": 2, "STANDARD": 3}, 0).alias("code"), c("p_brand").isin("Brand#11", "Brand#22").alias("listed"))


@book.add("SELECT o_orderkey, sha256(CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus || '|' || o_orderpriority) AS fingerprint FROM orders")
def f23_fingerprint(spark, d):
    return Micro(spark, d).raw("orders").select("o_orderkey", F.sha2(F.concat_ws("|", c("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority"), 256).alias("fingerprint"))
