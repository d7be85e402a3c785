"""The queries p1_ to p5_ (reference checks, reshaping, drift, skew, filling) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import drift, fill, orphans, skew, wide
from weftline.session import table


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    cons, over = table(spark, d, "stratum_constraints"), table(spark, d, "target_overview")
    refs = (
        orphans.references(cons, "stratum_constraints", "stratum_id", "constraint_id", F.year("loaded_at"), parent="strata")
        .unionByName(orphans.references(over, "target_overview", "stratum_id", "target_id", F.col("period"), parent="strata"))
        .unionByName(orphans.references(over, "target_overview", "target_id", "target_id", F.col("period"), parent="targets"))
    )
    parents = orphans.parent_rows(table(spark, d, "strata"), "stratum_id", parent="strata").unionByName(orphans.parent_rows(table(spark, d, "targets"), "target_id", parent="targets"))
    return orphans.find_in(refs, parents)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("table_name", "ref_field", "row_id", "orphan_kind").distinct()


def p1_orphan_counts(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_counts(_orphans(spark, d))


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return wide.resolve_cells(table(spark, d, "stratum_constraints"), "stratum_id", "constraint_variable", "operation", "value", "constraint_id", "loaded_at")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return wide.unclean_cells(_cells(spark, d)).select(F.col("entity_id").alias("stratum_id"), F.col("variable").alias("constraint_variable"), "operation")


def p2_wide(spark: SparkSession, d: str) -> DataFrame:
    w = wide.widen(_cells(spark, d)).withColumnRenamed("entity_id", "stratum_id").drop("other_values")
    return w.withColumn("unfilled", F.array_join(F.transform(F.map_entries("unfilled"), lambda e: F.concat_ws("=", e["key"], e["value"])), ";"))


def _files(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, d, "aca_ptc_lines")
    parsed = drift.read_lines(lines)
    return parsed, drift.file_fields(lines, parsed)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.schema_changes(_files(spark, d)[1]).select("file_id", "field_name", "change_kind")


def p3_table(spark: SparkSession, d: str) -> DataFrame:
    return drift.conform(*_files(spark, d))


def p3_versions(spark: SparkSession, d: str) -> DataFrame:
    return drift.schema_versions(_files(spark, d)[1])


def p3_steps(spark: SparkSession, d: str) -> DataFrame:
    """The migration steps between the versions of each feed."""
    return drift.migration_steps(drift.versioned(_files(spark, d)[1]))


def _areas(spark: SparkSession, d: str) -> tuple[DataFrame, dict]:
    g = skew.with_district(table(spark, d, "geography_assignment"), "cd_geoid", "district")
    return g, {"cd_geoid": F.col("district"), "state_fips": F.col("state_fips")}


def _keyed(spark: SparkSession, d: str) -> DataFrame:
    return skew.keyed(*_areas(spark, d), F.col("household_weight"))


#: Share of all rows from which a key is heavy.
HEAVY = {"cd_geoid": 0.02, "state_fips": 0.05}


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return skew.heavy_keys(_keyed(spark, d), HEAVY).select("key_field", "key_value")


def p4_key_totals(spark: SparkSession, d: str) -> DataFrame:
    totals = skew.value_bounds(_keyed(spark, d)).where(F.col("key_value").isNotNull())
    records = skew.distinct_records(*_areas(spark, d), F.col("record_idx"))
    return totals.join(records, ["key_field", "key_value"], "left").select("key_field", "key_value", "n_rows", F.coalesce("n_records", F.lit(0)).alias("n_records"), F.round("total", 2).alias("total_weight"))


def p4_key_quantiles(spark: SparkSession, d: str) -> DataFrame:
    return skew.quantiles(_keyed(spark, d), [0.25, 0.5, 0.75])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return fill.filled_cells(fill.fill_records(table(spark, d, "forbes_top_tail"))).select("record_id", "field_name").distinct()


def p5_filled(spark: SparkSession, d: str) -> DataFrame:
    return fill.fill_records(table(spark, d, "forbes_top_tail"))


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_orphan_counts, p2_found, p2_wide, p3_found, p3_table, p3_versions, p3_steps, p4_found, p4_key_totals, p4_key_quantiles, p5_found, p5_filled)}


# ---- SQL ----

_P1 = """
WITH refs AS (
  SELECT 'stratum_constraints' AS table_name, 'stratum_id' AS ref_field, constraint_id AS row_id, stratum_id AS k, loaded_at AS t, CAST(year(loaded_at) AS INT) AS period, 's' AS p FROM stratum_constraints WHERE stratum_id IS NOT NULL
  UNION ALL SELECT 'target_overview', 'stratum_id', target_id, stratum_id, loaded_at, period, 's' FROM target_overview WHERE stratum_id IS NOT NULL
  UNION ALL SELECT 'target_overview', 'target_id', target_id, target_id, loaded_at, period, 't' FROM target_overview WHERE target_id IS NOT NULL),
parents AS (
  SELECT 's' AS p, stratum_id AS k, min(loaded_at) AS t, bool_and(deleted_at IS NOT NULL) AS dead FROM strata GROUP BY 2
  UNION ALL SELECT 't', target_id, min(loaded_at), bool_and(deleted_at IS NOT NULL) FROM targets GROUP BY 2),
found AS (
  SELECT table_name, ref_field, row_id, period, CASE WHEN q.k IS NULL THEN 'missing' WHEN q.dead THEN 'deleted' WHEN q.t > r.t THEN 'late' END AS orphan_kind
  FROM refs r LEFT JOIN parents q ON q.p = r.p AND q.k = r.k)
"""

_INT, _TXT, _BOOL = (", ".join(f"'{v}'" for v in names) for names in (wide.INTEGERS, wide.TEXTS, wide.BOOLEANS))
_P2 = f"""
WITH raw AS (
  SELECT stratum_id, lower(trim(constraint_variable, ' ' || chr(9) || chr(10) || chr(13))) AS v, CASE trim(operation) WHEN '=' THEN '==' ELSE trim(operation) END AS o,
    value, trim(value, ' ' || chr(9) || chr(10) || chr(13)) AS t, lower(trim(value, ' ' || chr(9) || chr(10) || chr(13))) AS l, constraint_id, loaded_at
  FROM stratum_constraints WHERE stratum_id > 0),
num AS (
  SELECT *, CASE WHEN regexp_matches(l, '^[+-]?(inf|infinity)$') THEN CASE WHEN l LIKE '-%' THEN '-Infinity'::DOUBLE ELSE 'Infinity'::DOUBLE END
    WHEN regexp_matches(l, '^[+-]?[$]?([0-9]{{1,3}}(,[0-9]{{3}})+|[0-9]+)([.][0-9]*)?(e[+-]?[0-9]+)?$') THEN TRY_CAST(replace(replace(l, '$', ''), ',', '') AS DOUBLE) END AS n
  FROM raw),
canon AS (
  SELECT *, CASE WHEN v IN ({_INT}) THEN CASE WHEN NOT isinf(n) AND n = floor(n) THEN CAST(CAST(n AS BIGINT) AS VARCHAR) END
    WHEN v IN ({_TXT}) THEN nullif(t, '')
    WHEN v IN ({_BOOL}) THEN CASE WHEN l IN ('1', 'true', 'yes', '1.0') THEN 'true' WHEN l IN ('0', 'false', 'no', '0.0') THEN 'false' END
    ELSE CASE WHEN abs(n) < 1e15 AND n = floor(n) THEN CAST(CAST(n AS BIGINT) AS VARCHAR) ELSE CAST(n + 0.0 AS VARCHAR) END END AS c
  FROM num),
cells AS (
  SELECT stratum_id, v, o, arg_max(c, (loaded_at, constraint_id, c)) FILTER (c IS NOT NULL) AS resolved, count(DISTINCT c) AS n_values, bool_or(c IS NULL) AS has_bad,
    arg_max(coalesce(value, ''), (loaded_at, constraint_id, coalesce(value, ''))) FILTER (c IS NULL) AS bad
  FROM canon GROUP BY ALL)
"""
_CAST = {"bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "string": "VARCHAR"}
_P2_COLS = ",\n  ".join(f"CAST(max(resolved) FILTER (v = '{v}' AND o = '{o}') AS {_CAST[t]}) AS {wide.column_name(v, o)}" for v, t in wide.TYPES.items() for o in wide.OPERATORS)

_GEO = """
WITH n AS (SELECT *, TRY_CAST(trim(cd_geoid) AS DOUBLE)::BIGINT AS d FROM geography_assignment),
k AS (
  SELECT 'cd_geoid' AS key_field, CAST(CASE WHEN d = 1198 THEN 1101 WHEN d % 100 = 0 THEN d + 1 ELSE d END AS VARCHAR) AS key_value, household_weight AS w, record_idx FROM n
  UNION ALL SELECT 'state_fips', CAST(state_fips AS VARCHAR), household_weight, record_idx FROM n)
"""

_P5 = """
WITH base AS (
  SELECT record_id, snapshot_date, TRY_CAST(left(snapshot_date, 4) AS INT) AS year, nullif(regexp_replace(lower(trim(alias)), '[^a-z0-9]+', '-', 'g'), '') AS person,
    list_sort(list_distinct(list_filter(list_transform(string_split(lower(coalesce(industry, '')), '|'), lambda x: trim(x)), lambda x: x <> ''))) AS inds,
    CASE WHEN age BETWEEN 1 AND 120 AND NOT isnan(age) THEN age END AS age,
    CASE WHEN TRY_CAST(trim(children) AS DOUBLE) BETWEEN 0 AND 30 THEN TRY_CAST(trim(children) AS DOUBLE)::INT END AS children,
    CASE lower(trim(marital_status)) WHEN 'married' THEN 'Married' WHEN 'single' THEN 'Single' WHEN 'divorced' THEN 'Divorced' WHEN 'separated' THEN 'Separated' WHEN 'widowed' THEN 'Widowed'
      WHEN 'widowed, remarried' THEN 'Widowed, Remarried' WHEN 'engaged' THEN 'Engaged' WHEN 'in relationship' THEN 'In Relationship' END AS marital_status
  FROM forbes_top_tail),
grp AS (
  SELECT *, CASE WHEN len(inds) > 0 THEN array_to_string(inds, '|') || '@' || year END AS iy, CASE WHEN len(inds) > 0 THEN array_to_string(inds, '|') END AS ind, CAST(year AS VARCHAR) AS sn FROM base),
d AS (SELECT DISTINCT * FROM grp),
cell AS (SELECT person, iy, inds, sn, unnest(['age', 'born', 'children', 'marital_status']) AS field, unnest([CAST(age::INT AS VARCHAR), CAST(year - age::INT AS VARCHAR), CAST(children AS VARCHAR), marital_status]) AS v FROM d),
c AS (
  SELECT level, g, field, v, count(*) AS n FROM (
    SELECT unnest(['person', 'industry_year', 'snapshot', 'all']) AS level, unnest([person, iy, sn, '*']) AS g, field, v FROM cell
    UNION ALL SELECT 'industry', q.ind, field, v FROM (SELECT DISTINCT ind, unnest(inds) AS one FROM grp) q JOIN (SELECT unnest(inds) AS one, field, v FROM cell) USING (one))
  WHERE g IS NOT NULL AND v IS NOT NULL AND CASE field WHEN 'born' THEN level = 'person' WHEN 'age' THEN level <> 'person' ELSE true END GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY level, g, field ORDER BY TRY_CAST(v AS INT), v) AS upto, sum(n) OVER (PARTITION BY level, g, field) AS support FROM c),
s AS (
  SELECT level, g, CASE field WHEN 'born' THEN 'age' ELSE field END AS field,
    CASE WHEN field = 'marital_status' THEN arg_min(v, (-n, v)) ELSE CAST(min(TRY_CAST(v AS INT)) FILTER (upto * 2 >= support) AS VARCHAR) END AS stat
  FROM r GROUP BY level, g, field, support HAVING support >= CASE level WHEN 'person' THEN 1 WHEN 'all' THEN 1 ELSE 5 END)
"""


_P3 = """
WITH l AS (SELECT file_id, line_no, max(feed_id) AS feed_id, max(published_at) AS published_at, arg_max(line_text, (loaded_at, line_text)) AS t FROM aca_ptc_lines
  WHERE trim(line_text) <> '' AND NOT starts_with(ltrim(line_text), '#') GROUP BY ALL),
c AS (SELECT file_id, line_no, feed_id, published_at, list_transform(regexp_extract_all(',' || t, ',([ ]*"(?:[^"]|"")*"[^,]*|[^,]*)', 1), lambda x: replace(regexp_replace(trim(x), '^"(.*)"$', '\\1'), '""', '"')) AS cells FROM l),
hd AS (SELECT file_id, min(line_no) AS header_line FROM c GROUP BY 1),
h AS (SELECT file_id, feed_id, published_at, header_line, unnest(cells) AS header, generate_subscripts(cells, 1) AS pos FROM c JOIN hd USING (file_id) WHERE line_no = header_line),
k AS (SELECT *, lower(trim(header)) AS low, regexp_replace(lower(trim(header)), '[^a-z0-9]', '', 'g') AS w FROM h WHERE trim(header) <> ''),
y AS (SELECT *, regexp_replace(regexp_replace(w, '^(20)?[0-9][0-9]([a-z])', '\\2'), '([a-z])(20)?[0-9][0-9]$', '\\1') AS stem, '20' || coalesce(nullif(regexp_extract(w, '([0-9][0-9])$', 1), ''), regexp_extract(w, '^(20)?([0-9][0-9])[a-z]', 2)) AS yr FROM k),
n AS (SELECT *, CASE WHEN w IN ('state', 'st', 'statename', 'statecode', 'stateabbr', 'stateabbreviation', 'statefips', 'fips') THEN 'state' WHEN regexp_matches(w, '^(vol|volume)(mult|multiplier|ratio)$') THEN 'vol_mult' WHEN regexp_matches(w, '^(val|value)(mult|multiplier|ratio)$') THEN 'val_mult'
  WHEN regexp_matches(stem, '^(@COUNT)$') AND yr IN ('2022', '2024', '2025') THEN 'enroll_' || yr WHEN regexp_matches(stem, '^(@CREDIT)$') AND yr IN ('2022', '2024', '2025') THEN 'aptc_' || yr ELSE low END AS name FROM y)
""".replace("@COUNT", drift.COUNT_WORDS).replace("@CREDIT", drift.CREDIT_WORDS)

_P3_FOUND = _P3 + """, u AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY file_id, name ORDER BY pos) = 1),
v AS (SELECT c.file_id, u.name, trim(coalesce(c.cells[u.pos], '')) AS x FROM u JOIN c ON c.file_id = u.file_id AND c.line_no > u.header_line),
ty AS (SELECT file_id, name, CASE WHEN bool_and(x = '' OR regexp_matches(x, '^[0-9]+$')) THEN 'integer' WHEN bool_and(x = '' OR regexp_matches(x, '^([0-9]+[.]?[0-9]*|[.][0-9]+)$')) THEN 'decimal' ELSE 'text' END AS type FROM v GROUP BY ALL),
f AS (SELECT u.file_id, u.name, trim(u.header) AS header, coalesce(type, 'integer') AS type FROM u LEFT JOIN ty USING (file_id, name)),
o AS (SELECT file_id, lag(file_id) OVER (PARTITION BY feed_id ORDER BY published_at, file_id) AS prev FROM (SELECT DISTINCT file_id, feed_id, published_at FROM n)),
b AS (SELECT o.file_id, coalesce(x.name, z.name) AS field_name, x.header AS h1, x.type AS t1, z.header AS h0, z.type AS t0 FROM (SELECT o.file_id, o.prev, f.name FROM o JOIN f ON f.file_id IN (o.file_id, o.prev) WHERE o.prev IS NOT NULL GROUP BY ALL) o
  LEFT JOIN f x ON x.file_id = o.file_id AND x.name = o.name LEFT JOIN f z ON z.file_id = o.prev AND z.name = o.name)
SELECT file_id, field_name, 'added' AS change_kind FROM b WHERE h0 IS NULL UNION ALL SELECT file_id, field_name, 'removed' FROM b WHERE h1 IS NULL
UNION ALL SELECT file_id, field_name, 'renamed' FROM b WHERE h1 <> h0 UNION ALL SELECT file_id, field_name, 'retyped' FROM b WHERE t1 <> t0"""


_P3_VERSIONS = _P3 + """, ty AS (SELECT n.file_id, n.pos, bool_and(x = '' OR regexp_matches(x, '^[0-9]+$')) AS whole, bool_and(x = '' OR regexp_matches(x, '^([0-9]+[.]?[0-9]*|[.][0-9]+)$')) AS dec
  FROM n JOIN (SELECT file_id, line_no, unnest(list_transform(cells, lambda z: trim(z))) AS x, generate_subscripts(cells, 1) AS pos FROM c) v ON v.file_id = n.file_id AND v.pos = n.pos AND v.line_no > n.header_line GROUP BY ALL),
fp AS (SELECT file_id, feed_id, published_at, count(*) AS n_fields, sha256(string_agg(trim(header) || chr(9) || name || chr(9) || CASE WHEN coalesce(whole, true) THEN 'integer' WHEN dec THEN 'decimal' ELSE 'text' END, chr(10) ORDER BY pos)) AS fingerprint
  FROM n LEFT JOIN ty USING (file_id, pos) GROUP BY ALL),
ch AS (SELECT *, coalesce(fingerprint <> lag(fingerprint) OVER w, true) AS new_version FROM fp WINDOW w AS (PARTITION BY feed_id ORDER BY published_at, file_id))
SELECT feed_id, file_id, published_at, n_fields, fingerprint, CAST(sum(new_version::INT) OVER (PARTITION BY feed_id ORDER BY published_at, file_id) AS BIGINT) AS version, new_version FROM ch"""


def _p3_table() -> str:
    def raw(n: str) -> str:
        return f"max(x) FILTER (name = '{n}' AND x <> '') AS raw_{n}"

    def num(n: str) -> str:
        t = f"regexp_replace(raw_{n}, '[$, ]', '', 'g')"
        return f"CASE WHEN {t} LIKE '%\\%' ESCAPE '\\' THEN TRY_CAST(rtrim({t}, '%') AS DOUBLE) / 100 ELSE TRY_CAST({t} AS DOUBLE) END"

    def typed(n: str, t: str) -> str:
        if n == "state":
            codes = ", ".join(f"('{k}', '{v}')" for k, v in drift.state_codes().items())
            return f"coalesce((SELECT code FROM (VALUES {codes}) s(k, code) WHERE k = lower(raw_state)), raw_state) AS state"
        return f"CASE WHEN {num(n)} = floor({num(n)}) THEN CAST({num(n)} AS BIGINT) END AS {n}" if t == "bigint" else f"{num(n)} AS {n}"

    fields = ", ".join(f"'{n}'" for n in drift.FIELDS)
    fails = " || ".join(f"CASE WHEN raw_{n} IS NOT NULL AND {n} IS NULL THEN ';{n}=' || raw_{n} ELSE '' END" for n in sorted(drift.FIELDS))
    return _P3 + f""", d AS (SELECT c.feed_id, c.file_id, c.published_at, c.line_no, n.name, trim(coalesce(c.cells[n.pos], '')) AS x, coalesce(c.cells[n.pos], '') AS cell FROM n JOIN c ON c.file_id = n.file_id AND c.line_no > n.header_line),
g AS (SELECT feed_id, file_id, published_at, line_no, {', '.join(raw(n) for n in drift.FIELDS)}, coalesce(string_agg(name || '=' || cell, ';' ORDER BY name || '=' || cell) FILTER (name NOT IN ({fields})), '') AS extras FROM d GROUP BY ALL),
t AS (SELECT *, {', '.join(typed(n, t) for n, t in drift.FIELDS.items())} FROM g)
SELECT feed_id, file_id, published_at, line_no, {', '.join(drift.FIELDS)}, extras, ltrim({fails}, ';') AS cast_failures FROM t"""


def _p5_sql() -> str:
    levels = {"person": "person", "industry_year": "iy", "industry": "ind", "snapshot": "sn", "all": "'*'"}
    joins, sel = [], []
    for f, t in (("age", "DOUBLE"), ("children", "INT"), ("marital_status", "VARCHAR")):
        pick, tag = [], []
        for n, g in levels.items():
            a = f"{f}_{n}"
            joins.append(f"LEFT JOIN s {a} ON {a}.level = '{n}' AND {a}.field = '{f}' AND {a}.g = grp.{g}" if g != "'*'" else f"LEFT JOIN s {a} ON {a}.level = 'all' AND {a}.field = '{f}'")
            v = f"CASE WHEN grp.year - CAST({a}.stat AS INT) BETWEEN 1 AND 120 THEN CAST(grp.year - CAST({a}.stat AS INT) AS VARCHAR) END" if (f, n) == ("age", "person") else f"{a}.stat"
            pick.append(v)
            tag.append(f"WHEN {v} IS NOT NULL THEN '{n}'")
        sel.append(f"coalesce(grp.{f}, CAST(coalesce({', '.join(pick)}) AS {t})) AS {f}")
        sel.append(f"CASE WHEN grp.{f} IS NULL THEN CASE {' '.join(tag)} ELSE 'none' END END AS {f}_level")
    return _P5 + "SELECT record_id, snapshot_date, " + ", ".join(sel) + " FROM grp " + " ".join(joins)


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _P1 + "SELECT DISTINCT table_name, ref_field, row_id, orphan_kind FROM found WHERE orphan_kind IS NOT NULL",
        "p1_orphan_counts": _P1 + "SELECT table_name, ref_field, period, orphan_kind, count(DISTINCT row_id) AS orphan_rows FROM found WHERE orphan_kind IS NOT NULL GROUP BY ALL",
        "p2_found": _P2 + "SELECT stratum_id, v AS constraint_variable, o AS operation FROM cells WHERE has_bad OR n_values > 1",
        "p2_wide": _P2 + f"SELECT stratum_id, {_P2_COLS},\n  coalesce(string_agg(v || '|' || o || '=' || CASE WHEN has_bad THEN bad ELSE 'conflict' END, ';' ORDER BY v || '|' || o) FILTER (has_bad OR n_values > 1), '') AS unfilled FROM cells GROUP BY stratum_id",
        "p3_found": _P3_FOUND,
        "p3_table": _p3_table(),
        "p3_versions": _P3_VERSIONS,
        "p4_found": _GEO + "SELECT key_field, key_value FROM k, (SELECT count(*) AS t FROM geography_assignment) WHERE key_value IS NOT NULL GROUP BY key_field, key_value, t HAVING count(*) >= t * CASE key_field WHEN 'cd_geoid' THEN 0.02 ELSE 0.05 END",
        "p4_key_totals": _GEO + "SELECT key_field, key_value, count(*) AS n_rows, count(DISTINCT record_idx) AS n_records, round(sum(w) FILTER (NOT isnan(w)), 2) AS total_weight FROM k WHERE key_value IS NOT NULL GROUP BY ALL",
        "p4_key_quantiles": _GEO + ", qs AS (SELECT unnest([0.25, 0.5, 0.75])::DOUBLE AS q), r AS (SELECT key_field, key_value, w, row_number() OVER (PARTITION BY key_field, key_value ORDER BY w) AS i, count(w) OVER (PARTITION BY key_field, key_value) AS n FROM k WHERE key_value IS NOT NULL AND w IS NOT NULL AND NOT isnan(w))"
        " SELECT key_field, key_value, q, w AS quantile FROM r, qs WHERE i = ceil(q * n)",
        "p5_found": _P5 + "SELECT record_id, 'age' AS field_name FROM base WHERE age IS NULL UNION SELECT record_id, 'children' FROM base WHERE children IS NULL UNION SELECT record_id, 'marital_status' FROM base WHERE marital_status IS NULL",
        "p5_filled": _p5_sql(),
    }
