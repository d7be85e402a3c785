"""The micro-data that the queries use: households, filing units and persons from the star schema, and the clean target tables.

nation and region stand for district and state; customer for household; orders for filing unit; lineitem for person.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import exprs as X
from weftline.operators import wide
from weftline.session import table


class Book:
    """Queries with their SQL, registered by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable:
        def put(f: Callable) -> Callable:
            self.queries[f.__name__] = f
            if sql is not None:
                text = sql.strip()
                if text.upper().startswith("WITH RECURSIVE"):
                    text = BASE.replace("WITH district", "WITH RECURSIVE district", 1) + "," + text[14:]
                else:
                    text = BASE + ("," + text[4:] if text.upper().startswith("WITH") else text)
                self.sql[f.__name__] = text
            return f

        return put


class Micro:
    """Lazily built tables of one data folder."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.d, name)

    @property
    def district(self) -> DataFrame:
        return self.raw("nation").select(F.col("n_nationkey").alias("district"), F.col("n_regionkey").alias("state"), F.col("n_name").alias("district_name"))

    @property
    def household(self) -> DataFrame:
        c = self.raw("customer").select(
            F.col("c_custkey").alias("household_id"), F.col("c_nationkey").alias("district"), (F.lit(1) + F.col("c_custkey") % 7).cast("double").alias("weight"),
            F.col("c_acctbal").alias("wealth"), F.col("c_mktsegment").alias("segment"),
        )
        return c.join(self.district.select("district", "state"), "district").select("household_id", "district", "state", "weight", "wealth", "segment")

    @property
    def unit(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("unit_id"), F.col("o_custkey").alias("household_id"), F.col("o_totalprice").alias("agi"), F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("period"),
        )

    @property
    def person(self) -> DataFrame:
        p = self.raw("lineitem").select(
            F.col("l_orderkey").alias("unit_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), F.col("l_quantity").alias("age"),
            F.col("l_extendedprice").alias("gross"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("earnings"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("linestatus"),
        )
        return p.join(self.unit.select("unit_id", "household_id"), "unit_id")

    @property
    def strata(self) -> DataFrame:
        """Strata with at least one row that is not deleted."""
        return (
            self.raw("strata").where(F.col("deleted_at").isNull()).groupBy("stratum_id")
            .agg(F.max("parent_stratum_id").alias("parent_stratum_id"), F.max("definition_hash").alias("definition_hash"))
        )

    @property
    def constraints(self) -> DataFrame:
        """Readable constraint cells of living strata, in one spelling: ``stratum_id, variable, operation, value``."""
        cells = wide.resolve_cells(self.raw("stratum_constraints"), "stratum_id", "constraint_variable", "operation", "value", "constraint_id", "loaded_at")
        kept = cells.where(F.col("resolved").isNotNull()).select(F.col("entity_id").alias("stratum_id"), "variable", "operation", F.col("resolved").alias("value"))
        return kept.join(self.strata.select("stratum_id"), "stratum_id", "left_semi")

    @property
    def targets(self) -> DataFrame:
        """The latest state of each target that is not deleted."""
        last = self.raw("targets").where(F.col("deleted_at").isNull()).groupBy("target_id").agg(F.max(F.struct("loaded_at", F.coalesce("value", F.lit(0.0)).alias("o"), "variable", "period", "stratum_id", "reform_id", "value", "active", "source")).alias("x"))
        return last.select("target_id", "x.variable", "x.period", "x.stratum_id", "x.reform_id", "x.value", "x.active", "x.source")


BASE = """
WITH district AS (SELECT n_nationkey AS district, n_regionkey AS state, n_name AS district_name FROM nation),
household AS (SELECT c_custkey AS household_id, c_nationkey AS district, state, CAST(1 + c_custkey % 7 AS DOUBLE) AS weight, c_acctbal AS wealth, c_mktsegment AS segment FROM customer JOIN district ON district = c_nationkey),
unit AS (SELECT o_orderkey AS unit_id, o_custkey AS household_id, o_totalprice AS agi, o_orderstatus AS status, o_orderpriority AS priority, CAST(year(o_orderdate) AS INT) AS period FROM orders),
person AS (SELECT l_orderkey AS unit_id, o_custkey AS household_id, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp, l_quantity AS age, l_extendedprice AS gross, l_extendedprice * (1 - l_discount) AS earnings, l_returnflag AS flag, l_linestatus AS linestatus
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
living AS (SELECT stratum_id, max(parent_stratum_id) AS parent_stratum_id, max(definition_hash) AS definition_hash FROM strata WHERE deleted_at IS NULL GROUP BY 1),
con_raw AS (SELECT *, lower(trim(constraint_variable)) AS v, CASE trim(operation) WHEN '=' THEN '==' ELSE trim(operation) END AS o, trim(value, ' ' || chr(9)) AS t, lower(trim(value, ' ' || chr(9))) AS l FROM stratum_constraints WHERE stratum_id > 0),
con_num AS (SELECT *, CASE WHEN regexp_matches(l, '^[+-]?(inf|infinity)$') THEN CASE WHEN l LIKE '-%' THEN '-Infinity'::DOUBLE ELSE 'Infinity'::DOUBLE END
  WHEN regexp_matches(l, '^[+-]?[$]?([0-9]{1,3}(,[0-9]{3})+|[0-9]+)([.][0-9]*)?(e[+-]?[0-9]+)?$') THEN TRY_CAST(replace(replace(l, '$', ''), ',', '') AS DOUBLE) END AS n FROM con_raw),
con_can AS (SELECT *, CASE WHEN v IN ('state_fips', 'congressional_district_geoid', 'age', 'eitc_child_count') THEN CASE WHEN NOT isinf(n) AND n = floor(n) THEN CAST(CAST(n AS BIGINT) AS VARCHAR) END
  WHEN v = 'ucgid_str' THEN nullif(t, '') WHEN v IN ('tax_unit_is_filer', 'medicaid_enrolled', 'used_aca_ptc', 'is_pregnant', 'tax_unit_itemizes', 'is_aca_ptc_eligible') THEN CASE WHEN l IN ('1', 'true', 'yes', '1.0') THEN 'true' WHEN l IN ('0', 'false', 'no', '0.0') THEN 'false' END
  ELSE CASE n WHEN 'Infinity'::DOUBLE THEN 'Infinity' WHEN '-Infinity'::DOUBLE THEN '-Infinity' ELSE CASE WHEN abs(n) < 1e15 AND n = floor(n) THEN CAST(CAST(n AS BIGINT) AS VARCHAR) ELSE CAST(n + 0.0 AS VARCHAR) END END END AS c FROM con_num),
constr AS (SELECT stratum_id, v AS variable, o AS operation, arg_max(c, (loaded_at, constraint_id, c)) AS value FROM con_can SEMI JOIN living USING (stratum_id) WHERE c IS NOT NULL GROUP BY ALL),
target AS (SELECT target_id, x.variable, x.period, x.stratum_id, x.reform_id, x.value, x.active, x.source FROM (
  SELECT target_id, max({'loaded_at': loaded_at, 'o': coalesce(value, 0.0), 'variable': variable, 'period': period, 'stratum_id': stratum_id, 'reform_id': reform_id, 'value': value, 'active': active, 'source': source}) AS x FROM targets WHERE deleted_at IS NULL GROUP BY 1))
"""
