"""The target tables: views, names, best periods, uprating, reconciliation, groups, selection."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import exprs as X

# The geographic constraint variables.
GEO_VARIABLES = ("state_fips", "congressional_district_geoid", "ucgid_str")
# Variables that are no domain of a stratum.
NO_DOMAIN = ("state_fips", "congressional_district_geoid", "tax_unit_is_filer", "ucgid_str")


def stratum_domains(constraints: DataFrame) -> DataFrame:
    """Distinct (stratum, domain variable)."""
    return constraints.where(~F.col("variable").isin(*NO_DOMAIN)).select("stratum_id", F.col("variable").alias("domain_variable")).distinct()


def stratum_geography(constraints: DataFrame) -> DataFrame:
    """One conditional aggregation per stratum: ``stratum_id, geo_level, geographic_id, domain_variable``."""
    v, x = F.col("variable"), F.col("value")
    g = constraints.groupBy("stratum_id").agg(
        F.max((v == "congressional_district_geoid") | ((v == "ucgid_str") & (F.length(x) == 13))).alias("is_d"),
        F.max((v == "state_fips") | ((v == "ucgid_str") & (F.length(x) == 11))).alias("is_s"),
        F.coalesce(F.max(F.when(v == "congressional_district_geoid", x)), F.max(F.when(v == "state_fips", x)), F.max(F.when(v == "ucgid_str", x)), F.lit("US")).alias("geographic_id"),
        F.array_join(F.array_sort(F.collect_set(F.when(~v.isin(*NO_DOMAIN), v))), ",").alias("dom"),
    )
    level = F.when(F.col("is_d"), "district").when(F.col("is_s"), "state").otherwise("national")
    return g.select("stratum_id", level.alias("geo_level"), "geographic_id", F.nullif(F.col("dom"), F.lit("")).alias("domain_variable"))


def target_overview(targets: DataFrame, constraints: DataFrame) -> DataFrame:
    """Targets with level, geography and domain; strata without constraints are national."""
    return targets.join(stratum_geography(constraints), "stratum_id", "left").fillna({"geo_level": "national", "geographic_id": "US"})


def target_names(targets: DataFrame, constraints: DataFrame) -> DataFrame:
    """``geo/variable/[constraints]`` with sorted constraints."""
    text = F.when(~F.col("variable").isin(*GEO_VARIABLES), F.concat("variable", "operation", "value"))
    txt = constraints.groupBy("stratum_id").agg(F.array_join(F.array_sort(F.collect_list(text)), ",").alias("txt"))
    geo = stratum_geography(constraints).select("stratum_id", "geographic_id")
    name = F.concat(F.coalesce("geographic_id", F.lit("US")), F.lit("/"), F.col("variable"), F.lit("/["), F.coalesce("txt", F.lit("")), F.lit("]"))
    return targets.join(txt, "stratum_id", "left").join(geo, "stratum_id", "left").withColumn("name", name).drop("txt", "geographic_id")


def definition_hashes(strata: DataFrame, constraints: DataFrame) -> DataFrame:
    """SHA-256 of parent and sorted constraints of each stratum."""
    texts = constraints.groupBy("stratum_id").agg(F.collect_list(F.concat_ws("|", "variable", "operation", "value")).alias("texts"))
    return strata.join(texts, "stratum_id", "left").select("stratum_id", X.definition_hash(F.col("parent_stratum_id"), F.coalesce("texts", F.array().cast("array<string>"))).alias("hash"))


def best_period(df: DataFrame, keys: list[str], period: str, wanted: Column) -> DataFrame:
    """Per ``keys`` the rows of the latest period up to ``wanted``, else of the earliest later one."""
    best = df.groupBy(*keys).agg(F.coalesce(F.max(F.when(F.col(period) <= wanted, F.col(period))), F.min(period)).alias("_best"))
    same = functools.reduce(operator.and_, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    return df.alias("a").join(best.alias("b"), same & (F.col(f"a.{period}") == F.col("b._best"))).select("a.*")


def latest_reported(df: DataFrame, keys: list[str], period: str, value: str, default: float = 0.0) -> DataFrame:
    """The value of the latest period in which it is not zero."""
    ok = F.coalesce(F.col(value) != 0, F.lit(False))
    return df.groupBy(*keys).agg(F.coalesce(F.max_by(F.when(ok, F.col(value)), F.when(ok, F.col(period))), F.lit(default)).alias(value))


def uprate(targets: DataFrame, factors: DataFrame, year: int) -> DataFrame:
    """Counts by population, amounts by prices: ``factors`` has ``from_year, kind, factor``; missing or same year is 1."""
    kind = F.when(F.col("variable").endswith("_count"), "population").otherwise("prices")
    f = factors.select(F.col("from_year"), F.col("kind").alias("_k"), F.col("factor").alias("_f"))
    j = targets.join(f, (F.col("period") == F.col("from_year")) & (kind == F.col("_k")), "left")
    factor = F.when(F.col("period") == year, F.lit(1.0)).otherwise(F.coalesce("_f", F.lit(1.0)))
    return j.withColumn("uprating_factor", factor).withColumn("uprated", F.col("value") * factor).drop("from_year", "_k", "_f")


def reconcile(rows: DataFrame, factors: DataFrame | None = None) -> DataFrame:
    """Scale districts to their state per domain and variable: ``hif`` = state / sum of districts, times the state's factor.

    ``rows``: ``domain, variable, geo_level, state, district, value``. Districts of a state without a row, or whose
    values sum to zero, stay as they are.
    """
    states = rows.where("geo_level = 'state'").groupBy("domain", "variable", "state").agg(F.max("value").alias("state_value"))
    d = rows.where("geo_level = 'district'")
    w = Window.partitionBy("domain", "variable", "state")
    j = d.withColumn("_sum", F.sum("value").over(w)).join(states, ["domain", "variable", "state"], "left")
    j = j.join(factors, ["state", "variable"], "left") if factors is not None else j.withColumn("factor", F.lit(1.0))
    hif = F.when((F.col("_sum") != 0) & F.col("state_value").isNotNull(), F.col("state_value") / F.col("_sum"))
    return j.select("domain", "variable", "state", "district", "value", hif.alias("hif"), F.when(hif.isNotNull(), F.col("value") * hif * F.coalesce("factor", F.lit(1.0))).otherwise(F.col("value")).alias("reconciled"))


def rescale_children(parents: DataFrame, children: DataFrame, keys: list[str], value: str = "value", tolerance: float = 1e-3) -> DataFrame:
    """Scale children to their parent where their sum is off by more than ``tolerance``."""
    p = parents.groupBy(*keys).agg(F.max(value).alias("_parent"))
    w = Window.partitionBy(*keys)
    j = children.withColumn("_sum", F.sum(value).over(w)).join(p, keys, "left")
    off = F.coalesce(F.abs(F.col("_sum") - F.col("_parent")) > 1e-8 + tolerance * F.abs(F.col("_parent")), F.lit(False)) & (F.col("_sum") != 0)
    return j.withColumn("rescaled", F.when(off, F.col(value) * F.col("_parent") / F.col("_sum")).otherwise(F.col(value))).drop("_sum", "_parent")


def scale_to_total(df: DataFrame, keys: list[str], value: str, total: Column) -> DataFrame:
    """``x * total / sum(x)`` per ``keys``."""
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum")) if keys else df.agg(F.sum(value).alias("_sum"))
    j = df.join(sums, keys) if keys else df.crossJoin(F.broadcast(sums))  # one row
    return j.withColumn("scaled", F.col(value) * total / F.col("_sum")).drop("_sum")


def target_groups(overview: DataFrame) -> DataFrame:
    """Group numbers by level, domain and variable (no domain first), with the group's size."""
    level = F.when(F.col("geo_level") == "national", 0).when(F.col("geo_level") == "state", 1).otherwise(2)
    sizes = overview.groupBy(level.alias("level"), "domain_variable", "variable").agg(F.count(F.lit(1)).alias("n_targets"))
    w = Window.partitionBy(F.lit(0)).orderBy("level", F.col("domain_variable").asc_nulls_first(), "variable")  # one row per kind of target
    return sizes.withColumn("group_id", (F.row_number().over(w) - 1).cast("int"))


def geographic_strata(strata: DataFrame, constraints: DataFrame) -> DataFrame:
    """Strata that are whole geographies: only geographic constraints, or none (the nation)."""
    pure = constraints.groupBy("stratum_id").agg(
        F.min(F.col("variable").isin("state_fips", "congressional_district_geoid")).alias("pure"),
        F.max(F.when(F.col("variable") == "state_fips", F.col("value"))).alias("s"), F.max(F.when(F.col("variable") == "congressional_district_geoid", F.col("value"))).alias("d"),
    )
    return strata.select("stratum_id").join(pure, "stratum_id", "left").where(F.coalesce("pure", F.lit(True))).select("stratum_id", F.coalesce("d", "s", F.lit("US")).alias("geographic_id"))


def rules_predicate(rules: list[dict[str, str]]) -> Column:
    """Any rule matches; a rule matches if all its fields do."""
    one = [functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.lit(v)) for k, v in r.items()], F.lit(True)) for r in rules]
    return functools.reduce(operator.or_, one, F.lit(False))


def include_exclude(df: DataFrame, include: list[dict] | None = None, exclude: list[dict] | None = None) -> DataFrame:
    """Keep rows that an include rule matches (all, if there are none), then drop those an exclude rule matches."""
    out = df.where(rules_predicate(include)) if include else df
    return out.where(~rules_predicate(exclude)) if exclude else out


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``new`` rows replace those of ``existing`` with the same keys."""
    return existing.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def get_or_create(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``existing`` plus the ``new`` rows whose key it lacks, one per key."""
    return existing.unionByName(new.dropDuplicates([key]).join(existing.select(key), key, "left_anti").select(*existing.columns))


def load_long(wide: DataFrame, area: str, scales: dict[str, float]) -> DataFrame:
    """A wide table as long records ``area, variable, value``, each variable times its scale; missing cells are dropped."""
    long = wide.select(area, *[F.col(v).cast("double").alias(v) for v in scales]).unpivot(area, list(scales), "variable", "value")
    factor = F.create_map(*[F.lit(x) for kv in scales.items() for x in kv])
    return long.where(F.col("value").isNotNull()).withColumn("value", F.col("value") * F.try_element_at(factor, "variable"))
