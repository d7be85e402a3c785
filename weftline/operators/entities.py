"""Climbing between person, filing unit and household.

All maps are one grouped aggregation on the key they climb to, with map-side combining; nothing is collected per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_to(df: DataFrame, key: str, **values: Column) -> DataFrame:
    """Sums of members' values per ``key``."""
    return df.groupBy(key).agg(*[F.sum(v).alias(n) for n, v in values.items()])


def any_member(df: DataFrame, key: str, **flags: Column) -> DataFrame:
    """Whether any member of ``key`` has each flag; a null flag is false."""
    return df.groupBy(key).agg(*[F.max(F.coalesce(v, F.lit(False))).alias(n) for n, v in flags.items()])


def first_member(df: DataFrame, key: str, order: list[str], **values: Column) -> DataFrame:
    """The values of the first member in ``order``."""
    return df.groupBy(key).agg(F.min(F.struct(*order, *[v.alias(f"_{n}") for n, v in values.items()])).alias("m")).select(key, *[F.col(f"m._{n}").alias(n) for n in values])


def to_members(df: DataFrame, groups: DataFrame, key: str, defaults: dict | None = None) -> DataFrame:
    """Give each member its group's values; members without a group get ``defaults``."""
    out = df.join(groups, key, "left")
    return out.fillna(defaults) if defaults else out


def target_values(person: DataFrame, condition: Column, entity: str | None, household: str, value: Column | None = None) -> DataFrame:
    """Household contributions to one target: ``household, contribution``.

    ``entity`` None counts persons that satisfy ``condition``. Otherwise an entity counts (or gives ``value``, taken
    once per entity) if any of its members satisfies it. ``entity`` equal to ``household`` is the household level.
    """
    flagged = person.withColumn("_ok", F.coalesce(condition, F.lit(False)))
    if entity is None:
        return flagged.groupBy(household).agg(F.sum(F.col("_ok").cast("long")).cast("double").alias("contribution"))
    keys = [household] if entity == household else [household, entity]
    per = flagged.groupBy(*keys).agg(F.max("_ok").alias("_ok"), (F.max(value) if value is not None else F.lit(1.0)).alias("_v"))
    each = F.when(F.col("_ok"), F.col("_v")).otherwise(0.0)
    if entity == household:
        return per.select(household, each.alias("contribution"))
    return per.groupBy(household).agg(F.sum(each).alias("contribution"))


def targets_together(person: DataFrame, unit: str, household: str, specs: list[tuple[str, Column, str, Column | None]]) -> DataFrame:
    """Household contributions to many targets from one pass over the persons: ``household, target, contribution``.

    Each spec is ``(target, condition, level, value)`` with level ``person``, ``unit`` or ``household``; the meaning is
    that of :func:`target_values`. Persons are shuffled once, to their unit; only units go on to the household.
    """
    aggs = []
    for i, (_, cond, level, value) in enumerate(specs):
        ok = F.coalesce(cond, F.lit(False))
        if level == "person":
            aggs.append(F.sum(ok.cast("long")).alias(f"_n{i}"))
        else:
            aggs += [F.max(ok).alias(f"_ok{i}"), (F.max(value) if value is not None else F.lit(1.0)).alias(f"_v{i}")]
    per_unit = person.groupBy(household, unit).agg(*aggs)
    sums = []
    for i, (_, _, level, _) in enumerate(specs):
        if level == "person":
            sums.append(F.sum(f"_n{i}").cast("double").alias(f"_c{i}"))
        elif level == "unit":
            sums.append(F.sum(F.when(F.col(f"_ok{i}"), F.col(f"_v{i}")).otherwise(0.0)).alias(f"_c{i}"))
        else:
            sums.append(F.when(F.max(f"_ok{i}"), F.max(f"_v{i}")).otherwise(0.0).alias(f"_c{i}"))
    per = per_unit.groupBy(household).agg(*sums)
    long = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"_c{i}").alias("contribution")) for i, (t, *_) in enumerate(specs)]))
    return per.select(household, long.alias("_x")).select(household, "_x.*")


def by_geography(contributions: DataFrame, households: DataFrame, household: str = "household_id", weight: str = "weight") -> DataFrame:
    """Weighted estimates of named contributions for nation, states and districts in one pass over the households.

    ``target, geo_level, geographic_id, estimate``. The three levels are grouping sets of one aggregation, so the rows
    are expanded after, not before, the join.
    """
    j = contributions.join(households.select(household, "state", "district", weight), household)
    rolled = j.rollup("target", "state", "district").agg(F.sum(F.col("contribution") * F.col(weight)).alias("estimate"), F.grouping_id().alias("g")).where("g in (0, 1, 3)")
    level = F.when(F.col("g") == 0, "district").when(F.col("g") == 1, "state").otherwise("national")
    key = F.when(F.col("g") == 0, F.col("district").cast("string")).when(F.col("g") == 1, F.col("state").cast("string")).otherwise("US")
    return rolled.select("target", level.alias("geo_level"), key.alias("geographic_id"), "estimate")
