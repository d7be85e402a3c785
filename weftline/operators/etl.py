"""Reshaping and rescaling of administrative tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def redistribute(values: DataFrame, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """Values of old areas dealt to new areas: ``mapping`` has ``old, new, share``; unmapped areas stay."""
    j = values.join(mapping, values[key] == mapping["old"], "left")
    return j.groupBy(F.coalesce("new", F.col(key)).alias(key)).agg(F.sum(F.col(value) * F.coalesce("share", F.lit(1.0))).alias(value))


def age_histogram(person: DataFrame, key: str, age: str, width: int, top: int) -> DataFrame:
    """Members per band of ``width`` years, with an own band from ``top``."""
    b = F.when(F.col(age) >= top, top).otherwise(F.floor(F.col(age) / width) * width).cast("int")
    return person.groupBy(key, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def second_largest(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """The smaller of a group's two largest values; of a single value itself. Two mergeable passes, no ranking."""
    top = df.groupBy(key).agg(F.max(value).alias("_m"), F.count(value).alias("_n"))
    j = df.join(top, key)
    return j.groupBy(key).agg(F.when((F.max("_n") == 1) | (F.sum((F.col(value) == F.col("_m")).cast("int")) > 1), F.max("_m")).otherwise(F.max(F.when(F.col(value) < F.col("_m"), F.col(value)))).alias(name))


def at_or_above(df: DataFrame, value: str, thresholds: list[float]) -> DataFrame:
    """Counts and sums at or above each threshold, from disjoint bands."""
    t = sorted(thresholds)
    band = sum((F.col(value) >= x).cast("int") for x in t)
    per = df.where(F.col(value) >= t[0]).groupBy(band.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("s"))
    each = per.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("b"))))
    return each.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("total")).select(F.element_at(F.array(*[F.lit(x) for x in t]), F.col("i")).alias("threshold"), "n", "total")


def joint_flags(df: DataFrame, flags: list[str], weight: str) -> DataFrame:
    """Weight of rows with both flags, for each pair of flag columns, in one pass."""
    pairs = list(combinations(sorted(flags), 2))
    one = df.agg(*[F.sum(F.when(F.col(a) & F.col(b), F.col(weight))).alias(f"{a}|{b}") for a, b in pairs])
    return one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"{a}|{b}").alias("joint")) for a, b in pairs])).alias("x")).select("x.*").where(F.col("joint").isNotNull())


def annualise(df: DataFrame, keys: list[Column], month: Column, value: Column, name: str) -> DataFrame:
    """``sum * 12 / months seen``, halves to even."""
    return df.groupBy(*keys).agg(F.bround(F.round(F.sum(value), 2) * 12 / F.count_distinct(month), 0).alias(name))


def first_row(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key in a stated order."""
    rest = [x for x in df.columns if x not in keys]
    s = F.min(F.struct(*order, *[F.col(x).alias(f"_{x}") for x in rest]))
    return df.groupBy(*keys).agg(s.alias("_r")).select(*keys, *[F.col(f"_r._{x}").alias(x) for x in rest])
