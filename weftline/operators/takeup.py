"""Reproducible participation draws and assignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import exprs as X


def draws(df: DataFrame, variable: str, *keys: str, name: str = "draw") -> DataFrame:
    """One uniform per row from the variable's name and the row's keys."""
    return df.withColumn(name, X.hash_uniform(F.lit(variable), *keys))


def rates(df: DataFrame, table: DataFrame, key: str, default: float = 0.8, name: str = "rate") -> DataFrame:
    """The rate of the row's place, else ``default``."""
    return df.join(table.select(key, F.col("rate").alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(default)))


def reported_first(df: DataFrame, draw: str, rate: str, reported: str, group: list[str], name: str = "takes_up") -> DataFrame:
    """Reporters always take up; others with the probability that brings their group to its rate."""
    r = F.coalesce(F.col(reported), F.lit(False))
    per = df.groupBy(*group).agg(F.floor(F.max(rate) * F.count(F.lit(1))).alias("_want"), F.sum(r.cast("long")).alias("_rep"), F.count(F.lit(1)).alias("_n"))
    per = per.select(*group, F.coalesce(F.try_divide(F.greatest(F.col("_want") - F.col("_rep"), F.lit(0)), F.col("_n") - F.col("_rep")), F.lit(0.0)).alias("_p"))
    return df.join(per, group).withColumn(name, r | (F.col(draw) < F.col("_p"))).drop("_p")


def blend(draw: Column, filed: Column, not_filed: Column) -> Column:
    return F.when(draw, filed).otherwise(not_filed)
