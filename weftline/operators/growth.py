"""Growth indices and uprating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def growth_index(df: DataFrame, key: str, year: str, value: str, population: str, base: int) -> DataFrame:
    """Index to the base year, per head and plain, to three digits."""
    b = df.where(F.col(year) == base).select(key, F.col(value).alias("_v"), F.col(population).alias("_p"))
    per = (F.col(value) / F.col(population)) / (F.col("_v") / F.col("_p"))
    return df.join(b, key).select(key, year, F.round(per, 3).alias("per_head"), F.round(F.col(value) / F.col("_v"), 3).alias("plain"))


def apply_growth(df: DataFrame, totals: DataFrame, year: str, total: str, to: int, value: str) -> DataFrame:
    """``value`` times the growth of ``total`` from the row's year to ``to``."""
    f = totals.join(F.broadcast(totals.where(F.col(year) == to).select(F.col(total).alias("_to"))), F.lit(True)).select(year, (F.col("_to") / F.col(total)).alias("_f"))  # one row per year
    return df.join(f, year).withColumn(value, F.col(value) * F.col("_f")).drop("_f")


def signed_uprating(df: DataFrame, value: str, gains: float, losses: float, population: float, weight: str) -> DataFrame:
    """Positive and negative amounts grow differently, per head; the weight grows by population."""
    v = F.col(value)
    return df.withColumn(value, F.when(v > 0, v * gains / population).otherwise(v * losses / population)).withColumn(weight, F.col(weight) * population)


def indexed_thresholds(df: DataFrame, value: str, factors: list[float], interval: float) -> DataFrame:
    """``value`` after 0, 1, ... steps of growth, each floored to ``interval`` before the next."""
    steps = [F.col(value)]
    for f in factors:
        steps.append(F.floor(steps[-1] * F.lit(f) / interval) * interval)
    return df.select("*", F.posexplode(F.array(*[s.cast("double") for s in steps])).alias("step", "_v")).drop(value).withColumnRenamed("_v", value)
