"""Weighted order statistics, inequality, concentration and selection up to a weighted total.

Cumulative sums over a whole table run in two steps: rows are sorted within value ranges found by approximate
quantiles, each range's total is added up in order, and the ranges before are added to the sum within the range. The
number of ranges grows with the rows (``ROWS_PER_RANGE``, up to ``MOST_RANGES``), so no step holds all rows in one
task; only the ranges' totals (one row per range and group) meet in one place. A value that fills more than one range
gets a range of its own, which is cut further by the first of the columns that order its ties, if that is a number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Rows that one range of a cumulative sum holds, about, and the most ranges.
ROWS_PER_RANGE, MOST_RANGES = 500_000, 1024


def _range_of(v: Column, edges: list[float]) -> Column:
    """The number of ``edges`` at or below ``v``: among 32 coarse edges first, then within one stretch between them."""
    step = max(1, -(-len(edges) // 32))
    coarse = edges[::step]
    at = sum(((v >= F.lit(e)).cast("int") for e in coarse), F.lit(0))
    if step == 1:
        return F.coalesce(at, F.lit(-1))
    parts = F.array(*[F.array(*[F.lit(e) for e in edges[i * step + 1 : (i + 1) * step]]).cast("array<double>") for i in range(len(coarse))])
    inner = F.size(F.filter(F.element_at(parts, F.greatest(at, F.lit(1))), lambda e: e <= v))
    return F.coalesce(F.when(at == 0, 0).otherwise((at - 1) * step + 1 + inner), F.lit(-1))


def cumulative(df: DataFrame, value: str, add: list[Column], order: list[Column], group: list[str] | None = None, descending: bool = False, ranges: int | None = None) -> DataFrame:
    """Adds ``cum0, cum1, ...`` (running sums of ``add`` in the order of ``value`` and then ``order``) and ``tot0, ...``."""
    group = group or []
    points = F.lit([i / MOST_RANGES for i in range(1, MOST_RANGES)])
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(value, points, 4 * MOST_RANGES).alias("e")).first()
    ranges = ranges or max(2, min(MOST_RANGES, seen["n"] // ROWS_PER_RANGE))
    some = slice(MOST_RANGES // ranges - 1, None, MOST_RANGES // ranges)
    picked = [float(e) for e in (seen["e"] or [])[some]]
    heavy = sorted({a for a, b in zip(picked, picked[1:]) if a == b})
    v = F.col(value)
    rng = _range_of(v, sorted({*picked, *(math.nextafter(h, math.inf) for h in heavy)}))
    d = df.withColumn("_r", -rng if descending else rng).withColumn("_s", F.lit(0))
    if heavy and order and isinstance(df.select(order[0]).schema[0].dataType, NumericType):
        ties = df.where(v.isin(heavy)).agg(F.percentile_approx(order[0].cast("double"), points, 4 * MOST_RANGES).alias("e")).first()["e"]
        d = d.withColumn("_s", F.when(v.isin(heavy), _range_of(order[0].cast("double"), sorted({float(e) for e in (ties or [])[some]}))).otherwise(0))
    for i, a in enumerate(add):
        d = d.withColumn(f"_a{i}", a)
    n = range(len(add))
    key = v.desc_nulls_last() if descending else v.asc_nulls_first()
    inner = Window.partitionBy(*group, "_r", "_s").orderBy(key, *order).rowsBetween(Window.unboundedPreceding, 0)
    per = d.groupBy(*group, "_r", "_s").agg(*[F.sum(f"_a{i}").alias(f"_t{i}") for i in n])
    outer = Window.partitionBy(*(group or [F.lit(0)]))
    before = outer.orderBy("_r", "_s").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*group, "_r", "_s", *[F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_b{i}") for i in n], *[F.sum(f"_t{i}").over(outer).alias(f"tot{i}") for i in n])
    out = d.withColumns({f"_c{i}": F.sum(f"_a{i}").over(inner) for i in n}).join(per, [*group, "_r", "_s"])
    return out.withColumns({f"cum{i}": F.col(f"_b{i}") + F.col(f"_c{i}") for i in n}).drop("_r", "_s", *[f"{p}{i}" for i in n for p in ("_a", "_b", "_c")])


def weighted_rank_share(df: DataFrame, value: str, weight: str, key: str) -> DataFrame:
    """The share of weight up to the middle of each row, ``mid_share``."""
    return cumulative(df, value, [F.col(weight)], [F.col(key)]).withColumn("mid_share", (F.col("cum0") - F.col(weight) / 2) / F.col("tot0")).drop("cum0", "tot0")


def weighted_quantiles(df: DataFrame, value: str, weight: str, qs: list[float], group: list[str] | None = None) -> DataFrame:
    """The smallest value whose cumulative weight reaches ``q`` of the total."""
    group = group or []
    by_value = df.groupBy(*group, value).agg(F.sum(weight).alias("_w"))
    c = cumulative(by_value, value, [F.col("_w")], [], group)
    each = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("q"), F.when(F.col("cum0") >= q * F.col("tot0"), F.col(value)).alias("x")) for q in qs])).alias("e")
    return c.select(*group, each).select(*group, "e.*").groupBy(*group, "q").agg(F.min("x").alias("quantile"))


def gini(df: DataFrame, value: str, weight: str) -> DataFrame:
    """One minus twice the area under the Lorenz curve (trapezoids). Negative values count as zero."""
    x = F.greatest(F.col(value), F.lit(0.0))
    by_value = df.select(x.alias("_x"), F.col(weight).alias("_w")).groupBy("_x").agg(F.sum("_w").alias("_w"))
    c = cumulative(by_value, "_x", [F.col("_w"), F.col("_w") * F.col("_x")], [])
    area = F.sum(F.col("_w") * (2 * F.col("cum1") - F.col("_w") * F.col("_x")) / 2) / (F.max("tot0") * F.max("tot1"))
    return c.agg((1 - 2 * area).alias("gini"))


def top_share(df: DataFrame, value: str, weight: str, p: float) -> DataFrame:
    """The share of the total held at or above the weighted quantile ``1 - p``."""
    q = weighted_quantiles(df, value, weight, [1 - p]).select(F.col("quantile").alias("_q"))
    j = df.join(F.broadcast(q), F.lit(True))  # one row
    amount = F.col(value) * F.col(weight)
    return j.agg((F.sum(F.when(F.col(value) >= F.col("_q"), amount).otherwise(0.0)) / F.sum(amount)).alias("share"))


def concentration(df: DataFrame, weight: str, tops: list[int]) -> DataFrame:
    """Effective sample size and the shares of the largest weights."""
    base = df.agg((F.sum(weight) * F.sum(weight) / F.sum(F.col(weight) * F.col(weight))).alias("ess"), F.sum(weight).alias("_t"))
    out = base
    for n in tops:
        top = df.orderBy(F.col(weight).desc()).limit(n).agg(F.sum(weight).alias(f"_s{n}"))
        out = out.join(F.broadcast(top), F.lit(True)).withColumn(f"top_{n}_share", F.col(f"_s{n}") / F.col("_t")).drop(f"_s{n}")
    return out.drop("_t")


def weighted_profile(df: DataFrame, group: str, value: str, weight: str) -> DataFrame:
    """Weighted mean (0 without weight), share of the total weight and plain mean per group."""
    per = df.groupBy(group).agg(F.sum(F.col(value) * F.col(weight)).alias("_s"), F.sum(weight).alias("_w"), F.avg(value).alias("plain"))
    return per.join(F.broadcast(per.agg(F.sum("_w").alias("_t"))), F.lit(True)).select(group, F.when(F.col("_w") == 0, 0.0).otherwise(F.col("_s") / F.col("_w")).alias("mean"), (F.col("_w") / F.col("_t")).alias("share"), "plain")


def fill_to_total(df: DataFrame, draw: str, weight: str, key: str, total: Column, group: list[str] | None = None) -> DataFrame:
    """The rows with the smallest ``draw`` whose weight first reaches ``total``, the crossing row included."""
    c = cumulative(df, draw, [F.col(weight)], [F.col(key)], group)
    return c.where(F.col("cum0") - F.col(weight) < total).drop("cum0", "tot0")


def quota_sample(df: DataFrame, group: list[str], draw: Column, key: str, quota: Column) -> DataFrame:
    """The ``quota`` rows with the smallest ``draw`` per group; ``quota`` may use ``_n``, the group's size."""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    ranked = cumulative(df.withColumn("_d", draw), "_d", [F.lit(1)], [F.col(key)], group)
    return ranked.join(sizes, group).where(F.col("cum0") <= quota).drop("_d", "_n", "cum0", "tot0")
