"""Comparing distributions and groupings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import weights as W


def compare_distributions(df: DataFrame, side: str, x: str, other: str, bins: int = 50) -> DataFrame:
    """One row: histogram overlap, Kolmogorov-Smirnov distance, standardised mean and correlation difference of sides 0 and 1.

    The histogram and the running shares come from counts per bin and per value, so no side is sorted in one task.
    """
    a, b = F.when(F.col(side) == 0, 1), F.when(F.col(side) == 1, 1)
    s = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(a).alias("na"), F.count(b).alias("nb")).first()
    span = (s["hi"] or 0.0) - (s["lo"] or 0.0)
    na, nb = max(s["na"], 1), max(s["nb"], 1)
    slot = F.least(F.floor((F.col(x) - (s["lo"] or 0.0)) / (span or 1.0) * bins), F.lit(bins - 1))
    overlap = df.groupBy(slot.alias("slot")).agg(F.count(a).alias("a"), F.count(b).alias("b")).agg(F.sum(F.least(F.col("a") / na, F.col("b") / nb)).alias("overlap"))
    per = df.groupBy(x).agg(F.count(a).alias("a"), F.count(b).alias("b"))
    ks = W.cumulative(per, x, [F.col("a"), F.col("b")], []).agg(F.max(F.abs(F.col("cum0") / na - F.col("cum1") / nb)).alias("ks"))
    v = lambda k: F.when(F.col(side) == k, F.col(x))
    o = lambda k: F.when(F.col(side) == k, F.col(other))
    rest = df.agg((F.abs(F.avg(v(0)) - F.avg(v(1))) / F.sqrt((F.var_samp(v(0)) + F.var_samp(v(1))) / 2)).alias("smd"), (F.corr(v(0), o(0)) - F.corr(v(1), o(1))).alias("corr_diff"))
    one = F.lit(True)  # each part is one row
    return overlap.join(F.broadcast(ks), one).join(F.broadcast(rest), one)


def kendall(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """Kendall's tau-b of ``x`` and ``y``, each in ``bins`` bins of equal width: one row ``tau``.

    Pairs are counted from the at most ``bins * bins`` cells of the two-way table, never formed from rows.
    """
    s = df.agg(*[f(c).alias(f"{n}{c}") for c in (x, y) for n, f in (("lo_", F.min), ("hi_", F.max))]).first()
    slot = lambda c: F.least(F.floor((F.col(c) - (s[f"lo_{c}"] or 0)) / (((s[f"hi_{c}"] or 0) - (s[f"lo_{c}"] or 0)) or 1) * bins), F.lit(bins - 1)).cast("int")
    g = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(slot(x).alias("i"), slot(y).alias("j")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    rows = g.collect()  # at most bins * bins
    t = np.zeros((bins, bins))
    for r in rows:
        t[r["i"], r["j"]] = r["n"]
    below = t[::-1].cumsum(0)[::-1]
    after = np.vstack([below[1:], np.zeros(bins)])  # rows with larger x
    right = np.hstack([after[:, ::-1].cumsum(1)[:, ::-1][:, 1:], np.zeros((bins, 1))])
    left = np.hstack([np.zeros((bins, 1)), after.cumsum(1)[:, :-1]])
    pairs = lambda v: float((v * (v - 1) / 2).sum())
    n = t.sum()
    free = np.sqrt((pairs(np.array([n])) - pairs(t.sum(1))) * (pairs(np.array([n])) - pairs(t.sum(0))))
    tau = float((t * (right - left)).sum() / free) if free > 0 else None
    return df.sparkSession.createDataFrame([(tau,)], "tau double")


def pair_agreement(df: DataFrame, within: list[str], a: str, b: str) -> DataFrame:
    """Pairs of members together in both groupings and in each, from group sizes."""
    g = df.groupBy(*within, a, b).agg(F.count(F.lit(1)).alias("n"))
    pairs = lambda c: F.sum(F.col(c) * (F.col(c) - 1) / 2).cast("long")
    both = g.agg(pairs("n").alias("pairs_in_both"))
    x = g.groupBy(*within, a).agg(F.sum("n").alias("n")).agg(pairs("n").alias("pairs_in_a"))
    y = g.groupBy(*within, b).agg(F.sum("n").alias("n")).agg(pairs("n").alias("pairs_in_b"))
    return both.join(F.broadcast(x), F.lit(True)).join(F.broadcast(y), F.lit(True))
