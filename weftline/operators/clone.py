"""Clones, geography and area subsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import exprs as X
from weftline.operators import impute
from weftline.operators import weights as W
from weftline.session import cut


def shares(df: DataFrame, value: str, group: list[str], name: str = "share") -> DataFrame:
    """``value`` as a share of its group's total, by an aggregation joined back (a whole-table group is one row)."""
    if not group:
        return df.join(F.broadcast(df.agg(F.sum(value).alias("_t"))), F.lit(True)).withColumn(name, F.col(value) / F.col("_t")).drop("_t")
    return df.join(df.groupBy(*group).agg(F.sum(value).alias("_t")), group).withColumn(name, F.col(value) / F.col("_t")).drop("_t")


def tilt(blocks: DataFrame, amounts: DataFrame) -> DataFrame:
    """Move district mass in proportion to ``amounts`` (``cd_geoid, amount``); shares within a district stay; no amount at all keeps the original."""
    per = blocks.groupBy("cd_geoid").agg(F.sum("probability").alias("_m"))
    a = per.join(amounts, "cd_geoid", "left").withColumn("amount", F.greatest(F.coalesce("amount", F.lit(0.0)), F.lit(0.0)))
    total = a.agg(F.sum("amount").alias("_all"), F.sum("_m").alias("_mass"))
    j = blocks.join(a.join(F.broadcast(total), F.lit(True)), "cd_geoid")
    tilted = F.when(F.col("_all") > 0, F.col("probability") / F.col("_m") * F.col("amount") / F.col("_all")).otherwise(F.col("probability") / F.col("_mass"))
    return j.withColumn("tilted", tilted).drop("_m", "amount", "_all", "_mass")


def cumulative(blocks: DataFrame, group: str, order: str, weight: str) -> DataFrame:
    """Cumulative share intervals ``lo, hi`` per group for inverse draws, and ``n_blocks``; a group is a place's blocks, a list of bounded length."""
    w = Window.partitionBy(group).orderBy(order)
    whole = Window.partitionBy(group)
    upto = F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum(weight).over(whole)
    cum = blocks.withColumn("hi", upto / total).withColumn("n_blocks", F.count(F.lit(1)).over(whole))
    return cum.withColumn("lo", F.coalesce(F.lag("hi").over(w), F.lit(0.0))).withColumn("hi", F.when(F.row_number().over(w) == F.col("n_blocks"), 1.0).otherwise(F.col("hi")))


def draw_block(rows: DataFrame, blocks: DataFrame, group: str, order: str, weight: str, u: Column, cells: int = 64) -> DataFrame:
    """Give each row a block of its group by inverse draw of ``u``; intervals are met by cells of the unit line.

    A group has a cell for every four of its blocks, ``cells`` at least.
    """
    cum = cumulative(blocks, group, order, weight).withColumn("_n", F.greatest(F.lit(cells), F.ceil(F.col("n_blocks") / 4)).cast("long"))
    per = cum.select(group, "_n").distinct()
    spread = F.sequence(F.floor(F.col("lo") * F.col("_n")), F.least(F.floor(F.col("hi") * F.col("_n")), F.col("_n") - 1))
    cum = cum.where(F.col("hi") > F.col("lo")).withColumn("_cell", F.explode(spread))
    r = rows.join(per, group).withColumn("_u", u).withColumn("_cell", F.floor(F.col("_u") * F.col("_n"))).drop("_n")
    return r.join(cum.select(group, "_cell", "lo", "hi", order), [group, "_cell"]).where((F.col("_u") >= F.col("lo")) & (F.col("_u") < F.col("hi"))).drop("_cell", "lo", "hi", "_u")


def draw_with_fallback(rows: DataFrame, known: DataFrame, others: DataFrame, group: str, option: str, weight: str, parent: Column, u: Column) -> DataFrame:
    """A weighted option of the row's group; in a group without options, each option of its parent place with equal chance.

    ``known`` has ``group, option, weight``, ``others`` has ``parent, option``; ``parent`` gives a group's parent place.
    Rows whose parent has no option either are left out.
    """
    have = known.where(F.col(weight) > 0).select(group, option, F.col(weight).cast("double").alias(weight))
    lacking = rows.select(group).distinct().join(have.select(group).distinct(), group, "left_anti").withColumn("_parent", parent)
    equal = lacking.join(others.select(F.col("parent").alias("_parent"), option).distinct(), "_parent").select(group, option, F.lit(1.0).alias(weight))
    return draw_block(rows, have.unionByName(equal), group, option, weight, u)


#: Options in one block of the exact draw.
OPTION_BLOCK = 1_024


def draw_without_repeat(records: DataFrame, options: DataFrame, record: str, option: str, weight: str, n: int, salt: str = "place", group: str | None = None, rounds: int = 2) -> DataFrame:
    """``n`` different options (numeric) for each record, of its ``group``: draws by weight, one after the other, repeats passed over.

    First ``rounds`` rounds of ``2 n`` draws each, repeats passed over. Records that still lack options (their weight
    lies on a few) are finished exactly: every option they do not have gets the key ``-ln(u) / weight``, and the smallest
    keys follow in order, which is the same distribution; options are met in blocks of ``OPTION_BLOCK``, each block
    giving its ``n`` smallest. Fewer than ``n`` options of positive weight in a group is an error.
    """
    g = group or "_pool"
    pool = options.where(F.col(weight) > 0).withColumn(g, F.col(group) if group else F.lit(0)).select(g, option, F.col(weight).cast("double").alias(weight))
    recs = records.withColumn(g, F.col(group) if group else F.lit(0)).select(record, g)
    if pool.groupBy(g).agg(F.count_distinct(option).alias("k")).where(F.col("k") < n).limit(1).count() or not pool.limit(1).count():
        raise ValueError("fewer options than wanted")
    draws, open_ = None, recs
    for k in range(rounds):
        asked = open_.withColumn("_t", F.explode(F.sequence(F.lit(2 * n * k), F.lit(2 * n * (k + 1) - 1))))
        got = impute.draw_weighted(asked, pool, option, weight, X.hash_uniform(F.lit(salt), record, "_t"), [g])
        draws = got if draws is None else draws.unionByName(got)
        draws = cut(draws.groupBy(record, g, option).agg(F.min("_t").cast("double").alias("_t")))
        open_ = cut(recs.join(draws.groupBy(record).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n), record, "left_anti"))
        if not open_.limit(1).count():
            break
    else:
        have = draws.groupBy(record).agg(F.collect_set(option).alias("_have"))  # fewer than n
        number = F.floor(F.row_number().over(Window.partitionBy(g).orderBy(option)) / OPTION_BLOCK)
        blocks = pool.withColumn("_b", number).groupBy(g, "_b").agg(F.collect_list(F.struct(F.col(option).alias("o"), F.col(weight).alias("w"))).alias("_list"))
        most = pool.groupBy(g).agg(F.floor(F.count(F.lit(1)) / OPTION_BLOCK).alias("_most"))
        asked = open_.join(have, record, "left").join(most, g).withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_most")))).drop("_most")
        key = lambda x: -F.log(1 - X.hash_uniform(F.lit(salt), F.lit("exact"), F.col(record), x["o"])) / x["w"]
        new = F.filter("_list", lambda x: ~F.coalesce(F.array_contains("_have", x["o"]), F.lit(False)))
        best = F.slice(F.array_sort(F.transform(new, lambda x: F.struct(key(x).alias("key"), x["o"].alias("o")))), 1, n)
        rest = asked.join(blocks, [g, "_b"]).select(record, g, F.explode(best).alias("e")).select(record, g, F.col("e.o").alias(option), (F.col("e.key") + 2.0 * n * rounds).alias("_t"))
        draws = draws.unionByName(rest)
    order = Window.partitionBy(record).orderBy("_t", option)
    return draws.withColumn("clone", F.row_number().over(order) - 1).where(F.col("clone") < n).select(record, "clone", option)


def clones(df: DataFrame, n: int, record: str, n_records: Column) -> DataFrame:
    """``n`` copies of each record with their column id ``clone * n_records + record``."""
    return df.withColumn("clone", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("col_id", F.col("clone") * n_records + F.col(record))


def dense_ids(df: DataFrame, group: list[str], order: str, name: str) -> DataFrame:
    """Numbers 0..n-1 per group in ``order`` (numeric, unique per group), counted range by range so that no group is one task."""
    return W.cumulative(df, order, [F.lit(1).cast("long")], [], group).withColumn(name, F.col("cum0") - 1).drop("cum0", "tot0")


def double_records(df: DataFrame, ids: list[str], weight: str, replaced: dict[str, Column]) -> DataFrame:
    """Append a second half: ids moved by ``max + 1``, weight 0, some columns replaced. ``half`` tells them apart."""
    tops = df.agg(*[(F.max(i) + 1).alias(f"_{i}") for i in ids])
    second = df.join(F.broadcast(tops), F.lit(True))
    cols = [(F.col(k) + F.col(f"_{k}")).alias(k) if k in ids else F.lit(0.0).alias(k) if k == weight else replaced[k].alias(k) if k in replaced else F.col(k) for k in df.columns]
    return df.withColumn("half", F.lit(1)).unionByName(second.select(*cols).withColumn("half", F.lit(2)))


def area_subset(columns: DataFrame, area: Column, weight: str = "weight") -> DataFrame:
    """The (clone, household) columns of an area with positive weight; an empty area is an error for the caller to raise."""
    return columns.where((F.col(weight) > 0) & area)
