"""Donor imputation, stratified samples, allocation and expansion."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import exprs as X
from weftline.operators import weights as W
from weftline.session import cut

#: Fewest cells of the unit line in which draws meet cumulative shares, and donors to a cell beyond that.
CELLS, CELL_DONORS = 256, 4
# Fixed value: the power of the scores in donor selection.
SELECTION_POWER = 24.0
#: Most groups whose numbers of cells are broadcast.
BROADCAST_GROUPS = 100_000


def draw_weighted(rows: DataFrame, donors: DataFrame, key: str, weight: str, u: Column, group: list[str] | None = None, cells: int = CELLS) -> DataFrame:
    """Give each row one donor ``key`` (numeric) with probability by weight, within ``group``.

    Donors' running shares are cut at the cells of the unit line and a draw meets the donors of its cell only. The
    number of cells grows with the group's donors (one for ``CELL_DONORS`` of them, ``cells`` at least), so a draw meets
    a few donors however many there are. Shares are whole numbers (2^52 for a group), so that neighbouring intervals
    meet exactly and every row gets one donor. Rows of a group without donors of positive weight get none.
    """
    group = group or []
    on = [*group, "_g"]
    d = donors.where(F.col(weight) > 0).select(*group, key, weight).withColumn("_g", F.lit(0))
    n = F.greatest(F.lit(cells), F.ceil(F.count(F.lit(1)) / CELL_DONORS)).cast("long")
    per = cut(d.groupBy(*on).agg(n.alias("_cells"), F.sum(weight).alias("_whole")))
    per = F.broadcast(per) if per.count() <= BROADCAST_GROUPS else per
    part = F.greatest(F.round(F.col(weight) / F.col("_whole") * float(1 << 52)).cast("long"), F.lit(1))
    c = W.cumulative(d.join(per, on).withColumn("_part", part), key, [F.col("_part")], [F.col(key)], on)
    c = c.select(*on, key, "_cells", ((F.col("cum0") - F.col("_part")) / F.col("tot0")).alias("_lo"), (F.col("cum0") / F.col("tot0")).alias("_hi"))
    spread = F.sequence(F.floor(F.col("_lo") * F.col("_cells")), F.least(F.floor(F.col("_hi") * F.col("_cells")), F.col("_cells") - 1))
    c = c.withColumn("_cell", F.explode(spread)).drop("_cells")
    r = rows.withColumn("_g", F.lit(0)).join(per.select(*on, "_cells"), on).withColumn("_u", u)
    r = r.withColumn("_cell", F.floor(F.col("_u") * F.col("_cells"))).drop("_cells")
    return r.join(c, [*on, "_cell"]).where((F.col("_u") >= F.col("_lo")) & (F.col("_u") < F.col("_hi"))).drop("_u", "_cell", "_lo", "_hi", "_g")


def hot_deck(recipients: DataFrame, donors: DataFrame, cell: list[str], columns: list[str], key: str, bands: int = 4) -> DataFrame:
    """Impute ``columns`` one after the other: each from the donors' distribution in the recipient's cell, further split by the band of the column before.

    A conditional-quantile hot deck: it stands in for a quantile forest and keeps each cell's distribution. Cells
    without donors stay null.
    """
    out, given, edges = recipients, list(cell), None
    d = donors
    for i, col in enumerate(columns):
        if i:
            prev = columns[i - 1]
            e = donors.agg(F.percentile_approx(prev, [j / bands for j in range(1, bands)], 1000).alias("e")).first()["e"] or []
            edges = lambda c, e=e: sum(((F.col(c) >= F.lit(x)).cast("int") for x in e), F.lit(0))
            out, d = out.withColumn(f"_b{i}", edges(prev)), d.withColumn(f"_b{i}", edges(prev))
            given = [*given, f"_b{i}"]
        pool = d.where(F.col(col).isNotNull()).groupBy(*given, col).agg(F.count(F.lit(1)).cast("double").alias("_n"))
        got = draw_weighted(out.select(key, *given), pool, col, "_n", X.hash_uniform(F.lit(col), key), given).select(key, col)
        out = out.join(got, key, "left")
    return out.drop(*[f"_b{i}" for i in range(1, len(columns))])


def reconcile_to_total(columns: list[str], total: Column) -> list[Column]:
    """Non-negative parts scaled to ``total``; parts that sum to zero share it equally; no positive total gives zeros."""
    parts = [F.greatest(F.col(c), F.lit(0.0)) for c in columns]
    s = functools.reduce(operator.add, parts)
    return [F.when(total > 0, F.when(s > 0, p / s * total).otherwise(total / len(columns))).otherwise(F.lit(0.0)).alias(c) for p, c in zip(parts, columns)]


def keep_top_sample(df: DataFrame, value: str, percentile: float, n: int, draw: Column, key: str) -> DataFrame:
    """All rows at or above a percentile and the rows with the smallest draws below it, ``n`` in all."""
    t = df.agg(F.percentile(value, percentile).alias("_t"))
    j = df.join(F.broadcast(t), F.lit(True))  # one row
    top = j.where(F.col(value) >= F.col("_t")).drop("_t")
    n_top = top.count()
    rest = j.where(F.col(value) < F.col("_t")).drop("_t").withColumn("_d", draw)
    low = W.cumulative(rest, "_d", [F.lit(1)], [F.col(key)]).where(F.col("cum0") <= max(0, n - n_top)).drop("_d", "cum0", "tot0")
    return top.unionByName(low)


def bracket_sample(df: DataFrame, bracket: Column, caps: dict[str, int], first: Column, draw: Column, key: str) -> DataFrame:
    """Up to ``caps[bracket]`` rows per bracket, rows with ``first`` before others, then by draw."""
    d = df.withColumn("_b", bracket).withColumn("_d", F.when(first, draw).otherwise(draw + 1.0))
    c = W.cumulative(d, "_d", [F.lit(1)], [F.col(key)], ["_b"])
    cap = F.create_map(*[F.lit(x) for kv in caps.items() for x in kv])
    return c.where(F.col("cum0") <= F.coalesce(F.try_element_at(cap, "_b"), F.lit(0))).withColumnRenamed("_b", "bracket").drop("_d", "cum0", "tot0")


def subset_to_weight(df: DataFrame, weight: str, draw: Column, current: float, wanted: float) -> DataFrame:
    """A random part of the rows whose expected weight is the gap between current and wanted total."""
    tot = df.agg(F.sum(weight).alias("_t"))
    p = F.least(F.abs(F.lit(current - wanted)) / F.col("_t"), F.lit(1.0))
    return df.join(F.broadcast(tot), F.lit(True)).where(draw < p).drop("_t")  # one row


def move_to_target(df: DataFrame, status: str, source: str, to: str, weight: str, draw: Column, factor: float) -> DataFrame:
    """Move rows of one status to another by draw, so that the expected weight of ``to`` becomes ``factor`` times its own.

    A row of ``source`` moves if its draw is below the wanted weight over the weight of ``source``, at most all rows.
    """
    at = lambda x: F.coalesce(F.sum(F.when(F.col(status) == x, F.col(weight))), F.lit(0.0))
    tot = df.agg(F.least(F.try_divide(F.greatest(at(to) * factor - at(to), F.lit(0.0)), at(source)), F.lit(1.0)).alias("_p"))
    moved = (F.col(status) == source) & (draw < F.coalesce("_p", F.lit(0.0)))
    return df.join(F.broadcast(tot), F.lit(True)).withColumn(status, F.when(moved, to).otherwise(F.col(status))).drop("_p")  # one row


def lognormal(u1: Column, u2: Column, mu: float, sigma: float) -> Column:
    """A log-normal value from two uniforms."""
    z = F.sqrt(-2 * F.log(F.greatest(u1, F.lit(1e-18)))) * F.cos(2 * 3.141592653589793 * u2)
    return F.exp(mu + sigma * z)


def integer_weights(total: Column, n: Column, rank: Column) -> Column:
    """``total`` dealt to ``n`` rows as integers: quotient, plus one for the first ``remainder`` rows."""
    return F.floor(total / n) + F.when(rank <= total % n, 1).otherwise(0)


def allocate(df: DataFrame, group: list[str], base: str, weight: str, total: str, name: str = "allocated") -> DataFrame:
    """A weighted total dealt to the rows of its group in proportion to ``base``.

    A positive total goes to positive bases, a negative one to negative bases, if there are any; else to all non-zero
    bases, else equally to all rows.
    """
    b, w, t = F.col(base), F.col(weight), F.col(total)
    per = df.groupBy(*group).agg(F.sum(F.when(b > 0, b * w)).alias("_p"), F.sum(F.when(b < 0, -b * w)).alias("_n"), F.sum(F.abs(b) * w).alias("_a"), F.sum(w).alias("_w"))
    j = df.join(per, group)
    mag = F.when((t > 0) & F.col("_p").isNotNull(), F.when(b > 0, b / F.col("_p")).otherwise(0.0)).when((t < 0) & F.col("_n").isNotNull(), F.when(b < 0, -b / F.col("_n")).otherwise(0.0)).when(F.col("_a") > 0, F.abs(b) / F.col("_a")).otherwise(1 / F.col("_w"))
    return j.withColumn(name, F.when(F.abs(t) <= 1e-6, F.lit(0.0)).otherwise(mag * t + 0.0)).drop("_p", "_n", "_a", "_w")


def project_to_bounds(df: DataFrame, group: list[str], value: str, weight: str, total: str, lower: str, upper: str, tol: float = 1e-6) -> DataFrame:
    """Move values within their bounds until each group's weighted sum meets ``total``; adds ``residual``, what is left.

    Each round spreads the residual over the rows that have room, in proportion to their size (equally where all are
    zero). A round that does not meet the total brings at least one row to its bound, so rounds go on until every
    group's residual is within ``tol`` or its rows have no room left; the residual of a group whose bounds cannot meet
    the total is what the nearest values leave. Rows without positive weight keep their clamped values.

    A round is two grouped aggregations joined back, so no group is collected; the state is written to the checkpoint
    folder between rounds. Null values count as zero, null bounds as none.
    """
    v, w = F.col(value), F.coalesce(F.col(weight), F.lit(0.0))
    lo, hi = F.coalesce(F.col(lower), F.lit(float("-inf"))), F.coalesce(F.col(upper), F.lit(float("inf")))
    cur = df.withColumn(value, F.least(F.greatest(F.coalesce(v.cast("double"), F.lit(0.0)), lo), hi))
    while True:
        cur = cut(cur)
        res = cur.groupBy(*group).agg((F.max(total) - F.sum(v * w)).alias("_r"))
        room = F.when(F.col("_r") > 0, hi - v).otherwise(v - lo)
        j = cur.join(res, group).withColumn("_room", room).withColumn("_free", (w > 0) & (F.col("_room") > 1e-9 * F.greatest(F.abs(v), F.lit(1.0))))
        base = j.groupBy(*group).agg(F.max("_r").alias("_r"), F.sum(F.when(F.col("_free"), F.abs(v) * w)).alias("_b"), F.sum(F.when(F.col("_free"), w)).alias("_w"))
        base = cut(base.withColumn("_open", (F.abs("_r") > tol) & F.coalesce(F.col("_w") > 0, F.lit(False))))
        if not base.where("_open").limit(1).count():
            return cur.join(base.select(*group, F.col("_r").alias("residual")), group)
        j = j.drop("_r").join(base, group)
        step = F.when(F.col("_b") > 1e-9, F.col("_r") * F.abs(v) / F.col("_b")).otherwise(F.col("_r") / F.col("_w"))
        step = F.when(F.col("_open") & F.col("_free"), F.greatest(F.least(step, F.col("_room")), -F.col("_room"))).otherwise(F.lit(0.0))
        cur = j.withColumn(value, v + step).select(*cur.columns)


def donor_probabilities(donors: DataFrame, bucket: str, score: str, amount: str, wanted: str, power: float = SELECTION_POWER) -> DataFrame:
    """Adds ``probability``: a donor's chance within its bucket, by its score to ``power`` and the nearness of its amount to ``wanted``.

    Nearness is the square root of ``1 / (1 + d)``, ``d`` being the distance of the logarithms of one plus the absolute
    amounts. Scores below 1e-6 count as that; a bucket whose masses are not positive numbers gives all donors the same.
    """
    mass = F.pow(F.greatest(F.coalesce(F.col(score), F.lit(0.0)), F.lit(1e-6)), F.lit(power))
    gap = F.abs(F.log1p(F.abs(F.col(amount))) - F.log1p(F.greatest(F.abs(F.col(wanted)), F.lit(1.0))))
    d = donors.withColumn("_mass", mass * F.sqrt(1 / (1 + gap)))
    per = d.groupBy(bucket).agg(F.sum("_mass").alias("_all"), F.count(F.lit(1)).alias("_k"), F.max(F.col("_mass").isNull() | F.isnan("_mass")).alias("_odd"))
    even = F.col("_odd") | ~F.coalesce((F.col("_all") > 0) & (F.col("_all") < float("inf")), F.lit(False))
    return d.join(per, bucket).withColumn("probability", F.when(even, 1.0 / F.col("_k")).otherwise(F.col("_mass") / F.col("_all"))).drop("_mass", "_all", "_k", "_odd")


def sample_donors(donors: DataFrame, bucket: str, key: str, probability: str, n: Column, u: Column) -> DataFrame:
    """``n`` donors per bucket: ``bucket, key, copy``; without replacement by exponential keys of the draw ``u``.

    A bucket with fewer donors than ``n`` (a column that is equal within a bucket) draws with replacement instead, one
    weighted draw per ``copy``.
    """
    d = donors.where(F.col(probability) > 0).select(bucket, key, probability, n.cast("long").alias("_want"), (-F.log(1 - u) / F.col(probability)).alias("_key"))
    sizes = cut(d.groupBy(bucket).agg(F.count(F.lit(1)).alias("_k"), F.max("_want").alias("_want")))
    few = sizes.where(F.col("_k") < F.col("_want"))
    enough = d.drop("_want").join(sizes.where(F.col("_k") >= F.col("_want")).drop("_k"), bucket)
    once = W.cumulative(enough, "_key", [F.lit(1).cast("long")], [F.col(key)], [bucket]).where(F.col("cum0") <= F.col("_want")).select(bucket, key, (F.col("cum0") - 1).alias("copy"))
    asked = few.select(bucket, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_want") - 1)).alias("copy"))
    again = draw_weighted(asked, d.select(bucket, key, probability), key, probability, X.hash_uniform(F.lit("again"), bucket, "copy"), [bucket]).select(bucket, key, "copy")
    return once.unionByName(again)


#: Donors in one block of the exact search of :func:`draw_tilted`.
TILT_BLOCK = 512


def draw_tilted(rows: DataFrame, donors: DataFrame, rid: str, did: str, group: str, weight: str, tilt: Column, rounds: tuple[int, ...] = (8, 64)) -> DataFrame:
    """One donor (numeric id) per row of its group with probability in proportion to ``weight * tilt``, ``0 <= tilt <= 1``.

    First by rejection: donors are drawn by weight and kept with probability ``tilt`` (which may use columns of both
    sides); the first kept draw counts. Rows are given 8 and then 64 draws. What is left, rows that are unlike most of
    their group, is drawn exactly: each such row meets its group's donors block by block, every donor gets the key
    ``-ln(u) / (weight * tilt)``, and the smallest key wins, which combines map-side. Both ways have the same
    distribution, so the number of rounds does not change it. Rows whose donors all have a tilt of zero are drawn by
    weight alone; rows of a group without donors of positive weight get none.
    """
    left, found = rows, None
    pool = donors.where(F.col(weight) > 0)
    for k, n in enumerate(rounds):
        asked = left.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        got = draw_weighted(asked, pool, did, weight, X.hash_uniform(F.lit(f"draw{k}"), rid, "_t"), [group]).join(pool.drop(weight), [group, did])
        kept = got.where(X.hash_uniform(F.lit(f"keep{k}"), rid, "_t") < tilt).groupBy(rid).agg(F.min_by(did, "_t").alias(did))
        found = kept if found is None else found.unionByName(kept)
        found = cut(found)
        left = cut(rows.join(found.select(rid), rid, "left_anti"))
        if not left.limit(1).count():
            return found
    sizes = pool.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / TILT_BLOCK).alias("_blocks"))
    asked = left.join(sizes, group).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))).drop("_blocks")
    dealt = pool.join(sizes, group).withColumn("_block", F.pmod(F.xxhash64(did), F.col("_blocks"))).drop("_blocks")
    share = F.col(weight) * tilt
    key = -F.log(1 - X.hash_uniform(F.lit("exact"), rid, did)) / share
    rest = cut(asked.join(dealt, [group, "_block"]).where(share > 0).groupBy(rid).agg(F.min_by(did, F.struct(key, F.col(did))).alias(did)))
    untilted = left.join(rest.select(rid), rid, "left_anti").select(rid, group)
    return found.unionByName(rest).unionByName(draw_weighted(untilted, pool, did, weight, X.hash_uniform(F.lit("untilted"), rid), [group]).select(rid, did))


def expand(df: DataFrame, n: Column) -> DataFrame:
    """``n`` copies of each row, numbered from 0."""
    return df.withColumn("copy", F.explode(F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1))))


def reference_person(df: DataFrame, household: str, order: list[str], adult: Column, age: str, partner: Column, male: Column) -> DataFrame:
    """One reference row per household.

    No adult: the oldest; one adult: that one; two adults who are partners of different sex: the man; else the oldest
    adult. Ties go to the first in ``order``.
    """
    a = adult.cast("int")
    per = df.groupBy(household).agg(F.sum(a).alias("_na"), F.sum((adult & partner).cast("int")).alias("_np"), F.count_distinct(F.when(adult & partner, male)).alias("_ns"))
    j = df.join(per, household)
    mixed = (F.col("_na") == 2) & (F.col("_np") == 2) & (F.col("_ns") == 2)
    key = F.struct((-a).alias("a"), F.when(mixed & male, 0).otherwise(1).alias("m"), (-F.col(age)).alias("g"), *[F.col(o).alias(f"o{i}") for i, o in enumerate(order)])
    w = Window.partitionBy(household).orderBy(key)
    return j.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_na", "_np", "_ns")


def filing_units(
    person: DataFrame, household: str, line: str, spouse: str, parent: str, age: str, adult_age: int = 18, *,
    parent2: str | None = None, income: str | None = None, reference: Column | None = None, child: Column | None = None, relative: Column | None = None, kin: Column | None = None, young: int = 15,
) -> DataFrame:
    """Units of a household from pointers, in two passes of claims: ``household, line, unit_line, role``.

    Two persons who point to each other form a pair, led by the reference person, else the older (then the lower line);
    other adults begin a unit of their own. First the single adults, by age and line, may be claimed by a unit that holds
    one of their parents, if ``child`` holds for them; a claimed adult's unit can claim nobody after that, and claims are
    followed through chains to the unit that is left. Then the others, by age and line, are claimed by what is left: if
    ``child`` holds, by a parent's unit, or, for those under ``young`` without a parent's line, by the reference person's
    unit; else, if ``relative`` holds, by a parent's unit or, for those under ``young`` with ``kin`` or without a parent's
    line, the reference person's unit. Among several units the one with the largest income, then the older head, then the
    lower line claims. Whoever is not claimed is a unit of their own.

    By default ``child`` is being under ``adult_age``, ``relative`` holds for all, ``kin`` and ``reference`` for none.
    Everything happens in one grouping per household (whose members are a short list), with no join. A line that occurs
    twice in a household is an error of the data: the first in order of age counts for pointers.
    """
    no = F.lit(False)
    parents = F.array_compact(F.array(F.col(parent).cast("int"), *([F.col(parent2).cast("int")] if parent2 else [])))
    test = lambda c, default: F.coalesce(c if c is not None else default, no)
    p = F.struct(
        F.col(line).cast("int").alias("l"), F.col(spouse).cast("int").alias("s"), parents.alias("ps"), F.col(age).cast("double").alias("a"),
        (F.coalesce(F.col(income).cast("double"), F.lit(0.0)) if income else F.lit(0.0)).alias("i"), F.coalesce(F.col(age) >= adult_age, no).alias("adult"),
        test(reference, no).alias("ref"), test(child, F.col(age) < adult_age).alias("child"), test(relative, F.lit(True)).alias("rel"), test(kin, no).alias("kin"),
    )
    h = person.groupBy(F.col(household).alias("h")).agg(F.array_sort(F.collect_list(p)).alias("p"))  # a household's members
    mate = lambda x: F.get(F.filter("p", lambda y: (y["l"] == x["s"]) & (y["s"] == x["l"]) & (y["l"] != x["l"])), F.lit(0))

    def lead(x: Column, m: Column) -> Column:
        older = (x["a"] > m["a"]) | ((x["a"] == m["a"]) & (x["l"] < m["l"]))
        return F.when(x["ref"], x["l"]).when(m["ref"], m["l"]).when(F.coalesce(older, x["l"] < m["l"]), x["l"]).otherwise(m["l"])

    own = F.transform("p", lambda x: F.struct(x.alias("x"), mate(x).alias("m")))
    h = h.withColumn("q", own).withColumn("q", F.transform("q", lambda z: F.struct(
        z["x"].alias("x"), z["m"].isNotNull().alias("paired"), F.when(z["m"].isNotNull(), lead(z["x"], z["m"])).when(z["x"]["adult"], z["x"]["l"]).alias("own"),
        F.coalesce(z["m"]["i"], F.lit(0.0)).alias("mi"), F.coalesce(z["m"]["ref"], no).alias("mref"), F.when(z["m"].isNotNull(), F.array(z["x"]["l"], z["m"]["l"])).otherwise(F.array(z["x"]["l"])).alias("lines"))))
    led = F.filter("q", lambda z: z["own"] == z["x"]["l"])
    h = h.withColumn("u", F.transform(led, lambda z: F.struct((z["x"]["i"] + z["mi"]).alias("i"), z["x"]["a"].alias("a"), (-F.array_min(z["lines"])).alias("o"), z["x"]["l"].alias("k"), z["lines"].alias("lines"), (z["x"]["ref"] | z["mref"]).alias("ref"))))

    def best(found: Column) -> Column:
        return F.array_max(F.transform(found, lambda u: F.struct(u["i"].alias("i"), u["a"].alias("a"), u["o"].alias("o"), u["k"].alias("k"))))["k"]

    ordered = lambda cond: F.array_sort(F.transform(F.filter("q", cond), lambda z: F.struct(z["x"]["a"].alias("a"), z["x"]["l"].alias("l"), z["x"].alias("x"))))
    none = F.array().cast("array<struct<f:int,t:int>>")

    def claim(acc: Column, z: Column) -> Column:
        x = z["x"]
        may = F.filter("u", lambda u: ~F.exists(acc, lambda c: c["f"] == u["k"]) & (u["k"] != x["l"]) & F.arrays_overlap(u["lines"], x["ps"]))
        to = F.when(x["child"], best(may))
        return F.when(to.isNotNull(), F.concat(acc, F.array(F.struct(x["l"].alias("f"), to.alias("t"))))).otherwise(acc)

    h = h.withColumn("first", F.aggregate(ordered(lambda z: z["x"]["adult"] & ~z["paired"]), none, claim))
    follow = lambda k: F.aggregate(F.sequence(F.lit(1), F.greatest(F.size("first"), F.lit(1))), k, lambda cur, _: F.coalesce(F.get(F.filter("first", lambda c: c["f"] == cur), F.lit(0))["t"], cur))
    h = h.withColumn("left", F.filter("u", lambda u: ~F.exists("first", lambda c: c["f"] == u["k"])))

    def second(x: Column) -> Column:
        of_parents = best(F.filter("left", lambda u: F.arrays_overlap(u["lines"], x["ps"])))
        of_reference = best(F.filter("left", lambda u: u["ref"]))
        lone, small = F.size(x["ps"]) == 0, F.coalesce(x["a"] < young, no)
        return F.coalesce(F.when(x["child"], F.coalesce(of_parents, F.when(lone & small, of_reference))), F.when(x["rel"], F.coalesce(of_parents, F.when((x["kin"] | lone) & small, of_reference))))

    unit = lambda z: F.when(z["paired"], z["own"]).when(z["x"]["adult"], follow(z["x"]["l"])).otherwise(F.coalesce(second(z["x"]), z["x"]["l"]))
    each = F.transform("q", lambda z: F.struct(z["x"]["l"].alias("l"), unit(z).alias("unit"), z["paired"].alias("paired")))
    out = h.select("h", F.explode(each).alias("e")).select("h", "e.*")
    role = F.when(F.col("unit") == F.col("l"), "head").when(F.col("paired"), "spouse").otherwise("dependant")
    return out.select(F.col("h").alias(household), F.col("l").alias(line), F.col("unit").alias("unit_line"), role.alias("role"))
