"""Joins the built-in operators do not name: range, nearest, paired and checked joins.

Range and nearest joins never build a cross product: bands go to an equi-join over cells of the value axis, and
neighbours are sought block by block along an axis.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators import weights as W
from weftline.session import cut

#: Most blocks of donors along the axis of a nearest-neighbour search; their edges are broadcast (8 MB).
MOST_BLOCKS = 1_000_000
#: Donors of the largest group from which a nearest-neighbour search prunes; below, meeting all parts is quicker than asking twice.
PRUNE_FROM = 20_000
#: Most rows of a specification table (bands, rules, rates) that are broadcast; about 10 MB.
BROADCAST_ROWS = 100_000


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows, else as it is."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def lookup(df: DataFrame, other: DataFrame, on: list[str] | str, defaults: dict) -> DataFrame:
    """Left join with defaults for rows without a partner."""
    return df.join(other, on, "left").fillna(defaults)


def band_join(df: DataFrame, bands: DataFrame, x: Column, lo: str, hi: str, cell: float, keys: list[str] | None = None) -> DataFrame:
    """Rows with ``lo <= x < hi``, by equal keys only.

    A finite band lies on the level whose cells (``cell`` times a power of two) are about as wide as the band, so it
    meets at most three of them, however wide it is; a row has one cell on each level that is in use. Bands open to one
    side, a few per key, share one cell per key. Rows without ``x`` and empty bands meet nothing.
    """
    keys = keys or []
    low, high = F.coalesce(F.col(lo), F.lit(float("-inf"))), F.coalesce(F.col(hi), F.lit(float("inf")))
    finite = (low > float("-inf")) & (high < float("inf"))
    level = F.when(finite, F.greatest(F.ceil(F.log2((high - low) / cell)), F.lit(0))).otherwise(F.lit(-1)).cast("int")
    b = bands.where(high > low).withColumn("_level", level)
    size = F.lit(cell) * F.pow(F.lit(2.0), F.col("_level"))
    b = cut(b.withColumn("_cell", F.explode(F.when(F.col("_level") >= 0, F.sequence(F.floor(low / size), F.floor(high / size))).otherwise(F.array(F.lit(0).cast("long"))))))
    used = sorted(r[0] for r in b.select("_level").distinct().collect())  # some sixty at most
    if not used:
        used = [0]
    rows = df.withColumn("_x", x).where(F.col("_x").isNotNull() & ~F.isnan(F.col("_x").cast("double")))
    spots = F.array(*[F.struct(F.lit(n).alias("_level"), (F.floor(F.col("_x") / (cell * 2.0**n)) if n >= 0 else F.lit(0)).cast("long").alias("_cell")) for n in used])
    spread = rows.withColumn("_spot", F.explode(spots)).select("*", "_spot._level", "_spot._cell").drop("_spot")
    return spread.join(small(b), [*keys, "_level", "_cell"]).where((F.col("_x") >= low) & (F.col("_x") < high)).drop("_x", "_level", "_cell")


def checked_join(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """Inner join that fails on rows without a partner."""
    orphans = df.join(other.select(on), on, "left_anti").limit(1).count()
    if orphans:
        raise ValueError(f"rows without a partner on {on}")
    return df.join(other, on)


def nearest_donors(recipients: DataFrame, donors: DataFrame, rid: str, did: str, features: dict[str, float], group: str, k: int = 1, squared: bool = True, standardise: bool = True, block: int = 512, others: bool = False, prune_from: int = PRUNE_FROM) -> DataFrame:
    """For each recipient the ``k`` nearest donors of its group: ``rid, did, distance, rank`` (ties: smaller id).

    ``features`` names the columns with their weights. Distances are weighted sums of squared (or absolute) differences;
    standardised by the donors' mean and deviation (0 counts as 1), missing features counting as the mean. Recipients
    of a group without donors are matched against all donors. With ``others`` a recipient's own id is no donor for it.

    The donors of a group are cut into blocks of about ``block`` by the feature with most different values (the axis;
    larger only where there would be more than ``MOST_BLOCKS``), and donors that tie there are dealt to parts of a block.
    A recipient first meets the block it lies in; its k-th distance there bounds how far along the axis a nearer donor
    can lie, and only the blocks within are met then. Recipients come in packs of ``block`` and every (group, block,
    part) is a join key of its own, so no group is one task and no pair of rows is ever a row: an Arrow function keeps
    the ``k`` best of a pack and a part. Where no group has more than ``prune_from`` donors, each group is one block, and
    a recipient meets all its parts at once; the result is the same.
    """
    import numpy as np

    names = list(features)
    seen = donors.agg(*[F.avg(f).alias(f"m_{f}") for f in names], *[F.stddev_pop(f).alias(f"s_{f}") for f in names], *[F.approx_count_distinct(f).alias(f"n_{f}") for f in names]).first()
    axis = max(range(len(names)), key=lambda i: (seen[f"n_{names[i]}"] if features[names[i]] > 0 else -1, -i))

    def z(f: str) -> Column:
        return F.coalesce(((F.col(f) - F.lit(seen[f"m_{f}"] or 0.0)) / F.lit(seen[f"s_{f}"] or 1.0)) if standardise else F.col(f).cast("double"), F.lit(0.0))

    everyone = "\x00all"
    vec = F.array(*[z(f) for f in names])
    d = donors.select(F.col(did).alias("_id"), F.col(group).cast("string").alias("_g"), vec.alias("_v"))
    sizes = cut(d.groupBy("_g").agg(F.count(F.lit(1)).alias("_nd"), F.min("_id").alias("_one")))
    r = recipients.select(F.col(rid).alias("_id"), F.col(group).cast("string").alias("_g"), vec.alias("_v")).join(sizes, "_g", "left")
    without = F.col("_nd").isNull()
    if others:
        without = without | ((F.col("_nd") == 1) & (F.col("_one") == F.col("_id")))
    r = r.select("_id", F.when(without, F.lit(everyone)).otherwise(F.col("_g")).alias("_g"), "_v")
    if r.where(F.col("_g") == everyone).limit(1).count():
        d = d.unionByName(d.withColumn("_g", F.lit(everyone)))
        sizes = sizes.select("_g", "_nd").unionByName(sizes.agg(F.sum("_nd").alias("_nd")).select(F.lit(everyone).alias("_g"), "_nd"))
    n = sizes.agg(F.coalesce(F.sum("_nd"), F.lit(0)), F.coalesce(F.max("_nd"), F.lit(0))).first()
    block = max(block, -(-n[0] // MOST_BLOCKS))
    edges: dict[str, np.ndarray] = {}
    if n[1] > max(block, prune_from):
        points = min(4095, -(-n[1] // block) - 1)
        step = F.greatest(F.lit(1), F.floor(F.lit(points) / F.greatest(F.ceil(F.col("n") / block) - 1, F.lit(1)))).cast("int")
        cuts = d.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(F.get("_v", F.lit(axis)), F.lit([i / (points + 1) for i in range(1, points + 1)]), 10 * points).alias("e")).where(F.col("n") > block)
        kept = cuts.withColumn("step", step).select("_g", F.filter("e", lambda _, i: (i + 1) % F.col("step") == 0).alias("e"))
        edges = {x["_g"]: np.unique(np.array(x["e"], float)) for x in kept.collect()}  # at most MOST_BLOCKS numbers
    held = donors.sparkSession.sparkContext.broadcast(edges)
    spot = F.get("_v", F.lit(axis))

    @F.pandas_udf("array<long>")
    def blocks_near(g: pd.Series, x: pd.Series, reach: pd.Series) -> pd.Series:
        out = np.empty(len(g), object)
        gs, xs, rs = g.to_numpy(), x.to_numpy(float), reach.to_numpy(float)
        for name in set(gs):
            at, e = np.nonzero(gs == name)[0], held.value.get(name, np.zeros(0))
            pad = rs[at] * (1 + 1e-9) + 1e-12
            lo, hi = np.searchsorted(e, xs[at] - pad, "right"), np.searchsorted(e, xs[at] + pad, "right")
            own = np.searchsorted(e, xs[at], "right")
            for i, a, b, o, r_ in zip(at, lo, hi, own, rs[at]):
                out[i] = [int(o)] if r_ < 0 else [j for j in range(a, b + 1) if j != o]
        return pd.Series(out)

    def in_own_block(df: DataFrame) -> DataFrame:
        return df.withColumn("_b", F.get(blocks_near("_g", spot, F.lit(-1.0)), F.lit(0)) if edges else F.lit(0).cast("long"))

    entry = F.struct("_id", "_v")
    d = in_own_block(d)
    parts = cut(d.groupBy("_g", "_b").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("_parts")))
    pools = cut(d.join(parts, ["_g", "_b"]).groupBy("_g", "_b", F.pmod(F.xxhash64("_id"), F.col("_parts")).alias("_s")).agg(F.array_sort(F.collect_list(entry)).alias("_pool")))
    weights = np.array(list(features.values()), float)

    def run(batches):
        for b in batches:
            rows = []
            for ask, have in zip(b["_ask"], b["_pool"]):
                a, p = (np.array([list(x["_v"]) for x in y], float) for y in (ask, have))
                dist = np.zeros((len(a), len(p)))
                for j, w in enumerate(weights):
                    diff = a[:, j, None] - p[None, :, j]
                    dist += w * (diff * diff if squared else np.abs(diff))
                if others:
                    dist[np.array([x["_id"] for x in ask])[:, None] == np.array([x["_id"] for x in have])] = np.inf
                best = np.where(np.isnan(dist), np.inf, dist).argmin(axis=1)[:, None] if k == 1 else np.argsort(dist, axis=1, kind="stable")[:, :k]
                rows += [(x["_id"], have[j]["_id"], float(dist[i, j])) for i, x in enumerate(ask) for j in best[i] if not others or x["_id"] != have[j]["_id"]]
            yield pd.DataFrame(rows, columns=["rid", "did", "distance"])

    types = dict(recipients.dtypes)[rid], dict(donors.dtypes)[did]

    def meet(asked: DataFrame) -> DataFrame:
        """The best donors of each asked block, for rows of ``_id, _g, _v, _b``."""
        n_asked = asked.groupBy("_g", "_b").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("_packs")).join(parts, ["_g", "_b"])
        packs = asked.join(n_asked, ["_g", "_b"]).groupBy("_g", "_b", "_parts", F.pmod(F.xxhash64("_id"), F.col("_packs")).alias("_p")).agg(F.collect_list(entry).alias("_ask"))
        spread = packs.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
        return spread.join(pools, ["_g", "_b", "_s"]).select("_ask", "_pool").mapInPandas(run, f"rid {types[0]}, did {types[1]}, distance double")

    def top(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(Window.partitionBy("rid").orderBy("distance", "did"))).where(F.col("rank") <= k)

    r = in_own_block(r)
    first = top(meet(r))
    if not edges:
        return first
    first = cut(first)
    last = first.groupBy(F.col("rid").alias("_id")).agg(F.max("distance").alias("_far"), F.count(F.lit(1)).alias("_k"))
    w = features[names[axis]]
    reach = F.when((F.col("_k") == k) & F.lit(w > 0), F.sqrt(F.col("_far") / w) if squared else F.col("_far") / w)
    more = r.drop("_b").join(last, "_id", "left").select("_id", "_g", "_v", F.explode(blocks_near("_g", spot, F.coalesce(reach, F.lit(float("inf"))))).alias("_b"))
    return top(first.drop("rank").unionByName(meet(more)))


def pair_by_rank(recipients: DataFrame, donors: DataFrame, rid: str, did: str, r_order: str, d_order: str, group: str) -> DataFrame:
    """The i-th recipient of a group meets the donor at the evenly spaced position of the ordered donors (halves to even).

    Positions come from sums by value ranges, so no group is sorted in one task; the orders are numbers.
    """
    def ranked(df: DataFrame, key: str, name: str, order: str, pos: str, size: str) -> DataFrame:
        one = df.select(group, F.col(key).alias(name), F.col(order).alias("_o"))
        c = W.cumulative(one, "_o", [F.lit(1).cast("long")], [F.col(name)], [group])
        return c.select(group, name, (F.col("cum0") - 1).alias(pos), F.col("tot0").alias(size))

    r, d = ranked(recipients, rid, "rid", r_order, "i", "n"), ranked(donors, did, "did", d_order, "pos", "m")
    m = donors.groupBy(group).agg(F.count(F.lit(1)).alias("m"))
    at = F.when(F.col("n") == 1, F.lit(0)).otherwise(F.bround(F.col("i") * (F.col("m") - 1) / (F.col("n") - 1), 0)).cast("int")
    return r.join(m, group).withColumn("pos", at).join(d.select(group, "pos", "did"), [group, "pos"]).select(group, "rid", "did")
