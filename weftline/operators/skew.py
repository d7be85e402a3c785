"""Per-key results when a few keys hold most records.

Ranks are selected exactly by refining histograms: each pass counts the rows of every open value interval in ``BINS``
bins, keeps for each wanted rank the bin that holds it and narrows the interval to that bin's observed bounds, until
the bounds meet. Only counts and bounds are shuffled; no task ever holds a hot key's values. Wanted ranks that share
an interval share its histogram, and rows outside all open intervals are dropped before anything is shuffled.

Per-key quantiles are ranks within a key. Heavy keys are found the same way with the keys themselves as values: a key
with at least ``s`` rows holds a rank that is a multiple of ``s``, so the keys at those ranks are the only candidates,
and a resolved bin's count is the key's number of rows.

Counts, sums and distinct records are aggregated in mergeable steps.

Defined results: null keys are no keys; null and NaN values count as rows but have no rank; infinities rank first or
last; a quantile is the smallest value with at least ``ceil(q * n)`` values at or below it; a key without values has
null quantiles; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.session import cut

BINS = 256
#: Most open (key, quantile) intervals that are broadcast (about 100 bytes each); beyond it the join is salted.
BROADCAST_INTERVALS = 50_000
SALTS = 32


def _whole(n: Column) -> Column:
    return F.when((n == F.floor(n)) & (n >= 0) & (n < 1e9), n.cast("long"))


def _first_district(n: Column) -> Column:
    return F.when(n == 1198, F.lit(1101).cast("long")).when(n % 100 == 0, n + 1).otherwise(n)


def district_number(cd: Column) -> Column:
    """A district written in any way as its number; district 00, and 98 in state 11, count as 01."""
    return _first_district(_whole(F.trim(cd.cast("string")).try_cast("double")))


def with_district(df: DataFrame, cd: str, name: str) -> DataFrame:
    """:func:`district_number` in steps of their own, so that a text is read once per row."""
    d = df.withColumn(name, F.trim(F.col(cd).cast("string")).try_cast("double"))
    return d.withColumn(name, _whole(F.col(name))).withColumn(name, _first_district(F.col(name)))


def keyed(df: DataFrame, keys: dict[str, Column], value: Column, record: Column | None = None) -> DataFrame:
    """One row per row and key field: ``key_field, key_value, value[, record]``. Null keys stay null."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("key_field"), c.cast("string").alias("key_value")) for n, c in keys.items()]))
    cols = [each.alias("k"), value.cast("double").alias("value")] + ([record.alias("record")] if record is not None else [])
    return df.select(*cols).select("k.*", *[c for c in ("value", "record") if c == "value" or record is not None])


def value_bounds(rows: DataFrame) -> DataFrame:
    """Per key: counts, sum and bounds of its values, the one bin from which the refinement starts."""
    v = F.when(~F.isnan("value"), F.col("value"))
    finite = F.when((v > float("-inf")) & (v < float("inf")), v)
    return rows.groupBy("key_field", "key_value").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(v).alias("total"), F.count(v).alias("n"),
        F.sum((v == float("-inf")).cast("long")).alias("n_low"), F.sum((v == float("inf")).cast("long")).alias("n_high"),
        F.min(finite).alias("lo"), F.max(finite).alias("hi"),
    )


def heavy_keys(rows: DataFrame, shares: dict[str, float], bins: int = BINS) -> DataFrame:
    """Keys that hold at least ``shares[key_field]`` of all rows: ``key_field, key_value, n_rows, all_rows``.

    ``rows`` has ``key_field`` and ``key_value`` (as :func:`keyed` gives them, with whole numbers as keys); null keys
    count in the total. The keys are ranked as numbers, and those at every ``ceil(share * all rows)``-th rank selected.
    """
    ranked = rows.select("key_field", F.lit("").alias("key_value"), F.col("key_value").try_cast("double").alias("value"))
    bounds = cut(value_bounds(ranked))  # one row per key field
    share = F.try_element_at(F.create_map(*[x for k, v in shares.items() for x in (F.lit(k), F.lit(str(v)).cast("decimal(18,12)"))]), F.col("key_field"))
    part = lambda n: share * F.col(n).cast("decimal(19,0)")  # noqa: E731  exact
    step = F.greatest(F.ceil(part("n_rows")).cast("long"), F.lit(1))
    steps = bounds.withColumn("step", step).where(F.col("step") <= F.col("n"))
    wanted = steps.select("key_field", "key_value", F.explode(F.sequence(F.col("step"), F.col("n"), F.col("step"))).alias("rank"), F.lit(0).cast("long").alias("below"), "n", "lo", "hi")
    found = select_ranks(ranked, wanted, bins).select("key_field", F.col("lo").cast("long").cast("string").alias("key_value"), F.col("n").alias("n_rows")).distinct()
    totals = bounds.select(F.col("key_field").alias("f"), F.col("n_rows").alias("all_rows"))
    return (
        found.join(F.broadcast(totals), F.col("key_field") == F.col("f"))  # one row per key field named by the caller
        .where(F.col("n_rows") >= part("all_rows"))
        .select("key_field", "key_value", "n_rows", "all_rows")
    )


def distinct_records(df: DataFrame, keys: dict[str, Column], record: Column) -> DataFrame:
    """Distinct records per key, ``key_field, key_value, n_records``: distinct pairs in the columns' own types, then counts."""
    out = None
    for name, key in keys.items():
        pairs = df.select(key.alias("k"), record.alias("r")).where(F.col("k").isNotNull() & F.col("r").isNotNull()).distinct()
        part = pairs.groupBy("k").agg(F.count(F.lit(1)).alias("n_records")).select(F.lit(name).alias("key_field"), F.col("k").cast("string").alias("key_value"), "n_records")
        out = part if out is None else out.unionByName(part)
    return out


def _attach(rows: DataFrame, spans: DataFrame, n_open: int) -> DataFrame:
    if n_open <= BROADCAST_INTERVALS:
        return rows.join(F.broadcast(spans), ["key_field", "key_value"])
    return (
        rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        .join(spans.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["key_field", "key_value", "salt"])
        .drop("salt")
    )


def select_ranks(rows: DataFrame, wanted: DataFrame, bins: int = BINS) -> DataFrame:
    """The values at given ranks of each key's finite values.

    ``wanted``: ``key_field, key_value, rank, below, n, lo, hi`` and further columns to keep: the rank among the key's
    values, the number of values before ``lo``, and the number of values in ``[lo, hi]``, all of them inside. Returns
    the same columns with ``lo = hi`` the value at the rank, ``below`` the values before it and ``n`` those equal to it.
    """
    values = rows.where(F.col("key_value").isNotNull() & (F.abs("value") < float("inf"))).select("key_field", "key_value", "value")
    interval = ["key_field", "key_value", "lo", "hi"]
    spans, done = wanted, None
    while True:
        spans = cut(spans)
        is_open = F.coalesce(F.col("lo") < F.col("hi"), F.lit(False))
        closed, open_ = spans.where(~is_open), spans.where(is_open)
        done = closed if done is None else done.unionByName(closed)
        intervals = open_.select(*interval).distinct()
        n_open = intervals.count()
        if not n_open:
            return done
        width = F.col("hi") * 0.5 - F.col("lo") * 0.5
        at = F.try_divide(F.col("value") * 0.5 - F.col("lo") * 0.5, width) * bins
        slot = F.least(F.floor(F.coalesce(at, F.when(F.col("value") == F.col("hi"), F.lit(float(bins))).otherwise(F.lit(0.0)))), F.lit(bins - 1))
        hist = (
            _attach(values, intervals, n_open)
            .where((F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi")))
            .groupBy(*interval, slot.cast("int").alias("slot"))
            .agg(F.count(F.lit(1)).alias("c"), F.min("value").alias("low"), F.max("value").alias("high"))
        )
        before = F.sum("c").over(Window.partitionBy(*interval).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))  # at most one row per bin
        hist = hist.withColumn("before", F.coalesce(before, F.lit(0)))
        picked = open_.join(hist, interval).where((F.col("below") + F.col("before") < F.col("rank")) & (F.col("below") + F.col("before") + F.col("c") >= F.col("rank")))
        spans = picked.withColumns({"below": F.col("below") + F.col("before"), "n": F.col("c"), "lo": F.col("low"), "hi": F.col("high")}).select(*wanted.columns)


def quantiles(rows: DataFrame, qs: list[float], bounds: DataFrame | None = None, bins: int = BINS) -> DataFrame:
    """Exact quantiles per key: ``key_field, key_value, q, quantile``."""
    bounds = value_bounds(rows) if bounds is None else bounds
    each = bounds.where(F.col("key_value").isNotNull()).select("*", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q"))
    rank = F.greatest(F.ceil(F.col("q") * F.col("n")), F.lit(1))
    low, high = rank <= F.col("n_low"), rank > F.col("n") - F.col("n_high")
    end = F.when(F.col("n") == 0, F.lit(None)).when(low, float("-inf")).when(high, float("inf"))
    some = F.col("n") > 0
    wanted = each.select(
        "key_field", "key_value", "q", (rank - F.col("n_low")).alias("rank"), F.lit(0).cast("long").alias("below"), (F.col("n") - F.col("n_low") - F.col("n_high")).alias("n"),
        F.coalesce(end, F.when(some, F.col("lo"))).alias("lo"), F.coalesce(end, F.when(some, F.col("hi"))).alias("hi"),
    )
    return select_ranks(rows, wanted, bins).select("key_field", "key_value", "q", F.col("lo").alias("quantile"))
