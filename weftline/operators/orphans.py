"""References to records that do not exist.

The parents' integer keys are compressed into runs: maximal stretches of consecutive keys that share one deletion
state. A reference is as-of matched to the last run that starts at or before its key; a key beyond that run's end is
an orphan. Runs never cross a block of ``RUN_BLOCK`` keys, so the as-of match is local to a block and no global order
is needed. Before the match, references are reduced to distinct keys with map-side combining, so one key that holds a
third of all references costs one row per map task.

A run carries the time at which each of its keys first appeared as an array indexed by ``key - run_start``, and the
latest of these; whether a reference came too early is read from the array by position, and only for references that
are older than the latest.

Several parent tables go through one pass: their keys are told apart by the table's name (see :func:`parent_rows`).

Defined results: a null reference is no reference; a parent row without a key is ignored; a reference or a key without
any ``loaded_at`` is never late; repeated rows count once in :func:`orphan_counts`; empty tables give empty results;
columns beyond those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.session import cut

#: Keys per block, a power of two. It bounds the rows of one as-of window and the length of a run's array.
RUN_BLOCK_BITS = 12
#: Copies of each orphan key in the join back to the rows, so that a hot orphan key is spread over as many tasks.
SALTS = 16
#: Most orphan keys that are broadcast to the referring rows (about 50 bytes each); beyond it both sides are shuffled.
BROADCAST_KEYS = 200_000


def references(df: DataFrame, table_name: str, ref_field: str, row_id: str, period: Column, loaded_at: str = "loaded_at", parent: str = "") -> DataFrame:
    """The references of one field in the common form that :func:`find_orphans` reads; ``parent`` names the table they point to."""
    return df.select(
        F.lit(table_name).alias("table_name"),
        F.lit(ref_field).alias("ref_field"),
        F.lit(parent).alias("parent"),
        F.col(row_id).cast("long").alias("row_id"),
        F.col(ref_field).cast("long").alias("ref_key"),
        F.col(loaded_at).alias("ref_loaded_at"),
        period.cast("int").alias("period"),
    ).where(F.col("ref_key").isNotNull())


def parent_rows(df: DataFrame, key: str, loaded_at: str = "loaded_at", deleted_at: str = "deleted_at", parent: str = "") -> DataFrame:
    """A parent table's rows in the common form: ``parent, k, t, alive``. Unite those of several tables for one pass."""
    return df.select(F.lit(parent).alias("parent"), F.col(key).cast("long").alias("k"), F.col(loaded_at).alias("t"), F.col(deleted_at).isNull().cast("int").alias("alive")).where(F.col("k").isNotNull())


def runs_of(rows: DataFrame) -> DataFrame:
    """Runs of consecutive keys of :func:`parent_rows`: ``parent, block, run_start, run_end, run_deleted, latest, first_loaded``.

    ``run_deleted`` holds if every row of every key in the run is deleted; ``first_loaded`` has one time per key and
    ``latest`` the last of them.
    """
    states = rows.groupBy("parent", "k").agg(F.min("t").alias("t"), (F.max("alive") == 0).alias("dead")).withColumn("block", F.shiftright("k", RUN_BLOCK_BITS))
    w = Window.partitionBy("parent", "block").orderBy("k")
    breaks = (F.col("k") - F.lag("k").over(w) != 1) | (F.col("dead") != F.lag("dead").over(w))
    numbered = states.withColumn("starts", F.coalesce(breaks, F.lit(True)).cast("int")).withColumn("run_no", F.sum("starts").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        numbered.groupBy("parent", "block", "run_no")
        .agg(F.min("k").alias("run_start"), F.max("k").alias("run_end"), F.bool_or("dead").alias("run_deleted"), F.max("t").alias("latest"), F.array_sort(F.collect_list(F.struct("k", "t"))).alias("by_key"))
        .select("parent", "block", "run_start", "run_end", "run_deleted", "latest", F.transform("by_key", lambda x: x["t"]).alias("first_loaded"))
    )


def key_runs(parents: DataFrame, key: str, loaded_at: str = "loaded_at", deleted_at: str = "deleted_at") -> DataFrame:
    """The runs of one parent table, see :func:`runs_of`."""
    return runs_of(parent_rows(parents, key, loaded_at, deleted_at)).drop("parent")


def match_runs(keys: DataFrame, runs: DataFrame) -> DataFrame:
    """As-of match of distinct ``parent, ref_key`` rows to ``runs``: adds ``run_start, run_end, run_deleted, latest`` of the last run that starts at or before the key."""
    blocked = keys.withColumn("block", F.shiftright("ref_key", RUN_BLOCK_BITS))
    marks = runs.select("parent", "block", F.col("run_start").alias("ref_key"), F.struct("run_start", "run_end", "run_deleted", "latest").alias("run"))
    both = marks.withColumn("is_ref", F.lit(0)).unionByName(blocked.withColumn("is_ref", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy("parent", "block").orderBy("ref_key", "is_ref").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("run", F.last("run", ignorenulls=True).over(w)).where("is_ref = 1").drop("is_ref").select("*", "run.*").drop("run")


def find_orphans(refs: DataFrame, parents: DataFrame, key: str, loaded_at: str = "loaded_at", deleted_at: str = "deleted_at") -> DataFrame:
    """The rows of ``refs`` (see :func:`references`) that refer to no usable row of one parent table, with ``orphan_kind``."""
    return find_in(refs, parent_rows(parents, key, loaded_at, deleted_at))


def find_in(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """The rows of ``refs`` that refer to no usable row among ``parents`` (:func:`parent_rows`), with ``orphan_kind``.

    ``missing``: no parent has the key; ``deleted``: all parents with the key are deleted; ``late``: the first parent
    with the key was loaded after the reference. Every such row is returned, repeated rows as often as they occur.
    """
    runs = cut(runs_of(parents))  # read twice below
    keys = refs.groupBy("parent", "ref_key").agg(F.min("ref_loaded_at").alias("earliest_ref"))
    at = match_runs(keys, runs.drop("first_loaded"))
    inside = F.coalesce(F.col("ref_key") <= F.col("run_end"), F.lit(False))
    early = F.col("latest").cast("timestamp_ntz") > F.col("earliest_ref").cast("timestamp_ntz")
    at = at.withColumn("state", F.when(~inside, "missing").when(F.col("run_deleted"), "deleted").when(early, "late"))
    at = cut(at.where(F.col("state").isNotNull()).select("parent", "block", "run_start", "ref_key", "earliest_ref", "state"))  # orphans, and what may be late
    gone = at.where(F.col("state") != "late").select("parent", "ref_key", "state", F.lit(None).cast("timestamp_ntz").alias("first_loaded"))
    arrays = runs.where(~F.col("run_deleted")).select("parent", "block", "run_start", F.col("first_loaded").alias("loads"))
    late = (
        at.where(F.col("state") == "late")
        .join(arrays, ["parent", "block", "run_start"])
        .select("parent", "ref_key", "state", "earliest_ref", F.expr("loads[cast(ref_key - run_start as int)]").cast("timestamp_ntz").alias("first_loaded"))
        .where(F.col("first_loaded") > F.col("earliest_ref").cast("timestamp_ntz"))
        .drop("earliest_ref")
    )
    found = cut(gone.unionByName(late))  # one row per orphan key
    if found.count() <= BROADCAST_KEYS:
        rows = refs.join(F.broadcast(found), ["parent", "ref_key"])
    else:
        salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = refs.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).join(salted, ["parent", "ref_key", "salt"])
    return (
        rows.where((F.col("state") != "late") | (F.col("first_loaded") > F.col("ref_loaded_at").cast("timestamp_ntz")))
        .select("table_name", "ref_field", "row_id", "ref_key", "period", F.col("state").alias("orphan_kind"))
    )


def orphan_counts(orphans: DataFrame) -> DataFrame:
    """Distinct referring rows per table, field, period and kind."""
    return (
        orphans.select("table_name", "ref_field", "period", "orphan_kind", "row_id")
        .distinct()
        .groupBy("table_name", "ref_field", "period", "orphan_kind")
        .agg(F.count(F.lit(1)).alias("orphan_rows"))
    )
