"""Checks of tables, constraints, targets and results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def inconsistent_constraints(constraints: DataFrame) -> DataFrame:
    """Per stratum and variable the first problem of its constraint set, if any."""
    o, x = F.col("operation"), F.col("value").try_cast("double")
    has = lambda *ops: F.max(o.isin(*ops))
    g = constraints.groupBy("stratum_id", "variable").agg(
        (has("==", "!=") & (F.count_distinct(o) > 1)).alias("mixed"), (has(">") & has(">=")).alias("two_low"), (has("<") & has("<=")).alias("two_high"),
        F.coalesce(F.max(F.when(o.isin(">", ">="), x)), F.lit(float("-inf"))).alias("lo"), F.coalesce(F.min(F.when(o.isin("<", "<="), x)), F.lit(float("inf"))).alias("hi"),
        (has(">=") & has("<=")).alias("closed"),
    )
    empty = (F.col("lo") > F.col("hi")) | ((F.col("lo") == F.col("hi")) & ~F.col("closed"))
    problem = F.when(F.col("mixed"), "equality combined").when(F.col("two_low"), "two lower bounds").when(F.col("two_high"), "two upper bounds").when(empty, "empty range")
    return g.select("stratum_id", "variable", problem.alias("problem")).where(F.col("problem").isNotNull())


def sanity(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One pass over ``df``: ``check, status, failing`` for conditions that no row may meet."""
    agg = df.agg(*[F.sum(F.coalesce(c, F.lit(False)).cast("long")).alias(f"_{i}") for i, c in enumerate(checks.values())])
    long = agg.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.coalesce(F.col(f"_{i}"), F.lit(0)).alias("failing")) for i, n in enumerate(checks)])).alias("x")).select("x.*")
    return long.withColumn("status", F.when(F.col("failing") == 0, "PASS").otherwise("FAIL"))


def structural(
    tables: dict[str, DataFrame], keys: dict[str, str], *, not_negative: dict[str, list[str]] | None = None, finite: dict[str, list[str]] | None = None, flags: dict[str, list[str]] | None = None,
    parents: list[tuple[str, str, str]] | None = None, ranges: dict[tuple[str, str, str], tuple[float, float]] | None = None,
) -> DataFrame:
    """The structural suite of a dataset: ``check, status, failing``.

    ``keys`` names each table's id, which must be unique; columns that must not be negative, must be finite (null, NaN and
    infinities fail) or must hold 0 or 1 (or booleans); ``parents`` are (child table, key, parent table) that must
    resolve; ``ranges`` gives per (table, column, entity table) the bounds of the column's total per entity, outside of
    which the status is ``WARN``. A table or column that is not there is ``SKIP``. One pass per table for its columns, one
    grouping per id, one anti join per parent.
    """
    out: list[DataFrame] = []
    spark = next(iter(tables.values())).sparkSession
    skipped: list[str] = []
    has = lambda t, c: t in tables and c in tables[t].columns

    def result(df: DataFrame, name: str, bad: str = "FAIL") -> DataFrame:
        return df.select(F.lit(name).alias("check"), F.when(F.col("n") == 0, "PASS").otherwise(bad).alias("status"), F.col("n").cast("long").alias("failing"))

    for t, df in tables.items():
        tests = {}
        for kind, columns in (("not negative", not_negative), ("finite", finite), ("flag", flags)):
            for c in (columns or {}).get(t, []):
                if not has(t, c):
                    skipped.append(f"{kind} {t}.{c}")
                    continue
                x = F.col(c)
                d = x.cast("double")
                tests[f"{kind} {t}.{c}"] = d < 0 if kind == "not negative" else (d.isNull() | F.isnan(d) | (F.abs(d) == float("inf"))) if kind == "finite" else ~F.coalesce(d.isin(0.0, 1.0), F.lit(False))
        if tests:
            long = sanity(df, tests)
            out.append(long.select("check", "status", F.col("failing").cast("long").alias("failing")))
    for t, k in keys.items():
        if has(t, k):
            out.append(result(duplicate_keys(tables[t], [k]).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")), f"unique {t}.{k}"))
        else:
            skipped.append(f"unique {t}.{k}")
    for child, k, parent in parents or []:
        if has(child, k) and has(parent, k):
            lost = tables[child].where(F.col(k).isNotNull()).join(tables[parent].select(k), k, "left_anti")
            out.append(result(lost.agg(F.count(F.lit(1)).alias("n")), f"{child} in {parent} by {k}"))
        else:
            skipped.append(f"{child} in {parent} by {k}")
    for (t, c, entity), (lo, hi) in (ranges or {}).items():
        if has(t, c) and entity in tables:
            total = tables[t].agg(F.sum(F.col(c).cast("double")).alias("s")).join(F.broadcast(tables[entity].agg(F.count(F.lit(1)).alias("k"))), F.lit(True))  # one row each
            out.append(result(total.select((~F.coalesce((F.col("s") / F.col("k")).between(lo, hi), F.lit(False))).cast("long").alias("n")), f"{t}.{c} per {entity}", "WARN"))
        else:
            skipped.append(f"{t}.{c} per {entity}")
    done = spark.createDataFrame([(x, "SKIP", 0) for x in skipped], "check string, status string, failing long")
    for df in out:
        done = done.unionByName(df)
    return done


def area_validation(simulated: DataFrame, targets: DataFrame, on: list[str], ceilings: dict[str, float] | None = None, training: Column | None = None, tol: float = 0.1) -> DataFrame:
    """Simulated against target values per area and variable: both, the errors, and whether a ceiling is broken.

    ``simulated`` has ``on`` and ``sim``, ``targets`` has ``on``, ``level`` and ``target``; ``ceilings`` gives the largest
    plausible magnitude by level. Targets without a simulated value count as missing, and the other way round.
    """
    j = targets.join(simulated, on, "full_outer")
    cap = F.try_element_at(F.create_map(*[F.lit(x) for kv in ceilings.items() for x in kv]), F.col("level")) if ceilings else F.lit(None).cast("double")
    rel = F.when(F.col("target") != 0, (F.col("sim") - F.col("target")) / F.abs(F.col("target")))
    status = F.when(F.col("sim").isNull() | F.col("target").isNull(), "missing").when(F.coalesce(F.abs("sim") > cap, F.lit(False)), "implausible").when(F.coalesce(F.abs(rel) <= tol, F.col("sim") == 0), "ok").otherwise("off")
    return j.select(*on, "level", "sim", "target", (F.col("sim") - F.col("target")).alias("error"), rel.alias("relative_error"), status.alias("status"), (training if training is not None else F.lit(None).cast("boolean")).alias("in_training"))


def additive(parts: DataFrame, wholes: DataFrame, key: str, value: str, tol: float = 1e-6) -> DataFrame:
    """Wholes against the sum of their parts: ``key, by_parts, n_parts, whole, gap, adds_up``; either side may lack a key."""
    s = parts.groupBy(key).agg(F.sum(value).alias("by_parts"), F.count(F.lit(1)).alias("n_parts"))
    w = wholes.groupBy(key).agg(F.sum(value).alias("whole"))
    j = s.join(w, key, "full_outer")
    gap = F.coalesce("by_parts", F.lit(0.0)) - F.coalesce("whole", F.lit(0.0))
    return j.select(key, "by_parts", F.coalesce("n_parts", F.lit(0)).alias("n_parts"), "whole", gap.alias("gap"), (F.abs(gap) <= tol * F.greatest(F.abs(F.coalesce("whole", F.lit(0.0))), F.lit(1.0))).alias("adds_up"))


def hierarchy(strata: DataFrame, expected: dict[str, int] | None = None) -> DataFrame:
    """Per level of geographic strata: ``geo_level, n, expected, as_expected, under_parent``.

    ``strata``: ``stratum_id, parent_stratum_id, geo_level, geographic_id``. A state belongs under the nation and a
    district under its own state (number // 100); ``under_parent`` counts those that do, the nation counting as such
    without a parent.
    """
    up = strata.select(F.col("stratum_id").alias("parent_stratum_id"), F.col("geo_level").alias("up_level"), F.col("geographic_id").alias("up_id"))
    j = strata.join(up, "parent_stratum_id", "left")
    n, m = F.col("geographic_id").try_cast("int"), F.col("up_id").try_cast("int")
    fits = F.when(F.col("geo_level") == "national", F.col("parent_stratum_id").isNull()).when(F.col("geo_level") == "state", F.col("up_level") == "national").otherwise((F.col("up_level") == "state") & (F.floor(n / 100) == m))
    per = j.groupBy("geo_level").agg(F.count_distinct("geographic_id").alias("n"), F.sum(F.coalesce(fits, F.lit(False)).cast("long")).alias("under_parent"))
    want = F.try_element_at(F.create_map(*[F.lit(x) for kv in expected.items() for x in kv]), F.col("geo_level")).cast("long") if expected else F.lit(None).cast("long")
    return per.select("geo_level", "n", want.alias("expected"), (F.col("n") == want).alias("as_expected"), "under_parent")


def containment(strata: DataFrame, constraints: DataFrame) -> DataFrame:
    """What a stratum's constraints break of its parent's: ``stratum_id, variable, operation, parent_value, problem``.

    A child must have all constraints of its parent, values being compared as numbers where both are (so zeros in front
    do not count); a constraint on the state is also kept by a district of that state (number // 100), and broken as
    ``district outside state`` by another one.
    """
    key = lambda v: F.coalesce(v.try_cast("double").cast("string"), v)
    p = strata.where(F.col("parent_stratum_id").isNotNull()).select("stratum_id", "parent_stratum_id").join(constraints.select(F.col("stratum_id").alias("parent_stratum_id"), "variable", "operation", F.col("value").alias("parent_value")), "parent_stratum_id")
    d = constraints.where((F.col("variable") == "congressional_district_geoid") & (F.col("operation") == "==")).groupBy("stratum_id").agg(F.max(F.col("value").try_cast("int")).alias("_d"))
    own = constraints.select("stratum_id", "variable", "operation", key(F.col("value")).alias("_k"), F.lit(True).alias("_has")).distinct()
    j = p.withColumn("_k", key(F.col("parent_value"))).join(own, ["stratum_id", "variable", "operation", "_k"], "left").join(d, "stratum_id", "left")
    of_state = (F.col("variable") == "state_fips") & (F.col("operation") == "==") & F.col("_d").isNotNull()
    inside = F.coalesce(F.floor(F.col("_d") / 100) == F.col("parent_value").try_cast("int"), F.lit(False))
    problem = F.when(of_state & ~inside, "district outside state").when(F.col("_has").isNull() & ~(of_state & inside), "missing")
    return j.select("stratum_id", "variable", "operation", "parent_value", problem.alias("problem")).where(F.col("problem").isNotNull())


def contract(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Each column's values against its entity's number: ``entity, column_name, n_values, n_rows, n_keys, complete``; one pass per table."""
    out = None
    for entity, (df, key) in tables.items():
        names = df.columns
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"), *[F.count(F.col(c)).alias(f"v{i}") for i, c in enumerate(names)])
        long = one.select("n_rows", "n_keys", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"v{i}").alias("n_values")) for i, c in enumerate(names)])).alias("x"))
        part = long.select(F.lit(entity).alias("entity"), "x.column_name", "x.n_values", "n_rows", "n_keys", ((F.col("x.n_values") == F.col("n_rows")) & (F.col("n_rows") == F.col("n_keys"))).alias("complete"))
        out = part if out is None else out.unionByName(part)
    return out


def achievement(estimates: DataFrame, category: str = "category") -> DataFrame:
    """Two datasets' estimates against the same targets, per category: ``n, share_a_better, mean_gain``, the gain being the fall of the absolute relative error.

    ``estimates``: the category, ``target``, ``a`` and ``b``; targets of zero are left out.
    """
    err = lambda x: F.abs((F.col(x) - F.col("target")) / F.col("target"))
    e = estimates.where(F.col("target") != 0).select(category, err("a").alias("ea"), err("b").alias("eb"))
    return e.groupBy(category).agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("ea") < F.col("eb")).cast("double")).alias("share_a_better"), F.avg(F.col("eb") - F.col("ea")).alias("mean_gain"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def buckets_cover(df: DataFrame, group: list[str], lower: str, upper: str) -> DataFrame:
    """Whether the buckets of each group partition the whole line."""
    from pyspark.sql import Window

    w = Window.partitionBy(*group).orderBy(lower)
    j = df.withColumn("_next", F.lead(lower).over(w)).withColumn("_prev", F.lag(upper).over(w))
    bad = (F.col("_next").isNotNull() & (F.col("_next") != F.col(upper))) | (F.col("_next").isNull() & (F.col(upper) != float("inf"))) | (F.col("_prev").isNull() & (F.col(lower) != float("-inf")))
    return j.groupBy(*group).agg(F.count(F.lit(1)).alias("n_buckets"), (~F.max(bad)).alias("covers"))
