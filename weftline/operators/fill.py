"""Filling missing values from similar records, by hierarchical group statistics.

For every field, each level of a hierarchy (here same person, same industries and year, any of the industries,
snapshot, all) gets its support and its statistic: the median of numbers, the mode of categories. A missing cell takes
the statistic of the finest level with at least that level's required support; the level is stored beside the value.

Statistics come from (level, group, value) counts, which combine map-side and are bounded by the number of different
real values, so a group holding a third of all rows is one small histogram. A record of several industries counts
under each of them and is filled from the merged histograms of all of them. Medians are the lower median. A field may
move with another column at some levels: a person's age is carried as a birth year (snapshot year minus age).

The statistics of all coarse levels are resolved once per distinct combination of their keys; a row meets one resolved
combination and the statistics of its fine group, two joins in all.

Defined results: unreal cells (null, NaN, blank, stand-ins, out of range) are missing and always flagged, with level
``none`` when no group has support; repeated rows of a record count once per different content; modes tie to the
smallest value; null groups (no alias, industry or date) do not serve; empty tables give an empty table.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.session import cut

#: Levels from fine to coarse with the support each requires.
LEVELS = {"person": 1, "industry_year": 5, "industry": 5, "snapshot": 5, "all": 1}
#: Most combinations of coarse keys that are broadcast (about 200 bytes each); beyond it they are joined with salts.
BROADCAST_COMBINATIONS = 50_000
#: Copies of each combination in that join, so that a hot combination's rows are filled by many tasks.
SALTS = 16
# Words of which a marital status holds at least one.
STATUS_WORDS = "married|single|divorced|widow|separated|engaged|relationship|partner|annulled|cohabit|civil union|common.law"


@dataclass(frozen=True)
class Field:
    """A field to fill: ``kind`` is ``median`` (whole numbers) or ``mode``; ``type`` the type of the result.

    At the (fine) levels ``moving`` the statistic is taken of ``origin - value`` and given back as ``origin - statistic``, if
    that lies within ``bounds``.
    """

    name: str
    kind: str
    type: str
    origin: str | None = None
    moving: tuple[str, ...] = ()
    bounds: tuple[int, int] | None = None


@dataclass(frozen=True)
class Level:
    """A level: the column that names a row's group (text, or an array of texts whose groups are merged) and its support.

    ``fine`` levels have about as many groups as there are entities; the others are resolved per combination.
    """

    name: str
    column: str
    support: int
    fine: bool = False


def real_age(age: Column) -> Column:
    a = age.cast("string").try_cast("double")
    return F.when((a >= 1) & (a <= 120), a)


def real_children(text: Column) -> Column:
    c = F.trim(text.cast("string")).try_cast("double")
    return F.when((c >= 0) & (c <= 30) & (c == F.floor(c)), c.cast("int"))


def real_status(text: Column) -> Column:
    t = F.initcap(F.regexp_replace(F.lower(F.trim(text.cast("string"))), r"\s+", " "))
    return F.when(F.lower(t).rlike(STATUS_WORDS), t)


def person_key(alias: Column) -> Column:
    k = F.regexp_replace(F.lower(F.trim(alias)), r"[^a-z0-9À-￿]+", "-")
    return F.when(F.length(k) > 0, k)


#: The fields and the hierarchy of wealth records.
FIELDS = (Field("age", "median", "double", "year", ("person",), (1, 120)), Field("children", "median", "int"), Field("marital_status", "mode", "string"))


def hierarchy(levels: dict[str, int] = LEVELS) -> list[Level]:
    columns = {"person": "person", "industry_year": "industries_year", "industry": "inds", "snapshot": "snapshot", "all": "everything"}
    return [Level(n, columns[n], k, n == "person") for n, k in levels.items()]


def fill_records(df: DataFrame, levels: dict[str, int] = LEVELS) -> DataFrame:
    """Wealth records: one row per stored row, ``record_id, snapshot_date``, the three fields filled, and ``<field>_level``.

    ``<field>_level`` is null for a cell that was real, else the level it was filled from or ``none``.
    """
    inds = F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.lower(F.coalesce("industry", F.lit(""))), r"\|"), F.trim), lambda x: x != "")))
    year = F.substring("snapshot_date", 1, 4).try_cast("int")
    base = df.select(
        F.col("record_id").cast("long").alias("record_id"), F.col("snapshot_date").alias("snapshot_date"), year.alias("year"), person_key(F.col("alias")).alias("person"), inds.alias("inds"),
        real_age(F.col("age")).alias("age"), real_children(F.col("children")).alias("children"), real_status(F.col("marital_status")).alias("marital_status"),
    )
    keyed = base.select("*", F.when(F.size("inds") > 0, F.concat_ws("@", F.array_join("inds", "|"), F.col("year"))).alias("industries_year"), F.col("year").cast("string").alias("snapshot"), F.lit("*").alias("everything"))
    return fill_fields(keyed, ["record_id", "snapshot_date"], FIELDS, hierarchy(levels))


def _is_array(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() == "array"


def _set_key(column: str) -> Column:
    """An array of groups as one text; a separator within a group is escaped."""
    return F.when(F.size(column) > 0, F.array_join(F.transform(column, lambda x: F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))), "|"))


def group_statistics(base: DataFrame, fields: tuple[Field, ...], levels: list[Level]) -> DataFrame:
    """``level, grp, field, support, stat``: the median or mode of each group, as text; merged groups under their set's text."""
    def stored(f: Field, moved: bool) -> Column:
        v = F.col(f.origin) - F.col(f.name).cast("int") if moved else F.col(f.name).cast("int") if f.kind == "median" else F.col(f.name)
        return v.cast("string")

    def entry(level: int, grp: Column) -> Column:
        moved = levels[level].name
        cells = F.array(*[F.struct(F.lit(j).alias("field"), stored(f, moved in f.moving).alias("v")) for j, f in enumerate(fields)])
        return F.struct(F.lit(level).alias("level"), grp.alias("grp"), cells.alias("cells"))

    arrays = {l.column for l in levels if _is_array(base, l.column)}
    entries = F.concat(*[F.transform(l.column, functools.partial(entry, i)) if l.column in arrays else F.array(entry(i, F.col(l.column))) for i, l in enumerate(levels)])
    counts = (
        base.distinct().select(F.explode(entries).alias("e")).where(F.col("e.grp").isNotNull()).select("e.level", "e.grp", F.explode("e.cells").alias("c")).select("level", "grp", "c.field", "c.v")
        .where(F.col("v").isNotNull()).groupBy("level", "grp", "field", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    if arrays:
        counts = cut(counts)  # at most one row per group and value, read once more for each merged level
    merged = [i for i, l in enumerate(levels) if l.column in arrays]
    parts = [counts.where(~F.col("level").isin(merged)) if merged else counts]
    for i in merged:
        sets = base.select(F.col(levels[i].column).alias("members")).where(F.size("members") > 0).distinct().select(_set_key("members").alias("set"), F.explode("members").alias("grp"))
        parts.append(counts.where(F.col("level") == i).join(sets, "grp").groupBy("level", F.col("set").alias("grp"), "field", "v").agg(F.sum("n").alias("n")))
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    num = F.col("v").try_cast("int")
    whole = Window.partitionBy("level", "grp", "field")
    ranked = counts.withColumn("upto", F.sum("n").over(whole.orderBy(num, "v"))).withColumn("support", F.sum("n").over(whole))
    median = F.min(F.when(F.col("upto") * 2 >= F.col("support"), num))
    mode = F.min(F.struct((-F.col("n")).alias("o"), F.col("v").alias("v")))["v"]
    modes = [j for j, f in enumerate(fields) if f.kind == "mode"]
    stat = F.when(F.col("field").isin(modes), F.col("mode")).otherwise(F.col("median").cast("string")) if modes else F.col("median").cast("string")
    return ranked.groupBy("level", "grp", "field").agg(F.first("support").alias("support"), median.alias("median"), mode.alias("mode")).select("level", "grp", "field", "support", stat.alias("stat"))


def fill_fields(base: DataFrame, keep: list[str], fields: tuple[Field, ...], levels: list[Level]) -> DataFrame:
    """Fill the nulls of ``fields`` from the finest of ``levels`` with support: ``keep``, the fields and ``<field>_level``.

    ``base`` has the fields (null where missing) and the levels' columns. ``levels`` go from fine to coarse.
    """
    if any(l.name in f.moving and not l.fine for f in fields for l in levels):
        raise ValueError("fields move at fine levels only")
    stats = group_statistics(base, fields, levels)
    need = F.create_map(*[F.lit(x) for i, l in enumerate(levels) for x in (i, l.support)])
    usable = stats.where(F.col("support") >= F.try_element_at(need, F.col("level"))).select("level", "grp", "field", "stat")
    group_of = lambda l: _set_key(l.column) if _is_array(base, l.column) else F.col(l.column)
    missing = F.lit(False)
    for f in fields:
        missing = missing | F.col(f.name).isNull()
    coarse = [(i, l) for i, l in enumerate(levels) if not l.fine]
    wanting = base.where(missing).select("*", *[group_of(l).alias(f"g{i}") for i, l in enumerate(levels)])
    usable = cut(usable)  # one row per group and field, read by each join below
    best = {f.name: F.min(F.when(F.col("field") == j, F.struct("level", "stat"))).alias(f"best{j}") for j, f in enumerate(fields)}
    out = wanting
    if coarse:
        keys = [f"g{i}" for i, _ in coarse]
        combos = wanting.select(*keys).distinct()
        asked = combos.select(*keys, F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.col(f"g{i}").alias("grp")) for i, _ in coarse])).alias("e")).select(*keys, "e.*")
        found = cut(asked.join(usable, ["level", "grp"]).groupBy(*keys).agg(*best.values()))
        found = found.select(*[F.col(k).alias(f"to_{k}") for k in keys], *[F.col(f"best{j}").alias(f"coarse{j}") for j in range(len(fields))])
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"to_{k}"))
        if found.count() <= BROADCAST_COMBINATIONS:
            out = out.join(F.broadcast(found), same, "left")
        else:
            salted = found.withColumn("to_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            out = out.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).join(salted, same & (F.col("salt") == F.col("to_salt")), "left")
    for i, l in enumerate(levels):
        if l.fine:  # a null group is scattered, a hot one left to the adaptive skew join
            per = usable.where(F.col("level") == i).groupBy(F.col("grp").alias(f"to{i}")).agg(*[b.alias(f"fine{i}_{j}") for j, b in enumerate(best.values())])
            key = F.coalesce(F.col(f"g{i}"), F.concat(F.lit("\x00"), F.monotonically_increasing_id().cast("string")))
            out = out.withColumn("key", key).join(per, F.col("key") == F.col(f"to{i}"), "left").drop("key")
    done, flags = [F.col(k) for k in keep], []
    for j, f in enumerate(fields):
        values, names = [], []
        for i, l in enumerate(levels):
            pick = F.col(f"fine{i}_{j}") if l.fine else F.when(F.col(f"coarse{j}")["level"] == i, F.col(f"coarse{j}"))
            v = pick["stat"]
            if l.name in f.moving:
                back = F.col(f.origin) - v.try_cast("int")
                v = F.when(back.between(*f.bounds), back.cast("string")) if f.bounds else back.cast("string")
            values.append(v)
            names.append(F.when(v.isNotNull(), l.name))
        done.append(F.coalesce(F.col(f.name), F.coalesce(*values).try_cast(f.type)).alias(f.name))
        flags.append(F.when(F.col(f.name).isNull(), F.coalesce(*names, F.lit("none"))).alias(f"{f.name}_level"))
    whole = base.where(~missing).select(*keep, *[f.name for f in fields], *[F.lit(None).cast("string").alias(f"{f.name}_level") for f in fields])
    return out.select(*done, *flags).unionByName(whole)


def filled_cells(filled: DataFrame, fields: tuple[Field, ...] = FIELDS, key: str = "record_id") -> DataFrame:
    """The distinct filled (or unfillable) cells: ``key, field_name, level``."""
    cells = F.array(*[F.struct(F.lit(f.name).alias("field_name"), F.col(f"{f.name}_level").alias("level")) for f in fields])
    return filled.select(key, F.explode(cells).alias("c")).select(key, "c.*").where(F.col("level").isNotNull()).distinct()
