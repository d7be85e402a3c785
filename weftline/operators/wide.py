"""Attribute-value rows into one wide row per entity.

Each cell (entity, variable, operator) is first resolved with map-side combining to its latest readable value, its
number of different values and its last unreadable text. An entity's resolved cells then go into one key-value map,
from which the known keys are projected into typed columns and the cells that could not be filled cleanly are kept
with the text that failed. An entity collects at most one entry per distinct cell, however many rows it has.

Defined results: entities are positive ids; names are trimmed and lower-cased, ``=`` is ``==``; rows without variable
or operator are no cells; a conflicting cell is filled with its latest readable value (ties: highest row id, then
value) and reported; an unreadable cell is null in its column and reported; empty tables give an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The variables by type, and the operators with the suffix of their columns. All other variables are doubles.
INTEGERS = ("state_fips", "congressional_district_geoid", "age", "eitc_child_count")
TEXTS = ("ucgid_str",)
BOOLEANS = ("tax_unit_is_filer", "medicaid_enrolled", "used_aca_ptc", "is_pregnant", "tax_unit_itemizes", "is_aca_ptc_eligible")
DOUBLES = ("adjusted_gross_income", "tanf", "aca_ptc", "snap", "selected_marketplace_plan_benchmark_ratio")
OPERATORS = {"==": "eq", ">": "gt", ">=": "ge", "<": "lt", "<=": "le", "!=": "ne"}
TYPES = {v: t for t, names in (("bigint", INTEGERS), ("string", TEXTS), ("boolean", BOOLEANS), ("double", DOUBLES)) for v in names}

BLANKS = " \t\n\r\f\v\u00a0\u2009\u202f"
#: One number: sign, currency sign, plain or grouped digits, fraction, exponent.
NUMBER = r"^[+-]?[$€£]?(?:\d{1,3}(?:[, _\u00a0\u2009\u202f']\d{3})+|\d+)(?:\.\d*)?(?:e[+-]?\d+)?$|^[+-]?[$€£]?\.\d+(?:e[+-]?\d+)?$"
INFINITY = r"^[+-]?(?:inf|infinity|∞)$"


def read_number(text: Column) -> Column:
    """The double that ``text`` writes, or null."""
    return _number(F.lower(F.trim(text, F.lit(BLANKS))))


def _number(low: Column) -> Column:
    plain = F.regexp_replace(low, r"[$€£, _\u00a0\u2009\u202f']", "").try_cast("double")
    signed = F.when(low.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(low.rlike(INFINITY), signed).when(low.rlike(NUMBER), plain + F.lit(0.0))


def canonical(df: DataFrame, variable: str, text: str, types: dict[str, str] = TYPES) -> DataFrame:
    """``df`` with ``canon``: ``text`` read as the type of ``variable`` and written in one way, or null if it cannot be read.

    Each step is a projection of its own, so that a text is trimmed and its number parsed once per row.
    """
    of = lambda t: [v for v, k in types.items() if k == t]
    v, t, low, n = F.col(variable), F.col("_t"), F.col("_low"), F.col("_n")
    d = df.withColumn("_t", F.trim(F.col(text), F.lit(BLANKS))).withColumn("_low", F.lower("_t"))
    d = d.withColumn("_n", F.when(~v.isin(*of("string"), *of("boolean")), _number(low)))
    digits = F.when((F.abs(n) < 9e18) & (n == F.floor(n)), n.cast("decimal(20,0)").cast("string"))
    plain = F.when(F.abs(n) < 1e15, F.coalesce(digits, n.cast("string"))).otherwise(n.cast("string"))
    flag = F.when(low.isin("1", "true", "yes", "1.0"), "true").when(low.isin("0", "false", "no", "0.0"), "false")
    canon = F.when(v.isin(*of("bigint")), digits).when(v.isin(*of("string")), F.when(t != "", t)).when(v.isin(*of("boolean")), flag).otherwise(plain)
    return d.withColumn("canon", canon).drop("_t", "_low", "_n")


def resolve_cells(rows: DataFrame, entity: str, variable: str, operation: str, value: str, row_id: str, loaded_at: str, types: dict[str, str] = TYPES) -> DataFrame:
    """One row per cell: ``entity_id, variable, operation, resolved, n_values (0, 1 or 2 for more), unreadable, has_bad``.

    ``types`` gives each variable's type (``bigint``, ``double``, ``boolean`` or ``string``); others are doubles.
    """
    v = F.lower(F.trim(F.col(variable), F.lit(BLANKS)))
    o = F.trim(F.col(operation), F.lit(BLANKS))
    named = (
        rows.select(F.col(entity).cast("long").alias("entity_id"), v.alias("variable"), F.when(o == "=", "==").otherwise(o).alias("operation"), F.col(value).alias("text"), F.col(row_id).alias("rid"), F.col(loaded_at).alias("seen"))
        .where((F.col("entity_id") > 0) & (F.col("variable") != "") & (F.col("operation") != ""))
    )
    cells = canonical(named, "variable", "text", types)
    good, bad = F.col("canon").isNotNull(), F.col("canon").isNull()
    return (
        cells.groupBy("entity_id", "variable", "operation")
        .agg(
            F.max(F.when(good, F.struct("seen", "rid", "canon")))["canon"].alias("resolved"),
            F.min("canon").alias("low"),
            F.max("canon").alias("high"),
            F.max(F.when(bad, F.struct("seen", "rid", F.coalesce("text", F.lit("")).alias("text"))))["text"].alias("unreadable"),
            F.max(bad).alias("has_bad"),
        )
        .withColumn("n_values", F.when(F.col("low").isNull(), 0).when(F.col("low") == F.col("high"), 1).otherwise(2))
        .drop("low", "high")
    )


def column_name(variable: str, operation: str) -> str:
    return f"{variable}_{OPERATORS[operation]}"


def pair_name(variable: Column, operation: Column) -> Column:
    """The key of a cell in an entity's map; a ``|`` of the variable is escaped, so no two cells share a key."""
    return F.concat(F.replace(variable, F.lit("|"), F.lit("\\|")), F.lit("|"), operation)


def entity_maps(cells: DataFrame) -> DataFrame:
    """One key-value map per entity: ``entity_id, pairs``, from cell name to ``variable, operation, resolved, issue``.

    ``issue`` is null for a clean cell, else its last unreadable text, or ``conflict``.
    """
    issue = F.when(F.col("has_bad"), F.col("unreadable")).when(F.col("n_values") > 1, F.lit("conflict"))
    pair = F.struct(pair_name(F.col("variable"), F.col("operation")).alias("k"), F.struct("variable", "operation", "resolved", issue.alias("issue")).alias("v"))
    return cells.groupBy("entity_id").agg(F.map_from_entries(F.array_sort(F.collect_list(pair))).alias("pairs"))


def cast_failures(maps: DataFrame) -> DataFrame:
    """The cells of :func:`entity_maps` that cannot be filled cleanly: ``entity_id, variable, operation, issue``."""
    kept = F.map_filter("pairs", lambda _, v: v["issue"].isNotNull())
    return maps.select("entity_id", F.explode(F.map_values(kept)).alias("f")).select("entity_id", "f.variable", "f.operation", "f.issue")


def unclean_cells(cells: DataFrame) -> DataFrame:
    """The resolved cells that cannot be filled cleanly, read from the entities' maps."""
    return cast_failures(entity_maps(cells)).drop("issue")


def widen(cells: DataFrame, types: dict[str, str] = TYPES) -> DataFrame:
    """One row per entity: a typed column per known variable and operator, ``other_values`` and ``unfilled``.

    All are projected from the entity's map. ``unfilled`` maps each unclean cell to its issue; ``other_values`` has the
    readable cells whose variable or operator is not known. ``types`` must be those given to :func:`resolve_cells`.
    """
    maps = entity_maps(cells)
    known = [(v, o) for v in types for o in OPERATORS]
    names = [f"{v.replace('|', chr(92) + '|')}|{o}" for v, o in known]
    cols = [F.try_element_at("pairs", F.lit(k))["resolved"].try_cast(types[v]).alias(column_name(v, o)) for k, (v, o) in zip(names, known)]
    value = lambda m, part: F.transform_values(m, lambda _, v: v[part])
    rest = value(F.map_filter("pairs", lambda k, v: ~k.isin(*names) & v["resolved"].isNotNull()), "resolved")
    unfilled = value(F.map_filter("pairs", lambda _, v: v["issue"].isNotNull()), "issue")
    return maps.select("entity_id", *cols, rest.alias("other_values"), unfilled.alias("unfilled"))
