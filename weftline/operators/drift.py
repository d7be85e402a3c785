"""Schemas that drift between the files of a feed.

Lines of delimited text are read into one table. Each file has a schema fingerprint (its headers, their meaning and
their types); a feed's version rises by one whenever the fingerprint differs from that of the file before. Between two
versions lie explicit migration steps, one record per field: ``initial``, ``added``, ``removed``, ``renamed``,
``retyped`` or ``moved``. The rules of a version (which column holds which field, of which type) are composed by
applying the steps one after the other; every ``CHAIN``-th version is a fresh start, so a chain is never longer. Each
file is routed by its version to these rules: rename, default for fields that are not there, and cast.

What the target looks like is a parameter (:class:`Target`): its fields with types, the words that mean a field,
spellings of values and defaults.

Repeated lines are combined map-side before they are shuffled; types come from counts per (file, position), so that a
file holding a third of all lines is no task's burden; lines meet their file's rules in blocks of ``LINE_BLOCK`` lines.

Defined results: lines without text or starting with ``#`` are comments; a line repeated under one ``line_no`` counts
once (the latest load); a missing cell is blank; fields of a file without non-blank cells are integers; a second
column that means the same field has steps of its own under a higher ``occurrence``, is left out of the changes and
fills blanks of the first in the table; empty headers name no field; a file without lines other than comments has no
schema; empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.session import cut

#: Lines per block of the join between lines and their file's rules.
LINE_BLOCK = 20_000
#: Versions from one fresh start of a feed's chain of steps to the next; it bounds the steps that are applied in a row.
CHAIN = 64
#: Kinds of steps that are changes of fields.
CHANGES = ("added", "removed", "renamed", "retyped")
#: A comma and its cell, quoted or plain; the line is read with a comma before it. Linear in the line's length.
CELL = r',(\s*+"(?:[^"]++|"")*+"[^,]*+|[^,]*+)'


@dataclass(frozen=True)
class Target:
    """The wanted table.

    ``fields``: name to ``string``, ``bigint`` or ``double``. ``renames``: (pattern, name) pairs tried in order on a
    header's letters and digits in lower case; where the name holds ``{year}``, a two- or four-digit year at the
    header's end or start is taken off before the comparison and put in. ``values``: per field, spellings in lower case
    to values. ``defaults``: per field, the value of files that lack it (else null).
    """

    fields: dict[str, str]
    renames: tuple[tuple[str, str], ...] = ()
    values: dict[str, dict[str, str]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)


# The target fields and the words that mean them.
COUNT_WORDS = "enroll|enrolls|enr|enrolled|enrollment|enrollments|enrolment|enrolments|consumers|planselections|selections"
CREDIT_WORDS = "aptc|avgaptc|meanaptc|averageaptc|meancredit|avgcredit|averagecredit|taxcredit|avgtaxcredit|meantaxcredit"
STATE_WORDS = ("state", "st", "statename", "statecode", "stateabbr", "stateabbreviation", "statefips", "fips")
FIELDS = {
    "state": "string", "enroll_2022": "bigint", "enroll_2024": "bigint", "enroll_2025": "bigint",
    "aptc_2022": "double", "aptc_2024": "double", "aptc_2025": "double", "vol_mult": "double", "val_mult": "double",
}
# State codes, FIPS numbers and names.
STATES = {
    "AL": (1, "Alabama"), "AK": (2, "Alaska"), "AZ": (4, "Arizona"), "AR": (5, "Arkansas"), "CA": (6, "California"), "CO": (8, "Colorado"),
    "CT": (9, "Connecticut"), "DE": (10, "Delaware"), "DC": (11, "District of Columbia"), "FL": (12, "Florida"), "GA": (13, "Georgia"), "HI": (15, "Hawaii"),
    "ID": (16, "Idaho"), "IL": (17, "Illinois"), "IN": (18, "Indiana"), "IA": (19, "Iowa"), "KS": (20, "Kansas"), "KY": (21, "Kentucky"),
    "LA": (22, "Louisiana"), "ME": (23, "Maine"), "MD": (24, "Maryland"), "MA": (25, "Massachusetts"), "MI": (26, "Michigan"), "MN": (27, "Minnesota"),
    "MS": (28, "Mississippi"), "MO": (29, "Missouri"), "MT": (30, "Montana"), "NE": (31, "Nebraska"), "NV": (32, "Nevada"), "NH": (33, "New Hampshire"),
    "NJ": (34, "New Jersey"), "NM": (35, "New Mexico"), "NY": (36, "New York"), "NC": (37, "North Carolina"), "ND": (38, "North Dakota"), "OH": (39, "Ohio"),
    "OK": (40, "Oklahoma"), "OR": (41, "Oregon"), "PA": (42, "Pennsylvania"), "RI": (44, "Rhode Island"), "SC": (45, "South Carolina"),
    "SD": (46, "South Dakota"), "TN": (47, "Tennessee"), "TX": (48, "Texas"), "UT": (49, "Utah"), "VT": (50, "Vermont"), "VA": (51, "Virginia"),
    "WA": (53, "Washington"), "WV": (54, "West Virginia"), "WI": (55, "Wisconsin"), "WY": (56, "Wyoming"),
}


def state_codes() -> dict[str, str]:
    """Lower-case code, name and FIPS number of each state to its code."""
    return {k: code for code, (fips, name) in STATES.items() for k in (code.lower(), name.lower(), str(fips), f"{fips:02}")}


MULTIPLIERS = Target(
    FIELDS,
    (
        ("|".join(STATE_WORDS), "state"), ("(vol|volume)(mult|multiplier|ratio)", "vol_mult"), ("(val|value)(mult|multiplier|ratio)", "val_mult"),
        (COUNT_WORDS, "enroll_{year}"), (CREDIT_WORDS, "aptc_{year}"),
    ),
    {"state": state_codes()},
)


def field_name(header: Column, target: Target = MULTIPLIERS) -> Column:
    """The target field that a header means, else the header in lower case."""
    low = F.lower(F.trim(header))
    word = F.regexp_replace(low, "[^a-z0-9]", "")
    stem = F.regexp_replace(word, r"^(?:20)?\d\d(?=[a-z])|(?<=[a-z])(?:20)?\d\d$", "")
    year = F.concat(F.lit("20"), F.coalesce(F.regexp_extract(word, r"(\d\d)$", 1), F.lit("")))
    lead = F.concat(F.lit("20"), F.regexp_extract(word, r"^(?:20)?(\d\d)(?=[a-z])", 1))
    dated = F.when(F.length(year) == 4, year).otherwise(lead)
    guesses = [F.when(word.isin(*[k.replace("_", "") for k in target.fields]), F.try_element_at(F.create_map(*[F.lit(x) for k in target.fields for x in (k.replace("_", ""), k)]), word))]
    for pattern, name in target.renames:
        if "{year}" in name:
            guesses.append(F.when(stem.rlike(f"^({pattern})$"), F.replace(F.lit(name), F.lit("{year}"), dated)))
        else:
            guesses.append(F.when(word.rlike(f"^({pattern})$"), name))
    guess = F.coalesce(*guesses)
    return F.when(guess.isin(*target.fields), guess).otherwise(low)


def _cells(text: Column) -> Column:
    raw = F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(CELL), F.lit(1))
    return F.transform(raw, lambda c: F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(c, r"[\r\uFEFF]", "")), '^"(.*)"$', "$1"), '""', '"'))


def _content(lines: DataFrame) -> DataFrame:
    text = F.regexp_replace("line_text", r"^\uFEFF", "")
    return lines.where((F.trim(text) != "") & ~F.ltrim(text).startswith("#") & F.col("file_id").isNotNull() & F.col("line_no").isNotNull())


def read_lines(lines: DataFrame) -> DataFrame:
    """Distinct non-comment lines: ``file_id, line_no, cells``."""
    last = F.max(F.struct("loaded_at", "line_text"))["line_text"].alias("text")
    return _content(lines).groupBy("file_id", "line_no").agg(last).select("file_id", "line_no", _cells(F.col("text")).alias("cells"))


def file_fields(lines: DataFrame, parsed: DataFrame | None = None, target: Target = MULTIPLIERS) -> DataFrame:
    """One row per file: ``feed_id, file_id, published_at, last_line, header_line, fields``.

    ``fields`` is an array of ``pos, header, name, occurrence, type`` in the order of the columns. The header is the
    file's first line that is no comment; the cells' types are counted over all lines and the header's own taken off.
    """
    parsed = read_lines(lines) if parsed is None else parsed
    first = F.max(F.struct((-F.col("line_no")).alias("o"), "loaded_at", "line_text"))
    files = _content(lines).groupBy("file_id").agg(first.alias("h"), F.max("line_no").alias("last_line"), F.max("feed_id").alias("feed_id"), F.max("published_at").alias("published_at"))
    heads = files.select("file_id", F.posexplode(_cells(F.col("h.line_text"))).alias("pos", "cell"))

    def code(cell: Column) -> Column:
        t = F.trim(cell)
        return F.when(t == "", 0).when(t.rlike(r"^[0-9]+$"), 1).when(t.rlike(r"^[0-9]+\.?[0-9]*$|^\.[0-9]+$"), 2).otherwise(3)

    coded = parsed.select("file_id", F.posexplode(F.transform("cells", code)).alias("pos", "code"))
    per = coded.where("code > 1").groupBy("file_id", "pos").agg(F.count(F.when(F.col("code") == 3, 1)).alias("texts"), F.count(F.lit(1)).alias("fractions"))
    own = code(F.col("cell"))
    counted = heads.join(per, ["file_id", "pos"], "left").fillna({"texts": 0, "fractions": 0})
    kind = F.when(F.col("texts") > (own == 3).cast("long"), "text").when(F.col("fractions") > (own > 1).cast("long"), "decimal").otherwise("integer")
    named = counted.select("file_id", F.struct("pos", F.trim("cell").alias("header"), field_name(F.col("cell"), target).alias("name"), kind.alias("type")).alias("f"))
    lists = named.groupBy("file_id").agg(F.array_sort(F.collect_list("f")).alias("all"))  # a file's columns
    usable = F.filter("all", lambda x: x["header"] != "")
    nth = F.transform("u", lambda x, i: F.struct(x["pos"].alias("pos"), x["header"].alias("header"), x["name"].alias("name"), F.size(F.filter(F.slice(F.col("u"), 1, i), lambda y: y["name"] == x["name"])).alias("occurrence"), x["type"].alias("type")))
    lists = lists.select("file_id", usable.alias("u")).select("file_id", nth.alias("fields"))
    return files.join(lists, "file_id").select("feed_id", "file_id", "published_at", "last_line", (-F.col("h.o")).alias("header_line"), "fields")


def fingerprint(fields: str) -> Column:
    """SHA-256 of the headers, names and types in their order."""
    return F.sha2(F.concat_ws("\n", F.transform(fields, lambda x: F.concat_ws("\t", x["header"], x["name"], x["type"]))), 256)


def versioned(files: DataFrame) -> DataFrame:
    """Each file with its feed's ``version``, its ``fingerprint``, ``new_version`` and ``prev``, the fields of the file before.

    The file before is sought within the feed's day; the first file of a day takes the last of the feed's day before,
    and a day's versions go on from those of the days before, so that a feed with most of the files is spread over its
    days. ``prev`` is null for a feed's first file.
    """
    f = cut(files.withColumn("fingerprint", fingerprint("fields")).withColumn("day", F.to_date("published_at")))  # one row per file, read twice below
    w = Window.partitionBy("feed_id", "day").orderBy("published_at", "file_id")
    state = F.struct("fields", "fingerprint")
    within = f.withColumn("before", F.lag(state).over(w)).withColumn("n", F.row_number().over(w)).withColumn("rises", F.sum((F.col("before.fingerprint") != F.col("fingerprint")).cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    within = within.withColumn("rises", F.coalesce("rises", F.lit(0)))
    ends = within.groupBy("feed_id", "day").agg(F.min(F.struct("n", "fingerprint"))["fingerprint"].alias("first_print"), F.max(F.struct("n", "fields", "fingerprint")).alias("last"), F.max("rises").alias("day_rises"))
    d = Window.partitionBy("feed_id").orderBy("day")
    ends = ends.withColumn("day_before", F.lag(F.struct("last.fields", "last.fingerprint")).over(d))
    opens = F.coalesce(F.col("day_before.fingerprint") != F.col("first_print"), F.lit(True)).cast("long")
    ends = ends.withColumn("opens", opens).withColumn("start", F.sum(F.col("opens") + F.col("day_rises")).over(d.rowsBetween(Window.unboundedPreceding, 0)) - F.col("day_rises"))
    ends = ends.select(F.col("feed_id").alias("g"), F.col("day").alias("d"), "day_before", "start")
    j = within.join(ends, F.col("feed_id").eqNullSafe(F.col("g")) & F.col("day").eqNullSafe(F.col("d")))
    prev = F.when(F.col("n") == 1, F.col("day_before")).otherwise(F.col("before"))
    return j.select("feed_id", "file_id", "published_at", "last_line", "header_line", "fields", "fingerprint", (F.col("start") + F.col("rises")).alias("version"), F.coalesce(prev["fingerprint"] != F.col("fingerprint"), F.lit(True)).alias("new_version"), prev["fields"].alias("prev"))


def migration_steps(versions: DataFrame) -> DataFrame:
    """One record per field and change from a version to the next.

    ``feed_id, version, file_id, field_name, occurrence, change_kind, old_header, header, old_type, type, pos``; the
    file is the one that opens the version. A field may have several records in one version.
    """
    def keyed(c: str) -> Column:
        return F.map_from_entries(F.transform(F.coalesce(c, F.array().cast("array<struct<pos:int,header:string,name:string,occurrence:int,type:string>>")), lambda x: F.struct(F.struct(x["name"].alias("name"), x["occurrence"].alias("occurrence")), x)))

    opening = versions.where("new_version").select("feed_id", "version", "file_id", F.col("prev").isNull().alias("is_first"), keyed("fields").alias("now"), keyed("prev").alias("old"))
    keys = F.array_union(F.map_keys("now"), F.map_keys("old"))
    each = opening.select("feed_id", "version", "file_id", "is_first", F.explode(keys).alias("k"), "now", "old").select("feed_id", "version", "file_id", "is_first", "k", F.try_element_at("now", "k").alias("a"), F.try_element_at("old", "k").alias("b"))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    kinds = F.array_compact(F.array(
        F.when(F.col("is_first"), "initial"), F.when(~F.col("is_first") & F.col("b").isNull(), "added"), F.when(F.col("a").isNull(), "removed"),
        F.when(both & (F.col("a.header") != F.col("b.header")), "renamed"), F.when(both & (F.col("a.type") != F.col("b.type")), "retyped"), F.when(both & (F.col("a.pos") != F.col("b.pos")), "moved"),
    ))
    return each.select("feed_id", "version", "file_id", F.col("k.name").alias("field_name"), F.col("k.occurrence").alias("occurrence"), F.explode(kinds).alias("change_kind"), F.col("b.header").alias("old_header"), F.col("a.header").alias("header"), F.col("b.type").alias("old_type"), F.col("a.type").alias("type"), F.col("a.pos").alias("pos"))


def schema_changes(files: DataFrame) -> DataFrame:
    """Every change of fields from one file of a feed to the next, from the migration steps: ``feed_id, file_id, field_name, change_kind``."""
    steps = migration_steps(versioned(files))
    return steps.where(F.col("change_kind").isin(*CHANGES) & (F.col("occurrence") == 0)).select("feed_id", "file_id", "field_name", "change_kind")


def schema_versions(files: DataFrame) -> DataFrame:
    """Version and fingerprint of each file, and whether it opens the version."""
    return versioned(files).select("feed_id", "file_id", "published_at", F.size("fields").cast("long").alias("n_fields"), "fingerprint", "version", "new_version")


def version_rules(versions: DataFrame, chain: int = CHAIN) -> DataFrame:
    """The rules of every version, composed from the steps: ``feed_id, version, rules``.

    ``rules`` is an array of ``name, occurrence, pos, type``. A chain starts at every ``chain``-th version from that
    version's own fields; the steps up to the wanted version are then applied in order. A chain holds at most
    ``chain`` versions' steps, however many versions a feed has.
    """
    opened = versions.where("new_version").withColumn("link", F.floor((F.col("version") - 1) / chain))
    rule = lambda x: F.struct(x["name"].alias("name"), x["occurrence"].alias("occurrence"), x["pos"].alias("pos"), x["type"].alias("type"))
    starts = opened.where((F.col("version") - 1) % chain == 0).select("feed_id", "link", F.transform("fields", rule).alias("start"))
    steps = migration_steps(versions).withColumn("link", F.floor((F.col("version") - 1) / chain)).where((F.col("version") - 1) % chain > 0)
    steps = steps.groupBy("feed_id", "link").agg(F.array_sort(F.collect_list(F.struct("version", "change_kind", F.struct(F.col("field_name").alias("name"), "occurrence", "pos", "type").alias("rule")))).alias("steps"))
    starts = starts.select(F.col("feed_id").alias("g"), F.col("link").alias("l"), "start")
    chains = starts.join(steps, F.col("g").eqNullSafe(F.col("feed_id")) & (F.col("l") == F.col("link")), "left").select("g", "l", "start", "steps")
    each = opened.select("feed_id", "version", "link").join(chains, F.col("feed_id").eqNullSafe(F.col("g")) & (F.col("link") == F.col("l")))

    def apply(rules: Column, step: Column) -> Column:
        others = F.filter(rules, lambda x: (x["name"] != step["rule"]["name"]) | (x["occurrence"] != step["rule"]["occurrence"]))
        return F.when(step["change_kind"] == "removed", others).otherwise(F.concat(others, F.array(step["rule"])))

    upto = F.filter(F.coalesce("steps", F.array().cast(steps.schema["steps"].dataType)), lambda s: s["version"] <= F.col("version"))
    return each.select("feed_id", "version", F.aggregate(upto, F.col("start"), apply).alias("rules"))


def _as_double(c: Column) -> Column:
    t = F.regexp_replace(F.trim(c), r"[$,\s]", "")
    return F.when(t.endswith("%"), F.regexp_replace(t, "%$", "").try_cast("double") / 100).otherwise(t.try_cast("double"))


def conform(parsed: DataFrame, files: DataFrame, target: Target = MULTIPLIERS, chain: int = CHAIN) -> DataFrame:
    """All data lines with the target's columns, plus ``feed_id, file_id, published_at, line_no, extras, cast_failures``.

    Each file takes the rules of its version. ``extras`` and ``cast_failures`` are sorted ``name=text`` lists of the
    further fields and of the non-blank cells that their field's type cannot hold.
    """
    block = F.floor(F.col("line_no") / LINE_BLOCK).cast("long")
    versions = cut(versioned(files))  # one row per file, read three times below
    rules = version_rules(versions, chain).withColumnRenamed("feed_id", "g").withColumnRenamed("version", "v")
    routed = versions.join(rules, F.col("feed_id").eqNullSafe(F.col("g")) & (F.col("version") == F.col("v")))
    spread = F.explode(F.sequence(F.floor(F.col("header_line") / LINE_BLOCK), F.floor(F.col("last_line") / LINE_BLOCK)))
    routed = routed.select(F.col("file_id").alias("f"), "feed_id", "published_at", "header_line", F.array_sort("rules", lambda x, y: x["pos"] - y["pos"]).alias("rules"), spread.alias("b"))
    joined = parsed.withColumn("block", block).join(routed, (F.col("file_id") == F.col("f")) & (F.col("block") == F.col("b"))).where(F.col("line_no") > F.col("header_line"))
    cell = lambda x: F.coalesce(F.get("cells", x["pos"]), F.lit(""))

    def text(name: str) -> Column:
        own = F.filter("rules", lambda x: x["name"] == name)
        return F.get(F.filter(F.transform(own, lambda x: F.trim(cell(x))), lambda c: c != ""), F.lit(0))

    further = F.transform(F.filter("rules", lambda x: ~x["name"].isin(*target.fields)), lambda x: F.concat(x["name"], F.lit("="), cell(x)))
    lacks = [~F.array_contains(F.transform("rules", lambda x: x["name"]), n) if n in target.defaults else F.lit(False) for n in target.fields]
    raw = joined.select("feed_id", "file_id", "published_at", "line_no", further.alias("x"), *[text(n).alias(f"raw_{n}") for n in target.fields], *[no.alias(f"lacks_{n}") for n, no in zip(target.fields, lacks)])
    typed = {}
    for n, t in target.fields.items():
        c = F.col(f"raw_{n}")
        if t == "bigint":
            d = _as_double(c)
            v = F.when((d == F.floor(d)) & (F.abs(d) < 9e18), d.cast("bigint"))
        elif t == "double":
            v = _as_double(c)
        else:
            codes = F.create_map(*[F.lit(x) for kv in target.values[n].items() for x in kv]) if target.values.get(n) else None
            v = c if codes is None else F.coalesce(F.try_element_at(codes, F.regexp_replace(F.lower(c), r"\.0+$", "")), c)
        typed[n] = F.when(F.col(f"lacks_{n}"), F.lit(target.defaults[n]).cast(t)).otherwise(v) if n in target.defaults else v
    fails = F.array_compact(F.array(*[F.when(F.col(f"raw_{n}").isNotNull() & F.col(n).isNull(), F.concat(F.lit(f"{n}="), F.col(f"raw_{n}"))) for n in target.fields]))
    return raw.select("*", *[c.alias(n) for n, c in typed.items()]).select("feed_id", "file_id", "published_at", "line_no", *target.fields, F.concat_ws(";", F.array_sort("x")).alias("extras"), F.concat_ws(";", F.array_sort(fails)).alias("cast_failures"))
