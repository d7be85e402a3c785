"""The operators p1 to p5 on small fixtures: brute force, nulls, repeats, ties, empty tables, clashing names."""

import csv
import datetime as dt
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from weftline.operators import drift, fill, orphans, skew, wide
from weftline.plans import preparation
from weftline.session import table

T0 = dt.datetime(2024, 1, 1)
CLASH = ["block", "k", "run", "salt", "key", "pos", "cell", "fields", "value_", "q", "slot", "level", "grp", "s", "g", "n", "b", "canon", "text_"]


def clash(df):
    """Extra columns with names that the operators use inside."""
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH if c not in df.columns])


# ---- p1 ----


def orphan_rows(spark, refs, parents):
    r = clash(spark.createDataFrame(refs, "rid long, pid long, loaded_at timestamp_ntz"))
    p = clash(spark.createDataFrame(parents, "pid long, loaded_at timestamp_ntz, deleted_at timestamp_ntz"))
    out = orphans.find_orphans(orphans.references(r, "r", "pid", "rid", F.year("loaded_at")), p, "pid")
    return {(x["row_id"], x["orphan_kind"]) for x in out.collect()}


def test_orphans_brute_force(spark):
    rnd = random.Random(1)
    day = lambda: T0 + dt.timedelta(days=rnd.randrange(100))
    parents = [(rnd.choice([None, *range(-6, 30), 4095, 4096, 4097, 10**12]), rnd.choice([None, day(), day()]), rnd.choice([None, None, day()])) for _ in range(60)]
    refs = [(i, rnd.choice([None, *range(-8, 34), 4094, 4095, 4096, 4098, 10**12, 10**12 + 1, 7, 7, 7]), rnd.choice([None, day(), day()])) for i in range(300)]
    by = defaultdict(list)
    for k, t, d in parents:
        if k is not None:
            by[k].append((t, d))
    want = set()
    for i, k, t in refs:
        if k is None:
            continue
        if k not in by:
            want.add((i, "missing"))
        elif all(d is not None for _, d in by[k]):
            want.add((i, "deleted"))
        else:
            first = min((x for x, _ in by[k] if x is not None), default=None)
            if first is not None and t is not None and first > t:
                want.add((i, "late"))
    for limit in (orphans.BROADCAST_KEYS, 0):
        old, orphans.BROADCAST_KEYS = orphans.BROADCAST_KEYS, limit
        got = orphan_rows(spark, refs, parents)
        orphans.BROADCAST_KEYS = old
        assert got == want


def test_orphans_of_empty_tables(spark):
    assert orphan_rows(spark, [], [(1, T0, None)]) == set()
    assert orphan_rows(spark, [(1, 5, T0), (2, None, T0)], []) == {(1, "missing")}


def test_runs_split_at_gaps_deletions_and_blocks(spark):
    p = spark.createDataFrame([(1, T0, None), (2, T0, None), (3, T0, T0), (5, T0, None), (4095, T0, None), (4096, T0, None)], "pid long, loaded_at timestamp_ntz, deleted_at timestamp_ntz")
    got = {(r["run_start"], r["run_end"], r["run_deleted"]) for r in orphans.key_runs(p, "pid").collect()}
    assert got == {(1, 2, False), (3, 3, True), (5, 5, False), (4095, 4095, False), (4096, 4096, False)}


# ---- p2 ----


def cells(spark, rows):
    df = clash(spark.createDataFrame(rows, "cid long, sid long, var string, op string, val string, loaded_at timestamp_ntz"))
    return wide.resolve_cells(df, "sid", "var", "op", "val", "cid", "loaded_at")


@pytest.mark.parametrize("text, number", [("1,234.50", 1234.5), (" +20\t", 20.0), ("$15,000", 15000.0), ("4.0e+04", 40000.0), ("-INF", float("-inf")), ("+infinity", float("inf")), (".5", 0.5), ("-0", 0.0), ("12..5", None), ("1O000", None), ("25-34", None), ("", None), ("1,23", None), ("nan", None), (None, None)])
def test_read_number(spark, text, number):
    assert spark.createDataFrame([(text,)], "t string").select(wide.read_number(F.col("t"))).first()[0] == number


def test_cells_resolve_and_report(spark):
    rows = [
        (1, 1, "Age ", "=", "30", T0), (1, 1, "age", "==", "30.0", T0), (2, 1, "age", ">=", "8.5", T0), (3, 1, "snap", "<", "1e3", T0), (4, 1, "snap", "<", "1,000", T0),
        (5, 2, "used_aca_ptc", "==", "YES", T0), (6, 2, "used_aca_ptc", "==", "0", T0 + dt.timedelta(1)), (7, 2, "ucgid_str", "==", "  ", T0), (8, 0, "age", "==", "x", T0), (9, None, "age", "==", "x", T0), (10, 3, None, "==", "1", T0), (11, 3, "new_thing", "~", "5", T0), (12, 3, "age", "<", None, None),
    ]
    c = cells(spark, rows)
    bad = {tuple(r) for r in wide.unclean_cells(c).collect()}
    assert bad == {(1, "age", ">="), (2, "used_aca_ptc", "=="), (2, "ucgid_str", "=="), (3, "age", "<")}
    w = {r["entity_id"]: r for r in wide.widen(c).collect()}
    assert w[1]["age_eq"] == 30 and w[1]["age_ge"] is None and w[1]["snap_lt"] == 1000.0
    assert w[2]["used_aca_ptc_eq"] is False and w[2]["unfilled"]["used_aca_ptc|=="] == "conflict"
    assert w[3]["other_values"] == {"new_thing|~": "5"}
    assert wide.widen(cells(spark, [])).count() == 0


def test_own_types_and_names_with_separators(spark):
    types = {"colour": "string", "n|x": "bigint"}
    df = spark.createDataFrame([(1, 1, "Colour", "==", "red", T0), (2, 1, "n|x", "==", "5", T0), (3, 1, "n", "x|==", "bad", T0), (4, 1, "n|x", "==", "7", T0)], "cid long, sid long, var string, op string, val string, loaded_at timestamp_ntz")
    c = wide.resolve_cells(df, "sid", "var", "op", "val", "cid", "loaded_at", types)
    w = wide.widen(c, types).first()
    assert w["colour_eq"] == "red" and w["n|x_eq"] == 7 and w["unfilled"] == {"n\\|x|==": "conflict", "n|x|==": "bad"} and w["other_values"] == {}
    assert {tuple(r) for r in wide.unclean_cells(c).collect()} == {(1, "n|x", "=="), (1, "n", "x|==")}


# ---- p3 ----


def canon(h):
    t = h.strip().lower()
    w = re.sub("[^a-z0-9]", "", t)
    if w in ("state", "st", "statename", "statecode"):
        return "state"
    for stem, name in (("vol", "vol_mult"), ("volume", "vol_mult"), ("val", "val_mult"), ("value", "val_mult")):
        if w in (stem + "mult", stem + "ratio", stem + "multiplier"):
            return name
    if y := re.search(r"(20)?(22|24|25)", w):
        s = w.replace(y.group(0), "")
        if s in ("enroll", "enr", "enrollment", "consumers", "planselections"):
            return "enroll_20" + y.group(2)
        if s in ("aptc", "avgaptc", "meancredit", "taxcredit"):
            return "aptc_20" + y.group(2)
    return t


def kind(values):
    vs = [v.strip() for v in values if v.strip()]
    return "integer" if all(re.fullmatch("[0-9]+", v) for v in vs) else "decimal" if all(re.fullmatch(r"[0-9]+\.?[0-9]*|\.[0-9]+", v) for v in vs) else "text"


def test_schema_changes_brute_force(spark):
    p = table(spark, SF, "aca_ptc_lines").toPandas().drop_duplicates(["file_id", "line_no"])
    feeds = defaultdict(list)
    for (feed, f), g in p.groupby(["feed_id", "file_id"]):
        rows = [next(csv.reader([t])) for t in g.sort_values("line_no").line_text if not t.startswith("#")]
        feeds[feed].append((g.published_at.iloc[0], f, {canon(h): (h.strip(), kind([r[i] if i < len(r) else "" for r in rows[1:]])) for i, h in enumerate(rows[0])}))
    want = set()
    for fs in feeds.values():
        fs.sort(key=lambda x: x[:2])
        for (_, _, a), (_, f, b) in zip(fs, fs[1:]):
            want |= {(f, n, "added") for n in b.keys() - a.keys()} | {(f, n, "removed") for n in a.keys() - b.keys()}
            want |= {(f, n, "renamed") for n in a.keys() & b.keys() if a[n][0] != b[n][0]} | {(f, n, "retyped") for n in a.keys() & b.keys() if a[n][1] != b[n][1]}
    assert {tuple(r) for r in preparation.p3_found(spark, SF).collect()} == want


LINES = "file_id long, feed_id long, file_name string, published_at timestamp_ntz, loaded_at timestamp_ntz, line_no int, line_text string"


def test_drift_edge_cases(spark):
    def f(i, day, *lines):
        return [(i, 1, "f", T0 + dt.timedelta(days=day), T0, n, t) for n, t in enumerate(lines, 1)]

    rows = f(1, 0, "# note", " State ,enr_22,,note", 'Alabama,"1,200",x,"a ""b"", c"') + f(1, 0, "# note")
    rows += f(2, 0, "state,ENROLL_2022,enroll_2023,note", "28,55", "MS,,7,") + f(3, 2, "# only a comment") + f(4, 3, "st,Enroll_2022", "56,1.5") + [(None, 1, "f", T0, T0, 1, "x"), (5, 1, "f", T0, T0, None, "x"), (6, None, "f", None, None, 1, None)]
    lines = clash(spark.createDataFrame(rows, LINES))
    parsed = drift.read_lines(lines)
    files = drift.file_fields(lines, parsed)
    got = {tuple(r)[1:] for r in drift.schema_changes(files).collect()}
    assert got == {
        (2, "state", "renamed"), (2, "enroll_2022", "renamed"), (2, "enroll_2022", "retyped"), (2, "enroll_2023", "added"), (2, "note", "retyped"),
        (4, "state", "renamed"), (4, "state", "retyped"), (4, "enroll_2022", "renamed"), (4, "enroll_2022", "retyped"), (4, "enroll_2023", "removed"), (4, "note", "removed"),
    }
    t = {(r["file_id"], r["line_no"]): r for r in drift.conform(parsed, files).collect()}
    assert t[1, 3]["state"] == "AL" and t[1, 3]["enroll_2022"] == 1200 and t[1, 3]["extras"] == 'note=a "b", c'
    assert t[2, 2]["state"] == "MS" and t[2, 2]["enroll_2022"] == 55 and t[4, 2]["cast_failures"] == "enroll_2022=1.5"
    none = spark.createDataFrame([], LINES)
    empty, no_files = drift.read_lines(none), drift.file_fields(none)
    assert drift.schema_changes(no_files).count() == 0 and drift.conform(empty, no_files).count() == 0 and drift.version_rules(drift.versioned(no_files)).count() == 0


def test_rules_composed_from_steps_equal_the_files_own_fields(spark):
    """Sixty files with columns that come, go, move, change case, double and change type; chains of any length."""
    rnd = random.Random(9)
    heads = ["state", "State", "enr_22", "ENROLL_2022", "enroll_2022", "aptc_25", "note", "x", "X ", "vol_mult", ""]
    rows = []
    for i in range(60):
        if i % 3 == 0:
            cols = [rnd.choice(heads) for _ in range(rnd.randrange(1, 7))]
            cells = [rnd.choice(["1", "1.5", "a", ""]) for _ in cols]
        day = T0 + dt.timedelta(days=i // 7, minutes=i)
        rows += [(i, i % 2 if i < 30 else 1, "f", day, T0, n, ",".join(c)) for n, c in enumerate((cols, cells), 1) if ",".join(c).strip()]
    files = drift.file_fields(spark.createDataFrame(rows, LINES))
    versions = drift.versioned(files)
    own = {(r["feed_id"], r["version"]): {(x["name"], x["occurrence"], x["pos"], x["type"]) for x in r["fields"]} for r in versions.collect()}
    assert max(v for _, v in own) > 12
    for chain in (1, 3, 64):
        got = {(r["feed_id"], r["version"]): {tuple(x) for x in r["rules"]} for r in drift.version_rules(versions, chain).collect()}
        assert got == own
    order = versions.select("feed_id", "published_at", "version", "fingerprint", "new_version").orderBy("feed_id", "published_at").collect()
    for a, b in zip(order, order[1:]):
        if a["feed_id"] == b["feed_id"]:
            assert b["version"] - a["version"] == int(a["fingerprint"] != b["fingerprint"]) == int(b["new_version"])


def test_own_target_with_defaults(spark):
    rows = [(1, 1, "f", T0, T0, 1, "Id,Qty 2021,colour"), (1, 1, "f", T0, T0, 2, "7,5,RED"), (2, 1, "f", T0 + dt.timedelta(1), T0, 1, "identifier,units_21"), (2, 1, "f", T0 + dt.timedelta(1), T0, 2, "8,x")]
    own = drift.Target({"id": "bigint", "qty_2021": "double", "colour": "string"}, (("identifier", "id"), ("qty|units", "qty_{year}")), {"colour": {"red": "R"}}, {"colour": "none"})
    lines = spark.createDataFrame(rows, LINES)
    files = drift.file_fields(lines, target=own)
    t = {r["file_id"]: r for r in drift.conform(drift.read_lines(lines), files, own).collect()}
    assert (t[1]["id"], t[1]["qty_2021"], t[1]["colour"]) == (7, 5.0, "R") and (t[2]["id"], t[2]["qty_2021"], t[2]["colour"], t[2]["cast_failures"]) == (8, None, "none", "qty_2021=x")
    assert {tuple(r)[2:] for r in drift.schema_changes(files).collect()} == {("id", "renamed"), ("qty_2021", "renamed"), ("qty_2021", "retyped"), ("colour", "removed")}


# ---- p4 ----


def test_quantiles_brute_force(spark):
    rnd = random.Random(2)
    odd = [None, float("nan"), float("inf"), float("-inf"), 1e308, -1e308, 5e-324, 0.0]
    rows = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([*odd, *[rnd.uniform(-5, 5) for _ in range(30)], 1.25, 1.25])) for _ in range(900)] + [("only null", None)]
    df = clash(spark.createDataFrame(rows, "kk string, vv double"))
    keyed = skew.keyed(df, {"kk": F.col("kk")}, F.col("vv"))
    for limit in (skew.BROADCAST_INTERVALS, 0):
        old, skew.BROADCAST_INTERVALS = skew.BROADCAST_INTERVALS, limit
        got = {(r["key_value"], r["q"]): r["quantile"] for r in skew.quantiles(keyed, [0.25, 0.5, 1.0], bins=4).collect()}
        skew.BROADCAST_INTERVALS = old
        for k in "ab":
            vs = sorted(v for x, v in rows if x == k and v is not None and v == v)
            for q in (0.25, 0.5, 1.0):
                assert got[k, q] == vs[max(-(-int(q * 4 * len(vs)) // 4), 1) - 1]
        assert got["only null", 0.5] is None and len(got) == 9
    assert skew.quantiles(keyed.where("false"), [0.5]).count() == 0


def test_heavy_keys_count_nulls_and_repeats(spark):
    df = spark.createDataFrame([("637",), ("0637",), (" 637.0 ",), ("1198",), ("1101",), ("600",), ("x",), (None,), ("",), ("1",)], "cd string")
    b = skew.keyed(df, {"cd": skew.district_number(F.col("cd"))}, F.lit(1.0))
    assert {tuple(r)[1:3] for r in skew.heavy_keys(b, {"cd": 0.2}).collect()} == {("637", 3), ("1101", 2)}


def test_heavy_keys_brute_force(spark):
    rnd = random.Random(5)
    for n in (0, 1, 7, 400):
        keys = [rnd.choice([None, 3, 3, 3, 10**8, rnd.randrange(40), rnd.randrange(40)]) for _ in range(n)]
        rows = skew.keyed(spark.createDataFrame([(k,) for k in keys], "k long"), {"a": F.col("k"), "b": F.col("k") % 5}, F.lit(None))
        for share in (0.03, 0.3, 1.0):
            want = {(f, str(x), c) for f, ks in (("a", keys), ("b", [None if k is None else k % 5 for k in keys])) for x in set(ks) - {None} if (c := ks.count(x)) >= share * len(ks)}
            assert {tuple(r)[:3] for r in skew.heavy_keys(rows, {"a": share, "b": share}, bins=3).collect()} == want


def test_a_hot_key_of_one_value_is_spread(spark):
    """Nine tenths of the rows share key and value: in the salted path no partition gets more than a few salts' worth."""
    rows = spark.range(40_000).repartition(4).select(F.lit("f").alias("key_field"), F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).otherwise("hot").alias("key_value"), F.lit(1.0).alias("value"))
    spans = rows.select("key_field", "key_value").distinct().withColumns({"lo": F.lit(0.0), "hi": F.lit(2.0)})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = skew._attach(rows, spans.hint("merge"), skew.BROADCAST_INTERVALS + 1)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 40_000 and max(sizes) < 40_000 * 0.3


# ---- p5 ----

FORBES = "record_id long, alias string, snapshot_date string, age double, children string, marital_status string, industry string"


def test_fill_backs_off_and_flags(spark):
    rows = [(i, f"p-{i}", "2023-09-01", 40.0 + i % 3, "2", "Married", "tech") for i in range(1, 7)]
    rows += [(10, "A-b-1", "2022-09-01", 50.0, " 3 ", "single", "tech"), (11, "a_b_1 ", "2024-09-01", float("nan"), "99", "?", "tech"), (12, "new", "2023-09-01", 999.0, "", None, "tech"), (13, None, "2023-09-01", None, "-1", "N/A", None), (14, None, None, 0.0, "x", " ", "other|tech"), (15, None, None, 0.0, "x", " ", "other"), (12, "new", "2023-09-01", 999.0, "", None, "tech")]
    out = {r["record_id"]: r for r in fill.fill_records(clash(spark.createDataFrame(rows, FORBES))).collect()}
    assert out[10]["age"] == 50.0 and out[10]["age_level"] is None and out[10]["marital_status"] == "Single"
    assert out[11]["age"] == 52.0 and out[11]["age_level"] == "person" and out[11]["children"] == 3
    assert out[12]["age"] == 41.0 and out[12]["age_level"] == "industry_year" and out[12]["marital_status"] == "Married"
    assert out[13]["children_level"] == "snapshot" and out[14]["age_level"] == "industry" and out[15]["age_level"] == "all"
    cells = fill.filled_cells(fill.fill_records(spark.createDataFrame(rows, FORBES)))
    assert cells.count() == 15
    lone = fill.fill_records(spark.createDataFrame([(1, "x", "2023", None, None, None, None)], FORBES)).first()
    assert lone["age"] is None and lone["age_level"] == "none"
    assert fill.fill_records(spark.createDataFrame([], FORBES)).count() == 0
    old, fill.BROADCAST_COMBINATIONS = fill.BROADCAST_COMBINATIONS, 0
    salted = sorted(map(str, fill.fill_records(spark.createDataFrame(rows, FORBES)).collect()))
    fill.BROADCAST_COMBINATIONS = old
    assert salted == sorted(map(str, fill.fill_records(spark.createDataFrame(rows, FORBES)).collect()))


def test_fill_own_fields_and_merged_groups(spark):
    rows = [(1, ["a"], 10, "x"), (2, ["a"], 20, "y"), (3, ["b"], 30, "x"), (4, ["b", "a"], None, None), (5, ["c|d"], 1, "z"), (6, ["c", "d"], None, None), (7, None, None, "q")]
    base = spark.createDataFrame(rows, "id long, tags array<string>, size int, colour string").withColumn("one", F.lit("*"))
    fields = (fill.Field("size", "median", "int"), fill.Field("colour", "mode", "string"))
    out = {r["id"]: r for r in fill.fill_fields(base, ["id"], fields, [fill.Level("tags", "tags", 2), fill.Level("all", "one", 1)]).collect()}
    assert (out[4]["size"], out[4]["colour"], out[4]["size_level"]) == (20, "x", "tags")
    assert (out[6]["size"], out[6]["size_level"]) == (10, "all") and out[7]["colour_level"] is None and out[7]["size_level"] == "all"


def test_very_long_texts(spark):
    long = "1," * 300_000 + '"a,b"'
    row = [(1, 1, "f", T0, T0, 1, "h" * 300_000), (1, 1, "f", T0, T0, 2, long)]
    parsed = drift.read_lines(spark.createDataFrame(row, LINES))
    assert parsed.where("line_no = 2").select(F.size("cells"), F.element_at("cells", -1)).first() == (300_001, "a,b")
    t = " " * 300_000
    assert spark.createDataFrame([("1" + t + "1",), (t + "7" + t,)], "t string").select(wide.read_number(F.col("t")).alias("n")).where("n = 7").count() == 1
