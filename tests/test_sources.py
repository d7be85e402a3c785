import sqlite3
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from weftline.operators import clone, impute, matrix
from weftline.sources import files as FS
from weftline.sources import legacy


def test_delimited_required_and_optional(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,Age\n1,30\n2,\n")
    df = FS.read_delimited(spark, str(tmp_path / "a.csv"), {"ID": "long", "age": "int"}, {"extra": 7.0})
    assert sorted(map(tuple, df.collect())) == [(1, 30, 7.0), (2, None, 7.0)]
    with pytest.raises(ValueError, match="lacks"):
        FS.read_delimited(spark, str(tmp_path / "a.csv"), {"missing": "int"})


def test_years_parameters_and_manifest(tmp_path):
    assert FS.pick_year(["t_2022.csv", "t_2024.csv", "notes.txt"], 2023) == "t_2022.csv"
    assert FS.pick_year(["t_2022.csv", "t_2024.csv"], 2020) == "t_2022.csv"
    assert FS.parameter({2020: 1.0, 2024: 2.0}, 2023) == 1.0
    with pytest.raises(KeyError):
        FS.parameter({2024: 2.0}, 2023)
    (tmp_path / "x").write_text("a")
    m = FS.manifest(str(tmp_path))
    (tmp_path / "x").write_text("b")
    assert FS.verify_manifest(str(tmp_path), m) == ["x"]


def test_stata_and_sqlite(spark, tmp_path):
    p = tmp_path / "s.dta"
    pd.DataFrame({"id": [1, 2], "v": [0.5, 1.5]}).to_stata(p, write_index=False)
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.write(p, "s.dta")
    assert legacy.read_stata(spark, str(tmp_path / "s.zip"), ["v"]).agg(F.sum("v")).first()[0] == 2.0
    with sqlite3.connect(tmp_path / "d.db") as con:
        con.execute("CREATE TABLE t (a INT)")
        con.execute("INSERT INTO t VALUES (4)")
    assert FS.read_sqlite(spark, str(tmp_path / "d.db"), "SELECT a FROM t", "a int").first()[0] == 4


def test_chunks_resume_and_guard(spark, tmp_path):
    f = str(tmp_path)
    assert FS.chunk_done(spark, f, 1, {"n": 1}) is False and FS.chunk_done(spark, f, 1, {"n": 1}) is True
    with pytest.raises(ValueError):
        FS.chunk_done(spark, f, 1, {"n": 2})


def test_draws_are_complete_and_follow_weights(spark):
    rec = spark.range(2000).withColumnRenamed("id", "r")
    opt = spark.createDataFrame([(1, 0.7), (2, 0.2), (3, 0.1), (4, 0.0)], "o long, w double")
    got = clone.draw_without_repeat(rec, opt, "r", "o", "w", 3)
    assert got.groupBy("r").agg(F.count_distinct("o").alias("n"), F.max("clone").alias("c")).where("n <> 3 OR c <> 2").count() == 0
    first = got.where("clone = 0 AND o = 1").count()
    assert abs(first / 2000 - 0.7) < 0.05
    with pytest.raises(ValueError):
        clone.draw_without_repeat(rec, opt, "r", "o", "w", 4)
    donors = spark.createDataFrame([(1, "g", 1.0, 0.9), (2, "g", 1.0, 0.1), (3, "h", 1.0, 0.0)], "o long, g string, w double, t double")
    rows = rec.withColumn("g", F.when(F.col("r") < 10, "h").otherwise("g"))
    t = impute.draw_tilted(rows, donors, "r", "o", "g", "w", F.col("t"))
    assert t.count() == 2000 and t.where("o = 3").count() == 10 and abs(t.where("o = 1").count() / 1990 - 0.9) < 0.04


def workbook(path, sheets):
    """A workbook with shared and inline texts, numbers and gaps."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    texts = []
    with zipfile.ZipFile(path, "w") as z:
        for k, rows in enumerate(sheets.values(), 1):
            xml = ""
            for n, cells in rows.items():
                xml += f'<row r="{n}">'
                for at, v in cells.items():
                    if isinstance(v, str):
                        texts.append(v)
                        xml += f'<c r="{at}{n}" t="s"><v>{len(texts) - 1}</v></c>' if len(texts) % 2 else f'<c r="{at}{n}" t="inlineStr"><is><t>{v}</t></is></c>'
                    else:
                        xml += f'<c r="{at}{n}"><v>{v}</v></c>'
                xml += "</row>"
            z.writestr(f"xl/worksheets/sheet{k}.xml", f"<worksheet {ns}><sheetData>{xml}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{t}</t></si>" for t in texts) + "</sst>")
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{s}" sheetId="{k}" r:id="rId{k}"/>' for k, s in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x">' + "".join(f'<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1)) + "</Relationships>")


def test_workbook_sheets_sections_and_cells(spark, tmp_path):
    p = str(tmp_path / "b.xlsx")
    workbook(p, {"notes": {1: {"A": "x"}}, "table 1": {2: {"A": "Alabama", "C": 5}, 3: {"A": "Total", "B": "1,200", "AB": 7.5}, 5: {"A": "Alaska"}, 6: {"A": "Total", "B": 3}}})
    s = legacy.read_sheet(spark, p, "table 1")
    assert s.count() == 4 and len(s.columns) == 29
    got = {r["name"]: r["value"] for r in legacy.sheet_cells(s, {"all": "B3", "wide": "$AB$3", "text": "A2", "none": "B5", "gone": "B4", "far": "ZZ3"}, {"all": 1000.0}).collect()}
    assert got == {"all": 1_200_000.0, "wide": 7.5, "text": None, "none": None, "far": None}
    f = FS.forward_sections(s, "row", F.col("c0") != "Total", F.col("c0"), "state")
    assert {(r["state"], r["c1"]) for r in f.collect()} == {("Alabama", "1,200"), ("Alaska", "3")}


def test_cached_answers_and_profiles(spark, tmp_path):
    calls = []

    def fetch(key="json"):
        calls.append(key)
        if key == "bad":
            raise OSError
        return '[{"a": 1, "b": "x"}, {"a": 2}]' if key == "json" else key.upper()

    for _ in range(2):
        assert FS.cached_json(spark, fetch, str(tmp_path / "j")).agg(F.sum("a")).first()[0] == 3
    assert calls == ["json"]
    f = str(tmp_path / "p")
    assert {tuple(r) for r in FS.cached_profiles(spark, fetch, ["a", "b", "a", "bad"], f).collect()} == {("a", "A"), ("b", "B")}
    calls.clear()
    assert FS.cached_profiles(spark, fetch, ["a", "c", "bad"], f).count() == 3 and sorted(calls) == ["bad", "c"]


def test_releases_are_checked(spark, tmp_path):
    f = str(tmp_path / "r")
    FS.stage(spark, {"t": spark.range(3).coalesce(1)}, f, "v1")
    for crc in (tmp_path / "r/staging/v1/t").glob(".part*.crc"):
        crc.unlink()
    with open(next((tmp_path / "r/staging/v1/t").glob("part*")), "ab") as x:
        x.write(b"!")
    with pytest.raises(ValueError, match="changed"):
        FS.promote(spark, f, "v1")
    FS.stage(spark, {"t": spark.range(3)}, f, "v1")
    FS.promote(spark, f, "v1")
    FS.stage(spark, {"t": spark.range(4)}, f, "v1")
    with pytest.raises(FileExistsError):
        FS.promote(spark, f, "v1")
    assert FS.releases(spark, f) == ["v1"]
    with pytest.raises(ValueError):
        FS.rollback(spark, f)


def test_chunked_build_refuses_another_lineage(spark, tmp_path):
    cols = spark.createDataFrame([(i, i % 4, i % 3, i % 2) for i in range(40)], "col_id long, record long, district int, state int")
    targets = spark.createDataFrame([(0, "v", "national", "US"), (1, "v", "state", "1"), (2, "v", "district", "2")], "target_idx int, value_key string, geo_level string, geographic_id string")
    vals = spark.createDataFrame([("v", i, 1.0 + i) for i in range(4)], "value_key string, record long, val double")
    once = sorted(map(tuple, matrix.build(cols, targets, vals).collect()))
    f = str(tmp_path / "c")
    _, done = matrix.build_chunks(cols, targets, vals, f, 5, batch=2, stop_after=1)
    assert done == {"built": 1, "found": 0}
    (tmp_path / "c/entries/batch=1").mkdir()  # a batch that was begun and not finished
    for want in ({"built": 3, "found": 1}, {"built": 0, "found": 4}):
        x, done = matrix.build_chunks(cols.orderBy(F.rand()), targets, vals, f, 5, batch=2, resume=True)
        assert done == want and sorted(map(tuple, x.collect())) == once
    for other in ((cols, targets, vals.where("record > 0"), 5), (cols.where("col_id > 0"), targets, vals, 5), (cols, targets, vals, 4)):
        with pytest.raises(ValueError, match="another build"):
            matrix.build_chunks(*other[:3], f, other[3], batch=2, resume=True)
    FS.delete(spark, f"{f}/manifest")
    with pytest.raises(ValueError, match="no manifest"):
        matrix.build_chunks(cols, targets, vals, f, 5, batch=2, resume=True)
    x, done = matrix.build_chunks(cols, targets, vals, f, 5, batch=2)
    assert done == {"built": 4, "found": 0} and x.count() == len(once)
    assert matrix.build_chunks(cols.where("false"), targets, vals, str(tmp_path / "e"), 5)[0].count() == 0
