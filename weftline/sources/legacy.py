"""Formats without a Spark reader. Files are small and read on the driver; convert larger ones to Parquet first."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _open(path: str, suffix: str) -> io.BytesIO:
    """The file, or the first member of an archive with the suffix."""
    if not path.endswith(".zip"):
        with open(path, "rb") as f:
            return io.BytesIO(f.read())
    with zipfile.ZipFile(path) as z:
        return io.BytesIO(z.read(next(n for n in z.namelist() if n.lower().endswith(suffix))))


def read_stata(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A Stata file, plain or zipped; labels are not applied."""
    return spark.createDataFrame(pd.read_stata(_open(path, ".dta"), columns=columns, convert_categoricals=False))


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def column_number(letters: str) -> int:
    """``A`` is 0, ``Z`` 25, ``AA`` 26."""
    n = 0
    for ch in letters.upper():
        n = n * 26 + ord(ch) - 64
    return n - 1


def read_sheet(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """A workbook's sheet without header: columns ``c0, c1, ...`` as text and ``row``, counted from 1 as in the sheet.

    Workbooks are zipped XML and read with the standard library; empty cells are null, formulas give their stored value.
    """
    with zipfile.ZipFile(path) as z:
        book = ET.fromstring(z.read("xl/workbook.xml"))
        link = next(s.get(f"{_LINK}id") for s in book.iter(f"{_SHEET}sheet") if s.get("name") == sheet)
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        target = next(r.get("Target") for r in rels if r.get("Id") == link).lstrip("/")
        texts = []
        if "xl/sharedStrings.xml" in z.namelist():
            texts = ["".join(t.text or "" for t in s.iter(f"{_SHEET}t")) for s in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_SHEET}si")]
        body = ET.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
    rows = []
    for r in body.iter(f"{_SHEET}row"):
        cells = {}
        for c in r.iter(f"{_SHEET}c"):
            value, kind = c.find(f"{_SHEET}v"), c.get("t")
            if kind == "inlineStr":
                text = "".join(t.text or "" for t in c.iter(f"{_SHEET}t"))
            else:
                text = None if value is None else texts[int(value.text)] if kind == "s" else value.text
            cells[column_number(re.match("[A-Z]+", c.get("r")).group())] = text
        rows.append((int(r.get("r")), cells))
    width = max((max(c, default=-1) for _, c in rows), default=-1) + 1
    data = [(n, *[c.get(i) for i in range(width)]) for n, c in rows]
    return spark.createDataFrame(data, "row int" + "".join(f", c{i} string" for i in range(width)))


def sheet_cells(sheet: DataFrame, addresses: dict[str, str], scales: dict[str, float] | None = None) -> DataFrame:
    """``name, value``: numbers at addresses such as ``BC17`` of a :func:`read_sheet`, times their scale; separators and blanks do not count."""
    entries = []
    for name, address in addresses.items():
        letters, row = re.fullmatch(r"\$?([A-Za-z]+)\$?(\d+)", address).groups()
        column = f"c{column_number(letters)}"
        entries.append((name, int(row), column, (scales or {}).get(name, 1.0)))
    cell = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(r).alias("at"), (F.col(c) if c in sheet.columns else F.lit(None).cast("string")).alias("text"), F.lit(s).alias("scale")) for n, r, c, s in entries])).alias("e")
    found = sheet.where(F.col("row").isin(*{r for _, r, _, _ in entries})).select("row", cell).where(F.col("row") == F.col("e.at"))
    return found.select("e.name", (F.regexp_replace("e.text", "[,\\s]", "").try_cast("double") * F.col("e.scale")).alias("value"))


def read_hdf(spark: SparkSession, path: str, variables: list[str], period: int) -> DataFrame:
    """Aligned arrays ``variable/period`` of an HDF5 file as columns (``variable`` where no period is kept); needs h5py."""
    try:
        import h5py
    except ImportError as e:
        raise RuntimeError("reading HDF5 needs h5py, which is not installed") from e
    with h5py.File(path) as f:
        cols = {v: (f[f"{v}/{period}"] if f"{v}/{period}" in f else f[v])[...] for v in variables}
    return spark.createDataFrame(pd.DataFrame({k: (x.astype(str) if x.dtype.kind == "S" else x) for k, x in cols.items()}))
