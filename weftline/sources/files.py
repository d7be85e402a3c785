"""Readers and writers of survey files: delimited, fixed-width, sheet-like text, year-suffixed files, parameters.

Columns are pruned in the reader's schema, so a wide file costs its read columns only. Missing optional columns are
filled, missing required ones are an error.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_delimited(spark: SparkSession, paths: str | list[str], types: dict[str, str], optional: dict[str, object] | None = None, sep: str = ",", fill: float | None = None) -> DataFrame:
    """Delimited files with headers: required columns ``types``, optional ones with their default, upper-cased names.

    The header of each path is read first; every path is read with its own column order, and the parts are united.
    """
    optional = optional or {}
    parts = []
    for p in [paths] if isinstance(paths, str) else paths:
        have = {x.upper(): x for x in spark.read.option("header", True).option("sep", sep).csv(p).columns}
        missing = [x for x in types if x.upper() not in have]
        if missing:
            raise ValueError(f"{p} lacks {missing}")
        df = spark.read.option("header", True).option("sep", sep).csv(p)
        cols = [F.col(f"`{have[k.upper()]}`").try_cast(t).alias(k.upper()) for k, t in types.items()]
        cols += [(F.col(f"`{have[k.upper()]}`").try_cast("double") if k.upper() in have else F.lit(v)).alias(k.upper()) for k, v in optional.items()]
        parts.append(df.select(*cols))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.fillna(fill) if fill is not None else out


def read_fixed_width(spark: SparkSession, path: str, fields: dict[str, tuple[int, int, str]]) -> DataFrame:
    """Text lines cut at ``name: (start from 1, length, type)``; blanks are null."""
    line = spark.read.text(path)
    return line.select(*[F.nullif(F.trim(F.substring("value", s, n)), F.lit("")).try_cast(t).alias(k) for k, (s, n, t) in fields.items()])


def forward_sections(rows: DataFrame, order: str, is_header: Column, label: Column, name: str) -> DataFrame:
    """Rows of a sheet below section headers: each row gets the label of the last header before it; headers are dropped."""
    w = Window.partitionBy(F.lit(0)).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)  # a sheet's rows
    return rows.withColumn(name, F.last(F.when(is_header, label), ignorenulls=True).over(w)).where(~F.coalesce(is_header, F.lit(False)))


#: Most rows of a SQLite query that go through the driver.
SQLITE_ROWS = 1_000_000


def read_sqlite(spark: SparkSession, path: str, query: str, schema: str, rows: int = SQLITE_ROWS) -> DataFrame:
    """A query on a small SQLite file (a target database), read on the driver; more than ``rows`` rows are an error."""
    import sqlite3

    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
        got = con.execute(query).fetchmany(rows + 1)
    if len(got) > rows:
        raise ValueError(f"more than {rows} rows: read {path} by ranges, or convert it to Parquet")
    return spark.createDataFrame(got, schema)


def mutual(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of each side that have a partner on the other."""
    return left.join(right.select(key), key, "left_semi"), right.join(left.select(key), key, "left_semi")


def pick_year(names: Iterable[str], year: int) -> str:
    """The file with the newest year suffix up to ``year``, else the earliest."""
    dated = sorted((int(m.group(1)), n) for n in names if (m := re.search(r"(\d{4})(?=\D*$)", n)))
    if not dated:
        raise FileNotFoundError("no year-suffixed file")
    upto = [n for y, n in dated if y <= year]
    return upto[-1] if upto else dated[0][1]


def parameter(table: dict[int, float], year: int) -> float:
    """The latest value up to ``year``; none is an error."""
    ys = [y for y in table if y <= year]
    if not ys:
        raise KeyError(f"no value up to {year}")
    return table[max(ys)]


def parameters(spark: SparkSession, nested: dict[str, dict[int, float]], year: int, category: str = "category") -> DataFrame:
    """Values by category for ``year`` as a small table; categories without a value up to then are left out."""
    rows = [(k, float(parameter(v, year))) for k, v in nested.items() if any(y <= year for y in v)]
    return spark.createDataFrame(rows, f"{category} string, value double")


def write_area(entities: dict[str, DataFrame], folder: str, partition: str = "area") -> None:
    """One Parquet table per entity, partitioned by area."""
    for name, df in entities.items():
        df.write.mode("overwrite").partitionBy(partition).parquet(f"{folder}/{name}")


def append_shard(entries: DataFrame, folder: str, chunk: int) -> None:
    """One chunk of matrix entries; writing a chunk again replaces it."""
    entries.write.mode("overwrite").parquet(f"{folder}/chunk={chunk}")


def write_sorted_csv(df: DataFrame, folder: str, by: list[str], gzip: bool = True) -> None:
    df.orderBy(*by).write.mode("overwrite").option("header", True).option("compression", "gzip" if gzip else "none").csv(folder)


def write_package(tables: dict[str, DataFrame], metadata: dict, folder: str) -> None:
    """A calibration package: Parquet tables and a one-row table with the metadata as text."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        spark = df.sparkSession
    spark.createDataFrame([(json.dumps(metadata, sort_keys=True),)], "metadata string").coalesce(1).write.mode("overwrite").text(f"{folder}/metadata")


def read_package(spark: SparkSession, names: list[str], folder: str) -> tuple[dict[str, DataFrame], dict]:
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}, json.loads(spark.read.text(f"{folder}/metadata").first()[0])


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system that Spark can read."""
    p, fs = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a folder in one step; the new name must be free."""
    (a, fs), (b, _) = _path(spark, old), _path(spark, new)
    fs.mkdirs(b.getParent())
    if fs.exists(b) or not fs.rename(a, b):
        raise FileExistsError(f"{old} cannot become {new}")


def write_json(spark: SparkSession, value: dict | list, folder: str) -> None:
    spark.createDataFrame([(json.dumps(value, sort_keys=True),)], "s string").coalesce(1).write.mode("overwrite").text(folder)


def read_json(spark: SparkSession, folder: str):
    return json.loads(spark.read.text(folder).first()[0])


def chunk_done(spark: SparkSession, folder: str, chunk: int, signature: dict) -> bool:
    """Whether a chunk was written under the same signature; another signature is an error, and so is an unreadable one."""
    path = f"{folder}/signature-{chunk}"
    if not exists(spark, path):
        write_json(spark, signature, path)
        return False
    if read_json(spark, path) != signature:
        raise ValueError("the chunk was written under another signature")
    return True


def cached_json(spark: SparkSession, fetch: Callable[[], str], path: str) -> DataFrame:
    """A JSON answer as a table: read from its raw copy at ``path``, or fetched once and kept there."""
    if not exists(spark, path):
        spark.createDataFrame([(fetch(),)], "s string").coalesce(1).write.text(path)
    return spark.read.option("multiLine", True).json(path)


def cached_profiles(spark: SparkSession, fetch: Callable[[str], str], keys: list[str], folder: str, threads: int = 8) -> DataFrame:
    """``key, body``: one fetched text per key, by several threads; keys that ``folder`` has are not fetched again.

    A key whose fetch fails has no row and is tried again by the next call.
    """
    have = spark.read.parquet(folder) if exists(spark, folder) else spark.createDataFrame([], "key string, body string")
    known = {r["key"] for r in have.select("key").collect()}  # as many as ``keys`` at most

    def one(key: str) -> tuple[str, str] | None:
        try:
            return key, fetch(key)
        except OSError:
            return None

    with ThreadPoolExecutor(threads) as pool:
        new = [r for r in pool.map(one, [k for k in dict.fromkeys(keys) if k not in known]) if r]
    if new:
        spark.createDataFrame(new, "key string, body string").coalesce(1).write.mode("append").parquet(folder)
    return spark.read.parquet(folder) if new or known else have


def stage(spark: SparkSession, tables: dict[str, DataFrame], root: str, version: str) -> None:
    """Write the tables of a release below ``root/staging/version`` with the hashes of their files."""
    at = f"{root}/staging/{version}"
    delete(spark, at)
    for name, df in tables.items():
        df.write.parquet(f"{at}/{name}")
    file_hashes(spark, at).coalesce(1).write.parquet(f"{root}/manifests/{version}", mode="overwrite")


def promote(spark: SparkSession, root: str, version: str) -> None:
    """Check a staged release against its hashes, move it to ``root/releases/version`` in one step and make it the current one."""
    changed = verify_hashes(file_hashes(spark, f"{root}/staging/{version}"), spark.read.parquet(f"{root}/manifests/{version}"))
    if changed.limit(1).count():
        raise ValueError(f"files of {version} are missing or changed")
    rename(spark, f"{root}/staging/{version}", f"{root}/releases/{version}")
    write_json(spark, [*releases(spark, root), version], f"{root}/registry")


def releases(spark: SparkSession, root: str) -> list[str]:
    """The releases that were made current, the last one being so now."""
    return read_json(spark, f"{root}/registry") if exists(spark, f"{root}/registry") else []


def rollback(spark: SparkSession, root: str) -> str:
    """Make the release before the current one current again."""
    have = releases(spark, root)
    if len(have) < 2:
        raise ValueError("no earlier release")
    write_json(spark, have[:-1], f"{root}/registry")
    return have[-2]


def verify_hashes(now: DataFrame, expected: DataFrame) -> DataFrame:
    """``file, problem``: files that are missing, new or changed, from two results of :func:`file_hashes`."""
    e = expected.select("file", F.col("sha256").alias("_was"))
    j = now.select("file", "sha256").join(e, "file", "full_outer")
    problem = F.when(F.col("sha256").isNull(), "missing").when(F.col("_was").isNull(), "new").when(F.col("sha256") != F.col("_was"), "changed")
    return j.select("file", problem.alias("problem")).where(F.col("problem").isNotNull())


def manifest(folder: str) -> dict[str, dict]:
    """Size and SHA-256 of each file below a driver-side folder."""
    out = {}
    for p in sorted(Path(folder).rglob("*")):
        if p.is_file():
            out[str(p.relative_to(folder))] = {"bytes": p.stat().st_size, "sha256": hashlib.sha256(p.read_bytes()).hexdigest()}
    return out


def verify_manifest(folder: str, expected: dict[str, dict]) -> list[str]:
    """Files that are missing, new or changed."""
    now = manifest(folder)
    return sorted(k for k in {*now, *expected} if now.get(k) != expected.get(k))


def file_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """Name below the folder, size and SHA-256 of its files, on the executors: ``file, length, sha256``."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    below = F.substring_index("path", folder.rstrip("/").split("/")[-1] + "/", -1)
    return f.select(below.alias("file"), "length", F.sha2("content", 256).alias("sha256"))
