"""Target-by-column contributions as long rows: ``target_idx, col_id, val``.

A value is computed once per (value key, record); the geography of a column only decides to which targets it adds, so
estimates are grouped aggregates and the matrix is materialised only where a solver asks for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.solve import compare_signatures
from weftline.sources import files


def columns_to_targets(columns: DataFrame, targets: DataFrame) -> DataFrame:
    """Each column once per level with the targets of its place: equal-key joins on ``(level, geographic id)``.

    The nation's targets are a short list met by key like the others, so no cross join occurs.
    """
    place = F.explode(F.array(
        F.struct(F.lit("national").alias("geo_level"), F.lit("US").alias("geographic_id")),
        F.struct(F.lit("state").alias("geo_level"), F.col("state").cast("string").alias("geographic_id")),
        F.struct(F.lit("district").alias("geo_level"), F.col("district").cast("string").alias("geographic_id")),
    ))
    return columns.select("col_id", "record", place.alias("p")).select("col_id", "record", "p.*").join(F.broadcast(targets) if targets.limit(50_001).count() <= 50_000 else targets, ["geo_level", "geographic_id"])


def build(columns: DataFrame, targets: DataFrame, values: DataFrame) -> DataFrame:
    """Non-zero entries: ``values`` has ``value_key, record, val``."""
    return columns_to_targets(columns, targets).join(values, ["value_key", "record"]).where(F.col("val") != 0).select("target_idx", "col_id", "val")


def table_print(df: DataFrame) -> str:
    """A fingerprint of a table's rows that does not depend on their order: their number and two sums of their hashes."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("x"), F.coalesce(F.sum(F.pmod(h, F.lit(1 << 40))), F.lit(0)).alias("s")).first()
    return f"{r['n']}-{r['x']:x}-{r['s']:x}"


def lineage(columns: DataFrame, targets: DataFrame, values: DataFrame, chunk_size: int, batch: int, **facts) -> dict:
    """The signature of a chunked build: what it is made of and how it is cut. ``facts`` are further things that must not change."""
    return {"format": 1, "chunk_size": chunk_size, "batch": batch, "columns": table_print(columns), "targets": table_print(targets), "values": table_print(values)} | facts


def build_chunks(columns: DataFrame, targets: DataFrame, values: DataFrame, folder: str, chunk_size: int, batch: int = 64, resume: bool = False, stop_after: int | None = None, **facts) -> tuple[DataFrame, dict[str, int]]:
    """The matrix of :func:`build` written by ranges of columns, and how many batches were built and found.

    A chunk holds the columns ``[k * chunk_size, (k + 1) * chunk_size)``; ``batch`` chunks are written by one job, into a
    folder of their own whose success marker says that it is whole, so that a build that was stopped goes on with
    ``resume`` where it ended. The manifest holds the signature (:func:`lineage`): resuming under another one, or
    without a manifest, is an error; without ``resume`` everything is built anew. ``stop_after`` ends after so many
    batches. Column ids are not negative. The first column's number is read from ``col_id`` and may have gaps. Values must
    come out the same to the last bit each time: sums of doubles by :func:`weftline.functions.exprs.ordered_sum`.
    """
    spark = columns.sparkSession
    signature = lineage(columns, targets, values, chunk_size, batch, **facts)
    manifest, entries = f"{folder}/manifest", f"{folder}/entries"
    if resume and files.exists(spark, manifest):
        differ = compare_signatures(files.read_json(spark, manifest), signature, tuple(signature))
        if differ["fatal"] or differ["soft"]:
            raise ValueError(f"the chunks in {folder} are of another build: {', '.join(differ['fatal'] + differ['soft'])}")
    elif resume and files.exists(spark, entries):
        raise ValueError(f"the chunks in {folder} have no manifest")
    else:
        files.delete(spark, folder)
        files.write_json(spark, signature, manifest)
    last = columns.agg(F.max("col_id")).first()[0]
    n_batches = 0 if last is None else last // (chunk_size * batch) + 1
    done = {"built": 0, "found": 0}
    for k in range(n_batches):
        if files.exists(spark, f"{entries}/batch={k}/_SUCCESS"):
            done["found"] += 1
            continue
        if stop_after is not None and done["built"] >= stop_after:
            break
        lo, hi = k * chunk_size * batch, (k + 1) * chunk_size * batch
        part = build(columns.where((F.col("col_id") >= lo) & (F.col("col_id") < hi)), targets, values)
        part.withColumn("chunk", F.floor(F.col("col_id") / chunk_size).cast("long")).write.mode("overwrite").partitionBy("chunk").parquet(f"{entries}/batch={k}")
        done["built"] += 1
    schema = build(columns, targets, values).schema
    if not (done["built"] or done["found"]):
        return spark.createDataFrame([], schema), done
    whole = spark.read.schema(schema).option("basePath", entries).parquet(*[f"{entries}/batch={k}" for k in range(done["built"] + done["found"])])
    return whole.select(*schema.names), done


def multiply(matrix: DataFrame, weights: DataFrame) -> DataFrame:
    """``X w``: ``target_idx, estimate, row_sum``; ``weights`` has ``col_id, w``."""
    return matrix.join(weights, "col_id").groupBy("target_idx").agg(F.sum(F.col("val") * F.col("w")).alias("estimate"), F.sum("val").alias("row_sum"))


def initial_weights(columns: DataFrame, people: DataFrame, default: float = 100.0) -> DataFrame:
    """Per district its people divided by its columns, else ``default``: ``col_id, w``; ``people`` has ``district, people``."""
    n = columns.groupBy("district").agg(F.count_distinct("col_id").alias("_n"))
    per = n.join(people, "district", "left").select("district", F.coalesce(F.col("people") / F.col("_n"), F.lit(default)).alias("w"))
    return columns.select("col_id", "district").distinct().join(per, "district").select("col_id", "w")


def package_report(matrix: DataFrame, targets: DataFrame, n_columns: int) -> DataFrame:
    """Rows, entries, density and impossible targets (row sum not positive)."""
    rows = matrix.groupBy("target_idx").agg(F.sum("val").alias("row_sum"), F.count(F.lit(1)).alias("n"))
    j = targets.select("target_idx").distinct().join(rows, "target_idx", "left").fillna({"row_sum": 0.0, "n": 0})
    return j.agg(F.count(F.lit(1)).alias("n_targets"), F.sum("n").alias("entries"), F.sum((F.col("row_sum") <= 0).cast("long")).alias("impossible")).withColumn("density", F.col("entries") / (F.col("n_targets") * F.lit(n_columns)))
