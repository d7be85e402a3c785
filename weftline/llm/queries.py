"""The queries p6_ to p8_ and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import language, leakage, packing
from weftline.session import table


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return packing.place_documents(table(spark, d, "documents")).where("n_pieces > 1").select("doc_id").distinct()


def p6_placed(spark: SparkSession, d: str) -> DataFrame:
    return packing.place_documents(table(spark, d, "documents"))


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.containers(packing.place_documents(table(spark, d, "documents")))


def p6_document_bytes(spark: SparkSession, d: str) -> DataFrame:
    """Bytes and pieces of each document as placed."""
    return packing.place_documents(table(spark, d, "documents")).groupBy("doc_id").agg(F.sum("n_bytes").alias("n_bytes"), F.max("n_pieces").alias("n_pieces"))


def p6_limits(spark: SparkSession, d: str) -> DataFrame:
    """What the containers must keep: nothing over their capacity, all bytes, and at most 3% (small tables) unused."""
    boxes = packing.containers(packing.place_documents(table(spark, d, "documents")))
    used, room = F.sum("used"), F.count(F.lit(1)) * packing.CAPACITY
    return boxes.agg((F.max("used") <= packing.CAPACITY).alias("fits"), used.alias("bytes"), (1 - used / room < 0.03).alias("well_filled"))


def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_leaks(spark, d).select("doc_id", "item_id")


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """Which items leaked, into how many documents."""
    return p7_leaks(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"), F.max("repeated_words").alias("longest"))


def p8_segments(spark: SparkSession, d: str) -> DataFrame:
    return language.segment_documents(table(spark, d, "documents")).select("doc_id", "segment_no", "start", "end", "lang", F.round("confidence", 4).alias("confidence"), "present")


def _languages(spark: SparkSession, d: str) -> DataFrame:
    return language.document_languages(language.segment_documents(table(spark, d, "documents")))


def p8_documents(spark: SparkSession, d: str) -> DataFrame:
    return _languages(spark, d).select("doc_id", "lang", F.round("confidence", 4).alias("confidence"), F.concat_ws(",", "present").alias("present"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return language.wrong_labels(_languages(spark, d))


def p8_cover(spark: SparkSession, d: str) -> DataFrame:
    """What segments must keep: they cover each text without gaps, from its start to its end, with confidences between 0 and 1."""
    s = language.segment_documents(table(spark, d, "documents"))
    per = s.groupBy("doc_id").agg(F.sum(F.col("end") - F.col("start")).alias("n_chars"), F.min("start").alias("first"), F.max("end").alias("last"), F.count(F.lit(1)).alias("n"), F.max("segment_no").alias("no"), F.min(F.col("confidence").between(0.0, 1.0)).alias("sound"))
    return per.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), ((F.col("first") == 0) & (F.col("last") == F.col("n_chars")) & (F.col("no") == F.col("n") - 1)).alias("whole"), "sound")


def queries() -> dict:
    return {f.__name__: f for f in (p6_found, p6_placed, p6_containers, p6_document_bytes, p6_limits, p7_found, p7_leaks, p7_items, p8_found, p8_segments, p8_documents, p8_cover)}


def oracle_sql() -> dict[str, str]:
    size = "octet_length(encode(text))"
    return {
        "p6_found": f"SELECT DISTINCT doc_id FROM documents WHERE {size} > 4096",
        "p6_document_bytes": f"SELECT doc_id, CAST(sum(coalesce({size}, 0)) AS BIGINT) AS n_bytes, CAST(max(greatest(ceil(coalesce({size}, 0) / 4096.0), 1)) AS BIGINT) AS n_pieces FROM documents GROUP BY 1",
        "p8_cover": "SELECT doc_id, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS n_chars, true AS whole, true AS sound FROM documents GROUP BY 1",
        "p6_limits": f"SELECT true AS fits, CAST(sum({size}) AS BIGINT) AS bytes, true AS well_filled FROM documents",
    }
