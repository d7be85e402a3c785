"""All query modules of the library's core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.plans import checking, geography, joining, preparation, ranking, rules, solving, targeting, totals


def parts() -> list:
    return [preparation, rules, joining, totals, ranking, targeting, geography, solving, checking]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.a3_entity_targets(spark, sf_dir)
