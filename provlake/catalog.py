"""Queries by name over the shared tables, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from provlake.plans import curation, harvest, relational, rules, stages

QUERIES = relational.QUERIES | harvest.QUERIES | curation.QUERIES | rules.QUERIES | stages.QUERIES
ORACLES = relational.ORACLES | harvest.ORACLES | curation.ORACLES | rules.ORACLES | stages.ORACLES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata against stored rows, and weighted counts beside it."""
    return QUERIES["weighted_counts"](spark, sf_dir).select("k", "weight", "n").unionByName(
        QUERIES["bijection"](spark, sf_dir).groupBy("state").agg({"*": "count"}).selectExpr("state AS k", "`count(1)` AS weight", "`count(1)` AS n")
    )
