"""Status, funnel and audit reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.functions.records import exception_type, percent, record_id


#: Lines of the printed status, in order.
LABELS = {
    "candidates": "candidates", "keep": "kept by triage", "attempted": "records tried", "done": "records got", "untouched": "records not tried", "fetch_rejected": "records refused", "fetch_percent": "tried, percent",
    "units": "calculation units", "calcs": "calculations parsed", "frames": "frames", "parse_percent": "parsed, percent",
}


def status(candidates: DataFrame, keep: DataFrame, fetched: DataFrame, calcs: DataFrame, rejections: DataFrame) -> DataFrame:
    """One row: counts and percents of every stage (ids are joined, never gathered)."""
    keep_ids = keep.select(F.coalesce("recid", "entry_id").alias("id") if "entry_id" in keep.columns else F.col("recid").alias("id")).distinct()
    got, parsed = fetched.select(F.col("recid").alias("id")).distinct(), calcs.select(record_id(F.col("calc_id")).alias("id")).distinct()
    done = got.union(parsed).distinct()
    refused = rejections.where("stage like '%fetch' and not contains(id, ':')").select("id").distinct()
    tried = done.union(refused).distinct().join(keep_ids, "id", "left_semi")
    one = lambda df, name: df.agg(F.count("*").alias(name))
    row = one(candidates, "candidates")
    for df, name in ((keep, "keep"), (got, "fetched"), (calcs, "calcs"), (tried, "attempted"), (done.join(keep_ids, "id", "left_semi"), "done")):
        row = row.crossJoin(F.broadcast(one(df, name)))
    row = row.crossJoin(F.broadcast(fetched.agg(F.coalesce(F.sum("n_calc_units"), F.lit(0)).alias("units")))).crossJoin(F.broadcast(calcs.agg(F.coalesce(F.sum(F.size("frame_ids")), F.lit(0)).alias("frames"))))
    row = row.withColumn("untouched", F.greatest(F.lit(0), F.col("keep") - F.col("attempted"))).withColumn("fetch_rejected", F.greatest(F.lit(0), F.col("attempted") - F.col("done")))
    return row.withColumn("fetch_percent", percent(F.col("attempted"), F.col("keep"))).withColumn("parse_percent", percent(F.col("calcs"), F.col("units")))


def audit(units: DataFrame, calcs: DataFrame, rejections: DataFrame) -> DataFrame:
    """Per record: units expected, parsed, rejected and unaccounted for."""
    j = units.join(calcs.select("calc_id").distinct().withColumn("p", F.lit(1)), "calc_id", "left").join(rejections.select(F.col("id").alias("calc_id")).distinct().withColumn("r", F.lit(1)), "calc_id", "left")
    return j.groupBy("recid").agg(F.count("*").alias("expected"), F.count("p").alias("parsed"), F.count_if(F.col("p").isNull() & F.col("r").isNotNull()).alias("rejected"), F.count_if(F.col("p").isNull() & F.col("r").isNull()).alias("unaccounted"))


def parse_errors(rejections: DataFrame, records: DataFrame) -> DataFrame:
    got = rejections.withColumn("recid", record_id(F.col("id"))).groupBy("recid", exception_type(F.col("detail")).alias("error")).agg(F.count("*").alias("n"))
    return got.join(records.select("recid", "title"), "recid", "left")


def reclaim(files: DataFrame, status: DataFrame, dirs: DataFrame) -> DataFrame:
    """(tier, files, bytes): what may go, by the status of the nearest folder; files under a kept folder never do.

    ``files``: recid, path, size; ``status``: dir, status; ``dirs``: dir, keep."""
    from provlake.operators.dataset import nearest_ancestor, reclaimable

    near = nearest_ancestor(files.select("path", "size"), status, "status")
    free = reclaimable(files.select("path"), dirs).withColumn("free", F.lit(True))
    tier = F.when(F.col("free").isNull(), "protected").when(F.col("status") == "parsed", "safe").when(F.col("status") == "pending", "later").otherwise("review")
    return near.join(free, "path", "left").groupBy(tier.alias("tier")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


def funnel(keep: int, fetched: int, rejected: int, in_dataset: int, failed: int, units: int, parsed: int, unit_rejects: int) -> dict[str, bool]:
    return {"keep": keep == fetched + rejected, "fetched": fetched == in_dataset + failed, "units": units == parsed + unit_rejects}


def staging(files: DataFrame, status: DataFrame) -> DataFrame:
    """Bytes and files by reclaim category and record status."""
    j = files.join(status, "recid", "left")
    return j.groupBy("category", F.coalesce("status", F.lit("unknown")).alias("status")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


def usage(listing: DataFrame) -> DataFrame:
    """Bytes, files and directories of a listing (path, length)."""
    from provlake.operators.dataset import ancestors

    dirs = listing.select(F.explode(ancestors(F.col("path"))).alias("d")).distinct().agg(F.count("*").alias("dirs"))
    return listing.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count("*").alias("files")).crossJoin(F.broadcast(dirs))
