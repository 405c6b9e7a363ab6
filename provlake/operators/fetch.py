"""Decisions on getting and staging a record's files: outcomes, verdicts, what to keep, ranges and footprints."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.functions import files as ff
from provlake.functions import records

# Reasons that a record or a file gets.
DEFERRED, TOO_LARGE, RETRY, NOTHING, NO_UNITS = "disk_budget_deferred", "record_exceeds_disk_budget", "fetch_failed_transient", "no_vasp_files_fetched", "no_calc_units_after_extract"
ATTEMPTS, LONGEST_WAIT = 3, 120
EXTRA_INODES = 3


def outcome(ok: Column, status: Column, error: Column, over_cap: Column, budget_full: Column, checksum_ok: Column) -> Column:
    """The reason of one download: ``ok``, or the first thing that stopped it."""
    return (
        F.when(budget_full, "disk_budget_reached").when(status >= 400, F.concat(F.lit("http_"), status.cast("string"))).when(over_cap, "over_size_cap")
        .when(error.isNotNull(), error).when(~checksum_ok, "md5_mismatch").when(ok, "ok").otherwise("download_error:unknown")
    )


def reason_kind(reason: Column) -> Column:
    """ok, transient (comes again), or failed (this file; the record may still hold others)."""
    return F.when(reason == "ok", "ok").when(records.transient(reason), "transient").otherwise("failed")


def resume_step(have: Column, status: Column, attempt: Column) -> Column:
    """What to do with an answer when ``have`` bytes of a file are there: append, restart, verify, wait or reject."""
    return (
        F.when((status == 206) & (have > 0), "append").when(status.between(200, 299), "restart").when((status == 416) & (have > 0), "verify")
        .when((status == 429) & (attempt < ATTEMPTS), "wait").otherwise("reject")
    )


def wait_seconds(retry_after: Column, attempt: Column, most: int = LONGEST_WAIT) -> Column:
    """The server's wish in seconds, else doubling from two; ``most`` at the most."""
    said = F.trim(retry_after).try_cast("double")
    return F.least(F.when(said >= 0, said).otherwise(F.pow(F.lit(2.0), attempt + 1)), F.lit(float(most)))


def verdict(deferred: Column, got_any: Column, transient: Column, truncated: Column, units: Column) -> Column:
    """struct(reason, kept, note) of a record: nothing is called final that a retry or a larger budget could change."""
    empty = F.when(truncated, TOO_LARGE).when(transient, RETRY)
    reason = F.when(deferred, DEFERRED).when(~got_any, empty.otherwise(NOTHING)).when(units == 0, empty.otherwise(NO_UNITS))
    return F.struct(reason.alias("reason"), reason.isNull().alias("kept"), F.when(reason.isNull() & truncated, TOO_LARGE).alias("note"))


def keep_staging(transient: Column, truncated: Column, n_files: Column) -> Column:
    """Whether an unrecorded record's files stay for the next run: only if it may work then, and something is there."""
    return transient & ~truncated & (n_files > 0)


def type_filter(types: list[str], column: Column) -> tuple[str | None, Column | None]:
    """(type to ask the source for, local test): none, one that the source takes, or several tested here."""
    if not types:
        return None, None
    return (types[0], None) if len(types) == 1 else (None, column.isin(*types))


def resolve_path(path: Column, folder: Column) -> Column:
    """A relative path under ``folder``; an absolute one as it is."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.rtrim(folder, F.lit("/")), F.lit("/"), path))


def heavy_names(names: Column) -> Column:
    """Map of heavy kind to the first of the names that has it."""
    first = [(k, F.get(F.filter(names, ff.is_heavy(k)), 0)) for k in ff.HEAVY]
    return F.map_filter(F.create_map(*[x for k, v in first for x in (F.lit(k), v)]), lambda k, v: v.isNotNull())


def listing_hits(names: Column) -> Column:
    """struct(vasp, primary, nested) of an archive's member names, without clutter."""
    clean = F.filter(names, lambda n: ~ff.is_junk(n))
    return F.struct(
        F.filter(clean, ff.is_calc_name).alias("vasp"), F.filter(clean, ff.is_primary_name).alias("primary"),
        F.filter(clean, lambda n: ff.archive_kind(ff.basename(n), bare=False).isNotNull()).alias("nested"),
    )


def has_rank(rank: Column, least: int = 3) -> Column:
    return F.coalesce(rank >= least, F.lit(False))


def footprint(listing: DataFrame, key: str, size: str = "size") -> DataFrame:
    """(key, bytes, inodes): what staging takes, files and the folders made for them."""
    return listing.groupBy(key).agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), (F.count("*") + EXTRA_INODES).alias("inodes"))


def _spans(most: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["offset", "end"], kind="stable").reset_index(drop=True)
        out, n, start = [], -1, None
        for a, b in zip(rows["offset"], rows["end"]):
            if start is None or b - start > most:
                n, start = n + 1, a
            out.append(n)
        return rows.assign(span=out)[["archive", "name", "offset", "end", "span"]]

    return run


def span_groups(members: DataFrame, most: int = 512 << 20) -> DataFrame:
    """(archive, name, offset, end, span): members in order of place, a new span where one would grow beyond ``most`` bytes.

    The rule is sequential within an archive; a row is one member, so a task holds one archive's list.
    """
    return members.select("archive", "name", F.col("offset").cast("long").alias("offset"), F.col("end").cast("long").alias("end")).groupBy("archive").applyInPandas(
        _spans(most), "archive string, name string, offset long, end long, span int"
    )


def span_ranges(groups: DataFrame) -> DataFrame:
    """(archive, span, start, stop, wanted, wasted): one request for each span, and the bytes in it that nobody asked for."""
    got = groups.groupBy("archive", "span").agg(F.min("offset").alias("start"), F.max("end").alias("stop"), F.sum(F.col("end") - F.col("offset")).alias("wanted"))
    return got.withColumn("wasted", F.greatest(F.col("stop") - F.col("start") - F.col("wanted"), F.lit(0)))


def top_reasons(rejections: DataFrame, k: int = 8, column: str = "reason") -> DataFrame:
    """The k most frequent values, equal counts in the order of their names."""
    return rejections.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)
