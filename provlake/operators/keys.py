"""One row per key, id-set joins and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def newest_per_key(df: DataFrame, key: Column | str, order: Column, tie: Column | str) -> DataFrame:
    """The row with the largest ``order`` of each key; of equals the one with the smallest ``tie`` (first seen)."""
    w = W.partitionBy(key).orderBy(order.desc_nulls_last(), tie)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def first_seen(df: DataFrame, key: Column | str, *position: Column | str) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(key).orderBy(*position))).where("_rn = 1").drop("_rn")


def last_seen(df: DataFrame, key: Column | str, *position: str) -> DataFrame:
    return first_seen(df, key, *[F.col(p).desc() for p in position])


def first_keys(df: DataFrame, key: str, position: str, n: int) -> DataFrame:
    """Rows of the first n distinct keys by first appearance (a bounded peek)."""
    seen = df.groupBy(key).agg(F.min(position).alias("_at")).orderBy("_at", key).limit(n)
    return df.join(F.broadcast(seen.select(key)), key, "left_semi") if n <= 100_000 else df.join(seen.select(key), key, "left_semi")


def limit_concepts(df: DataFrame, concept: str, position: str, n: int, resumed: DataFrame | None = None) -> DataFrame:
    """Rows of the first concepts up to n distinct ones, counting those that an earlier run has."""
    if resumed is None:
        return first_keys(df, concept, position, n)
    had = resumed.select(concept).distinct()
    new = first_keys(df.join(had, concept, "left_anti"), concept, position, max(0, n - had.count()))
    return df.join(had, concept, "left_semi").unionByName(new)


def remaining(work: DataFrame, done: DataFrame, on: str, rejected: DataFrame | None = None) -> DataFrame:
    """Resume: work minus what is done and what was terminally rejected."""
    out = work.join(done.select(on).distinct(), on, "left_anti")
    return out if rejected is None else out.join(rejected.select(on).distinct(), on, "left_anti")


def targets(keep: DataFrame, wanted: DataFrame, on: str, position: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the keep-list that are wanted, last duplicate first; wanted ids without one)."""
    ids = wanted.select(on).distinct()
    return last_seen(keep.join(ids, on, "left_semi"), on, position), ids.join(keep.select(on), on, "left_anti")


def completeness(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """Keys that one side lacks: (key, side)."""
    x, y = a.select(on).distinct(), b.select(on).distinct()
    return x.join(y, on, "left_anti").withColumn("side", F.lit("left_only")).unionByName(y.join(x, on, "left_anti").withColumn("side", F.lit("right_only")))


def upsert(base: DataFrame, updates: DataFrame, on: str, columns: list[str], guard: Column | None = None) -> DataFrame:
    """``base`` with ``columns`` replaced where an update for the key exists and the guard holds."""
    new = updates.select(on, F.struct(*columns).alias("_new"))
    hit = F.col("_new").isNotNull() if guard is None else F.col("_new").isNotNull() & guard
    out = base.join(new, on, "left")
    return out.select(*[F.when(hit, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns])


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def union_all(*frames: DataFrame, tag: str | None = None) -> DataFrame:
    """Bag union by name; absent columns become null.  ``tag`` adds the number of the input."""
    out = None
    for i, f in enumerate(frames):
        f = f.withColumn(tag, F.lit(i)) if tag else f
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def or_flags(a: Column, b: Column) -> Column:
    """Map of flags: either says so."""
    return F.map_zip_with(a, b, lambda k, x, y: F.coalesce(x, F.lit(False)) | F.coalesce(y, F.lit(False)))


def parse_todo(units: DataFrame, done: DataFrame, rejected: DataFrame, ident: str = "calc_id", position: str = "pos") -> DataFrame:
    """Units to parse: not done, not terminally rejected (id), and each id once, at its first place."""
    return first_seen(remaining(units, done, ident, rejected.select(F.col("id").alias(ident))), ident, position)


def overlap_reason(entries: DataFrame, known: DataFrame, key: str, refs: str, doi: str = "doi") -> DataFrame:
    """(key, reason): the first reference of an entry that names a known DOI or the other source's site."""
    from provlake.functions.records import normal_doi

    each = entries.select(key, F.posexplode(refs).alias("pos", "ref")).withColumn("doi", normal_doi(F.col("ref")))
    hit = each.join(known.select(F.col(doi).alias("doi")).distinct().withColumn("known", F.lit(True)), "doi", "left")
    why = F.when(F.lower("ref").contains("zenodo."), "url").when(F.col("known"), "doi")
    return hit.withColumn("reason", why).where("reason is not null").groupBy(key).agg(F.min_by("reason", "pos").alias("reason"))
