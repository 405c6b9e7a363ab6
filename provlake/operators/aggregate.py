"""Counting, distribution and census operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def gate_counts(df: DataFrame, gates: list[tuple[str, Column]], keep: str = "keep") -> DataFrame:
    """(gate, n): each row counts for the first gate that it fails, or for ``keep``; one pass."""
    return with_gate(df, gates, keep).groupBy("gate").agg(F.count("*").alias("n"))


def with_gate(df: DataFrame, gates: list[tuple[str, Column]], keep: str = "keep") -> DataFrame:
    failed = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in gates], F.lit(keep))
    return df.withColumn("gate", failed)


def dropped_values(df: DataFrame, gates: list[tuple[str, Column]], gate: str, column: str, k: int = 10) -> DataFrame:
    """(column, n): the k most frequent values among the rows that ``gate`` dropped; a missing one is ``null``."""
    value = F.coalesce(F.col(column).cast("string"), F.lit("null")).alias(column)
    return with_gate(df, gates).where(F.col("gate") == gate).groupBy(value).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)


def census(files: DataFrame, record: str, size: str, name: str, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """(one row: records, bytes, largest and middle record, share of the k largest; files and bytes by extension)."""
    from provlake.functions.files import extension

    per = files.groupBy(record).agg(F.sum(size).cast("long").alias("v")).withColumn("_all", F.lit("all"))
    stats = lower_index_stats(per, "_all", "v").select(F.col("n").alias("records"), F.col("total").alias("bytes"), F.col("high").alias("largest"), "median")
    top = per.orderBy(F.desc("v"), record).limit(k).agg(F.sum("v").alias("_top"))
    row = stats.crossJoin(F.broadcast(top)).withColumn("top_share", F.round(F.try_divide("_top", "bytes"), 6)).drop("_top")
    return row, files.groupBy(extension(F.col(name)).alias("ext")).agg(F.count("*").alias("files"), F.sum(size).cast("long").alias("bytes"))


def split_rejects(df: DataFrame, gates: list[tuple[str, Column]], stage: str, ident: str) -> tuple[DataFrame, DataFrame]:
    """(kept rows, rejection rows): nothing is dropped without a row that says why."""
    got = with_gate(df, gates)
    return got.where("gate = 'keep'").drop("gate"), got.where("gate <> 'keep'").select(F.lit(stage).alias("stage"), F.col(ident).cast("string").alias("id"), F.col("gate").alias("reason"))


def weighted_counts(df: DataFrame, key: Column, weight: Column, name: str) -> DataFrame:
    """Weighted by ``weight``; a null key is the text ``null``."""
    return df.groupBy(F.coalesce(key.cast("string"), F.lit("null")).alias(name)).agg(F.sum(weight).cast("long").alias("weight"), F.count("*").alias("n"))


def three_state(df: DataFrame, flag: Column) -> DataFrame:
    return df.agg(F.count_if(flag).alias("yes"), F.count_if(~flag).alias("no"), F.count_if(flag.isNull()).alias("unknown"))


def membership_counts(df: DataFrame, items: Column, name: str) -> DataFrame:
    """Rows that hold an item, each once."""
    return df.select(F.explode(F.array_distinct(items)).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def cap_sweep(df: DataFrame, group: str, size: str, caps: list[int | None]) -> DataFrame:
    """(group, cap, n, bytes): what each cap lets through; a cap of null lets all through (-1 in the result)."""
    one = F.explode(F.array(*[F.lit(-1 if c is None else c).cast("long") for c in caps])).alias("cap")
    ok = (F.col("cap") < 0) | (F.col(size) <= F.col("cap"))
    return df.select(group, size, one).groupBy(group, "cap").agg(F.count_if(ok).alias("n"), F.coalesce(F.sum(F.when(ok, F.col(size))), F.lit(0)).cast("long").alias("bytes"))


def lower_index_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """n, total, mean (2 digits), element n//2 and element min(n - 1, int(0.9 n)) of the ascending values, extremes.

    Values are numbered over ranges of (group, value), so a large group is spread; the wanted numbers are then joined.
    """
    from provlake.operators.split import in_group

    size = df.groupBy(group).agg(F.count(value).alias("n"), F.sum(value).cast("long").alias("total"), F.round(F.avg(value), 2).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"))
    at = in_group(df.where(F.col(value).isNotNull()).select(group, value), group, value)
    half, tenth = F.floor(F.col("_n") / 2), F.least(F.col("_n") - 1, F.floor(F.col("_n") * 0.9))
    # two values of each group are left before anything is grouped
    picks = at.where((F.col("_i") == half) | (F.col("_i") == tenth)).groupBy(F.col(group).alias("_g")).agg(
        F.max(F.when(F.col("_i") == half, F.col(value))).alias("median"), F.max(F.when(F.col("_i") == tenth, F.col(value))).alias("p90")
    )
    return size.join(picks, F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")


def concentration(df: DataFrame, key: str, value: Column, tops: list[int]) -> DataFrame:
    """(top, share): share of the total held by the largest 1, 3, ... keys."""
    per = df.groupBy(key).agg(F.sum(value).alias("v"))
    total = per.agg(F.sum("v").alias("t"))
    top = per.orderBy(F.desc("v"), key).limit(max(tops)).withColumn("rank", F.row_number().over(W.orderBy(F.desc("v"), key)))
    each = top.select("v", "rank", F.explode(F.array(*[F.lit(t) for t in tops])).alias("top")).where("rank <= top").groupBy("top").agg(F.sum("v").alias("v"))
    return each.crossJoin(F.broadcast(total)).select("top", F.round(F.try_divide("v", "t"), 6).alias("share"))


def bucket(value: Column, edges: list[int]) -> Column:
    """Text of the half-open range: ``<=10``, ``11-50``, ..., ``>200``."""
    out = F.when(value <= edges[0], f"<={edges[0]}")
    for a, b in zip(edges, edges[1:]):
        out = out.when(value <= b, f"{a + 1}-{b}")
    return out.when(value.isNotNull(), f">{edges[-1]}")


def buckets(df: DataFrame, value: str, edges: list[int]) -> DataFrame:
    return df.groupBy(bucket(F.col(value), edges).alias("bucket")).agg(F.count("*").alias("n"), F.sum(value).cast("long").alias("weight"))


def presence(df: DataFrame, group: str, fields: list[str]) -> DataFrame:
    """(group, field, n, filled, percent): null, blank text and empty arrays or maps count as empty."""
    kinds = dict(df.dtypes)
    full = lambda c: F.col(c).isNotNull() & ((F.col(c) != "") if kinds[c] == "string" else (F.size(c) > 0) if kinds[c].startswith(("array", "map")) else F.lit(True))
    sums = df.groupBy(group).agg(F.count("*").alias("n"), *[F.count_if(full(c)).alias(f"_{c}") for c in fields])
    long = sums.select(group, "n", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"_{c}").alias("filled")) for c in fields])).alias("x"))
    return long.select(group, "x.field", "n", "x.filled", F.round(100.0 * F.col("x.filled") / F.col("n"), 2).alias("percent"))


def top_share(df: DataFrame, group: str, ident: str, k: int) -> DataFrame:
    """(group, total, ids, top): rows, distinct ids, rows of the k ids with most rows."""
    per = df.groupBy(group, ident).agg(F.count("*").alias("n"))
    ranked = per.withColumn("r", F.row_number().over(W.partitionBy(group).orderBy(F.desc("n"), ident)))
    return ranked.groupBy(group).agg(F.sum("n").alias("total"), F.count("*").alias("ids"), F.sum(F.when(F.col("r") <= k, F.col("n"))).alias("top"))


def true_flags(df: DataFrame, flags: str) -> DataFrame:
    return df.select(F.explode(flags).alias("flag", "on")).where("on").groupBy("flag").agg(F.count("*").alias("n"))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact; null counts as a value.  Each column is grouped by itself, so rows aren't copied for each count."""
    out = None
    for c in columns:
        one = df.groupBy(c).agg(F.lit(1).alias("_")).agg(F.count("*").alias(c))
        out = one if out is None else out.crossJoin(F.broadcast(one))  # one row each
    return out


def pivot_sources(df: DataFrame, resolved: str) -> DataFrame:
    """(tag, source, n) of a map tag -> struct(value, source)."""
    return df.select(F.explode(resolved).alias("tag", "r")).groupBy("tag", F.col("r.source").alias("source")).agg(F.count("*").alias("n"))


def transitions(df: DataFrame, old: Column, new: Column) -> DataFrame:
    return df.where(~old.eqNullSafe(new)).groupBy(F.concat(old, F.lit(" -> "), new).alias("change")).agg(F.count("*").alias("n"))


def weighted_histogram(df: DataFrame, value: str, weight: str, edges: list[float]) -> DataFrame:
    """(bucket, share): half-open [a, b) ranges, shares of the total weight."""
    b = F.when(F.col(value) < edges[0], 0)
    for i, e in enumerate(edges[1:], 1):
        b = b.when(F.col(value) < e, i)
    got = df.groupBy(b.otherwise(len(edges)).alias("bucket")).agg(F.sum(weight).alias("w"))
    return got.crossJoin(F.broadcast(df.agg(F.sum(weight).alias("t")))).select("bucket", F.round(F.try_divide("w", "t"), 6).alias("share"))


def extrapolate(sample: DataFrame, strata: DataFrame, stratum: str, value: str, size: str) -> DataFrame:
    """Sample totals scaled to each stratum's whole."""
    s = sample.groupBy(stratum).agg(F.sum(value).alias("v"), F.sum(size).alias("s"))
    return s.join(strata.select(stratum, F.col(size).alias("whole")), stratum).agg(F.sum(F.col("v") * F.try_divide("whole", "s")).alias("estimate"))


def project_ratios(totals: DataFrame, ratios: DataFrame) -> DataFrame:
    """Transfer, extracted and stored bytes from measured ratios (one row each)."""
    return totals.crossJoin(F.broadcast(ratios)).select("*", (F.col("transfer") * F.col("extract_ratio")).alias("extracted"), (F.col("transfer") * F.col("frame_ratio")).alias("stored"))


def dataset_stats(calcs: DataFrame) -> DataFrame:
    """(key, value, frames, calcs) over parser, run type, functional, licence and resource type, by frame count."""
    n = F.size("frame_ids")
    keys = {"parser": F.col("parser"), "run_type": F.col("calc_parameters.run_type"), "functional": F.col("calc_parameters.functional"), "license": F.col("provenance.license"), "resource_type": F.col("provenance.resource_type")}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.coalesce(c.cast("string"), F.lit("null")).alias("value")) for k, c in keys.items()])).alias("x")
    return calcs.select(n.alias("frames"), each).groupBy("x.key", "x.value").agg(F.sum("frames").alias("frames"), F.count("*").alias("calcs"))


def calc_quality(frames: DataFrame) -> DataFrame:
    """Per calculation: frames, unconverged ones, ones with forces, largest energy deviation per atom, last verdict."""
    return frames.groupBy("calc_id").agg(
        F.count("*").alias("n_frames"), F.count_if(~F.col("electronic_converged")).alias("n_frames_scf_unconverged"), F.count_if(F.col("forces").isNotNull()).alias("n_frames_with_forces"),
        F.max(F.abs(F.col("e_free") - F.col("ref_energy")) / F.col("n_atoms")).alias("max_abs_free_minus_e0_per_atom"), F.max_by("electronic_converged", "ionic_step").alias("electronic_converged"),
    )
