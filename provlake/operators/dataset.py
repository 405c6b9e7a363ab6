"""Integrity, units, verdicts, merge, prune, purge and enrichment of a dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from provlake.functions import files as ff


def bijection(meta: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """(key, in_meta, on_disk, state) for keys that don't match one to one; counts come before the join.

    Duplicates on disk are reported only for keys that the metadata knows; others are orphans.
    """
    m = meta.groupBy(key).agg(F.count("*").alias("in_meta"))
    d = stored.groupBy(key).agg(F.count("*").alias("on_disk"))
    j = m.join(d, key, "full_outer").select(key, F.coalesce("in_meta", F.lit(0)).alias("in_meta"), F.coalesce("on_disk", F.lit(0)).alias("on_disk"))
    state = F.when(F.col("on_disk") == 0, "missing").when(F.col("in_meta") == 0, "orphan").when(F.col("on_disk") > 1, "duplicate_on_disk").when(F.col("in_meta") > 1, "duplicate_in_meta")
    return j.withColumn("state", state).where("state is not null")


def integrity(meta: DataFrame, stored: DataFrame, key: str, truncated: int = 0, examples: int = 10) -> DataFrame:
    """(state, n, examples, fatal): orphans are a warning only if some shard is cut off."""
    bad = bijection(meta, stored, key)
    # the smallest few keys of each state, without gathering the rest
    first = bad.withColumn("r", F.row_number().over(W.partitionBy("state").orderBy(key))).where(F.col("r") <= examples)
    ex = first.groupBy("state").agg(F.array_sort(F.collect_list(F.col(key).cast("string"))).alias("examples"))
    fatal = (F.col("state") != "orphan") | F.lit(truncated == 0)
    return bad.groupBy("state").agg(F.count("*").alias("n")).join(ex, "state").withColumn("fatal", fatal)


def group_units(listing: DataFrame, record: str = "recid", path: str = "path") -> DataFrame:
    """(recid, dir, tag, files): one primary makes the directory a unit; several make a unit per tag that shares untagged inputs."""
    f = listing.select(record, F.col(path).alias("path"), ff.dirname(F.col(path)).alias("dir"), ff.role(F.col(path)).alias("role")).where("role is not null")
    f = f.withColumn("primary", F.col("role").isin(*ff.PRIMARY)).withColumn("tag", ff.unit_tag(F.col("path")))
    n = f.groupBy(record, "dir").agg(F.count_if("primary").alias("primaries")).where("primaries > 0")
    f = f.join(n, [record, "dir"])
    whole = f.where("primaries = 1").withColumn("unit", F.lit(""))
    tagged = f.where("primaries > 1")
    tags = tagged.where("primary").select(record, "dir", F.col("tag").alias("unit")).distinct()
    own = tagged.join(tags, [record, "dir"]).where("tag = unit or (tag = '' and not primary)")
    canonical = F.lower(ff.basename(F.col("path"))) != "vasprun.xml"
    best = whole.unionByName(own).groupBy(record, "dir", "unit", "role").agg(F.min(F.struct(canonical.alias("odd"), "path")).alias("b"))
    return best.groupBy(record, "dir", "unit").agg(F.map_from_entries(F.collect_list(F.struct("role", F.col("b.path")))).alias("files"))


def unreferenced(listing: DataFrame, units: DataFrame, record: str = "recid", path: str = "path") -> DataFrame:
    used = units.select(record, F.explode(F.map_values("files")).alias(path)).distinct()
    return listing.join(used, [record, path], "left_anti")


def heavy_files(units: DataFrame, heavy: DataFrame, record: str = "recid") -> DataFrame:
    """Per unit: map of heavy kind to its first path, from files of the same directory."""
    h = heavy.select(record, ff.dirname(F.col("path")).alias("dir"), ff.heavy_kind(F.col("path")).alias("kind"), "path").where("kind is not null")
    first = h.groupBy(record, "dir", "kind").agg(F.min("path").alias("path"))
    return units.join(first.groupBy(record, "dir").agg(F.map_from_entries(F.collect_list(F.struct("kind", "path"))).alias("heavy")), [record, "dir"], "left")


def peek_verdict(archives: DataFrame, record: str = "recid") -> DataFrame:
    """confirmed, negative (every archive a readable zip, none nested, none with a name) or gap."""
    a = archives.groupBy(record).agg(F.bool_or("has_names").alias("yes"), F.bool_and(F.col("readable") & ~F.col("nested")).alias("sure"))
    return a.select(record, F.when(F.col("yes"), "confirmed").when(F.col("sure"), "negative").otherwise("gap").alias("verdict"))


def zip_plan(members: DataFrame, archive: str = "archive", most: int = 128, big: int = 10 * 10**9, skip: int = 50 * 10**6) -> DataFrame:
    """Per archive: empty, whole (nested, not worthwhile or too many targets) or targeted."""
    want = ff.is_fetch_name(F.col("name")) & ~ff.is_junk(F.col("name"))
    nested = ff.archive_kind(F.col("name"), bare=False).isNotNull()
    a = members.groupBy(archive).agg(
        F.count_if(want).alias("targets"), F.bool_or(nested).alias("nested"), F.bool_or("zip64").alias("zip64"), F.sum("compressed_size").alias("total"), F.coalesce(F.sum(F.when(~want, F.col("compressed_size"))), F.lit(0)).alias("skipped")
    )
    plan = (
        F.when(F.col("nested"), "whole_nested").when(F.col("targets") == 0, "proven_empty").when(F.col("targets") > most, "whole_many")
        .when(F.col("zip64") | (F.col("total") >= big) | (F.col("skipped") >= skip), "targeted").otherwise("whole_small")
    )
    return a.withColumn("plan", plan)


def stream_plan(members: DataFrame, group: str, rate: float, interval: float, batch: int = 256) -> DataFrame:
    """Targeted ranges or the whole span, by modelled seconds at the current rate (1 MiB/s at least)."""
    speed = max(rate, float(1 << 20))
    end = F.col("offset") + 30 + F.length("name") + 512 + F.col("compressed_size")
    a = members.groupBy(group).agg(F.count("*").alias("n"), F.sum("compressed_size").alias("wanted"), (F.max(end) - F.min("offset")).alias("span"))
    t = F.greatest((F.ceil(F.col("n") / batch) + 1) * interval, F.col("wanted") / speed)
    w = interval + F.col("span") / speed
    return a.select("*", t.alias("t_targeted"), w.alias("t_whole")).withColumn("plan", F.when((F.col("n") <= batch) | (F.col("wanted") <= 0) | (F.col("t_targeted") <= F.col("t_whole")), "targeted").otherwise("whole"))


def trim_oversized(files: Column, sizes: Column, cap: int) -> Column:
    """Files of a unit that fit the cap; an empty map if none does (reject)."""
    return F.map_filter(files, lambda role, path: F.coalesce(F.element_at(sizes, path), F.lit(0)) <= cap)


def choose_primary(entry_files: Column, mainfile: Column) -> Column:
    """The main file if it is a primary, else the first vasprun, else the first outcar."""
    pick = lambda role: F.get(F.filter(entry_files, lambda p: ff.role(p) == role), 0)
    return F.coalesce(F.when(ff.role(mainfile).isin(*ff.PRIMARY), mainfile), pick("vasprun"), pick("outcar"))


def merge_shards(into: DataFrame, sources: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(rows of all inputs with shards renumbered after the destination's, (source, old, new) map)."""
    top = into.select(F.explode("shards").alias("s")).agg(F.max(shard_index(F.col("s"))).alias("m"))
    names = None
    for i, s in enumerate(sources):
        n = s.select(F.lit(i).alias("source"), F.explode("shards").alias("old")).distinct()
        names = n if names is None else names.unionByName(n)
    w = W.orderBy("source", shard_index(F.col("old")), "old")  # shard names only, one per ~10k frames
    names = names.crossJoin(F.broadcast(top)).select("source", "old", F.format_string("shard-%05d.extxyz.gz", (F.coalesce("m", F.lit(-1)) + F.row_number().over(w)).cast("int")).alias("new"))
    mapping = names.groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("old", "new"))).alias("m"))
    out = into
    for i, s in enumerate(sources):
        moved = s.crossJoin(F.broadcast(mapping.where(F.col("source") == i).select("m"))).withColumn("shards", F.transform("shards", lambda x: F.element_at(F.col("m"), x))).drop("m")
        out = out.unionByName(moved, allowMissingColumns=True)
    return out, names


def shard_index(path: Column) -> Column:
    return F.regexp_extract(path, r"(\d+)\D*$", 1).try_cast("int")


def merge_conflicts(into: DataFrame, sources: list[DataFrame], key: str = "calc_id") -> DataFrame:
    all_ = into.select(key)
    for s in sources:
        all_ = all_.unionByName(s.select(key))
    return all_.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def merge_problems(into: DataFrame, sources: list[DataFrame], stored: DataFrame, key: str = "calc_id") -> DataFrame:
    """(problem, what, n) that forbid a merge: ids that several inputs have, and listed shards that aren't stored (shard)."""
    clash = merge_conflicts(into, sources, key).select(F.lit("duplicate_id").alias("problem"), F.col(key).cast("string").alias("what"), "n")
    listed = into.select("shards")
    for s in sources:
        listed = listed.unionByName(s.select("shards"))
    named = listed.select(F.explode("shards").alias("shard")).groupBy("shard").agg(F.count("*").alias("n"))
    return clash.unionByName(named.join(stored.select("shard").distinct(), "shard", "left_anti").select(F.lit("missing_shard").alias("problem"), F.col("shard").alias("what"), "n"))


def prune_uncommitted(frames: DataFrame, calcs: DataFrame) -> DataFrame:
    """Frames that some metadata row lists."""
    return frames.join(calcs.select(F.explode("frame_ids").alias("frame_id")).distinct(), "frame_id", "left_semi")


def purge_plan(units: DataFrame, done: DataFrame, record: str = "recid") -> DataFrame:
    """(recid, action, files): purge when every unit is parsed, else keep with a reason; files that only parsed units use are free."""
    j = units.join(done.select("calc_id").distinct().withColumn("ok", F.lit(True)), "calc_id", "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    per = j.groupBy(record).agg(F.bool_and("ok").alias("all"), F.count_if("ok").alias("parsed"), F.count("*").alias("units"))
    paths = j.select(record, "ok", F.explode(F.map_values("files")).alias("path")).groupBy(record, "path").agg(F.bool_and("ok").alias("free")).where("free")
    free = paths.groupBy(record).agg(F.count("*").alias("free_files"))
    action = F.when(F.col("all"), "purge").when(F.col("parsed") > 0, "partial").otherwise("keep")
    return per.join(free, record, "left").select(record, action.alias("action"), F.when(~F.col("all"), F.format_string("%d of %d units parsed", "parsed", "units")).alias("reason"), F.coalesce("free_files", F.lit(0)).alias("free_files"))


def ancestors(path: Column) -> Column:
    """Every directory above a path, the nearest last."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).otherwise(F.array().cast("array<string>"))


def nearest_ancestor(paths: DataFrame, dirs: DataFrame, value: str) -> DataFrame:
    """Each path with the value of the nearest directory above it: an equality join on exploded ancestors."""
    up = paths.select("path", F.posexplode(ancestors(F.col("path"))).alias("depth", "dir"))
    return paths.join(up.join(dirs.select("dir", value), "dir").groupBy("path").agg(F.max_by(value, "depth").alias(value)), "path", "left")


# What a folder's units make of it, the strongest first.
STRENGTH = ("pending", "recoverable", "parsed")


def folder_status(units: DataFrame) -> DataFrame:
    """(dir, status): the strongest status among a folder's units (units: dir, status)."""
    rank = F.array_position(F.array(*[F.lit(x) for x in STRENGTH]), F.col("status"))
    return units.groupBy("dir").agg(F.min_by("status", F.when(rank > 0, rank).otherwise(len(STRENGTH) + 1)).alias("status"))


def reclaimable(paths: DataFrame, dirs: DataFrame) -> DataFrame:
    """Paths none of whose ancestors is kept (dirs: dir, keep)."""
    kept = dirs.groupBy("dir").agg(F.bool_or("keep").alias("keep")).where("keep")
    up = paths.select("path", F.explode(ancestors(F.col("path"))).alias("dir"))
    return paths.join(up.join(kept, "dir", "left_semi").select("path").distinct(), "path", "left_anti")


def enrich(calcs: DataFrame) -> DataFrame:
    """Adds ``resolved`` and ``computes_stress``; running it again changes nothing."""
    from provlake.functions import physics

    p = F.col("calc_parameters")
    return calcs.withColumn("resolved", physics.resolve_all(p["incar"], p["parameters"], p["run_type"])).withColumn("computes_stress", physics.computes_stress(F.col("quality.n_frames_with_stress")))


def apply_net_properties(calcs: DataFrame, updates: DataFrame) -> DataFrame:
    """Electronic and quality blocks from a map of calculations; values that are there stay where the map has null."""
    j = calcs.join(updates.select("calc_id", F.struct(*[c for c in updates.columns if c != "calc_id"]).alias("_u")), "calc_id", "left")
    cols = [F.coalesce(F.col("_u")[c], F.col(c)).alias(c) if c in updates.columns and c != "calc_id" else F.col(c) for c in calcs.columns]
    return j.select(*cols)


def apply_per_step(frames: DataFrame, updates: DataFrame, value: str) -> DataFrame:
    """Frames with a value by calculation and ionic step from a map of text step to value."""
    return frames.join(updates.select("calc_id", "per_step"), "calc_id", "left").withColumn(value, F.element_at("per_step", F.col("ionic_step").cast("string"))).drop("per_step")


def sane_labels(energy: Column, n_atoms: Column) -> Column:
    per = energy / n_atoms
    return energy.isNotNull() & ~F.isnan(energy) & (F.abs(energy) != float("inf")) & (per > -15) & (per < 8)


def refresh(calcs: DataFrame, new: DataFrame, parser: str, block: str, poor: Column) -> DataFrame:
    """Rows of one parser whose ``block`` is poor get it from a map of ids; others and ids without a new block stay."""
    j = calcs.join(new.select("calc_id", F.col(block).alias("_new")), "calc_id", "left")
    guard = (F.col("parser") == parser) & poor & F.col("_new").isNotNull()
    return j.select(*[F.when(guard, F.col("_new")).otherwise(F.col(c)).alias(c) if c == block else F.col(c) for c in calcs.columns])


def repair_targets(calcs: DataFrame, parser: str | None, missing: Column | None = None) -> DataFrame:
    """(record, calc_id) that a repair is for: of one parser, and only those that lack something if ``missing`` is given."""
    from provlake.functions.records import record_id

    rows = calcs if parser is None else calcs.where(F.col("parser") == parser)
    return (rows if missing is None else rows.where(missing)).select(record_id(F.col("calc_id")).alias("record"), "calc_id").distinct()


def net_properties(moment: Column, moment_source: Column, neutral: Column, nelect: Column, nsw: Column, ibrion: Column, ediffg: Column, steps: Column, known: Column) -> Column:
    """struct(net_magnetization, net_charge, magnetization_source, ionic_converged): what is known already stays."""
    from provlake.functions import physics

    return F.struct(
        moment.alias("net_magnetization"), physics.net_charge(neutral, nelect).alias("net_charge"), F.when(moment.isNotNull(), moment_source).otherwise("unavailable").alias("magnetization_source"),
        F.coalesce(known, physics.ionic_converged(nsw, ibrion, ediffg, steps)).alias("ionic_converged"),
    )


def rewind(table: DataFrame, redo: DataFrame, on: str) -> DataFrame:
    """A new snapshot without the rows that are to be done again."""
    return table.join(redo.select(on).distinct(), on, "left_anti")


def part_complete(budget_stopped: Column, pending: Column, new_rejections: Column) -> Column:
    return ~budget_stopped & (pending == 0) & (new_rejections == 0)
