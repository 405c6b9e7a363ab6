"""Deterministic partitioning, sampling and budgets."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ranges(df: DataFrame, order: list[str], parts: int, each: int = 100) -> list:
    """Up to ``parts`` - 1 rows of the order columns that cut the order evenly, from about ``each`` rows a part picked by hash."""
    n = df.count()
    some = df.select(*order).where(F.pmod(F.xxhash64(*order), F.lit(max(1, n // (parts * each)))) == 0).orderBy(*order).limit(4 * parts * each).collect()
    at = sorted({len(some) * i // parts for i in range(1, parts)}) if some else []
    return [some[i] for i in at]


def positions(df: DataFrame, *order: str) -> DataFrame:
    """A dense position from 0 in the given order: a row's range follows from its values alone, so ranges are numbered
    apart and moved by the sizes of those before, however often the plan is evaluated."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = [F.struct(*[F.lit(r[c]).cast(kinds[c]).alias(c) for c in order]) for r in ranges(df, list(order), parts)]
    key = F.struct(*[F.col(c) for c in order])
    at = F.size(F.filter(F.array(*edges), lambda e: e <= key)) if edges else F.lit(0)
    ranged = df.withColumn("_p", at)
    counts = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    before = counts.select("_p", (F.sum("_n").over(W.orderBy("_p")) - F.col("_n")).alias("_b"))  # one row per range
    inner = F.row_number().over(W.partitionBy("_p").orderBy(*order)) - 1
    return ranged.withColumn("_i", inner).join(F.broadcast(before), "_p").withColumn("position", F.col("_b") + F.col("_i")).drop("_p", "_i", "_b")


def round_robin(df: DataFrame, position: str, parts: int) -> DataFrame:
    return df.withColumn("part", F.pmod(F.col(position), F.lit(parts)).cast("int"))


def _lpt(parts: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["weight", "key"], ascending=[False, True], kind="stable")
        heap = [(0, p) for p in range(parts)]
        got = []
        for w in rows["weight"]:
            load, p = heapq.heappop(heap)
            got.append(p)
            heapq.heappush(heap, (load + max(1, int(w)), p))
        return pd.DataFrame({"key": rows["key"], "weight": rows["weight"], "part": got})

    return run


def lpt(groups: DataFrame, key: str, weight: str, parts: int) -> DataFrame:
    """Largest first onto the least loaded part, the lowest on ties.

    The rule is sequential, so all groups meet in one task: pass one row per group (an upload, a record),
    thousands to a few millions of small rows, and join the parts back to the members.
    """
    kind = dict(groups.dtypes)[key]
    g = groups.select(F.col(key).alias("key"), F.col(weight).cast("long").alias("weight"), F.lit(0).alias("_g"))
    return g.groupBy("_g").applyInPandas(lambda pdf: _lpt(parts)(pdf), f"key {kind}, weight long, part int").withColumnRenamed("key", key)


def split_groups(df: DataFrame, group: str, parts: int) -> DataFrame:
    """All rows of a group land in one part."""
    sizes = df.groupBy(group).agg(F.count("*").alias("weight"))
    return df.join(lpt(sizes, group, "weight", parts).select(group, "part"), group)


def even_stride(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """n rows spread evenly over the order: indices int(i * step)."""
    total = df.count()
    if n >= total:
        return df
    got = positions(df, *order)
    i = F.ceil(F.col("position") * n / total)
    return got.where((i < n) & (F.floor(i * total / n) == F.col("position"))).drop("position")


def in_group(df: DataFrame, group: str, order: str) -> DataFrame:
    """Adds a row's number in its group (``_i`` from 0) and the group's size (``_n``): a large group is spread over ranges."""
    at = positions(df, group, order)
    facts = at.groupBy(F.col(group).alias("_g")).agg(F.min("position").alias("_first"), F.count("*").alias("_n"))
    return at.join(facts, F.col(group).eqNullSafe(F.col("_g"))).select(*df.columns, (F.col("position") - F.col("_first")).alias("_i"), "_n")


def stratified_spread(df: DataFrame, stratum: str, order: str, want: int) -> DataFrame:
    """Per stratum rows at round(i * (n - 1) / (want - 1)), half to even; all rows of small strata."""
    at = in_group(df, stratum, order)
    picks = F.transform(F.sequence(F.lit(0), F.lit(want - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / F.lit(max(1, want - 1))).cast("long"))
    return at.where((F.col("_n") <= want) | F.array_contains(picks, F.col("_i"))).drop("_i", "_n")


def running(df: DataFrame, position: str, block: int = 10_000, **sums: str) -> DataFrame:
    """Running sums in the order of a dense position: inside blocks, then moved by the totals of the blocks before."""
    p = df.withColumn("_block", F.floor(F.col(position) / block))
    w = W.partitionBy("_block").orderBy(position)
    tops = p.groupBy("_block").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    ahead = W.orderBy("_block")  # one row per block
    moved = tops.select("_block", *[(F.sum(f"_t_{n}").over(ahead) - F.col(f"_t_{n}")).alias(f"_b_{n}") for n in sums])
    got = p.withColumns({n: F.sum(c).over(w) for n, c in sums.items()}).join(moved, "_block")
    return got.withColumns({n: F.col(n) + F.col(f"_b_{n}") for n in sums}).drop("_block", *[f"_b_{n}" for n in sums])


def budget_prefix(df: DataFrame, order: list[str], size: str, cap: int) -> DataFrame:
    """Smallest first while the running sum stays within the cap; the first row always stays."""
    return running(positions(df, *order), "position", running=size).where((F.col("running") <= cap) | (F.col("position") == 0))


def admit(df: DataFrame, ident: str, position: str, nbytes: str, nfiles: str, max_bytes: int | None, max_files: int | None, rounds: int = 100) -> DataFrame:
    """Staging budget in order: fits, defer (others' data in the way) or never_fits (too large alone).

    A round admits rows up to the first that doesn't fit beside those before it; of the rows behind, only those that
    fit into what is left go on to the next round, the others are deferred.  Running sums are distributed; the driver
    holds one row a round.  What ``rounds`` rounds leave is an error, not a guess.
    """
    most_b, most_f = (2**62 if m is None else m for m in (max_bytes, max_files))
    rows = df.select(F.col(ident).cast("string").alias("id"), F.col(position).cast("long").alias("pos"), F.col(nbytes).cast("long").alias("b"), F.col(nfiles).cast("long").alias("f"))
    alone = (F.col("b") > most_b) | (F.col("f") > most_f)
    open_, taken = rows.where(~alone), []  # pieces of the order that fit: [first, last] within the size left then
    low = None
    for _ in range(rounds):
        at = running(positions(open_, "pos"), "position", sb="b", sf="f")
        over = at.where((F.col("sb") > most_b) | (F.col("sf") > most_f)).agg(F.min("pos").alias("p")).first().p
        cond = F.col("pos") < over if over is not None else F.lit(True)
        used = at.where(cond).agg(F.coalesce(F.max("sb"), F.lit(0)).alias("b"), F.coalesce(F.max("sf"), F.lit(0)).alias("f")).first()
        taken.append((low, over, most_b, most_f))
        if over is None:
            break
        most_b, most_f, low = most_b - used.b, most_f - used.f, over
        open_ = open_.where((F.col("pos") > over) & (F.col("b") <= most_b) & (F.col("f") <= most_f))
        if not open_.limit(1).count():
            break
    else:
        raise RuntimeError(f"admit: not settled after {rounds} rounds")
    # a row fits if, in the round that its place belongs to, it was still open: small enough for what was left then
    inside = F.lit(False)
    for lo, hi, b, f in taken:
        piece = (F.col("b") <= b) & (F.col("f") <= f)
        if lo is not None:
            piece = piece & (F.col("pos") > lo)
        if hi is not None:
            piece = piece & (F.col("pos") < hi)
        inside = inside | piece
    return rows.select("id", "pos", F.when(alone, "never_fits").when(inside, "fits").otherwise("defer").alias("decision"))


def time_ranges(df: DataFrame, ts: str, most: int, least_seconds: int = 1) -> list[tuple]:
    """Half-open ranges of at most ``most`` rows, halved until they fit or are ``least_seconds`` long.

    Rows are counted by second once; a second's range at a depth follows from halving alone, so each round sums the
    histogram by equality with the open ranges.  The driver holds ranges, not rows.
    """
    spark = df.sparkSession
    hist = df.select(F.unix_timestamp(F.col(ts).cast("timestamp")).alias("s")).where("s is not null").groupBy("s").agg(F.count("*").alias("n")).persist()
    lo, hi = hist.agg(F.min("s"), F.max("s")).first()
    if lo is None:
        return []
    halve = lambda acc, _: F.when(F.col("s") >= F.floor((acc["a"] + acc["b"]) / 2), F.struct(F.floor((acc["a"] + acc["b"]) / 2).alias("a"), acc["b"].alias("b"))).otherwise(F.struct(acc["a"].alias("a"), F.floor((acc["a"] + acc["b"]) / 2).alias("b")))
    open_, done, depth = [(lo, hi + 1)], [], 0
    whole = F.struct(F.lit(lo).cast("long").alias("a"), F.lit(hi + 1).cast("long").alias("b"))
    while open_:
        r = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), whole, halve) if depth else whole
        at = hist.select(r.alias("r"), "n").select("r.a", "r.b", "n").join(F.broadcast(spark.createDataFrame(open_, "a long, b long")), ["a", "b"])
        n = {(x.a, x.b): x.n for x in at.groupBy("a", "b").agg(F.sum("n").alias("n")).collect()}
        nxt = []
        for a, b in open_:
            if n.get((a, b), 0) <= most or b - a <= least_seconds:
                done.append((a, b, n.get((a, b), 0)))
            else:
                nxt += [(a, (a + b) // 2), ((a + b) // 2, b)]
        open_, depth = nxt, depth + 1
    hist.unpersist()
    return sorted(done)


def streaks(df: DataFrame, key: str, order: str, failed: str, limit: int) -> DataFrame:
    """First row of each key at which ``limit`` failures in a row are reached (a success resets)."""
    w = W.partitionBy(key).orderBy(order)
    island = F.sum(F.when(~F.col(failed), 1).otherwise(0)).over(w)
    run = df.withColumn("_isl", island).withColumn("streak", F.sum(F.col(failed).cast("int")).over(W.partitionBy(key, "_isl").orderBy(order)))
    return run.where(F.col("streak") == limit).groupBy(key).agg(F.min(order).alias(order))
