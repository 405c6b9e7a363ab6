"""Samples, yields, ranks and pages of counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from provlake.operators.split import even_stride, positions


def thin(df: DataFrame, order: list[str], size: str, budget: int) -> DataFrame:
    """An ordered sample thinned evenly to its budget's share, then without its single largest rows (of equals the
    first) until the rest fits; one row stays at least.  For samples: the running sum is over one window."""
    row = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("t")).first()
    if not row.n or row.t <= budget:
        return df
    picked = even_stride(df, order, max(1, int(row.n * (budget / row.t))))
    at = positions(picked, *order)
    largest = W.orderBy(F.desc(size), "position")
    ranked = at.withColumn("_before", F.coalesce(F.sum(size).over(largest.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn("_r", F.row_number().over(largest))
    total = picked.agg(F.sum(size).alias("_t"), F.count("*").alias("_n"))
    # a row goes as long as what is left with it is over the budget
    kept = ranked.crossJoin(F.broadcast(total)).where((F.col("_t") - F.col("_before") <= budget) | (F.col("_r") == F.col("_n")))
    return kept.select(*df.columns)


def budgeted_sample(df: DataFrame, order: list[str], size: str, n: int, budget: int) -> DataFrame:
    """At most n rows, evenly over the order, that fit the budget together."""
    return thin(even_stride(df, order, n), order, size, budget)


def yields(attempted: DataFrame, fetched: DataFrame, calcs: DataFrame) -> DataFrame:
    """One row: records attempted (recid, bytes), got and parsed, frames, and their ratios (null where nothing was tried).

    ``calcs``: recid, frames, bytes."""
    a = attempted.agg(F.count("*").alias("attempted"))
    got = fetched.select("recid").distinct()
    f = got.agg(F.count("*").alias("fetched"))
    d = attempted.join(got, "recid", "left_semi").agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("downloaded"))
    per = calcs.groupBy("recid").agg(F.sum("frames").alias("frames"), F.sum("bytes").alias("bytes"), F.count("*").alias("calcs"))
    p = per.agg(F.count("*").alias("parsed"), F.coalesce(F.sum("frames"), F.lit(0)).alias("frames"), F.coalesce(F.sum("calcs"), F.lit(0)).alias("calcs"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("stored"))
    row = a.crossJoin(F.broadcast(f)).crossJoin(F.broadcast(d)).crossJoin(F.broadcast(p))
    ratio = lambda x, y, k: F.round(F.col(x) / F.nullif(F.col(y), F.lit(0)), k)
    return row.withColumns({
        "yield_fetch": ratio("fetched", "attempted", 3), "yield_parse": ratio("parsed", "attempted", 3), "bytes_per_frame": ratio("stored", "frames", 1),
        "stored_per_downloaded": ratio("stored", "downloaded", 5), "frames_per_record": ratio("frames", "parsed", 2),
    })


def totals(df: DataFrame, *columns: str) -> DataFrame:
    """One row of sums; nulls count as zero, and no rows give zero."""
    return df.agg(*[F.coalesce(F.sum(F.coalesce(F.col(c), F.lit(0))), F.lit(0)).alias(c) for c in columns])


def by_rank(df: DataFrame, rank: str, concept: str, position: str) -> DataFrame:
    """Rows by falling rank; of equal rank in the order in which their concept was first seen, whatever row stands for it."""
    seen = df.withColumn("first_seen", F.min(position).over(W.partitionBy(concept)))
    return seen.orderBy(F.desc_nulls_last(rank), "first_seen", position)


def top_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n most frequent keys; equal counts in key order."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(n)


def count_page(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """One page of (key, n) in key order behind ``after``: a filter that reaches the scan, before counting."""
    return (df if after is None else df.where(F.col(key) > after)).groupBy(key).agg(F.count("*").alias("n")).orderBy(key).limit(size)


def count_pages(df: DataFrame, key: str, size: int = 1000):
    """All pages, each as its rows; the next starts behind the last key of the one before."""
    after = None
    while rows := count_page(df, key, after, size).collect():
        yield rows
        after = rows[-1][0]
