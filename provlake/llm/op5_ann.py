"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes.

Codes: the sample's principal axes, then a rotation learned by alternating signs and Procrustes steps
(iterative quantization), done from TABLES different starting rotations; a vector's code is the signs of
its rotated coordinates, TABLES * dimension bits.  Codes are split into m substrings of 16 bits, and each
shard of rows has an index from the values of each substring to its rows.  Probing all values within REACH
bits of a query's in every substring retrieves, by the pigeonhole principle, every code within
m * (REACH + 1) - 1 bits, and of the others those that come that near in some substring.  Of what is
retrieved, codes within RADIUS_SHARE of the bits are reranked by exact cosine in double precision.

Every row is indexed and every query searched; the codes alone are learned on a sample of at most SAMPLE
rows, those with the smallest hashes.  Queries, a stated set, meet the rows in blocks: neither side is ever
held whole.  A shard gives each query its best K, so hot vectors add at most K rows per shard and query.  A
query that found fewer than K is searched again without index and radius, by the same plan.

Defined cases: null vectors, zero ones, ones with null or non-finite components, and ones of another
length than most take no part, as candidates or queries; ties go to the smaller id; rows that repeat, also
under one id, are rows of their own: each is a candidate for the others and, as a query, has its own
answer; null ids take no part; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.llm.common import cut, table

SAMPLE, TABLES, REACH, RADIUS_SHARE = 20_000, 4, 4, 0.42
K, EVERY = 5, 50
#: Rows of a shard and queries of a block, which bound a task's memory: vectors move n / BLOCK / 50 + n / SHARD / 50 times.
SHARD, BLOCK, LEAST_SHARD = 65_536, 65_536, 8_192


class Codes:
    def __init__(self, x: np.ndarray, tables: int = TABLES, rounds: int = 30) -> None:
        self.mean = x.mean(0) if len(x) else 0.0
        c = x - self.mean
        _, _, axes = np.linalg.svd(c, full_matrices=False) if len(c) >= c.shape[1] else (0, 0, np.eye(x.shape[1]))
        v, self.maps = c @ axes.T, []
        for t in range(tables):
            r = np.linalg.qr(np.random.RandomState(t).normal(size=(axes.shape[0],) * 2))[0]
            for _ in range(rounds):
                u, _, w = np.linalg.svd(np.sign(v @ r).T @ v)
                r = (u @ w).T
            self.maps.append(axes.T @ r)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        bits = np.concatenate([(x - self.mean) @ m > 0 for m in self.maps], 1)
        packed = np.packbits(bits, axis=1)
        return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))


def masks(reach: int) -> np.ndarray:
    """All 16-bit values of at most ``reach`` ones, the fewest first."""
    v = np.arange(1 << 16, dtype=np.int64)
    n = np.bitwise_count(v)
    return np.concatenate([v[n == k] for k in range(min(reach, 16) + 1)])


class ShardIndex:
    """Rows of one shard by the value of each 16-bit substring of their codes."""

    def __init__(self, codes: np.ndarray, bits: int) -> None:
        n, self.m = len(codes), -(-bits // 16)
        self.codes = np.ascontiguousarray(codes).view(np.uint64)
        self.subs = np.ascontiguousarray(codes).view(">u2").astype(np.int64)[:, : self.m]
        self.rows = np.empty((self.m, n), np.int32)
        self.at = np.empty((self.m, (1 << 16) + 1), np.int32)
        for j in range(self.m):
            order = np.argsort(self.subs[:, j], kind="stable")
            self.rows[j] = order
            self.at[j] = np.searchsorted(self.subs[order, j], np.arange((1 << 16) + 1))
        self.base = np.arange(self.m)[:, None] * n
        self.mark = np.zeros(n, bool)

    def within(self, query: np.ndarray, radius: int, probes: np.ndarray) -> np.ndarray:
        """Rows within ``radius`` bits of the query's code that some substring's probe meets."""
        sub = np.ascontiguousarray(query).view(">u2").astype(np.int64)[: self.m, None] ^ probes[None]
        lo = np.take_along_axis(self.at, sub, 1) + self.base
        count = (np.take_along_axis(self.at, sub + 1, 1) + self.base - lo).ravel()
        full = np.flatnonzero(count)
        lo, count = lo.ravel()[full], count[full]
        if not len(full):
            return full
        ends = np.cumsum(count)
        self.mark[:] = False
        self.mark[self.rows.ravel()[np.repeat(lo - (ends - count), count) + np.arange(ends[-1])]] = True
        rows = np.flatnonzero(self.mark)
        return rows[np.bitwise_count(self.codes[rows] ^ query.view(np.uint64)).sum(1) <= radius]


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exactly the same for equal vectors, wherever they stand."""
    return (x * q).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum()))


_FOUND = pa.schema([("ask", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _search(bits: int, radius: int | None, reach: int, k: int):
    def run(rows: pa.Table, asks: pa.Table) -> pa.Table:
        if not rows.num_rows or not asks.num_rows:
            return _FOUND.empty_table()
        rows = rows.sort_by([("vec_id", "ascending"), ("key", "ascending")])
        ids, keys, x = rows["vec_id"].to_numpy(), rows["key"].to_numpy(), _matrix(rows["x"], rows.num_rows)
        # rough scores take the vectors as they came and choose; the exact ones are in double precision
        unit = x / np.sqrt((x.astype(np.float64) ** 2).sum(1))[:, None].astype(x.dtype)
        index = ShardIndex(_codes(rows["code"]), bits) if radius is not None else None
        probes, every = masks(reach), np.arange(len(ids))
        out: list[list] = [[], [], [], []]
        asked = zip(asks["key"].to_pylist(), asks["vec_id"].to_pylist(), _matrix(asks["x"], asks.num_rows), _codes(asks["code"]))
        for key, qid, q, code in asked:
            at = index.within(code, radius, probes) if index else every
            at = at[keys[at] != key]
            q = q.astype(np.float64)
            if len(at) > 4 * k:
                rough = unit[at] @ (q / np.sqrt((q * q).sum())).astype(x.dtype)
                at = at[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - 1e-4]
            s = cosine(q, x[at].astype(np.float64))
            best = np.lexsort((ids[at], -s))[:k]
            for column, got in zip(out, ([key] * len(best), [qid] * len(best), ids[at[best]].tolist(), s[best].tolist())):
                column += got
        return pa.table(out, schema=_FOUND)

    return run


def _encoder(codes: Codes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(np.float64)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([c.tobytes() for c in codes(x)], pa.binary()), b.column(2)], names=["vec_id", "x", "code", "ask"])

    return run


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x) of the vectors that take part; single precision stays as it is."""
    x = F.col(column)
    x = x if dict(vectors.dtypes)[column] == "array<float>" else x.cast("array<double>")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & F.col("x").isNotNull()).where(
        ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists("x", lambda v: v != 0)
    )


def nearest(vectors: DataFrame, query, k: int = K, reach: int = REACH, radius_share: float = RADIUS_SHARE, sample: int = SAMPLE, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``vectors`` (vec_id, x) where ``query`` holds, its nearest others."""
    spark = vectors.sparkSession
    dims = vectors.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n = dims[0].d, dims[0].n
    vectors = vectors.where(F.size("x") == d)
    # a sample by hash: the same rows however the table is split; a share first, so that few rows are sorted
    h = F.pmod(F.xxhash64("vec_id", "x"), F.lit(1_000_000))
    some = vectors.where(h < int(1_200_000 * min(1.0, sample / n)) + 1000).orderBy(h, "vec_id", "x").limit(sample).select("x").toArrow()
    fit = _matrix(some["x"], some.num_rows).astype(np.float64)
    fit = fit / np.sqrt((fit * fit).sum(1))[:, None]
    kind = f"vec_id long, x {dict(vectors.dtypes)['x']}, code binary, ask boolean"
    coded = vectors.select("vec_id", "x", F.coalesce(query, F.lit(False)).alias("ask")).mapInArrow(_encoder(pickle.loads(pickle.dumps(Codes(fit)))), kind)
    rows = cut(coded.withColumn("key", F.monotonically_increasing_id()), "op5-rows")
    asks = rows.where("ask")
    # a small table is dealt to the tasks there are; how it is dealt changes no result
    shards = max(1, -(-n // shard), min(spark.sparkContext.defaultParallelism, -(-n // LEAST_SHARD)))
    blocks, bits = max(1, -(-asks.count() // block)), TABLES * d

    def search(asks: DataFrame, radius: int | None) -> DataFrame:
        # each shard meets each block of queries: both sides are copied by the number of blocks or shards
        deal = lambda parts, seed: F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(parts)).cast("int")
        left = rows.select("vec_id", "x", "code", "key", deal(shards, 1).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
        right = asks.select("vec_id", "x", "code", "key", deal(blocks, 7).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
        return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(_search(bits, radius, reach, k), "ask long, query_id long, vec_id long, score double")

    got = cut(search(asks, int(radius_share * bits)), "op5-found")
    full = got.groupBy("ask").agg(F.count("*").alias("n")).where(F.col("n") >= k).select("ask")
    short = cut(asks.join(full.withColumnRenamed("ask", "key"), "key", "left_anti").select("vec_id", "x", "code", "key"), "op5-short")
    if short.limit(1).count():
        got = got.join(full, "ask", "left_semi").unionByName(search(short, None))
    # the best K of a query, by an aggregate that holds K rows of each shard
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
    return got.groupBy("ask", "query_id").agg(best.alias("b")).select("query_id", F.posexplode("b").alias("rank", "b")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "b.vec_id", (-F.col("b.s")).alias("score"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(usable(table(spark, sf_dir, "embeddings")), F.col("vec_id") % EVERY == 0)
