"""SimHash near-duplicates found with the pigeonring principle.

A fingerprint is cut into M segments on a ring.  If two fingerprints differ in at most T bits, some
segment starts a chain in which every l consecutive segments differ in at most floor(l * T / M) bits
together.  Chains of no allowed difference make the join key, longer ones prune pairs before the full
Hamming check.  Fingerprints of a crowded key are linked through their neighbours at distance one
instead: two fingerprints are within two bits exactly if such neighbourhoods (65 values each, so at
most 65 fingerprints share a value) meet.  No pair of a crowded key is ever formed.

Defined cases: no words (null or blank text) gives fingerprint zero, linked like any other; fewer than
three words make one shingle; rows repeated in the table come back as often as they came; rows with a
null doc_id get a fingerprint and join their component without lowering its id; empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from provlake.llm.common import LOWER, cut, doc_columns, drop_cut, free_name, small, table
from provlake.llm.graph import components

SEED, BITS, WITHIN = 42, 3, 2
SEGMENTS = 7
#: Fingerprints under one key beyond which the key is handled by neighbourhoods.
CROWDED = 64


def fingerprint(text: str | None, width: int = BITS) -> int:
    words = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(flat, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[: -width] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(flat[a:b], SEED) for a, b in zip(starts.tolist(), ends[width - 1 :].tolist())]
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[a : a + (1 << 16)], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches):
        got = np.array([fingerprint(t) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(got)], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    return doc_columns(docs).mapInArrow(_prints, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def segment_masks(m: int = SEGMENTS) -> list[int]:
    cuts = [round(i * 64 / m) for i in range(m + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]


def links(fps: DataFrame, within: int = WITHIN, m: int = SEGMENTS, crowded: int = CROWDED) -> tuple[DataFrame, list[DataFrame]]:
    """(u, v) for distinct fingerprints (fp, rep): links that connect all pairs within two bits; and the written tables behind them."""
    if within != 2:
        raise ValueError("the neighbourhood path is made for two bits")
    masks = segment_masks(m)
    budget = [chain * within // m for chain in range(1, m + 1)]
    exact = budget.count(0)
    over = lambda i, n: _signed(sum(masks[(i + j) % m] for j in range(n)))
    entry = F.explode(F.array(*[F.struct(F.lit(i).alias("ring"), F.col("fp").bitwiseAND(F.lit(over(i, exact))).alias("key")) for i in range(m)])).alias("e")
    entries = fps.select("fp", "rep", entry).select("fp", "rep", "e.ring", "e.key")
    counts = cut(entries.groupBy("ring", "key").agg(F.count("*").alias("n")).where("n > 1"), "op4-keys")
    shared = cut(entries.join(counts, ["ring", "key"]), "op4-entries")
    few = shared.where(F.col("n") <= crowded)
    a, b = few.alias("a"), few.select("ring", "key", F.col("fp").alias("fp2"), F.col("rep").alias("rep2")).alias("b")
    diff = F.col("fp").bitwiseXOR(F.col("fp2"))
    chains = F.lit(True)
    for n in range(exact + 1, m):
        if budget[n - 1] < budget[n]:  # the tightest chain of each budget
            mask = F.element_at(F.array(*[F.lit(over(i, n)) for i in range(m)]), F.col("ring") + 1)
            chains = chains & (F.bit_count(diff.bitwiseAND(mask)) <= budget[n - 1])
    pairs = a.join(b, ["ring", "key"]).where((F.col("fp") < F.col("fp2")) & chains & (F.bit_count(diff) <= within))
    pairs = pairs.select(F.col("rep").alias("u"), F.col("rep2").alias("v"))
    near = F.explode(F.array(F.lit(0), *[F.lit(_signed(1 << i)) for i in range(64)])).alias("flip")
    hot = shared.where(F.col("n") > crowded).select("fp", "rep").distinct()
    meet = hot.select("rep", F.col("fp").alias("fp0"), near).groupBy(F.col("fp0").bitwiseXOR(F.col("flip")).alias("at"))
    stars = meet.agg(F.collect_list("rep").alias("reps")).where(F.size("reps") > 1).select(F.array_min("reps").alias("v"), F.explode("reps").alias("u"))
    return pairs.unionByName(stars.select("u", "v").where("u <> v")).distinct(), [counts, shared]


def labels(prints: DataFrame, node: str) -> DataFrame:
    """fp, component_id of each fingerprint: the smallest ``node`` of its component."""
    # groups whose nodes are all null stay alone
    fps = cut(prints.groupBy("fp").agg(F.min(node).alias("rep")).where("rep is not null"), "op4-distinct")
    near, written = links(fps)
    comp = components(near)
    got = cut(fps.join(comp, fps["rep"] == comp["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id")), "op4-labels")
    drop_cut(fps, *written)
    return got


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id for every row."""
    prints = cut(fingerprints(docs), "op4-prints")
    return prints.join(labels(prints, "doc_id"), "fp", "left").select("doc_id", "fp", "component_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _beside(text: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            got = np.array([fingerprint(t) for t in b.column(text).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got)], names=names)

    return run


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each component stays, that of the smallest doc_id; rows without an id come last."""
    fp, key = free_name(docs, "op4_fp"), free_name(docs, "op4_row")
    schema = StructType([*docs.schema.fields, StructField(fp, LongType())])
    # ids may be null or repeated: rows are told apart by a key written with the fingerprints
    rows = cut(docs.mapInArrow(_beside(docs.columns.index("text"), schema.names), schema).withColumn(key, F.monotonically_increasing_id()), "op4-rows")
    prints = rows.select(F.col(fp).alias("fp"), F.col(key).alias("row"), F.col("doc_id").alias("id"))
    best = prints.join(labels(prints, "row"), "fp").groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("m"))
    return rows.join(best.select(F.col("m.row").alias(key)), key, "left_semi").select(docs.columns)
