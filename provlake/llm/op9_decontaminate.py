"""Benchmark decontamination: a prefix-filtered containment join.

Shingles of the benchmark's windows are ordered by how rare they are in the documents.  A document
can hold a window only if it holds the window's rarest shingle, so that one shingle (the prefix of a
containment join at threshold 1) is the join key.  Position bounds drop candidates whose window
would stick out of the text, and the words of what is left are compared exactly.

Windows are made on the executors and written.  One scan of the documents, whatever the benchmark's size,
marks the words where some window's shingle may stand, by a bit table of at most 2**MOST_BITS bits, and
writes them with the words around; wrong marks cost room and meet no window.  Spark picks the joins by the
sides' sizes.

Defined cases: a null text has no words; a benchmark item without words has no window; null item ids
mark words as hit but are not counted as items; rows repeated in ``documents`` are judged one by one;
repeated benchmark rows count once; empty tables give empty or all-clean results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.llm.common import ALNUM, Words, cut, free_name, gram_hashes, small, steps, table

WINDOW, SHINGLE = 13, 5
#: Bits of the table of marks, at most; marks of a run of words, and runs of a row.
MOST_BITS, MARKS, RUNS = 27, 64, 64

_SCAN = "row_key long, doc_id long, n_words long, runs array<struct<start:int,words:array<string>,hits:array<struct<pos:int,gram:long>>>>"
_WINDOWS = "item string, k int, words array<string>, grams array<struct<offset:int,gram:long>>"
_GRAMS = pa.list_(pa.struct([("offset", pa.int32()), ("gram", pa.int64())]))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _windows(window: int, shingle: int):
    """Each distinct window of each item, with its shingles of k words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 64):
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for x, y in steps(texts):
                w = Words(texts[x:y], ALNUM, True)
                h, by_k = w.hashes(), {}
                for d in range(y - x):
                    first, stop = int(w.bound[d]), int(w.bound[d + 1])
                    size = min(window, stop - first)
                    if not size:
                        continue
                    k = min(shingle, size)
                    g = by_k.setdefault(k, _signed(gram_hashes(h, k)))
                    words, seen = w.text(first, stop), set()
                    rows = []
                    for s in range(stop - first - size + 1):
                        part = tuple(words[s : s + size])
                        if part not in seen:
                            seen.add(part)
                            rows.append((part, [{"offset": o, "gram": int(g[first + s + o])} for o in range(size - k + 1)]))
                    for z in range(0, len(rows), 2000):
                        some = rows[z : z + 2000]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([ids[x + d]] * len(some), pa.string()), pa.array([k] * len(some), pa.int32()), pa.array([r[0] for r in some], pa.list_(pa.string())), pa.array([r[1] for r in some], _GRAMS)],
                            names=["item", "k", "words", "grams"],
                        )

    return run


def mark_tables(wins: DataFrame, most_bits: int = MOST_BITS) -> dict[int, np.ndarray]:
    """By shingle length a table of bits, merged on the executors: 64 bits a row, 2**most_bits bits at most."""
    grams = wins.select("k", F.explode("grams.gram").alias("g"))
    n = {r.k: r.n for r in grams.groupBy("k").agg(F.approx_count_distinct("g").alias("n")).collect()}
    out = {}
    for k, size in n.items():
        bits = min(most_bits, max(16, int(size).bit_length() + 10))
        slot = F.shiftrightunsigned("g", 64 - bits)
        word = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
        got = grams.where(F.col("k") == k).groupBy(F.shiftright(slot, 6).alias("at")).agg(F.bit_or(word).alias("w")).toArrow()
        out[k] = np.zeros(1 << (bits - 6), np.uint64)
        out[k][got["at"].to_numpy()] = got["w"].to_numpy().view(np.uint64)
    return out


def _scanner(marks: dict[int, np.ndarray], window: int, shingle: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            ids, texts, keys = batch.column(0), batch.column(1).to_pylist(), batch.column(2)
            for a, b in steps(texts):
                w = Words(texts[a:b], ALNUM, True)
                h = w.hashes()
                hits: dict[int, list] = {}
                for k, table in marks.items():
                    g = gram_hashes(h, k)
                    slot = g >> np.uint64(64 - 6 - (len(table).bit_length() - 1))
                    at = np.flatnonzero(table[(slot >> np.uint64(6)).view(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1))
                    at = at[w.doc[at] == w.doc[at + k - 1]] if len(at) else at
                    # a shingle as long as its window needs no words around it
                    before, after = (window - shingle, window) if k == shingle else (0, k)
                    for p, v in zip(at.tolist(), _signed(g[at]).tolist()):
                        hits.setdefault(int(w.doc[p]), []).append((p, v, before, after))
                place, n_words, rows = [], [], []
                for d in range(b - a):
                    lo, hi, runs = int(w.bound[d]), int(w.bound[d + 1]), []
                    for p, v, before, after in sorted(hits.get(d, ())):
                        if not runs or p - before > runs[-1][1] or len(runs[-1][2]) >= MARKS:
                            runs.append([max(lo, p - before), lo, []])
                        runs[-1][1] = max(runs[-1][1], min(hi, p + after))
                        runs[-1][2].append((p, v))
                    runs = [{"start": s - lo, "words": w.text(s, e), "hits": [{"pos": p - lo, "gram": v} for p, v in got]} for s, e, got in runs]
                    # a document's first row has its number of words, further ones only more runs
                    for x in range(0, max(1, len(runs)), RUNS):
                        place.append(a + d)
                        n_words.append(None if x else int(w.n[d]))
                        rows.append(runs[x : x + RUNS])
                for x in range(0, len(rows), 512):
                    at = pa.array(place[x : x + 512])
                    yield pa.RecordBatch.from_arrays([keys.take(at), ids.take(at).cast(pa.int64()), pa.array(n_words[x : x + 512], pa.int64()), pa.array(rows[x : x + 512], _RUNS)], names=["row_key", "doc_id", "n_words", "runs"])

    return scan


_RUNS = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.list_(pa.string())), ("hits", pa.list_(pa.struct([("pos", pa.int32()), ("gram", pa.int64())])))]))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, most_bits: int = MOST_BITS, key: str | None = None) -> DataFrame:
    """Per input row: row_key, doc_id, n_words, spans (merged hit words) and items (sorted ids as strings).

    ``key``: a column of written, distinct longs to take as row_key.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    wins = cut(items.mapInArrow(_windows(window, shingle), _WINDOWS).withColumn("win", F.monotonically_increasing_id()), "op9-windows")
    marks = mark_tables(wins, most_bits)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (F.monotonically_increasing_id() if key is None else F.col(key)).alias("row_key"))
    hit = cut(rows.mapInArrow(_scanner(marks, window, shingle), _SCAN), "op9-scan")
    scanned = hit.where("n_words is not null")
    found = None
    if marks:
        runs = hit.select("row_key", F.explode("runs").alias("r"))
        seen = runs.select(F.explode("r.hits.gram").alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
        # rarest first; the smaller gram, then the smaller offset break ties
        each = wins.select("win", F.explode("grams").alias("g")).select("win", F.col("g.gram").alias("gram"), F.col("g.offset").alias("offset"))
        rare = each.join(seen, "gram", "left").groupBy("win").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "offset")).alias("p")).where("p.n > 0")
        prefix = rare.join(wins.select("win", "item", F.col("words").alias("w")), "win").select(F.col("p.gram").alias("gram"), F.col("p.offset").alias("offset"), "item", "w")
        at = runs.select("row_key", F.col("r.start").alias("from"), F.col("r.words").alias("words"), F.explode("r.hits").alias("h"))
        # each mark with no more words than a window that has it may cover
        low = F.greatest(F.lit(0), F.col("h.pos") - F.col("from") - (window - shingle))
        near = at.select("row_key", (F.col("from") + low).alias("start"), F.slice("words", low + 1, 2 * window - shingle).alias("words"), F.col("h.pos").alias("pos"), F.col("h.gram").alias("gram"))
        s = F.col("pos") - F.col("offset")
        found = (
            near.join(prefix, "gram")
            .where((s >= F.col("start")) & (s + F.size("w") <= F.col("start") + F.size("words")))
            .where(F.slice("words", s - F.col("start") + 1, F.size("w")) == F.col("w"))
            .select("row_key", "item", s.alias("s"), (s + F.size("w")).alias("e"))
        )
    clean = F.array().cast("array<string>")
    if found is None:
        return scanned.select("row_key", "doc_id", "n_words", F.array().cast("array<struct<s:int,e:int>>").alias("spans"), clean.alias("items"))
    merged = F.expr(
        "aggregate(array_sort(sp), cast(array() as array<struct<s:int,e:int>>), (a, x) -> "
        "if(size(a) > 0 and element_at(a, -1).e >= x.s, "
        "concat(slice(a, 1, size(a) - 1), array(named_struct('s', element_at(a, -1).s, 'e', greatest(element_at(a, -1).e, x.e)))), concat(a, array(x))))"
    )
    per = found.groupBy("row_key").agg(F.collect_set(F.struct("s", "e")).alias("sp"), F.array_sort(F.collect_set("item")).alias("items")).select("row_key", merged.alias("spans"), "items")
    return scanned.select("row_key", "doc_id", "n_words").join(per, "row_key", "left").select("row_key", "doc_id", "n_words", F.coalesce("spans", F.array().cast("array<struct<s:int,e:int>>")).alias("spans"), F.coalesce("items", clean).alias("items"))


def verdicts(docs: DataFrame, benchmark: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    return judged(decontaminate(docs, benchmark, most_bits=most_bits)).drop("row_key")


def judged(got: DataFrame) -> DataFrame:
    hit = F.expr("aggregate(spans, 0L, (a, x) -> a + (x.e - x.s))")
    return got.select(
        "row_key", "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: contaminated rows go, each judged by its own text."""
    key = free_name(docs, "op9_row")
    rows = cut(docs.withColumn(key, F.monotonically_increasing_id()), "op9-docs")
    bad = judged(decontaminate(rows, table(spark, sf_dir, "benchmark"), key=key)).where("contaminated")
    return rows.join(bad.select(F.col("row_key").alias(key)), key, "left_anti").select(docs.columns)
