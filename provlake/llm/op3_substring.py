"""Substring dedup: every word in a 35-word window whose words also start elsewhere goes.

Windows are dealt by their minimizer, the smallest hash among their 8-word shingles: equal windows have
equal minimizers.  A stretch of windows with one minimizer is a segment.
1. One scan counts minimizer places; a minimizer with one place cannot be in a repeated window.
2. Segments of the others are grouped by their whole word sequence (a 64-bit hash beside the 64-bit
   minimizer).  Segments that occur twice are repeated throughout; they need no comparison, however
   many copies there are.
3. The segments that occur once go, with those of the same minimizer, to shards.  Each shard builds a
   compressed FM-index (``fm_index``) over the words themselves and streams its segments through it;
   backward search gives the stretches that occur twice or more.
4. A minimizer with more than CROWDED different segments is not sent to one shard.  Equal windows have its
   first place in them at the same offset, so each segment is cut at fixed offsets into blocks of up to
   BLOCK windows, a row each, and the words that all windows of a block share are its core.  A core that
   occurs once has no repeated window; blocks that occur twice are repeated throughout; only the windows
   of the others are counted one by one, by their own hash, which spreads over all tasks.
5. Each document's stretches are joined with its text again and the words in them removed.

Defined cases: null and blank texts have no words and come back empty; fewer than 35 words are kept as
they are; rows that repeat count as occurrences of each other and come back as often as they came (a
null doc_id included); an empty table stays empty; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.llm.common import SPACES, Words, cut, drop_cut, free_name, give_back, gram_hashes, mix, small, steps, table
from provlake.llm.fm_index import FMIndex, repeated_windows

WINDOW, SHINGLE = 35, 8
CROWDED = 500
#: Windows of a crowded minimizer's segment that share a core and a row.
BLOCK = 7
#: Words that one shard's index holds, about.
SHARD_WORDS = 100_000


def _sliding(x: np.ndarray, width: int, f) -> np.ndarray:
    """f over each ``width`` neighbours (f: np.minimum or np.maximum)."""
    n, step, out = len(x), 1, x
    while 2 * step <= width:
        out = f(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return f(out[: n - width + 1], out[rest : rest + n - width + 1]) if rest else out[: n - width + 1]


class Segments:
    """Segments of the texts of one step."""

    def __init__(self, texts: list[str | None], window: int, shingle: int) -> None:
        self.w = w = Words(texts, SPACES, False)
        self.h = h = w.hashes()
        n = len(h)
        span = window - shingle + 1  # shingles of a window
        if n < window:
            self.doc = self.start = self.count = self.key = self.print = self.places = np.zeros(0, np.int64)
            return
        g = gram_hashes(h, shingle)
        low = _sliding(g, span, np.minimum)  # of window i: shingles i .. i + span - 1
        ok = w.doc[: n - window + 1] == w.doc[window - 1 :]
        # a shingle is a place of its minimizer if some window within the text has it as its smallest
        padded = np.zeros(len(g) + span - 1, np.uint64)
        padded[span - 1 : span - 1 + len(low)] = np.where(ok, low, np.uint64(0))
        place = _sliding(padded, span, np.maximum) == g
        new = ok.copy()
        new[1:] &= ~(ok[:-1] & (low[1:] == low[:-1]) & (w.doc[1 : len(low)] == w.doc[: len(low) - 1]))
        first = np.flatnonzero(new)
        stop = np.flatnonzero(ok & ~np.append(ok[1:] & ~new[1:], False)) + 1
        self.doc, self.count = w.doc[first], stop - first
        self.start = first - w.bound[self.doc]
        self.key = low[first].view(np.int64)
        at = np.concatenate(([0], np.cumsum(place)))
        # places of the segment's own minimizer among its shingles: those equal to it
        same = at[stop + span - 1] - at[first]
        one = same == 1
        self.places = same.astype(np.int64)
        for i in np.flatnonzero(~one):
            self.places[i] = int((g[first[i] : stop[i] + span - 1] == low[first[i]]).sum())
        # the hash of the whole word sequence: a polynomial over the word hashes
        c = np.zeros(n + 1, np.uint64)
        pw, iv = _powers(n)
        np.cumsum(h * pw[:n], out=c[1:])
        length = self.count + window - 1
        self.print = mix((c[first + length] - c[first]) * iv[first] + length.astype(np.uint64)).view(np.int64)


_B = np.uint64(0xA0761D6478BD642F)
_P: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _P or len(_P[0]) < n:
        n = max(n, 1 << 20)
        p, v = np.full(n, _B, np.uint64), np.full(n, np.uint64(pow(int(_B), -1, 1 << 64)), np.uint64)
        p[0] = v[0] = 1
        _P[:] = [np.multiply.accumulate(p), np.multiply.accumulate(v)]
    return _P[0], _P[1]


_ANCHORS = "doc_key struct<id:long,h:long>, key long, print long, start int, count int, places int"
_KEY = pa.struct([("id", pa.int64()), ("h", pa.int64())])


def _anchors(window: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            keys, texts = b.column(0), b.column(1).to_pylist()
            for x, y in steps(texts):
                s = Segments(texts[x:y], window, shingle)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(x, y - x).take(pa.array(s.doc)), pa.array(s.key), pa.array(s.print), pa.array(s.start.astype(np.int32)), pa.array(s.count.astype(np.int32)), pa.array(s.places.astype(np.int32))],
                    names=["doc_key", "key", "print", "start", "count", "places"],
                )

    return run


_TEXTS = "shard int, key long, print long, many boolean, hot boolean, words string, core long, wins array<long>, at array<int>"


def _blocks(h: np.ndarray, key: int, window: int, shingle: int) -> dict[tuple[int, tuple[int, ...]], list[int]]:
    """(core, hashes of its windows) of each block of a segment, and at which windows such a block begins."""
    each, i = min(BLOCK, window), np.arange(len(h) - window + 1)
    place = np.flatnonzero(gram_hashes(h, shingle).view(np.int64) == key)
    first = place[np.searchsorted(place, i)]  # the minimizer's first place in each window
    core = first - (first - i) // each * each
    wins, cores = gram_hashes(h, window).view(np.int64).tolist(), gram_hashes(h, window - each + 1).view(np.int64)
    new = [0, *(np.flatnonzero(np.diff(first * (len(h) + 1) + core)) + 1).tolist()]
    out: dict[tuple[int, tuple[int, ...]], list[int]] = {}
    for a, b, c in zip(new, [*new[1:], len(i)], cores[core[new]].tolist()):
        out.setdefault((c, tuple(wins[a:b])), []).append(a)
    return out


def _needed(window: int, shingle: int, shards: int):
    """The words of needed segments; for crowded minimizers the segments' blocks instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            texts, needs = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows: list[tuple] = []
            for text, need in zip(texts, needs):
                w = Words([text], SPACES, False)
                h = w.hashes() if any(x["hot"] for x in need) else None
                for x in need:
                    a, n = x["start"], x["count"] + window - 1
                    if x["hot"]:
                        rows += [(0, x["key"], x["print"], x["many"], True, None, *block, at) for block, at in _blocks(h[a : a + n], x["key"], window, shingle).items()]
                    else:
                        rows.append((x["key"] % shards, x["key"], x["print"], x["many"], False, " ".join(w.text(a, a + n)), None, None, None))
                while len(rows) >= 20_000:
                    yield _pack(rows[:20_000])
                    del rows[:20_000]
            if rows:
                yield _pack(rows)

    return run


def _pack(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["shard", "key", "print", "many", "hot", "words", "core", "wins", "at"])


_COVER = "key long, print long, spans array<struct<s:int,e:int>>"


def _search(window: int):
    """One shard: index all its segments, stream those that occur once, report what repeats."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        give_back()
        rows = rows.sort_values(["key", "print"], kind="stable").reset_index(drop=True)
        words = [t.split(" ") for t in rows["words"]]
        number: dict[str, int] = {}
        flat: list[int] = []
        start = []
        for ws in words:
            flat.append(0)
            start.append(len(flat))
            flat.extend([number.setdefault(x, len(number) + 1) for x in ws])
        seq = np.array([*flat, 0], np.int64)
        index = FMIndex(seq, len(number) + 1)
        ask = np.flatnonzero(~rows["many"].to_numpy(bool))
        begin = np.array(start, np.int64)[ask]
        count = np.array([len(words[i]) - window + 1 for i in ask], np.int64)
        found = repeated_windows(index, seq, begin, count, window)
        got = [(rows["key"][i], rows["print"][i], merge([(s, s + window) for s in sorted(f)])) for i, f in zip(ask, found) if f]
        return pd.DataFrame({"key": [g[0] for g in got], "print": [g[1] for g in got], "spans": [[{"s": s, "e": e} for s, e in g[2]] for g in got]}, columns=["key", "print", "spans"], dtype=object)

    return run


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in spans:
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _doc_key():
    text = F.col("text").cast("string")
    return F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("id"), F.xxhash64("doc_id", text, F.length(text)).alias("h"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(_doc_key().alias("doc_key"), F.col("text").cast("string").alias("text"))


def _crowded(hot: DataFrame, window: int) -> tuple[DataFrame, list[DataFrame]]:
    """(key, print, spans) of repeated windows of crowded minimizers; and the written tables behind it."""
    hot = hot.select("key", "print", "many", "core", "wins", "at", F.size("at").alias("n"))
    twice = hot.groupBy("core").agg(F.sum("n").alias("n"), F.bool_and("many").alias("many")).where("n > 1 and not many").select("core")
    left = cut(hot.join(twice, "core"), "op3-blocks")
    runs = cut(left.groupBy("core", "wins").agg(F.sum("n").alias("n"), F.bool_and("many").alias("many")), "op3-runs")
    once = runs.where("n = 1 and not many")
    seen = runs.join(once.select("core").distinct(), "core", "left_semi").select("core", F.explode("wins").alias("win"))
    seen = cut(seen.groupBy("core", "win").agg(F.count("*").alias("n")).where("n > 1").select("core", "win"), "op3-again")
    ask = left.where("not many").select("key", "print", "core", "wins", "at")
    whole = ask.join(runs.where("n > 1").select("core", "wins"), ["core", "wins"]).select("key", "print", F.explode("at").alias("s"), (F.size("wins") - 1).alias("more"))
    part = ask.join(once.select("core", "wins"), ["core", "wins"]).select("key", "print", "core", F.col("at")[0].alias("at"), F.posexplode("wins").alias("pos", "win"))
    part = part.join(seen, ["core", "win"]).select("key", "print", (F.col("at") + F.col("pos")).alias("s"), F.lit(0).alias("more"))
    span = F.struct("s", (F.col("s") + F.col("more") + window).alias("e"))
    return whole.unionByName(part).groupBy("key", "print").agg(F.collect_list(span).alias("spans")), [left, runs, seen]


def repeated_spans(docs: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, crowded: int = CROWDED, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, list[DataFrame]]:
    """(doc_key, spans): word spans to remove, for documents that have any; and the written tables behind it."""
    keyed = _keyed(docs)
    anchors = cut(keyed.mapInArrow(_anchors(window, shingle), _ANCHORS), "op3-anchors")
    twice = cut(anchors.groupBy("key").agg(F.sum("places").alias("p")).where("p > 1").select("key"), "op3-keys")
    cand = cut(anchors.join(twice, "key"), "op3-cand")
    drop_cut(anchors)
    segs = cut(
        cand.groupBy("key", "print").agg(F.count("*").alias("n"), F.max("places").alias("places"), F.min(F.struct("doc_key", "start", "count")).alias("rep")), "op3-segs"
    )
    per = segs.groupBy("key").agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("once"), F.max("places").alias("places"))
    per = cut(per.where("once > 0 and (kinds > 1 or places > 1)").select("key", (F.col("kinds") > crowded).alias("hot")), "op3-open")
    need = segs.join(per, "key").select("rep.doc_key", F.struct("key", "print", F.col("rep.start").alias("start"), F.col("rep.count").alias("count"), (F.col("n") > 1).alias("many"), "hot").alias("x"))
    need = cut(need.groupBy("doc_key").agg(F.collect_list("x").alias("need")), "op3-need")
    words = need.select(F.explode("need").alias("x")).agg(F.sum(F.col("x.count") + window - 1)).first()[0] or 0
    shards = max(1, -(-words // shard_words))
    # rows that repeat give their segments once for each row: group them again by what they are
    texts = cut(keyed.join(need, "doc_key").select("text", "need").mapInArrow(_needed(window, shingle, shards), _TEXTS).dropDuplicates(["key", "print", "at"]), "op3-texts")
    cold = texts.where("not hot").groupBy("shard").applyInPandas(_search(window), _COVER)
    hot, blocks = _crowded(texts.where("hot"), window)
    full = segs.where("n > 1").select("key", "print", F.array(F.struct(F.lit(0).alias("s"), (F.col("rep.count") + window - 1).alias("e"))).alias("spans"))
    cover = cut(full.unionByName(cold).unionByName(hot), "op3-cover")
    got = cand.select("doc_key", "key", "print", "start").join(cover, ["key", "print"])
    move = F.transform("spans", lambda x: F.struct((x["s"] + F.col("start")).alias("s"), (x["e"] + F.col("start")).alias("e")))
    spans = cut(got.groupBy("doc_key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(move)))).alias("spans")), "op3-spans")
    drop_cut(twice, cand, segs, per, need, texts, *blocks, cover)
    return spans, [spans]


def _kept(text: str | None, spans: list[dict] | None) -> tuple[int, int, bytes]:
    """Number of words, of removed ones, and the kept ones."""
    words = (text or "").encode("utf-8", "replace").split()
    n = len(words)
    if spans:
        part, last = [], 0
        for s, e in merge([(x["s"], x["e"]) for x in spans]):
            part += words[last:s]
            last = e
        words = part + words[last:]
    return n, n - len(words), b" ".join(words)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches):
        got = [_kept(t, s) for t, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()), pa.array([hashlib.sha256(g[2]).hexdigest() for g in got], pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def _texts(names: list[str]):
    """Columns ``names`` of a batch whose last column holds the spans; n_chars follows a text that changed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for b in small(batches):
            texts = b.column(at).to_pylist()
            got = [_kept(t, s) for t, s in zip(texts, b.column(len(names)).to_pylist())]
            cols = list(b.columns[: len(names)])
            cols[at] = pa.array([k.decode("utf-8") if gone else t for t, (_, gone, k) in zip(texts, got)], b.schema.field(at).type)
            if "n_chars" in names:
                n = names.index("n_chars")
                size = pa.compute.utf8_length(cols[at]).cast(cols[n].type)
                cols[n] = pa.compute.if_else(pa.array([gone > 0 for _, gone, _ in got], pa.bool_()), size, cols[n])
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """The table with its texts' repeated stretches removed (kept words joined by blanks; others unchanged)."""
    return _joined(docs, docs, **options).mapInArrow(_texts(docs.columns), docs.schema)


def _joined(docs: DataFrame, keep: DataFrame, **options) -> DataFrame:
    """``keep`` with the spans to remove as a further, last column."""
    spans, _ = repeated_spans(docs, **options)
    key, last = free_name(keep, "op3_key"), free_name(keep, "op3_spans")
    spans = spans.select(F.col("doc_key").alias(key), F.col("spans").alias(last))
    return keep.withColumn(key, _doc_key()).join(spans, key, "left").select(*keep.columns, last)


def removals(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _joined(docs, slim, **options).mapInArrow(_digests, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removals(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated stretches leave the texts; every document stays."""
    return remove_repeats(docs)
