"""Shared plumbing: sessions, shared folders, table reading, byte-level word scanning."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step holds; several 8-byte arrays of this length live at once.
STEP_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; Arrow batches of texts are kept small in both the JVM and Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see; a temporary one only where the session names none and is local (tests)."""
    got = spark.conf.get("spark.checkpoint.dir", None)
    if not got:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        got = "file://" + tempfile.mkdtemp(prefix="provlake-")
        spark.conf.set("spark.checkpoint.dir", got)
    return got.rstrip("/")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the table has it."""
    had = {c.lower() for c in df.columns}
    while name.lower() in had:
        name += "_"
    return name


#: What ``cut`` has written in this process, the oldest first.
_WRITTEN: list[str] = []


def cut(df: DataFrame, what: str) -> DataFrame:
    """Write and reread: later jobs start from files that survive a lost executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop_cut(*frames: DataFrame) -> None:
    """Delete what ``cut`` wrote, once no later plan reads it."""
    for df in frames:
        for f in {os.path.dirname(x) for x in df.inputFiles()}:
            _delete(df.sparkSession, f)


def settled(spark: SparkSession, since: int, df: DataFrame) -> DataFrame:
    """``df``, itself written by ``cut``, after all that was written from number ``since`` on before it is deleted."""
    for path in _WRITTEN[since:-1]:
        _delete(spark, path)
    _WRITTEN[since:-1] = []
    return df


def written() -> int:
    return len(_WRITTEN)


def shards_for(rows: int, each: int, least: int = 1) -> int:
    return max(least, -(-rows // each))


# --- vectorised words -------------------------------------------------------

SPACES = np.ones(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = False  # words [^\x20\x09-\x0D]+

ALNUM = np.zeros(256, bool)  # words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POW = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    had = _POW.get(int(base))
    if had is None or len(had) < n:
        p = np.full(max(n, STEP_BYTES + 1), base, np.uint64)
        p[0] = 1
        _POW[int(base)] = had = np.multiply.accumulate(p)
    return had[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of several texts: byte spans in ``raw``, the text each is of, and 64-bit hashes."""

    def __init__(self, texts: list[str | None], kind: np.ndarray, lower: bool) -> None:
        enc = [(t or "").encode("utf-8", "replace") for t in texts]
        raw = b" ".join(enc) + b" "
        self.raw = raw.translate(LOWER) if lower else raw
        buf = np.frombuffer(self.raw, np.uint8)
        inside = kind[buf].view(np.int8)
        edge = np.diff(inside, prepend=np.int8(0))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sizes = np.fromiter(map(len, enc), np.int64, len(enc)) + 1
        first = np.zeros(len(enc) + 1, np.int64)
        np.cumsum(sizes, out=first[1:])
        self.bound = np.searchsorted(self.start, first)  # words of text t: bound[t]:bound[t + 1]
        self.n = np.diff(self.bound)
        self.doc = np.repeat(np.arange(len(enc)), self.n)
        self.buf = buf

    def hashes(self) -> np.ndarray:
        n = len(self.buf)
        c = np.zeros(n + 1, np.uint64)
        np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=c[1:])
        h = (c[self.end] - c[self.start]) * _powers(_INV, n)[self.start]
        return mix(h + (self.end - self.start).astype(np.uint64))

    def text(self, a: int, b: int) -> list[str]:
        return [self.raw[x:y].decode("utf-8") for x, y in zip(self.start[a:b].tolist(), self.end[a:b].tolist())]


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive word hashes (also across texts: mask those)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = h[:n].copy()
    for j in range(1, k):
        g *= np.uint64(0xD6E8FEB86659FD93)
        g += h[j : j + n]
    return mix(g)


def steps(texts: list[str | None], most: int = STEP_BYTES):
    """Slices of a batch whose texts have about ``most`` bytes together (one text at least)."""
    a, size = 0, 0
    for b, t in enumerate(texts):
        got = len(t) if t else 0
        if b > a and size + got > most:
            yield a, b
            a, size = b, 0
        size += got
    if a < len(texts):
        yield a, len(texts)


def small(batches, rows: int = 512):
    """Slices of Arrow batches, so that Python holds the texts of a few rows at a time."""
    give_back()  # workers live on: what the last task freed
    for b in batches:
        for a in range(0, b.num_rows, rows):
            yield b.slice(a, rows)
    give_back()


def give_back() -> None:
    """Return freed memory to the system; a worker's pools keep it otherwise, beside the JVM's heap."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def doc_columns(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, whatever else the table holds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
