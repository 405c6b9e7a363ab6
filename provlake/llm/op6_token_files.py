"""Token-id files: ids of whole documents in ascending doc_id order, coded by ``range_coder``.

File format: a row per segment (Parquet carries the rows).  A segment holds whole documents in order,
about SEGMENT ids; its columns are the part and segment number, the documents' ids and lengths, the
segment's packed order-0 counts, and for each block its number of ids, CRC-32 and coded bytes.  Any block
decodes alone, given those counts.  Parts are ranges of doc_id, so part and segment order is document
order; starts come from a running sum over parts.

Pieces of words, in lower case and cut as the tokenizer's own pattern cuts them, are given to the
tokenizers library once while they are in a worker's bounded memos; texts with white space other than blank, tab, line feed and return go to it whole.

Defined cases: a null text is encoded as an empty one and has the end id alone; rows that share a
doc_id stand in the order of their texts' hashes, then texts, each with its own start; a null doc_id
comes first; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from provlake.llm import range_coder
from provlake.llm.common import LOWER, cut, doc_columns, shared_dir, small, steps, table
from provlake.llm.op2_bpe import ODD_SPACE, vocabulary

END = 1
SEGMENT = 8_000_000
PART_BYTES = 24 << 20
#: Characters whose pieces are looked up together.
STEP = 4 << 20
#: Segments whose starts (24 bytes each) are broadcast.
BROADCAST = 2_000_000
_NAMES = ["doc_ids", "doc_lens", "prior", "block_lens", "block_crcs", "blocks"]
_KINDS = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary())]
_SCHEMA = "doc_ids array<long>, doc_lens array<long>, prior binary, block_lens array<long>, block_crcs array<long>, blocks array<binary>"


class Tokens:
    """Ids by the tokenizers library: the pieces that aren't in the bounded memos go to it together."""

    def __init__(self, path: str, words: int = 400_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        vocab = self.tok.get_vocab()
        self.last = np.zeros(max(vocab.values(), default=0) + 1, bool)  # ids that end a piece of a word
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        # plain pieces are in normal form as they are cut, where this holds for each of their characters
        letters = [chr(c) for c in range(0x20, 0x100) if c == 0x20 or _PLAIN(chr(c))]
        self.normal = self.tok.normalizer is not None and all(self.tok.normalizer.normalize_str(c) == c for c in letters)
        self.most, self.young, self.old = words, {}, {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, pieces: list[str]) -> list[bytes] | None:
        """Ids of pieces, encoded as one text; None if they can't be told apart."""
        normalizer = self.tok.normalizer
        try:
            if self.normal:
                self.tok.normalizer = None
            ids = np.array(self.tok.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, "<u2")
        finally:
            self.tok.normalizer = normalizer
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(pieces):
            return None
        raw, at = ids.tobytes(), (2 * ends).tolist()
        return [raw[x:y] for x, y in zip([0, *at], at)]

    def _new(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that no memo holds."""
        joined = "".join(pieces)
        if not _PLAIN(joined) or "<|" in joined:
            plain = [p for p in pieces if _PLAIN(p) and "<|" not in p]
            if len(plain) < len(pieces):
                known = dict(zip(plain, self._new(plain))) if plain else {}
                rest = [p for p in pieces if p not in known]
                known.update(zip(rest, self._library(rest)))
                return [known[p] for p in pieces]
        return self._plain(pieces) or self._library(pieces)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 16-bit ids of each text: numpy cuts the pieces and Arrow numbers them, so that Python sees each different one once."""
        raw = [t.encode() if t else b"" for t in texts]
        odd = [i for i, t in enumerate(raw) if t.translate(None, _USUAL) and ODD_SPACE.search(texts[i])]
        whole = dict(zip(odd, self._library([texts[i] for i in odd]) if odd else ()))
        data, start, sizes, first = pieces_of([b"" if i in whole else t for i, t in enumerate(raw)] if odd else raw)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        coded = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        found, at = self._find(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), coded.indices.to_numpy()
        size = np.fromiter(map(len, found), np.int64, len(found)) >> 1
        begin, n = np.cumsum(size) - size, size.take(at)
        end = np.concatenate(([0], np.cumsum(n)))
        out = np.frombuffer(b"".join(found), "<u2").take(np.repeat(begin.take(at) - end[:-1], n) + np.arange(end[-1]))
        cuts = end[np.searchsorted(start, first)].tolist()
        return [whole[i] if i in whole else out[x:y].tobytes() for i, (x, y) in enumerate(zip(cuts, cuts[1:]))]

    def _find(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces."""
        if len(self.young) > self.most:  # two generations of pieces: the older one goes
            self.old, self.young = self.young, {}
        young = self.young
        got = list(map(young.get, pieces))
        new = [i for i, g in enumerate(got) if g is None]
        if new:
            aged = list(map(self.old.get, [pieces[i] for i in new]))
            miss = [pieces[i] for i, g in zip(new, aged) if g is None]
            made = iter(self._new(miss) if miss else ())
            for i, g in zip(new, aged):
                got[i] = young[pieces[i]] = next(made) if g is None else g
        return got


#: Pieces on which the library's classes of characters are these: visible ASCII and the letters of Latin-1 in lower case.
_PLAIN = re.compile(r"[!-@\[-~ß-öø-ÿ]+").fullmatch
_BLANK, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)
_BLANKS = b" \t\n\r"
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _LETTER
_CLASS[[*_BLANKS]] = _BLANK
_CLASSES = _CLASS.tobytes()
#: Bytes of texts without odd white space: visible ASCII, blanks, and those of characters up to two bytes but for its lead C2.
_USUAL = bytes([*_BLANKS, *range(0x21, 0x7F), *range(0x80, 0xC0), *range(0xC3, 0xE0)])


def pieces_of(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The tokenizer's own pieces of texts in lower case: their bytes, one piece after the other, each one's place
    and size, and the place of each text.  A word with other characters than ``_PLAIN``, or with ``<|``, is one piece as it stands."""
    joined = b" ".join([b"", *texts, b""])
    raw, low = np.frombuffer(joined, np.uint8), np.frombuffer(bytearray(joined.translate(LOWER)), np.uint8)
    first = np.cumsum([1, *(len(t) + 1 for t in texts)])
    kind = np.frombuffer(bytearray(joined.translate(_CLASSES)), np.uint8)
    high = np.flatnonzero(raw >= 0x80)
    if len(high):
        lead = high[raw[high] == 0xC3]
        lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = _LETTER
        low[lead[raw[lead + 1] < 0x9F] + 1] += 0x20
    if b"<|" in joined:
        kind[np.flatnonzero((raw[:-1] == 0x3C) & (raw[1:] == 0x7C))] = _OTHER
    edge = kind[1:] != kind[:-1]
    edge |= kind[1:] == _DIGIT
    at = np.flatnonzero(edge) + 1
    what = kind.take(at[:-1])  # the last edge is the blank behind all
    inside = np.flatnonzero(what)
    start, end, what = at.take(inside), at.take(inside + 1), what.take(inside)
    if (what == _OTHER).any():
        fresh = np.concatenate(([True], start[1:] != end[:-1]))
        word = np.cumsum(fresh) - 1
        other = np.zeros(int(word[-1]) + 1, bool)
        other[word[what == _OTHER]] = True
        whole = other[word]
        last = np.concatenate((fresh[1:], [True]))
        keep = ~whole | fresh
        end[whole & fresh], what[whole] = end[whole & last], _OTHER
        start, end, what = start[keep], end[keep], what[keep]
        within = np.zeros(len(raw), np.int8)
        within[start[what == _OTHER]] = 1
        within[end[what == _OTHER]] = -1
        low = np.where(np.cumsum(within, dtype=np.int8).view(bool), raw, low)
    # 's, 't, 're, 've, 'm, 'll and 'd: a lone apostrophe takes the letters from the piece behind it
    mark = np.flatnonzero(raw == 0x27)
    lone = np.minimum(np.searchsorted(start, mark), len(start) - 2) if len(start) > 1 else mark[:0]
    lone = lone[(start[lone] == mark) & (what[lone] == _SIGN) & (end[lone] == mark + 1) & (start[lone + 1] == mark + 1) & (what[lone + 1] == _LETTER)] if len(lone) else lone
    if len(lone):
        a, b, room = low[start[lone] + 1], low[start[lone] + 2], end[lone + 1] - start[lone + 1]
        one = (a == 0x73) | (a == 0x74) | (a == 0x6D) | (a == 0x64)
        two = (room > 1) & ((((a == 0x72) | (a == 0x76)) & (b == 0x65)) | ((a == 0x6C) & (b == 0x6C)))
        take = np.where(two, 2, np.where(one, 1, 0))
        end[lone] += take
        start[lone + 1] += take
        keep = start < end
        start, end = start[keep], end[keep]
    return low.tobytes().translate(None, _BLANKS), start, end - start, first


def _writer(path: str, end: int, segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, docs, lens, held, n = tokens_of(path), [], [], [], 0
        tail = np.array([end], "<u2").tobytes()

        def pack() -> pa.RecordBatch:
            prior, blocks, sizes, sums = range_coder.encode(np.frombuffer(b"".join(held), "<u2"))
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((docs, lens, prior, sizes, sums, blocks), _KINDS)], names=_NAMES)

        for b in small(batches, 1000):
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for x, y in steps(texts, STEP):
                for i, got in zip(ids[x:y], tokens.ids(texts[x:y])):
                    docs.append(i)
                    lens.append(len(got) // 2 + 1)
                    held.append(got + tail)
                    n += lens[-1]
                    if n >= segment:
                        yield pack()
                        docs, lens, held, n = [], [], [], 0
        if docs:
            yield pack()

    return run


_TOKENS: dict[str, Tokens] = {}


def tokens_of(path: str) -> Tokens:
    """One for each worker process: later tasks of a reused worker find the words of earlier ones."""
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(path)
    return _TOKENS[path]


def write_files(docs: DataFrame, target: str, path: str | None = None, end: int = END, segment: int = SEGMENT, parts: int | None = None) -> None:
    """Write the files of ``docs`` (doc_id, text) under ``target``."""
    spark = docs.sparkSession
    base = doc_columns(docs).withColumn("_h", F.xxhash64("text"))
    if parts is None:
        size = docs.select("text").agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(1, -(-size // PART_BYTES))
    ranged = base.repartitionByRange(parts, "doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text")
    rows = ranged.mapInArrow(_writer(path or vocabulary("word_bpe_49k.json"), end, segment), _SCHEMA)
    rows.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("segment"), "*").write.parquet(target)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in range(b.num_rows):
            start, docs, lens, prior, sizes, sums, blocks = (b.column(i)[row].as_py() for i in range(7))
            ids = range_coder.decode(prior, blocks, sizes, sums)
            cuts = np.concatenate(([0], np.cumsum(lens, dtype=np.int64))).tolist()
            raw = memoryview(ids.tobytes())
            crcs = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array([start + c for c in cuts[:-1]], pa.int64()), pa.array(lens, pa.int64()), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_files(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    files = spark.read.parquet(target)
    # a row per segment: its number of ids; then what stands before it, in its part and in the parts before
    sums = files.select("part", "segment", F.expr("aggregate(doc_lens, 0L, (a, x) -> a + x)").alias("n"))
    parts = sums.groupBy("part").agg(F.sum("n").alias("n"))
    base = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))  # one row per PART_BYTES of text
    inner = F.sum("n").over(W.partitionBy("part").orderBy("segment")) - F.col("n")
    at = cut(sums.withColumn("inner", inner).join(base, "part").select("part", "segment", (F.col("base") + F.col("inner")).alias("start")), "op6-starts")
    few = at.count() <= BROADCAST
    rows = files.join(F.broadcast(at) if few else at, ["part", "segment"]).select("start", *_NAMES)
    return rows.mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{shared_dir(spark)}/op6-files-{uuid.uuid4().hex}"
    write_files(table(spark, sf_dir, "documents"), target)
    return read_files(spark, target)
