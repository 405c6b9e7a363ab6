"""Byte-pair encoding and decoding with reuse of content-defined chunks.

A rolling hash over the bytes cuts texts into chunks, so equal passages of different documents give equal
chunks.  A chunk is encoded and decoded once while a worker holds it; its outermost stretches, before the
first and after the last of its safe breaks, stay open.  At every join of chunks the open stretches on both
sides are put together and encoded again.  A join is widened until both of its ends lie on safe breaks:
there the new encoding agrees exactly with that of the whole text, as the pre-tokenizer breaks at a space
behind a non-space whatever stands around it.  A chunk without two safe breaks is taken into its joins.

What is new in a step of documents, chunks' inner stretches and joins, goes to the tokenizers library in one
call, each piece between safe breaks once: its tokens are told apart by their lengths in bytes, and the call's
ids must decode to its text again.  The chunks and pieces that a worker holds are bounded and outlive a task
where Spark reuses its workers; they are not shared between workers, as moving a chunk's ids costs more than
encoding it again.

Defined cases: a null text is encoded as an empty one; special tokens in a text are recognised as the
library does; any length is taken whole; rows repeat as they came; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from provlake.llm.common import doc_columns, small, steps, table

#: White space on which regex engines agree; other kinds take the slow path.
ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
MASK_BITS, LEAST, MOST = 10, 256, 8192
#: Bytes of chunks, ids and decoded texts, and number of pieces that a worker holds.
HELD, PIECES = 24 << 20, 200_000
_PIECE = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cut_points(data: bytes, bits: int = MASK_BITS, least: int = LEAST, most: int = MOST) -> list[int]:
    """Byte positions at which a chunk ends: a 32-byte rolling hash with ``bits`` zero bits."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for shift in (1, 2, 4, 8, 16):  # doubling: a hash over 2, 4, ... 32 bytes
        h[shift:] = h[shift:] + (h[:-shift] << np.uint32(shift))
    out, last = [], 0
    for p in (np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1).tolist():
        while p - last > most:
            last += most
            out.append(last)
        if p - last >= least:
            out.append(p)
            last = p
    while n - last > most:
        last += most
        out.append(last)
    if last < n:
        out.append(n)
    fixed = []
    for p in out:  # never inside a character
        while p < n and data[p] & 0xC0 == 0x80:
            p += 1
        if not fixed or p > fixed[-1]:
            fixed.append(p)
    return fixed


_GEAR = np.random.RandomState(20240607).randint(0, 1 << 32, 256, dtype=np.uint32)


#: A space behind a character that no engine takes for white space.
_SAFE = "(?<=[^ \t\n\r" + ODD_SPACE.pattern[1:-1] + "])(?=[ \t\n\r])"
_FIRST, _LAST = re.compile(_SAFE), re.compile(".*" + _SAFE, re.S)


class Codec:
    """encode(texts) gives each whole text's ids and decoded text."""

    def __init__(self, path: str, held: int = HELD, pieces: int = PIECES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        vocab = self.tok.get_vocab()
        self.length = np.zeros(max(vocab.values(), default=0) + 1, np.int64)  # bytes of a token
        self.length[list(vocab.values())] = list(map(len, vocab))
        self.most, self.most_pieces = held, pieces
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}
        self.bytes = 0
        self.new: dict[str, tuple[bytes, str]] = {}
        self.aged: dict[str, tuple[bytes, str]] = {}

    def _library(self, texts: list[str]) -> list[tuple[bytes, str]]:
        ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        # a text that decodes to itself stands once in memory
        return [(np.array(i, "<u2").tobytes(), t if t == d else d) for i, t, d in zip(ids, texts, self.tok.decode_batch(ids, skip_special_tokens=False))]

    def _learn(self, pieces: list[str]) -> None:
        """Ids of pieces: those with white space in front and text behind are encoded as one text."""
        linked = [p for p in pieces if p[0] in " \t\n\r" and p[-1] not in " \t\n\r" and "<|" not in p]
        if linked:
            whole = "".join(linked)
            ids = self.tok.encode_batch_fast([whole], add_special_tokens=False)[0].ids
            got = np.array(ids, "<u2")
            at, ends = np.cumsum(self.length[got]), np.cumsum([len(p.encode()) for p in linked])
            stop = np.searchsorted(at, ends) + 1
            if stop[-1] <= len(at) and (at[stop - 1] == ends).all() and self.tok.decode(ids, skip_special_tokens=False) == whole:
                raw, edge = got.tobytes(), (2 * stop).tolist()
                self.new.update(zip(linked, zip([raw[x:y] for x, y in zip([0, *edge], edge)], linked)))
        rest = [p for p in pieces if p not in self.new]
        self.new.update(zip(rest, self._library(rest)))

    def spans(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids, decoded text) of texts whose ends are safe breaks; those with odd white space go whole."""
        if len(self.new) > self.most_pieces:
            self.aged, self.new = self.new, {}
        split = [None if ODD_SPACE.search(t) else _PIECE.findall(t) for t in texts]
        miss = []
        for p in set(chain.from_iterable(w for w in split if w)).difference(self.new):
            if (got := self.aged.get(p)) is None:
                miss.append(p)
            else:
                self.new[p] = got
        if miss:
            self._learn(miss)
        odd = [t for t, w in zip(texts, split) if w is None]
        whole = dict(zip(odd, self._library(odd)))
        out = []
        for t, w in zip(texts, split):
            if w is None:
                out.append(whole[t])
            else:
                got = [self.new[p] for p in w]
                dec = "".join([g[1] for g in got])
                out.append((b"".join([g[0] for g in got]), t if dec == t else dec))
        return out

    def _find(self, chunk: str) -> tuple | None:
        got = self.young.get(chunk)
        if got is None and (got := self.old.get(chunk)) is not None:
            self._hold(chunk, got)
        return got

    def _hold(self, chunk: str, got: tuple) -> None:
        """Two generations, each of half the bytes; the older one goes when the younger is full."""
        self.young[chunk] = got
        self.bytes += 4 * len(chunk) + 300
        if self.bytes > self.most // 2:
            self.old, self.young, self.bytes = self.young, {}, 0

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, str]]:
        """(ids, decoded text) of whole documents."""
        jobs: dict[str, int] = {}  # texts for the library, each once
        plan: list[list] = []
        here: dict[str, tuple] = {}
        for text in texts:
            parts, open_end = [], ""
            for chunk in chunks(text or ""):
                got = here.get(chunk) or self._find(chunk)
                if got is None:
                    first = _FIRST.search(chunk)
                    cut = (first.start(), _LAST.match(chunk).end()) if first else (0, 0)
                    # start, inner text, its encoding once it is made, end
                    got = (chunk[: cut[0]], chunk[cut[0] : cut[1]], [], chunk[cut[1] :]) if cut[1] > cut[0] else (chunk, "", None, "")
                here[chunk] = got
                head, inner, made, tail = got
                open_end += head
                if made is None:
                    continue  # the join reaches into the next chunk
                if open_end:
                    parts.append(jobs.setdefault(open_end, len(jobs)))
                if not made:
                    jobs.setdefault(inner, len(jobs))
                parts.append(got)
                open_end = tail
            if open_end:
                parts.append(jobs.setdefault(open_end, len(jobs)))
            plan.append(parts)
        done = self.spans(list(jobs))
        for chunk, got in here.items():
            if got[2] is not None and not got[2]:
                got[2].append(done[jobs[got[1]]])
            if chunk not in self.young:
                self._hold(chunk, got)
        out = []
        for parts in plan:
            pieces = [done[p] if isinstance(p, int) else p[2][0] for p in parts]
            out.append((np.frombuffer(b"".join([p[0] for p in pieces]), "<u2"), "".join([p[1] for p in pieces])))
        return out


def chunks(text: str) -> list[str]:
    """Content-defined chunks of a text; a short one is one chunk."""
    if len(text) <= LEAST:
        return [text] if text else []
    data = text.encode("utf-8", "replace")
    cuts = cut_points(data)
    return [data[a:b].decode("utf-8") for a, b in zip([0, *cuts], cuts)]


_CODECS: dict[str, Codec] = {}


def codec_of(path: str) -> Codec:
    """One for each worker process, whatever tasks it runs."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _worker(path: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        text = [str(i) for i in range(codec.tok.get_vocab_size() + 1)]
        sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
        for b in small(batches):
            docs, texts = b.column(0), b.column(1).to_pylist()
            for x, y in steps(texts):
                got = codec.encode(texts[x:y])
                cols = [docs.slice(x, y - x).cast(pa.int64()), pa.array([len(i) for i, _ in got], pa.int64())]
                if kind == "full":
                    cols += [pa.array([i.astype(np.int32) for i, _ in got], pa.list_(pa.int32())), pa.array([d for _, d in got], pa.string())]
                cols += [pa.array([sha(",".join([text[v] for v in i.tolist()])) for i, _ in got], pa.string()), pa.array([sha(d) for _, d in got], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=_NAMES[kind])

    return run


_NAMES = {"digest": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], "full": ["doc_id", "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"]}
_KINDS = {"digest": "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", "full": "doc_id long, n_tokens long, ids array<int>, decoded string, ids_sha256 string, decoded_sha256 string"}


def encode(docs: DataFrame, path: str | None = None, output: str = "full") -> DataFrame:
    """doc_id, n_tokens, ids and decoded text (``full`` only) and the SHA-256 of both, made where the ids are."""
    return doc_columns(docs).mapInArrow(_worker(path or vocabulary(), output), _KINDS[output])


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), output="digest")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: ids and decoded text of each document, and their digests."""
    return encode(docs)
