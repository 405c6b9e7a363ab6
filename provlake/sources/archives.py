"""Archives read on executors: members kept by name, nested ones expanded, refusals as rows; transparent decompression."""

from __future__ import annotations

import bz2
import gzip
import io
import lzma
import posixpath
import re
import tarfile
import xml.etree.ElementTree as ET
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.functions import files as ff

# Depth and failures of nested archives, where a nested one's members go.
DEEPEST, MOST_ERRORS, NESTED = 8, 1000, "__extracted"
_BROKEN = (zipfile.BadZipFile, tarfile.TarError, EOFError, zlib.error, lzma.LZMAError, OSError, RuntimeError, NotImplementedError, ValueError)
_WANTED, _JUNK, _PARTS = re.compile(ff.FETCH_PATTERN), re.compile(ff.JUNK_PATTERN), re.compile(ff.MULTIPART_PATTERN)


def nested_kind(name: str) -> str | None:
    """The kind of a member that is an archive itself; bare compression is data there."""
    low = name.lower()
    tests = {"zip": (".zip",), "tar": ff.TARS, "rar": (".rar",), "sevenzip": (".7z",), "tarzst": (".tar.zst", ".tzst")}
    return next((k for k, ends in tests.items() if low.endswith(ends)), None)


def inside(base: str, member: str) -> str | None:
    """The place of a member below ``base``; None if it leaves the root."""
    path = posixpath.normpath(posixpath.join(base, member))
    return None if path in (".", "..") or path.startswith(("../", "/")) else path


def _zip(data: bytes) -> Iterator[tuple[str, int, Callable[[], bytes]]]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for i in z.infolist():
            if not i.is_dir():
                yield i.filename, i.file_size, lambda i=i: z.read(i)


def _tar(data: bytes) -> Iterator[tuple[str, int, Callable[[], bytes]]]:
    with tarfile.open(fileobj=io.BytesIO(data)) as t:
        for m in t:
            if m.isfile():
                yield m.name, m.size, lambda m=m: t.extractfile(m).read()


def _tarzst(data: bytes) -> Iterator[tuple[str, int, Callable[[], bytes]]]:
    import zstandard

    with zstandard.ZstdDecompressor().stream_reader(data) as r:
        yield from _tar(r.read())


_READERS = {"zip": _zip, "tar": _tar, "tarzst": _tarzst}


def expand(name: str, kind: str, data: bytes, cap: int | None = None, depth: int = 0, base: str = "", errors: list[int] | None = None) -> Iterator[tuple]:
    """(path, size, content or None, reason or None, detail): every member; wanted ones within ``cap`` with their content.

    Nested archives are expanded in the order of their names, down to DEEPEST levels; after MOST_ERRORS failures one row
    says so and the rest is left.
    """
    errors = errors if errors is not None else [MOST_ERRORS]
    if depth > DEEPEST:
        yield base or name, None, None, "archive_nesting_too_deep", f"stopped at depth {DEEPEST}"
        return
    if _PARTS.search(name):
        yield base or name, None, None, "archive_multipart_unsupported", "a part of a split archive"
        return
    if kind not in _READERS:
        yield base or name, None, None, "archive_unsupported", kind
        return
    nested: list[tuple[str, str, bytes]] = []
    try:
        for member, size, read in _READERS[kind](data):
            path = inside(base, member)
            if path is None or _JUNK.search(member):
                continue
            sub = nested_kind(posixpath.basename(member))
            if sub and (cap is None or size <= cap):
                nested.append((path, sub, read()))
            wanted = _WANTED.search(posixpath.basename(member)) and not sub
            if wanted and cap is not None and size > cap:
                yield path, size, None, "over_size_cap", None
            else:
                yield path, size, read() if wanted else None, None, None
    except _BROKEN as e:
        errors[0] -= 1
        if errors[0] <= 0:
            yield base or name, None, None, "nested_extract_errors_capped", f"stopped after {MOST_ERRORS}"
        else:
            yield base or name, None, None, "extract_error", f"{type(e).__name__}: {e}"
        return
    for path, sub, content in sorted(nested, key=lambda x: x[0]):
        if errors[0] <= 0:
            return
        yield from expand(posixpath.basename(path), sub, content, cap, depth + 1, path + NESTED, errors)


def _members(cap: int | None):
    cols = ["archive", "path", "size", "content", "reason", "detail"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, kind, data in zip(b["path"], b["kind"], b["content"]):
                rows, held = [], 0
                for row in expand(posixpath.basename(path), kind, bytes(data), cap):
                    rows.append((path, *row))
                    held += len(row[2] or b"")
                    if held > 32 << 20:
                        yield pd.DataFrame(rows, columns=cols).astype({"size": "Int64"})
                        rows, held = [], 0
                yield pd.DataFrame(rows, columns=cols).astype({"size": "Int64"})

    return run


def extract(files: DataFrame, cap: int | None = None) -> DataFrame:
    """(archive, path, size, content, reason, detail) of every member of the archives among binary files; others give no rows."""
    kind = files.select("path", "content", ff.archive_kind(F.col("path")).alias("kind")).where("kind is not null")
    return kind.mapInPandas(_members(cap), "archive string, path string, size long, content binary, reason string, detail string")


def plain(name: str, data: bytes) -> bytes:
    """Content behind gz, bz2, xz or lzma by the name's end; others as they are."""
    low = name.lower()
    for end, f in ((".gz", gzip.decompress), (".bz2", bz2.decompress), (".xz", lzma.decompress), (".lzma", lzma.decompress)):
        if low.endswith(end):
            return f(data)
    return data


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        text = []
        for path, data in zip(b["path"], b["content"]):
            try:
                text.append(plain(path, bytes(data)).decode("utf-8", "replace"))
            except _BROKEN:
                text.append(None)
        yield pd.DataFrame({"path": b["path"], "text": text})


def texts(files: DataFrame) -> DataFrame:
    """(path, text) of binary files, whatever they are compressed with; null if they can't be read."""
    return files.select("path", "content").mapInPandas(_texts, "path string, text string")


def found(chunks: Iterable[bytes], needles: list[bytes]) -> set[bytes]:
    """Which needles a stream holds; one across two chunks counts, and the stream ends when all are found."""
    keep, tail, got = max(map(len, needles), default=1) - 1, b"", set()
    for chunk in chunks:
        window = tail + chunk
        got.update(n for n in needles if n in window)
        if len(got) == len(needles):
            break
        tail = window[-keep:] if keep else b""
    return got


def xml_parameters(data: bytes) -> dict[str, str] | None:
    """The scalar entries of the first parameter block of an XML output; reading stops at its end.  None without one."""
    out, inside_, parser = {}, False, ET.XMLPullParser(["start", "end"])
    try:
        for a in range(0, len(data), 1 << 16):
            parser.feed(data[a : a + (1 << 16)])
            for event, node in parser.read_events():
                if node.tag == "parameters":
                    if event == "end":
                        return out
                    inside_ = True
                elif inside_ and event == "end" and node.tag in ("i", "v") and node.get("name"):
                    out.setdefault(node.get("name").strip().upper(), " ".join((node.text or "").split()))
    except ET.ParseError:
        pass
    return out or None
