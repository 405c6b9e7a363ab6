"""Frame shards, zip directories and other byte formats read on executors from binary files."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def binary(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)


def salvage(data: bytes) -> tuple[bytes, bool]:
    """What a gzip stream still holds (all members), and whether it was cut off or damaged."""
    out, rest = io.BytesIO(), data
    while rest:
        d = zlib.decompressobj(31)
        try:
            for i in range(0, len(rest), 1 << 16):
                out.write(d.decompress(rest[i : i + (1 << 16)]))
                if d.eof:
                    rest = d.unused_data + rest[i + (1 << 16) :]
                    break
            else:
                out.write(d.flush())
                return out.getvalue(), True
        except zlib.error:
            return out.getvalue(), True
    return out.getvalue(), False


def frame_blocks(text: str) -> tuple[list[tuple[str, list[str]]], bool]:
    """(header, atom lines) of each whole frame; True if a torn one ends the text."""
    lines, i, out = text.split("\n"), 0, []
    while i < len(lines) and lines[i].strip():
        try:
            n = int(lines[i])
        except ValueError:
            return out, True
        if i + 2 + n > len(lines) or (i + 2 + n == len(lines) and not text.endswith("\n") and len(lines[-1].split()) < len(lines[i + 2].split())):
            return out, True
        out.append((lines[i + 1], lines[i + 2 : i + 2 + n]))
        i += 2 + n
    return out, False


def header_tokens(header: str) -> dict[str, str]:
    """key=value tokens of a header line; quoted values may hold blanks; a bare key reads as T."""
    out, i, n = {}, 0, len(header)
    while i < n:
        if header[i].isspace():
            i += 1
            continue
        j = i
        while j < n and header[j] != "=" and not header[j].isspace():
            j += 1
        key, value = header[i:j], "T"
        if j < n and header[j] == "=":
            j += 1
            if j < n and header[j] == '"':
                k = header.find('"', j + 1)
                k = n if k < 0 else k
                value, j = header[j + 1 : k], k + 1
            else:
                k = j
                while k < n and not header[k].isspace():
                    k += 1
                value, j = header[j:k], k
        out[key] = value
        i = j
    return out


def rewrite_header(header: str, new: dict[str, str | None]) -> str:
    """Tokens replaced or, where null, left out; new ones at the end."""
    got = {k: v for k, v in header_tokens(header).items() if k not in new}
    got |= {k: v for k, v in new.items() if v is not None}
    return " ".join(f'{k}="{v}"' if " " in v else f"{k}={v}" for k, v in got.items())


def _meta(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for path, data in zip(b["path"], b["content"]):
            raw, cut = salvage(data) if path.endswith(".gz") else (data, False)
            got, torn = frame_blocks(raw.decode("utf-8", "replace"))
            rows = []
            for head, atoms in got:
                t = header_tokens(head)
                rows.append((path, t.get("frame_id"), t.get("calc_id"), sorted({a.split(None, 1)[0] for a in atoms if a.strip()}), cut or torn))
            yield pd.DataFrame(rows or [(path, None, None, [], cut or torn)], columns=["shard", "frame_id", "calc_id", "symbols", "truncated"])


def frame_meta(files: DataFrame) -> DataFrame:
    """(shard, frame_id, calc_id, distinct symbols, truncated); a shard without a whole frame gives one row without ids."""
    return files.select("path", "content").mapInPandas(_meta, "shard string, frame_id string, calc_id string, symbols array<string>, truncated boolean")


def _atoms(atoms: list[str]) -> tuple[list, list, list | None]:
    """Symbols, positions and forces of a frame's atom lines; ValueError if one is torn."""
    cells = [a.split() for a in atoms]
    if any(len(c) < 4 or len(c) != len(cells[0]) for c in cells):
        raise ValueError("torn line")
    return [c[0] for c in cells], [[float(x) for x in c[1:4]] for c in cells], [[float(x) for x in c[4:7]] for c in cells] if cells and len(cells[0]) >= 7 else None


def _full(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    num = lambda t, k: float(t[k]) if k in t else None
    for b in batches:
        for path, data in zip(b["path"], b["content"]):
            raw, cut = salvage(data) if path.endswith(".gz") else (data, False)
            blocks, torn = frame_blocks(raw.decode("utf-8", "replace"))
            rows = []
            for head, atoms in blocks:
                t = header_tokens(head)
                try:
                    rows.append((path, t.get("frame_id"), t.get("calc_id"), int(t["ionic_step"]) if "ionic_step" in t else None, *_atoms(atoms), num(t, "REF_energy"), num(t, "E_free"), {"T": True, "F": False}.get(t.get("electronic_converged")), num(t, "scf_dE")))
                except ValueError:  # the frame at the cut: what follows is lost
                    torn = True
                    break
            out = pd.DataFrame(rows or [(path, *[None] * 10)], columns=["shard", "frame_id", "calc_id", "ionic_step", "symbols", "positions", "forces", "ref_energy", "e_free", "electronic_converged", "scf_de"])
            out["truncated"] = cut or torn
            yield out


def frames(files: DataFrame) -> DataFrame:
    """Whole frames up to the first torn one, and whether their shard was cut off; a shard without any gives one row of nulls."""
    return files.select("path", "content").mapInPandas(
        _full, "shard string, frame_id string, calc_id string, ionic_step int, symbols array<string>, positions array<array<double>>, forces array<array<double>>, ref_energy double, e_free double, electronic_converged boolean, scf_de double, truncated boolean"
    )


def write_frames(df: DataFrame, path: str, per_file: int = 10_000) -> None:
    """Frames as Parquet files of at most ``per_file`` rows."""
    df.write.mode("append").option("maxRecordsPerFile", per_file).parquet(path)


def frame_text(df: DataFrame) -> DataFrame:
    """(value): each frame as text: number of atoms, a header of its columns, a line per atom."""
    num = lambda x: F.format_string("%.8f", x)
    vec = lambda v: F.concat_ws(" ", F.transform(v, num))
    forces = F.coalesce(F.col("forces"), F.transform("positions", lambda _: F.array().cast("array<double>")))
    atoms = F.transform(F.arrays_zip(F.col("symbols").alias("s"), F.col("positions").alias("p"), forces.alias("f")), lambda a: F.trim(F.concat_ws(" ", a["s"], vec(a["p"]), vec(a["f"]))))
    kinds = F.concat(F.lit("species:S:1:pos:R:3"), F.when(F.col("forces").isNotNull(), ":forces:R:3").otherwise(""))
    said = {"calc_id": F.col("calc_id"), "frame_id": F.col("frame_id"), "ionic_step": F.col("ionic_step").cast("string"), "REF_energy": F.col("ref_energy").cast("string"), "E_free": F.col("e_free").cast("string"), "electronic_converged": F.when(F.col("electronic_converged"), "T").when(~F.col("electronic_converged"), "F"), "scf_dE": F.col("scf_de").cast("string")}
    quoted = [F.when(c.isNotNull(), F.concat(F.lit(f'{k}="' if k.endswith("_id") else f"{k}="), c, F.lit('"' if k.endswith("_id") else ""))) for k, c in said.items()]
    return df.select(F.concat_ws("\n", F.size("symbols").cast("string"), F.concat_ws(" ", F.concat(F.lit("Properties="), kinds), *quoted), F.concat_ws("\n", atoms)).alias("value"))


def write_frame_text(df: DataFrame, path: str, per_file: int = 10_000) -> None:
    """Frames as gzip text files of at most ``per_file`` frames; a file is there whole or not at all."""
    frame_text(df).write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def zip_members(data: bytes) -> list[tuple] | None:
    """(name, method, compressed, uncompressed, crc, offset, flag, zip64) from the tail of a zip; None if unreadable."""
    at = data.rfind(b"PK\x05\x06")
    if at < 0 or len(data) < at + 22:
        return None
    count, size, start = struct.unpack_from("<HLL", data, at + 10)
    base = 0
    if 0xFFFFFFFF in (size, start) or count == 0xFFFF:
        loc = data.rfind(b"PK\x06\x07", 0, at)
        if loc < 0:
            return None
        (z,) = struct.unpack_from("<Q", data, loc + 8)
        if data[z : z + 4] != b"PK\x06\x06":
            return None
        count, size, start = struct.unpack_from("<QQQ", data, z + 32)
    out, i = [], base + start
    for _ in range(count):
        if data[i : i + 4] != b"PK\x01\x02":
            return None
        flag, method = struct.unpack_from("<HH", data, i + 8)
        crc, comp, full, n, extra, note = struct.unpack_from("<LLLHHH", data, i + 16)
        (offset,) = struct.unpack_from("<L", data, i + 42)
        name = data[i + 46 : i + 46 + n].decode("utf-8" if flag & 0x800 else "cp437", "replace")
        wide, e = False, i + 46 + n
        while e + 4 <= i + 46 + n + extra:
            kind, length = struct.unpack_from("<HH", data, e)
            if kind == 1:
                wide, q = True, e + 4
                for field in ("full", "comp", "offset"):
                    if {"full": full, "comp": comp, "offset": offset}[field] == 0xFFFFFFFF:
                        (v,) = struct.unpack_from("<Q", data, q)
                        q += 8
                        full, comp, offset = (v if field == "full" else full), (v if field == "comp" else comp), (v if field == "offset" else offset)
            e += 4 + length
        out.append((name, method, comp, full, crc, offset, flag, wide))
        i += 46 + n + extra + note
    return out


def _listing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = ["name", "method", "compressed_size", "uncompressed_size", "crc", "offset", "flag", "zip64"]
    for b in batches:
        for path, data in zip(b["path"], b["content"]):
            got = zip_members(data)
            df = pd.DataFrame(got or [(None, None, None, None, None, None, None, None)], columns=cols).astype({c: "Int64" for c in cols[1:7]})
            df.insert(0, "archive", path)
            df["readable"] = got is not None
            yield df


def zip_directory(files: DataFrame) -> DataFrame:
    """One row per member; an unreadable archive gives one row with readable = false."""
    return files.select("path", "content").mapInPandas(_listing, "archive string, name string, method int, compressed_size long, uncompressed_size long, crc long, offset long, flag int, zip64 boolean, readable boolean")


def read_member(data: bytes, name: str) -> bytes | None:
    """Bytes of a stored or deflated member; None if its checksum is wrong or it isn't there."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            return z.read(name)
    except (KeyError, zipfile.BadZipFile, zlib.error):
        return None


def trailer_size(tail: Column) -> Column:
    """The little-endian number in the last four bytes of a gzip file."""
    digits = F.hex(tail)
    return F.conv(F.concat(*[F.substring(digits, i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("long")


def expanded_size(path: Column, size: Column, tail: Column) -> Column:
    """Bytes a file holds: for gzip the larger of its size and its trailer's, 4 GiB where a file of 512 MiB or more says less than its own size."""
    said = trailer_size(tail)
    gz = F.lower(path).endswith(".gz") & (F.length(tail) == 4)
    return F.when(gz & (size >= 1 << 29) & (said < size), F.greatest(size, F.lit(1 << 32))).when(gz, F.greatest(size, said)).otherwise(size)


def gzip_size(path: Column, content: Column) -> Column:
    return expanded_size(path, F.length(content).cast("long"), F.substring(content, -4, 4))


def shard_paths(files: DataFrame) -> DataFrame:
    """Shards by the number in their name."""
    from provlake.operators.dataset import shard_index

    return files.select("path", shard_index(F.col("path")).alias("index")).where("index is not null").orderBy("index")


def next_index(files: DataFrame) -> DataFrame:
    """One row: the first free shard number."""
    return shard_paths(files).agg((F.coalesce(F.max("index"), F.lit(-1)) + 1).alias("next"))
