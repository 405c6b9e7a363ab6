"""Licences, access, DOIs, ids, references: rules on record fields as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Licence ids that grant nothing, upstreams whose entries are copies, words that hint at the code.
NO_LICENCE = ["", "notspecified", "all-rights-reserved", "arr", "closed", "restricted", "copyright", "none"]
EXCLUDED_UPSTREAMS = ["AFLOW", "OQMD", "Materials Project"]
SIGNALS = r"(?i)\b(vasp|vasprun|outcar|incar|first[ -]principles|density[ -]functional|dft|ab[ -]initio|projector[ -]augmented|paw|plane[ -]wave)\b"
TERMINAL_FETCH = ["no_calc_units_after_extract", "no_vasp_files_fetched", "manually_excluded"]
TRANSIENT_PREFIXES = ["download_error", "write_error", "http_5", "http_429", "disk_budget"]
TERMINAL_PARSE = ["vasprun_parse_error", "vaspout_parse_error", "outcar_parse_error", "no_frames"]


def reusable_licence(lic: Column) -> Column:
    """False for null, blank and no-licence ids and for nc or nd terms."""
    clean = F.lower(F.trim(lic))
    parts = F.split(clean, r"[-_.\s]+")
    return F.coalesce(~clean.isin(*NO_LICENCE) & ~F.arrays_overlap(parts, F.array(F.lit("nc"), F.lit("nd"))), F.lit(False))


def open_access(right: Column) -> Column:
    """A missing access right passes."""
    return right.isNull() | (right == "open")


def metadata_signals(*texts: Column) -> Column:
    joined = F.concat_ws(" ", *texts)
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(joined, F.lit(SIGNALS), 1), F.lower)))


def normal_doi(text: Column) -> Column:
    got = F.lower(F.regexp_replace(F.regexp_extract(text, r"(10\.\d{4,9}/\S+)", 1), r"\.+$", ""))
    return F.when(got != "", got)


def references(refs: Column, datasets: Column) -> Column:
    """References, then the DOIs of datasets."""
    none = F.array().cast("array<string>")
    return F.concat(F.coalesce(refs, none), F.coalesce(F.filter(F.transform(datasets, lambda d: d["doi"]), lambda d: d.isNotNull()), none))


def record_id(calc_id: Column) -> Column:
    """The middle of an id with three or more segments, else the first."""
    parts = F.split(calc_id, ":")
    return F.when(F.size(parts) >= 3, F.get(parts, 1)).otherwise(F.get(parts, 0))


def calc_id(source: Column, rec: Column, path: Column) -> Column:
    return F.concat_ws(":", source, rec, path)


def transient(reason: Column) -> Column:
    out = F.lit(False)
    for p in TRANSIENT_PREFIXES:
        out = out | reason.startswith(p)
    return out


def terminal_fetch(reason: Column) -> Column:
    return reason.isin(*TERMINAL_FETCH)


def terminal_parse(reason: Column) -> Column:
    return reason.isin(*TERMINAL_PARSE)


def exception_type(detail: Column) -> Column:
    return F.substring(F.split_part(detail, F.lit(":"), F.lit(1)), 1, 40)


def pseudopotential_set(titles: Column) -> Column:
    """Order-sensitive fingerprint of non-blank titles: 16 hex digits of SHA-1."""
    return F.substring(F.sha1(F.array_join(F.filter(titles, lambda t: t != ""), "\n")), 1, 16)


def keep_entry(program: Column, method: Column, external_db: Column, elements: Column, want: list[str] | None = None) -> Column:
    """The second source's keep-query: program and method fit, not from a copied upstream, all elements there."""
    ok = (program == "VASP") & (method == "DFT") & F.coalesce(~external_db.isin(*EXCLUDED_UPSTREAMS), F.lit(True))
    return ok if not want else ok & (F.size(F.array_except(F.array(*[F.lit(w) for w in want]), elements)) == 0)


def normalise_hit(hit: Column) -> Column:
    """A raw search hit as a candidate: flattened, files normalised, sizes summed with nulls as zero."""
    from provlake.functions.files import classify, extension

    meta, files = hit["metadata"], F.coalesce(hit["files"], F.array())
    listed = F.transform(files, lambda f: F.struct(f["key"].alias("key"), F.coalesce(f["size"], F.lit(0)).alias("size"), extension(f["key"]).alias("ext"), f["checksum"].alias("checksum"), f["links"]["self"].alias("download")))
    recid = hit["id"].cast("string")
    return F.struct(
        recid.alias("recid"), F.coalesce(hit["conceptrecid"], recid).alias("concept"), meta["title"].alias("title"),
        F.transform(meta["creators"], lambda c: c["name"]).alias("creators"), hit["created"].alias("created"), meta["keywords"].alias("keywords"),
        meta["license"]["id"].alias("license"), meta["resource_type"]["type"].alias("resource_type"), meta["access_right"].alias("access_right"),
        F.size(files).alias("files_total"), F.aggregate(listed, F.lit(0).cast("long"), lambda a, f: a + f["size"]).alias("bytes_total"),
        listed.alias("files"), classify(F.transform(files, lambda f: f["key"])).alias("listing"),
        metadata_signals(meta["title"], F.array_join(meta["keywords"], " ")).alias("signals"),
    )


def human_bytes(n: Column) -> Column:
    """Bytes with one digit in the largest fitting unit, rounded as the stored number is, half to even."""
    shown = lambda size, unit: F.concat(F.replace(F.format_number(n / size, 1), F.lit(","), F.lit("")), F.lit(f" {unit}"))
    out = shown(1e15, "PB")
    for unit, size in (("TB", 1e12), ("GB", 1e9), ("MB", 1e6), ("KB", 1e3)):
        out = F.when(F.abs(n) < size * 1e3, shown(size, unit)).otherwise(out)
    return F.when(F.abs(n) < 1000, F.format_string("%d B", n.cast("long"))).otherwise(out)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.try_divide(100.0 * part, whole), digits)


def backoff_seconds(attempt: Column, most: float = 60.0) -> Column:
    return F.least(F.pow(F.lit(2.0), attempt + 1), F.lit(most))
