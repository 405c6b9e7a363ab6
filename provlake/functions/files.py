"""File-name rules as Columns: extensions, classes, roles, archive kinds, heavy outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names, extensions and ranks that the record model uses.
STEMS = ("vasprun", "outcar", "vaspout", "oszicar", "poscar", "contcar", "incar", "kpoints", "potcar", "xdatcar", "doscar", "eigenval", "procar", "ibzkpt")
PRIMARY = ("vasprun", "outcar", "vaspout")
FETCH_STEMS = ("vasprun", "vaspout", "outcar", "incar", "kpoints", "poscar", "contcar", "potcar", "oszicar")
ARCHIVES = (".zip", ".tar", ".gz", ".tgz", ".bz2", ".xz", ".7z", ".rar", ".tbz2", ".zst", ".tar.gz", ".tar.bz2", ".tar.xz")
PROCESSED = (".extxyz", ".xyz", ".traj", ".aselmdb", ".lmdb", ".h5", ".hdf5", ".json", ".cif")
RANKS = {"vasp_direct": 4, "archive": 3, "processed_atomistic": 2, "vasp_input_only": 1, "unlikely": 0}
HEAVY = {
    "charge_density": "(chgcar|chg|aeccar|parchg)", "wavefunction": "wavecar", "dos": "doscar", "eigenvalues": "eigenval",
    "projected": "procar", "local_potential": "locpot", "elf": "elfcar",
}
TARS = (".tar", ".tar.gz", ".tgz", ".tar.bz2", ".tbz2", ".tar.xz", ".txz")
ROLES = ("vasprun", "vaspout", "outcar", "incar", "contcar", "poscar", "potcar")

_SQUEEZED = r"(\.(gz|bz2|xz|zst|lz4))?$"
NAME_PATTERN = r"(?iU)(?:^|[/_.-])(" + "|".join(STEMS) + r")(?:[._-]\w+)*" + _SQUEEZED
PRIMARY_PATTERN = r"(?iU)(?:^|[/_.-])(" + "|".join(PRIMARY) + r")(?:[._-]\w+)*" + _SQUEEZED
FETCH_PATTERN = r"(?i)(?:^|[/_.-])(" + "|".join(FETCH_STEMS) + r")"
JUNK_PATTERN = r"(^|/)(\._|\.DS_Store$|__MACOSX(/|$))"
MULTIPART_PATTERN = r"(?i)\.(z\d{2}|r\d{2}|part\d+\.rar)$"


def extension(name: Column) -> Column:
    """Lower-cased; ``.tar.gz``, ``.tar.bz2`` and ``.tar.xz`` count as one."""
    return F.regexp_extract(F.lower(name), r"(\.tar\.(?:gz|bz2|xz)|\.[^./]*)$", 1)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def is_calc_name(name: Column) -> Column:
    return basename(name).rlike(NAME_PATTERN)


def is_primary_name(name: Column) -> Column:
    return basename(name).rlike(PRIMARY_PATTERN)


def is_fetch_name(name: Column) -> Column:
    return basename(name).rlike(FETCH_PATTERN)


def is_junk(path: Column) -> Column:
    return path.rlike(JUNK_PATTERN)


def is_multipart(name: Column) -> Column:
    return name.rlike(MULTIPART_PATTERN)


def heavy_kind(path: Column) -> Column:
    """The kind of a heavy output, by the first word that the basename starts with; else null."""
    base = basename(path)
    return F.coalesce(*[F.when(base.rlike(f"(?i)^{p}"), k) for k, p in HEAVY.items()])


def is_heavy(kind: str):
    """A test of a name for one kind of heavy output."""
    return lambda name: basename(name).rlike(f"(?i)^{HEAVY[kind]}")


def availability(names: Column) -> Column:
    """Map of heavy kind to whether any of an array of names has it."""
    return F.create_map(*[x for k in HEAVY for x in (F.lit(k), F.exists(names, is_heavy(k)))])


def archive_kind(name: Column, bare: bool = True) -> Column:
    """zip, tar, rar, sevenzip or tarzst; top-level names (``bare``) with nothing but a compression suffix
    count as tars that lost their own, unless they are wanted files."""
    low = F.lower(name)
    ends = lambda names: "(" + "|".join(n.replace(".", r"\.") for n in names) + ")$"
    out = (
        F.when(low.endswith(".zip"), "zip").when(low.rlike(ends(TARS)), "tar")
        .when(low.endswith(".rar"), "rar").when(low.endswith(".7z"), "sevenzip").when(low.rlike(r"\.(tar\.zst|tzst)$"), "tarzst")
    )
    if bare:
        out = out.when(low.endswith(".zst") & ~is_fetch_name(name), "tarzst").when(low.rlike(r"\.(gz|bz2|xz)$") & ~is_fetch_name(name), "tar")
    return out


def is_wanted_member(path: Column, size: Column, cap: int | None) -> Column:
    ok = is_fetch_name(path) & ~is_junk(path)
    return ok if cap is None else ok & (size <= cap)


def would_download(name: Column) -> Column:
    return is_fetch_name(name) | archive_kind(name).isNotNull()


def role(path: Column) -> Column:
    """The slot of a unit that a name fills: its word at the start or behind a separator, some with their extension."""
    base, tails = basename(path), {"vasprun": r"[\w.\-]*\.xml(\.(gz|bz2|xz|zst))?$", "vaspout": r"[\w.\-]*\.h5$"}
    return F.coalesce(*[F.when(base.rlike(rf"(?iU)(?:^|[/_.\-]){k}{tails.get(k, '')}"), k) for k in ROLES])


def unit_tag(path: Column) -> Column:
    """What tells a unit's files apart in one directory: the name without its role's word, one known extension and the edges."""
    low, word = F.lower(basename(path)), role(path)
    at = F.coalesce(F.position(word, low), F.lit(0))
    bare = F.when(at > 0, F.concat(F.substring(low, F.lit(1), at - 1), F.substring(low, at + F.length(word), F.length(low)))).otherwise(low)
    return F.regexp_replace(F.regexp_replace(bare, r"\.(xml|h5|gz|bz2|xz|zst|json)$", ""), r"^[ ._\-/]+|[ ._\-/]+$", "")


def archive_subdir(name: Column) -> Column:
    bare = F.regexp_replace(basename(name), r"(?i)\.(tar\.gz|tar\.bz2|tar\.xz|tar\.zst|tgz|tbz2|zip|tar|rar|7z|gz|bz2|xz|zst)$", "")
    clean = F.regexp_replace(bare, r"[^A-Za-z0-9._-]", "_")
    return F.when(clean == "", "archive").otherwise(clean)


def normal_path(path: Column) -> Column:
    """Without ``.`` and ``..``; null if it leaves its root or is absolute."""
    walked = F.aggregate(
        F.split(path, "/"), F.array().cast("array<string>"),
        lambda acc, p: F.when(acc.isNull(), acc).when(p.isin("", "."), acc).when(p == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))).otherwise(F.concat(acc, F.array(p))),
    )
    return F.when(~path.startswith("/"), F.array_join(walked, "/"))


def inside(path: Column, root: Column) -> Column:
    """Path containment: true if ``path`` lies in ``root`` (both normalised)."""
    return (path == root) | path.startswith(F.concat(F.rtrim(root, F.lit("/")), F.lit("/")))


def classify(names: Column) -> Column:
    """struct(category, rank, vasp_files, primary_files, archives, processed) of an array of names."""
    calc, prim = F.filter(names, is_calc_name), F.filter(names, is_primary_name)
    arch = F.filter(names, lambda n: extension(basename(n)).isin(*ARCHIVES))
    proc = F.filter(names, lambda n: extension(basename(n)).isin(*PROCESSED))
    category = (
        F.when(F.size(prim) > 0, "vasp_direct").when(F.size(arch) > 0, "archive").when(F.size(proc) > 0, "processed_atomistic")
        .when(F.size(calc) > 0, "vasp_input_only").otherwise("unlikely")
    )
    return F.struct(category.alias("category"), rank(category).alias("rank"), calc.alias("vasp_files"), prim.alias("primary_files"), arch.alias("archives"), proc.alias("processed"))


def rank(category: Column) -> Column:
    return reduce(lambda acc, kv: acc.when(category == kv[0], kv[1]), list(RANKS.items())[1:], F.when(category == "vasp_direct", 4))
