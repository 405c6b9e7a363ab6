"""The second source's entries: slim rows, paths, staged names, archive members and availability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.functions import files as ff

_VASPRUN, _OUTCAR = r"(?i)vasprun.*\.xml", r"(?i)(?:^|[/_.\-])outcar"


def entry_role(path: Column) -> Column:
    """vasprun or outcar by the basename; null for other files."""
    base = ff.basename(path)
    return F.when(base.rlike(_VASPRUN), "vasprun").when(base.rlike(_OUTCAR), "outcar")


def slim(entry: Column) -> Column:
    """The fields of a raw entry that later stages read; lists that are missing are empty, datasets without a DOI go."""
    r = entry["results"]
    sim = r["method"]["simulation"]
    listed = lambda a, f: F.coalesce(F.transform(F.filter(a, lambda x: x.isNotNull()), f), F.array())
    none = F.array().cast("array<string>")
    return F.struct(
        *[entry[c].alias(c) for c in ("entry_id", "upload_id", "mainfile", "external_db", "external_id", "license")],
        F.coalesce(entry["references"], none).alias("references"),
        F.filter(listed(entry["datasets"], lambda d: F.struct(d["doi"].alias("doi"))), lambda d: F.coalesce(d["doi"] != "", F.lit(False))).alias("datasets"),
        listed(entry["authors"], lambda a: F.struct(a["name"].alias("name"))).alias("authors"), entry["upload_create_time"].alias("upload_create_time"),
        F.struct(
            F.struct(r["material"]["elements"].alias("elements"), r["material"]["chemical_formula_reduced"].alias("chemical_formula_reduced")).alias("material"),
            F.struct(
                r["method"]["method_name"].alias("method_name"),
                F.struct(sim["program_name"].alias("program_name"), sim["program_version"].alias("program_version"), F.struct(sim["dft"]["xc_functional_names"].alias("xc_functional_names")).alias("dft")).alias("simulation"),
            ).alias("method"),
            F.struct(F.coalesce(r["properties"]["available_properties"], none).alias("available_properties")).alias("properties"),
        ).alias("results"),
    )


def relative_to_main(path: Column, mainfile: Column) -> Column:
    """A file's path below the folder of its entry's main file; elsewhere, or if that has no folder, its basename."""
    folder = F.concat(ff.dirname(mainfile), F.lit("/"))
    below = F.coalesce(mainfile.contains("/") & (ff.dirname(mainfile) != "") & path.startswith(folder), F.lit(False))
    return F.when(below, F.substring(path, F.length(folder) + 1, F.length(path))).otherwise(ff.basename(path))


def staged_name(remote: Column, role: Column) -> Column:
    """The usual name of a primary with the remote name's compression suffix."""
    return F.concat(F.when(role == "vasprun", "vasprun.xml").otherwise("OUTCAR"), F.regexp_extract(F.lower(remote), r"(\.gz|\.bz2|\.xz)$", 1))


def choose_primary(mainfile: Column, names: Column) -> Column:
    """struct(path, role): the main file if it is a primary, else the first vasprun, else the first outcar; null if there is none."""
    pick = lambda role: F.get(F.filter(names, lambda p: entry_role(p) == role), 0)
    best = lambda p: F.when(p.isNotNull(), F.struct(p.alias("path"), entry_role(p).alias("role")))
    return F.coalesce(F.when(entry_role(mainfile).isNotNull(), F.struct(mainfile.alias("path"), entry_role(mainfile).alias("role"))), best(pick("vasprun")), F.when(pick("outcar").isNotNull(), F.struct(pick("outcar").alias("path"), F.lit("outcar").alias("role"))))


def wanted_members(entries: DataFrame, members: DataFrame, siblings: bool = True) -> DataFrame:
    """(upload_id, entry_id, name, role): each entry's main file as a member of its upload's archive, and the first
    outcar beside a vasprun.  ``entries``: upload_id, entry_id, mainfile; ``members``: upload_id, name, pos."""
    e = entries.select("upload_id", "entry_id", F.col("mainfile").alias("name"), entry_role(F.col("mainfile")).alias("role")).where("role is not null")
    own = e.join(members.select("upload_id", "name").distinct(), ["upload_id", "name"]).select("upload_id", "entry_id", "name", "role")
    if not siblings:
        return own
    beside = members.where(entry_role(F.col("name")) == "outcar").groupBy("upload_id", ff.dirname(F.col("name")).alias("dir")).agg(F.min_by("name", F.struct("pos", "name")).alias("name"))
    more = own.where("role = 'vasprun'").select("upload_id", "entry_id", ff.dirname(F.col("name")).alias("dir")).join(beside, ["upload_id", "dir"])
    return own.unionByName(more.select("upload_id", "entry_id", "name", F.lit("outcar").alias("role")))


def availability(properties: Column, names: Column) -> Column:
    """Map of heavy kind to whether the entry's list of properties or a file name says it is there."""
    said = {"dos": "dos_electronic", "eigenvalues": "band_structure_electronic"}
    listed = lambda k: F.coalesce(F.exists(properties, lambda p: p.startswith(said[k])), F.lit(False)) if k in said else F.lit(False)
    by_name = ff.availability(names)
    return F.create_map(*[x for k in ff.HEAVY for x in (F.lit(k), listed(k) | F.coalesce(F.element_at(by_name, F.lit(k)), F.lit(False)))])
