"""Output headers as text: parameter blocks, echoes, titles, meshes and the parameters put together, as Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.functions import physics
from provlake.functions.records import pseudopotential_set

# The tags that are kept of an effective parameter block, and a tag's other name.
EFFECTIVE_TAGS = (
    "PREC", "ENCUT", "ENINI", "ENAUG", "EDIFF", "NELM", "NELMIN", "NELMDL", "ALGO", "IALGO",
    "LREAL", "ADDGRID", "LASPH", "LMAXMIX", "LMAXPAW", "GGA_COMPAT", "ISYM", "ISPIN",
    "LNONCOLLINEAR", "LSORBIT", "NBANDS", "NELECT", "NUPDOWN", "ISMEAR", "SIGMA",
    "IBRION", "NSW", "ISIF", "POTIM", "EDIFFG", "NFREE", "PSTRESS", "SMASS",
    "GGA", "METAGGA", "LHFCALC", "LHFONE", "AEXX", "AGGAX", "AGGAC", "ALDAC", "HFSCREEN",
    "HFSCREENC", "ENCUTFOCK", "PRECFOCK", "NKRED", "NKREDX", "NKREDY", "NKREDZ", "LDAU",
    "LDAUTYPE", "LDAUL", "LDAUU", "LDAUJ", "LSPINORB", "LIBXC",
    "IVDW", "LUSE_VDW", "LVDW", "LDIPOL", "IDIPOL", "LMONO",
    "LWAVE", "LCHARG", "LVTOT", "LVHAR", "LELF", "LORBIT", "LAECHG",
    "KSPACING", "KGAMMA",
)
ALIASES = {"ENMAX": "ENCUT"}
HUBBARD_TAGS = ("LDAUTYPE", "LDAUL", "LDAUU", "LDAUJ")
# Where a file's preferred functional tables stand, the modern ones first.
TABLE_ORDER = ("PBE_64", "PBE_54", "PBE_52", "PBE", "LDA_64", "LDA_54", "LDA_52", "LDA")
NELM_DEFAULT, MOST_LINES = 60, 20_000
_START = "Startparameter for this run"


def header(text: Column, most: int = MOST_LINES) -> Column:
    """Lines before the marker of the first iteration, ``most`` at the most."""
    lines = F.split(text, "\n")
    at = F.array_position(F.transform(lines, lambda x: x.rlike(r"Iteration\s+1\(\s*1\)")), True)
    return F.slice(lines, 1, F.least(F.when(at > 0, at - 1).otherwise(F.size(lines)), F.lit(most)).cast("int"))


def first_map(entries: Column) -> Column:
    """Map of an array of struct(k, v); of equal keys the first."""
    keys = F.transform(entries, lambda e: e["k"])
    return F.map_from_entries(F.filter(entries, lambda e, i: F.array_position(keys, e["k"]) == i + 1))


def last_map(entries: Column) -> Column:
    """Map of an array of struct(k, v); of equal keys the last."""
    return first_map(F.reverse(entries))


def effective_block(text: Column) -> Column:
    """Map of the kept tags of the resolved block, from its first line on; a tag's first place counts; empty without a block."""
    rest = F.regexp_extract(text, f"(?s)({_START}.*)", 1)
    pattern = r"([A-Za-z_][A-Za-z0-9_]*)[ \t]*=[ \t]*([^\s;]+)"
    keys = F.transform(F.regexp_extract_all(rest, F.lit(pattern), 1), F.upper)
    pairs = F.zip_with(keys, F.regexp_extract_all(rest, F.lit(pattern), 2), lambda k, v: F.struct(k.alias("k"), v.alias("v")))
    return first_map(F.filter(pairs, lambda e: e["k"].isin(*EFFECTIVE_TAGS)))


def input_echo(text: Column) -> Column:
    """Map of the user's own tags, between the lines that start with ``INCAR:`` and ``POTCAR:``; of equal tags the last."""
    lines = F.split(text, "\n")
    starts = lambda word: F.transform(lines, lambda x: F.ltrim(x).startswith(word))
    a = F.array_position(starts("INCAR:"), True).cast("int")
    stops = F.filter(F.transform(starts("POTCAR:"), lambda on, i: F.when(on, i + 1)), lambda i: i > a)
    stop = F.coalesce(F.get(stops, F.lit(0)), F.size(lines) + 1)
    block = F.when(a > 0, F.slice(lines, a + 1, F.greatest(stop - a - 1, F.lit(0)))).otherwise(F.array().cast("array<string>"))
    bodies = F.flatten(F.transform(block, lambda x: F.split(F.regexp_extract(x, "^([^#!]*)", 1), ";")))
    pattern = r"^\s*([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.*\S)\s*$"
    pairs = F.transform(F.filter(bodies, lambda b: b.rlike(pattern)), lambda b: F.struct(F.upper(F.regexp_extract(b, pattern, 1)).alias("k"), F.regexp_extract(b, pattern, 2).alias("v")))
    return last_map(pairs)


def titles(text: Column) -> Column:
    """Distinct pseudopotential titles in order; without any, those of the summary lines."""
    lines = F.split(text, "\n")
    own = F.transform(F.filter(lines, lambda x: x.contains("TITEL") & x.contains("=")), lambda x: F.trim(F.regexp_replace(x, "^[^=]*=", "")))
    old = F.transform(F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x.startswith("POTCAR:")), lambda x: F.trim(F.substring(x, F.lit(8), F.length(x))))
    own, old = (F.array_distinct(F.filter(F.transform(a, lambda t: F.regexp_replace(t, r"\s+$|^\s+", "")), lambda t: t != "")) for a in (own, old))
    return F.when(F.size(own) > 0, own).otherwise(old)


def exchange_family(text: Column) -> Column:
    """Distinct names that the pseudopotentials give their exchange, above the resolved block; numbers are codes and don't count."""
    above = F.regexp_extract(text, rf"(?s)^(.*?)(?:\n[^\n]*{_START}|$(?!\n))", 1)
    first = F.transform(F.split(above, "\n"), lambda x: F.regexp_extract(x, r"\bLEXCH\s*=\s*([A-Za-z0-9]+)", 1))
    return F.array_distinct(F.filter(first, lambda v: (v != "") & ~v.rlike(r"^\d+$")))


def hubbard(text: Column, own: Column, effective: Column) -> Column:
    """struct(on, values): whether a Hubbard term is on, and its arrays as the user or the output gives them."""
    tag = lambda m, k: F.element_at(m, F.lit(k))
    on = physics.truthy(tag(own, "LDAU")) | physics.truthy(tag(effective, "LDAU")) | F.coalesce(text.contains("LDA+U is selected"), F.lit(False))
    echo = lambda k: F.nullif(F.trim(F.regexp_extract(text, rf"(?m)\b{k}[ \t]*=[ \t]*([^#!\n]+)", 1)), F.lit(""))
    values = F.map_filter(F.create_map(*[x for k in HUBBARD_TAGS for x in (F.lit(k), F.coalesce(tag(own, k), echo(k)))]), lambda k, v: v.isNotNull())
    return F.struct(on.alias("on"), F.when(on & (F.size(values) > 0), values).alias("values"))


def mesh(text: Column, own: Column, effective: Column) -> Column:
    """struct(style, points, count, spacing) of the k-points; null where the text doesn't say."""
    style = F.when(text.rlike("(?i)Monkhorst[_ -]?Pack"), "Monkhorst").when(text.rlike("Gamma-point only") | text.rlike(r"(?i)\bGamma\b.*k-?points?"), "Gamma")
    spacing = F.coalesce(F.element_at(own, F.lit("KSPACING")), F.element_at(effective, F.lit("KSPACING")))
    style = style.when(text.rlike("(?i)Automatic generation of k-mesh"), "Automatic").when(spacing.isNotNull(), "KSPACING")
    grid = r"generate k-points for:\s*(\d+)\s+(\d+)\s+(\d+)"
    points = F.when(text.rlike(grid), F.array(*[F.regexp_extract(text, grid, i).cast("int") for i in (1, 2, 3)]))
    return F.struct(style.alias("style"), points.alias("points"), F.regexp_extract(text, r"NKPTS\s*=\s*(\d+)", 1).try_cast("int").alias("count"), spacing.alias("spacing"))


def code_version(text: Column) -> Column:
    return F.nullif(F.regexp_extract(F.split_part(text, F.lit("\n"), F.lit(1)), r"^\s*vasp\.(\S+)", 1), F.lit(""))


def max_steps(text: Column) -> Column:
    """NELM of a header, 60 if it isn't there; NELMIN and NELMDL are other tags."""
    return F.coalesce(F.regexp_extract(text, r"\bNELM\s*=\s*(\d+)", 1).try_cast("int"), F.lit(NELM_DEFAULT))


def number(value: Column) -> Column:
    """A token as a double, also with a Fortran exponent; null if it is none."""
    return F.translate(F.upper(F.trim(value)), "D", "E").try_cast("double")


def restrict(parameters: Column) -> Column:
    """The kept tags of a raw parameter map, with other names put right where the tag itself is missing; nulls go."""
    tag = lambda k: F.element_at(parameters, F.lit(k))
    renamed = F.map_filter(F.create_map(*[x for a, k in ALIASES.items() for x in (F.lit(k), F.when(tag(k).isNull(), tag(a)))]), lambda k, v: v.isNotNull())
    own = F.map_filter(parameters, lambda k, v: k.isin(*EFFECTIVE_TAGS) & v.isNotNull())
    return F.map_concat(own, renamed)


def as_json(value: Column) -> Column:
    """Structs, maps and arrays as JSON text; nulls inside stay."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def parser_family(calc_id: Column) -> Column:
    """Which reader an id's file belongs to."""
    tail = F.lower(F.substring_index(calc_id, ":", -1))
    return F.when(tail.contains("vasprun"), "vasprun").when(tail.endswith(".h5") | tail.contains("vaspout"), "vaspout").otherwise("outcar")


def kept_steps(energies: Column) -> Column:
    """struct(kept, dropped): ionic steps with an energy under their first numbers, and how many have none."""
    at = F.transform(energies, lambda e, i: F.struct(i.alias("step"), e.alias("energy")))
    kept = F.filter(at, lambda x: x["energy"].isNotNull())
    return F.struct(kept.alias("kept"), (F.size(energies) - F.size(kept)).alias("dropped"))


def calc_parameters(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``calc_parameters``: what a header text says of a calculation, the user's tags before the resolved ones."""
    own, eff, t = F.col("_own"), F.col("_eff"), F.col(text)
    got = df.withColumns({"_own": input_echo(t), "_eff": effective_block(t), "_titles": titles(t)})
    got = got.withColumn("_hub", hubbard(t, own, eff))
    tag = lambda m, k: F.element_at(m, F.lit(k))
    pick = lambda k: F.coalesce(tag(eff, k), tag(own, k))
    param = lambda k: F.coalesce(tag(own, k), tag(eff, k))
    run = physics.run_type(
        physics.truthy(pick("LHFCALC")), number(pick("AEXX")), number(pick("HFSCREEN")), F.coalesce(tag(own, "METAGGA"), tag(eff, "METAGGA")), pick("GGA"),
        F.col("_hub.on"), tag(own, "IVDW").try_cast("int"), physics.truthy(pick("LUSE_VDW")), F.split_part(F.get("_titles", 0), F.lit(" "), F.lit(1)) == "PAW",
    )
    got = got.withColumn("_run", run)
    ispin = param("ISPIN").try_cast("int")
    block = F.struct(
        F.lit("vasp").alias("code"), code_version(t).alias("code_version"), F.col("_run").alias("run_type"), physics.functional(F.col("_run")).alias("functional"), F.col("_hub.values").alias("hubbard_u"),
        (ispin == 2).alias("spin_polarized"), number(param("ENCUT")).alias("encut"), number(param("EDIFF")).alias("ediff"), param("ISMEAR").try_cast("int").alias("ismear"), number(param("SIGMA")).alias("sigma"), ispin.alias("ispin"),
        mesh(t, own, eff).alias("kpoints"), F.col("_titles").alias("potcar_symbols"), F.when(F.size("_titles") > 0, pseudopotential_set(F.col("_titles"))).alias("potcar_set_hash"),
        own.alias("incar"), eff.alias("parameters"), exchange_family(t).alias("xc_lexch"), F.lit("header").alias("parsed_from"),
    )
    return got.withColumn("calc_parameters", block).drop("_own", "_eff", "_titles", "_hub", "_run")


def is_magnetic(parameters: Column) -> Column:
    """Whether a calculation carries magnetisation: spin-polarised, or a non-collinear flag on (the resolved one first)."""
    flag = lambda k: physics.truthy(F.coalesce(F.element_at(parameters["parameters"], F.lit(k)), F.element_at(parameters["incar"], F.lit(k))))
    return F.coalesce(parameters["spin_polarized"], F.lit(False)) | flag("LNONCOLLINEAR") | flag("LSORBIT")


def electronic(df: DataFrame, text: str, table: Column | None = None) -> DataFrame:
    """``df`` (with ``calc_parameters``) with ``electronic``: net moment and charge of an output text, and where they come from.

    The moment is that of the last magnetisation line, zero for a run without spin that prints none.  The neutral number of
    electrons takes the valences above the resolved block, or else a map of titles to valences; what isn't sure is null.
    """
    c, t = F.col("calc_parameters"), F.col(text)
    none = F.array().cast("array<double>")
    above = F.regexp_extract(t, rf"(?s)^(.*?)(?:\n[^\n]*{_START}|$(?!\n))", 1)
    got = df.withColumns({
        "_mags": F.coalesce(F.filter(physics.last_magnetisation(t), lambda x: x.isNotNull()), none),
        "_zval": F.transform(F.regexp_extract_all(above, F.lit(r"POMASS\s*=\s*[\d.]+\s*;\s*ZVAL\s*=\s*([\d.]+)"), 1), lambda x: x.try_cast("double")),
        "_ions": F.transform(F.filter(F.split(F.trim(F.regexp_extract(t, r"ions per type\s*=([ \d]+)", 1)), r"\s+"), lambda x: x != ""), lambda x: x.cast("double")),
    })
    flag = lambda k: physics.truthy(F.element_at(c["incar"], F.lit(k))) | physics.truthy(F.element_at(c["parameters"], F.lit(k)))
    bare = ~F.coalesce(c["ispin"] == 2, F.lit(False)) & ~flag("LNONCOLLINEAR") & ~flag("LSORBIT")
    n = F.size("_mags")
    moment = F.when(n >= 3, physics.moment(F.slice("_mags", 1, 3))).when(n >= 1, F.round(F.get("_mags", 0), 6)).when(bare, 0.0)
    source = F.when(n >= 3, "outcar_ncl").when(n >= 1, "outcar").when(bare, "nonmagnetic").otherwise("unavailable")
    nelect = F.coalesce(number(F.element_at(c["parameters"], F.lit("NELECT"))), number(F.element_at(c["incar"], F.lit("NELECT"))))
    own = F.when(F.size("_ions") > 0, physics.neutral_electrons(F.col("_ions"), F.col("_zval")))
    known = F.lit(None).cast("double")
    if table is not None:
        zvals = F.transform(c["potcar_symbols"], lambda x: F.element_at(table, F.replace(x, F.lit(" "), F.lit(""))))
        known = F.when((F.size("_ions") > 0) & F.forall(zvals, lambda z: z.isNotNull()), physics.neutral_electrons(F.col("_ions"), zvals))
    neutral = F.coalesce(own, known)
    charge = physics.net_charge(neutral, nelect)
    block = F.struct(
        moment.alias("net_magnetization"), source.alias("magnetization_source"), charge.alias("net_charge"), nelect.alias("nelect"), neutral.alias("nelect_neutral"),
        F.when(charge.isNull(), "unavailable").when(own.isNotNull(), "outcar_header").otherwise("potcar_stats").alias("charge_source"),
    )
    return got.withColumn("electronic", block).drop("_mags", "_zval", "_ions")


def valences(titles_: DataFrame, table: DataFrame, key: str = "title") -> DataFrame:
    """(key, zval) of each title that a reference table (functional, title, zval) knows: without blanks, the preferred functional first."""
    order = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in TABLE_ORDER]), F.col("functional")), F.lit(0))
    known = table.where("zval is not null").select(F.col("title").alias("_plain"), F.when(order > 0, order).otherwise(len(TABLE_ORDER) + 1).alias("_order"), "functional", "zval")
    best = known.groupBy("_plain").agg(F.min(F.struct("_order", "functional", "zval")).alias("b")).select("_plain", F.col("b.zval").alias("zval"))
    return titles_.select(key).distinct().withColumn("_plain", F.replace(F.col(key), F.lit(" "), F.lit(""))).join(best, "_plain").select(key, "zval")
