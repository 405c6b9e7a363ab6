"""Run types, resolved parameters, convergence and electronic quantities as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of functionals and dispersion corrections, defaults of tags.
GGA = {"RE": "revPBE", "PE": "PBE", "PS": "PBEsol", "RP": "revPBE+Padé", "AM": "AM05", "OR": "optPBE", "BO": "optB88", "MK": "optB86b", "--": "GGA"}
METAGGA = {"TPSS": "TPSS", "RTPSS": "revTPSS", "M06L": "M06-L", "MBJ": "modified Becke-Johnson", "SCAN": "SCAN", "R2SCAN": "R2SCAN", "RSCAN": "RSCAN", "MS0": "MadeSimple0", "MS1": "MadeSimple1", "MS2": "MadeSimple2"}
METAGGA_OFF = ("--", "NONE", "F", ".FALSE.", ".F.", "FALSE", "T", ".TRUE.", ".T.", "TRUE")
IVDW = {0: "no-correction", 1: "DFT-D2", 10: "DFT-D2", 11: "DFT-D3", 12: "DFT-D3-BJ", 2: "TS", 20: "TS", 21: "TS-H", 202: "MBD", 4: "dDsC"}
DEFAULTS = {"LHFCALC": "false", "LDAU": "false", "LSORBIT": "false", "ADDGRID": "false", "LREAL": "false", "LASPH": "false", "NKRED": "1"}
HYBRIDS = {"HSE06": (0.25, 0.2), "HSE03": (0.25, 0.3), "B3LYP": (0.2, 0.0), "HF": (1.0, 0.0)}
TAGS = ["LHFCALC", "LDAU", "LSORBIT", "ADDGRID", "LREAL", "LASPH", "NKRED", "AEXX", "HFSCREEN", "ENCUT", "ISIF"]
OTHER_HYBRID = "PBEO or other Hybrid Functional"
KBAR_TO_EV = 0.1 * 0.006241509125883258


def close(x: Column, y: float) -> Column:
    return F.coalesce(F.abs(x - y) <= F.greatest(F.abs(x), F.lit(abs(y))) * 1e-9, F.lit(False))


def _labels(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def run_type(lhfcalc: Column, aexx: Column, hfscreen: Column, metagga: Column, gga: Column, ldau: Column, ivdw: Column, luse_vdw: Column, paw: Column | None = None) -> Column:
    """Functional by the ordered rule, then ``+U``, then the dispersion suffix (IVDW of the user's own file only).

    The mixing numbers decide whether or not LHFCALC is on; absent ones count as zero.  ``paw``: whether the
    first pseudopotential's title starts with PAW, which leaves LDA where nothing else is said.
    """
    meta, g = F.upper(F.trim(metagga)), F.upper(F.trim(gga))
    said = lambda x: x.isNotNull() & (x != "")
    base = (
        F.when(close(aexx, 1.0), "HF").when(close(hfscreen, 0.3), "HSE03").when(close(hfscreen, 0.2), "HSE06").when(close(aexx, 0.2), "B3LYP")
        .when(lhfcalc, OTHER_HYBRID).when(said(meta) & ~meta.isin(*METAGGA_OFF), F.coalesce(F.element_at(_labels(METAGGA), meta), meta))
        .when(said(g), F.coalesce(F.element_at(_labels(GGA), g), g)).when(F.lit(False) if paw is None else paw, "LDA").otherwise("unknown")
    )
    vdw = F.coalesce(F.element_at(_labels(IVDW), ivdw), F.when(ivdw != 0, "unknown"))
    tail = F.when(luse_vdw, "+rVV10").when(vdw.isNotNull(), F.concat(F.lit("+vdW-"), vdw)).otherwise("")
    return F.concat(base, F.when(ldau, "+U").otherwise(""), tail)


def functional(run: Column) -> Column:
    return F.split_part(run, F.lit("+"), F.lit(1))


def is_hybrid(run: Column) -> Column:
    return F.coalesce(functional(run).isin(*HYBRIDS) | run.contains("Hybrid"), F.lit(False))


def truthy(value: Column) -> Column:
    """Whether a text stands for on; other texts and null are off."""
    return F.coalesce(F.upper(F.trim(value)).isin("T", ".TRUE.", ".T.", "TRUE", "1"), F.lit(False))


def resolve(tag: str, incar: Column, parameters: Column, run: Column) -> Column:
    """struct(value, source): the user's file, the effective block, what the run type says, the default, else unknown.

    ``incar`` and ``parameters`` are maps of text.  A present but empty ``incar`` is complete; a null one is not,
    so nothing is derived or defaulted from its silence.  AEXX and HFSCREEN apply only if the resolved LHFCALC is on.
    """
    own, eff = F.element_at(incar, F.lit(tag)), F.element_at(parameters, F.lit(tag))
    complete, none = incar.isNotNull(), F.lit(None).cast("string")
    off = F.lit(False)
    derived = none
    if tag == "LHFCALC":
        derived = F.when(complete & is_hybrid(run), "true")
    elif tag == "LDAU":
        derived = F.when(complete & F.coalesce(run.contains("+U"), F.lit(False)), "true")
    elif tag in ("AEXX", "HFSCREEN"):
        off = complete & ~truthy(resolve("LHFCALC", incar, parameters, run)["value"])
        i = 0 if tag == "AEXX" else 1
        derived = F.when(complete & ~off, F.element_at(_labels({k: str(v[i]) for k, v in HYBRIDS.items()}), functional(run)))
    default = F.when(complete, F.lit(DEFAULTS[tag])) if tag in DEFAULTS else none
    source = (
        F.when(own.isNotNull(), "incar").when(eff.isNotNull(), "parameters").when(derived.isNotNull(), "derived:run_type")
        .when(default.isNotNull(), "default").when(off, "not_applicable").otherwise("unknown")
    )
    return F.struct(F.coalesce(own, eff, derived, default).alias("value"), source.alias("source"))


def resolve_all(incar: Column, parameters: Column, run: Column) -> Column:
    return F.create_map(*[x for t in TAGS for x in (F.lit(t), resolve(t, incar, parameters, run))])


def effective(resolved: Column) -> Column:
    """Map of tag to value alone; null where unresolved."""
    return F.transform_values(resolved, lambda k, v: v["value"])


def computes_stress(frames_with_stress: Column) -> Column:
    """struct(value, source) of whether a run gave stresses, by its frames; unknown without a count."""
    known = frames_with_stress.isNotNull()
    return F.struct(F.when(known, frames_with_stress > 0).alias("value"), F.when(known, "derived:stress").otherwise("unknown").alias("source"))


def lookup(tag: str, parameters: Column, incar: Column, resolved: Column) -> Column:
    return F.coalesce(F.element_at(parameters, F.lit(tag)), F.element_at(incar, F.lit(tag)), F.element_at(resolved, F.lit(tag))["value"])


def ionic_converged(nsw: Column, ibrion: Column, ediffg: Column, steps: Column) -> Column:
    """Null if the number of steps is unknown."""
    n = F.coalesce(nsw, F.lit(0))
    mode = F.coalesce(ibrion, F.when(n.isin(-1, 0), -1).otherwise(0))
    whole = (n <= 1) | (steps == n)
    return F.when(steps.isNull(), F.lit(None).cast("boolean")).when((mode == 0) | (mode.isin(1, 2) & F.coalesce(ediffg == 0, F.lit(False))), whole).otherwise((n <= 1) | (steps < n))


def scf_verdict(changes: Column, nelm: Column) -> Column:
    """struct(converged, de) of a step's energy changes: fewer than NELM (60) steps, size of the last change; null without steps."""
    n = F.size(changes)
    return F.struct(F.when(n > 0, n < F.coalesce(nelm, F.lit(60))).alias("converged"), F.when(n > 0, F.abs(F.try_element_at(changes, F.lit(-1)))).alias("de"))


def energy_change(energies: Column) -> Column:
    return F.when(F.size(energies) > 1, F.try_element_at(energies, F.lit(-1)) - F.try_element_at(energies, F.lit(-2)))


def corrected_energy(raw: Column, fixed: Column) -> Column:
    return F.when(F.abs(raw - fixed) > 1e-7, F.round(fixed, 8)).otherwise(raw)


def entropy_term(energy: Column, free: Column) -> Column:
    return energy - free


def stress_voigt(m: Column) -> Column:
    """3 x 3 in kBar (rows) to xx, yy, zz, yz, xz, xy in eV per cubic angstrom, sign turned."""
    at = lambda i, j: F.get(F.get(m, i), j)
    return F.array(*[-KBAR_TO_EV * at(i, j) for i, j in ((0, 0), (1, 1), (2, 2), (1, 2), (0, 2), (0, 1))])


def moment(parts: Column) -> Column:
    """One component is the moment; three are a vector whose length counts; 6 digits."""
    norm = F.sqrt(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x * x))
    return F.round(F.when(F.size(parts) == 1, F.get(parts, 0)).when(F.size(parts) == 3, norm), 6)


def last_magnetisation(text: Column) -> Column:
    """Components on the last total-magnetisation line of an output text."""
    hits = F.regexp_extract_all(text, F.lit(r"number of electron\s+\S+\s+magnetization((?:[ \t]+[-+0-9.Ee]+)*)"), 1)
    return F.transform(F.filter(F.split(F.trim(F.try_element_at(hits, F.lit(-1))), r"\s+"), lambda x: x != ""), lambda x: x.try_cast("double"))


def occupancy_moment(up: Column, down: Column, weights: Column) -> Column:
    """Sum over k-points of the weight times the sum over bands of up minus down."""
    per = F.zip_with(up, down, lambda u, d: F.aggregate(F.zip_with(u, d, lambda a, b: a - b), F.lit(0.0), lambda a, x: a + x))
    return F.round(F.aggregate(F.zip_with(per, weights, lambda p, w: p * w), F.lit(0.0), lambda a, x: a + x), 6)


def neutral_electrons(ions: Column, zval: Column) -> Column:
    """Null unless there is one valence per species."""
    return F.when(F.size(ions) == F.size(zval), F.aggregate(F.zip_with(ions, zval, lambda n, z: n * z), F.lit(0.0), lambda a, x: a + x))


def net_charge(neutral: Column, nelect: Column) -> Column:
    return F.round(neutral - nelect, 6)


def species_runs(symbols: Column) -> Column:
    """Run lengths in order: equal neighbours count together, not equal elements."""
    return F.aggregate(
        symbols, F.array().cast("array<struct<s:string,n:int>>"),
        lambda acc, s: F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["s"] == s), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(s.alias("s"), (F.try_element_at(acc, F.lit(-1))["n"] + 1).alias("n"))))).otherwise(F.concat(acc, F.array(F.struct(s.alias("s"), F.lit(1).alias("n"))))),
    )


def is_magnetic(ispin: Column, noncollinear: Column, spin_orbit: Column) -> Column:
    return F.coalesce(ispin == 2, F.lit(False)) | F.coalesce(noncollinear, F.lit(False)) | F.coalesce(spin_orbit, F.lit(False))


def spin_availability(charge_density: Column, spin: Column, magnetic: Column) -> Column:
    return F.struct((charge_density & spin).alias("spin_density"), magnetic.alias("magnetization"))


def coerce(token: Column) -> Column:
    """struct(kind, b, i, d, s): a parameter token as boolean, integer, decimal (Fortran D exponents too) or text."""
    t = F.upper(F.trim(token))
    b = F.when(t.isin("T", ".T.", ".TRUE."), True).when(t.isin("F", ".F.", ".FALSE."), False)
    i = t.try_cast("long")
    d = F.translate(t, "D", "E").try_cast("double")
    kind = F.when(b.isNotNull(), "boolean").when(i.isNotNull() & ~t.contains("."), "integer").when(d.isNotNull(), "decimal").otherwise("text")
    return F.struct(kind.alias("kind"), b.alias("b"), i.alias("i"), d.alias("d"), token.alias("s"))


def coerce_list(value: Column) -> Column:
    """struct(numbers, text): a value of several tokens as numbers if all are numbers or booleans (1 and 0), else as text."""
    tokens = F.transform(F.filter(F.split(F.trim(value), r"\s+"), lambda x: x != ""), coerce)
    plain = (F.size(tokens) > 0) & F.forall(tokens, lambda t: t["kind"] != "text")
    return F.struct(F.when(plain, F.transform(tokens, lambda t: F.coalesce(t["d"], t["b"].cast("double")))).alias("numbers"), F.when(~plain, F.trim(value)).alias("text"))


def parameter_lines(text: Column) -> Column:
    """Map of tags of a user's input text: comments after ``#`` or ``!`` go, ``;`` separates, the first of a tag counts."""
    bare = F.regexp_replace(text, r"[#!][^\n]*", "")
    pairs = F.filter(F.split(bare, r"[;\n]"), lambda x: x.contains("="))
    entry = F.transform(pairs, lambda x: F.struct(F.upper(F.trim(F.split_part(x, F.lit("="), F.lit(1)))).alias("k"), F.trim(F.regexp_replace(x, r"^[^=]*=", "")).alias("v")))
    first = F.aggregate(entry, F.array().cast("array<struct<k:string,v:string>>"), lambda a, e: F.when(F.exists(a, lambda y: y["k"] == e["k"]), a).otherwise(F.concat(a, F.array(e))))
    return F.map_from_entries(first)


def repeat_tokens(value: Column) -> Column:
    """``3*0.5 1`` as 0.5, 0.5, 0.5, 1."""
    return F.flatten(F.transform(F.filter(F.split(F.trim(value), r"\s+"), lambda x: x != ""), lambda x: F.when(x.rlike(r"^\d+\*"), F.array_repeat(F.regexp_replace(x, r"^\d+\*", ""), F.regexp_extract(x, r"^(\d+)\*", 1).try_cast("int"))).otherwise(F.array(x))))
