import pytest
from pyspark.sql import functions as F

from provlake.functions import files, physics, records


def values(spark, rows, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_extensions(spark):
    assert values(spark, ["a.tar.gz", "B.ZIP", "c.tar.zst", "d", "e.f/g"], files.extension) == [".tar.gz", ".zip", ".zst", "", ""]


def test_calc_names(spark):
    names = ["vasprun.xml", "x/OUTCAR.gz", "OUTCAR_1", "myoutcar", "run-OUTCAR.relax.xz", "POSCAR", "readme.md"]
    assert values(spark, names, files.is_calc_name) == [True, True, True, False, True, True, False]
    assert values(spark, names, files.is_primary_name) == [True, True, True, False, True, False, False]


def test_classify(spark):
    rows = [["OUTCAR"], ["a.zip", "POSCAR"], ["POSCAR", "README.json"], ["POSCAR"], ["x.txt"], []]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x array<string>")
    got = [r.c.category for r in df.orderBy("i").select(files.classify(F.col("x")).alias("c")).collect()]
    assert got == ["vasp_direct", "archive", "processed_atomistic", "vasp_input_only", "unlikely", "unlikely"]


def test_archive_kinds(spark):
    assert values(spark, ["a.zip", "a.tar.gz", "a.7z", "a.tar.zst", "a.gz", "OUTCAR.gz", "a.txt"], files.archive_kind) == ["zip", "tar", "sevenzip", "tarzst", "tar", None, None]
    assert values(spark, ["data-raw.gz", "x.zst", "OUTCAR.zst"], files.archive_kind) == ["tar", "tarzst", None]
    assert values(spark, ["a.gz", "a.tgz"], lambda c: files.archive_kind(c, bare=False)) == [None, "tar"]


def test_paths(spark):
    assert values(spark, ["a/./b/../c", "../x", "/abs", "a//b"], files.normal_path) == ["a/c", None, None, "a/b"]


def test_heavy_and_roles(spark):
    assert values(spark, ["d/CHGCAR.gz", "WAVECAR", "xCHGCAR", "ELFCAR"], files.heavy_kind) == ["charge_density", "wavefunction", None, "elf"]
    assert values(spark, ["CHGCAR1", "parchg_2", "AECCAR0"], files.heavy_kind) == ["charge_density"] * 3
    assert values(spark, ["vasprun_1.xml.gz", "vasprun.txt", "OUTCAR", "INCAR"], files.role) == ["vasprun", None, "outcar", "incar"]
    assert values(spark, ["myoutcar.txt", "vasprun.xml.zst", "a-OUTCAR", "Si.vasprun.relax.xml"], files.role) == [None, "vasprun", "outcar", "vasprun"]
    assert values(spark, ["site1.v2_OUTCAR", "vasprun.xml", "vasprun_1.xml", "x/OUTCAR.gz"], files.unit_tag) == ["site1.v2", "", "1", ""]
    assert values(spark, ["x.7z.001", "x.001", "x.z01", "x.part1.rar", "x.r00"], files.is_multipart) == [False, False, True, True, True]


def test_licences(spark):
    ids = ["cc-by-4.0", "CC-BY-NC-4.0", "cc-by-nd", "mit", "", "closed", None, "notspecified", "gpl-3.0", "incandescent"]
    assert values(spark, ids, records.reusable_licence) == [True, False, False, True, False, False, False, False, True, True]


def test_open_access(spark):
    assert values(spark, [None, "open", "closed"], records.open_access) == [True, True, False]


def test_doi(spark):
    got = values(spark, ["10.1234/AB.c..", "https://doi.org/10.5281/zenodo.7", "none", None], records.normal_doi)
    assert got == ["10.1234/ab.c", "10.5281/zenodo.7", None, None]


def test_record_id(spark):
    assert values(spark, ["s:12:a/b", "12", "s:12"], records.record_id) == ["12", "12", "s"]


@pytest.mark.parametrize(
    ("args", "want"),
    [
        ((True, 1.0, None, None, None, False, None), "HF"), ((True, 0.25, 0.3, None, None, False, None), "HSE03"), ((True, 0.25, 0.2, None, "PE", True, None), "HSE06+U"),
        ((True, 0.2, None, None, None, False, None), "B3LYP"), ((True, 0.25, None, None, None, False, None), "PBEO or other Hybrid Functional"), ((False, None, None, "R2SCAN", "PE", False, None), "R2SCAN"),
        ((False, None, None, "--", "PS", False, 12), "PBEsol+vdW-DFT-D3-BJ"), ((False, None, None, None, "ZZ", True, 99), "ZZ+U+vdW-unknown"), ((None, None, None, None, None, None, None), "unknown"), ((False, None, None, None, "PE", False, 0), "PBE+vdW-no-correction"), ((False, 0.25, 0.2, None, "PE", False, None), "HSE06"), ((False, None, None, ".FALSE.", "PE", False, None), "PBE"),
    ],
)
def test_run_type(spark, args, want):
    h, a, s, m, g, u, v = args
    lit = lambda x, k: F.lit(x).cast(k)
    got = spark.range(1).select(physics.run_type(lit(h, "boolean"), lit(a, "double"), lit(s, "double"), lit(m, "string"), lit(g, "string"), lit(u, "boolean"), lit(v, "int"), F.lit(False))).first()[0]
    assert got == want


@pytest.mark.parametrize(
    ("tag", "incar", "par", "run", "want"),
    [
        ("LREAL", {"LREAL": "true"}, {"LREAL": "false"}, "PBE", ("true", "incar")), ("LREAL", {}, {"LREAL": "x"}, "PBE", ("x", "parameters")), ("LHFCALC", {}, {}, "HSE06", ("true", "derived:run_type")),
        ("LDAU", {}, {}, "PBE+U", ("true", "derived:run_type")), ("NKRED", {}, {}, "PBE", ("1", "default")), ("NKRED", None, {}, "PBE", (None, "unknown")), ("ENCUT", {}, {}, "PBE", (None, "unknown")),
        ("AEXX", {}, {}, "HSE03", ("0.25", "derived:run_type")), ("AEXX", {"LHFCALC": "false"}, {}, "HSE03", (None, "not_applicable")), ("HFSCREEN", {}, {"LHFCALC": "T"}, "PBE", (None, "unknown")), ("ISIF", {}, {}, "PBE", (None, "unknown")), ("AEXX", {}, {}, "PBE", (None, "not_applicable")),
    ],
)
def test_resolver(spark, tag, incar, par, run, want):
    df = spark.createDataFrame([(incar, par, run)], "incar map<string,string>, par map<string,string>, run string")
    r = df.select(physics.resolve(tag, F.col("incar"), F.col("par"), F.col("run")).alias("r")).first().r
    assert (r.value, r.source) == want


@pytest.mark.parametrize(
    ("nsw", "ibrion", "ediffg", "steps", "want"),
    [(10, 2, -0.01, 5, True), (10, 2, -0.01, 10, False), (10, 0, None, 10, True), (10, 0, None, 4, False), (None, None, None, 1, True), (0, None, None, 1, True), (10, 2, 0.0, 10, True), (10, 2, -0.01, None, None)],
)
def test_ionic(spark, nsw, ibrion, ediffg, steps, want):
    df = spark.createDataFrame([(nsw, ibrion, ediffg, steps)], "a int, b int, c double, d int")
    assert df.select(physics.ionic_converged(*map(F.col, "abcd"))).first()[0] is want


def test_scf(spark):
    df = spark.createDataFrame([([1.0, -9e-3], 2), ([1.0], 4), ([], 4)], "x array<double>, n int")
    got = [(r.v.converged, r.v.de) for r in df.select(physics.scf_verdict(F.col("x"), F.col("n")).alias("v")).collect()]
    assert got == [(False, 9e-3), (True, 1.0), (None, None)]


def test_electronic(spark):
    text = "number of electron 10.0 magnetization 1.5\nnumber of electron 10.0 magnetization 3.0 4.0 0.0\n"
    df = spark.createDataFrame([(text, [2.0, 1.0], [4.0, 6.0], ["A", "A", "B", "A"])], "t string, n array<double>, z array<double>, s array<string>")
    r = df.select(physics.moment(physics.last_magnetisation(F.col("t"))).alias("m"), physics.neutral_electrons(F.col("n"), F.col("z")).alias("e"), physics.species_runs(F.col("s")).alias("s")).first()
    assert (r.m, r.e, [(x.s, x.n) for x in r.s]) == (5.0, 14.0, [("A", 2), ("B", 1), ("A", 1)])


def test_parameters(spark):
    df = spark.createDataFrame([("encut = 500 ! c\nISMEAR=0; SIGMA = 0.1\nENCUT=1\n# x=1",)], "t string")
    assert df.select(physics.parameter_lines(F.col("t"))).first()[0] == {"ENCUT": "500", "ISMEAR": "0", "SIGMA": "0.1"}
    assert values(spark, ["3*0.5 1"], physics.repeat_tokens) == [["0.5", "0.5", "0.5", "1"]]
    assert [v.kind for v in values(spark, ["T", "12", "1.5D-3", "Normal", ".FALSE."], physics.coerce)] == ["boolean", "integer", "decimal", "text", "boolean"]


def test_last_words_of_run_types(spark):
    lit = lambda x, k: F.lit(x).cast(k)
    none = [lit(None, "double")] * 2
    got = spark.range(1).select(
        physics.run_type(F.lit(False), *none, lit(None, "string"), lit(None, "string"), F.lit(False), lit(None, "int"), F.lit(False), F.lit(True)),
        physics.run_type(F.lit(False), *none, lit(None, "string"), F.lit("PE"), F.lit(True), lit(11, "int"), F.lit(True)),
        physics.computes_stress(lit(0, "int")), physics.computes_stress(lit(None, "int")),
    ).first()
    assert got[:2] == ("LDA", "PBE+U+rVV10") and tuple(got[2]) == (False, "derived:stress") and tuple(got[3]) == (None, "unknown")


HEADER = """ vasp.6.4.2 build
 INCAR:
   encut = 450 # eV
   LDAU = .TRUE.; LDAUU = 4.0 0.0
   SYSTEM = two words
   ENCUT = 500
 POTCAR:    PAW_PBE Fe 06Sep2000
   LEXCH  = PE
 Startparameter for this run:
   NELM = 40; NELMIN= 2
   GGA = PE ; AEXX = 0.0
   LEXCH  =     8
   UNKNOWN = 3
 Iteration   1(   1)
   GGA = PS
"""


def test_headers(spark):
    from provlake.functions import headers

    df = spark.createDataFrame([(HEADER,), ("nothing",), (None,)], "text string")
    rows = headers.calc_parameters(df, "text").select(headers.header(F.col("text")).alias("h"), "calc_parameters.*").collect()
    r = rows[0]
    assert r.code_version == "6.4.2" and r.run_type == "PBE+U" and r.encut == 500.0 and r.incar["SYSTEM"] == "two words" and r.hubbard_u["LDAUU"] == "4.0 0.0"
    assert r.parameters == {"NELM": "40", "NELMIN": "2", "GGA": "PE", "AEXX": "0.0"} and r.xc_lexch == ["PE"] and r.potcar_symbols == ["PAW_PBE Fe 06Sep2000"] and len(r.h) == 13
    assert rows[1].run_type == "unknown" and rows[1].incar == {} and rows[1].parameters == {} and rows[1].potcar_set_hash is None
    two = headers.titles(F.col("text"))
    assert spark.createDataFrame([("   TITEL  = PAW_PBE O 08Apr2002\n POTCAR: x\n TITEL = A\n TITEL = A",)], "text string").select(two).first()[0] == ["PAW_PBE O 08Apr2002", "A"]


def test_lists_of_tokens(spark):
    got = values(spark, ["4.0 0.0", "T 2", "two words", ""], physics.coerce_list)
    assert [g.numbers for g in got] == [[4.0, 0.0], [1.0, 2.0], None, None] and got[2].text == "two words"
