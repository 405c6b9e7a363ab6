"""An offline self-check: small inputs through each layer, as rows of PASS and FAIL, and the bytes a frame takes."""

from __future__ import annotations

import io
import tempfile
import zipfile

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

OUTCAR = """ vasp.6.3.0 build
 INCAR:
   ENCUT = 400
 POTCAR:    PAW_PBE H 15Jun2001
   VRHFIN =H: s1
   TITEL  = PAW_PBE H 15Jun2001
   ions per type =               2
 Startparameter for this run:
   ENCUT  =  400.0 eV ; GGA = PE
--- Iteration      1(   1)  ---
 total energy-change (2. order) : 0.1E+01
--- Iteration      1(   2)  ---
 total energy-change (2. order) :-0.1E-04
      direct lattice vectors                 reciprocal lattice vectors
     4.0  0.0  0.0   0.25 0.0 0.0
     0.0  4.0  0.0   0.0 0.25 0.0
     0.0  0.0  4.0   0.0 0.0 0.25
 POSITION                                       TOTAL-FORCE (eV/Angst)
 -----------------------------------------------------------------------------------
      0.0 0.0 0.0   0.1 0.0 0.0
      0.0 0.0 0.74  -0.1 0.0 0.0
 -----------------------------------------------------------------------------------
  free  energy   TOTEN  =        -6.75 eV
  energy  without entropy=       -6.75  energy(sigma->0) =       -6.74
"""


def archive() -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("run/OUTCAR", OUTCAR)
        z.writestr("run/CHGCAR", "x")
        z.writestr("../escape/OUTCAR", "no")
    return out.getvalue()


def run(spark: SparkSession) -> list[tuple[str, bool, str]]:
    """(check, passed, what was seen)."""
    from provlake.functions import files, headers
    from provlake.operators import scf
    from provlake.sources import archives, ranges, units

    out: list[tuple[str, bool, str]] = []

    def check(name: str, f) -> None:
        try:
            ok, seen = f()
        except Exception as e:  # noqa: BLE001 - a check that breaks is a check that fails
            ok, seen = False, f"{type(e).__name__}: {e}"[:200]
        out.append((name, bool(ok), str(seen)))

    one = spark.createDataFrame([(OUTCAR,)], "text string")
    data = archive()

    def names():
        got = one.select(files.classify(F.array(F.lit("run/OUTCAR"), F.lit("a.zip"))).alias("c")).first().c.category
        return got == "vasp_direct", got

    def listing():
        got = [m[0] for m in ranges.directory(lambda a, b: data[a:b], len(data))]
        return got == ["run/OUTCAR", "run/CHGCAR", "../escape/OUTCAR"], got

    def members():
        got = {p: c is not None for p, _, c, *_ in archives.expand("a.zip", "zip", data)}
        return got == {"run/OUTCAR": True, "run/CHGCAR": False}, got

    def parameters():
        got = headers.calc_parameters(one, "text").select("calc_parameters.*").first()
        return (got.run_type, got.encut, got.code_version) == ("PBE", 400.0, "6.3.0"), got.run_type

    def steps():
        lines = one.select(F.lit("f").alias("file"), F.posexplode(F.split("text", "\n")).alias("line_no", "value"))
        got = [tuple(r) for r in scf.trace(lines).collect()]
        return got == [("f", 0, 2, 1e-05)], got

    def frames():
        got = units.parse_unit("s:1:run/OUTCAR", {"outcar": ("run/OUTCAR", OUTCAR.encode())})
        return len(got) == 1 and got[0]["ref_energy"] == -6.74 and got[0]["symbols"] == ["H", "H"], len(got)

    def bytes_per_frame():
        rows = [(f"c#{i}", [0.1 * i] * 6) for i in range(200)]
        with tempfile.TemporaryDirectory() as d:
            spark.createDataFrame(rows, "frame_id string, x array<double>").coalesce(1).write.mode("overwrite").parquet(f"file://{d}/f")
            size = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"file://{d}/f").agg(F.sum("length")).first()[0]
        return size > 0, f"{size / len(rows):.1f} B"

    for name, f in (("names", names), ("listing", listing), ("members", members), ("parameters", parameters), ("steps", steps), ("frames", frames), ("bytes a frame", bytes_per_frame)):
        check(name, f)
    return out


def report(rows: list[tuple[str, bool, str]]) -> str:
    wide = max(len(n) for n, *_ in rows)
    return "\n".join([*[f"{'PASS' if ok else 'FAIL'}  {n:<{wide}}  {seen}" for n, ok, seen in rows], f"{sum(ok for _, ok, _ in rows)} of {len(rows)} passed"])
