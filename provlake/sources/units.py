"""One calculation's output files to frames: readers by precedence, fallback, caps, time limits, refusals as rows."""

from __future__ import annotations

import multiprocessing
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from queue import Empty

import pandas as pd
from pyspark.sql import DataFrame

from provlake.sources.archives import plain

ORDER = ("vasprun", "vaspout", "outcar")
_NUMBERS = re.compile(r"[-+]?\d+\.?\d*(?:[eEdD][-+]?\d+)?")
FRAMES = "calc_id string, parser string, fallback_from string, ionic_step int, symbols array<string>, positions array<array<double>>, forces array<array<double>>, lattice array<array<double>>, ref_energy double, e_free double, stress array<double>, reason string, detail string"
_COLUMNS = [c.split(" ")[0] for c in re.split(r", (?=[a-z_]+ )", FRAMES)]


def _floats(line: str) -> list[float]:
    return [float(x.replace("D", "E").replace("d", "e")) for x in _NUMBERS.findall(line)]


def outcar_frames(text: str) -> list[dict]:
    """Ionic steps of a text output: positions, forces, lattice, energies and stress, in the order of the text."""
    lines, out, i = text.split("\n"), [], 0
    kinds: list[str] = []
    counts: list[int] = []
    lattice = stress = None
    while i < len(lines):
        line = lines[i]
        if "VRHFIN" in line and "=" in line:
            kinds.append(line.split("=", 1)[1].split(":")[0].strip())
        elif "ions per type" in line and "=" in line:
            counts = [int(x) for x in line.split("=", 1)[1].split()]
        elif "direct lattice vectors" in line:
            got = [_floats(x) for x in lines[i + 1 : i + 4]]
            if len(got) == 3 and all(len(x) >= 3 for x in got):
                lattice = [x[:3] for x in got]
        elif line.strip().startswith("in kB"):
            got = _floats(line)
            stress = got[:6] if len(got) >= 6 else None
        elif "POSITION" in line and "TOTAL-FORCE" in line:
            rows, i = [], i + 2
            while i < len(lines) and not lines[i].strip().startswith("--"):
                rows.append(_floats(lines[i]))
                i += 1
            if rows and all(len(r) == 6 for r in rows) and i < len(lines):
                symbols = [k for k, n in zip(kinds, counts) for _ in range(n)]
                out.append({"symbols": symbols if len(symbols) == len(rows) else ["X"] * len(rows), "positions": [r[:3] for r in rows], "forces": [r[3:] for r in rows], "lattice": lattice, "stress": stress, "ref_energy": None, "e_free": None})
                stress = None
        elif out and "free  energy   TOTEN" in line and out[-1]["e_free"] is None:
            out[-1]["e_free"] = (_floats(line.split("=", 1)[1]) or [None])[0]
        elif out and "energy(sigma->0)" in line and out[-1]["ref_energy"] is None:
            out[-1]["ref_energy"] = (_floats(line.rsplit("=", 1)[1]) or [None])[0]
        i += 1
    return out


def xml_frames(data: bytes) -> list[dict]:
    """Ionic steps of an XML output; a text cut off in a step gives the steps before it."""
    symbols: list[str] = []
    out: list[dict] = []
    parser = ET.XMLPullParser(["end"])
    vectors = lambda node: [[float(x) for x in v.text.split()] for v in node.iter("v")] if node is not None else None
    try:
        for a in range(0, len(data), 1 << 18):
            parser.feed(data[a : a + (1 << 18)])
            for _, node in parser.read_events():
                if node.tag == "array" and node.get("name") == "atoms":
                    symbols = [rc[0].text.strip() for rc in node.iter("rc") if len(rc)]
                elif node.tag == "calculation":
                    basis = vectors(node.find(".//structure/crystal/varray[@name='basis']"))
                    place = vectors(node.find(".//structure/varray[@name='positions']"))
                    energy = {i.get("name"): float(i.text) for i in node.findall("energy/i") if i.text and "*" not in i.text}
                    stress = vectors(node.find("varray[@name='stress']"))
                    if basis and place:
                        out.append({
                            "symbols": symbols, "positions": [[sum(f[k] * basis[k][j] for k in range(3)) for j in range(3)] for f in place], "forces": vectors(node.find("varray[@name='forces']")),
                            "lattice": basis, "ref_energy": energy.get("e_0_energy"), "e_free": energy.get("e_fr_energy"), "stress": [stress[0][0], stress[1][1], stress[2][2], stress[0][1], stress[1][2], stress[0][2]] if stress else None,
                        })
                    node.clear()
        parser.close()
    except ET.ParseError:
        if not out:
            raise
    return out


def read_primary(role: str, name: str, data: bytes) -> list[dict]:
    raw = plain(name, data)
    if role == "vasprun":
        return xml_frames(raw)
    if role == "outcar":
        return outcar_frames(raw.decode("utf-8", "replace"))
    raise NotImplementedError(f"no reader for {role}")


def parse_unit(calc_id: str, files: dict[str, tuple[str, bytes]], most_bytes: int = 0) -> list[dict]:
    """Frame rows of a unit, or one row with a reason.

    Roles are tried in ORDER; one that can't be read gives way to the next, which is named as the fallback's.  The id is
    the caller's, whatever primary is read.  Steps without an energy go, the others keep their numbers.
    """
    fits = {r: f for r, f in files.items() if r in ORDER and (not most_bytes or len(f[1]) <= most_bytes)}
    base = dict.fromkeys(_COLUMNS) | {"calc_id": calc_id}
    if not fits:
        return [base | {"reason": "primary_too_large" if any(r in ORDER for r in files) else "no_primary"}]
    failed: list[tuple[str, str]] = []
    for role in ORDER:
        if role not in fits:
            continue
        try:
            steps = read_primary(role, *fits[role])
        except Exception as e:  # noqa: BLE001 - damaged output of any kind is a refusal, not a crash
            failed.append((role, f"{type(e).__name__}: {e}"[:300]))
            continue
        rows = [base | s | {"parser": role, "fallback_from": failed[0][0] if failed else None, "ionic_step": i} for i, s in enumerate(steps) if s["ref_energy"] is not None]
        if rows:
            return rows
        failed.append((role, "no frames"))
    if all(d == "no frames" for _, d in failed):
        return [base | {"reason": "no_frames"}]
    role, detail = next((r, d) for r, d in failed if d != "no frames")
    return [base | {"reason": f"{role}_parse_error", "detail": detail}]


def _child(queue, args) -> None:
    queue.put(parse_unit(*args))


def isolated(calc_id: str, files: dict, most_bytes: int, seconds: float) -> list[dict]:
    """``parse_unit`` in a process of its own, ended after ``seconds``; a crash or a time-out is a refusal."""
    ctx = multiprocessing.get_context("fork")
    queue = ctx.Queue()
    p = ctx.Process(target=_child, args=(queue, (calc_id, files, most_bytes)), daemon=True)
    p.start()
    base = dict.fromkeys(_COLUMNS) | {"calc_id": calc_id}
    waited, step = 0.0, 0.05
    try:
        while True:
            try:
                return queue.get(timeout=step)
            except Empty:
                waited += step
                if waited >= seconds:
                    return [base | {"reason": "parse_timeout", "detail": f"{seconds:g} s"}]
                if not p.is_alive() and queue.empty():
                    return [base | {"reason": "parse_crashed", "detail": f"exit {p.exitcode}"}]
    finally:
        p.kill()
        p.join()


def _parse(most_bytes: int, seconds: float | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for calc_id, files in zip(b["calc_id"], b["files"]):
                unit = {f["role"]: (f["path"], bytes(f["content"])) for f in files}
                rows = parse_unit(calc_id, unit, most_bytes) if seconds is None else isolated(calc_id, unit, most_bytes, seconds)
                yield pd.DataFrame(rows, columns=_COLUMNS).astype({"ionic_step": "Int64"})

    return run


def parse_units(units: DataFrame, most_bytes: int = 0, seconds: float | None = None) -> DataFrame:
    """Frames and refusals of units (calc_id, files array<struct<role, path, content>>); rows with a reason are refusals."""
    return units.select("calc_id", "files").mapInPandas(_parse(most_bytes, seconds), FRAMES)
