"""Readers, ranges, units, commits, passes, commands and plans that spread over tasks."""

import bz2
import io
import lzma
import random
import tarfile
import threading
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from provlake import cli, config
from provlake.operators import aggregate, fetch, sample, scf, split
from provlake.plans import passes, smoke, snapshots
from provlake.sources import archives, binary, ranges, units


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), data)
    return out.getvalue()


def tarred(mode, **members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as t:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


def test_archives(spark, tmp_path):
    inner = tarred("w:gz", OUTCAR=b"inner", notes=b"n")
    (tmp_path / "a.zip").write_bytes(zipped(run__OUTCAR="one", run__CHGCAR="c", **{"sub_dot_tgz": inner, "__MACOSX___dot__OUTCAR": "x"}))
    (tmp_path / "data.gz").write_bytes(tarred("w:gz", INCAR=b"ENCUT=1"))
    (tmp_path / "bad.zip").write_bytes(b"PK nothing")
    (tmp_path / "x.rar").write_bytes(b"Rar!")
    (tmp_path / "OUTCAR.gz").write_bytes(b"not an archive")
    got = {(r.archive.rsplit("/", 1)[1], r.path): (r.content and bytes(r.content), r.reason) for r in archives.extract(binary.binary(spark, f"file://{tmp_path}")).collect()}
    assert got[("a.zip", "run/OUTCAR")] == (b"one", None) and got[("a.zip", "run/CHGCAR")] == (None, None) and got[("a.zip", "sub.tgz__extracted/OUTCAR")] == (b"inner", None)
    assert got[("data.gz", "INCAR")] == (b"ENCUT=1", None) and got[("bad.zip", "bad.zip")][1] == "extract_error" and got[("x.rar", "x.rar")][1] == "archive_unsupported"
    assert not any("MACOSX" in p for _, p in got) and not any(a == "OUTCAR.gz" for a, _ in got)
    small = {p: r for p, _, _, r, _ in archives.expand("a.zip", "zip", zipped(OUTCAR="x" * 50, INCAR="y"), cap=10)}
    assert small == {"OUTCAR": "over_size_cap", "INCAR": None}
    deep = b"x"
    for _ in range(12):
        deep = zipped(a_dot_zip=deep) if deep != b"x" else zipped(OUTCAR=deep)
    assert [r for *_, r, _ in archives.expand("a.zip", "zip", deep) if r] == ["archive_nesting_too_deep"]
    assert list(archives.expand("x.z01", "zip", b""))[0][3] == "archive_multipart_unsupported" and archives.inside("a", "../../x") is None


def test_plain_and_probes():
    for end, f in ((".bz2", bz2.compress), (".xz", lzma.compress), ("", bytes)):
        assert archives.plain("OUTCAR" + end, f(b"text")) == b"text"
    assert archives.found([b"ab", b"cd", b"ef"], [b"bcd", b"xx", b"f"]) == {b"bcd", b"f"}
    xml = b"<modeling><parameters><separator><i name='ENMAX'> 400.0</i><v name='LDAUU'>1 2</v></separator><i name='ENMAX'>1</i></parameters><broken"
    assert archives.xml_parameters(xml) == {"ENMAX": "400.0", "LDAUU": "1 2"} and archives.xml_parameters(b"<a/>") is None


def test_ranges():
    data, asked = zipped(run__OUTCAR="x" * 5000, b="y" * 100), []

    def get(a, b):
        asked.append((a, b))
        return data[a:b]

    rows = ranges.directory(get, len(data))
    assert [r[0] for r in rows] == ["run/OUTCAR", "b"] and len(asked) == 1
    assert ranges.member(get, rows[0]) == b"x" * 5000 and ranges.directory(lambda a, b: b"nothing"[a:b], 7) is None
    assert ranges.members(lambda spans: [data[a:b] for a, b in spans], rows, most=1) == {"run/OUTCAR": b"x" * 5000, "b": b"y" * 100}
    wrong = (*rows[1][:4], rows[1][4] ^ 1, *rows[1][5:])
    assert ranges.member(get, wrong) is None
    big = data + bytes(200_000)  # a directory that isn't in the tail
    moved = big[: len(data) - 22] + bytes(200_000) + data[-22:]
    assert ranges.directory(lambda a, b: moved[a:b], len(moved)) is not None
    waits, tries = [], []

    def flaky(x):
        tries.append(x)
        if len(tries) < 3:
            raise ranges.TooMany(7 if len(tries) == 1 else None)
        return x

    assert ranges.retrying(flaky, sleep=waits.append)(5) == 5 and waits == [7, 4.0]
    with pytest.raises(OSError):
        ranges.retrying(lambda: (_ for _ in ()).throw(OSError("x")), attempts=2, sleep=waits.append)()


XML = b"""<modeling><atominfo><array name="atoms"><set><rc><c>H </c><c>1</c></rc><rc><c>O </c><c>2</c></rc></set></array></atominfo>
<calculation><structure><crystal><varray name="basis"><v>2 0 0</v><v>0 2 0</v><v>0 0 2</v></varray></crystal><varray name="positions"><v>0 0 0</v><v>.5 0 0</v></varray></structure>
<varray name="forces"><v>1 0 0</v><v>-1 0 0</v></varray><energy><i name="e_fr_energy">-3.5</i><i name="e_0_energy">-3.4</i></energy></calculation>
<calculation><structure><crystal><varray name="basis"><v>2 0 0</v><v>0 2 0</v><v>0 0 2</v></varray></crystal><varray name="positions"><v>0 0 0</v><v>.5 0 0</v></varray></structure><energy/></calculation></modeling>"""


def test_units(spark):
    outcar = smoke.OUTCAR.encode()
    good = units.parse_unit("c", {"vasprun": ("vasprun.xml", XML), "outcar": ("OUTCAR", outcar)})
    assert len(good) == 1 and good[0]["parser"] == "vasprun" and good[0]["positions"] == [[0, 0, 0], [1, 0, 0]] and good[0]["ref_energy"] == -3.4 and good[0]["ionic_step"] == 0
    fell = units.parse_unit("c", {"vasprun": ("vasprun.xml", b"<torn"), "outcar": ("OUTCAR", outcar)})
    assert fell[0]["parser"] == "outcar" and fell[0]["fallback_from"] == "vasprun" and fell[0]["forces"] == [[0.1, 0, 0], [-0.1, 0, 0]]
    reasons = [units.parse_unit("c", f, n)[0]["reason"] for f, n in [({"vasprun": ("v", b"<torn")}, 0), ({"outcar": ("O", b"empty")}, 0), ({"outcar": ("O", outcar)}, 10), ({"incar": ("I", b"")}, 0)]]
    assert reasons == ["vasprun_parse_error", "no_frames", "primary_too_large", "no_primary"]
    df = spark.createDataFrame([("c1", [("outcar", "OUTCAR", bytearray(outcar))]), ("c2", [("vasprun", "v", bytearray(b"<torn"))])], "calc_id string, files array<struct<role:string,path:string,content:binary>>")
    rows = {r.calc_id: r for r in units.parse_units(df, seconds=60).collect()}
    assert rows["c1"].symbols == ["H", "H"] and rows["c2"].reason == "vasprun_parse_error"


def test_time_limit(monkeypatch):
    monkeypatch.setattr(units, "parse_unit", lambda *a: time.sleep(30))
    began = time.time()
    assert units.isolated("c", {}, 0, 0.5)[0]["reason"] == "parse_timeout" and time.time() - began < 10
    monkeypatch.setattr(units, "parse_unit", lambda *a: __import__("os")._exit(3))
    assert units.isolated("c", {}, 0, 20)[0]["reason"] == "parse_crashed"


def test_commits(spark, tmp_path):
    root = f"file://{tmp_path}/d"
    assert snapshots.read(spark, root) is None
    for n in (3, 5, 7):
        with snapshots.Lock(spark, root):
            snapshots.commit(spark.range(n), root)
            assert snapshots.read(spark, root).count() == n
            with pytest.raises(snapshots.Locked):
                snapshots.Lock(spark, root).__enter__()
    assert len(list((tmp_path / "d").glob("v=*"))) == 2
    files = snapshots.Files(spark, root)
    files.write(snapshots.LOCK, '{"host": "elsewhere", "pid": 1, "at": 0, "id": "x"}', True)
    with snapshots.Lock(spark, root):
        pass
    files.write(snapshots.LOCK, f'{{"host": "elsewhere", "pid": 1, "at": {time.time()}, "id": "x", "job": "9"}}', True)
    with pytest.raises(snapshots.Locked):
        snapshots.Lock(spark, root).__enter__()
    with snapshots.Lock(spark, root, job_active=lambda job: False):
        pass


def test_passes():
    log, left, lock = [], {"a": 2, "b": 0}, threading.Lock()

    def get(part):
        with lock:
            log.append(("get", part))
        left[part] -= 1
        return left[part] < 0

    def work(part):
        with lock:
            log.append(("work", part))
        if part == "b":
            raise ValueError("b")

    done, errors = passes.run_parts(["a", "b"], get, work)
    assert done == ["a"] and [(p, str(e)) for p, e in errors] == [("b", "b")] and log.count(("work", "a")) == 3
    done, errors = passes.run_parts(["a", "b"], lambda p: False, lambda p: None, most_passes=2)
    assert done == ["a"] and errors[0][0] == "a" and "2 passes" in str(errors[0][1])


def test_settings(tmp_path):
    (tmp_path / ".env").write_text("# x\nexport PROVLAKE_ROOT='/r'\nPROVLAKE_RAW=/w\nbad line\n")
    got = config.settings(tmp_path / ".env", {"PROVLAKE_RAW": "/e", "OTHER": "1"})
    assert got == {"PROVLAKE_ROOT": "/r", "PROVLAKE_RAW": "/e"} and config.paths(got)["raw"] == "/e" and config.paths(got)["work"] == "/r/work" and config.settings(tmp_path / "no", {}) == {}


def test_commands(spark, tmp_path, capsys):
    assert cli.main(["queries"], spark) == 0 and "bijection" in capsys.readouterr().out
    spark.createDataFrame([("r1", "a.zip", 5), ("r1", "b.tar.gz", 7), ("r2", "c", 1)], "recid string, key string, size long").write.parquet(f"{tmp_path}/f.parquet")
    assert cli.main(["census", f"{tmp_path}/f.parquet"], spark) == 0
    out = capsys.readouterr().out
    assert "records" in out and ".tar.gz" in out
    (tmp_path / "r.json").write_text('{"stage": "fetch", "id": "1", "reason": "x"}\n{"stage": "fetch", "id": "2", "reason": "x"}\n')
    assert cli.main(["reasons", f"{tmp_path}/r.json"], spark) == 0 and "x" in capsys.readouterr().out
    assert cli.render(spark.range(3), 2).endswith("...") and len(cli.COMMANDS) >= 19


def test_self_check(spark, capsys):
    assert cli.main(["smoke"], spark) == 0 and "7 of 7 passed" in capsys.readouterr().out


def test_frame_text(spark, tmp_path):
    rows = [(f"c#{i}", "c", i, ["H", "O"], [[0.0, 0.0, 0.5], [1.0, 0.0, 0.0]], [[1.0, 0.0, 0.0]] * 2 if i else None, -1.5, -1.25, True, 0.5) for i in range(5)]
    df = spark.createDataFrame(rows, "frame_id string, calc_id string, ionic_step int, symbols array<string>, positions array<array<double>>, forces array<array<double>>, ref_energy double, e_free double, electronic_converged boolean, scf_de double")
    binary.write_frame_text(df.coalesce(1), f"file://{tmp_path}/f", 2)
    assert len(list((tmp_path / "f").glob("*.gz"))) == 3
    back = binary.frames(binary.binary(spark, f"file://{tmp_path}/f", "*.gz")).drop("shard", "truncated")
    assert sorted(map(tuple, back.select(df.columns).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    torn = "1\nframe_id=a\nH 0 0 0\n1\nframe_id=b\nH 0 x 0\n"
    (tmp_path / "t.xyz").write_text(torn)
    r = binary.frames(binary.binary(spark, f"file://{tmp_path}", "*.xyz")).collect()
    assert [(x.frame_id, x.truncated) for x in r] == [("a", True)]
    assert binary.next_index(spark.createDataFrame([("x/shard-00004.gz",), ("y",)], "path string")).first()[0] == 5


def test_positions_and_groups(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randint(0, 30), i) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(5)
    got = {r.i: r.position for r in split.positions(df, "v", "i").collect()}
    assert [got[i] for _, i in sorted((v, i) for _, v, i in rows)] == list(range(700))
    stats = {r.g: r for r in aggregate.lower_index_stats(df, "g", "v").collect()}
    for g in ("a", "b", None):
        v = sorted(x for k, x, _ in rows if k == g)
        assert (stats[g].median, stats[g].p90, stats[g].n) == (v[len(v) // 2], v[min(len(v) - 1, int(0.9 * len(v)))], len(v))


def test_admission(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 2, 5, 9, 30, 200]), rng.choice([1, 1, 3, 60])) for i in range(120)]
    want, b, f = {}, 0, 0
    for i, x, y in rows:
        if x > 100 or y > 50:
            want[i] = "never_fits"
        elif b + x > 100 or f + y > 50:
            want[i] = "defer"
        else:
            want[i], b, f = "fits", b + x, f + y
    got = split.admit(spark.createDataFrame(rows, "id int, b int, f int"), "id", "id", "b", "f", 100, 50)
    assert {r.pos: r.decision for r in got.collect()} == want and set(want.values()) == {"fits", "defer", "never_fits"}


def test_samples(spark):
    df = spark.createDataFrame([(i, 10 * i) for i in range(100)], "i int, size int")
    got = sorted(r.i for r in sample.budgeted_sample(df, ["size", "i"], "size", 20, 3000).collect())
    picks = [i for i in range(0, 100, 5)]
    k = max(1, int(20 * (3000 / sum(10 * i for i in picks))))
    thin = [picks[int(j * 20 / k)] for j in range(k)]
    while len(thin) > 1 and sum(10 * i for i in thin) > 3000:
        thin.remove(max(thin))
    assert got == thin
    pages = list(sample.count_pages(df.withColumn("k", F.col("i") % 7), "k", 3))
    assert [[r.k for r in p] for p in pages] == [[0, 1, 2], [3, 4, 5], [6]]


def test_trace_without_markers(spark):
    lines = spark.createDataFrame([("f", 1, " total energy-change (2. order) : 1.0"), ("f", 2, "Iteration      2(   3)"), ("f", 3, " total energy-change (2. order) :-0.5E-01"), ("g", 1, "x")], "file string, line_no int, value string")
    got = sorted(map(tuple, scf.verdicts(scf.trace(lines), F.lit(4)).collect()))
    assert got == [("f", 0, 0, None, None), ("f", 1, 3, 0.05, True)]


def test_spans_and_reasons(spark):
    m = spark.createDataFrame([("a", str(i), i * 100, i * 100 + 50) for i in range(10)], "archive string, name string, offset long, end long")
    got = fetch.span_ranges(fetch.span_groups(m, 260)).orderBy("span").collect()
    assert [(r.start, r.stop, r.wasted) for r in got] == [(0, 250, 100), (300, 550, 100), (600, 850, 100), (900, 950, 0)]


def test_progress_and_status(spark, tmp_path):
    from provlake.streaming import ingest, progress

    said = []
    listener = progress.Progress(said.append, every=2)
    spark.streams.addListener(listener)
    try:
        (tmp_path / "in").mkdir()
        (tmp_path / "in" / "a.json").write_text("".join(f'{{"id": {i}}}\n' for i in range(5)))
        q = ingest.start(ingest.files(spark, str(tmp_path / "in"), "id int"), lambda df, _: df.count(), str(tmp_path / "cp"))
        q.awaitTermination()
        for _ in range(100):
            if len(said) >= 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert any("5 rows" in s for s in said)
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.json").write_text('{"id": 1}\n{"id": 2}\n{"i')
    assert progress.appended(spark, f"file://{tmp_path}/m", "id int").count() == 2 and progress.appended(spark, f"file://{tmp_path}/no", "id int").count() == 0


class Hits:
    """An offline search: a hit every seven seconds; the second request fails once."""

    tries = 0

    def count(self, a, b):
        return sum(1 for h in range(0, 1000, 7) if a <= h < b)

    def page(self, a, b, number, size):
        from provlake.sources.ranges import TooMany

        Hits.tries += 1
        if Hits.tries == 2:
            raise TooMany(0.01)
        return [{"id": h} for h in range(0, 1000, 7) if a <= h < b][(number - 1) * size : number * size]


def test_paged_search(spark):
    from provlake.sources import search

    spark.dataSource.register(search.PagedSearch)
    df = spark.read.format("paged_search").options(client="tests.test_stages:Hits", start="0", end="1000", most="40").load()
    got = df.select("window", F.get_json_object("hit", "$.id").cast("int").alias("id")).collect()
    assert sorted(r.id for r in got) == list(range(0, 1000, 7)) and len({r.window for r in got}) == 4
