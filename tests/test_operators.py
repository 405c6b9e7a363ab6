import gzip
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from provlake.operators import aggregate, dataset, keys, report, split
from provlake.sources import binary, jsonl, search


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_newest_is_numeric(spark):
    df = spark.createDataFrame([("c", "9", 0), ("c", "100", 1), ("c", "100", 2), ("d", "1", 3)], "k string, v string, pos int")
    assert rows(keys.newest_per_key(df, "k", F.col("v").cast("long"), "pos")) == [("c", "100", 1), ("d", "1", 3)]


def test_gates_give_reasons(spark):
    df = spark.createDataFrame([(1, "mit"), (2, None), (3, "nc")], "id int, lic string")
    kept, out = aggregate.split_rejects(df, [("licence", F.col("lic") != "nc")], "discover", "id")
    assert [r.id for r in kept.collect()] == [1]
    assert rows(out) == [("discover", "2", "licence"), ("discover", "3", "licence")]


def test_bijection(spark):
    m = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "k string")
    d = spark.createDataFrame([("a",), ("b",), ("b",), ("x",), ("c",)], "k string")
    got = {r.k: r.state for r in dataset.bijection(m, d, "k").collect()}
    assert got == {"b": "duplicate_on_disk", "c": "duplicate_in_meta", "x": "orphan"}
    fatal = {r.state: r.fatal for r in dataset.integrity(m, d, "k", truncated=1).collect()}
    assert fatal == {"duplicate_on_disk": True, "duplicate_in_meta": True, "orphan": False}


def test_units(spark):
    files = ["a/vasprun.xml", "a/INCAR", "b/OUTCAR_1", "b/OUTCAR_2", "b/INCAR", "b/POSCAR_1", "c/notes.txt", "d/INCAR"]
    df = spark.createDataFrame([("r", f) for f in files], "recid string, path string")
    got = {(r.dir, r.unit): r.files for r in dataset.group_units(df).collect()}
    assert got == {("a", ""): {"vasprun": "a/vasprun.xml", "incar": "a/INCAR"}, ("b", "1"): {"outcar": "b/OUTCAR_1", "incar": "b/INCAR", "poscar": "b/POSCAR_1"}, ("b", "2"): {"outcar": "b/OUTCAR_2", "incar": "b/INCAR"}}


def test_lpt(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate([10, 1, 1, 1, 1, 1, 1, 1])], "k int, w int")
    load = {r.part: r.s for r in split.lpt(df, "k", "w", 2).groupBy("part").agg(F.sum("weight").alias("s")).collect()}
    assert load == {0: 10, 1: 7}


def test_round_robin(spark):
    df = split.round_robin(split.positions(spark.range(5), "id"), "position", 2)
    assert rows(df.select("id", "part")) == [(0, 0), (1, 1), (2, 0), (3, 1), (4, 0)]


def test_admission(spark):
    df = spark.createDataFrame([("a", 0, 60, 1), ("b", 1, 60, 1), ("c", 2, 200, 1), ("d", 3, 40, 1)], "id string, pos int, b int, f int")
    assert rows(split.admit(df, "id", "pos", "b", "f", 100, 10).select("id", "decision")) == [("a", "fits"), ("b", "defer"), ("c", "never_fits"), ("d", "fits")]


def test_merge(spark):
    a = spark.createDataFrame([("x", ["shard-00003.extxyz.gz"])], "calc_id string, shards array<string>")
    b = spark.createDataFrame([("y", ["shard-00000.extxyz.gz", "shard-00001.extxyz.gz"])], "calc_id string, shards array<string>")
    got, names = dataset.merge_shards(a, [b])
    assert {r.calc_id: r.shards for r in got.collect()} == {"x": ["shard-00003.extxyz.gz"], "y": ["shard-00004.extxyz.gz", "shard-00005.extxyz.gz"]}
    assert names.count() == 2 and dataset.merge_conflicts(a, [a]).count() == 1


def test_ancestors(spark):
    p = spark.createDataFrame([("r/a/b/f",), ("r/x",), ("f",)], "path string")
    d = spark.createDataFrame([("r", "outer", False), ("r/a", "inner", True)], "dir string, s string, keep boolean")
    assert rows(dataset.nearest_ancestor(p, d, "s")) == [("f", None), ("r/a/b/f", "inner"), ("r/x", "outer")]
    assert rows(dataset.reclaimable(p, d)) == [("f",), ("r/x",)]


def test_upsert_guard(spark):
    base = spark.createDataFrame([(1, "o", "p"), (2, "o", "q")], "k int, v string, parser string")
    new = spark.createDataFrame([(1, "n"), (2, "n")], "k int, v string")
    got = keys.upsert(base, new, "k", ["v"], F.col("parser") == "p")
    assert rows(got) == [(1, "n", "p"), (2, "o", "q")]
    assert rows(keys.upsert(got, new, "k", ["v"], F.col("parser") == "p")) == rows(got)


def test_status(spark):
    keep = spark.createDataFrame([("1",), ("2",), ("3",)], "recid string")
    got = spark.createDataFrame([("1", 2), ("2", 3)], "recid string, n_calc_units int")
    calcs = spark.createDataFrame([("s:1:a", ["f"] * 10), ("s:2:b", ["f"] * 5)], "calc_id string, frame_ids array<string>")
    rej = spark.createDataFrame([("parse", "s:1:x")], "stage string, id string")
    r = report.status(keep, keep, got, calcs, rej).first()
    assert (r.fetch_percent, r.calcs, r.units, r.frames, r.untouched) == (66.7, 2, 5, 15, 1)


def test_torn_manifest(spark, tmp_path):
    from pyspark.sql.types import StructType

    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\n{"x": 2}\n{"x": ')
    lines = jsonl.positioned(spark, [str(tmp_path / "a.jsonl")])
    schema = StructType.fromDDL("x int")
    assert sorted(r.x for r in jsonl.read_jsonl(lines, schema).collect()) == [1, 2]
    (tmp_path / "b.jsonl").write_text('{"x": 1}\n{"x": \n{"x": 2}\n')
    with pytest.raises(Exception, match="malformed line"):
        jsonl.read_jsonl(jsonl.positioned(spark, [str(tmp_path / "b.jsonl")]), schema).collect()


FRAME = '2\nLattice="1 0 0 0 1 0 0 0 1" calc_id=c frame_id=c#{0} ionic_step={0} REF_energy=-1.5\nH 0 0 0 1 1 1\nO 0 0 1 1 1 1\n'


def test_damaged_shards(spark, tmp_path):
    text = "".join(FRAME.format(i) for i in range(50)).encode()
    whole = gzip.compress(text)
    (tmp_path / "shard-00000.extxyz.gz").write_bytes(whole)
    (tmp_path / "shard-00001.extxyz.gz").write_bytes(whole[: len(whole) * 2 // 3])
    got = binary.frame_meta(binary.binary(spark, f"file://{tmp_path}")).collect()
    by = {s: [r for r in got if f"shard-0000{s}" in r.shard] for s in (0, 1)}
    assert len(by[0]) == 50 and not by[0][0].truncated and by[0][0].symbols == ["H", "O"]
    assert len(by[1]) < 50 and by[1][0].truncated
    f = binary.frames(binary.binary(spark, f"file://{tmp_path}", "*00000*")).where("ionic_step = 3").first()
    assert f.ref_energy == -1.5 and f.forces == [[1, 1, 1], [1, 1, 1]]


def test_zip_directory(spark, tmp_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a/OUTCAR", "x" * 1000)
        z.writestr("b.txt", "y")
    (tmp_path / "a.zip").write_bytes(buf.getvalue())
    (tmp_path / "bad.zip").write_bytes(b"nothing")
    got = binary.zip_directory(binary.binary(spark, f"file://{tmp_path}"))
    assert {r.name: (r.uncompressed_size, r.readable) for r in got.collect()} == {"a/OUTCAR": (1000, True), "b.txt": (1, True), None: (None, False)}
    assert binary.read_member(buf.getvalue(), "a/OUTCAR") == b"x" * 1000
    assert dataset.zip_plan(got.where("readable"), big=1).first().plan == "targeted"


def test_gzip_size(spark, tmp_path):
    (tmp_path / "x.gz").write_bytes(gzip.compress(b"a" * 70000))
    (tmp_path / "y.bz2").write_bytes(b"12345")
    (tmp_path / "z.gz").write_bytes(b"ab")
    got = {r[0].rsplit("/", 1)[1]: r[1] for r in binary.binary(spark, f"file://{tmp_path}").select("path", binary.gzip_size(F.col("path"), F.col("content"))).collect()}
    assert got == {"x.gz": 70000, "y.bz2": 5, "z.gz": 2}
    wrapped = spark.createDataFrame([("a.gz", 1 << 29, bytearray(b"\x01\x00\x00\x00")), ("a.gz", 1000, bytearray(b"\x01\x00\x00\x00"))], "p string, n long, t binary")
    assert [r[0] for r in wrapped.select(binary.expanded_size(F.col("p"), F.col("n"), F.col("t"))).collect()] == [1 << 32, 1000]


def test_windows_and_batches():
    hits = list(range(0, 1000, 7))
    count = lambda a, b: sum(a <= h < b for h in hits)
    got = list(search.windows(count, 0, 1000, most=20))
    assert got[0][0] == 0 and got[-1][1] == 1000 and all(x[1] == y[0] for x, y in zip(got, got[1:])) and all(count(a, b) <= 20 for a, b in got)
    assert search.batches([1, 1, 300 << 20, 1], most=2) == [0, 0, 1, 2]
    assert list(search.pages(lambda n, s: list(range(60))[(n - 1) * s : n * s])) == list(range(60))


def test_header_rewrite():
    assert binary.header_tokens('a=1 b="x y" flag c=') == {"a": "1", "b": "x y", "flag": "T", "c": ""}
    assert binary.rewrite_header('a=1 b="x y"', {"a": "2", "z": None, "n": "p q"}) == 'b="x y" a=2 n="p q"'


def test_purge(spark):
    u = spark.createDataFrame([("1", "a", {"v": "p", "i": "s"}), ("1", "b", {"v": "q", "i": "s"}), ("2", "c", {"v": "r"})], "recid string, calc_id string, files map<string,string>")
    done = spark.createDataFrame([("a",), ("c",)], "calc_id string")
    assert {r.recid: (r.action, r.free_files) for r in dataset.purge_plan(u, done).collect()} == {"1": ("partial", 1), "2": ("purge", 1)}


def test_streaming_failures(spark, tmp_path):
    from provlake.streaming import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id":"u","seq":1,"ok":false}\n{"id":"u","seq":2,"ok":false}\n{"id":"u","seq":3,"ok":false}\n{"id":"v","seq":1,"ok":false}\n{"id":"v","seq":2,"ok":true}\n')
    s = ingest.failure_counts(ingest.files(spark, str(tmp_path / "in"), "id string, seq int, ok boolean"))
    got = {}

    def sink(df, _):
        got.update({r.id: (r.failures, r.dead) for r in df.collect()})

    s.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert got == {"u": (3, True), "v": (0, False)}
