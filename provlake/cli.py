"""Commands: ``python -m provlake.cli COMMAND ...`` runs a query, a report or a maintenance step and prints its rows."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake import config, schemas


def session(master: str | None = None) -> SparkSession:
    b = SparkSession.builder.appName("provlake").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
    return (b.master(master) if master else b).getOrCreate()


def _rows(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Parquet folders as they are, anything else as JSON lines."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return (spark.read.schema(schema) if schema is not None else spark.read).json(path)


def render(df: DataFrame, most: int = 50) -> str:
    """Rows as a table of text, at most ``most``; a last line says if there are more."""
    rows = df.limit(most + 1).collect()
    cells = [df.columns, *[["" if v is None else str(v) for v in r] for r in rows[:most]]]
    wide = [max(len(r[i]) for r in cells) for i in range(len(df.columns))]
    lines = ["  ".join(v.ljust(w) for v, w in zip(r, wide)).rstrip() for r in cells]
    return "\n".join([*lines, "..."] if len(rows) > most else lines)


def status_block(row) -> str:
    """The status row as lines of name and number, with the percents in words."""
    from provlake.operators.report import LABELS

    got = row.asDict()
    return "\n".join(f"{label:<24}{'n/a' if got.get(name) is None else got[name]}" for name, label in LABELS.items() if name in got)


def queries(a, spark):
    from provlake.catalog import QUERIES

    return "\n".join(sorted(QUERIES))


def query(a, spark):
    from provlake.catalog import QUERIES

    return render(QUERIES[a.name](spark, a.tables), a.rows)


def normalise(a, spark):
    from provlake.functions.records import normalise_hit

    _rows(spark, a.source, schemas.HIT).select(normalise_hit(F.struct("*")).alias("c")).select("c.*").write.mode("overwrite").parquet(a.target)


def triage(a, spark):
    rows = spark.read.parquet(a.source)
    rows.where(F.col("listing.rank") >= a.least).write.mode("overwrite").parquet(a.target)


def split(a, spark):
    from provlake.operators.split import lpt

    rows = spark.read.parquet(a.source)
    weights = rows.groupBy(a.key).agg(F.sum(a.weight).alias("weight")) if a.weight else rows.groupBy(a.key).agg(F.count("*").alias("weight"))
    rows.join(lpt(weights, a.key, "weight", a.parts).select(a.key, "part"), a.key).write.mode("overwrite").partitionBy("part").parquet(a.target)


def census(a, spark):
    from provlake.operators.aggregate import census as counts

    row, kinds = counts(spark.read.parquet(a.source), a.record, a.size, a.name)
    return render(row) + "\n\n" + render(kinds.orderBy("ext"))


def verify(a, spark):
    from provlake.operators.dataset import integrity

    meta, stored = spark.read.parquet(a.meta).select(F.explode("frame_ids").alias("frame_id")), spark.read.parquet(a.frames).select("frame_id")
    return render(integrity(meta, stored, "frame_id", a.truncated))


def stats(a, spark):
    from provlake.operators.aggregate import dataset_stats

    return render(dataset_stats(spark.read.parquet(a.meta)).orderBy("key", F.desc("frames"), "value"), 500)


def audit(a, spark):
    from provlake.operators.report import audit as rows

    return render(rows(spark.read.parquet(a.units), spark.read.parquet(a.meta), _rows(spark, a.rejections, schemas.REJECTION)).orderBy("recid"), a.rows)


def status(a, spark):
    from provlake.operators.report import status as row

    t = lambda p: spark.read.parquet(p)
    return status_block(row(t(a.candidates), t(a.keep), t(a.fetched), t(a.meta), _rows(spark, a.rejections, schemas.REJECTION)).first())


def reasons(a, spark):
    from provlake.operators.fetch import top_reasons

    return render(top_reasons(_rows(spark, a.rejections, schemas.REJECTION), a.rows))


def enrich(a, spark):
    from provlake.operators.dataset import enrich as add
    from provlake.plans import snapshots

    with snapshots.Lock(spark, a.dataset):
        return snapshots.commit(add(snapshots.read(spark, a.dataset)), a.dataset)


def merge(a, spark):
    from provlake.operators.dataset import merge_problems, merge_shards
    from provlake.plans import snapshots

    into, sources = snapshots.read(spark, a.into), [snapshots.read(spark, s) for s in a.sources]
    bad = merge_problems(into, sources, spark.read.parquet(a.stored))
    if bad.limit(1).count():
        return "refused\n" + render(bad)
    with snapshots.Lock(spark, a.into):
        rows, names = merge_shards(into, sources)
        names.write.mode("overwrite").parquet(f"{a.into.rstrip('/')}/_renumbered")
        return snapshots.commit(rows, a.into)


def prune(a, spark):
    from provlake.operators.dataset import prune_uncommitted

    prune_uncommitted(spark.read.parquet(a.frames), spark.read.parquet(a.meta)).write.mode("overwrite").parquet(a.target)


def purge(a, spark):
    from provlake.operators.dataset import purge_plan

    return render(purge_plan(spark.read.parquet(a.units), spark.read.parquet(a.meta)).orderBy("recid"), a.rows)


def usage(a, spark):
    from provlake.operators.report import usage as sums

    return render(sums(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(a.folder).select("path", "length")))


def extract(a, spark):
    from provlake.sources import archives, binary

    archives.extract(binary.binary(spark, a.folder), a.cap).write.mode("overwrite").parquet(a.target)


def parse(a, spark):
    from provlake.sources.units import parse_units

    parse_units(spark.read.parquet(a.units), a.most_bytes, a.seconds).write.mode("append").parquet(a.target)


def smoke(a, spark):
    from provlake.plans.smoke import report, run

    got = run(spark)
    print(report(got))
    return 0 if all(ok for _, ok, _ in got) else 1


COMMANDS = {
    "queries": (queries, {}), "query": (query, {"name": {}, "tables": {}, "--rows": {"type": int, "default": 50}}), "normalise": (normalise, {"source": {}, "target": {}}),
    "triage": (triage, {"source": {}, "target": {}, "--least": {"type": int, "default": 3}}), "split": (split, {"source": {}, "target": {}, "key": {}, "--weight": {}, "--parts": {"type": int, "default": 8}}),
    "census": (census, {"source": {}, "--record": {"default": "recid"}, "--size": {"default": "size"}, "--name": {"default": "key"}}), "verify": (verify, {"meta": {}, "frames": {}, "--truncated": {"type": int, "default": 0}}),
    "stats": (stats, {"meta": {}}), "audit": (audit, {"units": {}, "meta": {}, "rejections": {}, "--rows": {"type": int, "default": 50}}), "status": (status, {"candidates": {}, "keep": {}, "fetched": {}, "meta": {}, "rejections": {}}),
    "reasons": (reasons, {"rejections": {}, "--rows": {"type": int, "default": 8}}), "enrich": (enrich, {"dataset": {}}), "merge": (merge, {"into": {}, "stored": {}, "sources": {"nargs": "+"}}), "prune": (prune, {"meta": {}, "frames": {}, "target": {}}),
    "purge": (purge, {"units": {}, "meta": {}, "--rows": {"type": int, "default": 50}}), "usage": (usage, {"folder": {}}), "extract": (extract, {"folder": {}, "target": {}, "--cap": {"type": int}}),
    "parse": (parse, {"units": {}, "target": {}, "--most-bytes": {"type": int, "default": 0}, "--seconds": {"type": float}}), "smoke": (smoke, {}),
}


def arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="provlake", description=__doc__)
    top.add_argument("--settings", default=".env", help="file of NAME=value lines")
    top.add_argument("--master", help="Spark master; the session's own by default")
    sub = top.add_subparsers(dest="command", required=True)
    for name, (f, options) in COMMANDS.items():
        p = sub.add_parser(name)
        for option, how in options.items():
            p.add_argument(option, **how)
        p.set_defaults(run=f)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = arguments().parse_args(argv)
    values = config.settings(a.settings)
    got = a.run(a, spark or session(a.master or values.get("PROVLAKE_MASTER")))
    if isinstance(got, int):
        return got
    if got is not None:
        print(got)
    return 0


if __name__ == "__main__":
    sys.exit(main())
