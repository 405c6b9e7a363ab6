"""Electronic traces of output lines: steps, last changes, gaps, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_STEP = r"Iteration\s+(\d+)\(\s*(\d+)\s*\)"
_CHANGE = r"total energy-change \(2\. order\)\s*:\s*([-+0-9.Ee]+)"


def gap_fill(df: DataFrame, group: str, step: str, fill: dict[str, Column] | None = None) -> DataFrame:
    """Every step from 1 to a group's largest; steps that were missing have nulls, or ``fill``."""
    tops = df.groupBy(group).agg(F.max(step).alias("_top"))
    dense = tops.select(group, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_top").cast("long"))).alias(step))
    out = dense.join(df.withColumn(step, F.col(step).cast("long")), [group, step], "left")
    return out.withColumns({c: F.coalesce(F.col(c), v) for c, v in (fill or {}).items()})


def trace(lines: DataFrame, file: str = "file", position: str = "line_no", value: str = "value") -> DataFrame:
    """(file, ionic_step from 0, n_esteps, scf_de): the markers of each output and the size of a step's last energy change.

    Only marker and change lines meet the window that carries a step's number down to its changes.
    """
    v = F.col(value)
    marks = lines.select(file, position, F.regexp_extract(v, _STEP, 1).try_cast("int").alias("i"), F.regexp_extract(v, _STEP, 2).try_cast("int").alias("e"), F.regexp_extract(v, _CHANGE, 1).alias("c"))
    marks = marks.where("i is not null or c <> ''")
    up = W.partitionBy(file).orderBy(position).rowsBetween(W.unboundedPreceding, 0)
    at = marks.withColumn("step", F.last("i", ignorenulls=True).over(up)).where("step is not null")
    change = F.when(F.col("i").isNull(), F.col("c").try_cast("double"))
    per = at.groupBy(file, "step").agg(F.max("e").alias("n_esteps"), F.max_by(change, F.when(change.isNotNull(), F.col(position))).alias("last"))
    full = gap_fill(per, file, "step", {"n_esteps": F.lit(0)})
    return full.select(file, (F.col("step") - 1).cast("int").alias("ionic_step"), "n_esteps", F.abs("last").alias("scf_de"))


def verdicts(steps: DataFrame, limit: Column) -> DataFrame:
    """Adds ``electronic_converged``: fewer electronic steps than ``limit``; null without steps or without a limit."""
    return steps.withColumn("electronic_converged", F.when((F.col("n_esteps") > 0) & (limit > 0), F.col("n_esteps") < limit))


def final_verdict(energies: Column, converged: Column) -> Column:
    """struct(electronic_converged, scf_de) of a calculation's last step: null, never true, if no electronic step is known."""
    n = F.size(energies)
    return F.struct(F.when(n > 0, converged).alias("electronic_converged"), F.when(n >= 2, F.abs(F.get(energies, n - 1) - F.get(energies, n - 2))).alias("scf_de"))
