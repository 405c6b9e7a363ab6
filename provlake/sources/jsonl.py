"""JSON Lines: tolerant scan, positions, sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import types as T
from pyspark.sql import functions as F


def positioned(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, line_no, value) of each non-blank line, from any file system that Spark reads.

    A split's place in its file and the order of rows within the split give the order of lines; numbering them is one
    window per file.
    """
    text = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_i"))
    n = (F.row_number().over(W.partitionBy("file").orderBy("_at", "_i")) - 1).cast("long")
    return text.withColumn("line_no", n).where(F.trim("value") != "").select("file", "line_no", "value")


def read_jsonl(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of positioned lines; a malformed last line of a file is dropped, an earlier one is an error.

    Whether a line is the last comes from one maximum per file, so files are never held whole.
    """
    kept = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    last = lines.groupBy("file").agg(F.max("line_no").alias("_last"))
    got = lines.withColumn("_r", F.from_json("value", kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})).join(F.broadcast(last), "file")
    bad = F.col("_r").isNull() | F.col("_r._bad").isNotNull()
    checked = got.where(~(bad & (F.col("line_no") == F.col("_last"))))
    ok = F.when(bad, F.raise_error(F.concat(F.lit("malformed line "), F.col("line_no").cast("string"), F.lit(" of "), F.col("file")))).otherwise(F.col("_r"))
    return checked.select("file", "line_no", ok.alias("_r")).select("file", "line_no", *[F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields])


def read_manifests(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.jsonl", exclude: str = "checkpoint") -> DataFrame:
    """All manifests below a folder but checkpoints; for any file system."""
    df = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).json(folder)
    return df.where(~F.col("_metadata.file_name").contains(exclude))


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def write_rejections(rejected: DataFrame, path: str) -> None:
    """Rejection rows (stage, id, reason and open detail) are only ever added."""
    rejected.write.mode("append").json(path)


def write_metadata(df: DataFrame, path: str) -> None:
    """Metadata rows are only ever added; nulls stay written, so rows keep one shape."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)
