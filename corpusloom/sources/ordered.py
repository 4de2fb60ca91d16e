"""Rows of files with their place in the input, so that first and last wins mean what they say.

A scan gives its splits to tasks in any order, so a row's place is made of what
the row itself knows: its file, the split of the file it came from and its
number within that. Only a row for each split is added up, within its file,
and one for each file over all files. The files count in the order of their names.

The scan runs twice, for the counts and for the rows, and is split alike both
times, as the files and the session's settings are the same. Files must not
change in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusloom.session import stage_table


def in_order(scan: DataFrame, seq: str = "seq", file: str = "file", row: str = "row") -> DataFrame:
    """A file scan's rows with ``file``, ``row`` (place in the file, from 0) and ``seq`` (place in the whole input)."""
    names = scan.columns
    split = scan.select(*[F.col(c).alias(f"c{k}_") for k, c in enumerate(names)], F.col("_metadata.file_path").alias("file_"), F.col("_metadata.file_block_start").alias("from_"), F.monotonically_increasing_id().alias("at_"))
    runs = split.groupBy("file_", "from_").agg(F.min("at_").alias("first_"), F.count("*").alias("m_"))
    before = lambda w: F.coalesce(F.sum("m_").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = stage_table(runs.withColumn("skip_", before(Window.partitionBy("file_").orderBy("from_"))), "input-splits")
    files = runs.groupBy("file_").agg(F.sum("m_").alias("m_")).select("file_", before(Window.partitionBy(F.lit(0)).orderBy("file_")).alias("offset_"))
    runs = stage_table(runs.join(files, "file_").select("file_", "from_", "first_", "skip_", "offset_"), "input-offsets")
    place = F.col("at_") - F.col("first_") + F.col("skip_")
    return split.join(runs, ["file_", "from_"]).select(*[F.col(f"c{k}_").alias(c) for k, c in enumerate(names)], F.col("file_").alias(file), place.alias(row), (place + F.col("offset_")).alias(seq))


def read_ordered(spark: SparkSession, path: str, form: str = "json", schema: str | None = None, **options: str) -> DataFrame:
    """``in_order`` of files of a format that splits by bytes or row groups (JSON lines, CSV, text, Parquet)."""
    reader = spark.read.format(form).options(**options)
    return in_order((reader.schema(schema) if schema else reader).load(path))
