"""CSV sinks for cleaned subjects and the points table.

Writes are distributed: each task writes its own part file and the commit
protocol makes the folder appear whole or not at all, so a lost executor
only re-runs its tasks. A single output file is available on request
(``single_file=True``): the rows are cleaned in parallel and then written by
one task, which should only be used for small outputs.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def save_table(df: DataFrame, path: str, single_file: bool = False, fmt: str = "csv") -> str:
    out = df.repartition(1) if single_file else df
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def save_subject(df: DataFrame, base_path: str, subject: str, single_file: bool = False, fmt: str = "csv") -> str:
    """One folder per subject under ``base_path`` (Personal, Payment, ...)."""
    return save_table(df, os.path.join(base_path, subject), single_file, fmt)


def save_points(df: DataFrame, path: str, single_file: bool = False, fmt: str = "csv") -> str:
    return save_table(df, path, single_file, fmt)


def read_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv") -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)
