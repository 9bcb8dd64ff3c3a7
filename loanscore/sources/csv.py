"""The raw application file: CSV with a header and the fixed raw schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscore.schema import RAW_FIELDS, raw_schema


def read_applications_csv(spark: SparkSession, path: str) -> DataFrame:
    """Permissive read: a field that does not parse as its type becomes null.

    The schema is explicit, so nothing is inferred and only the columns a
    query uses are parsed (CSV column pruning). Uncompressed CSV is split by
    byte range (``spark.sql.files.maxPartitionBytes``), so a large file is
    read by many tasks without any repartitioning.
    """
    return spark.read.schema(raw_schema()).option("header", True).option("mode", "PERMISSIVE").csv(path)


def write_applications_csv(df: DataFrame, path: str) -> str:
    """Write a frame holding some raw columns as a full-width raw CSV file set.

    Missing raw columns are written empty. Blanks around values are kept, so
    the file reads back exactly.
    """
    cols = []
    for name, typ in RAW_FIELDS:
        if name in df.columns:
            cols.append(F.col(name).cast(typ))
        else:
            cols.append(F.lit(None).cast(typ).alias(name))
    (
        df.select(*cols)
        .write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path
