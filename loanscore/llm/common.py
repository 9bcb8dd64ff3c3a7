"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscore.session import delete_on_exit, delete_path, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """The column's text; null counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


class Written:
    """A frame written once to the shared checkpoint folder and read back.

    Later steps restart from the written files, so a lost executor costs only
    its own tasks, and everything that was not deterministic in the frame is
    fixed by the write. ``drop()`` deletes the files early; otherwise they go
    when the driver ends.
    """

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, name)
        df.write.option("compression", "zstd").parquet(self.path)
        delete_on_exit(self.spark, self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        delete_path(self.spark, self.path)


class Bucketed:
    """A frame written once to the shared checkpoint folder, dealt by one column, and read back.

    The table has as many buckets as ``spark.sql.shuffle.partitions``, so joins
    on the column move only the other side. Its catalog entry goes at once;
    the files go when the driver ends.
    """

    def __init__(self, df: DataFrame, name: str, column: str):
        spark = df.sparkSession
        path, entry = scratch_path(spark, name), f"{name}_{uuid.uuid4().hex}"
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = df.repartition(n, column).write.format("parquet").option("compression", "zstd").option("path", path)
        dealt.bucketBy(n, column).saveAsTable(entry)
        delete_on_exit(spark, path)
        self.df = spark.table(entry)
        spark.sql(f"DROP TABLE {entry}")


def with_results(df: DataFrame, carried: str, results: dict[str, Column]) -> DataFrame:
    """Columns packed in the struct ``carried``, then ``results``.

    An input column with the name of a result (in any case) gives way to it.
    """
    taken = {name.lower() for name in results}
    kept = [f.name for f in df.schema[carried].dataType.fields if f.name.lower() not in taken]
    return df.select(
        *[F.col(carried).getField(name).alias(name) for name in kept],
        *[column.alias(name) for name, column in results.items()],
    )


def packed(df: DataFrame) -> Column:
    """The whole input row as one struct, out of reach of an operator's own column names."""
    return F.struct(*[F.col(f"`{name.replace('`', '``')}`") for name in df.columns])


def byte_batches(texts: Iterable[str], limit: int) -> Iterator[list[str]]:
    """Lists of consecutive texts of about ``limit`` characters; a longer text stands alone."""
    batch: list[str] = []
    size = 0
    for text in texts:
        if batch and size + len(text) > limit:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += len(text)
    if batch:
        yield batch


def array_slices(array: pa.Array, limit: int) -> Iterator[pa.Array]:
    """Consecutive slices of a string or list array of about ``limit`` bytes or values; a longer entry stands alone."""
    count = pc.binary_length if pa.types.is_string(array.type) else pc.list_value_length
    lengths = count(array).fill_null(0).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, length in enumerate(lengths.tolist()):
        if i > start and size + length > limit:
            yield array.slice(start, i - start)
            start, size = i, 0
        size += length
    if start < len(array):
        yield array.slice(start)


def pair_slices(left: pa.Array, right: pa.Array, limit: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Slices of two equally long string arrays of about ``limit`` bytes together; a longer pair stands alone."""
    start = size = 0
    lengths = pc.add(*[pc.cast(pc.binary_length(side), pa.int64()).fill_null(0) for side in (left, right)])
    for i, length in enumerate(lengths.to_pylist()):
        if i > start and size + length > limit:
            yield left.slice(start, i - start), right.slice(start, i - start)
            start, size = i, 0
        size += length
    if start < len(left):
        yield left.slice(start), right.slice(start)


#: A-Z lower-cased, every other ASCII character that is no letter or digit a space.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
PIECE_BYTES = 4_000_000


def folded_words(text: str, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The text's words (runs of a-z, 0-9 and characters beyond ASCII, A-Z lower-cased) in lists of bounded size."""
    folded = text.encode("utf-8", "surrogatepass").translate(_FOLD)
    start = 0
    while len(folded) - start > size:
        cut = folded.find(b" ", start + size)
        if cut < 0:
            break
        yield folded[start:cut].split()
        start = cut
    yield folded[start:].split()
