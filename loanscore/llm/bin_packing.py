"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups (here: equal texts) are taken by falling size and enter the bin with
the tightest remaining capacity that still holds them; bins are kept in a
balanced search tree by remaining capacity. The capacity is the smallest one
(to one part in ``TOLERANCE``) for which no more than the wanted number of
shards is needed, so shards come out nearly equal in bytes. A group larger than
an even share of what it and smaller ones hold (an oversized group) cannot be
made even by any packing: it gets a shard of its own and leaves the search, and
the others share the remaining shards evenly.

At scale the same packing is done on two levels. With unit = bytes of the
groups that are not oversized / (their shards * ``UNITS``), at most shards * UNITS
of them are as large as a unit; they and the oversized ones stay single. Smaller groups are packed best-fit-decreasing into pallets
of one unit inside Spark tasks, which leaves at most 2 * shards * UNITS
pallets and one more for each task. Only these bounded lists (large groups
and pallets, with their sizes) reach the driver, where they are packed into
the shards. No task sees a group's rows, only its size; rows are joined to
their group's shard afterwards, where Spark can split a hot group.

Slots: rows of a shard are spread over buckets of about ``BUCKET_ROWS``,
numbered inside each bucket and shifted by the rows of the buckets before it,
so no task numbers a whole shard.

Defined results: a null text is empty and equal to an empty text; repeated rows each
get a slot; with fewer groups than shards some shards stay empty; an empty
table gives an empty result. Other columns pass through and give way to
results of their name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanscore.llm.common import Written, packed, text_of, with_results

UNITS = 256
TOLERANCE = 2000  # the capacity is searched to this part of itself
BUCKET_ROWS = 4096


class CapacityTree:
    """A balanced search tree (treap) of (remaining capacity, bin)."""

    def __init__(self) -> None:
        self.root: list | None = None  # [key, priority, left, right]

    def add(self, remaining: int, bin_: int) -> None:
        key = (remaining, bin_)
        priority = hashlib.blake2b(b"%d/%d" % key, digest_size=8).digest()
        low, high = self._split(self.root, key)
        self.root = self._merge(self._merge(low, [key, priority, None, None]), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the bin with the least remaining capacity of at least ``size``."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        node = high
        while node[2] is not None:
            node = node[2]
        key = node[0]
        _, rest = self._split(high, (key[0], key[1] + 1))
        self.root = self._merge(low, rest)
        return key

    @classmethod
    def _split(cls, node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], high = cls._split(node[3], key)
            return node, high
        low, node[2] = cls._split(node[2], key)
        return low, node

    @classmethod
    def _merge(cls, low: list | None, high: list | None) -> list | None:
        if low is None or high is None:
            return low if high is None else high
        if low[1] > high[1]:
            low[3] = cls._merge(low[3], high)
            return low
        high[2] = cls._merge(low, high[2])
        return high


class Packer:
    """Best fit into bins of one capacity; sizes are to come in falling order."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.tree = capacity, 0, CapacityTree()

    def put(self, size: int) -> int:
        """The bin for the next group; one larger than the capacity gets a bin of its own."""
        found = self.tree.take_tightest(size)
        if found is None:
            found = (max(self.capacity, size), self.bins)
            self.bins += 1
        remaining, bin_ = found
        if remaining > size:
            self.tree.add(remaining - size, bin_)
        return bin_


def oversized(sizes: list[int], total: int, bins: int) -> int:
    """How many of the largest groups (sizes falling, ``total`` of all) are each above an even share of what they leave."""
    own = 0
    while own < min(bins - 1, len(sizes)) and sizes[own] * (bins - own) > total:
        total -= sizes[own]
        own += 1
    return own


def pack(sizes: list[int], bins: int) -> list[int]:
    """The bin (from 0) of each size, sizes falling.

    Oversized groups get a bin of their own and leave the search; the others
    share the remaining bins at about the least capacity that needs no more.
    """
    own = oversized(sizes, sum(sizes), bins)
    return [*range(own), *[own + bin_ for bin_ in _pack_evenly(sizes[own:], bins - own)]]


def _pack_evenly(sizes: list[int], bins: int) -> list[int]:

    def packed_with(capacity: int) -> tuple[list[int], int]:
        packer = Packer(capacity)
        return [packer.put(size) for size in sizes], packer.bins

    total = sum(sizes)
    low = max(-(-total // bins), max(sizes, default=0))
    high = max(low, 2 * low)
    best, used = packed_with(high)
    while used > bins:  # cannot happen at twice the least, kept for certainty
        high *= 2
        best, used = packed_with(high)
    while high - low > low // TOLERANCE:
        middle = (low + high) // 2
        tried, used = packed_with(middle)
        if used <= bins:
            best, high = tried, middle
        else:
            low = middle + 1
    return best


def _pallets(unit: int):
    """Packs a task's groups (key, size), by falling size, into pallets of one unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = Packer(unit)
        base = TaskContext.get().partitionId() << 32
        for batch in batches:
            bins = [base + packer.put(size) for size in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bins, pa.int64())], names=["key", "size", "item"])

    return run


def group_shards(groups: DataFrame, shards: int) -> DataFrame:
    """(key, shard) for the groups (key, size); sizes are at least 1."""
    spark = groups.sparkSession
    total = groups.agg(F.sum("size")).first()[0] or 0
    largest = [r.size for r in groups.orderBy(F.desc("size")).select("size").limit(shards).toLocalIterator()]
    own = oversized(largest, total, shards)
    unit = max(1, (total - sum(largest[:own])) // ((shards - own) * UNITS))
    light = groups.where(F.col("size") < unit).sortWithinPartitions(F.desc("size"), "key")
    pallets = Written(light.mapInArrow(_pallets(unit), "key binary, size long, item long"), "pallets").df
    heavy = Written(groups.where(F.col("size") >= unit).select("key", "size"), "heavy").df
    # Bounded lists: at most 2 * shards * UNITS + tasks pallets, at most shards * UNITS groups.
    items = [(r.size, None, r.item) for r in pallets.groupBy("item").agg(F.sum("size").alias("size")).toLocalIterator()]
    items += [(r.size, bytes(r.key), None) for r in heavy.select("size", "key").toLocalIterator()]
    items.sort(key=lambda x: (-x[0], x[1] or b"", x[2] or 0))
    bins = pack([size for size, _, _ in items], shards)
    placed = [(key, item, bin_) for (_, key, item), bin_ in zip(items, bins)]
    by_item = spark.createDataFrame([(i, b) for k, i, b in placed if k is None], "item long, shard int")
    by_key = spark.createDataFrame([(k, b) for k, i, b in placed if k is not None], "key binary, shard int")
    return pallets.join(by_item, "item").select("key", "shard").union(by_key)


def shard_documents(docs: DataFrame, shards: int = 16, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` (its columns, or those in ``carry``) with size, text_crc32, shard and slot.

    Rows of equal text share a shard.
    """
    carried = docs if carry is None else docs.select(*carry)
    rows = Written(
        docs.select(packed(carried).alias("row"), text_of(text).alias("text")).select(
            "row",
            (F.octet_length("text").cast("long") + 1).alias("size"),
            F.crc32("text").alias("crc"),
            F.unhex(F.sha2("text", 256)).alias("key"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "shard_rows",
    ).df
    groups = Written(rows.groupBy("key").agg(F.sum("size").alias("size")), "groups").df
    assigned = Written(group_shards(groups.repartition("key"), shards), "assigned").df
    buckets = max(1, rows.count() // (shards * BUCKET_ROWS))
    placed = Written(
        rows.join(assigned, "key").select(
            "row", "size", "crc", "shard", "uid", F.pmod(F.xxhash64("uid"), F.lit(buckets)).cast("int").alias("bucket")
        ),
        "placed",
    ).df
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "bucket").count().select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    )
    within = Window.partitionBy("shard", "bucket").orderBy("uid")
    numbered = placed.withColumn("n", F.row_number().over(within)).join(offsets, ["shard", "bucket"])
    return with_results(
        numbered,
        "row",
        {
            "size": F.col("size"),
            "text_crc32": F.col("crc"),
            "shard": F.col("shard"),
            "slot": F.col("offset") + F.col("n") - 1,
        },
    )
