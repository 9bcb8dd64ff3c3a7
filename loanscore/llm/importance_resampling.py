"""Importance resampling towards a target distribution, with corpus counts by distinct lines.

Features are all runs of 1 to ``NGRAM`` consecutive words of a text (runs of
a-z, 0-9 and characters beyond ASCII, A-Z lower-cased), joined by one space;
a feature's bucket is the CRC-32 of its UTF-8 bytes modulo ``BUCKETS``.

Corpus counts by segments. A newline separates words, so it cuts a text into
lines without cutting a word. Equal lines are one row with their number of
occurrences (counted before the shuffle, so a line that stands in a third of
all rows is one row of each task), their features are counted once and
multiplied by it. Runs that cross a newline belong to no line; where runs may
be longer than one word they are counted from the texts and added. What
travels after that is one count for each bucket and task.

Weights. A bucket's gain is floor(1000 * ln of the ratio of its smoothed
share of the target to its share of the corpus); a document's weight is the
floored mean gain over its features. The gains are a table of ``BUCKETS``
numbers, which travels with the tasks that read each text once.

Drawing without replacement. floor(-1000 * ln(-ln u)) (Gumbel noise) is added
to the weight, with u from a hash of the seed and the document id, and the
highest scores are drawn. Ranks are exact and global, but no task orders all
rows: scores are dealt out by ranges, numbered within their range, and
shifted by the rows of the ranges before.

Defined results: null and empty texts have no features and weight 0; texts of
fewer than ``MIN_WORDS`` words are never drawn; a null id is hashed as the
empty text and ranks behind the others of its score; rows that agree in id
and score are ordered in an unspecified way, each with its own rank. An empty
target or corpus counts as zero features. An empty table gives an empty
result. Other columns pass through and give way to results of their name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanscore.llm.common import Written, array_slices, folded_words, packed, text_of, with_results

NGRAM = 1
BUCKETS = 10_000
MIN_WORDS = 20
SHARE = 10  # percent of the documents with enough words that are drawn
SEED = 2024
BATCH_BYTES = 4_000_000  # of text: what one step of a task holds, but for a longer text
KNOWN_WORDS = 200_000  # buckets of single words that a task remembers at once
INDEX_BITS = 33  # of a row's number within its partition in monotonically_increasing_id


class WordBuckets(dict):
    """Buckets of single words, remembered once found."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        self[word] = bucket = zlib.crc32(word) % self.buckets
        return bucket

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > KNOWN_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def run_buckets(words: list[bytes], size: int, buckets: int) -> np.ndarray:
    """The buckets of all runs of ``size`` words."""
    runs = zip(*[words[i:] for i in range(size)])
    return np.fromiter((zlib.crc32(b" ".join(run)) % buckets for run in runs), np.int64, max(0, len(words) - size + 1))


def line_features(text: str, ngram: int, known: WordBuckets) -> Iterator[np.ndarray]:
    """The buckets of all runs of up to ``ngram`` words of ``text``, in pieces of bounded size."""
    tail: list[bytes] = []
    for words in folded_words(text, 1_000_000):
        yield known.of(words)
        for size in range(2, ngram + 1):
            yield run_buckets(tail[len(tail) - min(len(tail), size - 1) :] + words, size, known.buckets)
        tail = (tail + words)[-(ngram - 1) :] if ngram > 1 else []


def crossing_features(text: str, ngram: int, buckets: int) -> Iterator[int]:
    """The buckets of the runs of 2 to ``ngram`` words that hold a newline."""
    before: list[tuple[bytes, int]] = []  # the last ngram - 1 words and their lines
    for number, line in enumerate(text.split("\n")):
        words = [w for piece in folded_words(line) for w in piece]
        around = before + [(word, number) for word in words[: ngram - 1]]
        for end in range(len(before), len(around)):
            for size in range(2, min(ngram, end + 1) + 1):
                run = around[end - size + 1 : end + 1]
                if run[0][1] != run[-1][1]:
                    yield zlib.crc32(b" ".join(word for word, _ in run)) % buckets
        before = (before + [(word, number) for word in words[-(ngram - 1) :]])[-(ngram - 1) :]


def _task_counts(total: np.ndarray) -> pa.RecordBatch:
    used = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])


def _line_counts(ngram: int, buckets: int):
    """A mapInArrow function: counts by bucket of one task's distinct lines (line, occurrences)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(buckets, np.int64), WordBuckets(buckets)
        for batch in batches:
            for line, times in zip(batch.column(0), batch.column(1).to_pylist()):
                for found in line_features(line.as_py(), ngram, known):
                    np.add.at(total, found, times)
        yield _task_counts(total)

    return run


def _crossing_counts(ngram: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for bucket in crossing_features(text.as_py(), ngram, buckets):
                    total[bucket] += 1
        yield _task_counts(total)

    return run


def feature_counts(texts: DataFrame, text: str = "text", ngram: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts are in each bucket that has any."""
    whole = texts.select(text_of(text).alias("text"))
    lines = whole.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''").groupBy("line").agg(F.count(F.lit(1)).alias("times"))
    parts = lines.mapInArrow(_line_counts(ngram, buckets), "bucket int, n long")
    if ngram > 1:
        parts = parts.union(whole.mapInArrow(_crossing_counts(ngram, buckets), "bucket int, n long"))
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Each bucket's gain from the counts (bucket, n) of corpus and target."""
    both = corpus.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).union(
        target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    )
    counts = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).toArrow()  # one row a bucket
    source, wanted = np.zeros(buckets), np.zeros(buckets)
    source[counts["bucket"].to_numpy()], wanted[counts["bucket"].to_numpy()] = counts["s"].to_numpy(), counts["t"].to_numpy()
    ratio = ((wanted + 1) * (source.sum() + buckets)) / ((source + 1) * (wanted.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64).tolist()


def _weigher(gains: list[int], ngram: int):
    """A Spark function text -> (words, features, floored mean gain)."""
    buckets = len(gains)

    @F.arrow_udf("struct<n_words:long,n_features:long,weight:long>")
    def weighed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        gain, known = np.array(gains, dtype=np.int64), WordBuckets(buckets)
        for batch in (part for whole in batches for part in array_slices(whole, BATCH_BYTES)):
            found = []
            for text in batch:
                n_words = n_features = total = 0
                for turn, part in enumerate(line_features(text.as_py(), ngram, known)):
                    n_words += 0 if turn % ngram else len(part)
                    n_features += len(part)
                    total += int(gain[part].sum())
                found.append((n_words, n_features, total // n_features if n_features else 0))
            columns = zip(*found) if found else ([], [], [])
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["n_words", "n_features", "weight"])

    return weighed


def gumbel(seed: int, id_: Column) -> Column:
    """floor(-1000 * ln(-ln u)), u from the first 32 bits of sha256("seed:id")."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def ranked(rows: DataFrame, order: list[Column]) -> tuple[DataFrame, Written]:
    """``rows`` with their place (from 1) by ``order`` in the column ``place``, and the table behind them.

    The order must not tie for large numbers of rows: ranges are cut between
    different keys.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    stored = Written(dealt, "ranges")
    part = F.shiftright("at", INDEX_BITS)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    counts = stored.df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    offsets = counts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    numbered = stored.df.withColumn("part", part).join(offsets, "part")
    place = F.col("offset") + F.col("at").bitwiseAND(F.lit((1 << INDEX_BITS) - 1)) + 1
    return numbered.withColumn("place", place).drop("part", "offset", "at"), stored


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    ngram: int = NGRAM,
    buckets: int = BUCKETS,
    share: int = SHARE,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row of ``docs`` (its columns, or those in ``carry``) with n_words, n_features, weight, score and rank.

    ``rank`` numbers the drawn rows from the highest score; it is null for the others.
    """
    carried = docs if carry is None else docs.select(*carry)
    gains = bucket_gains(feature_counts(docs, text, ngram, buckets), feature_counts(target, target_text, ngram, buckets), buckets)
    rows = docs.select(packed(carried).alias("row"), F.col(id_column).alias("id"), text_of(text).alias("text"))
    weighed = rows.select("row", "id", _weigher(gains, ngram)("text").alias("w")).select("row", "id", "w.*")
    scored = weighed.select(
        "*",
        (F.col("weight") + gumbel(seed, F.col("id"))).alias("score"),
        (F.col("n_words") >= min_words).alias("enough"),
        F.monotonically_increasing_id().alias("uid"),
    )
    # Ranges are found by a sample of the keys, so the texts are weighed once and written first.
    placed, stored = ranked(Written(scored, "scored").df, [F.desc("enough"), F.desc("score"), F.asc_nulls_last("id"), F.asc("uid")])
    drawn = stored.df.where("enough").count() * share // 100
    results = {name: F.col(name) for name in ("n_words", "n_features", "weight", "score")}
    return with_results(placed, "row", results | {"rank": F.when(F.col("enough") & (F.col("place") <= drawn), F.col("place"))})
