"""Quality classifier: supervised subword embeddings trained by numpy stochastic gradient descent.

Features. A text's tokens are its runs of non-white-space bytes, as written.
Features are hashed into ``BUCKETS`` buckets: every token, every pair of
consecutive tokens, the byte n-grams of ``SUBWORDS`` lengths of each token
between a start and an end mark, and for each of the last ``BACK`` tokens that
a token repeats one feature of that distance, so that repetition is seen
whatever is repeated. All features are found by numpy over a whole text.

Model. Each bucket has a vector of ``DIM`` learned numbers. A document is the
mean of its features' vectors, and a softmax layer over the two labels gives
the score, the probability of label 1. As mean and layer are linear, the
trained model is stored as one number for each bucket and a bias.

Training. A bounded sample of the labelled documents, ``SAMPLE_ROWS`` of them
by a hash of their id and never a held-out one, is reduced to feature counts
by Spark tasks; the driver holds these counts (at most ``BUCKETS`` for each
row) and runs ``EPOCHS`` of stochastic gradient descent over single documents
in shuffled order at a falling rate. Sample, order and initial vectors are
fixed by hashes and ``SEED``.

Scoring reads every whole text once, with no shuffle; the model (``BUCKETS``
numbers) travels with the tasks.

Defined results: a null text is empty; an empty or blank text has the bias's
score. Labels that are null, of null ids or of ids without a document are not
learned from; of different labels of one id the smaller counts, and of
different texts of one id one (by hash) is learned from. A null id is hashed
as the empty text. Without labels, or with labels of one kind, the score is
that kind's smoothed share. Scores are row by row, so repeated rows agree. An
empty table gives an empty result. Other columns pass through and give way to
results of their name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscore.llm.common import Written, array_slices, packed, text_of, with_results

BITS = 16
BUCKETS = 1 << BITS
DIM = 12
SUBWORDS = (3, 4)
BACK = 3
SAMPLE_ROWS = 2000
EPOCHS = 5
RATE = 0.5
SEED = 13
THRESHOLD = 0.7
FOLDS = 4
HELD_OUT = 2  # the fold that is never learned from
BATCH_BYTES = 4_000_000  # of text: what one step of a task holds
PIECE_BYTES = 1_000_000  # of a text whose features are found at once

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_FACTOR = _U(0xD6E8FEB86659FD93)
_START, _END = 2, 3  # bytes that no token holds (both count as white space here)
_BLANK = np.array([b <= 0x20 for b in range(256)])


def _spread(x: np.ndarray, kind: int) -> np.ndarray:
    """Buckets of 64-bit values, another hash function for each kind of feature."""
    x = (x ^ _U(kind << 40)) * _FACTOR
    return ((x ^ (x >> _U(32))) * _BASE >> _U(64 - BITS)).astype(np.int64)


def features(data: bytes) -> np.ndarray:
    """The buckets of all features of a piece of text (UTF-8)."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~_BLANK[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.int64)
    lengths = stops - starts
    # The tokens one after the other, each with a mark in front and one behind.
    opens = np.cumsum(lengths + 2) - lengths - 2
    marked = np.empty(int(lengths.sum()) + 2 * len(lengths), np.uint64)
    body = np.ones(len(marked), bool)
    body[opens] = body[opens + lengths + 1] = False
    marked[body] = raw[inside[1:-1]]
    marked[opens], marked[opens + lengths + 1] = _START, _END
    token_of = np.repeat(np.arange(len(lengths)), lengths + 2)

    found = []
    for size in SUBWORDS:
        if len(marked) < size:
            continue
        grams = marked[: len(marked) - size + 1].copy()
        for i in range(1, size):
            grams = grams << _U(8) | marked[i : len(marked) - size + 1 + i]
        whole = token_of[: len(grams)] == token_of[size - 1 :]
        found.append(_spread(grams[whole], size))
    # Tokens by a polynomial of their bytes, summed within each token.
    place = np.arange(len(marked)) - np.repeat(opens, lengths + 2)
    powers = np.multiply.accumulate(np.full(int(lengths.max()) + 2, _BASE, np.uint64))
    tokens = np.add.reduceat((marked + _U(1)) * powers[place], opens)
    found.append(_spread(tokens, 100))
    found.append(_spread(tokens[:-1] * _FACTOR + tokens[1:], 101))
    for back in range(1, BACK + 1):
        again = np.count_nonzero(tokens[back:] == tokens[:-back])
        found.append(np.full(again, _spread(np.array([back], np.uint64), 102)[0]))
    return np.concatenate(found)


def pieces(text: str) -> Iterator[bytes]:
    """The text's bytes, cut at spaces into pieces of about ``PIECE_BYTES``."""
    data = text.encode("utf-8", "surrogatepass")
    start = 0
    while len(data) - start > PIECE_BYTES:
        cut = data.find(b" ", start + PIECE_BYTES)
        if cut < 0:
            break
        yield data[start:cut]
        start = cut
    yield data[start:]


@dataclass(frozen=True)
class Model:
    """A score is the logistic function of ``bias`` plus the mean of its features' weights."""

    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        total, n = 0.0, 0
        for piece in pieces(text):
            found = features(piece)
            total += float(self.weights[found].sum())
            n += len(found)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.bias + (total / n if n else 0.0)))))


def train(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """Fits vectors and layer on (buckets, shares of the text's features, label)."""
    ones = sum(label for _, _, label in examples)
    prior = math.log((ones + 1) / (len(examples) - ones + 1))
    if ones in (0, len(examples)):
        return Model(np.zeros(BUCKETS), prior)
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    layer, bias = np.zeros((DIM, 2)), np.array([0.0, prior])
    steps, step = EPOCHS * len(examples), 0
    for _ in range(EPOCHS):
        for at in rng.permutation(len(examples)):
            buckets, shares, label = examples[at]
            rate = RATE * (1 - step / steps)
            step += 1
            mean = shares @ vectors[buckets]
            logits = mean @ layer + bias
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[label] -= 1  # now the gradient of the loss by the logits
            back = layer @ chance
            layer -= rate * np.outer(mean, chance)
            bias -= rate * chance
            # A vector moves by its feature's share; the root keeps a long text's many small shares from learning nothing.
            vectors[buckets] -= rate * math.sqrt(len(buckets)) * np.outer(shares, back)
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def fold_of(id_: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_.cast("string"), F.lit(""))), F.lit(FOLDS))


def _counted():
    """A Spark function text -> its features' buckets and how often each occurs."""

    @F.arrow_udf("struct<buckets:array<int>,counts:array<long>>")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in (part for whole in batches for part in array_slices(whole, BATCH_BYTES)):
            buckets, counts = [], []
            for text in batch:
                total = np.zeros(BUCKETS, np.int64)
                for piece in pieces(text.as_py()):
                    total += np.bincount(features(piece), minlength=BUCKETS)
                used = np.flatnonzero(total)
                buckets.append(used.astype(np.int32))
                counts.append(total[used])
            yield pa.StructArray.from_arrays(
                [pa.array(buckets, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))], names=["buckets", "counts"]
            )

    return counted


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE_ROWS) -> Model:
    """The model learned from at most ``sample`` labelled documents outside the held-out fold."""
    marked = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isin(0, 1) & (fold_of(F.col("id")) != HELD_OUT)
    )
    order = [F.xxhash64("id", F.lit(SEED)), F.col("id")]
    chosen = marked.groupBy("id").agg(F.min("label").alias("label")).orderBy(*order).limit(sample)
    texts = docs.select(F.col(id_column).alias("id"), text_of(text).alias("text")).join(chosen, "id")
    made = texts.select("id", "label", F.xxhash64("text").alias("mark"), _counted()("text").alias("found"))
    one = Written(made.groupBy("id").agg(F.min_by(F.struct("label", "found"), "mark").alias("one")).select("id", "one.*"), "examples")
    examples = []
    for r in one.df.orderBy(*order).toLocalIterator():  # at most ``sample`` rows
        counts = np.array(r.found.counts, dtype=np.float64)
        if len(counts):
            examples.append((np.array(r.found.buckets, dtype=np.int64), counts / counts.sum(), r.label))
    one.drop()
    return train(examples)


def _scorer(model: Model):
    weights, bias = model.weights.astype(np.float64), model.bias

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(weights, bias)
        for batch in (part for whole in batches for part in array_slices(whole, BATCH_BYTES)):
            yield pa.array([own.score(text.as_py()) for text in batch], pa.float64())

    return score


def classify(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, carry: list[str] | None = None
) -> DataFrame:
    """Every row of ``docs`` (its columns, or those in ``carry``) with held_out, score and predicted."""
    carried = docs if carry is None else docs.select(*carry)
    rows = docs.select(
        packed(carried).alias("row"), (fold_of(F.col(id_column)) == HELD_OUT).alias("held_out"), text_of(text).alias("text")
    )
    scored = rows.select("row", "held_out", _scorer(model)("text").alias("score"))
    results = {"held_out": F.col("held_out"), "score": F.col("score"), "predicted": (F.col("score") >= threshold).cast("int")}
    return with_results(scored, "row", results)
