"""Near-duplicate classes by Order MinHash, verified by banded alignment.

Sketch. A text's words (runs of a-z, 0-9 and characters beyond ASCII, A-Z
lower-cased) form k-mers of ``KMER`` words, and each k-mer is labelled by how
often it occurred before, so repeats count. For each of ``SKETCHES`` hash
functions the ``SAMPLES`` smallest labelled k-mers are taken and put back into
text order; their hash is a bucket. Two texts share a bucket only if the same
k-mers are smallest in both and stand in the same order, which makes the
sketch sensitive to edit similarity and not just to the set of words. Texts of
up to ``SHORT_WORDS`` words have further sketches of k-mers of ``SHORT_KMER``
words, since a changed word leaves them few longer ones.

Word bins. Each text also has its words counted in bins (a byte each, about one
bin for every one or two words). From two texts' bins follows a least edit
distance, so bins rule pairs out before any text is fetched, and never one
that is similar enough.

Candidates. Texts with equal words are one node from the start. First, every
bucket's smallest node leads it, and each other node is tried with the leader it
shares most buckets with. In later rounds every class that a bucket still
holds sends one member, chosen by a hash that changes with the round, and
the heads of ``HEADS`` classes, chosen likewise, are its partners; each member is
tried with the ``HEADS`` new partners it shares most buckets with. Rounds go on
while more than one in ``PAYING`` of a round's pairs is a link; they only make the
classes of a bucket fewer. What is left is then tried completely. In a bucket of up to ``LARGE_BUCKET`` nodes that
still holds several classes, the bins of all nodes of different classes are
compared, in blocks of ``BLOCK_NODES`` nodes. The nodes of larger ones are first dealt
anew by their rarest words: of n words the floor(n * (1 - ``SIMILARITY``)) + 1 rarest
ones hold at least one word (labelled by occurrence) of every text that is
similar enough, so only nodes with such a word in common are compared, and a
passage that many texts share brings no two of them together by itself.
Nodes whose bucket holds no other class that word counts allow (with the place of the
bucket's word among the rarest) leave it.
Buckets of equal nodes are one bucket here. No bucket is capped.

Verification. A pair that its bins do not rule out is a link if the word edit
distance is at most (1 - ``SIMILARITY``) of the longer text, computed by a
bit-parallel alignment inside a diagonal band that is widened up to what this
distance allows. Word counts that rule the distance out are tried first.

Classes are the connected components of the links (``components``); a class
is named by its smallest document id.

Nothing but row counts and the ``RARITY`` word counters reaches the driver. Texts cross
the network once, into a table dealt by node; later steps fetch the few texts,
sketches and bins they need without moving the others. Tables between the steps are
written to the shared folder, and joins run between written tables, so hot
classes, buckets and leaders can be split.

Defined results: a null text is empty; texts without words are alike only if
they are equal; texts of fewer than ``KMER`` words are one k-mer. Repeated rows
are one class, of which one row is kept. A null id ranks behind all others. An
empty table gives an empty result. Other columns pass through and give way to
results of their name.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscore.llm.common import Bucketed, Written, array_slices, folded_words, packed, pair_slices, text_of, with_results
from loanscore.llm.components import connected_components

KMER = 3
SAMPLES = 2
SKETCHES = 48
SHORT_WORDS = 24  # texts of as many words at most have as many sketches of SHORT_KMER words besides
SHORT_KMER = 2
SIMILARITY = 0.8
HEADS = 4  # classes of a bucket that others may meet in a round, and new partners that one member meets
PAYING = 10  # a further round is worth it if more than one of so many pairs of the last was a link
LARGE_BUCKET = 512  # nodes of a larger bucket are dealt by their rarest words before they are compared
LENGTH_STEPS = 8  # of word counts, for the ratio that the similarity allows
BLOCK_NODES = 1024  # nodes that are compared with each other, or with as many others, at once
FEWEST_BINS, MOST_BINS = 256, 1 << 16  # of a text's words, by their hash
COARSE_BINS = 64  # that nodes of a block are compared by first
RARITY = 1 << 16  # counters of how many texts hold a word, by its hash
BATCH_BYTES = 4_000_000  # of text: what one step of a task holds, but for a longer text
BLOCK_KMERS = 8192  # k-mers hashed at once

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_MAX = _U(0xFFFFFFFFFFFFFFFF)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), kept between calls."""
    if len(_powers.get(name, ())) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name][:n]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word (a polynomial of its bytes, spread)."""
    if not words:
        return np.empty(0, np.uint64)
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    starts = np.concatenate([[0], ends[:-1]])
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * _power(_BASE, "up", len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_BASE_INVERSE, "down", len(data) + 1)[starts])


def labelled_kmers(hashes: np.ndarray, k: int = 5) -> np.ndarray:
    """Hashes of the k-mers in text order, each with the number of equal k-mers before it."""
    if not len(hashes):
        return hashes
    k = min(k, len(hashes))
    kmers = np.zeros(len(hashes) - k + 1, dtype=np.uint64)
    for t in range(k):
        kmers = kmers * _U(0x2545F4914F6CDD1D) + hashes[t : t + len(kmers)]
    kmers = mix(kmers)
    order = np.argsort(kmers, kind="stable")
    equal = np.concatenate([[False], kmers[order][1:] == kmers[order][:-1]])
    if not equal.any():
        return kmers
    at = np.arange(len(kmers))
    occurrence = np.empty(len(kmers), dtype=np.uint64)
    occurrence[order] = (at - np.maximum.accumulate(np.where(equal, 0, at))).astype(np.uint64)
    return np.where(occurrence > 0, mix(kmers + occurrence * _U(0xA24BAED4963EE407)), kmers)


def sketch(labels: np.ndarray, sketches: int = SKETCHES, samples: int = SAMPLES) -> np.ndarray:
    """The buckets of a text: for each hash function its smallest labels in text order, hashed."""
    if not len(labels):
        return np.empty(0, np.int64)
    number = np.arange(1, sketches + 1, dtype=np.uint64)
    salt, odd = mix(number), mix(number + _U(1 << 20)) | _U(1)
    samples = min(samples, len(labels))
    least = np.empty((sketches, 0), dtype=np.uint64)
    place = np.empty((sketches, 0), dtype=np.int64)
    rows = np.arange(sketches)
    for start in range(0, len(labels), BLOCK_KMERS):
        values = (labels[None, start : start + BLOCK_KMERS] ^ salt[:, None]) * odd[:, None]
        for _ in range(min(samples, values.shape[1])):
            at = values.argmin(axis=1)
            least = np.column_stack([least, values[rows, at]])
            place = np.column_stack([place, at + start])
            values[rows, at] = _MAX
    if least.shape[1] > samples:
        best = np.argsort(least, axis=1, kind="stable")[:, :samples]
        place = np.take_along_axis(place, best, axis=1)
    place.sort(axis=1)
    bucket = number.copy()
    for column in range(samples):
        bucket = mix(bucket * _U(0x2545F4914F6CDD1D) + labels[place[:, column]])
    return bucket.view(np.int64)


def buckets_of(hashes: np.ndarray) -> np.ndarray:
    """The buckets of a text's word hashes."""
    buckets = sketch(labelled_kmers(hashes, KMER))
    if len(hashes) > SHORT_WORDS:
        return buckets
    return np.unique(np.concatenate([buckets, sketch(labelled_kmers(hashes, SHORT_KMER))]))


def text_hashes(text: str) -> np.ndarray:
    """The hashes of a text's words in order."""
    return np.concatenate([np.empty(0, np.uint64), *[word_hashes(words) for words in folded_words(text, 1_000_000)]])


def word_bins(hashes: np.ndarray) -> np.ndarray:
    """How many words fall in each bin, 255 at most; the number of bins is a power of two that follows the words'."""
    size = min(max(1 << max(0, len(hashes).bit_length() - 1), FEWEST_BINS), MOST_BINS)
    counts = np.bincount((hashes & _U(size - 1)).astype(np.int64), minlength=size)
    return np.minimum(counts, 255).astype(np.uint8)


def folded_bins(bins: np.ndarray, size: int) -> np.ndarray:
    """The same words in fewer bins."""
    if len(bins) == size:
        return bins
    return np.minimum(bins.reshape(-1, size).sum(axis=0, dtype=np.int64), 255).astype(np.uint8)


def allowed(longer, least: float):
    """The edit distance that a pair may have whose longer text has ``longer`` words."""
    return np.floor((1 - least) * longer + 1e-9)


def bins_fit(a: np.ndarray, b: np.ndarray, longer: int, least: float) -> bool:
    """False if the bins alone show that the edit distance is larger than allowed."""
    size = min(len(a), len(b))
    a, b = folded_bins(a, size), folded_bins(b, size)
    most = max(a.sum(dtype=np.int64), b.sum(dtype=np.int64))
    return bool(most - np.minimum(a, b).sum(dtype=np.int64) <= allowed(longer, least))


def describe(text: str) -> tuple[bytes, int, np.ndarray, bytes]:
    """(digest of the words, number of words, buckets, word bins) of one text."""
    digest, hashes, n = hashlib.blake2b(digest_size=16), [], 0
    for words in folded_words(text, 1_000_000):
        if words:
            digest.update(b" ".join(words) + b" ")
            hashes.append(word_hashes(words))
            n += len(words)
    if not n:
        digest.update(b"\0" + text.encode("utf-8", "surrogatepass"))
        return digest.digest(), 0, np.empty(0, np.int64), b""
    joined = np.concatenate(hashes)
    return digest.digest(), n, buckets_of(joined), word_bins(joined).tobytes()


def _describer():
    @F.arrow_udf("struct<key:binary,n_words:long,buckets:array<long>,bins:binary>")
    def described(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in (part for whole in batches for part in array_slices(whole, BATCH_BYTES)):
            keys, counts, buckets, bins = zip(*[describe(text.as_py() or "") for text in batch])
            ends = np.zeros(len(buckets) + 1, dtype=np.int32)
            np.cumsum([len(b) for b in buckets], out=ends[1:])
            yield pa.StructArray.from_arrays(
                [
                    pa.array(keys, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(buckets))),
                    pa.array(bins, pa.binary()),
                ],
                names=["key", "n_words", "buckets", "bins"],
            )

    return described


def banded_distance(a: list, b: list, limit: int) -> int | None:
    """The edit distance of two sequences if it is at most ``limit``, else None.

    Columns of the alignment matrix are bit vectors over the 2 * limit + 1
    diagonals of the band; bit i of column j stands for row j - limit + i.
    Only places inside the band are held, so memory follows the band.
    """
    if abs(len(a) - len(b)) > limit:
        return None
    start, stop = 0, 0
    shorter = min(len(a), len(b))
    while start < shorter and a[start] == b[start]:
        start += 1
    while stop < shorter - start and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    a, b = a[start : len(a) - stop], b[start : len(b) - stop]
    if not a or not b:
        return max(len(a), len(b)) if max(len(a), len(b)) <= limit else None
    k, n = min(limit, max(len(a), len(b))), len(a)
    band = (1 << 2 * k + 1) - 1
    places: dict = {}  # word -> (bits, place of bit 0): its places in the band

    def enter(place: int, low: int) -> None:
        bits, base = places.get(a[place], (0, place))
        if base < low:
            bits, base = bits >> low - base, low
        places[a[place]] = (bits | 1 << place - base, base) if bits else (1, place)

    for place in range(min(k, n)):
        enter(place, 0)
    more, fewer = band & ~((1 << k) - 1), 0  # rows whose value is one more, one less than the row above
    distance = min(k, n)  # of the lowest row of the band, until that is the last row
    for j, word in enumerate(b, 1):
        low = j - k - 1
        if low + 2 * k < n:
            enter(low + 2 * k, low)
        bits, base = places.get(word, (0, low))
        match = (bits << base - low if base >= low else bits >> low - base) & band
        diagonal = ((((match & more) + more) ^ more) | match | fewer) & band
        right_more = fewer | band & ~(diagonal | more)
        right_fewer = diagonal & more
        if j <= n - k:
            distance += not diagonal >> 2 * k & 1
        else:
            bit = n - j + k
            distance += (right_more >> bit & 1) - (right_fewer >> bit & 1)
        below = diagonal >> 1
        more = right_fewer | band & ~(below | right_more)
        fewer = below & right_more
    return distance if distance <= limit else None


def alignment_similarity(a: str, b: str, least: float = SIMILARITY) -> float | None:
    """1 - word edit distance / words of the longer text, if that is at least ``least``."""
    first = [w for words in folded_words(a) for w in words]
    second = [w for words in folded_words(b) for w in words]
    longer = max(len(first), len(second))
    if not longer:
        return 1.0 if a == b else None
    limit = int((1 - least) * longer + 1e-9)
    least_distance = longer - (Counter(first) & Counter(second)).total()
    if least_distance > limit:
        return None
    band = min(max(16, least_distance), limit)
    while (distance := banded_distance(first, second, band)) is None and band < limit:
        band = min(4 * band, limit)  # most near copies lie well inside the band that the limit allows
    return None if distance is None else 1 - distance / longer


def _verifier(least: float):
    @F.arrow_udf("double")
    def similarity(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in (part for whole in batches for part in pair_slices(*whole, BATCH_BYTES)):
            found = [alignment_similarity(a.as_py(), b.as_py(), least) for a, b in zip(left, right)]
            yield pa.array(found, pa.float64())

    return similarity


def _bins_checker(least: float):
    @F.arrow_udf("boolean")
    def possible(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right, longer in batches:
            pairs = zip(left, right, longer.to_pylist())
            found = [bins_fit(*[np.frombuffer(x.as_py(), np.uint8) for x in (a, b)], n, least) for a, b, n in pairs]
            yield pa.array(found, pa.bool_())

    return possible


def _pairs(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _fetched(pairs: DataFrame, stored: DataFrame, columns: dict[str, Column]) -> tuple[DataFrame, Written]:
    """The pairs (a, b) with the columns of both ends (name_a, name_b), and the table behind them.

    Only what the pairs need is taken from ``stored`` (dealt by uid), so only that is moved.
    """
    ends = pairs.select(F.col("a").alias("uid")).union(pairs.select(F.col("b").alias("uid"))).distinct()
    needed = Written(stored.join(ends, "uid").select("uid", *[c.alias(name) for name, c in columns.items()]), "fetched")
    for end in ("a", "b"):
        pairs = pairs.join(needed.df.select(F.col("uid").alias(end), *[F.col(name).alias(f"{name}_{end}") for name in columns]), end)
    return pairs, needed


def _possible(pairs: DataFrame, stored: DataFrame, least: float) -> Written:
    """The pairs (a, b) that neither word counts nor bins rule out."""
    both, behind = _fetched(pairs, stored, {"n_words": F.col("n_words"), "bins": F.col("bins")})
    longer = F.greatest("n_words_a", "n_words_b")
    near = both.where(F.least("n_words_a", "n_words_b") >= longer * least - F.lit(1e-6))
    found = Written(near.where(_bins_checker(least)("bins_a", "bins_b", longer)).select("a", "b"), "possible")
    behind.drop()
    return found


def _verified(pairs: DataFrame, stored: DataFrame, text: Column, least: float) -> Written:
    """(a, b, similarity) for the pairs (a, b) whose alignment is similar enough."""
    both, behind = _fetched(pairs, stored, {"text": text})
    aligned = both.select("a", "b", _verifier(least)("text_a", "text_b").alias("similarity"))
    found = Written(aligned.where("similarity IS NOT NULL"), "links")
    behind.drop()
    return found


def block_pairs(block: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): the nodes of one block whose labels differ and whose lengths and bins do not rule the similarity out.

    block: (low, high, part, node, label, n_words, bins); parts low and high are compared.
    """
    part, node, label, words = (block[c].to_numpy() for c in ("part", "node", "label", "n_words"))
    bins = [np.frombuffer(b, np.uint8) for b in block["bins"].to_pylist()]
    levels = [np.stack([folded_bins(b, size) for b in bins]) for size in (COARSE_BINS, FEWEST_BINS)]
    sums = [level.sum(axis=1, dtype=np.int32) for level in levels]
    finer = np.array([len(b) > FEWEST_BINS for b in bins])
    low, high = block["low"][0].as_py(), block["high"][0].as_py()
    right = np.flatnonzero(part == high)
    lefts, rights = [], []
    for at in np.flatnonzero(part == low):
        others = right[right > at] if low == high else right
        longer = np.maximum(words[others], words[at])
        fits = (label[others] != label[at]) & (np.minimum(words[others], words[at]) >= longer * least - 1e-6)
        others, longer = others[fits], longer[fits]
        for level, total in zip(levels, sums):
            common = np.minimum(level[others], level[at]).sum(axis=1, dtype=np.int32)
            fits = np.maximum(total[others], total[at]) - common <= allowed(longer, least)
            others, longer = others[fits], longer[fits]
        if finer[at]:  # pairs of longer texts have more bins to tell them apart
            fits = [not finer[o] or bins_fit(bins[at], bins[o], n, least) for o, n in zip(others, longer)]
            others = others[np.array(fits, dtype=bool)]
        found = others
        lefts += [node[at]] * len(found)
        rights += node[found].tolist()
    left, other = np.array(lefts, dtype=np.int64), np.array(rights, dtype=np.int64)
    return np.minimum(left, other), np.maximum(left, other)


def _blocks_paired(least: float):
    """A function for mapInArrow over rows sorted by block: its pairs (a, b)."""

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs_of(block: pa.Table) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in block_pairs(block, least)], names=["a", "b"])

        rest: pa.Table | None = None  # the block that is not at its end
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            keys = [rows[c].to_numpy() for c in ("bucket", "low", "high")]
            starts = [0, *(np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1).tolist()]
            for start, stop in zip(starts, starts[1:]):
                yield pairs_of(rows.slice(start, stop - start))
            rest = rows.slice(starts[-1]) if rows.num_rows else None
        if rest is not None:
            yield pairs_of(rest)

    return paired


def _words_counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over texts: how many hold a word (labelled by occurrence), by its hash; one row a counter in use."""
    total = np.zeros(RARITY, np.int64)
    for batch in batches:
        for text in batch.column(0):
            total += np.bincount((labelled_kmers(text_hashes(text.as_py()), 1) % _U(RARITY)).astype(np.int64), minlength=RARITY)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["counter", "n"])


def rarest_words(hashes: np.ndarray, counts: np.ndarray, least: float) -> np.ndarray:
    """The labelled words of which every text that is similar enough holds at least one."""
    words = labelled_kmers(hashes, 1)
    order = np.lexsort((words, counts[(words % _U(len(counts))).astype(np.int64)]))
    return words[order[: int(allowed(len(words), least)) + 1]].view(np.int64)


def _rare_words(counts: np.ndarray, least: float):
    @F.arrow_udf("array<long>")
    def rarest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in (part for whole in batches for part in array_slices(whole, BATCH_BYTES)):
            yield pa.array([rarest_words(text_hashes(text.as_py()), counts, least) for text in batch], pa.list_(pa.int64()))

    return rarest


def _by_rare_words(held: DataFrame, stored: DataFrame, text: Column, least: float) -> DataFrame:
    """(bucket, node, label, n_words, rarer): the nodes of ``held`` dealt by their rarest words, with the number of rarer ones."""
    nodes = held.select("node", "label", "n_words").distinct()
    texts = stored.select(F.col("uid").alias("node"), text.alias("text")).join(nodes, "node")
    found = texts.select("text").mapInArrow(_words_counted, "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(RARITY, np.int64)  # at most so many rows were collected
    counts[found["counter"].to_numpy()] = found["n"].to_numpy()
    words = F.posexplode(_rare_words(counts, least)("text")).alias("rarer", "bucket")
    return Written(texts.select("node", "label", "n_words", words), "dealt").df.select("bucket", "node", "label", "n_words", "rarer")


def _comparable(rows: DataFrame, least: float) -> DataFrame:
    """The rows (bucket, node, label, n_words, rarer) whose bucket holds a node of another class that word counts allow.

    If a pair's first common word has ``rarer`` words before it in one text, the two have at
    most n_words - rarer in common, so the other text has at most that many / ``least`` words.
    Two rows are therefore compared only if their ranges from n_words to that bound meet.
    Ranges whose ends are alike in ``LENGTH_STEPS`` steps for each ratio that the similarity
    allows are one, from the least of their ends to the largest, so the ranges of a bucket are
    bounded however many nodes it holds. A bucket has one row of ranges, so no row is doubled.
    """
    least = max(least, 1e-9)
    size = LENGTH_STEPS / max(-math.log(least), 1e-9)
    step = lambda n: F.floor(F.log(F.greatest(n, F.lit(1.0))) * size)
    low, high = F.col("n_words").cast("double"), (F.col("n_words") - F.col("rarer")) / F.lit(least) + F.lit(1e-6)
    ranged = rows.withColumn("low", low).withColumn("high", high)
    ends = [F.min("low").alias("low"), F.max("high").alias("high"), F.min("label").alias("l0"), F.max("label").alias("l1")]
    ranges = ranged.groupBy("bucket", step(F.col("low")).alias("from"), step(F.col("high")).alias("to")).agg(*ends)
    ranges = ranges.groupBy("bucket").agg(F.collect_list(F.struct("low", "high", "l0", "l1")).alias("ranges"))
    other = lambda r: (r["l0"] != F.col("label")) | (r["l1"] != F.col("label"))
    meets = F.exists("ranges", lambda r: (r["low"] <= F.col("high")) & (r["high"] >= F.col("low")) & other(r))
    return ranged.join(ranges.where("size(ranges) > 1 OR ranges[0].l0 < ranges[0].l1"), "bucket").where(meets).select(rows.columns)


def _rest_pairs(placed: DataFrame, unsettled: DataFrame, stored: DataFrame, text: Column, least: float) -> Written:
    """(a, b): all pairs of nodes of different classes in a bucket that word counts and bins do not rule out.

    placed: (node, bucket, label); unsettled: (bucket).
    """
    sizes = placed.join(unsettled, "bucket").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    sizes = Written(sizes, "sizes").df
    lengths = stored.select(F.col("uid").alias("node"), "n_words")
    held = Written(placed.select("bucket", "node", "label").join(sizes, "bucket").join(lengths, "node"), "held").df
    held = held.select("bucket", "node", "label", "n_words", F.lit(0).alias("rarer"), "n")
    rows, large = held.where(F.col("n") <= LARGE_BUCKET).drop("n"), held.where(F.col("n") > LARGE_BUCKET)
    if not large.isEmpty():
        rows = rows.union(_by_rare_words(large, stored, text, least))
    rows = Written(_comparable(rows, least).select("bucket", "node", "label"), "rest").df
    mark = F.xxhash64("node")
    sets = rows.groupBy("bucket").agg(F.bit_xor(mark).alias("s1"), F.bit_xor(F.xxhash64(mark, "node")).alias("s2"), F.count(F.lit(1)).alias("n"))
    one = sets.groupBy("s1", "s2", "n").agg(F.min("bucket").alias("bucket"))  # buckets of equal nodes give equal pairs
    rows = Written(rows.join(one.select("bucket", F.ceil(F.col("n") / BLOCK_NODES).alias("parts")), "bucket"), "rest").df
    needed = stored.select(F.col("uid").alias("node"), "n_words", "bins").join(rows.select("node").distinct(), "node")
    bins = Written(needed, "bins").df
    parted = rows.withColumn("part", F.pmod(F.xxhash64("node", F.lit(BLOCK_NODES)), "parts"))
    spread = parted.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    blocks = spread.select("bucket", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "node", "label").join(
        bins.hint("merge"), "node"
    )
    key = ["bucket", "low", "high"]
    paired = blocks.repartition(*key).sortWithinPartitions(*key).mapInArrow(_blocks_paired(least), "a long, b long")
    return Written(paired.distinct(), "pairs")


def links_of(nodes: DataFrame, stored: DataFrame, text: Column, least: float) -> tuple[DataFrame, Written]:
    """(links, labels): verified pairs (a, b), and the class of each node that shared a bucket.

    nodes: (node); stored: (uid, n_words, buckets, bins and what ``text`` reads), dealt by uid.
    """
    all_rows = stored.join(nodes.select(F.col("node").alias("uid")), "uid").select(F.explode("buckets").alias("bucket"), F.col("uid").alias("node"))
    shared = all_rows.groupBy("bucket").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n"))
    placed = Written(all_rows.join(shared.where("n > 1").select("bucket", "first"), "bucket"), "buckets")
    # Each node is first tried with the leader it shares most buckets with.
    firsts = (
        placed.df.where("node <> first")
        .groupBy("node", "first")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("node")
        .agg(F.max(F.struct("n", (-F.col("first")).alias("minus"))).alias("best"))
    )
    pairs = Written(firsts.select((-F.col("best.minus")).alias("a"), F.col("node").alias("b")), "pairs")
    labels = Written(placed.df.select("node").distinct().withColumn("label", F.col("node")), "classes")
    tried, found, unsettled, turn = pairs.df, None, None, 1
    while True:
        possible = _possible(pairs.df, stored, least)
        links = _verified(possible.df, stored, text, least)
        possible.drop()
        n_links = links.df.count()
        paid = n_links * PAYING > pairs.df.count()
        found = links.df if found is None else found.union(links.df)
        if n_links:
            labels = _joined(labels, links.df)
        turn += 1
        rows = placed.df.select("bucket", "node")
        if unsettled:  # a bucket of one class stays so
            rows = rows.join(unsettled.df.select("bucket"), "bucket")
        past = [placed, unsettled] if unsettled else [placed]
        placed = Written(rows.join(labels.df, "node"), "placed")
        # The classes of a bucket that are tried with all others of it, each by one member.
        heads = [F.min(F.struct(F.xxhash64("label", F.lit(turn), F.lit(i)).alias("rank"), "label", "node")) for i in range(HEADS)]
        bounds = placed.df.groupBy("bucket").agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.array(*heads).alias("reps"))
        unsettled = Written(bounds.where("l0 < l1").select("bucket", "reps"), "unsettled")
        for table in past:
            table.drop()
        if not paid:  # what is left is tried completely
            break
        # Another member speaks for its class in each round.
        speakers = placed.df.groupBy("bucket", "label").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("rank"), "node")).alias("one"))
        others = F.transform(F.filter("reps", lambda rep: F.col("label") != rep["label"]), lambda rep: rep["node"])
        # Buckets of one passage hold the same classes: a member and its partners are one row before they become pairs.
        partners = speakers.join(unsettled.df, "bucket").groupBy("one.node", others.alias("others")).agg(F.count(F.lit(1)).alias("n"))
        crossing = partners.select("node", "n", F.explode("others").alias("rep")).groupBy("node", "rep").agg(F.sum("n").alias("n"))
        fresh = crossing.select("node", "rep", "n", *_pairs(F.col("rep"), F.col("node"))).join(tried, ["a", "b"], "left_anti")
        # Of its untried partners, at most HEADS for each of its buckets, a member meets those it shares most buckets with.
        order = F.struct((-F.col("n")).alias("few"), F.xxhash64("rep", F.lit(turn)).alias("rank"), "a", "b")
        first = fresh.groupBy("node").agg(F.slice(F.array_sort(F.collect_list(order)), 1, HEADS).alias("best"))
        pairs = Written(first.select(F.explode("best").alias("p")).select("p.a", "p.b").distinct(), "pairs")
        tried = tried.union(pairs.df)
    rest = _rest_pairs(placed.df, unsettled.df.select("bucket"), stored, text, least)
    untried = Written(rest.df.join(tried, ["a", "b"], "left_anti"), "untried")
    links = _verified(untried.df, stored, text, least)
    if not links.df.isEmpty():
        labels = _joined(labels, links.df)
    for table in (placed, unsettled, rest, untried):
        table.drop()
    return found.union(links.df), labels


def _joined(labels: Written, links: DataFrame) -> Written:
    """Labels (node, label) after classes that a link joins have become one."""
    ends = labels.df.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    starts = labels.df.select(F.col("node").alias("a"), F.col("label").alias("la"))
    edges = links.select("a", "b").join(starts, "a").join(ends, "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    onto = connected_components(edges)
    roots = onto.df.select(F.col("node").alias("label"), F.col("label").alias("root"))
    joined = Written(labels.df.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "classes")
    labels.drop()
    onto.drop()
    return joined


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: float = SIMILARITY, carry: list[str] | None = None
) -> DataFrame:
    """Every row of ``docs`` (its columns, or those in ``carry``) with class_id, class_size, n_links and kept.

    ``n_links`` counts the links that were verified for the row's text,
    ``kept`` is true for one row of each class.
    """
    carried = docs if carry is None else docs.select(*carry)
    rows = docs.select(
        packed(carried).alias("row"),
        F.col(id_column).alias("id"),
        text_of(text).alias("text"),
        F.monotonically_increasing_id().alias("uid"),
    ).select("row", "id", "text", "uid", _describer()("text").alias("d"))
    whole = text in carried.columns  # then the row holds the text, and it is not stored twice
    kept = ["row", "id", "uid", "d.*"] if whole else ["row", "id", "uid", "text", "d.*"]
    stored = Bucketed(rows.select(*kept), "described", "uid").df
    words = F.coalesce(F.col("row").getField(text).cast("string"), F.lit("")) if whole else F.col("text")
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "uid")
    groups = Written(
        stored.groupBy("key")
        .agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("copies"))
        .select("key", "first", "copies", F.col("first.uid").alias("node")),
        "nodes",
    ).df
    links, labels = links_of(groups.select("node"), stored, words, least)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    classed = groups.join(degree, "node", "left").join(labels.df, "node", "left")
    classed = Written(classed.withColumn("label", F.coalesce("label", "node")), "classed").df
    labels.drop()
    classes = Written(
        classed.groupBy("label").agg(F.min("first").alias("keeper"), F.sum("copies").alias("class_size")), "classes"
    ).df
    named = Written(
        classed.join(classes, "label").select(
            "key", "keeper", "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links")
        ),
        "named",
    ).df
    # Keys and their results meet first; the rows are not moved again. ``kept`` is written with
    # them: compared after the join, a filter on it would be a second join key and move all rows.
    results = {
        "class_id": F.col("keeper.id"),
        "class_size": F.col("class_size"),
        "n_links": F.col("n_links"),
        "kept": F.col("uid") == F.col("keeper.uid"),
    }
    judged = stored.select("uid", "key").join(named, "key").select("uid", F.struct(*[c.alias(name) for name, c in results.items()]).alias("judged"))
    judged = Written(judged, "judged").df
    return with_results(
        stored.select("row", "uid").join(judged, "uid"), "row", {name: F.col("judged").getField(name) for name in results}
    )
