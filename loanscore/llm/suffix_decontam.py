"""Benchmark decontamination with suffix arrays over the training shards.

A shard is a run of documents inside one Spark task (about ``SHARD_BYTES``
of text). Its words are numbered by the benchmark's vocabulary, its suffixes
sorted into a suffix array, and every suffix of the benchmark is looked up in
it by binary search (all suffixes at once, column by column). The interval
found holds the places of all verbatim matches of the suffix's first
``window`` words. Matches go on from word to word at every place of an item
that still fits; ``matches`` holds, for each benchmark row, the longest verbatim
matches (those within no longer one of that row) with their place in the document
and the first such place in the item. Shards need no exchange: a
document's words all lie in one shard, so the job is a map over documents
and a lost task is simply run again.

Suffixes that start with a pair of words that no benchmark item has in a row
cannot hold a match of two words, so they are left out of the array before it
is sorted; this changes no result.

The benchmark is given to the tasks in blocks of at most ``BLOCK_CHARS`` of
text (a longer item is a block of its own); with more than one block the
corpus is passed once for each block, the spans found so far going along.

Words: A-Z lower-cased, then runs of ASCII letters, digits and characters
beyond ASCII. A window is ``window`` consecutive words of an item; a shorter
item with a word is one window.

Defined results: a null text, or one without words, has no words, no hits and
is clean; items without words are never found; rows of one item id are one
item, a null id counts as the id of empty text; an empty benchmark leaves
every document clean and an empty document table gives an empty result.
Repeated rows are judged row by row; other columns pass through and give way
to results of their name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscore.llm.common import Written, array_slices, folded_words, packed, text_of, with_results

WINDOW = 10
SHARD_BYTES = 4_000_000
BLOCK_CHARS = 4_000_000

STATE = "struct<n_words:long,spans:array<struct<start:int,end:int>>,items:array<string>,matches:array<struct<item:string,item_word:int,doc_word:int,length:int>>>"


@dataclass
class Block:
    """Part of the benchmark, ready for lookup. Word number 0 stands for every other word."""

    window: int
    numbers: dict[bytes, int]
    probes: np.ndarray  # (n, window): the distinct windows, 0 beyond a short one's end
    lengths: np.ndarray  # words of each window
    items: list[str]  # of each benchmark row
    places: list[dict[int, list[int]]]  # the words where each window starts, by benchmark row
    pairs: np.ndarray  # the first two words of the windows, packed and sorted
    singles: np.ndarray  # words that are a window alone

    @classmethod
    def of(cls, items: list[tuple[str, str]], window: int) -> Block:
        numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], dict[int, list[int]]] = {}
        for row, (_, text) in enumerate(items):
            ids = [numbers.setdefault(w, len(numbers) + 1) for part in folded_words(text) for w in part]
            for at in range(max(len(ids) - window + 1, 1) if ids else 0):
                found.setdefault(tuple(ids[at : at + window]), {}).setdefault(row, []).append(at)
        probes = np.zeros((len(found), window), dtype=np.int64)
        lengths = np.zeros(len(found), dtype=np.int64)
        for i, ids in enumerate(found):
            probes[i, : len(ids)] = ids
            lengths[i] = len(ids)
        several = lengths > 1
        pairs = np.unique(probes[several, 0] << 32 | probes[several, 1]) if window > 1 else np.empty(0, np.int64)
        return cls(window, numbers, probes, lengths, [item for item, _ in items], list(found.values()), pairs, np.unique(probes[~several, 0]))


def _member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def suffix_array(words: np.ndarray, block: Block) -> np.ndarray:
    """Places of the shard's suffixes that can match, sorted by their first ``window`` words.

    ``words`` ends with ``window`` zeros; zeros also part the documents.
    """
    known = np.flatnonzero(words)
    if not len(known):
        return known
    can = _member(words[known], block.singles)
    if len(block.pairs):
        follow = known[words[known + 1] > 0]
        pair = follow[_member(words[follow] << 32 | words[follow + 1], block.pairs)]
        known = np.union1d(known[can], pair) if can.any() else pair
    else:
        known = known[can]
    return known[np.lexsort([words[known + k] for k in range(block.window - 1, -1, -1)])]


def _bound(words: np.ndarray, array: np.ndarray, probes: np.ndarray, above: bool) -> np.ndarray:
    """For each probe the first rank whose suffix is not below it (above: is above it), by binary search."""
    low = np.zeros(len(probes), dtype=np.int64)
    high = np.full(len(probes), len(array), dtype=np.int64)
    while (open_ := low < high).any():
        middle = (low + high) // 2
        place = array[np.minimum(middle, len(array) - 1)]
        below = np.zeros(len(probes), dtype=bool)
        equal = np.ones(len(probes), dtype=bool)
        for k in range(probes.shape[1]):
            word = words[place + k]
            below |= equal & (word < probes[:, k])
            equal &= word == probes[:, k]
        below |= equal & above
        low = np.where(open_ & below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    return low


def lookup(words: np.ndarray, array: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(place in the shard, window number) of every occurrence of every window."""
    if not len(array) or not len(block.probes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    beyond = np.arange(block.window)[None, :] >= block.lengths[:, None]
    top = np.where(beyond, np.iinfo(np.int64).max, block.probes)
    first, last = _bound(words, array, block.probes, False), _bound(words, array, top, True)
    counts = last - first
    which = np.repeat(np.arange(len(counts)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return array[np.repeat(first, counts) + offset], which


def search_shard(texts: list[str], block: Block) -> list[dict]:
    """For each text its words, hit spans, items and longest verbatim matches."""
    get = block.numbers.get
    parts, starts, at = [], [], 0
    for text in texts:
        ids = [np.fromiter((get(w, 0) for w in part), np.int64, len(part)) for part in folded_words(text)]
        starts.append(at)
        parts.extend(ids)
        parts.append(np.zeros(1, np.int64))
        at += sum(map(len, ids)) + 1
    words = np.concatenate([*parts, np.zeros(block.window, np.int64)])
    places, which = lookup(words, suffix_array(words, block), block)
    order = np.lexsort((which, places))
    places, which = places[order], which[order]
    ends = np.append(np.array(starts[1:], dtype=np.int64), at)
    cuts = np.searchsorted(places, [*starts, at])
    out = []
    for i, start in enumerate(starts):
        own = slice(cuts[i], cuts[i + 1])
        out.append({"n_words": int(ends[i] - start - 1), **_document(places[own] - start, which[own], block)})
    return out


def _document(places: np.ndarray, which: np.ndarray, block: Block) -> dict:
    spans: list[list[int]] = []
    items: set[str] = set()
    for window in np.unique(which).tolist():
        items.update(block.items[row] for row in block.places[window])
    #: by benchmark row: the last place that fits, the window's length, and by its word in the item where the match started
    running: dict[int, tuple[int, int, dict[int, int]]] = {}
    matches: set[tuple[str, int, int, int]] = set()

    def close(row: int) -> None:
        last, length, starts = running[row]
        start = min(starts.values())
        word = min(w for w, begun in starts.items() if begun == start)
        matches.add((block.items[row], word - (last - start), start, last - start + length))

    for place, window in zip(places.tolist(), which.tolist()):
        length = int(block.lengths[window])
        if spans and place <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], place + length)
        else:
            spans.append([place, place + length])
        for row, at in block.places[window].items():
            last, _, before = running.get(row, (-1, 0, {}))
            going = before if last == place - 1 else {}
            starts = {word: going.get(word - 1, place) for word in at}
            if before and (not going or min(starts.values()) > min(before.values())):
                close(row)
            running[row] = place, length, starts
    for row in running:
        close(row)
    return {
        "spans": [{"start": a, "end": b} for a, b in spans],
        "items": sorted(items),
        "matches": [
            {"item": item, "item_word": word, "doc_word": start, "length": length}
            for item, word, start, length in sorted(matches, key=lambda m: (m[2], m))
        ],
    }


def merge(state: dict | None, found: dict) -> dict:
    """What one more block found, added to what earlier blocks did."""
    if not state:
        return found
    spans: list[dict] = []
    for span in sorted(state["spans"] + found["spans"], key=lambda s: (s["start"], s["end"])):
        if spans and span["start"] <= spans[-1]["end"]:
            spans[-1]["end"] = max(spans[-1]["end"], span["end"])
        else:
            spans.append(dict(span))
    return {
        "n_words": found["n_words"],
        "spans": spans,
        "items": sorted({*state["items"], *found["items"]}),
        "matches": state["matches"] + found["matches"],
    }


def _searcher(block: Block):
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    result = to_arrow_type(StructType.fromDDL(STATE.removeprefix("struct<").removesuffix(">")))

    @F.arrow_udf(STATE)
    def search(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, states in batches:
            at = 0
            for shard in array_slices(texts, SHARD_BYTES):
                earlier = states.slice(at, len(shard)).to_pylist()
                at += len(shard)
                found = search_shard([t or "" for t in shard.to_pylist()], block)
                yield pa.array([merge(s, f) for s, f in zip(earlier, found)], result)

    return search


def benchmark_blocks(benchmark: DataFrame, item: str, text: str, window: int, limit: int = BLOCK_CHARS) -> Iterator[Block]:
    """The benchmark in blocks of at most ``limit`` characters, at least one; one block at a time is on the driver."""
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), text_of(text).alias("text"))
    items: list[tuple[str, str]] = []
    size = made = 0
    for row in rows.toLocalIterator():
        if items and size + len(row.text) > limit:
            yield Block.of(items, window)
            items, size, made = [], 0, made + 1
        items.append((row.item, row.text))
        size += len(row.text)
    if items or not made:
        yield Block.of(items, window)


def search_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Every row of ``docs`` with n_words, n_hit, items (sorted ids), matches and contaminated."""
    rows = docs.select(packed(docs).alias("row"), text_of(text).alias("text"), F.lit(None).cast(STATE).alias("state"))
    previous = None
    for block in benchmark_blocks(benchmark, item, item_text, window, block_chars):
        if previous is not None:  # one pass for each block, so that tasks hold one block at a time
            rows = Written(rows, "decontam").df
        rows = previous = rows.select("row", "text", _searcher(block)("text", "state").alias("state"))
    n_hit = F.aggregate("state.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    found = rows.select("row", "state", n_hit.alias("n_hit"))
    return with_results(
        found,
        "row",
        {
            "n_words": F.col("state.n_words"),
            "n_hit": F.col("n_hit"),
            "items": F.col("state.items"),
            "matches": F.col("state.matches"),
            "contaminated": F.col("n_hit") > 0,
        },
    )
