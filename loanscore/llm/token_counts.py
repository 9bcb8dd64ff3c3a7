"""Token counts: batch encoding in an Arrow function that returns lengths only.

Texts reach the Python workers in Arrow batches (bounded in bytes by
``spark.sql.execution.arrow.maxBytesPerBatch``) and are taken from them in
slices of about ``BATCH_BYTES``. Inside a slice, texts are cut into pieces of
at most ``PIECE_CHARS`` characters, and the pieces are dealt into encoder
calls of about ``CALL_CHARS`` characters, so no call holds much more than
another and a very long text never becomes one huge encoding. A piece ends
only in front of an ASCII white-space character: the vocabulary drops white
space, no token or special string contains it, and no normal form joins
characters across it, so the pieces' counts add up to the text's count. A text
without white space is encoded whole.

Defined results: a null text counts as empty (0 tokens); an empty table gives
an empty result; repeated rows are counted row by row; other columns pass
through, and an input column named like a result is replaced by it.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscore.llm.common import array_slices, byte_batches, packed, text_of, with_results

PIECE_CHARS = 32_768
CALL_CHARS = 524_288
BATCH_BYTES = 4_000_000  # of text: what one step of a task holds, but for a longer text
LIMIT_TOKENS = 2048

_SAFE = re.compile(r"(?=[ \t\n\r])")
_loaded: dict = {}


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in order, cut in front of white space into parts of about ``size`` characters."""
    start = 0
    while len(text) - start > size:
        found = _SAFE.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def tokenizer(path: str):
    """The tokenizer of a vocabulary file, loaded once in each worker."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        loaded.no_padding()
        loaded.no_truncation()
        _loaded[path] = loaded
    return _loaded[path]


def count_batch(path: str, texts: list[str]) -> np.ndarray:
    """Token counts of ``texts``, without special tokens added."""
    encoder = tokenizer(path)
    owner: list[int] = []

    def all_pieces() -> Iterator[str]:
        for i, text in enumerate(texts):
            for piece in pieces(text):
                owner.append(i)
                yield piece

    lengths: list[int] = []
    for call in byte_batches(all_pieces(), CALL_CHARS):
        lengths.extend(len(e) for e in encoder.encode_batch_fast(call, add_special_tokens=False))
    counts = np.zeros(len(texts), dtype=np.int64)
    np.add.at(counts, owner[: len(lengths)], lengths)
    return counts


def counter(path: str):
    """A Spark function text -> token count by the vocabulary file at ``path``."""

    @F.arrow_udf("long")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in (part for whole in batches for part in array_slices(whole, BATCH_BYTES)):
            yield pa.array(count_batch(path, batch.to_pylist()), pa.int64())

    return n_tokens


def token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT_TOKENS) -> DataFrame:
    """Every row of ``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (``n_tokens > limit``)."""
    rows = docs.select(packed(docs).alias("row"), text_of(text).alias("text"))
    counted = rows.select("row", F.octet_length("text").cast("long").alias("n_bytes"), counter(path)("text").alias("n"))
    return with_results(
        counted,
        "row",
        {"n_bytes": F.col("n_bytes"), "n_tokens": F.col("n"), "over_limit": F.col("n") > F.lit(limit)},
    )
