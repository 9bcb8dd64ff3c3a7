"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Encoding splits the text by the pattern and merges each match separately;
no special tokens exist. Long texts are cut first, at places where every
split of the whole text has a boundary: in front of a white-space character
that follows a character which is not white space (no alternative of the
pattern crosses such a place, and what stands on either side is matched the
same without the other). A very long run of white space has no such place
inside and would exhaust the library's regular expressions, so it is cut as
the pattern cuts it: the run without its last character (the whole run at the
text's end) is one match, and the last character goes with what follows.

Decoding joins the tokens' raw bytes; they need not be valid UTF-8 by token.

Defined results: a null text is encoded as the empty text (no ids, empty
bytes); an empty table gives an empty result; repeated rows are encoded row by
row; other columns pass through and give way to results of the same name. A
null id list decodes to empty bytes; an id without a rank is an error.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscore.llm.common import array_slices, packed, text_of, with_results

PIECE_CHARS = 65_536
LONG_RUN = 4_096
BATCH_BYTES = 4_000_000  # of text: what one step of a task holds, but for a longer text
BATCH_IDS = 2_000_000

# The characters that \s stands for in the library's patterns (Unicode White_Space).
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_BOUNDARY = re.compile(f"(?<=[^{_SPACE}])(?=[{_SPACE}])")
_RUNS = re.compile(f"[{_SPACE}]{{{LONG_RUN},}}")
_loaded: dict = {}


def encoding(path: str, pattern: str):
    """The tiktoken encoding of a rank file, loaded once in each worker."""
    if (path, pattern) not in _loaded:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        _loaded[path, pattern] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path, pattern]


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[tuple[bool, str]]:
    """(is one match of the pattern, piece): the text in order, cut at safe boundaries."""
    start = 0
    for run in _RUNS.finditer(text) if len(text) >= LONG_RUN else ():
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield from ((False, p) for p in _plain_pieces(text[start : run.start()], size))
        yield True, text[run.start() : end]
        start = end
    yield from ((False, p) for p in _plain_pieces(text[start:], size))


def _plain_pieces(text: str, size: int) -> Iterator[str]:
    start = 0
    while len(text) - start > size:
        found = _BOUNDARY.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    if start < len(text):
        yield text[start:]


def encode_text(bpe, text: str) -> np.ndarray:
    """Ids of one text as int32."""
    if len(text) < LONG_RUN:
        return bpe.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
    parts = []
    for one_match, piece in safe_pieces(text):
        ids = bpe._encode_single_piece(piece) if one_match else bpe.encode_to_numpy(piece, disallowed_special=())
        parts.append(np.asarray(ids, dtype=np.int32))
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def encoder(path: str, pattern: str):
    """A Spark function text -> array<int> of token ids."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = encoding(path, pattern)
        for batch in (part for whole in batches for part in array_slices(whole, BATCH_BYTES)):
            parts = [encode_text(bpe, text.as_py() or "") for text in batch]
            ends = np.zeros(len(parts) + 1, dtype=np.int32)
            np.cumsum([len(p) for p in parts], out=ends[1:])
            values = np.concatenate(parts) if parts else np.empty(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(values))

    return ids


def decoder(path: str, pattern: str):
    """A Spark function array<int> -> the tokens' raw bytes."""

    @F.arrow_udf("binary")
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = encoding(path, pattern)
        for batch in (part for whole in batches for part in array_slices(whole, BATCH_IDS)):
            values = batch.values.to_numpy(zero_copy_only=False)
            ends = batch.offsets.to_numpy()
            out = [bpe.decode_bytes(values[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.array(out, pa.binary())

    return raw


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``ids`` (array<int>) and ``n_tokens``."""
    rows = docs.select(packed(docs).alias("row"), text_of(text).alias("text"))
    coded = rows.select("row", encoder(path, pattern)("text").alias("ids"))
    return with_results(coded, "row", {"ids": F.col("ids"), "n_tokens": F.size("ids").cast("long")})


def decode(coded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Every row of ``coded`` with ``decoded`` (binary): the raw bytes of its ids."""
    rows = coded.select(packed(coded).alias("row"), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))
    return with_results(rows.select("row", decoder(path, pattern)("ids").alias("raw")), "row", {"decoded": F.col("raw")})
