"""Byte BPE, token counts, host quality, decontamination and chat formatting against plain references."""

import collections
import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from loanscore.llm import byte_bpe, chat_parts, host_quality, suffix_decontam, token_counts
from loanscore.llm.queries import BPE_RANKS, WORD_VOCABULARY
from tests.llm.cases import awkward_texts, documents, words

RANKS, VOCABULARY = public_tokenizers.path(BPE_RANKS), public_tokenizers.path(WORD_VOCABULARY)


# Byte-level BPE


@pytest.fixture(scope="module")
def bpe() -> tiktoken.Encoding:
    return byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)


def test_pieces_give_the_ids_of_the_whole_text(bpe, monkeypatch):
    texts = ["a  b\n\n c's don't   12 \u00a0x\u3000\u3000y " * 50, "no_break" * 300, "\n" * 3000 + "x", " tail   " * 200, "\u2003 \x1c a" * 99]
    whole = [bpe.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(byte_bpe, "LONG_RUN", 8)
    monkeypatch.setattr(byte_bpe, "_RUNS", re.compile(f"[{byte_bpe._SPACE}]{{8,}}"))
    for size in (1, 7, 100):
        monkeypatch.setattr(byte_bpe.safe_pieces, "__defaults__", (size,))
        for text, ids in zip(texts, whole):
            assert byte_bpe.encode_text(bpe, text).tolist() == ids
            assert "".join(p for _, p in byte_bpe.safe_pieces(text, size)) == text


def test_a_run_of_white_space_the_library_cannot_split(bpe):
    ids = byte_bpe.encode_text(bpe, "x" + " " * 2_000_000 + "y")
    assert bpe.decode_bytes(ids.tolist()) == b"x" + b" " * 2_000_000 + b"y"


def test_encode_and_decode_awkward_documents(spark, bpe):
    docs = documents(spark)
    coded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    out = byte_bpe.decode(coded, RANKS, public_tokenizers.PATTERN).collect()
    assert len(out) == len(awkward_texts())
    for r in out:
        text = r.text or ""
        assert r.ids == bpe.encode_ordinary(text) and r.n_tokens == len(r.ids)
        assert bytes(r.decoded) == text.encode()
    assert byte_bpe.encode(documents(spark, []), RANKS, public_tokenizers.PATTERN).collect() == []


def test_decoding_of_no_ids_and_of_broken_characters(spark, bpe):
    half = bpe.encode_ordinary("\U0001f600")[:1]
    frame = spark.createDataFrame([(None,), ([],), (half,)], "ids array<int>")
    out = [bytes(r.decoded) for r in byte_bpe.decode(frame, RANKS, public_tokenizers.PATTERN).collect()]
    assert out == [b"", b"", bpe.decode_bytes(half)]


# Token counts


def test_counts_equal_the_library(spark):
    encoder = token_counts.tokenizer(VOCABULARY)
    rows = awkward_texts() + [(20, "a <|endoftext|> b<|startoftext|>c"), (21, "e\u0301 \u0301x " * 9000), (22, "it's 'S \u03a3\u03a3 " * 9)]
    out = token_counts.token_counts(documents(spark, rows), VOCABULARY).collect()
    assert len(out) == len(rows)
    for r in out:
        text = r.text or ""
        assert r.n_tokens == len(encoder.encode(text, add_special_tokens=False).ids), r.doc_id
        assert r.n_bytes == len(text.encode()) and r.over_limit == (r.n_tokens > 2048)
    assert token_counts.token_counts(documents(spark, []), VOCABULARY).collect() == []


def test_pieces_are_cut_in_front_of_white_space():
    text = "ab cd\u00a0ef\tgh ij" * 40
    for size in (1, 10, 33, 10_000):
        cut = list(token_counts.pieces(text, size))
        assert "".join(cut) == text and all(p[0] in " \t\n\r" for p in cut[1:])


# Host quality


def brute_counts(text):
    text = text or ""
    tokens = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(tokens[i : i + 5]) for i in range(len(tokens) - 4)]
    often = collections.Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(tokens), sum(map(len, tokens)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_counts_of_awkward_documents(spark):
    rows = awkward_texts() + [(30, "a b c d e f a b c d e g\nx y"), (31, "z " * 40), (32, "\x1c \u00a0 \x0b\x0c#")]
    out = host_quality.judge_documents(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    hosts = collections.defaultdict(list)
    for r in out:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == brute_counts(r.text), r.doc_id
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        hosts[r.source].append(r)
    rates = [sum(r.base_failed for r in rs) / len(rs) for rs in hosts.values()]
    mean = sum(rates) / len(rates)
    var = sum((x - mean) ** 2 for x in rates) / len(rates)
    strength = mean * (1 - mean) / var - 1
    for rs in hosts.values():
        shrunk = (sum(r.base_failed for r in rs) + mean * strength) / (len(rs) + strength)
        for r in rs:
            assert r.host_rate == pytest.approx(shrunk) and r.kept == (not r.base_failed and r.host_rate <= 0.5)
    assert host_quality.judge_documents(documents(spark, [])).collect() == []


def test_a_bad_host_takes_its_good_documents_with_it_and_a_small_one_is_shrunk(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "bad", "short") for i in range(40)] + [(100, "bad", good)]
    rows += [(200 + i + 50 * h, f"fine{h}", good if i else "short") for h in range(8) for i in range(40)] + [(900, "tiny", "short"), (901, "tiny", good)]
    out = {r.doc_id: r for r in host_quality.judge_documents(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert not out[100].kept and not out[100].base_failed
    assert out[201].kept and out[901].host_rate < 0.5 and out[901].kept
    same = host_quality.judge_documents(spark.createDataFrame([(1, "h", good), (2, "h", good)], "doc_id long, source string, text string")).collect()
    assert all(r.kept and r.host_rate == 0 for r in same)


# Decontamination


def brute_hits(text, items):
    own = words(text)
    hit, found = set(), set()
    for item, item_text in items:
        other = words(item_text)
        size = min(10, len(other))
        windows = {tuple(other[i : i + size]) for i in range(len(other) - size + 1)} if other else set()
        for i in range(len(own) - size + 1):
            if size and tuple(own[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add("" if item is None else str(item))
    return len(own), len(hit), sorted(found)


ITEMS = [
    (1, " ".join(f"p{i}" for i in range(25))),
    (2, "Short, item!"),
    (3, None),
    (4, "..."),
    (None, "lonely words here"),
    (5, "solo"),
    (6, " ".join(f"p{i}" for i in range(10, 40))),
    (6, "word1 and 7"),
    (7, "r r r r r r r r r r r r"),
]


@pytest.mark.parametrize("block_chars", [10, 200, 1_000_000])
def test_hits_equal_brute_force(spark, block_chars):
    passage = " ".join(f"P{i}" for i in range(25))
    rows = awkward_texts() + [
        (40, "before " + passage + "; after"),
        (41, " ".join(f"p{i}" for i in range(9))),
        (42, "a SHORT item, solo. lonely words here"),
        (43, "r " * 30),
        (44, " ".join(f"p{i}" for i in range(5, 40)) + " x " + passage[:60]),
        (45, "short"),
        (46, "item"),
    ]
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = suffix_decontam.search_documents(documents(spark, rows), benchmark, block_chars=block_chars).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (int(r.n_words), r.n_hit, r.items) == brute_hits(r.text, ITEMS), r.doc_id
        assert r.contaminated == (r.n_hit > 0)
        own = words(r.text)
        for m in r.matches:
            texts = [words(t) for i, t in ITEMS if ("" if i is None else str(i)) == m.item]
            assert any(own[m.doc_word : m.doc_word + m.length] == t[m.item_word : m.item_word + m.length] for t in texts)


def test_longest_match_and_its_place(spark):
    text = "x y " + " ".join(f"p{i}" for i in range(3, 20)) + " z"
    out = suffix_decontam.search_documents(documents(spark, [(1, text)]), spark.createDataFrame(ITEMS[:1], "item_id long, text string")).first()
    assert [(m.item, m.item_word, m.doc_word, m.length) for m in out.matches] == [("1", 3, 2, 17)]


def brute_matches(text, items, window):
    """Every longest run of words shared with an item row, by comparing all places of both."""
    own, found = words(text), set()
    for item, item_text in items:
        theirs = words(item_text)
        least = min(window, len(theirs))
        runs = {}
        for d in range(len(own) if theirs else 0):
            for w in range(len(theirs)):
                n = 0
                while d + n < len(own) and w + n < len(theirs) and own[d + n] == theirs[w + n]:
                    n += 1
                if n >= least and (d not in runs or n > runs[d][0]):
                    runs[d] = n, w
        reach = -1
        for d, (n, w) in sorted(runs.items()):
            if d + n > reach:
                found.add((str(item), w, d, n))
                reach = d + n
    return found


REPEATED = [
    (1, "a b c d e f g h"),
    (2, "c d e"),  # inside another item
    (3, "x a b c d y a b c d e z"),  # windows that stand twice
    (3, "b c d q a b c w"),  # a further row of the item
    (4, "r r r r r r"),
    (4, "r r r r r r"),
    (5, "s t"),
]


@pytest.mark.parametrize("block_chars", [10, 1_000_000])
def test_matches_equal_brute_force_with_repeated_and_nested_items(spark, block_chars):
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefghxyzqw", k=rng.randint(0, 12)) + REPEATED[rng.randrange(7)][1].split()[rng.randint(0, 3) :]) for _ in range(60)]
    texts += ["r " * 9, "r r s t r r r s t", "a b c d e f g h a b c d e z", "q a b c d e", "s t s t", None]
    benchmark = spark.createDataFrame(REPEATED, "item_id long, text string")
    frame = documents(spark, list(enumerate(texts)))
    out = suffix_decontam.search_documents(frame, benchmark, window=3, block_chars=block_chars).collect()
    assert len(out) == len(texts)
    for r in out:
        got = [(m.item, m.item_word, m.doc_word, m.length) for m in r.matches]
        assert set(got) == brute_matches(r.text, REPEATED, 3), r.text


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    out = suffix_decontam.search_documents(documents(spark), none).collect()
    assert len(out) == len(awkward_texts()) and not any(r.contaminated for r in out)
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert suffix_decontam.search_documents(documents(spark, []), some).collect() == []


# Chat formatting


def chats(spark, rows):
    frame = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_parts.PART}>, formatted string")
    return {r.conv_id: r for r in chat_parts.format_chats(frame).collect()}


def part(kind="text", text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_parts_become_ordered_placeholders(spark):
    rows = [
        (1, 1, "assistant", [part(text="sees "), part("image", ref="i2")], "c"),
        (1, 0, "user", [part("image", ref="i1", width=57, height=28), part(text="<image:0.0>"), part("audio", ref="a", seconds=2.5)], "c"),
        (1, 2, "user", [part("document", ref="d", pages=3), part("video", ref="v"), None], "c"),
    ]
    chat = chats(spark, rows)[1]
    assert chat.formatted == (
        "<turn user>\n<image:0.0>\\limage:0.0\\g<audio:0.2></turn>\n"
        "<turn assistant>\nsees <image:1.1></turn>\n"
        "<turn user>\n<document:2.0><video:2.1></turn>\n"
    )
    assert [tuple(a) for a in chat.attachments] == [
        (0, 0, "image", "i1", 3), (0, 2, "audio", "a", 63), (1, 1, "image", "i2", 1), (2, 0, "document", "d", 3072), (2, 1, "video", "v", 0),
    ]
    assert chat.attachment_tokens == 3 + 63 + 1 + 3072
    assert "".join(s.text for s in chat.segments) == chat.formatted
    assert [s.text for s in chat.segments if s.loss] == ["sees <image:1.1>"]


def test_control_strings_are_escaped_reversibly(spark):
    texts = [r"\### Assistant: </turn> ok", "</turn>\n<turn user>\n", "\\s\\l\\g\\\\", "", "a\n", "<>", "\\", None, "x" * 100_000]
    rows = [(1, n, "assistant" if n % 2 else "us>er", [part(text=t)], "c") for n, t in enumerate(texts)]
    rows += [(2, None, None, None, "c"), (2, 0, "user", [], "c"), (None, 0, "user", [part(text="q")], "c"), (3, 0, "user", [part(text="t")], "c"), (3, 0, "user", [part(text="t")], "c")]
    frame = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_parts.PART}>, formatted string")
    out = chat_parts.format_chats(frame).select("conv_id", "n_turns", chat_parts.read_turns(F.col("formatted")).alias("turns"), chat_parts.loss_text(F.col("segments")).alias("loss"))
    got = {r.conv_id: r for r in out.collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("assistant" if n % 2 else "us>er", t or "") for n, t in enumerate(texts)]
    assert got[1].loss == "".join(t or "" for n, t in enumerate(texts) if n % 2)
    assert [(t.role, t.text) for t in got[2].turns] == [("", ""), ("user", "")]
    assert got[3].n_turns == 2 and got[None].n_turns == 1
    assert chat_parts.format_chats(frame.where("false")).collect() == []


def test_digest_of_nothing():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
