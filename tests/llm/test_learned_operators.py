"""Whitening, importance resampling and the quality classifier against plain references and held-out labels."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loanscore.llm import importance_resampling, quality_classifier, queries, whitening
from loanscore.llm.common import table
from tests.conftest import SMALL, SMOKE
from tests.llm.cases import awkward_texts, documents, words

# Embedding whitening


def covariance_of(rows):
    x = np.floor(1024 * np.array(rows, dtype=float)) + 100_000
    return x, np.cov(x.T, bias=True).reshape(x.shape[1], -1)


@pytest.mark.parametrize("seed", range(3))
def test_spectrum_equals_the_library(seed):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    spectra = [rng.uniform(1, 9, 40), [5.0] * 20 + [1.0] * 20, 10.0 ** -np.arange(40), [1 + 1e-15 * i for i in range(40)], [3.0] + [0.0] * 39]
    for values in spectra:
        a = q * np.array(values) @ q.T
        found, vectors = whitening.spectrum(a)
        assert np.allclose(found, np.linalg.eigvalsh((a + a.T) / 2)[::-1], atol=1e-13 * max(values), rtol=0)
        assert np.abs(vectors.T @ vectors - np.eye(40)).max() < 1e-13
        assert np.abs(a @ vectors - vectors * found).max() < 1e-13 * max(values)
    for a in (np.zeros((4, 4)), np.eye(3), np.ones((5, 5)), np.array([[2.0]]), np.array([[2.0, 1.0], [1.0, 2.0]])):
        assert np.allclose(whitening.spectrum(a)[0], np.linalg.eigvalsh(a)[::-1], atol=1e-14)


def test_polar_factor_is_the_matrix_sign():
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    for values in (np.linspace(-3, 4, 12), np.where(np.arange(12) < 5, -1e-9, 1e3)):
        assert np.abs(whitening.polar_factor(q * values @ q.T) - q * np.sign(values) @ q.T).max() < 1e-6


def test_whitened_rows_equal_an_eigendecomposition(spark):
    rows = {r.vec_id: r.embedding for r in table(spark, SMOKE, "embeddings").collect()}
    out = queries.registry()["op11_qdwh_whitening"](spark, SMOKE).collect()
    x, spread = covariance_of(list(rows.values()))
    values, basis = (part[..., ::-1] for part in np.linalg.eigh(spread))
    wanted = (x - x.mean(axis=0)) @ (basis / np.sqrt(values))
    at = {vec_id: i for i, vec_id in enumerate(rows)}
    got = np.zeros((len(rows), 8))
    n, sums = len(rows), x.astype(int).sum(axis=0)
    for r in out:
        got[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == sum((n * int(v) - int(s)) ** 2 for v, s in zip(x[at[r.vec_id]], sums))
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9)
        assert r.identity_error < 1e-9
    assert len(out) == 8 * n
    signs = np.sign((got * wanted[:, :8]).sum(axis=0))
    assert np.abs(got * signs - wanted[:, :8]).max() < 1e-9


AWKWARD_VECTORS = [
    (1, [0.5, -1.0, 2.0]),
    (2, None),
    (3, [0.5, None, 2.0]),
    (4, [float("nan"), 1.0, 1.0]),
    (5, [float("inf"), 1.0, 1.0]),
    (6, [float("-inf"), 1.0, 1.0]),
    (7, []),
    (8, [1.0, 2.0]),
    (None, [1.5, 0.25, -3.0]),
    (1, [0.5, -1.0, 2.0]),
    (9, [2.0, 2.0, 2.0]),
    (10, [-1.0, 0.0, 1e20]),
    (11, [-4.0, 0.5, 0.0]),
]


def test_whitening_of_awkward_vectors(spark):
    kind = "vec_id long, embedding array<double>, n string, WHITENED string, row string, vector string"
    frame = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in AWKWARD_VECTORS], kind)
    out = whitening.whiten(frame).collect()
    assert out[0].asDict().keys() == {"vec_id", "embedding", "row", "vector", *"component n deviation whitened explained identity_error".split()}
    assert Counter(r.vec_id for r in out) == {1: 6, None: 3, 9: 3, 11: 3}  # three components a row, one row twice
    assert {r.n for r in out} == {5} and {r.identity_error < 1e-9 for r in out} == {True}
    assert math.isclose(sum(r.explained for r in out if r.vec_id == 9), 1)
    assert whitening.whiten(frame.where("false")).collect() == []
    assert whitening.whiten(frame.where("vec_id = 2")).collect() == []


def test_whitening_without_variance_and_with_large_entries(spark):
    same = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(3)], "vec_id long, embedding array<double>")
    assert {(r.whitened, r.explained, r.deviation, r.identity_error) for r in whitening.whiten(same).collect()} == {(0.0, 0.0, 0, 1.0)}
    rows = [(i, [float(s * 2**38), 1.0]) for i, s in enumerate((1, -1, 0, 0.5))]
    large = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=1).collect()
    assert any(r.deviation is None for r in large)
    assert abs(sum(r.whitened**2 for r in large) / 4 - 1) < 1e-9


@given(st.lists(st.lists(st.integers(-(2**45), 2**45), min_size=3, max_size=3), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_deviations_are_exact(rows):
    n, sums = len(rows), tuple(map(sum, zip(*rows)))
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in rows]
    assert whitening.deviations(np.array(rows, dtype=np.int64), n, sums) == [v if v < 2**63 else None for v in exact]


# Importance resampling


def runs(text, ngram):
    w = words(text)
    return [" ".join(w[i : i + k]) for k in range(1, ngram + 1) for i in range(len(w) - k + 1)]


def bucket(feature, buckets=10_000):
    return zlib.crc32(feature.encode()) % buckets


def brute_resample(rows, target, ngram=1, share=10, min_words=20, seed=2024):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, runs(text, ngram)))
    for text in target:
        t.update(map(bucket, runs(text, ngram)))
    corpus, wanted = s.total(), t.total()
    out = []
    for n, (id_, text) in enumerate(rows):
        found = [
            math.floor(1000 * math.log((t[b] + 1) * (corpus + 10_000) / ((s[b] + 1) * (wanted + 10_000)))) for b in map(bucket, runs(text, ngram))
        ]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((id_, len(found), weight, score, len(words(text)) >= min_words, n))
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[5]))
    place = {r[5]: i for i, r in enumerate(order[: len(order) * share // 100], 1)}
    return [(*r[:4], place.get(r[5])) for r in out]


@pytest.mark.parametrize("ngram", [1, 3])
def test_resampling_equals_brute_force(spark, ngram):
    docs, target = table(spark, SMOKE, "documents"), table(spark, SMOKE, "benchmark")
    out = importance_resampling.resample(docs, target, ngram=ngram, share=30)
    got = [(r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in out.collect()]
    wanted = brute_resample([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], ngram, share=30)
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_resampling_of_awkward_documents(spark):
    target = spark.createDataFrame([(None,), ("",), ("word1 word2 and 7\nw4",)], "text string")
    for ngram in (1, 2):
        out = importance_resampling.resample(documents(spark), target, ngram=ngram, share=100).collect()
        wanted = brute_resample(awkward_texts(), [None, "", "word1 word2 and 7\nw4"], ngram, share=100)
        assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in out) == Counter(r[:4] for r in wanted)
        places = sorted(r.rank for r in out if r.rank)
        assert places == list(range(1, len(places) + 1)) and len(places) == sum(r[4] is not None for r in wanted)
        assert [r.score for r in sorted(out, key=lambda r: r.rank or 0) if r.rank] == sorted((r[3] for r in wanted if r[4]), reverse=True)
    assert importance_resampling.resample(documents(spark, []), target).collect() == []
    empty = importance_resampling.resample(documents(spark), target.where("false"), share=50).collect()
    assert len(empty) == len(awkward_texts())


@given(st.text(alphabet="ab \n\n-", max_size=60), st.integers(2, 4))
@settings(max_examples=200, deadline=None)
def test_lines_and_crossing_runs_make_up_the_text(text, ngram):
    known = importance_resampling.WordBuckets(97)
    parts = [text, *text.split("\n")]
    whole, *lines = [Counter(b for found in importance_resampling.line_features(part, ngram, known) for b in found.tolist()) for part in parts]
    crossing = Counter(importance_resampling.crossing_features(text, ngram, 97))
    assert whole == sum(lines, Counter()) + crossing
    assert whole == Counter(bucket(f, 97) for f in runs(text, ngram))


def test_ranks_of_equal_scores_are_whole(spark):
    rows = spark.range(5000).selectExpr("id % 3 as score", "7L as id", "id as uid")
    placed, stored = importance_resampling.ranked(rows.repartition(7), [rows.score.desc(), rows.id.asc_nulls_last(), rows.uid.asc()])
    out = sorted((r.place, -r.score, r.uid) for r in placed.collect())
    assert [p for p, _, _ in out] == list(range(1, 5001))
    assert [r[1:] for r in out] == sorted(r[1:] for r in out)
    stored.drop()


# Quality classifier


def test_features_are_those_of_each_token():
    def tokens_of(text):
        return sorted(quality_classifier.features(text.encode()).tolist())

    assert tokens_of("") == tokens_of(" \n\t ") == []
    assert tokens_of("  ab\n cd ") == tokens_of("ab cd")
    # two tokens and their pair, the n-grams of <ab> and <cd>
    assert len(tokens_of("ab cd")) == 3 + 2 * (2 + 1)
    assert len(tokens_of("ab ab")) == len(tokens_of("ab cd")) + 1  # the repetition
    same = Counter(tokens_of("xy ab xy")) & Counter(tokens_of("qr zz qr"))
    assert same.total() == 1  # a token two places back, whatever it is


def test_pieces_are_the_text(monkeypatch):
    monkeypatch.setattr(quality_classifier, "PIECE_BYTES", 10)
    text = "some words of a text é中 " * 9 + "x" * 50
    parts = list(quality_classifier.pieces(text))
    assert b"".join(parts).decode() == text and max(map(len, parts)) > 10


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


def test_held_out_accuracy(spark):
    out = {r.doc_id: r for r in queries.registry()["op13_subword_quality"](spark, SMALL).collect()}
    assert len(out) == table(spark, SMALL, "documents").count()
    assert all(r.held_out == (fold(i) == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in out.items())
    held = [(out[r.doc_id], r.quality) for r in table(spark, SMALL, "labels").collect() if out[r.doc_id].held_out]
    assert len(held) > 80
    assert sum(r.predicted == q for r, q in held) >= 0.97 * len(held)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = table(spark, SMOKE, "documents"), table(spark, SMOKE, "labels")
    first = quality_classifier.fit(docs, labels)
    turned = labels.selectExpr("doc_id", "if(crc32(string(doc_id)) % 4 = 2, 1 - quality, quality) AS quality")
    second = quality_classifier.fit(docs.repartition(5), turned.repartition(3))
    assert np.array_equal(first.weights, second.weights) and first.bias == second.bias


def test_classifying_awkward_documents(spark):
    rows = [(1, 0), (1, 1), (5, 1), (6, None), (None, 1), (7, 1), (8, 0), (9, 5), (99, 1), (10, 0), (11, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    model = quality_classifier.fit(documents(spark), labels)
    out = quality_classifier.classify(documents(spark), model).collect()
    assert len(out) == len(awkward_texts()) and all(0 <= r.score <= 1 for r in out)
    empty = 1 / (1 + math.exp(-model.bias))
    assert {r.score for r in out if not (r.text or "").strip()} == {empty}
    assert quality_classifier.classify(documents(spark, []), model).collect() == []
    none = quality_classifier.fit(documents(spark), labels.where("false"))
    assert {r.score for r in quality_classifier.classify(documents(spark), none).collect()} == {0.5}
    assert quality_classifier.fit(documents(spark, []), labels).bias == 0.0
    only_ones = quality_classifier.fit(documents(spark), labels.where("quality = 1"))
    assert only_ones.bias > 0 and not only_ones.weights.any()
