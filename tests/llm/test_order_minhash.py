import random

import numpy as np
import pytest

from loanscore.llm import order_minhash as om
from loanscore.llm.common import table
from loanscore.llm.components import connected_components
from tests.conftest import SMOKE
from tests.llm.cases import documents, edit_distance, roots, words


def test_banded_distance_is_the_edit_distance_within_its_limit():
    rng = random.Random(3)
    for _ in range(3000):
        size = rng.choice([2, 3, 8])
        a = [rng.randrange(size) for _ in range(rng.randrange(14))]
        b = a[:] if rng.random() < 0.6 else [rng.randrange(size) for _ in range(rng.randrange(14))]
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = [rng.randrange(size)] * rng.randrange(2)
        distance = edit_distance(a, b)
        for limit in (0, 1, 2, 4, 7, 20):
            assert om.banded_distance(a, b, limit) == (distance if distance <= limit else None), (a, b, limit)


def test_order_and_occurrence_change_the_sketch():
    first = om.word_hashes([b"a%d" % i for i in range(200)])
    swapped = np.concatenate([first[100:], first[:100]])
    same = set(om.sketch(om.labelled_kmers(first)).tolist())
    moved = set(om.sketch(om.labelled_kmers(swapped)).tolist())
    assert len(same & moved) < len(same)
    repeated = om.labelled_kmers(om.word_hashes([b"x"] * 10))
    assert len(set(repeated.tolist())) == 6
    unrepeated = om.labelled_kmers(first)
    extended = om.labelled_kmers(np.concatenate([first, first[:5]]))
    assert set(unrepeated.tolist()) <= set(extended.tolist())


def test_sketch_in_blocks_equals_one_block(monkeypatch):
    labels = om.labelled_kmers(om.word_hashes([b"w%d" % (i * i % 5003) for i in range(3000)]))
    whole = om.sketch(labels)
    monkeypatch.setattr(om, "BLOCK_KMERS", 64)
    assert om.sketch(labels).tolist() == whole.tolist()


def test_word_hashes_depend_on_the_word_alone():
    one = om.word_hashes([b"abc", b"de", b"abc"])
    assert one[0] == one[2] != one[1]
    assert om.word_hashes([b"zz", b"abc"])[1] == one[0]


def brute_classes(rows, least=0.8):
    split = [words(t) for _, t in rows]
    edges = []
    for i, a in enumerate(split):
        for j in range(i):
            b = split[j]
            longer = max(len(a), len(b))
            if not longer:
                alike = (rows[i][1] or "") == (rows[j][1] or "")
            elif min(len(a), len(b)) < least * longer:
                alike = False
            else:
                alike = a == b or om.banded_distance(a, b, int((1 - least) * longer + 1e-9)) is not None
            if alike:
                edges.append((i, j))
    return roots(len(rows), edges)


def as_partition(labels):
    groups = {}
    for member, label in enumerate(labels):
        groups.setdefault(label, set()).add(member)
    return sorted(map(sorted, groups.values()))


def test_classes_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SMOKE, "documents").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in om.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert as_partition([got[i].class_id for i, _ in rows]) == as_partition(brute_classes(rows))
    for r in got.values():
        assert r.kept == (r.doc_id == r.class_id)
        assert r.class_id <= r.doc_id


def test_chains_through_large_buckets_are_found(spark):
    rng = random.Random(5)
    base = [f"t{rng.randrange(400)}" for _ in range(120)]
    rows, current = [], base
    for i in range(60):  # each text is near the one before it, the ends are far apart
        current = current[:]
        current[rng.randrange(120)] = f"n{i}"
        rows.append((i, " ".join(current)))
    rows += [(100 + i, " ".join(base[:40] + [f"u{i}x{j}" for j in range(200)])) for i in range(40)]  # a shared passage
    got = {r.doc_id: r.class_id for r in om.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert as_partition([got[i] for i, _ in rows]) == as_partition(brute_classes(rows))


def test_pairs_are_tried_although_no_first_choice_is_a_link(spark):
    passage = [f"p{i}" for i in range(150)]
    b = passage + [f"b{i}" for i in range(50)]
    texts = [passage + [f"a{i}" for i in range(50)], b, b[:170] + [f"c{i}" for i in range(30)]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.class_id for r in om.near_duplicates(frame).collect()}
    assert got == {0: 0, 1: 1, 2: 1}


@pytest.mark.parametrize("large", [1000, 50])  # by blocks, and dealt by rare words first
def test_a_large_bucket_is_tried_completely(spark, monkeypatch, large):
    monkeypatch.setattr(om, "BLOCK_NODES", 64)  # several blocks
    monkeypatch.setattr(om, "LARGE_BUCKET", large)
    rng, passage = random.Random(9), [f"p{i}" for i in range(150)]
    texts = [passage + [f"u{i}x{j}" for j in range(50)] for i in range(300)]
    for i in range(12):  # near the text i, with no other five, four or three words in a row in common
        texts.append([w if j < 150 or j % 3 else f"n{i}x{j}" for j, w in enumerate(texts[i])])
    order = rng.sample(range(len(texts)), len(texts))
    frame = spark.createDataFrame([(i, " ".join(texts[i])) for i in order], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in om.near_duplicates(frame).collect()}
    assert got == {i: i if i < 300 else i - 300 for i in range(312)}


@pytest.mark.parametrize("similarity", [0.8, 0.85, 0.9])
@pytest.mark.parametrize("n", [10, 20, 24, 30, 40, 200, 800])
def test_near_pairs_with_scattered_edits_share_a_bucket(similarity, n):
    rng, trials, met = random.Random(n), 60, 0
    for trial in range(trials):
        first = [f"w{trial}x{i}" for i in range(n)]
        second = first[:]
        for at in rng.sample(range(n), int((1 - similarity) * n + 1e-9)):
            second[at] = f"e{trial}x{at}"
        met += bool(set(om.describe(" ".join(first))[2].tolist()) & set(om.describe(" ".join(second))[2].tolist()))
    assert met >= 0.95 * trials


def test_short_texts_with_the_middle_word_changed_share_a_bucket():
    for n in (5, 6, 10, 11):
        first = [f"w{i}" for i in range(n)]
        second = first[: n // 2] + ["other"] + first[n // 2 + 1 :]
        assert set(om.describe(" ".join(first))[2].tolist()) & set(om.describe(" ".join(second))[2].tolist()), n


def near_and_far(rng, trials, vocabulary=400, longest=60):
    """Pairs of texts, edited here and there, that are often near."""
    for _ in range(trials):
        a = [b"w%d" % rng.randrange(vocabulary) for _ in range(rng.randrange(1, longest))]
        b = a[:]
        for _ in range(rng.randrange(len(a) // 4 + 1)):
            at = rng.randrange(len(b))
            b[at : at + rng.choice([0, 1, 1])] = [b"x%d" % rng.randrange(9)]
        yield a, b, om.banded_distance(a, b, int(0.2 * max(len(a), len(b)) + 1e-9)) is not None


def test_bins_rule_out_no_near_pair():
    pairs = 0
    for a, b, near in [*near_and_far(random.Random(2), 300), *near_and_far(random.Random(4), 60, 5, 900)]:
        bins = [om.word_bins(om.word_hashes(t)) for t in (a, b)]
        block = om.pa.table({"low": [0, 0], "high": [0, 0], "part": [0, 0], "node": [1, 2], "label": [1, 2], "n_words": [len(a), len(b)],
                             "bins": [x.tobytes() for x in bins]})
        if near:
            pairs += 1
            assert om.bins_fit(*bins, max(len(a), len(b)), 0.8)
            assert [x.tolist() for x in om.block_pairs(block, 0.8)] == [[1], [2]]
    assert pairs > 100


def test_bins_of_long_texts_keep_their_counts_when_folded():
    hashes = om.word_hashes([b"w%d" % (i * i % 997) for i in range(5000)] + [b"often"] * 700)
    whole = om.word_bins(hashes)
    assert len(whole) == 4096 and whole.max() == 255 and len(om.word_bins(hashes[:9])) == om.FEWEST_BINS
    for size in (1024, 64):
        plain = np.bincount((hashes % np.uint64(size)).astype(int), minlength=size)
        assert om.folded_bins(whole, size).tolist() == np.minimum(plain, 255).tolist()


def test_near_pairs_have_a_rare_word_in_common():
    counts, pairs = np.array([5, 0, 9, 9, 1, 70, 2], dtype=np.int64), 0
    for a, b, near in near_and_far(random.Random(6), 400, 20):
        if near:
            pairs += 1
            assert set(om.rarest_words(om.word_hashes(a), counts, 0.8)) & set(om.rarest_words(om.word_hashes(b), counts, 0.8))
    assert pairs > 100


def test_slices_of_pairs_are_bounded_and_whole():
    left, right = om.pa.array(["a" * 5, None, "", "b" * 40, "c"]), om.pa.array(["d" * 5, "e", "", "f", None])
    parts = list(om.pair_slices(left, right, 10))
    assert [len(a) for a, _ in parts] == [1, 2, 1, 1]
    assert om.pa.concat_arrays([a for a, _ in parts]).equals(left) and om.pa.concat_arrays([b for _, b in parts]).equals(right)


@pytest.fixture
def aligned(monkeypatch):
    """A list that receives the number of pairs of each verification."""
    counts, verified = [], om._verified

    def spy(pairs, *rest):
        counts.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(om, "_verified", spy)
    return counts


@pytest.mark.parametrize("size, changed", [(100, 11), (150, 14), (300, 14)])  # many pairs are just near; none is
def test_aligned_pairs_grow_with_a_group_not_with_its_square(spark, aligned, size, changed):
    rng, base, rows = random.Random(11), [f"b{i}" for i in range(100)], []
    for i in range(size):  # the texts' common base is absent
        other = set(rng.sample(range(100), changed))
        rows.append((i, " ".join(f"n{i}x{j}" if j in other else w for j, w in enumerate(base))))
    out = om.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    if size < 300:
        assert as_partition([r.class_id for r in sorted(out, key=lambda r: r.doc_id)]) == as_partition(brute_classes(rows))
    assert sum(aligned) <= 6 * size, aligned


def test_a_large_near_group_is_aligned_few_times_a_text(spark, aligned):
    rng, base = random.Random(12), [f"b{i}" for i in range(120)]
    texts = [[w if rng.random() > 0.06 else f"n{i}x{j}" for j, w in enumerate(base)] for i in range(400)]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r.class_size for r in om.near_duplicates(frame).collect()} == {400}
    assert sum(aligned) <= 3 * 400, aligned


def test_awkward_documents(spark):
    docs = documents(spark)
    out = om.near_duplicates(docs)
    rows = out.collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].class_id == by[2][0].class_id == 1  # null and empty
    assert by[3][0].class_id == 3 and by[4][0].class_id == 4
    assert {r.class_id for i in (5, 6, 7) for r in by[i]} == {5}
    assert sum(r.kept for i in (5, 6, 7) for r in by[i]) == 1
    assert sum(r.class_size == 4 for r in rows) == 4
    assert sum(r.kept for r in rows) == len({(r.class_id, r.class_size) for r in rows})
    assert out.columns.count("kept") == 1 and {"KEY", "uid", "row", "source"} <= set(out.columns)


def test_empty_table(spark):
    assert om.near_duplicates(documents(spark, [])).collect() == []


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(30)] + [(31, 30)]])
def test_components(spark, edges):
    frame = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    got = {r.node: r.label for r in connected_components(frame).df.collect()}
    n = 1 + max((max(e) for e in edges), default=0)
    expected = roots(n, edges)
    assert got == {x: expected[x] for e in edges for x in e}


def test_word_counts_and_ranks_lose_no_pair_of_a_bucket(spark):
    """Rows leave a bucket only if no row of another class can be similar enough to theirs."""
    draw = random.Random(5)
    rows = [
        (bucket, node, draw.randrange(4) if bucket % 3 else 7, n, draw.randrange(n // 5 + 1))
        for bucket in range(40)
        for node, n in enumerate(draw.choices(range(1, 2000), k=draw.randrange(1, 12)))
    ]
    frame = spark.createDataFrame(rows, "bucket long, node long, label long, n_words long, rarer int")
    left = {(r.bucket, r.node) for r in om._comparable(frame, 0.8).collect()}
    for bucket, node, label, n, rarer in rows:
        others = [r for r in rows if r[0] == bucket and r[2] != label]
        if any(m <= (n - rarer) / 0.8 and n <= (m - rare) / 0.8 for _, _, _, m, rare in others):
            assert (bucket, node) in left
        if not others:
            assert (bucket, node) not in left
    assert len(left) < len(rows) / 2
    assert om._comparable(frame.limit(0), 0.8).isEmpty()


def test_similar_texts_meet_at_a_rare_word_that_their_lengths_allow():
    """The first common rare word of two similar texts stands where the ranges of both meet."""
    draw = random.Random(6)
    for _ in range(300):
        words = [f"w{draw.randrange(60)}" for _ in range(draw.randrange(5, 120))]
        other = list(words)
        for _ in range(draw.randrange(len(words) // 5 + 2)):
            at = draw.randrange(len(other))
            other[at : at + 1] = draw.choice([[], [f"x{draw.random()}"], [other[at], "y"]])
            if not other:
                break
        a, b = " ".join(words), " ".join(other)
        if om.alignment_similarity(a, b, 0.8) is None:
            continue
        counts = np.random.default_rng(len(words)).integers(1, 50, om.RARITY)
        first, second = (om.rarest_words(om.text_hashes(t), counts, 0.8).tolist() for t in (a, b))
        meeting = next(i for i, w in enumerate(first) if w in second)
        i, j = meeting, second.index(first[meeting])
        assert len(other) <= (len(words) - i) / 0.8 + 1e-6 and len(words) <= (len(other) - j) / 0.8 + 1e-6


def test_a_filter_on_kept_moves_no_row(spark):
    """Rows stay where they were dealt; a second join key would have them dealt anew."""
    docs = table(spark, SMOKE, "documents")
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = om.near_duplicates(docs)
        plan = found.where("kept").select(docs.columns)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    assert plan.count("Exchange ") == 1 and "Bucketed: true" in plan, plan
    rows = found.collect()
    assert sum(r.kept for r in rows) == len({r.class_id for r in rows})


@pytest.mark.parametrize("size", [100, 200])
def test_rows_of_a_large_bucket_are_compared_in_proportion_to_its_nodes(spark, size):
    """A row meets its bucket's ranges once, however many nodes and classes the bucket holds."""
    rows = [(1, node, node % 7, 100 + node % 20, 0) for node in range(size)]
    frame = spark.createDataFrame(rows, "bucket long, node long, label long, n_words long, rarer int")
    assert sorted(r.node for r in om._comparable(frame, 0.8).collect()) == list(range(size))


def test_ranges_of_a_bucket_end_where_word_counts_do(spark):
    """Two rows of a bucket whose word counts rule them out by one word leave it."""
    rows = [(1, 1, 1, 800, 0), (1, 2, 2, 1001, 0), (2, 1, 1, 800, 0), (2, 2, 2, 1000, 0), (3, 1, 1, 100, 1), (3, 2, 2, 124, 0)]
    frame = spark.createDataFrame(rows, "bucket long, node long, label long, n_words long, rarer int")
    assert {(r.bucket, r.node) for r in om._comparable(frame, 0.8).collect()} == {(2, 1), (2, 2)}
