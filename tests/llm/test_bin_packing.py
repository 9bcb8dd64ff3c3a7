import collections
import random
import zlib

import pytest

from loanscore.llm import bin_packing as bp
from tests.llm.cases import awkward_texts, documents


def test_tree_gives_the_tightest_bin():
    rng, tree, held = random.Random(1), bp.CapacityTree(), []
    for n in range(3000):
        if held and rng.random() < 0.5:
            size = rng.randrange(120)
            fitting = [x for x in held if x[0] >= size]
            expected = min(fitting) if fitting else None
            assert tree.take_tightest(size) == expected
            if expected:
                held.remove(expected)
        else:
            held.append((rng.randrange(100), n))
            tree.add(*held[-1])


def naive_best_fit(sizes, capacity):
    bins, out = [], []
    for size in sizes:
        fitting = [(left, i) for i, left in enumerate(bins) if left >= size]
        if fitting:
            i = min(fitting)[1]
        else:
            bins.append(max(capacity, size))
            i = len(bins) - 1
        bins[i] -= size
        out.append(i)
    return out


def test_packer_is_best_fit():
    rng = random.Random(2)
    for capacity in (30, 100, 1000):
        sizes = sorted((rng.randrange(1, 130) for _ in range(300)), reverse=True)
        packer = bp.Packer(capacity)
        assert [packer.put(s) for s in sizes] == naive_best_fit(sizes, capacity)


@pytest.mark.parametrize("sizes", [[], [5], [9, 1, 1], [3] * 100, list(range(200, 0, -1)), [10_000] + [1] * 50])
def test_pack_uses_no_more_bins_and_fills_evenly(sizes):
    placed = bp.pack(sizes, 8)
    assert len(placed) == len(sizes) and all(0 <= b < 8 for b in placed)
    load = collections.Counter()
    for size, b in zip(sizes, placed):
        load[b] += size
    if sum(sizes) > 1000 and max(sizes) <= sum(sizes) / 8:
        assert max(load.values()) <= 1.02 * sum(sizes) / 8


@pytest.mark.parametrize("large", [[2500], [4000], [9900], [3000, 2900], [5000, 2400, 1200], [600] * 3])
def test_oversized_groups_stand_alone_and_the_others_are_even(large):
    rng = random.Random(7)
    rest, left = [], 10_000_000 - 1000 * sum(large)
    while left:
        rest.append(min(left, rng.randrange(1, 200)))
        left -= rest[-1]
    sizes = sorted([1000 * size for size in large] + rest, reverse=True)
    load = collections.Counter()
    for size, bin_ in zip(sizes, bp.pack(sizes, 16)):
        load[bin_] += size
    own = sum(size >= 1000 * 625 for size in (1000 * s for s in large))
    even = sorted(load.values())[: 16 - own]
    assert len(load) == 16 and max(even) <= 1.02 * min(even)


def check(rows, shards):
    by_shard, groups = collections.defaultdict(list), collections.defaultdict(set)
    for r in rows:
        text = (r.text or "").encode()
        assert r.size == len(text) + 1 and r.text_crc32 == zlib.crc32(text) and 0 <= r.shard < shards
        by_shard[r.shard].append(r)
        groups[text].add(r.shard)
    assert all(len(s) == 1 for s in groups.values())
    for rs in by_shard.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    return {s: sum(r.size for r in rs) for s, rs in by_shard.items()}


def test_shards_are_even_and_groups_whole(spark, monkeypatch):
    monkeypatch.setattr(bp, "BUCKET_ROWS", 20)
    rng = random.Random(4)
    texts = ["x" * rng.randrange(1, 400) + str(i) for i in range(3000)]
    rows = [(i, rng.choice(texts[:50]) if i % 9 == 0 else texts[i]) for i in range(3000)] + [(5000 + i, "hot copy " * 5) for i in range(900)]
    out = bp.shard_documents(documents(spark, rows), shards=4).collect()
    assert len(out) == len(rows)
    load = check(out, 4)
    assert max(load.values()) <= 1.02 * sum(load.values()) / 4


@pytest.mark.parametrize("percent", [25, 40, 90])
def test_a_frequent_text_leaves_no_shard_empty(spark, percent):
    rng = random.Random(percent)
    rows = [(i, f"{i} " + "y" * rng.randrange(10, 120)) for i in range(4000)]
    copies = sum(len(t) + 1 for _, t in rows) * percent // (100 - percent) // 101
    rows += [(10_000 + i, "z" * 100) for i in range(copies)]
    load = check(bp.shard_documents(documents(spark, rows), shards=16).collect(), 16)
    even = sorted(load.values())[:15]
    assert len(load) == 16 and max(even) <= 1.02 * min(even)


def test_awkward_documents(spark):
    out = bp.shard_documents(documents(spark), shards=3).collect()
    assert len(out) == len(awkward_texts())
    check(out, 3)
    assert bp.shard_documents(documents(spark, []), shards=3).collect() == []
