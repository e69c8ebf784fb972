import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sortproof.llm.sharding import best_fit, pack_evenly, pack_fixed, shard_documents, sharding_digest



def best_fit_by_scan(sizes, capacity):
    space, out = [], []
    for s in sizes:
        fits = [(room, b) for b, room in enumerate(space) if room >= s]
        if fits:
            b = min(fits)[1]
        else:
            b = len(space)
            space.append(max(capacity, s))
        space[b] -= s
        out.append(b)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(1, 80))
def test_tree_finds_the_tightest_bin(sizes, capacity):
    sizes = sorted(sizes, reverse=True)
    assert pack_fixed(sizes, capacity) == best_fit_by_scan(sizes, capacity)


def test_even_packing_is_near_even():
    rng = random.Random(4)
    sizes = sorted((rng.randint(1, 1000) for _ in range(3000)), reverse=True)
    loads = defaultdict(int)
    for s, b in zip(sizes, pack_evenly(sizes, 8), strict=True):
        loads[b] += s
    assert len(loads) == 8 and max(loads.values()) - min(loads.values()) <= 1000
    assert best_fit(sizes, sum(sizes) // 9, 8) is None


@pytest.mark.parametrize("share", [3, 2])
def test_an_item_above_the_even_share_leaves_the_others_even(share):
    rest = sorted((random.Random(6).randint(1, 50) for _ in range(4000)), reverse=True)
    big = sum(rest) // (share - 1)  # of all bytes
    sizes = [big, *rest]
    loads = [0] * 8
    for s, b in zip(sizes, pack_evenly(sizes, 8), strict=True):
        loads[b] += s
    loads.sort()
    assert loads[-1] == big and loads[6] - loads[0] <= 50


def test_no_shard_stays_empty_while_another_holds_two_items():
    assert sorted(Counter(pack_evenly([5] * 4, 3)).values()) == [1, 1, 2]
    assert sorted(pack_evenly([9, 8, 1], 8)) == [0, 1, 2]
    # 60 equal items after two that have bins of their own
    sizes = [1000, 700] + [10] * 60
    assert sorted(Counter(pack_evenly(sizes, 8)).values()) == [1, 1, 10, 10, 10, 10, 10, 10]


def check(rows, out, shards):
    assert len(out) == len(rows)
    by_text, slots = defaultdict(set), defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    texts = dict(rows)
    for r in out:
        t = texts[r["doc_id"]] or ""
        by_text[t].add(r["shard"])
        assert r["size"] == len(t.encode()) + 1 and r["text_crc32"] == zlib.crc32(t.encode())
    assert all(len(v) == 1 for v in by_text.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(slots) <= set(range(shards))


def test_groups_stay_whole_and_slots_have_no_gap(docs_df, clashing):
    rng = random.Random(1)
    rows = [(i, "w" * rng.randint(0, 90) + str(i)) for i in range(300)]
    rows += [(1000 + i, "copy of one text") for i in range(120)] + [(2000, None), (2001, ""), (2002, "é" * 500)]
    out = sharding_digest(docs_df(rows, clashing)).collect()
    check(rows, out, 8)
    loads = defaultdict(int)
    for r in out:
        loads[r["shard"]] += r["size"]
        assert r["law"] == "bytes" and r["grown_shard"] is None
    # the copies are more than an eighth; the other seven shards are even
    rest = sorted(loads.values())[:-1]
    assert rest[-1] - rest[0] <= 100


def test_a_group_of_half_the_bytes_leaves_the_other_shards_even(docs_df):
    rows = [(i, f"text number {i}") for i in range(600)] + [(1000 + i, "copy of one text") for i in range(600)]
    out = sharding_digest(docs_df(rows)).collect()
    check(rows, out, 8)
    loads = defaultdict(int)
    for r in out:
        loads[r["shard"]] += r["size"]
    rest = sorted(loads.values())[:-1]
    assert len(rest) == 7 and rest[-1] - rest[0] <= 16


def test_few_parts_bundle_small_groups(docs_df):
    rows = [(i, f"text number {i}") for i in range(500)]
    out = shard_documents(docs_df(rows).select("doc_id", "text"), 4, parts=64).collect()
    check(rows, out, 4)
    loads = defaultdict(int)
    for r in out:
        loads[r["shard"]] += r["size"]
    assert max(loads.values()) - min(loads.values()) < sum(loads.values()) / 16


def test_fixed_capacity_repeated_rows_and_empty_table(docs_df):
    df = docs_df([(1, "aaaa"), (1, "aaaa"), (None, "bb"), (None, None)]).select("doc_id", "text")
    out = shard_documents(df, shards=None, capacity=10).collect()
    assert len(out) == 4 and {r["shard"] for r in out} == {0, 1}
    assert sharding_digest(docs_df([(1, "x")]).limit(0)).count() == 0
    with pytest.raises(ValueError, match="either"):
        shard_documents(df, shards=None)


@pytest.mark.parametrize(("parts", "most"), [(16, 200), (512, 36)])
def test_fixed_capacity_far_below_a_part_of_all_bytes(docs_df, parts, most):
    rows = [(i, f"text number {i}") for i in range(3000)] + [(5000 + i, "copy of one text") for i in range(200)] + [(None, None)]
    out = shard_documents(docs_df(rows).select("doc_id", "text"), shards=None, capacity=2000, parts=parts).collect()
    check(rows, out, most)
    loads, texts = defaultdict(int), defaultdict(set)
    for r in out:
        loads[r["shard"]] += r["size"]
        texts[r["shard"]].add(r["text_crc32"])
    assert set(loads) == set(range(len(loads)))
    # only the group of copies, which can't part, is above the capacity
    over = [b for b, n in loads.items() if n > 2000]
    assert len(over) == 1 and texts[over[0]] == {zlib.crc32(b"copy of one text")}
