import heapq
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from surveyloom.llm.sharding import place, shard_documents


def heap_counts(loads, size, count):
    heap = [(load, s) for s, load in enumerate(loads)]
    heapq.heapify(heap)
    counts = [0] * len(loads)
    for _ in range(count):
        load, s = heap[0]
        counts[s] += 1
        heapq.heapreplace(heap, (load + size, s))
    return counts


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=8), st.integers(1, 50), st.integers(0, 300))
def test_place_is_the_heap(loads, size, count):
    wanted = heap_counts(loads, size, count)
    after = sorted(load + n * size for load, n in zip(loads, wanted))
    counts = place(loads, size, count)
    assert sum(counts) == count and sorted(loads) == after


def test_shards_follow_the_schedule(spark, documents):
    rng = random.Random(1)
    texts = [None, "", "é", "a" * 5000] + ["w" * rng.randint(1, 400) for _ in range(150)] + ["hot"] * 120
    rows = [(None if i == 3 else i // 2 if i < 8 else i, t, "s") for i, t in enumerate(texts)]
    got = shard_documents(documents(rows), 8).collect()
    assert len(got) == len(rows)
    groups = {}
    for _, t, _ in rows:
        groups[t or ""] = groups.get(t or "", 0) + len((t or "").encode()) + 1
    loads = [0] * 8
    for size in sorted(groups.values(), reverse=True):
        place(loads, size, 1)
    shards = {}
    for r in got:
        shards.setdefault(r["shard"], []).append(r)
    assert sorted(sum(r["size"] for r in v) for v in shards.values()) == sorted(x for x in loads if x)
    for v in shards.values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))
    where = {}
    for r in got:
        assert where.setdefault(r["text_crc32"], r["shard"]) == r["shard"]
    assert {zlib.crc32((t or "").encode()) for _, t, _ in rows} == set(where)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, shard_documents(documents(rows), 8).collect()), key=str)


def test_no_documents(documents):
    df = shard_documents(documents([]), 8)
    assert df.columns == ["doc_id", "size", "text_crc32", "shard", "slot"] and df.count() == 0
