import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from surveyloom.llm import simhash


def brute_fingerprint(text, width=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, radius=3):
    """Smallest position reachable from each value."""
    label = list(range(len(values)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(values))]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abAB \t\n\x0b  éÉ", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) & (1 << 64) - 1 == brute_fingerprint(text)


def test_fingerprint_of_a_long_text(monkeypatch):
    text = " ".join(str(i % 97) for i in range(5000))
    monkeypatch.setattr(simhash, "HASH_SLICE", 64)
    assert simhash.fingerprint(text) & (1 << 64) - 1 == brute_fingerprint(text)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2**12 - 1)), min_size=1, max_size=60, unique=True))
def test_trees_find_what_is_near(pairs):
    pairs.sort(key=lambda p: p[0])
    names = sorted({g for g, _ in pairs})
    group = np.array([names.index(g) for g, _ in pairs])
    fp = np.array([v * 0x10001 for _, v in pairs], np.uint64)
    roots, children = simhash.build_trees(group, fp)
    got = set()
    for q, n in simhash.search(roots[group], fp, fp, children, 3):
        got |= set(zip(q.tolist(), n.tolist()))
    want = {(i, j) for i in range(len(fp)) for j in range(len(fp)) if group[i] == group[j] and (
        int(fp[i]) ^ int(fp[j])).bit_count() <= 3}
    assert got == want


@pytest.mark.parametrize("rows", [100, 10**7, 10**12])
def test_masks_cover_every_pair(rows):
    masks = simhash.shard_masks(rows, 3)
    rng = random.Random(rows)
    for _ in range(300):
        flips = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(flips & m & (1 << 64) - 1 == 0 for m in masks)


@pytest.mark.parametrize("tree, buffer", [(4096, 50_000), (8, 20)])
def test_links_and_components(spark, monkeypatch, tree, buffer):
    monkeypatch.setattr(simhash, "TREE_ROWS", tree)
    monkeypatch.setattr(simhash, "BUFFER_ROWS", buffer)
    monkeypatch.setattr(simhash, "OPEN_PAIRS", 50)
    rng = random.Random(4)
    values = [0] + [rng.getrandbits(64) for _ in range(150)]
    for _ in range(250):  # a chain and clouds around some values
        v = values[-1] if rng.random() < 0.4 else rng.choice(values[:5])
        for _ in range(rng.randint(1, 5)):
            v ^= 1 << rng.randrange(64)
        values.append(v)
    values = list(dict.fromkeys(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3)
    links = simhash.near_links(nodes).collect()
    assert len(links) < 30 * len(values)
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.near_links(nodes)).collect()}
    want = brute_components(values)
    classes = {}
    for v, w in zip(signed, want):
        classes.setdefault(w, set()).add(roots.get(v, v))
    assert all(len(c) == 1 for c in classes.values()) and len({min(c) for c in classes.values()}) == len(classes)


def test_documents(spark, documents):
    base = [" ".join(f"{a}{i}" for i in range(80)) for a in "abcd"]
    texts = [None, "", "  \n", "One two", "one TWO", base[0], base[0] + " tail", base[1], base[1], base[2] + " x" * 2000,
             base[3], base[3].replace("d40", "D40"), "x"]
    rows = [(i * 3, t, "s") for i, t in enumerate(texts)] + [(None, base[2], "s"), (0, None, "s"), (21, base[1], "s")]
    got = simhash.near_documents(documents(rows)).collect()
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    label = brute_components(fps)
    smallest = {}
    for (i, _, _), c in zip(rows, label):
        smallest[c] = min(smallest.get(c, i) if smallest.get(c) is not None else i, i) if i is not None else smallest.get(c)
    want = sorted(((i, f - (1 << 64) if f >> 63 else f, smallest[c]) for (i, _, _), f, c in zip(rows, fps, label)), key=str)
    assert sorted(map(tuple, got), key=str) == want
    kept = simhash.keep_one(documents(rows))
    assert kept.columns == documents(rows).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for i, _, c in want if i is not None})
    assert ids.count(None) == 1


def test_no_documents(documents):
    assert simhash.near_documents(documents([])).count() == 0
    assert simhash.keep_one(documents([])).count() == 0


def test_one_of_each_component_is_kept(documents):
    """Unlike texts under one doc_id stay, copies without doc_id are copies, and repeated rows are one."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(1, a, "s"), (1, b, "s"), (1, b, "t"), (2, b, "s"), (2, c, "s"), (None, a, "s"), (None, "lone words here", "s"),
            (None, "lone words here", "s"), (None, None, "s"), (None, "", "s"), (3, c, "s"), (3, c, "s"), (4, "", "s")]
    kept = simhash.keep_one(documents(rows)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(
        [(1, a), (1, b), (2, c), (None, "lone words here"), (4, "")], key=str)
    only = [(None, "copy of words", "s")] * 3 + [(None, "other things", "s")]
    assert sorted(r["text"] for r in simhash.keep_one(documents(only)).collect()) == ["copy of words", "other things"]
