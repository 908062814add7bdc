import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from surveyloom.llm import decontaminate as dc


def brute_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=14))
def test_common_subsequence(a, b):
    n, start, end = dc.common(a, b)
    assert n == brute_common(a, b) == brute_common(a, b[start:end])
    assert n == 0 or (brute_common(a, b[:end - 1]) < n and brute_common(a, b[start + 1:end]) < n)


def text(rng, n):
    return " ".join("".join(rng.choice(["an", "er", "th", "ing", "on", "ti", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(2)
    items = [(i, text(rng, rng.randint(15, 60)) + ". " + text(rng, 4) + ".") for i in range(30)]
    items += [(None, None), (40, ""), (41, "?!"), (42, text(rng, 300))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, text(rng, rng.randint(0, 200)), "s") for i in range(150)]
    for i in range(30):
        words = items[i][1].split()
        rows.append((1000 + i, f"{text(rng, 40)} {items[i][1].upper()} {text(rng, 70)}", "s"))
        changed = [w if rng.random() > 0.08 else "zzz" for w in words]
        rows.append((2000 + i, f"{text(rng, 11)}\n{' '.join(changed)}\n{text(rng, 30)}", "s"))
    rows += [(3000, " ".join(items[-1][1].split()[60:140]), "s"), (3001, None, "s"), (3002, "", "s"), (None, items[0][1], "s"),
             (3003, text(rng, 70_000) + " " + items[1][1], "s"), (3003, items[2][1], "s")]
    return items, bench, rows


def test_planted_items_are_found_and_others_left(documents, case):
    items, bench, rows = case
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(documents(rows), bench).collect()}
    assert {(1000 + i, i) for i in range(30)} <= got
    assert len({(2000 + i, i) for i in range(30)} & got) >= 29
    assert {(None, 0), (3003, 1), (3003, 2), (3000, 42)} <= got
    assert all(d is None or d >= 1000 for d, _ in got) and len(got) <= 64
    kept = dc.without_items(documents(rows), bench)
    assert kept.columns == documents(rows).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _, _ in rows} - {d for d, _ in got}


def covered(item, words):
    """Whether VERBATIM of an item stands in a stretch of twice its length, by trying all of them."""
    return any(brute_common(item, words[i:i + 2 * len(item)]) >= dc.VERBATIM * len(item) for i in range(len(words)))


def test_every_copy_is_found_whatever_its_cosine(spark, documents, monkeypatch):
    """Short items, changed copies and long hosts; with the latent search alone some are never compared."""
    rng = random.Random(5)
    names = [text(rng, 1) for _ in range(4000)]
    items = [(i, " ".join(rng.choices(names, k=rng.randint(4, 25)))) for i in range(300)]
    rows = []
    for i, item in items:
        words = [w for w in item.split() if rng.random() > 0.08]
        around = rng.choices(names, k=60)
        rows.append((i, " ".join([*around[:rng.randint(20, 40)], *words, *around[40:]]), "s"))
    wanted = {i for (i, item), (_, t, _) in zip(items, rows) if covered(dc.words_of(item), dc.words_of(t))}
    bench = spark.createDataFrame(items, "item_id long, text string")

    def found():
        return {r["doc_id"] for r in dc.contaminated(documents(rows), bench).collect() if r["doc_id"] == r["item_id"]}

    assert wanted <= found() and len(wanted) > 250
    monkeypatch.setattr(dc, "COSINE", 2.0)  # the rare words alone
    assert wanted <= found()


def test_a_word_elsewhere_does_not_hide_a_copy():
    item = [b"w%d" % i for i in range(20)]
    copy = item[1:]  # its first word stands far before it
    words = [item[0]] + [b"x%d" % i for i in range(30)] + copy + [b"y"] * 10
    assert dc.common(item, words)[0] == 20
    assert dc.held(item, [], words, 0, len(words)) == (19, 31, 50, False)
    assert dc.held(item, [], words[:31] + copy[:10], 0, 41) is None


def test_every_near_verbatim_copy_is_found(documents, case):
    items, bench, rows = case
    planted = {d: dc.words_of(t) for d, t, _ in rows if d and 2000 <= d < 2030}
    wanted = {(d, d - 2000) for d, words in planted.items() if covered(dc.words_of(items[d - 2000][1])[:dc.ITEM_WORDS], words)}
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(documents(rows), bench).collect()}
    assert wanted <= got and len(wanted) >= 29


def test_models_of_a_large_benchmark(documents, case, monkeypatch):
    _, bench, rows = case
    monkeypatch.setattr(dc, "MODEL_PASSAGES", 40)
    got = {r["doc_id"] for r in dc.contaminated(documents(rows[150:]), bench).collect()}
    assert {1000 + i for i in range(30)} <= got


def test_basis_is_the_singular_one(spark):
    rng = random.Random(8)
    passages = spark.createDataFrame([(i, 0, [w.encode() for w in text(rng, 30).split()[:30]], []) for i in range(25)],
                                     "item_id long, passage long, words array<binary>, answer array<binary>").cache()
    rows = [[bytes(w) for w in r["words"]] for r in passages.collect()]
    names = sorted({w for r in rows for w in r})
    idf = {w: 1.0 + len(w) / 10 for w in names}
    matrix = np.array([[r.count(w) * idf[w] for w in names] for r in rows])
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    basis = dc.singular_basis(passages, idf, 20)
    v = np.array([basis[w] for w in names])
    assert np.allclose(v.T @ v, np.eye(20), atol=1e-6)
    best = np.linalg.svd(matrix)[2][:20].T
    assert np.linalg.norm(matrix @ v) > 0.99 * np.linalg.norm(matrix @ best)


def test_nothing_to_find(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents([(1, "some words", "s")])
    assert dc.contaminated(docs, none).count() == 0 and dc.without_items(docs, none).count() == 1
    some = spark.createDataFrame([(1, "a few words of it")], "item_id long, text string")
    assert dc.contaminated(documents([]), some).count() == 0


def test_changed_order_is_found_by_the_latent_search_alone(documents, spark, monkeypatch):
    """Items whose thirds changed places: no ordered share suffices, the cosine finds them; like words elsewhere stay."""
    rng = random.Random(12)
    names = [text(rng, 1) + str(i % 7) for i in range(3000)]
    items = [(i, " ".join(rng.sample(names, 24))) for i in range(40)]
    rows = [(500 + i, " ".join(rng.choices(names, k=120)), "s") for i in range(200)]
    for i, item in items:
        w = item.split()
        rows.append((i, " ".join([*rng.choices(names, k=40), *w[16:], *w[8:16], *w[:8], *rng.choices(names, k=40)]), "s"))
        scattered = rng.choices(names, k=200)
        scattered[::8] = w + ["x"]  # its words, too far apart
        rows.append((1000 + i, " ".join(scattered), "s"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.contaminated(documents(rows), bench).collect()
    assert {(r["doc_id"], r["item_id"], r["path"]) for r in got} == {(i, i, "latent") for i, _ in items}
    assert {r["doc_id"] for r in dc.without_items(documents(rows), bench).collect()} == {d for d, _, _ in rows if d >= 500}
    monkeypatch.setattr(dc, "COSINE", 2.0)
    assert dc.contaminated(documents(rows), bench).count() == 0


def test_reworded_against_all_windows():
    rng = random.Random(3)
    for _ in range(400):
        item = [b"%d" % rng.randrange(12) for _ in range(rng.randint(8, 12))]
        words = [b"%d" % rng.randrange(16) for _ in range(rng.randint(0, 60))]
        weights = {w: 1.0 + int(w) for w in set(item)}

        def share(window):
            return sum(min(item.count(w), window.count(w)) * weights[w] for w in set(item)) / sum(weights[w] for w in item)

        best = max((share(words[i:i + 2 * len(item)]) for i in range(len(words) or 1)), default=0)
        hit = dc.reworded(item, item, words, 0, len(words), weights)
        assert (hit is not None) == (best >= dc.REWORDED - 1e-12)
        if hit:
            assert share(words[hit[1]:hit[2]]) >= dc.REWORDED - 1e-9 and hit[2] - hit[1] <= 2 * len(item)


def test_scans_do_not_grow_with_the_benchmark(documents, case, monkeypatch):
    """Many models, repeated benchmark rows: words are counted once, and one pass searches for all."""
    _, bench, rows = case
    monkeypatch.setattr(dc, "MODEL_PASSAGES", 20)
    counted = []
    count = dc.passage_counts
    monkeypatch.setattr(dc, "passage_counts", lambda *a: counted.append(1) or count(*a))
    found = dc.contaminated(documents(rows[150:]), bench.union(bench).union(bench))
    assert counted == [1]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Union" not in plan
    pairs = [(r["doc_id"], r["item_id"]) for r in found.collect() if r["doc_id"] is not None and r["doc_id"] < 2000]
    assert sorted(pairs) == sorted(set(pairs)) and {(1000 + i, i) for i in range(30)} <= set(pairs)
