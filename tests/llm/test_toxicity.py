import zlib
from itertools import combinations

import numpy as np
import pytest

from surveyloom.llm import toxicity

INSULTS = ("blarg", "snork", "grumph")


def brute_kernel(a, b):
    def features(word):
        out = {}
        for places in combinations(range(len(word)), toxicity.ORDER):
            gaps = places[-1] - places[0] + 1 - toxicity.ORDER
            if gaps <= toxicity.GAPS:
                key = "".join(word[i] for i in places)
                out[key] = out.get(key, 0.0) + toxicity.DECAY ** gaps
        return out

    x, y = features(a), features(b)
    norm = np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    return sum(v * y.get(k, 0.0) for k, v in x.items()) / norm if norm else 0.0


def test_kernel_is_the_gapped_one():
    words = ["\x02stupid\x03", "\x02stu-pid\x03", "\x02aaaaaa\x03", "\x02ab\x03", "\x02banana\x03", "\x02x\x03"]
    lut = toxicity.letters("abcdefghijklmnopqrstuvwxyz-")
    got = toxicity.kernel(words, words, lut)
    want = [[brute_kernel(a, b) for b in words] for a in words]
    assert np.allclose(got, want, atol=1e-5)


def corpus():
    rng = np.random.default_rng(0)
    syllables = ["an", "er", "th", "ing", "on", "ti", "re", "ha", "ou", "nd", "st", "ed"]
    rows, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice(syllables, rng.integers(1, 5))) for _ in range(rng.integers(5, 60))]
        toxic = i % 5 == 0
        for _ in range(3 if toxic else 0):
            words.insert(int(rng.integers(len(words))), str(rng.choice(INSULTS)))
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark, documents):
    rows, labels = corpus()
    known = spark.createDataFrame(labels + [(3, 1, None), (None, 1, 1), (10**6, 0, 1)], "doc_id long, quality int, toxic int")
    return rows, labels, toxicity.fit(documents(rows), known)


def test_held_out_accuracy(documents, fitted):
    rows, labels, model = fitted
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(documents(rows), model).collect()}
    held = [(i, y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((got[i] >= 0.5) == bool(y) for i, y in held) / len(held) > 0.97


def test_disguised_insults_and_odd_texts(documents, fitted):
    model = fitted[2]
    odd = {1: "the s n o r k and and re", 2: "that g.r.u.m.p.h there and", 3: "such a gru*mph on er", 4: "and ononon the ing",
           5: None, 6: "", 7: "an " * 60_000, 8: "x" * 5000, 9: "BLARG! blarg, re"}
    df = documents([(i, t, "s") for i, t in odd.items()] + [(None, "re on", "s"), (9, "an", "s")])
    got = toxicity.scored(df, model).collect()
    assert len(got) == 11 and all(0 <= r["score"] <= 1 for r in got)
    high = {r["doc_id"] for r in got if r["score"] >= 0.5}
    assert high == {1, 2, 3, 9}
    kept = df.where(toxicity.score_column(model) < 0.5)
    assert kept.columns == df.columns and kept.count() == 7


def test_shares():
    assert toxicity.shares([10, 10, 10], 60) == [10, 10, 10]
    assert toxicity.shares([100, 5, 40], 60) == [28, 5, 27]
    assert toxicity.shares([100, 100, 100], 60) == [20, 20, 20]
    assert toxicity.shares([0, 100, 0], 60) == [0, 60, 0]


def test_toxic_strings_do_not_push_out_clean_ones(spark, documents, monkeypatch):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(800):
        toxic = i % 2
        words = ["".join(rng.choice(list("bcdfgklmnprst"), 7)) for _ in range(220)]
        words[50:50] = ["blarg", "snork"] if toxic else ["the", "and"]
        rows.append((i, " ".join([*words, "common", "words"]), "s"))
        labels.append((i, 1, toxic))
    seen, fit_words = {}, toxicity.fit_words

    def spy(words, toxic, clean, share):
        seen.update(words=words, toxic=toxic, clean=clean)
        return fit_words(words, toxic, clean, share, rounds=1)

    monkeypatch.setattr(toxicity, "fit_words", spy)
    model = toxicity.fit(documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert len({w for (_, t, _), (_, _, y) in zip(rows, labels) if y for w in t.split()}) > toxicity.SAMPLE_WORDS
    toxic, clean = seen["toxic"], seen["clean"]
    assert len(set(seen["words"])) == len(seen["words"]) == toxicity.SAMPLE_WORDS
    assert (toxic == 0).sum() >= toxicity.SAMPLE_WORDS // 3 <= (clean == 0).sum()
    assert ((toxic > 0) & (clean > 0)).any() and model.text_weights is not None


def test_quick_margins_are_the_margins(fitted):
    model = fitted[2]
    lut, table = toxicity.letters(model.alphabet), model.table()
    words = [f"\x02{w}\x03" for t in (r[1] for r in fitted[0][:80]) for w in t.split()]
    quick, full = model.positive_margins(words, lut, table), model.margins(words, lut, table)
    assert np.allclose(np.maximum(quick, 0), np.maximum(full, 0), atol=1e-5) and (full > 0).any()


def test_without_labels_nothing_is_toxic(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents([(1, "blarg", "s"), (2, None, "s")])
    assert [r["score"] for r in toxicity.scored(docs, toxicity.fit(docs, none)).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.scored(documents([]), toxicity.fit(docs, one)).count() == 0


def test_an_id_with_both_labels_is_toxic(spark, documents):
    docs = documents([(i, f"text {i}", "s") for i in range(60)])
    labels = spark.createDataFrame([(i, t) for i in range(60) for t in ((0, 1) if i % 2 else (0,))], "doc_id long, toxic int")
    for rows in (labels, labels.orderBy("toxic"), labels.repartition(7)):
        got = {r["text"]: r["toxic"] for r in toxicity.sample(docs, rows).collect()}
        assert got and all(t == int(text.split()[1]) % 2 for text, t in got.items())
