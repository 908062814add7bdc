import pytest
from pyspark.sql import functions as F

from surveyloom.llm import mixing


def brute_targets(sizes, most=3):
    """Share by weight, stop at the cap, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left, free = {}, float(sum(sizes.values())), set(names)
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] >= most * sizes[s]}
        if not over:
            return target | {s: unit * weight[s] for s in free}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= over
    return target


ROWS = (
    [(i, " ".join(f"w{j}" for j in range(i % 90)), f"s{i % 5}") for i in range(200)]
    + [(500 + i, "hot words here " * 40, "hot") for i in range(100)]
    + [(None, "an id is missing", None), (7, "same id again", "s1"), (7, "same id again", "s1"), (900, None, "s2"),
       (901, " \t\n", "s2"), (902, "x " * 3000, "long"), (903, "few", "tiny"), (904, None, "empty")]
)


@pytest.mark.parametrize("block", [16, 512])
def test_words_taken(documents, block):
    docs = documents(ROWS)
    got = mixing.words_taken(docs, block=block).collect()
    assert len(got) == len(ROWS)
    sizes = {}
    for _, t, s in ROWS:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets = brute_targets(sizes)
    by_target = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        key = (r["source_size"], round(r["target"], 6))
        by_target[key] = by_target.get(key, 0) + r["taken"]
    wanted = {}
    for s, target in targets.items():
        key = (sizes[s], round(target, 6))
        wanted[key] = wanted.get(key, 0) + int(target + 1e-9)
    assert by_target == wanted
    assert sorted(map(str, got)) == sorted(map(str, mixing.words_taken(docs, block=block).collect()))


def test_mixed_documents_hold_the_words_taken(documents):
    docs = documents(ROWS)
    taken = {}
    for r in mixing.words_taken(docs, block=16).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    got = mixing.mixed_documents(docs, block=16)
    assert got.columns == docs.columns
    words = {}
    texts = {}
    for i, t, _ in ROWS:
        texts.setdefault(i, set()).add(t)
    for r in got.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
        assert r["n_chars"] == len(r["text"]) and r["size"] == "x"
        assert any(t and (r["text"] == t or set(r["text"].split()) <= set(t.split())) for t in texts[r["doc_id"]])
    assert words == {k: v for k, v in taken.items() if v}


def test_slots_fill_shards(documents):
    pieces = mixing.mix(documents(ROWS), block=16, shard_slots=50)["pieces"]
    slots = pieces.select("shard", "slot_in_shard", "rank").distinct().collect()
    assert len(slots) == len({(r[0], r[1]) for r in slots})
    # every full shard draws from the large source, and shares vary as draws do
    hot = {}
    for shard, _, rank in slots:
        hot.setdefault(shard, []).append(rank)
    assert len({tuple(sorted(v)) for v in hot.values()}) > 1


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000])
def test_permutation_and_its_inverse(spark, size):
    df = spark.range(size).select("id", mixing.permuted(F.col("id"), F.lit(size), 5, 1).alias("there"))
    rows = df.select("id", "there", mixing.permuted(F.col("there"), F.lit(size), 5, 1, inverse=True).alias("back")).collect()
    assert sorted(r["there"] for r in rows) == list(range(size))
    assert all(r["id"] == r["back"] for r in rows)


def test_only_dataframe_functions(documents):
    plan = mixing.words_taken(documents(ROWS[:20]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_documents(documents):
    assert mixing.words_taken(documents([])).count() == 0
    assert mixing.mixed_documents(documents([])).count() == 0
    assert mixing.words_taken(documents([(1, None, None), (2, "", "a")])).select("taken").distinct().collect() == [(0,)]


def test_slots_are_never_broadcast(spark, documents):
    """However few bytes the chunks of slots have: exploded slots are merged by sorting, and made by many tasks."""
    pieces = mixing.mix(documents(ROWS), block=16)["pieces"]
    pieces.collect()
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan and "REPARTITION_BY_NUM" in plan


def test_shard_and_slot_of_each_document(documents):
    docs = documents(ROWS)
    by_start = {}
    for r in mixing.mix(docs, block=16, shard_slots=50)["pieces"].collect():
        key = (r["doc_id"], r["digest"])
        by_start[key] = min(by_start.get(key, (1 << 60, 0)), (r["shard"], r["slot_in_shard"]))
    got = [r for r in mixing.words_taken(docs, block=16, shard_slots=50).collect() if r["doc_id"] not in (7, None)]
    wanted = {i: at for (i, _), at in by_start.items() if i not in (7, None)}
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got if r["taken"]} == wanted
    assert all(r["shard"] is None for r in got if not r["taken"])


def test_written_mix_lies_in_shards(documents):
    """All rows of a shard are in one partition, in slot order."""
    docs = documents(ROWS)
    first = {}
    for r in mixing.mix(docs, block=16, shard_slots=50)["pieces"].collect():
        key = (r["doc_id"], r["epoch"])
        first[key] = min(first.get(key, (1 << 60, 0, 0)), (r["first"], r["shard"], r["slot_in_shard"]))
    places = {}
    for (doc, _), (_, shard, slot) in first.items():
        places.setdefault(doc, []).append((shard, slot))
    rows = mixing.mixed_documents(docs, block=16, shard_slots=50).select(
        "doc_id", F.spark_partition_id().alias("p")).collect()
    parts = {}
    for r in rows:
        if len(places[r["doc_id"]]) == 1 and r["doc_id"] not in (7, None):
            parts.setdefault(r["p"], []).append(places[r["doc_id"]][0])
    home = {}
    for p, own in parts.items():
        assert own == sorted(own)
        for shard, _ in own:
            assert home.setdefault(shard, p) == p
