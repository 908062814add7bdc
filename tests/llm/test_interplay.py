import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from surveyloom.llm import interplay


def brute(rows, labels):
    """Every order applied to the documents one step after another."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    smallest = {}
    for d, t, _ in rows:
        if d is not None:
            smallest[t or ""] = min(d, smallest.get(t or "", d))
    fails = []
    for d, t, s in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        caps = sum("A" <= c <= "Z" for c in t)
        found = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * caps > 2 * len(t),
                 "D": bool(set(t) & set("#$%&*|")), "E": d is not None and smallest[t] < d}
        fails.append((s or "", d, {f for f in found if found[f]}))
    out = {}
    for part in {p for p, _, _ in fails}:
        own = [(d, f) for p, d, f in fails if p == part]
        total = Counter()
        steps = []
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [(d, x) for d, x in left if f in x]
                left = [(d, x) for d, x in left if f not in x]
                total[f] += len(gone)
                steps.append((order, step, f, [len(left), len(gone), sum(f in x for _, x in own) - len(gone), sum(
                    x == {f} for _, x in own), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]))
        out |= {(part, "".join(order), step): (*found, total[f]) for order, step, f, found in steps}
    return out


LONG = " ".join(f"w{i}" for i in range(300))
ROWS = (
    [(i, f"{LONG} {i}" if i % 3 else f"few words {i}", f"s{i % 2}") for i in range(12)]
    + [(20 + i, "Copied " * 30, "hot") for i in range(40)] + [(70 + i, LONG + " $", f"s{i % 2}") for i in range(6)]
    + [(None, LONG, "s0"), (None, LONG, "s0"), (90, LONG, "s0"), (91, LONG, "s1"), (91, LONG, "s1"), (91, "other", "s1"),
       (92, None, None), (93, "", ""), (94, "x " * 60_000, "long"), (95, "ÄÖÜ ABC", "s1"), (96, " \t\n\x0b ", None),
       (97, "no\xa0blank here", "s0"), (98, "CAPS", "only")]
)
LABELS = [(1, 1, 0), (1, 0, 1), (20, 1, None), (25, 0, 1), (71, 1, 1), (92, 1, 0), (None, 1, 1), (91, 1, 1), (5000, 1, 1)]


def test_every_order_against_one_step_after_another(spark, documents):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS part")
    got = interplay.filter_audit(documents(ROWS), labels).collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got}
    assert len(found) == len(got) == 600 * 6 and found == brute(ROWS, LABELS)


def test_empty_tables(spark, documents):
    docs, labels = documents(ROWS), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interplay.filter_audit(docs.limit(0), labels).count() == 0
    assert {r["good_lost"] + r["toxic_lost"] for r in interplay.filter_audit(docs, labels).collect()} == {0}


@pytest.mark.parametrize("size", range(1, 7))
def test_walk_against_each_set_by_itself(size):
    cells = np.random.default_rng(size).integers(0, 50, (3, 1 << size, 2))
    states = interplay.survivors(cells, size)
    for active in range(1 << size):
        left = [m for m in range(1 << size) if not m & active]
        assert (states[:, active] == cells[:, left].sum(axis=1)).all()


def test_copies_are_not_dealt_by_their_text(documents):
    """The largest shuffled group of documents is one id, not one text."""
    plan = interplay.failures(documents(ROWS))._jdf.queryExecution().toString()
    assert "hashpartitioning(digest" in plan and plan.count("Window") == 0
    assert re.search(r"Join LeftOuter, .*digest.* AND .*doc_id", plan)
