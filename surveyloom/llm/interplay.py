"""How filters overlap: failure masks of documents, a Gray-code walk over all sets of filters, and steps of all orders."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.frames import stored

BLANK = r"[\x20\x09-\x0D]+"
#: More filters have more orders than a report can hold.
MOST_FILTERS = 7
COUNTS = ("n", "good", "toxic")


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions by letter, from the text and the array of its words."""
    n = F.size(words)
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part and mask of every row: bit i of the mask is set if the document fails the i-th of filters A to E.

    E fails a document whose text a smaller doc_id has as well, wherever in the table. A null text is empty, a null
    source is the part of the empty string; a row without doc_id neither fails E nor makes others fail it, and rows
    that share doc_id and text do not fail each other. Text is read once; what follows are ids and digests. The
    smallest id of a text comes from a combining aggregate and meets documents by digest and id, so copies of one
    text are dealt out by id however many there are.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"),
        F.filter(F.split(text, BLANK), lambda w: w != "").alias("words"))
    fails = text_filters(F.col("text"), F.col("words"))
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(fails.values())), F.lit(0))
    facts = stored(read.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")),
                   "filter-facts")
    firsts = facts.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn(
        "first", F.lit(True))
    later = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return facts.join(firsts, ["digest", "doc_id"], "left").select(
        "doc_id", "part", (F.col("mask") + F.when(later, 1 << len(fails)).otherwise(0)).alias("mask"))


def mask_cells(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part and mask: n, good (quality 1 in `labels`) and toxic. A repeated label counts if any row says 1."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    return failed.join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def survivors(cells: np.ndarray, filters: int) -> np.ndarray:
    """What survives each set of filters, from counts by mask: both are arrays (parts, 2 ** filters, counts).

    Sets come in Gray-code order, so each differs from the one before in one filter. Each mask keeps the number of
    active filters that it fails; masks whose number leaves or reaches 0 leave or join the running survivors.
    """
    masks = np.arange(1 << filters)
    failing = np.zeros(1 << filters, np.int64)
    running = cells.sum(axis=1)
    states = np.zeros_like(cells)
    active = 0
    states[:, active] = running
    for turn in range(1, 1 << filters):
        toggled = turn & -turn
        active ^= toggled
        touched = masks[masks & toggled > 0]
        if active & toggled:
            running = running - cells[:, touched[failing[touched] == 0]].sum(axis=1)
            failing[touched] += 1
        else:
            failing[touched] -= 1
            running = running + cells[:, touched[failing[touched] == 0]].sum(axis=1)
        states[:, active] = running
    return states


def order_table(letters: str) -> dict[str, np.ndarray | list[str]]:
    """One entry for each order of the letters and each step: the order, the step, its filter and the set before it."""
    rows = [("".join(order), k + 1, letters.index(f), sum(1 << letters.index(x) for x in order[:k]))
            for order in permutations(letters) for k, f in enumerate(order)]
    names, steps, filters, before = zip(*rows)
    return {"order": list(names), "step": np.array(steps), "filter": np.array(filters), "before": np.array(before)}


def order_audit(cells: DataFrame, letters: str) -> DataFrame:
    """The steps of all orders of the filters, for each part: one row per part, filter_order and step.

    kept, removed, redundant (fails the step's filter, removed earlier), unique_fails (fails only that filter),
    good_lost, toxic_lost, and shapley, the filter's removed summed over all orders. `cells` holds part, mask, n, good
    and toxic; a part has at most 2 ** filters of them, and many parts are walked at once. No parts, no rows.
    """
    size = len(letters)
    if not 0 < size <= MOST_FILTERS:
        raise ValueError(f"{size} filters; 1 to {MOST_FILTERS} can be audited")
    table = order_table(letters)
    step, which, before = table["step"], table["filter"], table["before"]
    whole = (1 << size) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                parts = batch.column(0).slice(low, 64)
                counts = np.zeros((len(parts), 1 << size, len(COUNTS)), np.int64)
                for i, found in enumerate(batch.column(1).slice(low, 64).to_pylist()):
                    for cell in found:
                        counts[i, cell["mask"]] = [cell[c] for c in COUNTS]
                states = survivors(counts, size)
                after = states[:, before | 1 << which]
                lost = states[:, before] - after
                alone = states[:, 0] [:, None, 0] - states[:, 1 << which, 0]  # all that fail the filter
                total = np.stack([lost[:, which == f, 0].sum(axis=1) for f in range(size)], axis=1)
                columns = {
                    "part": parts.take(pa.array(np.repeat(np.arange(len(parts)), len(step)))),
                    "filter_order": pa.array(table["order"] * len(parts)),
                    "step": pa.array(np.tile(step, len(parts)).astype(np.int32)),
                    "kept": after[..., 0], "removed": lost[..., 0], "redundant": alone - lost[..., 0],
                    "unique_fails": states[:, whole ^ 1 << which, 0] - states[:, [whole], 0],
                    "good_lost": lost[..., 1], "toxic_lost": lost[..., 2], "shapley": total[:, which],
                }
                yield pa.RecordBatch.from_pydict(
                    {k: pa.array(v.ravel()) if isinstance(v, np.ndarray) else v for k, v in columns.items()})

    listed = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))
    return listed.mapInArrow(run, (
        "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
        "good_lost long, toxic_lost long, shapley long"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All orders of the filters A to E over whole `docs` (doc_id, text, source), by part: see `order_audit`."""
    return order_audit(mask_cells(failures(docs), labels), "ABCDE")
