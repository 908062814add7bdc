"""Longest-processing-time sharding of groups of equal texts."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.frames import buckets_for, stored, with_offsets


def place(loads: list[int], size: int, count: int) -> list[int]:
    """How many of `count` groups of equal `size` each shard gets when each goes to the least loaded one.

    The heap's picks are the `count` smallest of load + k * size. All below a level are found by bisection, so a
    class of a billion groups costs as little as one of ten; the heap deals out the rest. `loads` is updated.
    """
    counts = [0] * len(loads)
    if count > 4 * len(loads):
        def below(level: int) -> list[int]:
            return [max(0, -(-(level - load) // size)) for load in loads]

        low, high = min(loads), max(loads) + size * (count // len(loads) + 2)
        while low < high:  # the highest level with at most `count` picks below it
            middle = (low + high + 1) // 2
            low, high = (middle, high) if sum(below(middle)) <= count else (low, middle - 1)
        counts = below(low)
    heap = [(load + n * size, shard) for shard, (load, n) in enumerate(zip(loads, counts))]
    heapq.heapify(heap)
    for _ in range(count - sum(counts)):
        load, shard = heap[0]
        counts[shard] += 1
        heapq.heapreplace(heap, (load + size, shard))
    loads[:] = [load + n * size for load, n in zip(loads, counts)]
    return counts


def _schedule(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = [0] * shards
        for batch in batches:
            ends = []
            for size, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total, row = 0, []
                for n in place(loads, size, count):
                    row.append(total := total + n)
                ends.append(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ends, pa.list_(pa.int64()))], names=["group_bytes", "ends"])

    return run


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Put all documents into shards of nearly equal bytes; equal texts stay together.

    Groups of equal texts go, largest first, to the least loaded shard. Columns: doc_id, size (UTF-8 bytes plus 1),
    text_crc32, shard, slot (gapless from 0 in each shard). A null text counts as an empty one and shares its group;
    null or repeated ids are kept as they are; an empty table gives no rows. Other columns are not read.

    Text is read once and only digests travel. The schedule sees one row for each distinct group size: there are at
    most sqrt(2 * all bytes) of those (14 million at 100 TB), whatever the number of documents. A group that alone
    outweighs a fair share still stays whole, and is then the largest shard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.sha2(text, 256).alias("digest"),
    ), "shard-rows")
    buckets = buckets_for(slim.count())
    groups = slim.groupBy("digest").agg(F.sum("size").alias("group_bytes"))
    classes = groups.groupBy("group_bytes").count()
    ends = (classes.repartition(1).sortWithinPartitions(F.desc("group_bytes"))
            .mapInArrow(_schedule(shards), "group_bytes long, ends array<long>"))
    numbered = with_offsets(groups, ["group_bytes"], ["digest"], F.lit(1), buckets, "ordinal", repeats=False)
    placed = numbered.join(ends, "group_bytes").select(
        "digest", F.size(F.filter("ends", lambda end: end <= F.col("ordinal"))).alias("shard"))
    rows = slim.join(placed, "digest").select("doc_id", "size", "text_crc32", "shard", "digest")
    return with_offsets(
        stored(rows, "shard-places"), ["shard"], ["doc_id", "digest"], F.lit(1), buckets, "slot").select(
        "doc_id", "size", "text_crc32", "shard", "slot")
