"""SimHash fingerprints, BK-trees over shards of fingerprints, and components of near documents."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.llm.frames import stored

#: Nodes of one BK-tree. A larger shard is cut into trees of this size, and its rows visit each of them.
TREE_ROWS = 4096
#: Rows that a task holds at a time.
BUFFER_ROWS = 50_000
#: (query, node) pairs that may be open at a time.
OPEN_PAIRS = 1_000_000
#: Shards should hold about so many fingerprints: more fingerprints use longer keys.
SHARD_ROWS = 16
HASH_SLICE = 1 << 16


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit majority of the XXH64 (seed 42) of all word shingles, repeats included, as a signed number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles, n = map(b" ".join, zip(*(words[i:] for i in range(width)))), len(words) - width + 1
    counts, left = np.zeros(64, np.int64), n
    while left > 0:
        size = min(left, HASH_SLICE)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, islice(shingles, size), repeat(42)), np.uint64, size)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
        left -= size
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int = 3, more: dict[str, Column] | None = None) -> DataFrame:
    """doc_id and fp (long) of every row of `docs`, and `more` columns of longs."""
    more = more or {}
    names = ["doc_id", "fp", *more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(text.as_py(), width) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), *batch.columns[2:]], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *(c.alias(n) for n, c in more.items())).mapInArrow(
        run, ", ".join(f"{n} long" for n in names))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def build_trees(group: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BK-trees of all groups at once: root node of each group, and children[node, distance] (-1: none).

    Nodes are rows of distinct `fp` in each group; `group` counts up from 0. All rows descend together: a row whose
    edge is free becomes that child, if it is the first to ask, else it follows the edge.
    """
    children = np.full((len(fp), 65), -1, np.int32)
    roots = np.flatnonzero(np.diff(group, prepend=-1))
    waiting = np.setdiff1d(np.arange(len(fp)), roots, assume_unique=True)
    at = roots[group[waiting]]
    while len(waiting):
        edge = distances(fp[waiting], fp[at])
        free = np.flatnonzero(children[at, edge] < 0)
        _, first = np.unique(at[free] * 65 + edge[free], return_index=True)
        placed = free[first]
        children[at[placed], edge[placed]] = waiting[placed]
        stay = np.ones(len(waiting), bool)
        stay[placed] = False
        waiting, at = waiting[stay], children[at, edge][stay]
    return roots, children


def search(start: np.ndarray, asked: np.ndarray, fp: np.ndarray, children: np.ndarray,
           radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query index, node) within `radius`; only edges within it of the query's distance are followed."""
    query, node = np.arange(len(asked)), start
    while len(query):
        apart = distances(asked[query], fp[node])
        near = apart <= radius
        if near.any():
            yield query[near], node[near]
        more_query, more_node = [], []
        for edge in (apart + step for step in range(-radius, radius + 1)):
            there = np.flatnonzero((edge > 0) & (edge <= 64))
            child = children[node[there], edge[there]]
            more_query.append(query[there][child >= 0])
            more_node.append(child[child >= 0])
        query, node = np.concatenate(more_query), np.concatenate(more_node)


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give all rows joined by links (a, b) the smallest label among them; `label` is a forest of row numbers."""
    while True:
        one, two = label[a], label[b]
        differ = one != two
        if not differ.any():
            return
        a, b, one, two = a[differ], b[differ], one[differ], two[differ]
        np.minimum.at(label, np.maximum(one, two), np.minimum(one, two))
        while (label != label[label]).any():
            label[:] = label[label]


def _links(radius: int):
    """Rows come by (band, key, part), tree rows first; out go links that join what is near within each part."""
    def spanning(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        fp, tree = rows["fp"].view(np.uint64), rows["tree"]
        change = np.zeros(len(fp), bool)
        change[0] = True
        for name in ("band", "key", "part"):
            change[1:] |= rows[name][1:] != rows[name][:-1]
        group = np.cumsum(change) - 1
        nodes, label = np.flatnonzero(tree), np.arange(len(fp))
        roots, children = build_trees(group[nodes], fp[nodes])
        asks = np.flatnonzero(rows["ask"])
        open_pairs = np.cumsum(np.bincount(group[nodes])[group[asks]])
        for piece in np.split(asks, np.searchsorted(open_pairs, np.arange(OPEN_PAIRS, open_pairs[-1] if len(
                asks) else 0, OPEN_PAIRS))):
            for query, node in search(roots[group[piece]], fp[piece], fp[nodes], children, radius):
                unite(label, piece[query], nodes[node])
        linked = np.flatnonzero(label != np.arange(len(fp)))
        return rows["fp"][linked], rows["fp"][label[linked]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        names = ("band", "key", "part", "fp", "tree", "ask")

        def out(rows):
            a, b = spanning(rows)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            new = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in names[:5]}
            new["ask"] = np.ones(len(new["fp"]), bool)
            held = new if held is None else {n: np.concatenate([held[n], new[n]]) for n in names}
            if len(held["fp"]) < BUFFER_ROWS:
                continue
            # whole groups, or of one group that fills the buffer all that has come, go; its tree stays for the rest
            last = (held["band"] == held["band"][-1]) & (held["key"] == held["key"][-1]) & (
                held["part"] == held["part"][-1])
            whole = last.all()
            if whole and held["tree"][-1]:
                continue
            yield out(held if whole else {n: v[~last] for n, v in held.items()})
            keep = last & held["tree"] if whole else last
            held = {n: v[keep] for n, v in held.items()}
            if whole:
                held["ask"] = np.zeros(len(held["fp"]), bool)
        if held is not None and len(held["fp"]):
            yield out(held)

    return run


def shard_masks(rows: int, radius: int) -> list[int]:
    """Bit masks of which every pair within `radius` agrees on one at least.

    64 bits are cut into `blocks` runs; `radius` flips leave blocks - radius runs whole, so all choices of that many
    runs are keys. More runs make longer keys and more of them; the count of rows decides.
    """
    for blocks in range(radius + 1, radius + 5):
        bits = 64 * (blocks - radius) // blocks
        if rows <= SHARD_ROWS << bits:
            break
    ends = [64 * i // blocks for i in range(blocks + 1)]
    runs = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(ends, ends[1:])]
    masks = [sum(choice) for choice in combinations(runs, blocks - radius)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def near_links(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints `fp` within `radius` bits into the same components.

    Every pair within the radius shares a shard (see `shard_masks`). A shard's BK-tree is built once in the task that
    holds the shard, next to the rows that ask it; since neither side has a proven size, trees are co-located by the
    shuffle and not broadcast. A shard over TREE_ROWS is cut into trees of about that size; a row visits the trees up to
    its own, so each pair still meets once and no task holds more than a tree and a buffer. From each tree come
    links to one row per component, at most one per row, never all pairs.
    """
    masks = shard_masks(nodes.count(), radius)
    keyed = nodes.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in masks)))).select(
        F.col("pos").alias("band"), F.col("col").alias("key"), "fp")
    sizes = keyed.groupBy("band", "key").count()
    shared = keyed.join(sizes.where("count > 1"), ["band", "key"])
    trees = F.ceil(F.col("count") / TREE_ROWS).cast("long")
    own = shared.withColumn("own", F.pmod(F.xxhash64("fp", F.lit(1)), trees))
    rows = own.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), "own"))).select(
        "band", "key", "part", "fp", (F.col("part") == F.col("own")).alias("tree"))
    return (rows.repartition("band", "key", "part").sortWithinPartitions("band", "key", "part", F.desc("tree"))
            .mapInArrow(_links(radius), "a long, b long"))


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of every node in `links` (a, b).

    Alternates large stars and small stars until the links no longer change; each round is written to the shared
    folder. Links shrink to one per node, and a hub's links are split by adaptive execution like any skewed join.
    """
    def low(links: DataFrame) -> DataFrame:
        return links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))

    def state(links: DataFrame) -> tuple:
        return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())

    links = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(),
                   "links")
    before = None
    while (now := state(links)) != before:
        before = now
        both = links.union(links.select("v", "u"))
        large = both.join(low(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = stored(large.distinct(), "links")
        mins = low(large)
        small = (large.join(mins, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(mins.select("u", F.col("m").alias("v"))))
        links = stored(small.where("u <> v").distinct(), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def roots_of(rows: DataFrame, radius: int) -> DataFrame:
    """fp and root of every distinct `fp` in `rows`: the root is the component's smallest fingerprint, as a long."""
    nodes = stored(rows.select("fp").distinct(), "fingerprint-nodes")
    roots = components(near_links(nodes, radius))
    return nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_documents(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """One row per document: doc_id, fp (long) and component_id, the smallest doc_id it reaches through links.

    Documents whose fingerprints differ in at most `radius` bits are linked. A null or empty text has fingerprint 0
    and is linked like any other; repeated rows have their own rows here; a null doc_id never names a component, so
    component_id is null only where a component has no other id. An empty table gives no rows.
    """
    rows = stored(fingerprints(docs, width), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-nodes")
    roots = components(near_links(nodes.select("fp"), radius))
    tied = nodes.join(roots, nodes.fp == roots.node).select("fp", "root", "first_id")
    names = tied.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = tied.join(names, "root").select("fp", "component_id")
    alone = nodes.join(named.select("fp"), "fp", "left_anti").select("fp", F.col("first_id").alias("component_id"))
    return rows.join(named.union(alone), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """The documents, one of each component: that with the smallest doc_id (nulls last), then by fingerprint and text.

    A row is known by its doc_id and a digest of its text, so unlike texts under one doc_id are apart, and copies
    without doc_id are one component. Of rows that agree in both, one is kept, whatever other columns say.
    """
    # the keys are never null, so the join and the choice among repeated rows share one shuffle of the documents
    keys = {"__k": F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")), "__a": F.xxhash64("text"),
            "__b": F.xxhash64(F.lit(1), "text")}
    rows = stored(fingerprints(docs, width, keys), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("__n"), "doc_id", "fp", *keys)
    placed = rows.groupBy("fp").agg(F.min(row).alias("best")).join(roots_of(rows, radius), "fp")
    names = ["__n", *keys]
    best = stored(placed.groupBy("root").agg(F.min("best").alias("best")).select(
        *(F.col(f"best.{n}").alias(n) for n in names)), "survivors")
    kept = docs.withColumns({"__n": F.col("doc_id").isNull(), **keys}).join(best, names, "left_semi")
    first = Window.partitionBy(*names).orderBy("__a")
    return kept.withColumn("__row", F.row_number().over(first)).where("__row = 1").select(*docs.columns)
