"""Exact top-k search: term-at-a-time accumulation over all vectors, in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.llm.frames import stored

#: Queries of a block, and candidates that are scored together; scores are kept for TILE candidates and QUERY_TILE
#: queries at a time, which a core's cache holds.
QUERY_BLOCK = 4096
ROW_BLOCK = 2048
TILE, QUERY_TILE = 512, 256
#: A group of candidates streams past a block of queries, block by block: a GROUPS-th of all, but ROW_BLOCK to ROW_GROUP.
GROUPS, ROW_GROUP = 8, 1 << 16


def whole_components(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component x as double; what passes a long stops at its end."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def usable(vector: Column) -> Column:
    """Neither null nor holding a null, NaN or infinite component."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def postings(vectors: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of all components that are not zero, by term."""
    flat = vectors.combine_chunks()
    weights = flat.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(flat.offsets.to_numpy())
    rows = np.repeat(np.arange(len(lengths)), lengths)
    terms = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    there = np.flatnonzero(weights)
    there = there[np.argsort(terms[there], kind="stable")]
    return rows[there], terms[there], weights[there]


def highest(terms: np.ndarray, weights: np.ndarray, n_terms: int) -> np.ndarray:
    """The largest absolute weight of each term, as exact numbers; postings are sorted by term."""
    top = np.zeros(n_terms, object)
    if len(terms):
        there, starts = np.unique(terms, return_index=True)
        low = np.minimum.reduceat(weights, starts).astype(object)
        top[there] = np.maximum(np.maximum.reduceat(weights, starts).astype(object), -low)
    return top


def best(query_ids: np.ndarray, queries: tuple, ids: np.ndarray, rows: tuple, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores), k by queries: the highest scores of candidates with ascending `ids`; place -1 is none.

    Each term's postings are added, weighted by the queries' components, to a dense array of scores for a tile of
    candidates and of queries; k of each tile are selected by partition and merged with those so far. Ties go to the
    earlier place.
    """
    q_row, q_term, q_weight = queries
    c_row, c_term, c_weight = rows
    n_terms = max(1, 1 + max(q_term.max(initial=-1), c_term.max(initial=-1)))
    peak = int((highest(q_term, q_weight, n_terms) * highest(c_term, c_weight, n_terms)).sum())
    kind = np.int32 if peak < 1 << 31 else np.int64 if peak < 1 << 62 else object
    key_kind = np.int64 if peak * TILE < 1 << 61 else object
    dense = np.zeros((n_terms, len(query_ids)), kind)
    dense[q_term, q_row] = q_weight.astype(kind)
    weight = c_weight.astype(kind)
    columns = [slice(at, at + QUERY_TILE) for at in range(0, len(query_ids), QUERY_TILE)]
    found = [(np.full((0, len(query_ids[c])), -1, np.int64), np.zeros((0, len(query_ids[c])), kind)) for c in columns]
    tile_of = c_row // TILE
    for tile in range(-(-len(ids) // TILE)):
        low, high_row = tile * TILE, min(len(ids), (tile + 1) * TILE)
        place = np.arange(high_row - low)[:, None]
        mine = np.flatnonzero(tile_of == tile)
        terms, starts = np.unique(c_term[mine], return_index=True)
        postings_of = [(t, c_row[p] - low, weight[p][:, None]) for t, p in zip(terms, np.split(mine, starts[1:]))]
        for i, column in enumerate(columns):
            scores = np.zeros((high_row - low, len(query_ids[column])), kind)
            for term, at, gain in postings_of:
                if len(at) == len(scores):
                    scores += gain * dense[term, column]  # rows ascend within a term
                else:
                    scores[at] += gain * dense[term, column]
            own = ids[low:high_row, None] == query_ids[None, column]
            keys = scores.astype(key_kind) * TILE + (TILE - 1 - place)
            keys[own] = np.iinfo(np.int64).min if key_kind is np.int64 else -(1 << 200)
            if len(scores) > k:
                chosen = np.sort(np.argpartition(keys, len(scores) - k, axis=0)[len(scores) - k:], axis=0)
            else:
                chosen = np.broadcast_to(place, scores.shape)
            places = np.where(np.take_along_axis(own, chosen, 0), -1, chosen + low)
            both = (np.concatenate([found[i][0], places]),
                    np.concatenate([found[i][1], np.take_along_axis(scores, chosen, 0)]))
            order = np.argsort(-both[1], axis=0, kind="stable")
            none = np.take_along_axis(both[0] < 0, order, 0)
            order = np.take_along_axis(order, np.argsort(none, axis=0, kind="stable"), 0)[:k]
            found[i] = np.take_along_axis(both[0], order, 0), np.take_along_axis(both[1], order, 0)
    return np.concatenate([f[0] for f in found], axis=1), np.concatenate([f[1] for f in found], axis=1)


def past(excess: int) -> list[int] | None:
    """What an exact score has beyond the long that shows it, as longs that sort as it does (None: nothing)."""
    low = (1 << 45) - 1
    return [excess >> 90, excess >> 45 & low, excess & low] if excess else None


class Search:
    """A block of queries and the `k` best candidates of each among the rows seen so far."""

    def __init__(self, k: int):
        self.k = k
        self.asked: list[pa.RecordBatch] = []
        self.rows: list[pa.RecordBatch] = []
        self.waiting = 0
        self.queries: tuple | None = None
        self.found: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None  # ids, scores, whether there is one

    def see(self, rows: pa.RecordBatch) -> None:
        for at in range(0, rows.num_rows, ROW_BLOCK):
            self.rows.append(rows.slice(at, ROW_BLOCK))
            self.waiting += self.rows[-1].num_rows
            if self.waiting >= ROW_BLOCK:
                self.score()

    def score(self) -> None:
        if self.queries is None:
            asked = pa.Table.from_batches(self.asked)
            self.asked = []
            self.queries = asked["vec_id"].to_numpy(), asked["variant"].to_numpy(), postings(asked["parts"])
        rows = pa.Table.from_batches(self.rows).sort_by("vec_id")
        self.rows, self.waiting = [], 0
        ids = rows["vec_id"].to_numpy()
        places, scores = best(self.queries[0], self.queries[2], ids, postings(rows["parts"]), self.k)
        fresh = ids[places], scores, places >= 0
        if self.found is not None:
            fresh = tuple(np.concatenate(both) for both in zip(self.found, fresh))
        order = np.argsort(fresh[0], axis=0, kind="stable")
        for key in -fresh[1], ~fresh[2]:
            order = np.take_along_axis(order, np.argsort(np.take_along_axis(key, order, 0), axis=0, kind="stable"), 0)
        self.found = tuple(np.take_along_axis(x, order[:self.k], 0) for x in fresh)

    def result(self) -> pa.RecordBatch | None:
        if self.rows and (self.asked or self.queries):
            self.score()
        if self.found is None:
            return None
        ids, scores, there = self.found
        query_ids, variants, _ = self.queries
        exact, ends = scores[there], np.iinfo(np.int64)
        shown = np.clip(exact, ends.min, ends.max)
        beyond = [past(x - s) for x, s in zip(exact, shown)] if exact.dtype == object else [None] * len(exact)
        return pa.RecordBatch.from_arrays([
            pa.array(np.broadcast_to(query_ids, ids.shape)[there]), pa.array(np.broadcast_to(variants, ids.shape)[there]),
            pa.array(ids[there]), pa.array(shown.astype(np.int64)), pa.array(beyond, pa.list_(pa.int64())),
        ], names=["query_id", "variant", "vec_id", "score", "past"])


def top_k(vectors: DataFrame, queries: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """For each query row the `k` highest inner products with all other rows: query_id, rank, vec_id, score.

    Input columns are vec_id and embedding; components become floor(scale * x), and missing trailing ones count as 0.
    `queries` picks query rows. Rows without vec_id, and vectors that are null or hold a null or a non-finite
    component, take no part. A row never meets rows with its own vec_id; other repeated rows are candidates each, and
    an equal query row asks once. Ranks go by the exact integer score, ties to the smaller vec_id; a score beyond a long
    is ranked as it is and shown as the long's end. No rows, no result.

    Queries are numbered by place into blocks of fixed size, candidates into groups that stream past a block of queries,
    so a task's memory is that of two blocks whatever repeats. All pairs are scored, none are emitted but the best of
    each group; a query's last merge reads `k` rows per group. A row is copied to each block of queries, a query to each
    group of rows.
    """
    rows = stored(vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(queries, F.lit(False)).alias("asks"),
        whole_components(F.col("embedding"), scale).alias("parts"), F.monotonically_increasing_id().alias("place"),
    ), "vectors")
    asked = stored(rows.where("asks").select("vec_id", "parts").distinct().withColumn(
        "place", F.monotonically_increasing_id()), "query-vectors")
    n = rows.count()
    row_groups = -(-n // min(ROW_GROUP, max(ROW_BLOCK, n // GROUPS))) or 1
    query_blocks = -(-asked.count() // QUERY_BLOCK) or 1
    # a place holds the partition and the row in it; both together spread evenly over the blocks
    def dealt(blocks: int) -> Column:
        return F.pmod(F.col("place") + F.shiftright("place", 33), F.lit(blocks))

    def each(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))

    left = asked.select(dealt(query_blocks).alias("q"), each(row_groups).alias("c"), F.lit(1).cast("long").alias("asks"),
                        "vec_id", F.xxhash64("parts").alias("variant"), "parts")
    right = rows.select(each(query_blocks).alias("q"), dealt(row_groups).alias("c"), F.lit(0).cast("long").alias("asks"),
                        "vec_id", F.lit(0).cast("long").alias("variant"), "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, search = None, Search(k)
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)  # q, c, asks
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if here != tuple(keys[a, :2]):
                    if (out := search.result()) is not None:
                        yield out
                    here, search = tuple(keys[a, :2]), Search(k)
                part = batch.slice(a, b - a)
                if keys[a, 2]:
                    search.asked.append(part)
                elif search.asked or search.queries:
                    search.see(part)
        if (out := search.result()) is not None:
            yield out

    # a group's queries come before its rows
    found = left.unionByName(right).repartition("q", "c").sortWithinPartitions("q", "c", F.desc("asks")).mapInArrow(
        run, "query_id long, variant long, vec_id long, score long, past array<long>")
    none = F.array(*[F.lit(0).cast("long")] * 3)
    order = Window.partitionBy("query_id", "variant").orderBy(
        F.desc("score"), F.desc(F.coalesce("past", none)), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
