"""Approximate nearest neighbours: parts learned from a balanced neighbour graph, a classifier that routes, reranking."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.llm.frames import matrix, stored
from surveyloom.llm.topk import usable

#: Rows, and numbers in them, that parts and classifier are learned from at most; every row is indexed.
SAMPLE_ROWS = 16_384
SAMPLE_VALUES = 1 << 23
MAX_PARTS = 256
#: Graph neighbours of a sample row, and how far a part may pass its even share.
NEIGHBOURS = 20
SLACK = 0.05
HIDDEN = 96
#: Share of the neighbours of held-out sample rows that the probed parts must hold.
RECALL = 0.94
#: Queries and candidates of one group of the search, and candidates that are scored at a time.
QUERY_BLOCK = 1024
ROW_BLOCK = 1 << 17
TILE = 2048
PAIRS = 1 << 14


class Net(NamedTuple):
    """A linear map and one hidden layer: logits of the parts for a direction."""

    straight: np.ndarray
    into: np.ndarray
    offset: np.ndarray
    out: np.ndarray
    base: np.ndarray

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.into + self.offset, 0)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return x @ self.straight + self.hidden(x) @ self.out + self.base


class Index(NamedTuple):
    """`place` puts rows into parts, `route` gives queries the odds of parts; parts are probed up to `mass` of them."""

    place: Net
    route: Net
    mass: float


def directions(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def softmax(logits: np.ndarray) -> np.ndarray:
    grown = np.exp(logits - logits.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, scaled: np.ndarray, k: int) -> np.ndarray:
    """For each direction the sample rows of largest inner product with it, itself left out."""
    found = []
    for low in range(0, len(x), 512):
        near = x[low: low + 512] @ scaled.T
        near[np.arange(len(near)), np.arange(low, low + len(near))] = -np.inf
        found.append(np.argpartition(near, len(x) - k, axis=1)[:, len(x) - k:])
    return np.concatenate(found)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """A part for each row, of even size but for SLACK, that cuts few edges of the graph.

    Rows are first halved again and again at the median of their principal direction. Then rows move, largest gain
    first, to the part that holds most of their neighbours, while it has room and their own keeps its least size.
    """
    label = np.zeros(len(x), np.int64)
    halves = 1
    while halves < parts:
        for part in range(halves):
            rows = np.flatnonzero(label == part)
            off = x[rows] - x[rows].mean(axis=0)
            axis = np.linalg.eigh(off.T @ off)[1][:, -1]
            order = np.argsort(off @ axis, kind="stable")
            label[rows[order[len(rows) // 2:]]] += halves
        halves *= 2
    rows, k = graph.shape
    most = int(np.ceil(rows / parts * (1 + SLACK)))
    least = int(rows / parts * (1 - SLACK))
    a, b = np.repeat(np.arange(rows), k), graph.ravel()
    for _ in range(rounds):
        votes = (np.bincount(a * parts + label[b], minlength=rows * parts)
                 + np.bincount(b * parts + label[a], minlength=rows * parts)).reshape(rows, parts)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(rows), best] - votes[np.arange(rows), label]
        sizes = np.bincount(label, minlength=parts)
        moved = 0
        for row in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())]:
            if sizes[best[row]] < most and sizes[label[row]] > least:
                sizes[label[row]] -= 1
                sizes[best[row]] += 1
                label[row] = best[row]
                moved += 1
        if not moved:
            break
    return label


def trained(net: Net, x: np.ndarray, target: np.ndarray, seed: int, steps: int = 700, batch: int = 256) -> Net:
    """The net after Adam steps on the cross-entropy to `target` (rows of odds)."""
    rng = np.random.default_rng(seed)
    weights = [w.astype(np.float32) for w in net]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(x), batch)
        now = Net(*weights)
        h = now.hidden(x[rows])
        error = (softmax(now.logits(x[rows])) - target[rows]) / batch
        back = (error @ now.out.T) * (h > 0)
        slopes = [x[rows].T @ error, x[rows].T @ back, back.sum(axis=0), h.T @ error, error.sum(axis=0)]
        rate = 0.01 * min(1.0, 2 * (1 - step / steps) + 0.02)
        for i, slope in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.999 * second[i] + 0.001 * slope * slope
            change = first[i] / (1 - 0.9 ** step) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
            weights[i] = weights[i] - rate * change - 1e-4 * rate * weights[i] * (i != 4)
    return Net(*weights)


def blank_net(dims: int, parts: int, seed: int = 5) -> Net:
    rng = np.random.default_rng(seed)
    return Net(np.zeros((dims, parts), np.float32), (rng.normal(size=(dims, HIDDEN)) * (2 / dims) ** 0.5).astype(np.float32),
               np.zeros(HIDDEN, np.float32), (rng.normal(size=(HIDDEN, parts)) * 0.01).astype(np.float32),
               np.zeros(parts, np.float32))


def learn(sample: np.ndarray, parts: int) -> Index:
    """Learn an index from sample vectors: graph, balanced parts, a net that places rows, and a net that routes queries.

    The first net learns the parts of a row and its neighbours, from its direction; rows, in the sample as elsewhere,
    lie in the part it finds likeliest. The second goes on from it and learns where the neighbours of a direction lie
    so. A tenth of the sample is kept out of the learning; the odds that must be probed are set on its neighbours.
    """
    sample = np.unique(sample, axis=0)
    x = directions(sample)
    size = np.linalg.norm(sample, axis=1)
    order = np.random.default_rng(3).permutation(len(x))
    x, size = x[order], size[order]
    scaled = x * (size / size.max())[:, None].astype(np.float32)
    k = min(NEIGHBOURS, len(x) - 1)
    graph = neighbour_graph(x, scaled, k)
    own = balanced_parts(x, graph, parts)
    kept_out = max(1, len(x) // 10)
    learn_from = slice(kept_out, None)

    def odds(labels: np.ndarray, near: np.ndarray) -> np.ndarray:
        flat = np.repeat(np.arange(len(near)), near.shape[1]) * parts + labels[near].ravel()
        return (np.bincount(flat, minlength=len(near) * parts).reshape(len(near), parts) / near.shape[1]).astype(np.float32)

    itself = np.eye(parts, dtype=np.float32)[own]
    place = trained(blank_net(x.shape[1], parts), x[learn_from], (itself + odds(own, graph))[learn_from] / 2, seed=1)
    lies = place.logits(x).argmax(axis=1)
    target = odds(lies, graph)
    route = trained(place, x[learn_from], target[learn_from], seed=2)
    chances = softmax(route.logits(x[:kept_out]).astype(np.float64))
    ranked = np.argsort(-chances, axis=1)
    before = np.cumsum(np.take_along_axis(chances, ranked, 1), axis=1) - np.take_along_axis(chances, ranked, 1)
    held = np.take_along_axis(target[:kept_out], ranked, 1)
    # parts are probed while the odds before them are below the mass: the least mass whose parts hold enough
    at = np.argsort(before.ravel(), kind="stable")
    share = np.cumsum(held.ravel()[at]) / held.sum()
    enough = min(int(np.searchsorted(share, RECALL)), len(at) - 1)
    return Index(place, route, float(np.nextafter(before.ravel()[at][enough], 2.0)))


def probed(index: Index, x: np.ndarray) -> list[np.ndarray]:
    """The parts that each query asks, likeliest first."""
    chances = softmax(index.route.logits(directions(x)).astype(np.float64))
    ranked = np.argsort(-chances, axis=1, kind="stable")
    inorder = np.take_along_axis(chances, ranked, 1)
    count = ((np.cumsum(inorder, axis=1) - inorder) < index.mass).sum(axis=1)
    return [parts[:n] for parts, n in zip(ranked, count)]


class Search:
    """Best `k` of the candidates that stream by, for each of a block of queries; scores are exact double products.

    A tile of candidates is scored at once by a matrix product, whose last bits hang on where a row stands. Whatever
    comes within rounding of a query's k-th best is scored again by one fixed summation, so that equal vectors tie.
    """

    def __init__(self, k: int):
        self.k, self.asked, self.rows = k, [], []
        self.best: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def ask(self, ids: np.ndarray, variants: np.ndarray, x: np.ndarray) -> None:
        self.asked.append((ids, variants, x))

    def see(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.rows.append((ids, x))
        if sum(len(r[0]) for r in self.rows) >= TILE:
            self.score()

    def score(self) -> None:
        if self.best is None:
            self.ids, self.variants, self.x = (np.concatenate(part) for part in zip(*self.asked))
            self.norms = np.linalg.norm(self.x, axis=1)
            self.best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        ids, x = (np.concatenate(part) for part in zip(*self.rows))
        self.rows = []
        for low in range(0, len(ids), TILE):
            self._tile(*self._different(ids[low: low + TILE], x[low: low + TILE]))

    def _different(self, ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of equal vectors those with the k + 1 smallest ids: a query passes over one id, and smaller ids win ties."""
        _, kind = np.unique(np.ascontiguousarray(x + 0.0).view([("", np.void, x.shape[1] * 8)]).ravel(),
                            return_inverse=True)
        order = np.lexsort((ids, kind))
        kind, sorted_ids = kind[order], ids[order]
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (kind[1:] != kind[:-1]) | (sorted_ids[1:] != sorted_ids[:-1])
        rank = np.cumsum(fresh)
        first = np.flatnonzero(np.diff(kind, prepend=-1))
        rank -= np.repeat(rank[first], np.diff(np.append(first, len(kind))))
        keep = np.sort(order[rank <= self.k])
        return ids[keep], x[keep]

    def _tile(self, ids: np.ndarray, x: np.ndarray) -> None:
        near = self.x @ x.T
        near[self.ids[:, None] == ids[None, :]] = -np.inf
        floor = np.full(len(self.ids), -np.inf)
        if len(ids) > self.k:
            floor = np.partition(near, len(ids) - self.k, axis=1)[:, len(ids) - self.k]
        row, _, score = self.best
        full = np.bincount(row, minlength=len(self.ids)) == self.k
        last = np.zeros(len(self.ids))
        last[row] = score  # rows are sorted from best to last
        floor = np.where(full, np.maximum(floor, last), floor)
        room = 1e-12 * self.norms * np.linalg.norm(x, axis=1).max(initial=0)
        q, c = np.nonzero((near >= (floor - room)[:, None]) & (near > -np.inf))
        exact = [(self.x[q[at: at + PAIRS]] * x[c[at: at + PAIRS]]).sum(axis=1) for at in range(0, len(q), PAIRS)]
        row = np.concatenate([row, q])
        found = np.concatenate([self.best[1], ids[c]])
        score = np.concatenate([score, *exact])
        order = np.lexsort((found, -score, row))
        row, found, score = row[order], found[order], score[order]
        first = np.searchsorted(row, np.arange(len(self.ids)))
        keep = np.arange(len(row)) - first[row] < self.k
        self.best = row[keep], found[keep], score[keep]

    def result(self) -> pa.RecordBatch | None:
        if self.rows and self.asked:
            self.score()
        if self.best is None:
            return None
        row, found, score = self.best
        return pa.RecordBatch.from_arrays([pa.array(self.ids[row]), pa.array(self.variants[row]), pa.array(found),
                                           pa.array(score)], names=["query_id", "variant", "vec_id", "score"])


def searched(groups: DataFrame, dims: int, k: int) -> DataFrame:
    """Best `k` candidates of each query within each group (part, q, c); a group's queries come before its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, search = None, Search(k)
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)  # part, q, c, asks
            ids, variants = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if key != (here := tuple(keys[a, :3])):
                    if (out := search.result()) is not None:
                        yield out
                    key, search = here, Search(k)
                x = matrix(batch.column(6).slice(a, b - a), dims)
                if keys[a, 3]:
                    search.ask(ids[a:b], variants[a:b], x)
                elif search.asked:
                    search.see(ids[a:b], x)
        if (out := search.result()) is not None:
            yield out

    return (groups.select("part", "q", "c", F.col("asks").cast("long").alias("asks"), "vec_id", "variant", "embedding")
            .repartition("part", "q", "c").sortWithinPartitions("part", "q", "c", F.desc("asks"))
            .mapInArrow(run, "query_id long, variant long, vec_id long, score double"))


def parts_for(rows: int) -> int:
    """A power of two near rows ** 0.35: parts grow with the table, and so does a part."""
    return min(MAX_PARTS, 1 << round(0.35 * max(rows, 1).bit_length())) if rows >= 64 else 1


def fit(rows: DataFrame, n: int, dims: int, parts: int) -> Index:
    """Learn an index in one task, from SAMPLE_ROWS rows at most, drawn by a hash of their place in the table."""
    want = max(4 * parts, min(SAMPLE_ROWS, SAMPLE_VALUES // dims))
    drawn = F.pmod(F.xxhash64(F.lit(11), "place"), F.lit(1 << 30)) < int(min(1.0, 0.95 * want / n) * (1 << 30))
    sample = rows.where(drawn) if n > want else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [matrix(batch.column(0), dims) for batch in batches]
        index = learn(np.concatenate(found), parts) if found else None
        if index is not None:
            numbers = [w.astype("<f4").tobytes() for net in (index.place, index.route) for w in net]
            yield pa.RecordBatch.from_arrays([pa.array([numbers], pa.list_(pa.binary())), pa.array([index.mass])],
                                             names=["weights", "mass"])

    learned = sample.select("embedding", "place").repartition(1).sortWithinPartitions("place").select(
        "embedding").mapInArrow(run, "weights array<binary>, mass double").first()
    shapes = [(dims, parts), (dims, HIDDEN), (HIDDEN,), (HIDDEN, parts), (parts,)]
    weights = [np.frombuffer(w, "<f4").reshape(s) for w, s in zip(learned["weights"], shapes * 2)]
    return Index(Net(*weights[:5]), Net(*weights[5:]), learned["mass"])


def nearest(vectors: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """For each query row the `k` largest inner products found among all other rows: query_id, rank, vec_id, score.

    Input columns are vec_id and embedding. Rows without vec_id, and vectors that are null, zero, or hold a null or a
    non-finite component, take no part; missing trailing components count as 0. `queries` picks query rows. A row
    never meets rows with its own vec_id; other repeated rows are candidates each, and an equal query row asks once.
    Scores are double products of the vectors as they are; ties go to the smaller vec_id. A query whose parts hold
    fewer than `k` candidates asks all parts, so it gets `k` rows wherever there are so many. No rows, no result.

    Parts and classifier are learned from a bounded sample; every row is placed in a part, whatever its size. Large
    parts are searched in blocks of rows, often asked ones in blocks of queries, and rows stream past a block of queries,
    so no task holds a part. Work for a query follows the parts that RECALL needs: few where vectors cluster, about
    half of them where they point anywhere.
    """
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    vector = F.col("embedding") if kind in ("float", "double") else F.col("embedding").cast("array<double>")
    kind = kind if kind in ("float", "double") else "double"
    rows = vectors.where(usable(F.col("embedding")) & F.exists("embedding", lambda c: c != 0)
                         & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(queries, F.lit(False)).alias("asks"),
        vector.alias("embedding"), F.monotonically_increasing_id().alias("place"))
    n, dims = rows.agg(F.count("*"), F.max(F.size("embedding"))).first()
    parts = parts_for(n)
    index = fit(rows, n, dims, parts) if parts > 1 else None

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = np.zeros(batch.num_rows, np.int64)
            if index is not None and batch.num_rows:
                part = index.place.logits(directions(matrix(batch.column(2), dims))).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int64())], names=names)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = [np.zeros(1, np.int64)] * batch.num_rows
            if index is not None and batch.num_rows:
                asked = probed(index, matrix(batch.column(1), dims))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(asked, pa.list_(pa.int64()))], names=["vec_id", "embedding", "parts"])

    names = ["vec_id", "asks", "embedding", "place", "part"]
    indexed = stored(rows.mapInArrow(place, f"vec_id long, asks boolean, embedding array<{kind}>, place long, part long"),
                     "indexed-vectors")
    asked = stored(indexed.where("asks").select("vec_id", "embedding").distinct().mapInArrow(
        route, f"vec_id long, embedding array<{kind}>, parts array<long>").withColumn(
            "variant", F.xxhash64("embedding")), "routed-queries")
    held = {r["part"]: r["count"] for r in indexed.groupBy("part").count().collect()}  # one row per part
    found = _search(indexed, asked, held, parts, dims, k)
    if parts > 1:
        found = stored(found, "neighbours")
        got = found.groupBy("query_id", "variant").count().where(F.col("count") >= k)
        short = asked.join(got, (asked.vec_id == got.query_id) & (asked.variant == got.variant), "left_anti")
        short = stored(short.withColumn("parts", F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))),
                       "short-queries")
        if not short.isEmpty():
            rest = _search(indexed, short, held, parts, dims, k)
            found = found.join(short.select(F.col("vec_id").alias("query_id"), "variant"), ["query_id", "variant"],
                               "left_anti").unionByName(rest)
    return found.select("query_id", "rank", "vec_id", "score")


def _search(indexed: DataFrame, asked: DataFrame, held: dict[int, int], parts: int, dims: int, k: int) -> DataFrame:
    """Search all (query, part) pairs of `asked`, in blocks, and merge: query_id, variant, rank, vec_id, score."""
    routed = asked.select("vec_id", "variant", "embedding", F.explode("parts").alias("part"))
    asks = {r["part"]: r["count"] for r in routed.groupBy("part").count().collect()}  # one row per part

    def blocks(count: dict[int, int], size: int) -> Column:
        return F.get(F.array(*(F.lit(-(-count.get(p, 0) // size) or 1) for p in range(parts))), F.col("part").cast("int"))

    def each(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    row_blocks, query_blocks = blocks(held, ROW_BLOCK), blocks(asks, QUERY_BLOCK)
    left = routed.select("part", F.pmod(F.xxhash64("vec_id", "variant"), query_blocks).cast("int").alias("q"),
                         each(row_blocks).alias("c"), F.lit(True).alias("asks"), "vec_id", "variant", "embedding")
    right = indexed.select("part", each(query_blocks).alias("q"), F.pmod(F.xxhash64("place"), row_blocks).cast(
        "int").alias("c"), F.lit(False).alias("asks"), "vec_id", F.lit(0).cast("long").alias("variant"), "embedding")
    best = Window.partitionBy("query_id", "variant").orderBy(F.desc("score"), "vec_id")
    return searched(left.unionByName(right), dims, k).withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= k).withColumn("rank", F.col("rank").cast("int"))
