"""Benchmark decontamination by latent semantic retrieval and rare words, then common subsequences and answers."""

from __future__ import annotations

import pickle
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.frames import kept_by_worker, new_path, stored

#: Words of a passage that is looked up; passages start at every half.
PASSAGE = 32
#: Benchmark passages that one model holds; a larger benchmark is searched model by model.
MODEL_PASSAGES = 4096
#: Words of a benchmark passage; longer items have several, each looked up and checked.
ITEM_WORDS = 64
RANK, OVERSAMPLE, POWER_ROUNDS = 64, 8, 2
#: Least cosine of a candidate, least share of an item's words in common order, and the share that suffices for a
#: paraphrase if the answer is there as well.
COSINE, VERBATIM, PARAPHRASE = 0.55, 0.8, 0.6
#: Least share of an answer's words in common order.
ANSWERED = 0.8
#: What the latent space alone finds: a passage of at least this cosine that holds so much of an item's weight in any
#: order (of items of some length), or a smaller share in common order with the answer.
NEAR, REWORDED, REWORDED_WORDS, LOOSE = 0.75, 0.9, 8, 0.4
#: Words of texts that are looked at together, and occurrences of rare words that are counted together.
SEGMENT, PAIRS = 1 << 16, 1 << 21
MARKS = bytes(32 if chr(c) in string.punctuation else c for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased words without ASCII punctuation, in UTF-8."""
    return text.lower().encode().translate(MARKS).split()


@dataclass
class Anchors:
    """The rarest words of some lists, and how many of their occurrences no text can lack that holds enough of a list.

    Of a list of n words of which k must be there, n - k may be missing: of its n - k + r rarest, r are there.
    """

    row: np.ndarray  # entries: list, in order
    word: np.ndarray  # entries: code of one of its rarest words
    need: np.ndarray  # lists: r
    width: np.ndarray  # lists: words of text within which they stand


def anchors(lists: list[list[bytes]], share: float, widths: list[int], idf: dict[bytes, float],
            ids: dict[bytes, int]) -> Anchors:
    rows, words, need = [], [], []
    for i, found in enumerate(lists):
        must = next(k for k in range(len(found) + 1) if k >= share * len(found) - 1e-9)
        spare = len(found) - must
        held = 0
        for word, times in sorted(Counter(found).items(), key=lambda x: (-idf[x[0]], x[0])):
            if held >= spare + max(1, -(-must // 3)):
                break
            held += times
            rows.append(i)
            words.append(ids[word])
        need.append(held - spare)
    return Anchors(*(np.array(x, np.int64) for x in (rows, words, need, widths)))


@dataclass
class Model:
    """Items' words, answers and latent vectors, and the latent vector (IDF included) of each vocabulary word."""

    vocabulary: dict[bytes, int]
    items: list[tuple[int | None, list[bytes], list[bytes]]]  # item_id, words, answer words
    vectors: np.ndarray  # items x rank, unit length
    basis: np.ndarray  # words + 1 x rank; the last row is zero, for all other words
    weights: dict[bytes, float]  # of each vocabulary word
    #: What a text cannot lack that holds VERBATIM of an item; PARAPHRASE of it; its answer.
    verbatim: Anchors
    paraphrase: Anchors
    answers: Anchors


def item_passages(benchmark: DataFrame) -> DataFrame:
    """item_id, passage number, its words and its answer's words (column `answer`, or else the last sentence)."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text", answer.alias("answer"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text, given in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = words_of(text or "")
                sentences = [s for s in (text or "").replace("!", ".").replace("?", ".").split(".") if words_of(s)]
                last = words_of(given if given is not None else sentences[-1] if sentences else "")
                count = max(1, -(-len(found) // ITEM_WORDS))
                for n in range(count if found else 0):
                    part = found[len(found) * n // count: len(found) * (n + 1) // count]
                    out.append({"item_id": item, "passage": n, "words": part,
                                "answer": last if given is not None or n == count - 1 else []})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("item_id", pa.int64()), ("passage", pa.int64()), ("words", pa.list_(pa.binary())),
                ("answer", pa.list_(pa.binary()))]))

    return rows.mapInArrow(run, "item_id long, passage long, words array<binary>, answer array<binary>")


def passage_counts(docs: DataFrame, vocabulary: list[bytes]) -> dict[bytes, int]:
    """In how many passages of PASSAGE / 2 words of the whole corpus each vocabulary word stands; key b"" counts all.

    The vocabulary is that of the whole benchmark, so the corpus is counted in one scan however many models there are.
    """
    ids = {w: i for i, w in enumerate(vocabulary)}
    half = PASSAGE // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(ids) + 1, np.int64)
        for batch in batches:
            for passages in segments(batch.column(0), ids):
                filled = passages.codes.reshape(-1, half)
                keys = np.unique(np.arange(len(filled))[:, None] * (len(ids) + 1) + filled)
                seen[:-1] += np.bincount(keys % (len(ids) + 1), minlength=len(ids) + 1)[:-1]
                seen[-1] += len(filled)
        there = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(seen[there])], names=["word", "n"])

    # a row per vocabulary word and task
    counts = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    table = counts.toArrow()
    return {(vocabulary[w] if w < len(vocabulary) else b""): n for w, n in zip(
        table["word"].to_pylist(), table["n"].to_pylist())}


@dataclass
class Segment:
    """Some texts' words as codes; each text fills whole half passages (the rest is the code of no word)."""

    codes: np.ndarray
    rows: list[int]  # row of the batch
    words: list[list[bytes]]
    starts: list[int]  # first half passage of each text


def segments(texts: pa.Array, ids: dict[bytes, int]) -> Iterator[Segment]:
    """Whole texts in turn, about SEGMENT words at a time."""
    half, none = PASSAGE // 2, len(ids)
    codes: list[int] = []
    rows, words, starts = [], [], []
    for row, text in enumerate(texts):
        found = words_of(text.as_py() or "")
        starts.append(len(codes) // half)
        rows.append(row)
        words.append(found)
        codes += [ids.get(w, none) for w in found]
        codes += [none] * (-len(codes) % half)
        if len(codes) >= SEGMENT:
            yield Segment(np.array(codes, np.int32), rows, words, starts)
            codes, rows, words, starts = [], [], [], []
    if codes:
        yield Segment(np.array(codes, np.int32), rows, words, starts)


def singular_basis(passages: DataFrame, idf: dict[bytes, float], rank: int) -> dict[bytes, np.ndarray]:
    """Right singular vectors of the TF-IDF matrix of the passages, by randomised range finding over Spark.

    A passage is a row of unit length. Only words x (rank + oversampling) tables move: each round multiplies the rows
    in place by the current table and sums their outer products by word.
    """
    size = rank + OVERSAMPLE
    rows = stored(passages.select("words"), "benchmark-rows")

    def seeded(word: bytes) -> np.ndarray:
        return np.random.default_rng(zlib.crc32(word)).standard_normal(size)

    def product(table: dict[bytes, np.ndarray]) -> dict[bytes, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[bytes, np.ndarray] = {}
            for batch in batches:
                for found in batch.column(0).to_pylist():
                    row: dict[bytes, float] = {}
                    for word in found:
                        row[word] = row.get(word, 0.0) + idf[word]
                    length = np.sqrt(sum(x * x for x in row.values())) or 1.0
                    image = sum(x / length * table[word] for word, x in row.items())
                    for word, x in row.items():
                        sums[word] = sums.get(word, 0.0) + x / length * image
            yield pa.RecordBatch.from_arrays([
                pa.array(list(sums), pa.binary()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                names=["word", "part"])

        parts = rows.mapInArrow(run, "word binary, part array<double>").groupBy("word").agg(
            *(F.sum(F.get("part", F.lit(i))).alias(f"p{i}") for i in range(size)))
        found = parts.toArrow()
        values = np.column_stack([found[f"p{i}"].to_numpy() for i in range(size)])
        return dict(zip(found["word"].to_pylist(), values))

    table = {w: seeded(w) for w in idf}
    for _ in range(POWER_ROUNDS):
        image = product(table)
        names = sorted(image)
        q, _ = np.linalg.qr(np.array([image[w] for w in names]))
        q = np.pad(q, ((0, 0), (0, size - q.shape[1])))
        table = dict(zip(names, q))
    # A'A in the basis q: its eigenvectors turn q into right singular vectors, largest first
    image = product(table)
    q, aq = (np.array([t[w] for w in names]) for t in (table, image))
    _, turn = np.linalg.eigh(q.T @ aq)
    return dict(zip(names, q @ turn[:, ::-1][:, :rank]))


def fit(passages: DataFrame, counts: dict[bytes, int]) -> Model:
    """The model of at most MODEL_PASSAGES benchmark passages, with word weights from `counts` of the whole corpus."""
    rows = passages.orderBy("item_id", "passage").toArrow().to_pylist()
    vocabulary = sorted({w for row in rows for w in row["words"] + row["answer"]})
    total = counts.get(b"", 0)
    idf = {w: float(np.log((1 + total) / (1 + counts.get(w, 0))) + 1e-3) for w in vocabulary}
    latent = singular_basis(passages, idf, min(RANK, max(len(rows), 1)))
    rank = len(next(iter(latent.values())))
    basis = np.zeros((len(vocabulary) + 1, rank), np.float32)
    for i, w in enumerate(vocabulary):
        if w in latent:  # others stand in answers only
            basis[i] = idf[w] * latent[w]
    ids = {w: i for i, w in enumerate(vocabulary)}
    vectors = np.array([basis[[ids[w] for w in row["words"]]].sum(0) for row in rows])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    items, given = [r["words"] for r in rows], [r["answer"] for r in rows]
    twice = [2 * len(words) for words in items]
    wide = [n + len(answer) for n, answer in zip(twice, given)]
    return Model(ids, [(r["item_id"], r["words"], r["answer"]) for r in rows], vectors.astype(np.float32), basis, idf,
                 anchors(items, VERBATIM, twice, idf, ids), anchors(items, PARAPHRASE, wide, idf, ids),
                 anchors(given, ANSWERED, wide, idf, ids))


def common(item: list[bytes], text: list[bytes]) -> tuple[int, int, int]:
    """Length of the longest common subsequence, and the words of `text` between which it can be found.

    Bit-parallel: a bit per word of the item. The end is the first place at which the length is reached, the start the
    last one from which it is reached by that end.
    """
    def ends(a: list[bytes], b: list[bytes]) -> tuple[int, int]:
        places: dict[bytes, int] = {}
        for i, w in enumerate(a):
            places[w] = places.get(w, 0) | 1 << i
        full = (1 << len(a)) - 1
        row, best, at = full, 0, 0
        for i, w in enumerate(b):
            if match := places.get(w):
                up = row & match
                row = ((row + up) | (row - up)) & full
                if (n := len(a) - row.bit_count()) > best:
                    best, at = n, i + 1
        return best, at

    length, end = ends(item, text)
    _, back = ends(item[::-1], text[:end][::-1])
    return length, end - back, end


def in_order(answer: list[bytes], text: list[bytes]) -> bool:
    """Whether at least ANSWERED of the answer's words stand in the text in their order."""
    return bool(answer) and common(answer, text)[0] >= ANSWERED * len(answer)


def dense_blocks(part: Segment, marks: Anchors, none: int, span: int) -> np.ndarray:
    """Keys (text * lists + list) * span + block, in order, where that block of the text, as wide as the list wants it,
    holds rare words of the list, and holds with the next block as many as are needed."""
    used = np.zeros(none + 1, bool)
    used[marks.word] = True
    places = np.flatnonzero(used[part.codes])
    places = places[np.argsort(part.codes[places], kind="stable")]
    times = np.bincount(part.codes[places], minlength=none + 1)
    first = np.cumsum(times) - times
    starts = np.array(part.starts, np.int64) * (PASSAGE // 2)
    text = np.searchsorted(starts, places, side="right") - 1
    inside = places - starts[text]
    entries = np.flatnonzero(times[marks.word])
    lists, out = len(marks.need), []
    # lists are taken together up to PAIRS occurrences
    load = np.cumsum(np.bincount(marks.row, times[marks.word], lists)) // PAIRS
    for chunk in np.split(entries, np.flatnonzero(np.diff(load[marks.row[entries]])) + 1):
        n = times[marks.word[chunk]]
        at = np.repeat(first[marks.word[chunk]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        row = np.repeat(marks.row[chunk], n)
        keys, count = np.unique((text[at] * lists + row) * span + inside[at] // marks.width[row], return_counts=True)
        total = count.copy()
        total[:-1] += np.where(keys[1:] == keys[:-1] + 1, count[1:], 0)
        out.append(keys[total >= marks.need[keys // span % lists]])
    return np.sort(np.concatenate(out))


def regions(part: Segment, model: Model) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """For a text and an item, first and last word of regions one of which holds any stretch that is a hit.

    Rare words of a stretch stand in the block of the first of them and the next, and the stretch begins less than a
    block before it. An answer's first rare word is less than a block away from the item's.
    """
    none, lists = len(model.vocabulary), len(model.items)
    span = len(part.codes) // 2 + 3  # blocks have two words at least: no key and its neighbour are of two lists
    sure = dense_blocks(part, model.verbatim, none, span)
    maybe, said = (dense_blocks(part, marks, none, span) for marks in (model.paraphrase, model.answers))
    maybe = maybe[np.isin(maybe, said) | np.isin(maybe, said + 1) | np.isin(maybe, said - 1)]
    out: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for keys, marks in (sure, model.verbatim), (maybe, model.paraphrase):
        for key in keys.tolist():
            pair, block = divmod(key, span)
            t, i = divmod(pair, lists)
            width = int(marks.width[i])
            out.setdefault((t, i), []).append((max(0, (block - 1) * width), (block + 2) * width))
    return out


def held(wanted: list[bytes], answer: list[bytes], words: list[bytes], low: int, high: int) -> tuple | None:
    """Common words, the words of the text between which they stand, and whether the answer is there: of the stretch
    between `low` and `high` that holds most of an item, if one holds it."""
    size = len(wanted)
    region = words[low:high]
    there = set(region)
    at_most = sum(w in there for w in wanted)  # a common subsequence cannot hold words that are not there
    if at_most / size < PARAPHRASE:
        return None
    there.update(words[high:high + len(answer)])
    sayable = bool(answer) and sum(w in there for w in answer) >= ANSWERED * len(answer)
    least = PARAPHRASE if sayable else VERBATIM
    if at_most / size < least:
        return None
    n, a, b = common(wanted, region)
    if n / size < least:
        return None

    def judged(n: int, a: int, b: int) -> tuple | None:
        answered = sayable and in_order(answer, words[a:b + len(answer)])
        return (n, a, b, answered) if n / size >= VERBATIM or n / size >= PARAPHRASE and answered else None

    if b - a <= 2 * size and (hit := judged(n, low + a, low + b)):
        return hit
    # the longest one is too wide, or without the answer: look at each stretch of twice the item's length by itself
    known, best = set(wanted), None
    matches = np.cumsum([0, *(w in known for w in region)])
    for start in range(len(region)):
        end = min(start + 2 * size, len(region))
        if region[start] in known and (matches[end] - matches[start]) / size >= least:
            n, a, b = common(wanted, region[start:end])
            if (best is None or n > best[0]) and (hit := judged(n, low + start + a, low + start + b)):
                best = hit
    return best


def reworded(wanted: list[bytes], answer: list[bytes], words: list[bytes], low: int, high: int,
             weights: dict[bytes, float]) -> tuple | None:
    """Like `held`, for a stretch that the latent space calls near: words may have changed places.

    It holds an item whose words, by weight, nearly all stand within twice its length in whatever order, or LOOSE of
    whose words stand there in common order, followed by an answer that is not the item as a whole.
    """
    size, region = len(wanted), words[low:high]
    held_here = set(region)  # what is not there at all bounds every stretch
    total = sum(weights[w] for w in wanted)
    in_bag = size >= REWORDED_WORDS and sum(weights[w] for w in wanted if w in held_here) >= REWORDED * total - 1e-9
    loose = False
    if len(answer) < size and sum(w in held_here for w in wanted) >= LOOSE * size:
        held_here.update(words[high:high + len(answer)])
        loose = bool(answer) and sum(w in held_here for w in answer) >= ANSWERED * len(answer)
    if not in_bag and not loose:
        return None
    need = Counter(wanted)
    if in_bag:
        there: Counter = Counter()
        weight, best, at = 0.0, 0.0, 0
        for i, w in enumerate(region):
            if w in need:
                weight += weights[w] * (there[w] < need[w])
                there[w] += 1
            if i >= 2 * size and (gone := region[i - 2 * size]) in need:
                there[gone] -= 1
                weight -= weights[gone] * (there[gone] < need[gone])
            if weight > best + 1e-9:
                best, at = weight, i + 1
        if best >= REWORDED * total:
            first = max(0, at - 2 * size)
            first += next(i for i, w in enumerate(region[first:]) if w in need)
            n, _, _ = common(wanted, region[first:at])
            return n, low + first, low + at, in_order(answer, words[low + first:low + at + len(answer)])
    if loose:
        n, a, b = common(wanted, region)
        if n >= LOOSE * size and b - a <= 2 * size and in_order(answer, words[low + a:low + b + len(answer)]):
            return n, low + a, low + b, True
    return None


def found_in(texts: pa.Array, model: Model) -> Iterator[tuple[int, dict]]:
    """(row, hit) for each benchmark item in each whole text."""
    half = PASSAGE // 2
    for part in segments(texts, model.vocabulary):
        halves = model.basis[part.codes].reshape(-1, half, model.basis.shape[1]).sum(1)
        passages = halves.copy()
        passages[:-1] += halves[1:]
        last = np.array(part.starts[1:] + [len(halves)]) - 1
        passages[last[last >= 0]] = halves[last[last >= 0]]  # a text's last half stands alone
        length = np.linalg.norm(passages, axis=1, keepdims=True)
        cosines = passages @ model.vectors.T / np.maximum(length, 1e-12)
        near, item = np.nonzero(cosines >= COSINE)
        text = np.searchsorted(part.starts, near, side="right") - 1
        runs: dict[tuple[int, int], list[int]] = {}
        for n, i, t in zip(near.tolist(), item.tolist(), text.tolist()):
            runs.setdefault((t, i), []).append(n - part.starts[t])
        rare = regions(part, model)
        for t, i in runs.keys() | rare.keys():
            item_id, wanted, answer = model.items[i]
            places, spans, at = runs.get((t, i), []), [], 0
            while at < len(places):  # neighbouring passages are checked together, with an item's length around them
                first = last_place = places[at]
                while at + 1 < len(places) and places[at + 1] <= last_place + 2 and (
                        places[at + 1] - first) * half <= 4 * len(wanted):
                    at += 1
                    last_place = places[at]
                at += 1
                spans.append((max(0, first * half - len(wanted)), last_place * half + PASSAGE + len(wanted)))
            best = None
            for low, high in spans + rare.get((t, i), []):
                if best and best["coverage"] == 1:
                    break
                if hit := held(wanted, answer, part.words[t], low, high):
                    n, a, b, answered = hit
                    near_by = cosines[part.starts[t] + max(0, a // half - 1): part.starts[t] + -(-b // half), i]
                    if best is None or n / len(wanted) > best["coverage"]:
                        best = {"item_id": item_id, "cosine": float(near_by.max()), "common_words": n,
                                "coverage": n / len(wanted), "answered": answered, "first_word": a, "last_word": b,
                                "path": "ordered"}
            for low, high in spans if best is None else ():
                inside = cosines[part.starts[t] + max(0, -(-low // half)): part.starts[t] + -(-high // half), i]
                if inside.max(initial=0) >= NEAR and (
                        hit := reworded(wanted, answer, part.words[t], low, high, model.weights)):
                    n, a, b, answered = hit
                    if best is None or n / len(wanted) > best["coverage"]:
                        best = {"item_id": item_id, "cosine": float(inside.max()), "common_words": n,
                                "coverage": n / len(wanted), "answered": answered, "first_word": a, "last_word": b,
                                "path": "latent"}
            if best:
                yield part.rows[t], best


HIT = ("item_id long, cosine double, common_words long, coverage double, answered boolean, first_word long, "
       "last_word long, path string")


def models(docs: DataFrame, benchmark: DataFrame) -> list[str]:
    """One model for each MODEL_PASSAGES passages, written to the shared folder; their paths.

    The corpus is scanned once, for the words of all models. Models are fitted one after another and not kept, so the
    driver holds one; tasks load them in turn. Repeated benchmark rows are one.
    """
    spark = docs.sparkSession
    passages = stored(item_passages(benchmark).dropDuplicates(), "benchmark-passages")
    count = -(-passages.count() // (MODEL_PASSAGES // 2))
    if not count:
        return []
    vocabulary = passages.select(F.explode(F.concat("words", "answer")).alias("w")).distinct().toArrow()["w"].to_pylist()
    counts = passage_counts(docs, sorted(vocabulary))
    keyed = passages.withColumn("group", F.pmod(F.xxhash64("item_id", "passage", "words"), F.lit(count)))
    paths = []
    for g in range(count):
        model = cloudpickle.dumps(fit(keyed.where(F.col("group") == g).drop("group"), counts))
        paths.append(new_path(spark, "benchmark-model"))
        spark.createDataFrame([(bytearray(model),)], "model binary").coalesce(1).write.parquet(paths[-1])
    return paths


def loaded(path: str) -> Model:
    """A written model; a worker keeps the one it used last."""
    def read() -> Model:
        store, name = fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")
        return pickle.loads(pq.read_table(name, filesystem=store)["model"][0].as_py())

    return kept_by_worker(f"benchmark {path}", read)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item found in it: doc_id, item_id, cosine, common_words, coverage,
    answered, first_word, last_word (words of the document, end exclusive) and path.

    Word weights come from all passages of all documents. Every half-overlapping passage of every whole text is folded
    into the benchmark's latent space; those near an item are compared with it word by word, and so is every stretch
    that holds enough of an item's rarest words, which misses none. A document holds an item if VERBATIM of its words
    stand there in order within twice its length, or PARAPHRASE of them and the answer (path `ordered`). What is nearer
    still in the latent space (cosine NEAR) may have changed order: nearly all of the item's weight within twice its
    length, or LOOSE of its words in order and the answer (path `latent`). Null and empty texts and items are never
    found; repeated rows are searched each, repeated items are one; null ids stay null; an empty benchmark or table
    gives no rows. Of a long item each ITEM_WORDS part counts; the best is reported. Two scans of the documents,
    however large the benchmark.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), (
        "common_words", pa.int64()), ("coverage", pa.float64()), ("answered", pa.bool_()), ("first_word", pa.int64()), (
        "last_word", pa.int64()), ("path", pa.string())])
    rows = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"))
    paths = models(docs, benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict[tuple, dict] = {}
            for path in paths:
                for row, hit in found_in(batch.column(0), loaded(path)):
                    key = row, hit["item_id"]
                    if key not in best or hit["coverage"] > best[key]["coverage"]:
                        best[key] = hit
            yield pa.RecordBatch.from_pylist([
                {"doc_id": batch.column(1)[row].as_py(), **hit} for (row, _), hit in best.items()], schema)

    return rows.mapInArrow(run, f"doc_id long, {HIT}")


def holds_item(paths: list[str]) -> Column:
    """Whether column `text` holds an item of one of the models, as a column for filters that keep whole rows."""
    @F.arrow_udf("boolean")
    def holds(text: pa.Array) -> pa.Array:
        out = np.zeros(len(text), bool)
        for path in paths:
            left = np.flatnonzero(~out)
            out[left[[row for row, _ in found_in(text.take(pa.array(left)), loaded(path))]]] = True
        return pa.array(out)

    return holds(F.col("text"))


def without_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    paths = models(docs, benchmark)
    return docs.where(~holds_item(paths)) if paths else docs
