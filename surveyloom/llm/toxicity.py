"""Toxicity by a support vector machine over a gapped-subsequence string kernel with Nyström landmarks."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.frames import kept_by_worker, stored

#: The kernel: subsequences of ORDER characters that span at most ORDER + GAPS, each gap weighed by DECAY.
ORDER, GAPS, DECAY = 4, 2, 0.6
STEPS = [(a, b, c) for c in range(3, 4 + GAPS) for b in range(2, c) for a in range(1, b)]
#: Strings longer than this are seen through overlapping windows of it.
WIDTH = 24
#: Bounds of the labelled sample that the machine is fitted on: documents of each label, words (see `shares`), landmarks.
SAMPLE_DOCS, SAMPLE_WORDS, LANDMARKS = 8_000, 60_000, 160
REMEMBERED = 150_000
EDGES = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum()) + "¿¡«»“”„‘’…–—"
SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
EMPTY = (1 << 31) - 1


def letters(alphabet: str) -> np.ndarray:
    """Code of each code point below 0x600: 0 none, 1 and 2 the ends of a string, 63 any other character."""
    lut = np.full(0x600, 63, np.int32)
    lut[0], lut[2], lut[3] = 0, 1, 2
    for code, char in enumerate(alphabet[:60], 3):
        lut[ord(char)] = code
    return lut


def windows(chunk: str) -> list[str]:
    """A chunk's strings: lower case, without marks at its ends, between end signs; cut where it is long.

    A chunk with marks inside is also seen without them.
    """
    word = chunk.lower().strip(EDGES)
    if not word:
        return []
    forms = [word] if word.isalnum() else [word, "".join(filter(str.isalnum, word)) or word]
    return [f"\x02{form[i:i + WIDTH]}\x03" for form in forms
            for i in range(0, max(1, len(form) - WIDTH // 2 if len(form) > WIDTH else 1), WIDTH // 2)]


def with_insertions(words: list[str]) -> list[str]:
    """Each word with one character put in, at each place inside it: what a disguised insult looks like."""
    return [w[:i] + mark + w[i:] for w in words for i, mark in zip(range(2, len(w) - 1), "*x1-e0_a.i3o@u" * 2)]


def coded(words: list[str], lut: np.ndarray) -> np.ndarray:
    width = max(map(len, words), default=0)
    points = np.array(words, f"<U{max(width, 1)}").view("<u4").reshape(len(words), -1)
    return lut[np.minimum(points, 0x5FF)]


def keys_at(codes: np.ndarray, step: tuple[int, int, int]) -> np.ndarray:
    """Keys of the subsequences with these offsets, from each place; 0 beyond a word's end."""
    a, b, c = step
    n = codes.shape[1] - c
    keys = (codes[:, :n] << 18) | (codes[:, a:a + n] << 12) | (codes[:, b:b + n] << 6) | codes[:, c:]
    return np.where(codes[:, c:] > 0, keys, 0)


def subsequences(words: list[str], lut: np.ndarray) -> np.ndarray:
    """Kernel features of each word, sorted: key * 8 + gaps per entry, EMPTY where there is none."""
    codes, found = coded(words, lut), []
    for step in STEPS:
        if codes.shape[1] > step[2]:
            keys = keys_at(codes, step)
            found.append(np.where(keys > 0, keys << 3 | (step[2] - 3), EMPTY))
    return np.sort(np.concatenate(found, 1), 1) if found else np.full((len(words), 1), EMPTY, np.int32)


def weights(features: np.ndarray) -> np.ndarray:
    return np.where(features == EMPTY, 0.0, DECAY ** (features & 7)).astype(np.float32)


def lengths(features: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Each word's norm: equal subsequences are summed before they are squared."""
    new = np.ones(features.shape, bool)
    new[:, 1:] = (features[:, 1:] >> 3) != (features[:, :-1] >> 3)
    starts = np.flatnonzero(new.ravel())
    sums = np.add.reduceat(weight.ravel(), starts)
    norm = np.sqrt(np.bincount(starts // features.shape[1], sums * sums, len(features)))
    return np.where(norm > 0, norm, 1.0)


@dataclass
class Model:
    """The fitted machine. The landmarks' part of the decision is folded into one weight per subsequence."""

    alphabet: str
    keys: np.ndarray
    values: np.ndarray
    offset: float
    #: Logistic weights of the three text features, and their constant; None: no labels of both kinds were there.
    text_weights: np.ndarray | None

    def margins(self, words: list[str], lut: np.ndarray, table: np.ndarray) -> np.ndarray:
        features = subsequences(words, lut)
        weight = weights(features)
        gain = table[np.where(features == EMPTY, 0, features >> 3)]
        return (weight * gain).sum(1) / lengths(features, weight) + self.offset

    def positive_margins(self, words: list[str], lut: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Margins, where they are positive; else some value up to 0. A norm is 1 at least, so few need theirs."""
        codes, gain = coded(words, lut), np.zeros(len(words))
        for step in STEPS:
            if codes.shape[1] > step[2]:
                gain += DECAY ** (step[2] - 3) * table[keys_at(codes, step)].sum(1)
        margins = np.minimum(gain + self.offset, 0.0)
        if len(hot := np.flatnonzero(gain + self.offset > 0)):
            margins[hot] = self.margins([words[i] for i in hot], lut, table)
        return np.maximum(margins, -2.0)

    def table(self) -> np.ndarray:
        table = np.zeros(1 << 24, np.float32)
        table[self.keys] = self.values
        return table


class Scorer:
    """Features of texts under a model; remembers the margins of chunks it has met."""

    def __init__(self, model: Model):
        self.model, self.lut, self.table = model, letters(model.alphabet), model.table()
        self.new: dict[str, float] = {}
        self.old: dict[str, float] = {}

    def _learn(self, chunks: list[str]) -> None:
        ask = []
        for chunk in chunks:
            if (known := self.old.get(chunk)) is not None:
                self.new[chunk] = known
            else:
                ask.append(chunk)
        parts = [(chunk, word) for chunk in ask for word in windows(chunk)]
        self.new.update(dict.fromkeys(ask, -2.0))
        parts.sort(key=lambda x: len(x[1]))
        for i in range(0, len(parts), 4096):
            piece = parts[i:i + 4096]
            for (chunk, _), margin in zip(piece, self.model.positive_margins(
                    [w for _, w in piece], self.lut, self.table)):
                self.new[chunk] = max(self.new[chunk], float(margin))

    def features(self, texts: list[str]) -> np.ndarray:
        """Highest positive margin, positive margins summed (log) and their share among the text's strings (log)."""
        out = np.zeros((len(texts), 3))
        for row, text in enumerate(texts):
            chunks = text.split()
            chunks += [m[0].replace(" ", "").replace("\t", "") for m in SPACED.finditer(text)]
            if len(self.new) > REMEMBERED:
                self.old, self.new = self.new, {}
            unique = set(chunks)
            if missing := [c for c in unique if c not in self.new]:
                self._learn(missing)
            known = {c: self.new[c] for c in unique}
            top = max(known.values(), default=0.0)
            total = 0.0
            if top > 0:
                hot = {c for c, margin in known.items() if margin > 0}
                total = sum(known[c] for c in chunks if c in hot)
            out[row] = max(top, 0.0), np.log1p(total), np.log1p(100 * total / max(len(chunks), 1))
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.model.text_weights is None:
            return np.zeros(len(texts))
        x = np.column_stack([self.features(texts), np.ones(len(texts))])
        return 1 / (1 + np.exp(-np.clip(x @ self.model.text_weights, -30, 30)))


def scorer(model: Model, name: str) -> Scorer:
    """The worker's scorer of this fit; a reused worker keeps the last one from task to task."""
    return kept_by_worker(f"toxicity {name}", lambda: Scorer(model))


def squared_hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 30) -> np.ndarray:
    """Weights of a linear support vector machine (last column of `x` is 1), by Newton steps on the primal."""
    w = np.zeros(x.shape[1])
    ridge = np.ones(x.shape[1])
    ridge[-1] = 1e-3
    for _ in range(steps):
        gradient, hessian = ridge * w, np.diag(ridge)
        for i in range(0, len(x), 4096):  # rows in blocks, so that only one block is ever copied
            part, sign = x[i:i + 4096], y[i:i + 4096]
            slack = np.maximum(1 - sign * (part @ w), 0)
            active = slack > 0
            weighed = (part[active] * cost[i:i + 4096][active, None]).T
            gradient = gradient - weighed @ (sign * slack)[active]
            hessian = hessian + weighed @ part[active]
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (p - y) + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def kernel(words: list[str], landmarks: list[str], lut: np.ndarray) -> np.ndarray:
    """Normalised kernel values of words (rows) and landmarks (columns)."""
    marks = subsequences(landmarks, lut)
    mark_weight = weights(marks)
    mark_weight /= lengths(marks, mark_weight)[:, None]
    keys, place = np.unique(marks >> 3, return_inverse=True)
    dense = np.zeros((len(keys) + 1, len(landmarks)), np.float32)
    np.add.at(dense, (place.reshape(marks.shape), np.arange(len(landmarks))[:, None]), mark_weight)
    dense[np.searchsorted(keys, EMPTY >> 3):] = 0
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for i in range(0, len(words), 4096):
        features = subsequences(words[i:i + 4096], lut)
        weight = weights(features)
        at = np.minimum(np.searchsorted(keys, features >> 3), len(keys) - 1)
        at = np.where(keys[at] == features >> 3, at, len(keys))
        for column in range(features.shape[1]):
            out[i:i + 4096] += weight[:, column, None] * dense[at[:, column]]
        out[i:i + 4096] /= lengths(features, weight)[:, None]
    return out


def fit_words(words: list[str], toxic: np.ndarray, clean: np.ndarray, share: float, rounds: int = 3) -> Model | None:
    """Fit the machine on words with the number of contexts in which toxic and clean texts hold them.

    Labels are of texts, so which strings make a text toxic has to be found: first those that only toxic texts hold,
    too often for chance; then, as in multiple-instance learning, in each round those of toxic texts alone that
    the machine itself puts beyond its margin. What clean texts hold is never toxic.
    """
    chance = 1 / max(len(words), 1)
    alone = clean == 0
    sure = alone & (toxic >= max(2, np.ceil(np.log(chance) / np.log(share))))
    if not sure.any():
        sure = alone & (toxic >= max(2, toxic[alone].max(initial=0)))
    if not sure.any() or not (clean > 0).any():
        return None
    counts: dict[str, int] = {}
    for word in words:
        for char in word:
            counts[char] = counts.get(char, 0) + 1
    alphabet = "".join(sorted((c for c in counts if 3 < ord(c) < 0x5FF), key=lambda c: (-counts[c], c))[:60])
    lut = letters(alphabet)
    negative = np.flatnonzero(clean > 0)
    model, positive = None, sure
    for _ in range(rounds):
        chosen = np.flatnonzero(positive)
        by_count = chosen[np.argsort(-toxic[chosen], kind="stable")]
        hard = negative[:0] if model is None else negative[np.argsort(-margin[negative], kind="stable")]  # noqa: F821
        # landmarks: of toxic strings those least alike, of clean ones the hardest and some of all
        marks = spread([words[i] for i in by_count[:2000]], LANDMARKS // 2, lut)
        some = np.concatenate([hard[:LANDMARKS // 4], negative[::max(1, len(negative) // (LANDMARKS // 4))]])
        marks += [words[i] for i in dict.fromkeys(some.tolist())][:LANDMARKS - len(marks)]
        between = kernel(marks, marks, lut).astype(float)
        size, vectors = np.linalg.eigh((between + between.T) / 2)
        root = vectors * np.where(size > 1e-6, 1 / np.sqrt(np.maximum(size, 1e-6)), 0)
        shown = with_insertions([words[i] for i in by_count[:400]])
        rows = [words[i] for i in chosen] + shown + [words[i] for i in negative]
        x = np.ones((len(rows), len(marks) + 1))
        for i in range(0, len(rows), 4096):
            x[i:i + 4096, :-1] = kernel(rows[i:i + 4096], marks, lut) @ root
        plain, put_in = len(chosen), len(chosen) + len(shown)
        y = np.where(np.arange(len(rows)) < put_in, 1.0, -1.0)
        cost = np.ones(len(rows))
        cost[:plain] = len(negative) / plain
        cost[plain:put_in] = len(negative) / max(len(shown), 1) / 4
        cost *= min(1.0, 2e4 / len(rows)) * 4
        w = squared_hinge(x, y, cost)
        beta = root @ w[:-1]
        features = subsequences(marks, lut)
        weight = weights(features)
        part = weight / lengths(features, weight)[:, None] * beta[:, None]
        keys, place = np.unique(features >> 3, return_inverse=True)
        values = np.bincount(place.ravel(), part.ravel(), len(keys))
        real = keys != EMPTY >> 3
        model = Model(alphabet, keys[real].astype(np.int64), values[real].astype(np.float32), float(w[-1]), None)
        table = model.table()
        margin = np.concatenate([model.margins(words[i:i + 4096], lut, table) for i in range(0, len(words), 4096)])
        positive = sure | (alone & (toxic > 0) & (margin > 0.5))
    return model


def spread(words: list[str], count: int, lut: np.ndarray) -> list[str]:
    """Words least like those chosen before, the first word first: farthest points in the kernel's space."""
    chosen, likeness = words[:1], np.full(len(words), -1.0)
    while len(chosen) < min(count, len(words)):
        likeness = np.maximum(likeness, kernel(words, chosen[-1:], lut)[:, 0])
        chosen.append(words[int(np.argmin(likeness))])
    return chosen


def sample(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """toxic and text of labelled documents outside the held-out fold (crc32 of doc_id as text divisible by `folds`):
    at most SAMPLE_DOCS ids of each label, in hash order. Ids are picked from the labels, then looked up. An id with
    both labels is toxic."""
    known = labels.where("toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.crc32(F.col("id").cast("string")) % folds != 0).groupBy("id").agg(F.max("toxic").alias("toxic"))
    picked = known.where("toxic = 1").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS).union(
        known.where("toxic = 0").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS))
    rows = docs.join(stored(picked, "toxicity-ids"), docs["doc_id"] == F.col("id"))
    return rows.select("toxic", F.coalesce("text", F.lit("")).alias("text"))


def shares(sizes: list[int], room: int) -> list[int]:
    """How many of each kind are taken: all, or else no fewer than an even share of the room; none is left unused."""
    taken = [0] * len(sizes)
    for done, i in enumerate(sorted(range(len(sizes)), key=lambda i: sizes[i])):
        taken[i] = min(sizes[i], room // (len(sizes) - done))
        room -= taken[i]
    return taken


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of labelled rows outside the held-out fold (see `sample`), and on at most SAMPLE_WORDS of
    their strings: of those that only toxic texts hold, those of both labels, and those that only clean texts hold, each
    kind has a third at least, or all. What does not fit is left out from the least toxic contexts on, in hash
    order. Texts stay on the executors."""
    schema = pa.schema([("word", pa.string()), ("context", pa.int64()), ("toxic", pa.int32())])

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, int, int]] = []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                chunks = text.as_py().split()
                found += {(w, zlib.crc32(f"{before} {after}".encode()), label) for before, chunk, after in zip(
                    ["", *chunks], chunks, [*chunks[1:], ""]) for w in windows(chunk)}
                if len(found) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), schema.types)], schema=schema)
                    found = []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), schema.types)], schema=schema)

    texts = stored(sample(docs, labels), "toxicity-sample")
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    # copies of a text repeat its contexts, so a word counts once for each pair of neighbours
    counts = stored(texts.mapInArrow(strings, "word string, context long, toxic int").distinct().groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean")), "toxicity-strings")
    kinds = [counts.where(kind).orderBy(F.desc("toxic"), F.xxhash64("word"), "word").limit(SAMPLE_WORDS).toArrow()
             for kind in ("clean = 0", "clean > 0 and toxic > 0", "toxic = 0")]
    table = pa.concat_tables([kind.slice(0, n) for kind, n in zip(
        kinds, shares([kind.num_rows for kind in kinds], SAMPLE_WORDS))])
    words = table["word"].to_pylist()
    toxic, clean = (table[c].to_numpy().astype(np.int64) for c in ("toxic", "clean"))
    model = None
    if len(sizes) == 2:
        model = fit_words(words, toxic, clean, toxic.sum() / max(toxic.sum() + clean.sum(), 1))
    if model is None:
        return Model("", np.zeros(0, np.int64), np.zeros(0, np.float32), -1.0, None)

    def text_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(model)
        for batch in batches:
            x = own.features([text.as_py() for text in batch.column(1)])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x[:, i]) for i in range(3))],
                                             names=["toxic", "a", "b", "c"])

    rows = texts.mapInArrow(text_features, "toxic int, a double, b double, c double").toArrow()  # 2 * SAMPLE_DOCS at most
    x = np.column_stack([*(rows[c].to_numpy() for c in "abc"), np.ones(len(rows))])
    model.text_weights = logistic(x, rows["toxic"].to_numpy().astype(float))
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every whole text; empty and null texts have the score of a text without words."""
    name = f"{id(model)}-{model.offset}-{len(model.keys)}-{model.text_weights}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scorer(model, name)
        for batch in batches:
            scores = own.scores([text.as_py() or "" for text in batch.column(1)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def score_column(model: Model) -> Column:
    """The score of column `text` as a column, for filters that keep whole rows."""
    name = f"{id(model)}-{model.offset}-{len(model.keys)}-{model.text_weights}"

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(scorer(model, name).scores([x or "" for x in text.to_pylist()]), pa.float64())

    return score(F.col("text"))
