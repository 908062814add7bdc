"""Token ids in fixed-width bit packing: block files with offsets, read back whole or at a place."""

from __future__ import annotations

import hashlib
import io
import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyloom.llm.frames import kept_by_worker

#: Magic, bits of an id, documents, ids. Then int64 doc ids, int64 null flags as bytes, uint64 ends, packed ids.
HEADER = "<4sIQQ"
MAGIC = b"TKB1"
BLOCK_END = "\n"
#: Ids after which a block is closed; only a longer document makes a larger block.
BLOCK_IDS = 1 << 16
BLOCKS_PER_FILE = 512
#: Words whose ids a worker remembers; twice as many while it forgets the older ones.
REMEMBERED = 500_000
MARK = "\x01"
#: Bytes of texts that are encoded together, but for the text that goes beyond.
GROUP = 1 << 18
#: Letters that no normal form changes and that are lowered one by one in every Unicode version, then ASCII marks but
#: the apostrophe, which may begin a contraction.
LETTERS_AND_MARKS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: Those letters as byte-level models spell them: a character for each byte, bytes that are none shown from 256 on.
SPELLED = {c: "".join({0x9F: "\u0141", 0xA0: "\u0142", 0xAD: "\u0143"}.get(b, chr(b)) for b in chr(c).encode()) for c in range(0xDF, 0x100)}
#: Tasks that read files at most.
MOST_TASKS = 50_000


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids below 2**bits in `bits` bits each, lowest bit first, padded to whole bytes."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return raw[:, : bits // 8].tobytes()
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :bits], bitorder="little").tobytes()


def unpack(data: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """`count` ids from the id at `first` on; only the bytes that hold them are looked at."""
    start, end = first * bits, (first + count) * bits
    part = np.frombuffer(data, np.uint8)[start // 8: -(-end // 8)]
    out = np.zeros((count, 4), np.uint8)
    if bits % 8 == 0:
        out[:, : bits // 8] = part.reshape(count, bits // 8)
    else:
        wide = np.unpackbits(part, bitorder="little")[start % 8: start % 8 + end - start].reshape(count, bits)
        out[:, : -(-bits // 8)] = np.packbits(wide, axis=1, bitorder="little")
    return out.view("<u4").ravel()


def _steps(part: dict | None, inner: str) -> list[dict]:
    return [] if not part else part[inner] if part["type"] == "Sequence" else [part]


def drops_blanks(spec: str) -> bool:
    """Whether a tokenizer lowers texts and then keeps only pieces without white space, as its own settings say.

    Then a text's ids are those of its words in turn. A tokenizer of another build gets whole texts.
    """
    settings = json.loads(spec)
    normal = _steps(settings.get("normalizer"), "normalizers")
    cuts = _steps(settings.get("pre_tokenizer"), "pretokenizers")
    if not cuts or cuts[0]["type"] != "Split" or "Lowercase" not in [n["type"] for n in normal] or not {
            n["type"] for n in normal} <= {"Lowercase", "NFC", "Replace"}:
        return False
    pattern = cuts[0]["pattern"].get("Regex", "")
    return (cuts[0]["behavior"], cuts[0]["invert"]) == ("Removed", True) and pattern.endswith("[^\\s\\p{L}\\p{N}]+") and not (
        set(" .") & set(pattern)) and "\\s" not in pattern.removesuffix("[^\\s\\p{L}\\p{N}]+")


def keeps_letters(spec: str) -> bool:
    """Whether a run of plain letters (see `LETTERS_AND_MARKS`), lowered, reaches the tokenizer's byte-level model as it is
    and as a whole, and the marks after it as a piece of their own."""
    settings = json.loads(spec)
    if not drops_blanks(spec) or settings.get("truncation") or settings.get("padding"):
        return False
    first, *others = _steps(settings["pre_tokenizer"], "pretokenizers")
    runs = [p for p in first["pattern"]["Regex"].split("|") if not re.fullmatch("'[a-z]+", p)]
    replaced = [n for n in _steps(settings["normalizer"], "normalizers") if n["type"] == "Replace"]
    return sorted(runs) == sorted(("[\\p{L}]+", "[\\p{N}]", "[^\\s\\p{L}\\p{N}]+")) and all(
        (n["pattern"], n["content"]) == ({"Regex": "\\s+"}, " ") for n in replaced) and [
        (c["type"], c.get("add_prefix_space"), c.get("use_regex")) for c in others] == [("ByteLevel", False, False)]


def ends_in_letter(word: str) -> bool:
    """Whether a word, composed and lowered, ends in a letter of every Unicode version, so that a closing mark after it
    is a piece of its own. Lowering or composing can leave a combining mark at the end, which joins what follows."""
    return word.isascii() or unicodedata.ucd_3_2_0.category(unicodedata.normalize("NFC", word).lower()[-1])[0] == "L"


class Encoder:
    """Ids of whole texts by one tokenizer file, remembering the ids of words between blanks.

    That holds for tokenizers that drop white space before they split (see `drops_blanks`). Only line feeds and blanks
    are cut at; whatever else a word holds is left to the tokenizer, but plain letters go to its model directly where
    the steps before would leave them as they are (see `keeps_letters`).
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.by_word = drops_blanks(spec)
        self.new: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.model = self.tokenizer.model if keeps_letters(spec) else None
        size = 1 + max(self.tokenizer.get_vocab().values())
        self.packed = [bytes(x) for x in np.arange(size, dtype="<u4")[:, None].view(np.uint8)]

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of words, by one call for all that a lone mark can keep apart."""
        apart = [w for w in words if MARK not in w and len(w) < 200] if self.mark is not None else []
        found: dict[str, bytes] = {}
        if apart:
            joined = self.tokenizer.encode_batch_fast([f" {MARK} ".join(apart)], add_special_tokens=False)[0]
            ids = np.array(joined.ids, "<u4")
            ends, raw = [*(4 * np.flatnonzero(ids == self.mark)).tolist(), 4 * len(ids)], ids.tobytes()
            if len(ends) == len(apart):
                found = {w: raw[a:b] for w, a, b in zip(apart, [0, *(x + 4 for x in ends)], ends)}
        return [found[w] if w in found else np.array(
            self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]

    def _learn(self, words: Iterable[str]) -> None:
        new, old, packed = self.new, self.old, self.packed
        known, before = new.get, old.get
        tokenize, plain = (self.model.tokenize, LETTERS_AND_MARKS.fullmatch) if self.model else (None, lambda word: None)
        left = []
        for word in words:
            if (ids := before(word)) is None:
                if (found := plain(word)) is None:
                    left.append(word)
                    continue
                stem, tail = found.groups()
                stem = stem.lower()
                if (ids := known(stem)) is None:
                    if (ids := before(stem)) is None:
                        piece = stem if stem.isascii() else stem.translate(SPELLED)
                        ids = b"".join([packed[token.id] for token in tokenize(piece)])
                    new[stem] = ids
                if tail:
                    if (end := known(tail)) is None:
                        new[tail] = end = self._encode([tail])[0]
                    ids += end
            new[word] = ids
        if left:
            self._learn_others(left)

    def _learn_others(self, words: list[str]) -> None:
        stems, ask = {}, {}
        for word in words:
            # one closing mark after letters is a piece of its own, and ASCII letters are lowered by the tokenizer
            tail = word[-1] if word[-1] in ".,;:!?" and word[:-1].isalpha() and ends_in_letter(word[:-1]) else ""
            stem = word[:-1] if tail else word
            stem = stem.lower() if stem.isascii() and stem.isalpha() else stem
            stems[word] = stem, tail
            for piece in (stem, tail):
                if piece not in self.new and piece not in ask:
                    ask[piece] = self.old.get(piece)
        missing = [piece for piece, ids in ask.items() if ids is None]
        ask.update(zip(missing, self._encode(missing)))
        self.new.update(ask)
        for word, (stem, tail) in stems.items():
            self.new[word] = self.new[stem] + self.new[tail]

    def together(self, texts: Sequence[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text. Words that are new in any of them are learned at once."""
        if not self.by_word:
            return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        if len(self.new) > REMEMBERED:
            self.old, self.new = self.new, {"": b""}
        rows, missing = [], set()
        for text in texts:
            words = text.replace("\n", " ").split(" ")
            ids = list(map(self.new.get, words))
            gaps = [i for i, x in enumerate(ids) if x is None] if None in ids else []
            missing.update([words[i] for i in gaps])
            rows.append((ids, [(i, words[i]) for i in gaps]))
        self._learn(missing)
        for ids, gaps in rows:
            for i, word in gaps:
                ids[i] = self.new[word]
        return [b"".join(ids) for ids, _ in rows]

    def __call__(self, text: str) -> bytes:
        return self.together([text])[0]


def encoder(spec: str) -> Encoder:
    """The worker's encoder for a tokenizer; a reused worker keeps it from task to task."""
    return kept_by_worker(f"tokens {hashlib.sha1(spec.encode()).hexdigest()}", lambda: Encoder(spec))


def groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts that are encoded together: a run ends with the text that brings it to GROUP bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first = held = 0
    for i, size in enumerate(sizes.tolist(), 1):
        held += size
        if held >= GROUP or i == len(sizes):
            yield first, i
            first, held = i, 0


def block(doc_ids: list[int | None], ids: list[bytes], bits: int) -> bytes:
    ends = np.cumsum([len(x) // 4 for x in ids], dtype="<u8")
    return b"".join((
        struct.pack(HEADER, MAGIC, bits, len(ids), int(ends[-1])),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
        np.array([x is None for x in doc_ids], np.uint8).tobytes(),
        ends.tobytes(),
        pack(np.frombuffer(b"".join(ids), "<u4"), bits),
    ))


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1) -> None:
    """Encode whole texts (null: empty), end each with `end_id`, and write ids as block files in doc_id order.

    An id takes the bits that the largest vocabulary id needs. A block holds whole documents: a header, their doc ids
    and ends, and their packed ids. Files are named in order, as their blocks and documents are; null doc_ids come
    first, rows with the same doc_id by text. Spark's text writer writes the blocks, each followed by a line feed, so
    files are committed like any other output. An empty table gives no blocks.

    Texts are dealt out by range of doc_id once, before they are encoded.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    from tokenizers import Tokenizer

    size = Tokenizer.from_str(spec).get_vocab_size()
    bits = max(size - 1, end_id).bit_length()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(spec)
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block(doc_ids, ids, bits)], pa.binary())], names=["block"])

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in groups(texts):
                own = [x or "" for x in texts[a:b].to_pylist()]
                for doc_id, found in zip(names[a:b], encode.together(own)):
                    doc_ids.append(doc_id)
                    ids.append(found + end)
                    held += len(ids[-1]) // 4
                    if held >= BLOCK_IDS:
                        yield out()
                        doc_ids, ids, held = [], [], 0
        if ids:
            yield out()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    (ordered.mapInArrow(run, "block binary").select(F.col("block").cast("string").alias("value"))
     .write.option("lineSep", BLOCK_END).option("maxRecordsPerFile", BLOCKS_PER_FILE).text(path))


def opened(path: str) -> io.BufferedReader:
    store, name = fs.FileSystem.from_uri(path.replace("file:/", "file:///") if path.startswith("file:/") and
                                         not path.startswith("file://") else path)
    return io.BufferedReader(store.open_input_file(name), 1 << 20)


def read_block(file: io.BufferedReader, ids: bool = True) -> tuple[list, np.ndarray, int, bytes] | None:
    """doc ids, ends, bits and packed ids of the block at the file's position (None at the end)."""
    head = file.read(struct.calcsize(HEADER))
    if not head:
        return None
    magic, bits, docs, n = struct.unpack(HEADER, head)
    if magic != MAGIC:
        raise ValueError(f"no block before byte {file.tell()}")
    doc_ids = np.frombuffer(file.read(8 * docs), "<i8")
    null = np.frombuffer(file.read(docs), np.uint8)
    ends = np.frombuffer(file.read(8 * docs), "<u8").astype(np.int64)
    size = -(-n * bits // 8)
    data = file.read(size) if ids else b""
    if ids and len(data) != size:
        raise ValueError("the last block is cut off")
    file.seek(len(BLOCK_END) + (0 if ids else size), io.SEEK_CUR)
    return [None if x else int(i) for i, x in zip(doc_ids, null)], ends, bits, data


def _files(spark: SparkSession, path: str) -> DataFrame:
    """The names of the files, dealt out to about as many tasks: adaptive execution would merge so few bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path")
    return files.repartition(max(1, min(files.count(), MOST_TASKS)), "path")


def _numbered(rows: DataFrame, count: str) -> DataFrame:
    """Add `base`, the ids of all earlier files, by the order of their names; one row per file is sorted for it."""
    sums = rows.groupBy("path").agg(F.sum(count).alias("__n"))
    name = F.regexp_extract("path", r"part-(\d+)-.*?(?:-c(\d+))?\.[^/]*$", 1).cast("long")
    piece = F.regexp_extract("path", r"part-(\d+)-.*-c(\d+)[^/]*$", 2)
    order = Window.orderBy(name, F.when(piece != "", piece).cast("long"), "path")
    bases = sums.select("path", F.coalesce(F.sum("__n").over(
        order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return rows.join(bases, "path")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files alone: path, place (in the file), doc_id, in_file, ids (array of int)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with opened(name) as file:
                    place = done = 0
                    while (found := read_block(file)) is not None:
                        doc_ids, ends, bits, data = found
                        n = len(doc_ids)
                        ids = unpack(data, bits, 0, int(ends[-1])).astype(np.int32)
                        starts = np.concatenate([[0], ends[:-1]])
                        yield pa.RecordBatch.from_arrays([
                            pa.array([name] * n), pa.array(range(place, place + n), pa.int64()),
                            pa.array(doc_ids, pa.int64()), pa.array(starts + done),
                            pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1]).astype(np.int32)), pa.array(ids)),
                        ], names=["path", "place", "doc_id", "in_file", "ids"])
                        place, done = place + n, done + int(ends[-1])

    return _files(spark, path).mapInArrow(run, "path string, place long, doc_id long, in_file long, ids array<int>")


def token_table(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of every document, read from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with opened(name) as file:
                    done = 0
                    while (found := read_block(file)) is not None:
                        doc_ids, ends, bits, data = found
                        starts = np.concatenate([[0], ends[:-1]])
                        ids = unpack(data, bits, 0, int(ends[-1]))
                        crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends)]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([name] * len(ends)), pa.array(doc_ids, pa.int64()), pa.array(starts + done),
                            pa.array(ends - starts), pa.array(crc, pa.int64()),
                        ], names=["path", "doc_id", "in_file", "n_tokens", "ids_crc32"])
                        done += int(ends[-1])

    from surveyloom.llm.frames import stored

    rows = stored(_files(spark, path).mapInArrow(
        run, "path string, doc_id long, in_file long, n_tokens long, ids_crc32 long"), "token-rows")
    return _numbered(rows, "n_tokens").select(
        "doc_id", (F.col("base") + F.col("in_file")).alias("start"), "n_tokens", "ids_crc32")


def block_index(spark: SparkSession, path: str) -> DataFrame:
    """Where each block lies: path, offset (bytes), first (id of the whole corpus), n_tokens. Headers alone are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with opened(name) as file:
                    done, offset = 0, file.tell()
                    while (found := read_block(file, ids=False)) is not None:
                        n = int(found[1][-1])
                        yield pa.RecordBatch.from_pylist([
                            {"path": name, "offset": offset, "in_file": done, "n_tokens": n}])
                        done, offset = done + n, file.tell()

    from surveyloom.llm.frames import stored

    rows = stored(_files(spark, path).mapInArrow(
        run, "path string, offset long, in_file long, n_tokens long"), "token-index")
    return _numbered(rows, "n_tokens").select(
        "path", "offset", (F.col("base") + F.col("in_file")).alias("first"), "n_tokens")


def token_range(index: DataFrame, first: int, count: int) -> np.ndarray:
    """Ids first .. first + count - 1 of the corpus: the index names the blocks, and only those are read."""
    blocks = index.where((F.col("first") < first + count) & (F.col("first") + F.col("n_tokens") > first)).orderBy("first")
    parts = []
    for row in blocks.collect():  # as many as `count` ids span
        with opened(row["path"]) as file:
            file.seek(row["offset"])
            _, ends, bits, data = read_block(file)
        a = max(0, first - row["first"])
        b = min(int(ends[-1]), first + count - row["first"])
        parts.append(unpack(data, bits, a, b - a))
    return np.concatenate(parts) if parts else np.zeros(0, "<u4")
