"""Chat rendering whose text parses back to the same turns."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROLES = {"system": "System", "user": "User", "assistant": "Assistant"}
NAMES = {v: k for k, v in ROLES.items()}
END = "</turn>"
#: What the template may mean, after any run of backslashes. A control string with a backslash before it is text.
CONTROL = re.compile(r'(\\*)(### (?:System:|User:|Assistant:|Role ")|</turn>)')
HEADER = re.compile(r'### (?:(System|User|Assistant)|Role ("(?:[^"\\\n]|\\.)*")):\n')
#: Characters after which a conversation goes on in another row; rows hold whole turns.
PART_CHARS = 1 << 20


def header(role: str) -> str:
    return f"### {ROLES[role]}:\n" if role in ROLES else f"### Role {json.dumps(role)}:\n"


def escape(text: str) -> str:
    return CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return CONTROL.sub(lambda m: m[1][1:] + m[2], text)


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """Turns of a rendered text: role, text, and where the text's characters start and end. ValueError if it is none."""
    turns, at = [], 0
    while at < len(text):
        head = HEADER.match(text, at)
        if head is None:
            raise ValueError(f"no turn at {at}")
        role = NAMES[head[1]] if head[1] else json.loads(head[2])
        stop = next((m for m in CONTROL.finditer(text, head.end()) if not m[1]), None)
        if stop is None or stop[2] != END or stop.start() <= head.end() - 1 or text[stop.start() - 1] != "\n" or (
                stop.start() - 1 < head.end()) or text[stop.end():stop.end() + 1] != "\n":
            raise ValueError(f"the turn at {at} does not end")
        end = stop.start() - 1
        turns.append((role, unescape(text[head.end():end]), head.end(), end))
        at = stop.end() + 1
    return turns


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn and where its text lies in it. The text is escaped once more until the parser gives it back."""
    body = text
    while True:
        head = header(role)
        out = f"{head}{body}\n{END}\n"
        try:
            if [(r, t) for r, t, _, _ in parse(out)] == [(role, text)]:
                return out, len(head), len(head) + len(body)
        except ValueError:
            pass
        body = escape(body)


def format_conversations(rows: DataFrame) -> DataFrame:
    """Rendered conversations: conv_id, part (from 0), text, loss (spans of assistant texts, code points in `text`).

    Turns are ordered by turn, role and text. Null texts and roles count as empty; roles that the template has no
    name for are written as JSON strings; rows without conv_id form one conversation; repeated rows are repeated
    turns; other columns are not read. A conversation is one row unless it passes PART_CHARS; then its rows hold
    whole turns in order. Turns stream through a task by sorted key, so no conversation is held at once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        conv, part, texts, loss, size, started, held = None, 0, [], [], 0, False, 0

        def close() -> None:
            nonlocal held
            done.append({"conv_id": conv, "part": part, "text": "".join(texts), "loss": loss})
            held += size

        for batch in batches:
            for row in batch.to_pylist():
                if started and (row["conv_id"] != conv or size >= PART_CHARS):
                    close()
                    part = part + 1 if row["conv_id"] == conv else 0
                    texts, loss, size = [], [], 0
                conv, started = row["conv_id"], True
                out, start, end = render(row["role"], row["text"])
                if row["role"] == "assistant":
                    loss.append({"start": size + start, "end": size + end})
                texts.append(out)
                size += len(out)
                if held >= PART_CHARS:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done, held = [], 0
        if started:
            close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), (
        "loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(run, "conv_id long, part long, text string, loss array<struct<start: long, end: long>>"))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, by parsing what was rendered: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and
    formatted_chars. Digests are fed part by part, so a conversation of any length takes the memory of one part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        conv, started, turns, chars, loss_chars = None, False, 0, 0, 0
        all_turns = all_loss = hashlib.sha256()

        def close() -> None:
            done.append({"conv_id": conv, "n_turns": turns, "turns_sha256": all_turns.hexdigest(),
                         "loss_chars": loss_chars, "loss_sha256": all_loss.hexdigest(), "formatted_chars": chars})

        for batch in batches:
            for row in batch.to_pylist():
                if not started or row["conv_id"] != conv:
                    if started:
                        close()
                    conv, started, turns, chars, loss_chars = row["conv_id"], True, 0, 0, 0
                    all_turns, all_loss = hashlib.sha256(), hashlib.sha256()
                for role, text, _, _ in parse(row["text"]):
                    all_turns.update(f"{role}\n{text}\n".encode())
                    turns += 1
                for span in row["loss"]:
                    learned = unescape(row["text"][span["start"]:span["end"]])
                    all_loss.update(learned.encode())
                    loss_chars += len(learned)
                chars += len(row["text"])
            if len(done) >= 10_000:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if started:
            close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def written(formatted: DataFrame, path: str) -> DataFrame:
    """The conversations as JSON Lines, one object per row, and read back."""
    spark: SparkSession = formatted.sparkSession
    formatted.write.json(path, ignoreNullFields=False)
    return spark.read.schema(formatted.schema).json(path)
