"""Mixing sources to target weights: blocks, permuted slots, and a join by block index. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.llm.frames import buckets_for, stored, with_offsets

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 512  # words in a block
SHARD_SLOTS = 4096  # blocks in an output shard
ROUNDS = 24
CHUNK = 4096  # slots that one row stands for until rows are dealt out


def permuted(index: Column, size: Column, *key: Column | int, inverse: bool = False) -> Column:
    """Where a pseudorandom permutation of 0 .. size-1 puts `index`: a swap-or-not shuffle keyed by `key`.

    Each round pairs x with (k - x) mod size and swaps the pair on a hash bit of the larger one. Every round undoes
    itself, so the rounds in reverse order are the inverse. Any size works, without tables and without retries.
    """
    parts = [F.lit(k) if isinstance(k, int) else k for k in key]

    def swap(x: Column, turn: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*parts, turn), size) - x, size)
        bit = F.xxhash64(F.lit(1), *parts, turn, F.greatest(x, partner)).bitwiseAND(F.lit(1).cast("long"))
        return F.when(bit == 1, partner).otherwise(x)

    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(turns, index.cast("long"), swap)


def source_targets(sources: DataFrame, most: int = 3) -> DataFrame:
    """Add the word target of each source: columns source, source_size in; rank, weight and target are added.

    Sources by code point, null last, weigh 1, 2, 3, 1, ...; targets share all words by weight and stop at `most`
    times the source's size. What capped sources leave is shared again: with sources in order of cap by weight, the
    level that the rest reaches is the largest of (words left) / (weight left), so one pass replaces the rounds.
    One row per source is sorted here, never documents.
    """
    everything = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(everything) - 1)
    weighed = ranked.withColumns({
        "weight": F.col("rank") % 3 + 1,
        "cap": (F.col("source_size") * most).cast("double"),
    })
    order = Window.partitionBy().orderBy(F.col("cap") / F.col("weight"), "rank")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = weighed.withColumn("level", (
        (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))))
    return left.withColumn(
        "target", F.least("cap", F.max("level").over(whole) * F.col("weight"))).drop("cap", "level")


def _streams(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Each document's place in its source's stream of words: rank, doc_id, digest, size, start."""
    rows = docs.join(sources.select("source", "rank"), F.equal_null(docs.source, sources.source)).select(
        "rank", "doc_id", "digest", "size")
    return with_offsets(rows, ["rank"], ["doc_id", "digest", "size"], F.col("size"), buckets_for(docs.count()), "start")


def _slots(sources: DataFrame, block: int, seed: int, tasks: int) -> DataFrame:
    """One row per slot of the mix: rank, epoch, slot, block, take, place.

    A source's target is filled epoch by epoch; each epoch has its own permutation of the source's block indices,
    and the last slot of the last epoch is cut so that the words taken are the whole part of the target. `place` is
    the slot's position among all slots under one more permutation: output shards are runs of places, so their
    source counts are multinomial draws under the condition that they add up to the targets. Chunks of slots are dealt
    out to a stated number of tasks; few bytes stand for many slots, so adaptive execution must not merge them.
    """
    full = F.floor(F.col("target") / F.col("source_size"))
    epochs = (
        sources.where("source_size > 0")
        .withColumns({"words": F.floor("target"), "blocks": F.ceil(F.col("source_size") / block)})
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), full)))
        .withColumn("quota", F.least("source_size", F.col("words") - F.col("epoch") * F.col("source_size")))
        .where("quota > 0")
        .withColumn("short", block * F.col("blocks") - F.col("source_size"))
        .withColumn("short_at", permuted(F.col("blocks") - 1, F.col("blocks"), seed, F.col("rank"), F.col("epoch"),
                                         inverse=True))
    )
    # slots needed: whole blocks, and one more where the short block is among them and leaves something over
    cut = F.ceil(F.col("quota") / block)
    some = cut + F.when((F.col("short_at") < cut) & (cut * block - F.col("short") < F.col("quota")), 1).otherwise(0)
    epochs = epochs.withColumn("slots", F.least(some, "blocks"))
    order = Window.partitionBy().orderBy("rank", "epoch")
    epochs = epochs.withColumns({
        "first": F.coalesce(F.sum("slots").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "all_slots": F.sum("slots").over(Window.partitionBy()),
    })
    chunks = epochs.withColumn("chunk", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / CHUNK)))).repartition(tasks, "rank", "epoch", "chunk")
    slots = chunks.withColumn("slot", F.explode(F.sequence(
        F.col("chunk") * CHUNK, F.least((F.col("chunk") + 1) * CHUNK, "slots") - 1)))
    last = F.col("blocks") - 1
    ahead = F.col("slot") * block - F.when(F.col("slot") > F.col("short_at"), F.col("short")).otherwise(0)
    return slots.withColumn(
        "block", permuted(F.col("slot"), F.col("blocks"), seed, F.col("rank"), F.col("epoch"))
    ).select(
        "rank", "epoch", "slot", "block",
        F.least(block - F.when(F.col("block") == last, F.col("short")).otherwise(0), F.col("quota") - ahead).alias("take"),
        permuted(F.col("first") + F.col("slot"), F.col("all_slots"), seed, -1).alias("place"),
    ).where("take > 0")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words and a digest of the text, written once: the text itself is read here only."""
    return stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("digest"),
    ), "mix-sizes")


def mix(docs: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = 7) -> dict[str, DataFrame]:
    """Mix all documents to the target weights of their sources.

    Returns `sources` (source, source_size, rank, weight, target), `streams` (rank, doc_id, digest, size, start) and
    `pieces`: shard, slot_in_shard, rank, epoch, doc_id, digest, start (of the document in its source's stream),
    first and last (word positions in the document, end exclusive). Words taken from a source are the whole part of
    its target, an epoch takes a word once at most, and no target passes three epochs. Everything follows from the
    rows and the seed. A null text has no words; documents without words take no part in pieces; null sources form
    one source; null and repeated ids are separate rows; an empty table gives empty frames.

    A hot source is spread by block index everywhere, and its stream is laid out in buckets. Slots and documents are
    merged by sorting: what a chunk of slots weighs says nothing about the slots, so none are broadcast.
    """
    sizes = measured(docs)
    sources = stored(source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size"))), "mix-sources")
    streams = stored(_streams(sizes, sources), "mix-streams")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = _slots(sources, block, seed, tasks).hint("merge")
    span = (streams.where("size > 0")
            .withColumn("block", F.explode(F.sequence(
                F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)))))
    pieces = span.join(slots, ["rank", "block"]).select(
        F.floor(F.col("place") / shard_slots).alias("shard"),
        (F.col("place") % shard_slots).alias("slot_in_shard"),
        "rank", "epoch", "doc_id", "digest", "start",
        F.greatest(F.col("block") * block - F.col("start"), F.lit(0)).alias("first"),
        F.least("size", F.col("block") * block + F.col("take") - F.col("start")).alias("last"),
    ).where("last > first")
    return {"sizes": sizes, "sources": sources, "streams": streams, "pieces": pieces}


def words_taken(docs: DataFrame, **options: int) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, the words the mix takes, repeats counted, and the shard
    and slot of the first block that takes some (null if none does)."""
    parts = mix(docs, **options)
    taken = parts["pieces"].groupBy("rank", "start").agg(
        F.sum(F.col("last") - F.col("first")).alias("taken"), F.min(F.struct("shard", "slot_in_shard")).alias("at"))
    counted = parts["streams"].where("size > 0").join(taken, ["rank", "start"], "left").select(
        "doc_id", "size", "rank", "taken", "at.shard", F.col("at.slot_in_shard").alias("slot")).unionByName(
        parts["streams"].where("size = 0").select("doc_id", "size", "rank", *(
            F.lit(None).cast("long").alias(c) for c in ("taken", "shard", "slot"))))
    return counted.join(parts["sources"].select("rank", "source_size", "target"), "rank").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "shard", "slot")


def mixed_documents(docs: DataFrame, **options: int) -> DataFrame:
    """The mix as documents: for each epoch that takes words of a document one row with those words.

    All columns of `docs` are kept. A document taken whole keeps its text to the byte; of a document that a block
    boundary cuts, the words taken are joined by single spaces. n_chars, where there is such a column, follows the
    text. Documents of which nothing is taken, and documents without words, do not appear. Rows are laid out by output
    shard, in slot order within it: a row lies where its first words do.
    """
    parts = mix(docs, **options)
    runs = parts["pieces"].groupBy("doc_id", "digest", "rank", "start", "epoch").agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"),
        F.sum(F.col("last") - F.col("first")).alias("words"),
        F.min(F.struct("first", "shard", "slot_in_shard")).alias("at"))
    rows = runs.groupBy("doc_id", "digest", "rank", "start").agg(
        F.sort_array(F.collect_list(F.struct("epoch", "runs", "words", "at"))).alias("epochs"))
    picked = rows.groupBy("doc_id", "digest", "rank").agg(
        F.sort_array(F.collect_list(F.struct("start", "epochs"))).alias("copies"))
    picked = picked.join(parts["sources"].select("rank", "source"), "rank").select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("source").alias("__source"), "copies"
    ).withColumnRenamed("copies", "__copies")
    keyed = docs.withColumns({"__d": F.xxhash64("text"), "__i": F.col("doc_id").cast("long"),
                              "__s": F.col("source").cast("string")})
    joined = keyed.join(picked, F.col("__i").eqNullSafe(F.col("__id")) & (F.col("__d") == F.col("__digest"))
                        & F.col("__s").eqNullSafe(F.col("__source")))
    copy = Window.partitionBy("__id", "__digest", "__source").orderBy("__digest")
    numbered = joined.withColumn("__copy", F.row_number().over(copy))
    taken = numbered.withColumn("__e", F.explode(F.get(F.col("__copies"), F.col("__copy") - 1)["epochs"]))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    part = F.array_join(F.flatten(F.transform(F.col("__e.runs"), lambda run: F.slice(
        F.col("__words"), (run["first"] + 1).cast("int"), (run["last"] - run["first"]).cast("int")))), " ")
    whole = F.col("__e.words") == F.regexp_count("text", F.lit(WORD))
    text = F.when(whole, F.col("text")).otherwise(part)
    taken = taken.withColumn("__words", F.when(~whole, words)).withColumn("text", text)
    if "n_chars" in docs.columns:
        taken = taken.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    order = [F.col("__e.at.shard"), F.col("__e.at.slot_in_shard"), F.col("__i"), F.col("__d"), F.col("__e.epoch")]
    return taken.repartition(F.col("__e.at.shard")).sortWithinPartitions(*order).select(*docs.columns)
