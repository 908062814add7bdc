"""Incremental landing: new files of an inbox are taken once, the checkpoint remembers which."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.sources.editions import edition_path
from surveyloom.sources.store import copy_files

#: Spark's own columns of a file listing, which a stream has to be told.
LISTING = "path string, modificationTime timestamp, length long, content binary"


def land_new_files(spark: SparkSession, inbox: str, bronze: str, edition: int, checkpoint: str) -> None:
    """Put the files of `inbox` not seen before below the edition's folder, then stop.

    The stream carries names and lengths only; tasks copy the files byte by byte (see `sources.store`), whatever their
    size and encoding. A batch has a folder named by checkpoint and batch, and its files have names of their own there, so
    a repeated batch replaces them with the same bytes: re-running lands nothing twice, also after a failure half way.
    The memory of taken files stays in the checkpoint; delivered files beside the batches stay visible.
    """
    name = hashlib.sha1(checkpoint.encode()).hexdigest()[:8]

    def land(batch: DataFrame, number: int) -> None:
        copy_files(batch, f"{edition_path(bronze, edition)}/lote-{name}-{number:06d}")

    query = (
        spark.readStream.format("binaryFile").schema(LISTING).load(inbox)
        .select(F.col("path").alias("source"), "length")
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
