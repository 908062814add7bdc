"""Where this package may write intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SETTING, _WAREHOUSE = "spark.checkpoint.dir", "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: the one the session names, or where it names none, one in the warehouse."""
    return spark.conf.get(_SETTING, None) or f"{spark.conf.get(_WAREHOUSE).rstrip('/')}/_shared"


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/surveyloom/{name}-{uuid.uuid4().hex[:12]}"
