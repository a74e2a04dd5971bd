"""Helpers that the training-data operators share: sizes, shared folders, Arrow batches."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shared import checkpoint_folder, ship

#: Rows in an Arrow batch between Spark and Python; long texts make batches of rows large.
BATCH_ROWS = 1000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches, send this package's code to the executors once, and make sure that checkpoint() has a folder.

    The cluster's ``spark.checkpoint.dir`` is used where it is set. A folder of our own is made only in
    local mode without one, as in tests; on a cluster without one, checkpoint() reports the missing setting.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ship(spark)
    checkpoint_folder(spark)


def give_back() -> None:
    """Returns what a worker has freed to the system. Workers live through many stages; without this each keeps what the
    largest of them took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def giving_back(f):
    """For mapInArrow: f, and when a task ends what it freed goes back to the system, so that idle workers wait with little."""

    def run(batches):
        yield from f(batches)
        give_back()

    return run


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts; one column is read, one row comes back."""
    return docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("n")).first()["n"] or 0


def fold(id_col: str, mod: int) -> Column:
    """crc32 of the id written as text, modulo mod (null id: as the text '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def arrow_schema(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def free_name(taken: list[str], wanted: str) -> str:
    """wanted, with underscores before it for as long as a column has that name (case is ignored)."""
    names = {x.lower() for x in taken}
    while wanted.lower() in names:
        wanted = f"_{wanted}"
    return wanted
