"""Structured Streaming forms of the incremental run: new files, newest wins, repeats dropped, hourly windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.core import latest_by_struct
from ..operators.shared import cut

#: touched partitions that are named one by one when old rows are read; more are met by a join
NAMED = 10_000


def new_files(spark: SparkSession, path: str, schema, file_format: str = "parquet") -> DataFrame:
    """Rows of files that this stream's checkpoint has not seen yet."""
    return spark.readStream.schema(schema).format(file_format).load(path)


def changed_keys(stream: DataFrame, keys: Sequence[str], order: Sequence[str], partition: str) -> DataFrame:
    """The rows that are newer than all of their key before: stream's columns, and __been, the partitions that the key was
    in, its own among them. For update mode.

    The state store holds each key's newest row and when it was seen. A batch sends out the keys it has rows for; those whose
    newest row is older than the batch did not change. Of rows that tie in the order the one seen first stays.
    """
    seen = stream.withColumn("__seen", F.current_timestamp())  # the same for all rows of a batch
    row = F.struct(*stream.columns, "__seen")
    rank = F.struct(*order, (-F.unix_micros("__seen")).alias("__first"))
    state = seen.groupBy(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys))).agg(F.max_by(row, rank).alias("r"), F.max("__seen").alias("__now"), F.collect_set(F.struct(F.col(partition).cast("string").alias("p"))).alias("__been"))
    return state.where("r.__seen = __now").select(*(F.col(f"r.{c}").alias(c) for c in stream.columns), "__been")


def _old_rows(spark: SparkSession, out: str, changed: DataFrame, partition: str) -> DataFrame | None:
    """Rows at out in the partitions that changed keys are or were in; None if nothing is at out. Other partitions' files are
    not read: their folders are left out when files are listed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(out)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    touched = changed.select(F.explode("__been").alias("b")).select("b.p").distinct()
    old = spark.read.schema(changed.drop("__been").schema).parquet(out)
    named = [r["p"] for r in touched.limit(NAMED + 1).collect()]
    at = F.col(partition).cast("string")
    if len(named) <= NAMED:
        kind = changed.schema[partition].dataType
        values = [F.lit(v).cast(kind) for v in named if v is not None]
        chosen = F.col(partition).isin(*values) if values else F.lit(False)
        return old.where(chosen | F.col(partition).isNull() if None in named else chosen)
    return old.join(touched, at.eqNullSafe(touched["p"]), "left_semi")


def newest_wins(stream: DataFrame, out: str, keys: Sequence[str], order: Sequence[str], partition: str, checkpoint: str):
    """Keeps one row for each key at out, a table partitioned by one column.

    Only keys that changed reach a batch's merge (changed_keys), and only partitions that these are or were in are read and
    overwritten; a batch of old news reads and writes nothing. A batch that is repeated after a crash gives the same. The
    context needs a checkpoint folder (spark.checkpoint.dir, or SparkContext.setCheckpointDir).
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        changed = cut(batch)
        if changed.isEmpty():
            return
        rows = changed.drop("__been")
        old = _old_rows(spark, out, changed, partition)
        # what is read is written over, so it is cut from its files first
        best = cut(latest_by_struct(rows if old is None else rows.unionByName(old.select(*rows.columns)), list(keys), list(order)))
        best.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(out)
        _drop_left(spark, out, changed, best, partition)

    changes = changed_keys(stream, keys, order, partition)
    return changes.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _drop_left(spark: SparkSession, out: str, changed: DataFrame, best: DataFrame, partition: str) -> None:
    """A partition that all its keys have left has no rows to be overwritten with: its folder goes."""
    from ..sources.files import drop_stale_partitions

    been = changed.select(F.explode("__been").alias("b")).select(F.col("b.p").alias(partition)).distinct()
    drop_stale_partitions(spark, out, been, [partition], best.select(F.col(partition).cast("string").alias(partition)))


def drop_repeats(stream: DataFrame, hash_col: str, time_col: str, delay: str = "1 day") -> DataFrame:
    """Rows whose content was not seen within the delay."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([hash_col])


def hourly(stream: DataFrame, time_col: str, value: str, delay: str | None = "1 hour", mean=F.avg) -> DataFrame:
    """Count and mean by hour; rows that are later than the delay are dropped. None: the stream has a watermark already."""
    w = F.window(F.col(time_col), "1 hour")
    stream = stream.withWatermark(time_col, delay) if delay else stream
    return stream.groupBy(w).agg(F.count("*").alias("n"), mean(value).alias("mean_value")).select(F.col("window.start").alias("hour"), "n", "mean_value")


def run_now(stream: DataFrame, out: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there, and returns what it wrote below out. complete: the last state of all groups, else the
    rows of all batches."""
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows" if mode == "complete" else f"{out}/rows/batch={number}")

    stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    d = spark.read.option("basePath", f"{out}/rows").parquet(f"{out}/rows")
    return d.drop("batch") if mode != "complete" else d
