"""A layer's incremental run, as one Spark job over all events that need it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import append_ledger, drop_stale_partitions, read_ledger, write_partitions, write_quarantine
from ..sources.staged import Table
from .core import ledger_state, pending
from .quality import validate


def run_layer(
    spark: SparkSession,
    pipeline: str,
    sources: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    rules: Sequence[Callable[[DataFrame], DataFrame]],
    out: str,
    ledger: str,
    quarantine: str,
    keys: Sequence[str] = ("event_year", "event_id"),
    run_id: str = "run",
    force: bool = False,
    dry_run: bool = False,
    retry_failed: bool = True,
    retry_quarantined: bool = False,
    staged: bool = False,
) -> DataFrame:
    """Runs the events that are new, changed or failed, and returns what became of each: (event_id, fingerprint, status).

    sources: event_id, fingerprint, and what transform needs. transform gives rows with event_id and keys; rules give
    failures by event (operators.quality). An event with failures goes to quarantine as a whole (status dq_failed), one
    that gives no rows is failed, and neither stops the others. Good events replace their own partitions, and only
    then does the ledger say so: a crash repeats work and loses none. Partitions that a good event had and has no more, as
    when its year changes, go. With dry_run nothing is written, and the status is planned.

    staged: out is a table of sources.staged, of which readers see the old version or the new one and never parts of both; else
    partitions are overwritten where they stand, one after the other.
    """
    events = sources.select("event_id", "fingerprint").distinct()
    state = ledger_state(read_ledger(spark, ledger).where(F.col("pipeline") == pipeline))
    if force:
        todo = events
    else:
        again = pending(events, state, retry_failed, retry_quarantined)
        done = state.where("lower(status) = 'success'").select("event_id", F.col("fingerprint").alias("__done"))
        changed = events.join(done, "event_id").where("fingerprint != __done").select("event_id", "fingerprint")
        todo = again.union(changed).distinct()
    todo = todo.checkpoint()
    if dry_run:
        return todo.withColumn("status", F.lit("planned"))
    rows = transform(sources.join(todo, ["event_id", "fingerprint"], "left_semi")).checkpoint()
    good, failures = validate(rows, "event_id", [rule(rows) for rule in rules])
    failures = failures.checkpoint()
    good = good.checkpoint()  # what is written may be read from the same place
    bad = failures.select(F.col("group").alias("event_id"), F.lit(True).alias("__bad")).distinct()
    written = good.select("event_id", F.lit(True).alias("__good")).distinct()
    status = F.when(F.col("__bad"), "dq_failed").when(F.col("__good"), "success").otherwise("failed")
    outcome = todo.join(bad, "event_id", "left").join(written, "event_id", "left").select("event_id", "fingerprint", status.alias("status")).checkpoint()
    if not failures.isEmpty():
        write_quarantine(failures, quarantine, run_id)
    if not good.isEmpty():
        if staged:
            table = Table(spark, out, keys)
            table.publish(good, table.stale(good, "event_id", good) if "event_id" in keys else None)
        else:
            before = _partitions(spark, out, keys, good)
            write_partitions(good, out, keys)
            if before is not None:
                drop_stale_partitions(spark, out, before, keys, good)
    append_ledger(outcome.select(F.lit(pipeline).alias("pipeline"), F.col("event_id").cast("bigint").alias("event_id"), "status", "fingerprint", F.current_timestamp().alias("updated_at")), ledger)
    return outcome


def _partitions(spark: SparkSession, out: str, keys: Sequence[str], good: DataFrame) -> DataFrame | None:
    """Keys of the partitions at out that belong to the events of good; None if that cannot be told or nothing is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(out)
    if "event_id" not in keys or not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    kinds = dict(good.dtypes)
    there = spark.read.parquet(out).select(*(F.col(k).cast(kinds[k]) for k in keys)).distinct()
    return there.join(good.select("event_id").distinct(), "event_id", "left_semi").select(*keys).checkpoint()


def summary(outcome: DataFrame, limit: float = 0.5) -> DataFrame:
    """Counts by status, and whether the share of events that did not succeed passes the limit."""
    bad = F.count_if(F.col("status").isin("failed", "dq_failed"))
    return outcome.agg(F.count("*").alias("events"), F.count_if(F.col("status") == "success").alias("ok"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "dq_failed").alias("quarantined"), (bad > limit * F.count("*")).alias("exceeds"))
