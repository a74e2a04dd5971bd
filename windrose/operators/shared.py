"""What jobs with Python tasks and checkpoints need from a session: this package on the executors, and a shared folder."""

from __future__ import annotations

import atexit
import io
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: list = []


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once for a context: tasks import it, wherever the driver has it from."""
    sc = spark.sparkContext
    if sc in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    path = Path(tempfile.mkdtemp(prefix="windrose-")) / "windrose.zip"
    path.write_bytes(data.getvalue())
    sc.addPyFile(str(path))  # the driver serves it to executors from there
    atexit.register(shutil.rmtree, path.parent, ignore_errors=True)
    _shipped.append(sc)


def checkpoint_folder(spark: SparkSession) -> None:
    """Makes sure that checkpoint() has a folder. The cluster's ``spark.checkpoint.dir`` is used where it is set. A folder of
    our own is made only in local mode without one, as in tests; on a cluster without one, checkpoint() reports it."""
    sc = spark.sparkContext
    if not sc.getConf().get("spark.checkpoint.dir") and not sc._jsc.sc().getCheckpointDir().isDefined() and sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="windrose-checkpoint-"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which all executors see."""
    checkpoint_folder(spark)
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return f"{top}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df by way of Parquet in the shared folder: what is wide or made by a long plan and is read more than once. Readers take the
    columns that they need, and a small result is known to be small."""
    path = shared_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """df by way of the shared checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()
