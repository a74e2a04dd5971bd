"""Parquet tables whose files differ in their columns: footers are read once, into groups of equal schema.

A catalogue has a row for each file: its name, size, time and schema. Footers are read by tasks, of files that the catalogue does
not have yet; later reads look at no footer at all. A table is then read as one: files that agree with the wanted schema where
they have its columns go to one scan, whatever they lack; of the others each group of equal schema goes to a scan of its
own, whose columns are cast. The paths of all files are the driver's, as they are in Spark's own file index.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.shared import ship
from .files import list_files
from .staged import merged

#: where Spark writes a table's schema in a footer
_SPARK = b"org.apache.spark.sql.parquet.row.metadata"
CATALOGUE = "key string, size bigint, modified timestamp, schema string"

#: Columns that models of holes read.
HOLE_INPUTS = """
event_year bigint, tourn_id bigint, round_number bigint, hole_number bigint, player_key string, player_rating bigint, course_id bigint,
hole_length double, hole_par bigint, hole_score bigint, actual_strokes bigint, hole_to_par bigint, strokes_over_par bigint,
target_strokes_over_par bigint, division string, weather_available_flag boolean, wx_weather_missing_flag boolean,
wx_wind_speed_mps double, wx_wind_gust_mps double, wx_wind_dir_deg double, wx_temperature_c double, wx_precip_mm double,
wx_pressure_hpa double, wx_relative_humidity_pct double, feature_wind_speed_mps double, feature_wind_gust_mps double,
feature_wind_dir_deg double, feature_temp_c double, feature_precip_mm double, feature_pressure_hpa double,
feature_humidity_pct double, wind_speed_bucket string, layout_id bigint, feature_layout_id bigint, feature_course_id bigint,
source_content_sha256 string, row_hash_sha256 string
"""


def _footer(key: str) -> str | None:
    """A file's schema as Spark's JSON; None where its store cannot be reached from Python."""
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.pandas.types import from_arrow_schema

    try:
        scheme, _, rest = key.partition(":")
        if scheme == "file":
            store, path = fs.LocalFileSystem(), "/" + rest.lstrip("/")
        else:
            host, _, path = rest.lstrip("/").partition("/")
            store, top = fs.FileSystem.from_uri(f"{scheme}://{host}/")
            path = f"{top.rstrip('/')}/{path}"
        schema = pq.read_schema(path, filesystem=store)
    except Exception:  # noqa: BLE001  any store and file: the driver reads it by Spark, which reports what is wrong
        return None
    said = (schema.metadata or {}).get(_SPARK)
    return said.decode() if said else from_arrow_schema(schema.remove_metadata()).json()


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for d in batches:
        yield d.assign(schema=[_footer(k) for k in d["key"]])


def footers(spark: SparkSession, files: DataFrame) -> DataFrame:
    """files (key, size, modified) with the schema of each; a task reads many."""
    ship(spark)
    return files.select("key", "size", "modified").mapInPandas(_footers, CATALOGUE)


def refresh(spark: SparkSession, path: str, catalogue: str) -> int:
    """Brings a catalogue, a Parquet table of its own, up to the files under path; returns how many footers were read.

    Files that changed or are new get a row; those that are gone are left out when it is read (current).
    """
    known = _known(spark, catalogue)
    new = list_files(spark, path).join(known, ["key", "size", "modified"], "left_anti").checkpoint()
    n = new.count()
    if n:
        # few files, many footers a second: a task for a thousand of them
        found = footers(spark, new.repartition(1 + n // 1000)).checkpoint()
        lost = [r["key"] for r in found.where("schema is null").select("key").collect()]
        if lost:  # read by Spark itself, one by one
            said = spark.createDataFrame([(k, spark.read.parquet(k).schema.json()) for k in lost], "key string, schema string")
            found = found.where("schema is not null").unionByName(found.where("schema is null").drop("schema").join(said, "key"))
        found.write.mode("append").parquet(catalogue)
    return n


def _known(spark: SparkSession, catalogue: str) -> DataFrame:
    folder = spark._jvm.org.apache.hadoop.fs.Path(catalogue)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CATALOGUE)
    return spark.read.schema(CATALOGUE).parquet(catalogue)


def current(spark: SparkSession, path: str, catalogue: str) -> DataFrame:
    """The catalogue's rows of files that are there, as they are now."""
    return _known(spark, catalogue).join(list_files(spark, path), ["key", "size", "modified"], "left_semi").dropDuplicates(["key"])


def _without_void(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if not isinstance(f.dataType, T.NullType)])


def read_as(spark: SparkSession, path: str, schema: T.StructType | str | None, catalogue: str, partitions: Sequence[str] = ()) -> DataFrame:
    """The table at path with the columns of schema (None: all columns of all files, each as wide as needed), in any mix of
    files: what a file lacks, or has without a type as all is null, is null; other types are cast. partitions: columns of schema that
    are folders' keys; conditions on them choose folders before files are opened."""
    groups: dict[str, list[str]] = {}
    for r in current(spark, path, catalogue).select("key", "schema").collect():
        groups.setdefault(r["schema"], []).append(r["key"])
    own = {s: _without_void(T.StructType.fromJson(json.loads(s))) for s in groups}
    if schema is None:
        target = merged([own[s] for s in sorted(own)])
    else:
        target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kinds = {f.name: f.dataType for f in target.fields}
    scans: dict[str, tuple[T.StructType, list[str]]] = {}
    for s, keys in groups.items():
        fields = [f for f in own[s].fields if f.name in kinds and f.name not in partitions]
        agrees = all(f.dataType == kinds[f.name] for f in fields)
        at = "" if agrees else T.StructType(fields).json()
        scans.setdefault(at, (target if agrees else T.StructType([*fields, *(f for f in target.fields if f.name in partitions)]), []))[1].extend(keys)
    parts = []
    for layout, keys in scans.values():
        d = spark.read.schema(layout).option("basePath", path).parquet(*sorted(keys))
        have = set(layout.fieldNames())
        parts.append(d.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields)))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], target)


def hole_inputs(spark: SparkSession, path: str, catalogue: str) -> DataFrame:
    """The holes that models read: HOLE_INPUTS of a table partitioned by event_year and tourn_id."""
    return read_as(spark, path, HOLE_INPUTS, catalogue, ("event_year", "tourn_id"))
