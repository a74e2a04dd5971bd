"""Raw snapshots, partitioned tables, quarantine, ledgers and published tables as files."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.core import latest_by_struct


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Raw JSON snapshots under path (not their .meta.json): key, the keys=values of the path, payload text, file times."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(path, wholetext=True)
    d = raw.select(F.col("_metadata.file_path").alias("key"), F.col("_metadata.file_modification_time").alias("modified"), F.col("value").alias("payload"))
    part = lambda name: F.nullif(F.regexp_extract("key", rf"/{name}=([^/]+)", 1), F.lit(""))
    return d.where(~F.col("key").endswith(".meta.json")).select(
        "key", part("event_id").try_cast("bigint").alias("event_id"), part("division").alias("division"), part("round").try_cast("int").alias("round_number"),
        part("provider").alias("provider"), part("source").alias("source_id"), part("fetch_ts").alias("fetch_ts"), "modified", "payload",
    )


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """(key of the snapshot, meta_sha256, meta_fetched_at) of .meta.json files."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.meta.json").text(path, wholetext=True)
    get = lambda n: F.get_json_object("value", f"$.{n}")
    return raw.select(F.regexp_replace("_metadata.file_path", r"\.meta\.json$", ".json").alias("key"), get("content_sha256").alias("meta_sha256"), get("fetched_at_utc").alias("meta_fetched_at"))


def with_sidecar(snapshots: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Hash and fetch time: of the sidecar, else computed and from the path."""
    pick = lambda *cs: F.coalesce(*(F.nullif(S.norm_text(c), F.lit("")) for c in cs))
    joined = snapshots.join(sidecars, "key", "left")
    return joined.withColumns({"content_sha256": pick("meta_sha256", F.sha2("payload", 256)), "fetched_at": pick("meta_fetched_at", "fetch_ts")}).drop("meta_sha256", "meta_fetched_at")


def latest_snapshots(snapshots: DataFrame, keys: Sequence[str] = ("event_id", "division", "round_number")) -> DataFrame:
    """The snapshot with the largest key of each group."""
    return latest_by_struct(snapshots, list(keys), ["key"])


def write_partitions(df: DataFrame, path: str, keys: Sequence[str] = ("event_year", "tourn_id")) -> None:
    """Replaces exactly the partitions that df has rows for; a re-run gives the same files' content."""
    df.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def read_events(spark: SparkSession, path: str, event_ids: Sequence[int] | None = None, schema=None) -> DataFrame:
    """A partitioned table; ids prune its partitions. Columns that some files lack are null."""
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    df = reader.parquet(path)
    return df.where(F.col("tourn_id").isin(*event_ids)) if event_ids is not None else df


def write_quarantine(errors: DataFrame, path: str, run_id: str) -> None:
    """Failures of quality rules, appended as JSON by run."""
    errors.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").json(path)


def append_ledger(rows: DataFrame, path: str) -> None:
    """Status rows (pipeline, event_id, status, fingerprint, updated_at). Written after the data, so a crash only repeats work."""
    rows.write.mode("append").parquet(path)


LEDGER = "pipeline string, event_id bigint, status string, fingerprint string, updated_at timestamp"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A ledger's rows; none where nothing was written yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def read_weather_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Weather snapshots under path. Round, provider and source come from the state key of the file's name, if it has one
    (WEATHER_OBS#ROUND#n#PROV#p#SRC#s, where s may contain #), else from the path's keys=values. A blank provider is the archive; snapshots
    without a source are left out; a payload that is no JSON object is wrapped as raw_payload."""
    d = read_snapshots(spark, path)
    # the path is encoded as a URI, and # stands encoded in file names
    name = F.url_decode(F.url_decode(F.regexp_replace(F.element_at(F.split("key", "/"), -1), r"\.json$", "")))
    part = lambda i: F.nullif(F.regexp_extract(name, r"^WEATHER_OBS#ROUND#(\d+)#PROV#([^#]*)#SRC#(.*)$", i), F.lit(""))
    d = d.withColumns(
        {
            "round_number": F.coalesce(part(1).try_cast("int"), "round_number"),
            "provider": F.coalesce(F.nullif(F.trim(F.coalesce(part(2), "provider")), F.lit("")), F.lit("open_meteo_archive")),
            "source_id": F.nullif(F.trim(F.coalesce(part(3), "source_id")), F.lit("")),
            "payload": F.when(F.ltrim("payload").startswith("{"), F.col("payload")).otherwise(F.concat(F.lit('{"raw_payload":'), "payload", F.lit("}"))),
        }
    )
    return d.where("source_id is not null and round_number is not null")


def write_snapshots(df: DataFrame, path: str, kind: str = "json") -> None:
    """Raw payloads (event_id, fetched_at, payload), a file for each fetch under event_id=/fetch_date=/fetch_ts=, appended only;
    pages (kind html) are compressed. The folder meta has each payload's hash beside its event and time."""
    d = df.withColumns({"fetch_date": F.date_format("fetched_at", "yyyy-MM-dd"), "fetch_ts": F.date_format("fetched_at", "yyyyMMdd'T'HHmmss'Z'")})
    keys = ["event_id", "fetch_date", "fetch_ts"]
    writer = d.select(*keys, F.col("payload").alias("value")).repartition(*keys).write.mode("append").partitionBy(*keys)
    writer.option("compression", "gzip" if kind == "html" else "none").text(f"{path}/{kind}")
    meta = d.select(*keys, F.sha2("payload", 256).alias("content_sha256"), F.octet_length("payload").alias("bytes"), F.col("fetched_at").cast("string").alias("fetched_at_utc"))
    meta.write.mode("append").partitionBy("event_id").json(f"{path}/meta")


#: characters that stand encoded in names of partition folders, besides control characters
ENCODED = "\"#%'*/:=?\\\x7f{[]^"
#: the folder of null and of empty text
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: folders that are removed at the same time
AT_ONCE = 16


def partition_folder(keys: Sequence[str]) -> Column:
    """<key>=<value>/... of a row, with values encoded as in names of partition folders."""
    special = "[" + "".join(f"\\x{ord(c):02x}" for c in ENCODED) + "\\x00-\\x1f]"

    def value(k: str) -> Column:
        text = F.col(k).cast("string")
        encoded = F.array_join(F.transform(F.split(text, ""), lambda c: F.when(c.rlike(special), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c)), "")
        return F.when(text.isNull() | (text == ""), NO_VALUE).otherwise(F.when(text.rlike(special), encoded).otherwise(text))

    return F.concat_ws("/", *(F.concat(F.lit(f"{k}="), value(k)) for k in keys))


def drop_stale_partitions(spark: SparkSession, path: str, parents: DataFrame, keys: Sequence[str] = ("event_year", "tourn_id"), children: DataFrame | None = None) -> int:
    """Removes folders under path of keys that parents has and children has not: an event that lost its holes loses the
    old file. Returns how many.

    Names come from Spark, encoded; they reach the driver a few at a time, and several are removed at once. A table in sources.staged
    needs no removal: its next version leaves such partitions out.
    """
    # folders are compared, not values: null and empty text have one folder
    stale = parents.select(partition_folder(keys).alias("folder")).distinct()
    if children is not None:
        stale = stale.join(children.select(partition_folder(keys).alias("folder")).distinct(), "folder", "left_anti")
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())

    def remove(name: str) -> int:
        # a child of a path is taken as it is, without decoding
        folder = reduce(lambda at, part: spark._jvm.org.apache.hadoop.fs.Path(at, part), name.split("/"), top)
        return int(fs.exists(folder) and fs.delete(folder, True))

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return sum(pool.map(remove, (r[0] for r in stale.toLocalIterator())))


def _quoted(value: object) -> str:
    return str(value) if isinstance(value, int) and not isinstance(value, bool) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_partition(spark: SparkSession, table: str, spec: dict[str, object], location: str) -> None:
    """Adds a partition of a partitioned table at a location, if it is not there yet."""
    values = ", ".join(f"`{k}`={_quoted(v)}" for k, v in spec.items())
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({values}) LOCATION {_quoted(location)}")


def request_fingerprint(dataset: str, settings: dict, event_ids: Sequence[int] | None = None) -> str:
    """sha256 of the canonical JSON of what a training run is asked for: the data's fingerprint, all settings of the model, and
    the events, in any order."""
    asked = {**settings, "dataset_fingerprint": dataset, "event_ids": sorted(int(x) for x in event_ids) if event_ids else None}
    return hashlib.sha256(json.dumps(asked, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def dataset_fingerprint(files: DataFrame) -> DataFrame:
    """One row: sha256 over (key, size, modified) of files, whatever their order; a file in several rows counts once."""
    row = F.sha2(F.concat_ws("|", "key", F.col("size").cast("string"), F.col("modified").cast("string")), 256)
    words = [F.conv(F.substring("__h", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)") for i in range(4)]
    sums = [F.coalesce(F.sum(w), F.lit(0)).cast("string") for w in words]
    return files.distinct().withColumn("__h", row).agg(F.sha2(F.concat_ws("|", F.count("*").cast("string"), *sums), 256).alias("fingerprint"))


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(key, size, modified) of files under path; their content is not read."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return d.select(F.col("path").alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def publish(df: DataFrame, name: str, path: str) -> None:
    """A table at a folder of its own, in place of what was there."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.mode("overwrite").option("path", path).option("compression", "snappy").saveAsTable(name)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Whole numbers of a text file, by lines and commas; other text is left out."""
    return spark.read.text(path).select(F.explode(F.split("value", ",")).alias("x")).select(S.to_int("x").alias("id")).where("id is not null").distinct()
