"""Tables of partitions that change as a whole: data beside data, and a manifest that one rename publishes.

    <table>/data/run=<run>/<key>=<value>/part-...   what one run wrote; never changed
    <table>/manifests/<number>                      the partitions of one version: keys, the run that holds each, its schema
    <table>/manifests/.<number>-<run>               a manifest on its way

A run writes its data first, then the manifest of the next version under a name that readers do not look at, and then renames
it. The rename is the commit: before it readers see the old version, after it the new one, and never parts of both. Two runs
that start from one version cannot both commit, as the second finds the number taken. A run that ends on the way leaves only files
that no manifest names: `recover` renames a finished manifest of the next version, and takes away all others; `vacuum` takes away the
data of runs that no kept version needs.

A manifest is a table itself, so the number of partitions is not the driver's matter. It also holds the schema of each run:
readers take each group of runs with one schema as it was written, cast it to the table's, and unite the groups. No
footers are looked through, and a column that is missing or was all null in a run is null.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranked import null_safe
from ..operators.shared import cut


class Conflict(RuntimeError):
    """Another run has published the version that this one wanted to."""


class Table:
    """A staged table at a path, partitioned by keys."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)

    # --- files, by Hadoop's file system, so that a path of any store is good

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _fs(self):
        return self._at().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        fs, at = self._fs(), self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    # --- versions

    def versions(self) -> list[int]:
        """Published versions, ascending."""
        return sorted(int(n) for n in self._names("manifests") if n.isdigit())

    def manifest(self, version: int | None = None) -> DataFrame:
        """(keys, run, schema) of the partitions of a version, by default the last."""
        known = self.versions()
        if version is not None and version not in known:
            raise ValueError(f"version {version} of {self.path} is not there")
        if not known:
            raise FileNotFoundError(f"{self.path} has no published version")
        return self.spark.read.parquet(f"{self.path}/manifests/{known[-1] if version is None else version}")

    def publish(self, df: DataFrame, removed: DataFrame | None = None, run: str | None = None) -> int:
        """Replaces the partitions that df has rows for, drops those that removed (keys) names, and returns the new version.

        Whatever else the last version holds stays. df must not be empty where the table is new.
        """
        staged = self.stage(df, run)
        return self.commit(staged, removed)

    def stage(self, df: DataFrame, run: str | None = None) -> str:
        """Writes the data of a run; readers do not see it."""
        run = run or uuid.uuid4().hex
        if f"run={run}" in self._names("data"):
            raise Conflict(f"run {run} has written already")
        df.repartition(*self.keys).write.partitionBy(*self.keys).parquet(f"{self.path}/data/run={run}")
        return run

    def commit(self, run: str, removed: DataFrame | None = None) -> int:
        """Publishes what a run has staged."""
        base = (self.versions() or [0])[-1]
        self._write_manifest(run, base, removed)
        return self._rename(base + 1, run)

    def _write_manifest(self, run: str, base: int, removed: DataFrame | None) -> None:
        written = self.spark.read.parquet(f"{self.path}/data/run={run}")
        schema = T.StructType([f for f in written.schema.fields if f.name not in self.keys])
        kinds = dict(written.dtypes)
        new = written.select(*self.keys).distinct().select(*self.keys, F.lit(run).alias("run"), F.lit(schema.json()).alias("schema"))
        if base:
            old = self.manifest(base)
            # a key's type is what the first run made of its folders' names, and wider if a later one needs it
            old = old.withColumns({k: F.col(k).cast(_wider(dict(old.dtypes)[k], kinds[k])) for k in self.keys})
            new = new.withColumns({k: F.col(k).cast(_wider(dict(old.dtypes)[k], kinds[k])) for k in self.keys})
            gone = new.select(*self.keys)
            if removed is not None:
                gone = gone.unionByName(removed.select(*(F.col(k).cast(dict(new.dtypes)[k]) for k in self.keys)))
            new = new.unionByName(old.join(gone, null_safe(old, gone, self.keys), "left_anti"))
        new.write.parquet(f"{self.path}/manifests/.{base + 1}-{run}")

    def _rename(self, version: int, run: str) -> int:
        fs = self._fs()
        to = self._at("manifests", str(version))
        # a rename onto a folder would move into it, so the name must be free; on stores where both can be at once, the check of the
        # result below finds the second
        if fs.exists(to) or not fs.rename(self._at("manifests", f".{version}-{run}"), to):
            raise Conflict(f"version {version} of {self.path} is there already")
        if fs.exists(self._at("manifests", str(version), f".{version}-{run}")):
            fs.delete(self._at("manifests", str(version), f".{version}-{run}"), True)
            raise Conflict(f"version {version} of {self.path} is there already")
        return version

    # --- reading

    def read(self, version: int | None = None, schema: T.StructType | str | None = None, where: str | None = None) -> DataFrame:
        """The rows of a version. where: a condition on the keys, by which partitions are chosen before files are listed.

        schema: the table's columns besides the keys; by default those of all its runs, each as wide as needed.
        """
        chosen = self.manifest(version)
        if where:
            chosen = chosen.where(where)
        # runs and schemas are few next to partitions: at most one row for each run that is alive
        groups: dict[str, list[str]] = {}
        for r in chosen.select("run", "schema").distinct().collect():
            groups.setdefault(r["schema"], []).append(r["run"])
        kinds = {f.name: f.dataType for f in chosen.schema.fields}
        written = {s: T.StructType.fromJson(json.loads(s)) for s in groups}
        if schema is None:
            target = merged([written[s] for s in sorted(written)])
        else:
            target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        parts = []
        for said, runs in sorted(groups.items()):
            own = written[said]
            layout = T.StructType([*own.fields, *(T.StructField(k, kinds[k]) for k in self.keys), T.StructField("run", T.StringType())])
            d = self.spark.read.schema(layout).option("basePath", f"{self.path}/data").parquet(*(f"{self.path}/data/run={r}" for r in sorted(runs)))
            if where:
                d = d.where(where)
            alive = chosen.select(*self.keys, "run")
            d = d.join(alive, (d["run"] == alive["run"]) & null_safe(d, alive, self.keys), "left_semi")
            have = {f.name for f in own.fields}
            parts.append(d.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields), *self.keys))
        if not parts:
            empty = T.StructType([*target.fields, *(T.StructField(k, kinds[k]) for k in self.keys)])
            return self.spark.createDataFrame([], empty)
        return reduce(DataFrame.unionByName, parts)

    # --- after crashes, and old versions

    def recover(self) -> list[str]:
        """What was done with manifests on their way: 'rolled forward <n>' for a finished one of the next version, else
        'left out <n>'. Only for times without running writers."""
        fs, done = self._fs(), []
        for name in [n for n in self._names("manifests") if n.startswith(".") and "-" in n]:
            number, run = name[1:].split("-", 1)
            following = (self.versions() or [0])[-1] + 1
            finished = fs.exists(self._at("manifests", name, "_SUCCESS")) and fs.exists(self._at("data", f"run={run}", "_SUCCESS"))
            if finished and number.isdigit() and int(number) == following:
                self._rename(following, run)
                done.append(f"rolled forward {number}")
            else:
                fs.delete(self._at("manifests", name), True)
                done.append(f"left out {number}")
        return done

    def vacuum(self, keep: int = 2) -> int:
        """Drops versions but the last `keep`, and the data of runs that these do not need; returns how many runs went."""
        fs, known = self._fs(), self.versions()
        for v in known[:-keep]:
            fs.delete(self._at("manifests", str(v)), True)
        if not known:
            return 0
        needed = set()
        for v in known[-keep:]:
            needed |= {r["run"] for r in self.manifest(v).select("run").distinct().collect()}
        gone = [n for n in self._names("data") if n.startswith("run=") and n[4:] not in needed]
        for name in gone:
            fs.delete(self._at("data", name), True)
        return len(gone)

    def stale(self, owners: DataFrame, owner: str, kept: DataFrame) -> DataFrame:
        """Keys of partitions of the last version that belong to owners (a column among the keys) and that kept has not."""
        if not self.versions():
            return kept.select(*self.keys).limit(0)
        mine = self.manifest().select(*self.keys).join(owners.select(owner).distinct(), owner, "left_semi")
        kept = kept.select(*self.keys).distinct()
        return cut(mine.join(kept, null_safe(mine, kept, self.keys), "left_anti"))


_WIDTH = ["void", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "string"]


def _wider(a: str, b: str) -> str:
    """The type that holds both: of two whole numbers or fractions the larger, else text."""
    if a == b:
        return a
    if "void" in (a, b):
        return a if b == "void" else b
    numbers = _WIDTH[2:8]
    return max(a, b, key=_WIDTH.index) if a in numbers and b in numbers else "string"


def merged(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns of several schemas, in order of their first meeting; a column of two types gets the wider one, nested
    columns of two types become text."""
    out: dict[str, T.DataType] = {}
    for s in schemas:
        for f in s.fields:
            if f.name not in out:
                out[f.name] = f.dataType
            elif out[f.name] != f.dataType:
                a, b = out[f.name].simpleString(), f.dataType.simpleString()
                known = a in _WIDTH and b in _WIDTH
                out[f.name] = T._parse_datatype_string(_wider(a, b)) if known else T.StringType()
    return T.StructType([T.StructField(n, d) for n, d in out.items()])
