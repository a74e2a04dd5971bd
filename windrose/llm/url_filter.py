"""URL rules behind a blocked Bloom filter.

The list is a table of rules (host, path, verdict). A rule's canonical URL is its lower-cased host followed by its
path. A page's url can only be hit by a canonical URL made of a suffix of its host, cut at a dot, and a prefix of its
path that is as long as some listed path. These candidates are probed in a blocked Bloom filter of the listed
canonical URLs (each key sets and tests bits of one 64-bit block). Candidates that pass go to an exact hash join with
the list, which removes false positives; the longest rule wins.

The filter has at most ``max_filter_bytes`` bytes, whatever the list's length: beyond that it lets more candidates
through to the exact join, and loses none. Nothing else is sent to all executors by hand.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule. Rules with a null or
empty host, or a null path, are left out. Equal rules count once; of rules with one canonical URL and two verdicts,
block wins. Repeated and null page ids stay as they are, a row for each input row. An empty list or table is fine.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, prepare

BITS_PER_KEY = 16
MAX_FILTER_BYTES = 16 << 20
#: 64-bit block bits set by each key
PROBES = 5


def with_host_and_path(pages: DataFrame, url_col: str, host: str, path: str) -> DataFrame:
    url = F.coalesce(F.col(url_col), F.lit(""))
    return pages.withColumns(
        {
            host: lower_ascii(F.regexp_extract(url, r"://([^/?#]*)", 1)),
            path: F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1),
        }
    )


def _block_and_mask(key, n_blocks: int):
    """Block number and 64-bit mask of a key's xxhash64, as Spark columns."""
    block = F.pmod(key, F.lit(n_blocks)).cast("int")
    mask = F.lit(0).cast("long")
    for i in range(PROBES):
        bit = F.shiftrightunsigned(key, 64 - 6 * (i + 1)).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return block, mask


def bloom_blocks(keys: DataFrame, key_col: str, max_bytes: int = MAX_FILTER_BYTES) -> np.ndarray:
    """The filter's 64-bit blocks, built by an OR of partial masks on Spark; at most max_bytes reach the driver."""
    n = keys.count()
    n_blocks = max(1, min(max_bytes // 8, 1 << max(0, math.ceil(math.log2(max(1, n) * BITS_PER_KEY / 64)))))
    block, mask = _block_and_mask(F.xxhash64(key_col), n_blocks)
    rows = keys.select(block.alias("b"), mask.alias("m")).groupBy("b").agg(F.bit_or("m").alias("m")).toPandas()
    blocks = np.zeros(n_blocks, np.int64)
    blocks[rows["b"].to_numpy(np.int64)] = rows["m"].to_numpy(np.int64)
    return blocks


def probe(blocks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which 64-bit key hashes may be in the filter; never False for a listed key."""
    at = np.mod(hashes, len(blocks))
    mask = np.zeros(len(hashes), np.uint64)
    u = hashes.view(np.uint64)
    for i in range(PROBES):
        mask |= np.uint64(1) << ((u >> np.uint64(64 - 6 * (i + 1))) & np.uint64(63))
    return (blocks[at].view(np.uint64) & mask) == mask


def _key(host: Column, path: Column) -> Column:
    """A canonical URL's key; what parts them stands in no host, so that 'co' and 'm/' are not 'com' and '/'."""
    return F.concat(host, F.lit("\n"), path)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url_col: str = "url",
    default: str = "allow",
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """pages with host, path, rule (or null) and verdict ('allow' or 'block').

    rules: host, path, verdict. A url that no rule fits gets ``default``, the method's verdict for a URL that is not
    listed. Columns of pages named host, path, rule or verdict are replaced by the results.
    """
    spark = pages.sparkSession
    prepare(spark)
    pages = with_host_and_path(pages.drop(*(c for c in ("host", "path", "rule", "verdict") if c in pages.columns and c != url_col)), url_col, "host", "path")
    listed = (
        rules.where("host != '' and path is not null and verdict is not null")
        .select(lower_ascii(F.col("host")).alias("h"), F.col("path").alias("p"), "verdict")
        .select(_key(F.col("h"), F.col("p")).alias("key"), F.concat("h", "p").alias("rule"), "verdict", F.length("p").alias("n"))
        .groupBy("key", "rule", "n")
        .agg(F.max("verdict").alias("verdict"))
    )
    blocks = spark.sparkContext.broadcast(bloom_blocks(listed, "key", max_filter_bytes))
    lengths = sorted(r["n"] for r in listed.select("n").distinct().collect())  # one row for each path length in use

    @F.pandas_udf("array<boolean>")
    def may_be_listed(keys: pd.Series) -> pd.Series:
        counts = np.fromiter((len(k) for k in keys), np.int64, len(keys))
        flat = np.concatenate([*(np.asarray(k, np.int64) for k in keys), np.empty(0, np.int64)])
        return pd.Series(np.split(probe(blocks.value, flat), np.cumsum(counts)[:-1])) if len(keys) else pd.Series([], dtype=object)

    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    prefixes = F.transform(
        F.filter(F.array(*(F.lit(n) for n in lengths)).cast("array<int>"), lambda n: n <= F.length("path")),
        lambda n: F.substr(F.col("path"), F.lit(1), n),
    )
    keys = F.array_distinct(F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: _key(s, p)))))
    # a verdict depends on host and path alone, so each of their values is judged once
    urls = pages.where("host != ''").select("host", "path").distinct().withColumn("keys", keys)
    hit = may_be_listed(F.transform("keys", lambda k: F.xxhash64(k)))
    passed = (
        urls.withColumn("hit", hit)
        .select("host", "path", F.explode(F.arrays_zip("keys", "hit")).alias("k"))
        .where("k.hit")
        .select("host", "path", F.col("k.keys").alias("key"))
    )
    judged = (
        passed.join(listed.select("key", "rule", "verdict"), "key")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    return pages.join(judged, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))
