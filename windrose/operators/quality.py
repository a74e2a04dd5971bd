"""Quality rules. A rule yields rows (group, rule, failures, sample); groups with any are quarantined as a whole."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


def _failures(df: DataFrame, group: str, rule: str, bad: Column, sample: Column) -> DataFrame:
    return (
        df.groupBy(group)
        .agg(F.count_if(bad).alias("failures"), F.min(F.when(bad, sample.cast("string"))).alias("sample"))
        .where("failures > 0")
        .select(F.col(group).alias("group"), F.lit(rule).alias("rule"), "failures", "sample")
    )


def rule_unique(df: DataFrame, group: str, keys: Sequence[str]) -> DataFrame:
    """Keys that stand more than once."""
    counted = df.groupBy(group, *(k for k in keys if k != group)).agg(F.count("*").alias("__n"))
    return _failures(counted, group, f"unique({','.join(keys)})", F.col("__n") > 1, F.concat_ws("|", *keys))


def rule_not_blank(df: DataFrame, group: str, columns: Sequence[str], sample: str) -> DataFrame:
    """Null or blank values, all columns in one pass."""
    counts = [F.count_if(S.norm_text(c) == "").alias(c) for c in columns]
    first = F.min(F.when(reduce(lambda a, b: a | b, (S.norm_text(c) == "" for c in columns)), F.col(sample).cast("string"))).alias("sample")
    long = df.groupBy(F.col(group).alias("group")).agg(*counts, first).unpivot(["group", "sample"], list(columns), "column", "failures")
    return long.where("failures > 0").select("group", F.concat(F.lit("not_blank("), "column", F.lit(")")).alias("rule"), "failures", "sample")


def rule_range(df: DataFrame, group: str, column: str, low, high, sample: str) -> DataFrame:
    """Values outside [low, high]; a bound may be null, or another column's name."""
    bound = lambda x: F.col(x) if isinstance(x, str) else F.lit(x)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < bound(low))
    if high is not None:
        bad = bad | (F.col(column) > bound(high))
    return _failures(df, group, f"range({column})", bad, F.col(sample))


def rule_in(df: DataFrame, group: str, column: str, values: Sequence, sample: str) -> DataFrame:
    return _failures(df, group, f"in({column})", F.col(column).isNull() | ~F.col(column).isin(*values), F.col(sample))


def rule_fd(df: DataFrame, group: str, key: str, value: str) -> DataFrame:
    """Keys with more than one value."""
    counted = df.groupBy(group, key).agg(F.countDistinct(value).alias("__n"))
    return _failures(counted, group, f"fd({key}->{value})", F.col("__n") > 1, F.col(key))


def rule_same_count(before: DataFrame, after: DataFrame, group: str) -> DataFrame:
    """Groups whose number of rows changed."""
    n = lambda df, name: df.groupBy(group).agg(F.count("*").alias(name))
    both = n(before, "__a").join(n(after, "__b"), group, "full").fillna(0, ["__a", "__b"])
    return both.where("__a != __b").select(
        F.col(group).alias("group"), F.lit("same_count").alias("rule"), F.abs(F.col("__a") - F.col("__b")).alias("failures"), F.concat_ws("/", "__a", "__b").alias("sample")
    )


def rule_complete(expected: DataFrame, got: DataFrame, group: str, keys: Sequence[str]) -> DataFrame:
    """Expected keys without a row."""
    missing = expected.select(*{group: 0, **dict.fromkeys(keys, 0)}).distinct().join(got.select(*keys).distinct(), list(keys), "left_anti")
    return _failures(missing, group, f"complete({','.join(keys)})", F.lit(True), F.concat_ws("|", *keys))


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def validate(df: DataFrame, group: str, failures: Sequence[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(rows of groups without failures, all failures)."""
    if not failures:  # no rule, no failure
        failures = [_failures(df.limit(0), group, "none", F.lit(True), F.lit(""))]
    errors = reduce(lambda a, b: a.unionByName(b), failures)
    return df.join(errors.select(F.col("group").alias(group)).distinct(), group, "left_anti"), errors
