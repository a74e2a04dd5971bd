"""Ranks, running totals and exact quantiles within keys, without gathering a key into one task.

Rows are dealt by ranges of (keys, order), so that a key with very many rows lies in several ranges, one after the other.
Within a range a window numbers or adds up; what a key has in the ranges before comes from one row for each key and
range. The dealt rows are written to the checkpoint folder first: ranges are sampled, and both passes must see the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .shared import cut

#: how two partial results combine, and what an empty one is
_JOINED = {"sum": (lambda a, b: a + b, 0), "xor": (lambda a, b: a.bitwiseXOR(b), 0)}
_TOTAL = {"sum": F.sum, "xor": F.bit_xor}


def _columns(by: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in by]


def null_safe(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """The condition that both have the same values of all names; null meets null."""
    out = F.lit(True)
    for c in names:
        out = out & left[c].eqNullSafe(right[c])
    return out


def running(df: DataFrame, keys: Sequence[str], order: Sequence, results: dict[str, tuple[str, Column]], partitions: int | None = None) -> DataFrame:
    """df with, for each name, the total of a column over the rows of the same keys that come before in the order.

    results: name -> ("sum" or "xor", column); a null counts as nothing. order: names or sort columns. Null keys are keys.
    Rows that tie in the order get their totals in an unspecified order among themselves.
    """
    keys, by = list(keys), _columns(order)
    values = {f"__v_{n}": F.coalesce(c, F.lit(0)) for n, (_, c) in results.items()}
    ranges = [*_columns(keys), *by]
    dealt = df.withColumns(values)
    dealt = dealt.repartitionByRange(partitions, *ranges) if partitions else dealt.repartitionByRange(*ranges)
    dealt = cut(dealt.withColumn("__range", F.spark_partition_id()))
    here = Window.partitionBy(*keys, "__range").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumns({f"__l_{n}": F.coalesce(_TOTAL[kind](f"__v_{n}").over(here), F.lit(0)) for n, (kind, _) in results.items()})
    totals = dealt.groupBy(*keys, "__range").agg(*(_TOTAL[kind](f"__v_{n}").alias(f"__t_{n}") for n, (kind, _) in results.items()))
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*keys, "__range", *(F.coalesce(_TOTAL[kind](f"__t_{n}").over(earlier), F.lit(0)).alias(f"__b_{n}") for n, (kind, _) in results.items()))
    # a key that lies in one range has nothing before it: only what is not zero is joined
    some = F.lit(False)
    for n in results:
        some = some | (F.col(f"__b_{n}") != 0)
    before = before.where(some)
    joined = local.join(before, null_safe(local, before, [*keys, "__range"]), "left")
    out = {n: _JOINED[kind][0](F.col(f"__l_{n}"), F.coalesce(F.col(f"__b_{n}"), F.lit(0))) for n, (kind, _) in results.items()}
    return joined.select(*(local[c] for c in df.columns), *(c.alias(n) for n, c in out.items()))


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence, name: str) -> DataFrame:
    """df with a row's number within its keys, from 0."""
    return running(df, keys, order, {name: ("sum", F.lit(1).cast("long"))})


def joined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """left with the columns that right has besides the keys; null keys meet null keys."""
    out = left.join(right, null_safe(left, right, keys), "left")
    return out.select(*(left[c] for c in left.columns), *(right[c] for c in right.columns if c not in keys))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, at: dict[str, float], places: int | None = None) -> DataFrame:
    """(keys, one column for each name): exact quantiles of value within keys, linear between the two neighbours of a rank.

    Values are counted first (a row for each key and different value), the counts are added up in order, and of these the
    rows at the neighbours' ranks stay: no group of values is gathered. Nulls and NaN are left out; a key without values has
    nulls. places: results are rounded to that many digits.
    """
    keys = list(keys)
    d = df.select(*keys, F.col(value).cast("double").alias("__x"))
    d = d.withColumn("__x", F.when(~F.isnan("__x"), F.col("__x") + F.lit(0.0)))  # -0.0 is 0.0
    # a key's nulls are a row that counts as nothing: df is read once, keys without values stay
    counts = d.groupBy(*keys, "__x").agg(F.count("__x").alias("__n"))
    ranked = running(counts, keys, ["__x"], {"__before": ("sum", F.col("__n"))})
    groups = ranked.groupBy(*keys).agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("__all"))
    ranked = ranked.where("__n > 0")
    ranks = [F.struct(F.lit(n).alias("name"), (F.lit(float(q)) * (F.col("__all") - 1)).alias("rank")) for n, q in at.items()]
    wanted = groups.where("__all > 0").withColumn("__w", F.explode(F.array(*ranks))).select(*keys, "__w.name", "__w.rank")
    # at most two values meet each wanted rank; the few names of a key go to its values as one array
    wanted = wanted.groupBy(*keys).agg(F.collect_list(F.struct("name", "rank")).alias("__ranks"))
    few = (lambda x: x) if keys else F.broadcast  # one row without keys
    met = ranked.join(few(wanted), null_safe(ranked, wanted, keys)).select(
        *(ranked[c] for c in keys), "__x",
        F.explode(F.filter("__ranks", lambda r: (F.floor(r["rank"]) < F.col("__before") + F.col("__n")) & (F.ceil(r["rank"]) >= F.col("__before")))).alias("__r"), "__before", "__n",
    )
    low, high = F.floor("__r.rank"), F.ceil("__r.rank")
    inside = lambda rank: (rank >= F.col("__before")) & (rank < F.col("__before") + F.col("__n"))
    x = met.groupBy(*keys, F.col("__r.name").alias("__name"), F.col("__r.rank").alias("__rank")).agg(F.max(F.when(inside(low), F.col("__x"))).alias("__lo"), F.max(F.when(inside(high), F.col("__x"))).alias("__hi"))
    part = F.col("__rank") - F.floor("__rank")
    # an end that is infinite is taken as it is: infinity times nothing is not a number
    between = F.when(F.col("__lo") == F.col("__hi"), F.col("__lo")).when(part == 0, F.col("__lo")).otherwise(F.col("__lo") * (1 - part) + F.col("__hi") * part)
    found = x.withColumn("__q", between).groupBy(*keys).agg(*(F.max(F.when(F.col("__name") == n, F.col("__q"))).alias(n) for n in at))
    out = groups.join(few(found), null_safe(groups, found, keys), "left")
    digits = lambda c: F.col(c) if places is None else S.rounded(c, places)
    return out.select(*(groups[c] for c in keys), *(digits(n).alias(n) for n in at))
