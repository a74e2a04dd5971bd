"""Analytics over scored rounds and holes: residuals, slopes, quantiles, curves, windows, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import rounded
from .core import dmean
from .ranked import exact_quantiles, joined
from .shared import stored


def r(c: Column, digits: int = 4) -> Column:
    return rounded(c, digits)


def mode_date(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """The commonest value of each key; ties go to the earliest."""
    counted = df.where(F.col(date).isNotNull()).groupBy(*keys, date).agg(F.count("*").alias("n"))
    return counted.groupBy(*keys).agg(F.min_by(date, F.struct(-F.col("n"), F.col(date))).alias("mode"), F.sum("n").alias("rows"))


def play_span(df: DataFrame, key: str, date: str, pad: int) -> DataFrame:
    """Number of distinct dates, and the span around them."""
    return df.groupBy(key).agg(F.countDistinct(date).alias("n_dates"), F.date_sub(F.min(date), pad).alias("from_date"), F.date_add(F.max(date), pad).alias("to_date"))


def residual_summary(df: DataFrame, keys: Sequence[str], actual: str, expected: str) -> DataFrame:
    d = stored(df.select(*keys, actual, expected, (F.col(actual) - F.col(expected)).alias("__r")))
    out = d.groupBy(*keys).agg(
        F.count("*").alias("rows"), r(dmean(actual)).alias("mean_actual"), r(dmean(expected)).alias("mean_expected"), r(dmean("__r")).alias("residual_mean"),
        r(F.stddev_samp("__r")).alias("residual_std"), r(dmean(F.abs("__r"))).alias("mae"),
    )
    return joined(out, exact_quantiles(d, keys, "__r", {"residual_median": 0.5}, 4), keys)


def regression_metrics(df: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """mae, rmse and r2 (null for one row, or without spread), in one pass."""
    err = F.col(actual) - F.col(predicted)
    sst = F.var_pop(actual) * F.count(actual)
    r2 = F.when((F.count("*") > 1) & (sst > 1e-9), 1 - F.sum(err * err) / sst)
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), r(dmean(F.abs(err))).alias("mae"), r(F.sqrt(F.avg(err * err))).alias("rmse"), r(r2).alias("r2"))


def means(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), *(r(dmean(c)).alias(f"mean_{c}") for c in columns))


def effect_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row for each effect: mean, median, std, p10, p90, min, max."""
    long = stored(df.select(*columns)).unpivot([], list(columns), "effect", "v")
    out = long.groupBy("effect").agg(F.count("v").alias("n"), r(dmean("v")).alias("mean"), r(F.stddev_samp("v")).alias("std"), r(F.min("v")).alias("low"), r(F.max("v")).alias("high"))
    return joined(out, exact_quantiles(long, ["effect"], "v", {"median": 0.5, "p10": 0.1, "p90": 0.9}, 4), ["effect"])


def bucket_quantiles(df: DataFrame, bucket: str, value: str, order: Sequence[str]) -> DataFrame:
    """n, mean, median and quantiles by bucket, with the bucket's place in a fixed order."""
    df = stored(df.select(bucket, value))
    place = F.array_position(F.array(*(F.lit(x) for x in order)), F.col(bucket)).cast("int")
    out = df.groupBy(bucket).agg(F.count(value).alias("n"), r(dmean(value)).alias("mean"))
    return joined(out, exact_quantiles(df, [bucket], value, {f"p{int(100 * q)}": q for q in (0.1, 0.25, 0.5, 0.75, 0.9)}, 4), [bucket]).withColumn("place", place)


def stability(df: DataFrame, keys: Sequence[str], effect: str) -> DataFrame:
    """Spread of an effect by keys: its standard deviation, and the size that 95 % of the rows do not pass."""
    d = stored(df.select(*keys, F.col(effect), F.abs(effect).alias("__size")))
    return joined(d.groupBy(*keys).agg(r(F.stddev_samp(effect)).alias("std")), exact_quantiles(d, keys, "__size", {"p95_abs": 0.95}, 4), keys)


def relative_to_calm(df: DataFrame, keys: Sequence[str], value: str, wind: str, calm: float, min_rows: int) -> DataFrame:
    """Mean less the mean in calm rounds, per 5 mph, by one pass of conditional means; groups need enough rows of both."""
    is_calm = F.col(wind) < calm
    out = df.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.count_if(is_calm).alias("calm_rows"), dmean(value).alias("m"), dmean(wind).alias("w"),
        dmean(F.when(is_calm, F.col(value))).alias("cm"), dmean(F.when(is_calm, F.col(wind))).alias("cw"),
    )
    gap = F.col("w") - F.col("cw")
    return out.where((F.col("rows") >= min_rows) & (F.col("calm_rows") >= max(10, min_rows // 3))).select(
        *keys, "rows", "calm_rows", r(F.col("m") - F.col("cm")).alias("vs_calm"), r(F.when(F.abs(gap) > 1e-9, 5 * (F.col("m") - F.col("cm")) / gap), 3).alias("per_5_mph")
    )


def effect_curve(df: DataFrame, value: str, x: str, width: float, reference: float, min_rows: int) -> DataFrame:
    """Mean by bins of x, less the mean of the bin that holds the reference."""
    bin_ = (F.floor(F.col(x) / width) * width).cast("double")
    curve = df.where(F.col(x).isNotNull()).groupBy(bin_.alias("bin")).agg(F.count("*").alias("rows"), dmean(value).alias("m"))
    base = curve.where(F.col("bin") == F.floor(F.lit(reference) / width) * width).select(F.col("m").alias("base"))
    # one row, so the join is with a constant
    return curve.where(F.col("rows") >= min_rows).join(F.broadcast(base), how="left").select("bin", "rows", r(F.col("m") - F.col("base")).alias("vs_reference"))


def slope(df: DataFrame, keys: Sequence[str], y: str, x: str, min_rows: int = 2, min_std: float = 0.0) -> DataFrame:
    """Least-squares slope, per 5 units, intercept and r2 by keys."""
    out = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("rows"), F.stddev_samp(x).alias("__std"), r(F.regr_slope(y, x)).alias("slope"), r(5 * F.regr_slope(y, x)).alias("slope_5"),
        r(F.regr_intercept(y, x), 3).alias("intercept"), r(F.regr_r2(y, x)).alias("r2"),
    )
    return out.where((F.col("rows") >= min_rows) & (F.col("__std") >= min_std)).drop("__std")


def top_bottom(df: DataFrame, by: str, tie: Sequence[str], n: int) -> DataFrame:
    """The n largest and the n smallest, each a top-k without a full sort."""
    top = df.orderBy(F.col(by).desc(), *tie).limit(n).withColumn("side", F.lit("top"))
    return top.unionByName(df.orderBy(F.col(by).asc(), *tie).limit(n).withColumn("side", F.lit("bottom")))


def top_groups(df: DataFrame, key: str, n: int, min_rows: int) -> DataFrame:
    """Rows of the n largest groups that have enough rows."""
    best = df.groupBy(key).agg(F.count("*").alias("rows")).where(F.col("rows") >= min_rows).orderBy(F.col("rows").desc(), key).limit(n)
    return df.join(F.broadcast(best.select(key)), key, "left_semi")


def qcut(df: DataFrame, c: str, n: int) -> DataFrame:
    """df with bin, by edges at quantiles; equal edges fall together; bins are closed on the right, the first on both sides.

    Edges are one row of n + 1 numbers.
    """
    df = stored(df)
    at = {f"q{i}": i / n for i in range(n + 1)}
    edges = exact_quantiles(df, [], c, at).select(F.array_distinct(F.array(*at)).alias("edges"))
    bin_ = F.greatest(F.size(F.filter("edges", lambda e: e < F.col(c))), F.lit(1))
    return df.join(F.broadcast(edges), how="left").withColumn("bin", F.when(F.col(c).isNotNull(), bin_)).drop("edges")


def histogram(df: DataFrame, c: str, bins: int) -> DataFrame:
    """Counts in equal bins between the least and the largest value."""
    ends = df.agg(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi"))
    at = F.least(F.floor((F.col(c) - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * bins) + 1, F.lit(bins))
    return df.where(F.col(c).isNotNull()).join(F.broadcast(ends), how="left").groupBy(F.coalesce(at, F.lit(1)).cast("int").alias("bin")).agg(F.count("*").alias("rows"))


def curve_shape(df: DataFrame, keys: Sequence[str], x: str, y: str, drop: float = 0.10) -> DataFrame:
    """Total variation, roughness of second differences, and falls larger than drop, along x."""
    w = Window.partitionBy(*keys).orderBy(x)
    d = df.withColumns({"__d": F.col(y) - F.lag(y).over(w), "__d2": F.col(y) - 2 * F.lag(y).over(w) + F.lag(y, 2).over(w)})
    return d.groupBy(*keys).agg(
        r(F.sum(F.abs("__d"))).alias("variation"), r(F.sum(F.abs("__d2"))).alias("roughness"), F.count_if(F.col("__d") < -drop).alias("falls")
    )


def streak_cut(df: DataFrame, id_col: str, found: str, n: int, block: int = 1_000_000) -> DataFrame:
    """Ids before the n-th of n missing ones in a row.

    Runs of missing ids are found in blocks of ids, so no task orders the whole table; runs that span blocks are joined
    through the last found id of earlier blocks, one row for each block.
    """
    d = df.withColumn("__block", F.floor(F.col(id_col) / block))
    last = d.groupBy("__block").agg(F.max(F.when(F.col(found), F.col(id_col))).alias("last_found"), F.min(id_col).alias("first_id"))
    before = last.withColumn("carried", F.max("last_found").over(Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)))
    start = last.agg(F.min("first_id").alias("start"))
    w = Window.partitionBy("__block").orderBy(id_col)
    seen = d.join(before.select("__block", "carried"), "__block").join(F.broadcast(start))
    anchor = F.coalesce(F.max(F.when(F.col(found), F.col(id_col))).over(w), F.col("carried"), F.col("start") - 1)
    stop = seen.withColumn("__run", F.col(id_col) - anchor).where(F.col("__run") >= n).agg(F.min(id_col).alias("stop"))
    return df.join(F.broadcast(stop)).where(F.col("stop").isNull() | (F.col(id_col) < F.col("stop"))).drop("stop")


def sample_n(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows by a hash of the key and seed: the same rows each time."""
    return df.orderBy(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)


def hash_split(df: DataFrame, key: str, shares: dict[str, int]) -> DataFrame:
    """df with split: whole keys go to named splits by percent, the same each time."""
    at = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % 100
    out, low = F.lit(None).cast("string"), 0
    for name, percent in shares.items():
        out = F.when((at >= low) & (at < low + percent), name).otherwise(out)
        low += percent
    return df.withColumn("split", out)


def scenario_grid(df: DataFrame, grid: DataFrame) -> DataFrame:
    """Each row with each scenario of a small grid (at most a few hundred rows) in which gust is not below wind."""
    return df.crossJoin(F.broadcast(grid.where("gust >= wind")))


def daylight_hours(hourly: DataFrame, daily: DataFrame) -> DataFrame:
    """Hours [t, t + 1 h) that overlap [sunrise, sunset) of their date; dates with bounds out of order are dropped."""
    sun = daily.where("sunrise < sunset")
    return hourly.withColumn("date", F.col("t").cast("date")).join(sun, "date").where("t < sunset and t + interval 1 hour > sunrise")


def vs_baseline(curve: DataFrame, keys: Sequence[str], x: str, y: str, reference: float) -> DataFrame:
    """Curve less its value at the reference, by keys."""
    base = curve.where(F.col(x) == reference).select(*keys, F.col(y).alias("__base"))
    return curve.join(base, list(keys), "left").withColumn("vs_baseline", r(F.col(y) - F.col("__base"))).drop("__base")


def status_audit(df: DataFrame, status: str, flag: str) -> DataFrame:
    """Rows by status, with and without a flag."""
    return df.groupBy(F.col(status).alias("status")).agg(F.count("*").alias("total"), F.count_if(flag).alias("with_rounds"), F.count_if(~F.col(flag)).alias("without_rounds"))


def run_summary(state: DataFrame, limit: float, status: str = "status") -> DataFrame:
    """One row: events, successes, failures, their rate, and whether it reaches the limit."""
    failed = F.count_if(F.col(status) == "failed")
    rate = failed / F.nullif(F.count("*"), F.lit(0))
    return state.agg(F.count("*").alias("events"), F.count_if(F.col(status) == "success").alias("ok"), failed.alias("failed"), r(rate, 6).alias("failure_rate"), F.coalesce(rate >= limit, F.lit(False)).alias("exceeds"))


def course_support(df: DataFrame, course: str, layout: str, wind: str, temperature: str) -> DataFrame:
    """How much each course has seen: rows, layouts, the range and spread of its wind, the range of its temperatures."""
    return df.groupBy(course).agg(
        F.count("*").alias("rows"), F.countDistinct(layout).alias("layouts"), r(F.min(wind)).alias("wind_min"), r(F.max(wind)).alias("wind_max"), r(F.stddev_samp(wind)).alias("wind_std"),
        r(F.max(temperature) - F.min(temperature)).alias("temp_range"),
    )


def temperature_slice(df: DataFrame, temperature: str, value: str, width: float = 5) -> DataFrame:
    """The least and the mean value by bins of temperature."""
    return df.where(F.col(temperature).isNotNull()).groupBy(F.floor(F.col(temperature) / width).alias("temp_bin")).agg(r(F.min(value)).alias("best"), r(dmean(value)).alias("mean"))


def round_residuals(holes: DataFrame, keys: Sequence[str], actual: str, expected: str, carried: Sequence[str], order: str) -> DataFrame:
    """Residuals of holes with weather, added up to rounds; carried columns are the first hole's, by its number as text."""
    first = [F.min_by(c, F.col(order).cast("string")).alias(c) for c in carried]
    return holes.where("not wx_missing").groupBy(*keys).agg(F.sum(F.col(actual) - F.col(expected)).cast("bigint").alias("residual"), *first)


def worst_bias(df: DataFrame, groupings: dict[str, tuple[str, int]], value: str) -> DataFrame:
    """For each grouping, name -> (column, rows that a group needs): the largest mean of a group, whatever its sign."""
    out = None
    for name, (key, least) in groupings.items():
        g = df.groupBy(key).agg(F.count("*").alias("n"), dmean(value).alias("m")).where(F.col("n") >= least)
        one = g.agg(r(F.max(F.abs("m"))).alias("max_abs_bias")).select(F.lit(name).alias("grouping"), "max_abs_bias")
        out = one if out is None else out.unionByName(one)
    return out


def validate_dataset(df: DataFrame, keys: Sequence[str], may_lack: Sequence[str], value: str) -> DataFrame:
    """One row: rows, different keys, nulls of columns (null_<column>), and mean, std and quartiles of a value."""
    df = stored(df.select(*dict.fromkeys([*keys, *may_lack, value])))
    sums = df.agg(F.count("*").alias("rows"), F.countDistinct(*keys).alias("keys"), *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in may_lack), r(dmean(value)).alias("mean"), r(F.stddev_samp(value)).alias("std"))
    return sums.join(F.broadcast(exact_quantiles(df, [], value, {f"q{q}": q / 4 for q in (1, 2, 3)}, 4)))  # one row each
