"""Impact reports over scored rounds: the reporting base, grouped reports, binned distribution, additive roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .core import dmean

#: Reference weather.
REFERENCE = {"reference_wind_mph": 0.0, "reference_gust_mph": 1.0, "reference_temp_f": 80.0, "reference_precipitation": "No Precipitation"}

#: what reports average: name of the mean, column of the base
EFFECTS = {
    "avg_estimated_wind_impact_strokes": "wind_impact",
    "avg_estimated_temperature_impact_strokes": "temperature_impact",
    "avg_estimated_total_weather_impact_strokes": "total_impact",
}
WEATHER = {"avg_observed_wind_mph": "observed_wind_mph", "avg_observed_temp_f": "observed_temp_f"}
GUST = {"avg_observed_wind_gust_mph": "observed_wind_gust_mph"}
STROKES = {
    "avg_actual_round_strokes": "actual_round_strokes",
    "avg_predicted_round_strokes": "predicted",
    "avg_predicted_round_strokes_wind_reference": "predicted_wind_reference",
}


def with_impacts(rounds: DataFrame) -> DataFrame:
    """Arithmetic stand-in for a model's predictions, which makes reports exact: impacts, and predictions at reference weather."""
    wind = 0.15 * F.col("wind_mean") + 0.05 * F.col("gust_mean")
    temperature = 0.02 * (26.6667 - F.col("temp_mean"))
    precip = F.when(F.col("precip_sum") > 0, 0.3).otherwise(0.0)
    out = rounds.withColumns({"predicted": F.col("actual_round_strokes").cast("double"), "wind_impact": wind, "temperature_impact": temperature, "precip_impact": precip})
    out = out.withColumn("total_impact", F.col("wind_impact") + F.col("temperature_impact") + F.col("precip_impact"))
    return out.withColumns(
        {
            "predicted_wind_reference": F.col("predicted") - F.col("wind_impact"),
            "predicted_temperature_reference": F.col("predicted") - F.col("temperature_impact"),
            "predicted_total_reference": F.col("predicted") - F.col("total_impact"),
        }
    )


def reporting_base(scored: DataFrame) -> DataFrame:
    """Scored rounds with a total impact, in units and bands of the reports."""
    out = scored.where("total_impact is not null").withColumns(
        {
            "division": S.blank_to("division", "Unknown"),
            "state": F.upper(S.blank_to("state", "UNKNOWN")),
            "observed_wind_mph": S.mps_to_mph("wind_mean"),
            "observed_wind_gust_mph": S.mps_to_mph("gust_mean"),
            "observed_temp_f": S.c_to_f("temp_mean"),
            "round_month": (F.lit(1) + F.col("tourn_id") % 12).cast("bigint"),
            "rating_band": S.rating_band("player_rating"),
            "precip_flag": S.precip_label("precip_sum"),
            "round_wind_speed_bucket": S.wind_bucket("wind_mean"),
        }
    )
    return out.withColumns({"round_month_label": S.month_label("round_month"), "temperature_band_f": S.temp_band("observed_temp_f")})


def mean4(c) -> Column:
    return S.rounded(dmean(c))


def report(base: DataFrame, keys: Sequence[str], means: dict[str, str], events: bool = False, players: bool = False) -> DataFrame:
    """Counts and means by keys (none: one row)."""
    aggs = [F.count("*").alias("rounds_scored")]
    if events:
        aggs.append(F.countDistinct("tourn_id").alias("events_scored"))
    if players:
        aggs.append(F.countDistinct("player_key").alias("players_scored"))
    return base.groupBy(*keys).agg(*aggs, *(mean4(c).alias(n) for n, c in means.items()))


def overview(base: DataFrame) -> DataFrame:
    means = {
        "avg_added_strokes_weather": "total_impact", "avg_added_strokes_wind": "wind_impact",
        "avg_observed_wind_mph": "observed_wind_mph", "avg_observed_wind_gust_mph": "observed_wind_gust_mph", "avg_observed_temp_f": "observed_temp_f",
    }
    out = base.agg(F.count("*").alias("rounds_tracked"), F.countDistinct("tourn_id").alias("events_tracked"), *(mean4(c).alias(n) for n, c in means.items()))
    return out.withColumns({k: F.lit(v) for k, v in REFERENCE.items()})


def _ranges(name: str, label: str, edges: Sequence[float], first: int, open_low: bool, unit: str, low: str = "<", high: str = ">=") -> list[tuple]:
    """Bins between edges, with an open one above, and below if open_low."""
    text = lambda x: f"{x:.1f}" if not unit else f"{x:g}"
    tail = f" {unit}" if unit else ""
    out = [(name, label, f"{low} {text(edges[0])}{tail}", None, edges[0], None)] if open_low else []
    out += [(name, label, f"{text(a)} to {text(b)}{tail}", a, b, None) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    top = f"{high} {text(edges[-1])}{tail}" if open_low else f"{text(edges[-1])}+{tail}"
    out.append((name, label, top, edges[-1], None, None))
    return [(*b, first + i) for i, b in enumerate(out)]


def distribution_bins() -> list[tuple]:
    """(metric, label, bin, from, to, category, order) of the 46 bins."""
    halves = [x / 2 for x in range(-2, 9)]
    return [
        *_ranges("total_added_strokes_weather", "Total Added Strokes from Weather", halves, 0, True, ""),
        *_ranges("added_strokes_wind", "Added Strokes from Wind", halves, 100, True, ""),
        *_ranges("observed_average_wind_speed", "Observed Average Wind Speed", [0.0, 3.0, 6.0, 9.0, 12.0, 15.0], 200, False, "mph"),
        *_ranges("observed_average_wind_gust_speed", "Observed Average Wind Gust Speed", [0.0, 5.0, 10.0, 15.0, 20.0, 25.0], 300, False, "mph"),
        *_ranges("observed_temperature", "Observed Temperature", [32.0, 40.0, 50.0, 60.0, 70.0, 80.0, 90.0], 400, True, "F"),
        *(("observed_precipitation", "Observed Precipitation", x, None, None, x, 500 + i) for i, x in enumerate(("No Precipitation", "Precipitation"))),
    ]


METRICS = {
    "total_added_strokes_weather": "total_impact",
    "added_strokes_wind": "wind_impact",
    "observed_average_wind_speed": "observed_wind_mph",
    "observed_average_wind_gust_speed": "observed_wind_gust_mph",
    "observed_temperature": "observed_temp_f",
}


def bin_join(values: DataFrame, bins: DataFrame) -> DataFrame:
    """Bins with counts of values (metric_name, metric_value, category_value); half-open ranges or equal categories.

    Values are joined to the broadcast bins and counted, then the bins are joined to the counts: empty bins stay.
    """
    v, low, high = F.col("metric_value"), F.col("bin_start"), F.col("bin_end")
    inside = F.when(F.col("bin_category").isNotNull(), F.col("category_value") == F.col("bin_category")).otherwise(
        (low.isNull() | (v >= low)) & (high.isNull() | (v < high)) & v.isNotNull()
    )
    counted = values.join(F.broadcast(bins.withColumnRenamed("category", "bin_category")), "metric_name").where(inside).groupBy("sort_order").agg(F.count("*").alias("n"))
    return bins.join(counted, "sort_order", "left").withColumn("rounds_tracked", F.coalesce("n", F.lit(0))).drop("n")


def distribution(base: DataFrame) -> DataFrame:
    """Counts and shares of six metrics over fixed bins; the base is read once."""
    bins = base.sparkSession.createDataFrame(distribution_bins(), "metric_name string, metric_label string, bin_label string, bin_start double, bin_end double, category string, sort_order int")
    none_d, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    values = [F.struct(F.lit(m).alias("metric_name"), F.col(c).alias("metric_value"), none_s.alias("category_value")) for m, c in METRICS.items()]
    values.append(F.struct(F.lit("observed_precipitation").alias("metric_name"), none_d.alias("metric_value"), F.col("precip_flag").alias("category_value")))
    rows = base.select(F.explode(F.array(*values)).alias("v")).select("v.*").where("metric_value is not null or category_value is not null")
    total = F.sum("rounds_tracked").over(Window.partitionBy("metric_name"))
    return bin_join(rows, bins).withColumn("share_of_rounds", S.rounded(F.col("rounds_tracked") / F.nullif(total, F.lit(0)), 6)).drop("category")


def wind_points(base: DataFrame) -> DataFrame:
    """Mean added strokes by buckets of wind speed and gust."""
    parts = []
    for metric, c, edges, first in (("wind_speed", "observed_wind_mph", [3, 6, 9, 12, 15], 0), ("wind_gust", "observed_wind_gust_mph", [5, 10, 15, 20, 25], 100)):
        labels = [f"{a}-{b} mph" for a, b in zip([0, *edges[:-1]], edges, strict=True)] + [f"{edges[-1]}+ mph"]
        order = F.array_position(F.array(*(F.lit(x) for x in labels)), F.col("bucket_label")) - 1 + first
        parts.append(
            base.where(F.col(c).isNotNull() & F.col("wind_impact").isNotNull())
            .select(F.lit(metric).alias("bucket_metric"), S.steps(c, edges, labels).alias("bucket_label"), "wind_impact")
            .withColumn("sort_order", order.cast("int"))
        )
    return parts[0].unionByName(parts[1]).groupBy("bucket_metric", "bucket_label", "sort_order").agg(F.count("*").alias("rounds_tracked"), mean4("wind_impact").alias("avg_added_strokes_from_wind"))


def partial_rollup(base: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Counts and sums that can be added up again, with a sketch of distinct players."""
    return base.groupBy(*keys).agg(
        F.count("*").alias("rounds"),
        *(F.sum(F.col(c).cast("decimal(18,6)")).alias(f"sum_{c}") for c in sums),
        *(F.count(c).alias(f"n_{c}") for c in sums),
        F.hll_sketch_agg("player_key").alias("players_sketch"),
    )


def final_rollup(parts: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Means from partial sums; players is an estimate from the sketches."""
    mean = lambda c: S.rounded(F.sum(f"sum_{c}") / F.nullif(F.sum(f"n_{c}"), F.lit(0)))
    return parts.groupBy(*keys).agg(
        F.sum("rounds").alias("rounds"), *(mean(c).alias(f"avg_{c}") for c in sums), F.hll_sketch_estimate(F.hll_union_agg("players_sketch")).alias("players_estimate")
    )


def weighted_mean(c: str, weight: str) -> Column:
    """Mean weighted by another column, over rows where c is there; the plain mean if weights add up to nothing."""
    x, w = F.col(c).cast("decimal(18,6)"), F.col(weight)
    weights = F.sum(F.when(x.isNotNull(), w))
    return S.rounded(F.coalesce((F.sum(x * w) / F.nullif(weights, F.lit(0))).cast("double"), dmean(c)))


def weighted_rollup(df: DataFrame, keys: Sequence[str], counts: Sequence[str], means: Sequence[str], weight: str = "rounds_scored") -> DataFrame:
    return df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in counts), *(weighted_mean(c, weight).alias(c) for c in means))


def apply_filters(df: DataFrame, wanted: dict[str, Sequence], least: dict[str, int] | None = None) -> DataFrame:
    """Rows whose values are in each list that is given, and at least each floor."""
    for c, values in wanted.items():
        if values:
            df = df.where(F.col(c).isin(*values))
    for c, n in (least or {}).items():
        df = df.where(F.col(c) >= n)
    return df
