"""Which rows take part: training and scoring filters, valid ranges, events to fetch, dates; and columns made ready for models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .core import dmean
from .ranked import exact_quantiles
from .shared import stored

#: what a category that training has not seen becomes
MISSING = "__MISSING__"


def steps(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row: how many rows there are (rows), and after each condition on top of those before it. One pass."""
    so_far, counts = F.lit(True), []
    for name, condition in conditions.items():
        so_far = so_far & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(so_far).alias(name))
    return df.agg(F.count("*").alias("rows"), *counts)


def training_conditions(required: Sequence[str], min_holes: int = 18, weather: str = "weather_available", holes: str = "hole_count") -> dict[str, Column]:
    """With weather, with enough holes, with all required values: for steps(), or one after the other for a filter."""
    there = F.lit(True)
    for c in required:
        there = there & F.col(c).isNotNull()
    return {"with_weather": F.col(weather), "enough_holes": F.col(holes) >= min_holes, "kept": there}


def usable_rounds(df: DataFrame, required: Sequence[str], min_holes: int = 18, weather: str = "weather_available", holes: str = "hole_count") -> DataFrame:
    """Rows that meet all training_conditions."""
    for condition in training_conditions(required, min_holes, weather, holes).values():
        df = df.where(condition)
    return df


def in_ranges(df: DataFrame, ranges: dict[str, tuple[object, object]]) -> DataFrame:
    """Rows whose columns all lie in their ranges, ends included; nulls lie in none."""
    for c, (low, high) in ranges.items():
        df = df.where(F.col(c).between(low, high))
    return df


def eligible_events(df: DataFrame, status: str, wanted: Sequence[str], date: str, before, more: Column | None = None) -> DataFrame:
    """Events of wanted states that are over."""
    out = df.where(F.col(status).isin(*wanted) & (F.col(date) < before))
    return out if more is None else out.where(more)


def to_refetch(df: DataFrame, status: str, wanted: Sequence[str], date: str, first, last, fetched: str, before) -> DataFrame:
    """Events of wanted states in a window of dates that were not fetched since a time, or never."""
    return df.where(F.col(status).isin(*wanted) & F.col(date).between(first, last) & (F.col(fetched).isNull() | (F.col(fetched) < before)))


def on_dates(df: DataFrame, time: str, dates: DataFrame, date: str = "date") -> DataFrame:
    """Rows whose time is on one of the dates; df's columns."""
    wanted = dates.select(F.col(date).cast("date").alias("__date")).distinct()
    return df.join(wanted, F.col(time).cast("date") == F.col("__date"), "left_semi")


def options(df: DataFrame, columns: Sequence[str], but: dict[str, object] | None = None) -> DataFrame:
    """Distinct values to choose from, without those that stand for nothing."""
    for c, v in (but or {}).items():
        df = df.where(F.col(c) != v)
    return df.select(*columns).distinct()


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df with columns as doubles; what is no number is null."""
    return df.withColumns({c: S.to_double(c) for c in columns})


def engineered(df: DataFrame, wind: str = "wind_mean", gust: str = "gust_mean", length: str = "round_total_hole_length", rating: str = "player_rating", precip: str = "precip_sum") -> DataFrame:
    """df with interactions of wind and gust with length and rating, squared and centred rating, long_course (over the median
    length), and the logarithm of precipitation."""
    df = stored(df)
    g = df.agg(dmean(rating).alias("__mean_rating")).join(F.broadcast(exact_quantiles(df, [], length, {"__mid_length": 0.5})))  # one row each
    w, u, x, y = (S.rounded(wind), S.rounded(gust), F.col(length), F.col(rating))
    made = {
        "wind_x_length": S.rounded(w * x, 2), "gust_x_length": S.rounded(u * x, 2), "wind_x_rating": S.rounded(w * y, 2), "rating_squared": y * y,
        "rating_centred": S.rounded(y - F.col("__mean_rating"), 4), "long_course": x > F.col("__mid_length"), "log_precip": S.rounded(F.log1p(F.greatest(F.col(precip), F.lit(0))), 4),
    }
    return df.join(F.broadcast(g)).withColumns(made).drop("__mean_rating", "__mid_length")


def known_categories(df: DataFrame, train: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """df with a category that train does not have, or null, as MISSING."""
    seen = train.select(F.col(column).alias("__seen")).where("__seen is not null").distinct()
    out = df.join(seen, df[column] == seen["__seen"], "left")
    return out.withColumn(name or column, F.coalesce("__seen", F.lit(MISSING))).drop("__seen")
