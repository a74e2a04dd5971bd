"""A model over scenarios and grids: rows times settings as one exploded relation, one transform, conditional aggregates.

A setting replaces columns of a row by values or expressions. Settings are exploded beside the rows, so that the plan holds the
model once however many there are. What belongs to one row is brought together again by its keys; the partial aggregation
does most of that before the shuffle, as a row's settings stand side by side. A model with transform_settings predicts all settings
of a row where the row is, and nothing is exploded or shuffled.

A model is anything with transform(df) that adds a prediction column: BoostedTrees, or a PipelineModel of pyspark.ml.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .analysis import r, top_bottom
from .core import dmean
from .ranked import exact_quantiles, joined
from .shared import stored

#: columns to replace, and by what
Setting = dict[str, object]


def _value(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def with_settings(df: DataFrame, settings: dict[str, Setting], name: str = "setting") -> DataFrame:
    """Each row once for each setting, with the columns that it replaces and a column that names it."""
    columns = list(dict.fromkeys(c for s in settings.values() for c in s))
    if unknown := [c for c in columns if c not in df.columns]:
        raise ValueError(f"no such columns: {unknown}")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    structs = [F.struct(F.lit(n).alias("__name"), *((_value(s[c]) if c in s else F.col(c)).cast(kinds[c]).alias(c) for c in columns)) for n, s in settings.items()]
    exploded = df.withColumn("__s", F.explode(F.array(*structs)))
    return exploded.select(*(F.col(f"__s.{c}").alias(c) if c in columns else F.col(c) for c in df.columns), F.col("__s.__name").alias(name))


def _widened(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Whole-numbered columns as doubles, so that a setting's fractions are kept."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.col(c).cast("double") for c in columns if kinds[c] not in ("string", "double")})


def _beside(df: DataFrame, model, settings: dict[str, Setting], carried: Sequence) -> DataFrame | None:
    """(carried, a prediction for each setting, by its name) by models that predict all settings of a row at once; others: None."""
    columns = sorted({c for s in settings.values() for c in s})
    if unknown := [c for c in columns if c not in df.columns]:
        raise ValueError(f"no such columns: {unknown}")
    return model.transform_settings(_widened(df, columns), settings, carried) if hasattr(model, "transform_settings") else None


def scenario_predictions(df: DataFrame, model, settings: dict[str, Setting], keys: Sequence[str]) -> DataFrame:
    """(keys, a prediction for each setting, by its name). Keys tell the rows of df apart."""
    if (wide := _beside(df, model, settings, keys)) is not None:
        return wide
    columns = {c for s in settings.values() for c in s}
    scored = model.transform(with_settings(_widened(df, sorted(columns)), settings, "__setting")).select(*keys, "__setting", "prediction")
    return scored.groupBy(*keys).agg(*(F.max(F.when(F.col("__setting") == n, F.col("prediction"))).alias(n) for n in settings))


def score_scenarios(df: DataFrame, model, references: dict[str, Setting], keys: Sequence[str]) -> DataFrame:
    """df with predicted, and predicted_<name>_reference and <name>_impact for each reference, in one pass of the model."""
    names = {f"predicted_{n}_reference": s for n, s in references.items()}
    impacts = {f"{n}_impact": F.col("predicted") - F.col(f"predicted_{n}_reference") for n in references}
    # columns that a setting replaces keep their types in the result
    kept = df.withColumn("__kept", F.struct(*df.columns))
    if (wide := _beside(kept, model, {"predicted": {}, **names}, ["__kept"])) is not None:
        return wide.select("__kept.*", "predicted", *names).withColumns(impacts)
    wide = scenario_predictions(df, model, {"predicted": {}, **names}, keys)
    return df.join(wide, list(keys)).select(*df.columns, "predicted", *names).withColumns(impacts)


def pdp_curve(df: DataFrame, model, column: str, grid: Sequence[float], at: dict[str, float] | None = None) -> DataFrame:
    """(grid_value, n, mean, std and quantiles of the predictions) with column set to each value of the grid."""
    at = {"median": 0.5, "p10": 0.1, "p90": 0.9} if at is None else at
    settings = {str(i): {column: float(x)} for i, x in enumerate(grid)}
    if (wide := _beside(df, model, settings, [])) is not None:
        points = F.array(*(F.struct(F.lit(float(x)).alias("grid_value"), F.col(str(i)).alias("prediction")) for i, x in enumerate(grid)))
        return _by_grid(stored(wide).select(F.explode(points).alias("e")).select("e.grid_value", "e.prediction"), "prediction", at)
    scored = model.transform(with_settings(_widened(df, [column]), settings, "__setting"))
    return _by_grid(stored(scored.select(_grid_value(grid), "prediction")), "prediction", at)


def _grid_value(grid: Sequence[float]) -> Column:
    return F.element_at(F.array(*(F.lit(float(x)) for x in grid)), F.col("__setting").cast("int") + 1).alias("grid_value")


def _by_grid(d: DataFrame, value: str, at: dict[str, float]) -> DataFrame:
    sums = d.groupBy("grid_value").agg(F.count(value).alias("n"), r(dmean(value)).alias("mean"), r(F.stddev_pop(value)).alias("std"))
    return sums.join(exact_quantiles(d, ["grid_value"], value, at, 4), "grid_value")


def effect_pdp(df: DataFrame, model, grid: Sequence[float], actual: Callable[[float], Setting], reference: Callable[[float], Setting], keys: Sequence[str], at: dict[str, float] | None = None) -> DataFrame:
    """(grid_value, n, mean, std and quantiles) of the effect at each value of the grid: the prediction with actual(value)
    less that with reference(value), row by row. References that are alike for the whole grid are predicted once."""
    at = {"median": 0.5, "p10": 0.1, "p90": 0.9} if at is None else at
    settings, pairs = {}, []
    known: dict[str, str] = {}

    def setting(s: Setting) -> str:
        said = repr(sorted((c, str(v)) for c, v in s.items()))
        if said not in known:
            known[said] = f"s{len(known)}"
            settings[known[said]] = s
        return known[said]

    for x in grid:
        pairs.append((float(x), setting(actual(x)), setting(reference(x))))
    wide = stored(scenario_predictions(df, model, settings, keys).select(*settings))
    effects = F.array(*(F.struct(F.lit(x).alias("grid_value"), (F.col(a) - F.col(b)).alias("effect")) for x, a, b in pairs))
    return _by_grid(wide.select(F.explode(effects).alias("e")).select("e.grid_value", "e.effect"), "effect", at)


def course_response(df: DataFrame, model, course: str, reference: Setting, shifts: dict[str, Setting], observed: dict[str, str], keys: Sequence[str]) -> DataFrame:
    """A row for each course: rows, means of what was observed (name -> column), and mean_<name> and median_<name> of each
    shift's effect against the reference."""
    settings = {"__reference": reference, **shifts}
    seen = df.select("*", F.struct(F.col(course), *(F.col(c).alias(n) for n, c in observed.items())).alias("__seen"))
    wide = _beside(seen, model, settings, ["__seen"])
    if wide is None:
        wide = seen.select(*keys, "__seen").join(scenario_predictions(df, model, settings, keys), list(keys))
    # what follows is read once for the means, and once for each median
    d = stored(wide.select("__seen.*", *((F.col(n) - F.col("__reference")).alias(n) for n in shifts)))
    out = d.groupBy(course).agg(F.count("*").alias("n"), *(r(dmean(n)).alias(n) for n in observed), *(r(dmean(n)).alias(f"mean_{n}") for n in shifts))
    for n in shifts:
        out = joined(out, exact_quantiles(d, [course], n, {f"median_{n}": 0.5}, 4), [course])
    return out


def most_and_least(response: DataFrame, course: str, effect: str, n: int = 20) -> DataFrame:
    """The n courses that respond most to a shift, and the n that respond least."""
    return top_bottom(response, f"mean_{effect}", [course], n)


def envelope(df: DataFrame, model, column: str, thresholds: Sequence[float], keys: Sequence[str], name: str) -> DataFrame:
    """df with predictions of a model of trees that never fall as column grows: the largest prediction at the row's value and at
    all thresholds of the trees below it. Between thresholds predictions are constant, so this is exact for any value.
    """
    settings = {f"t{i}": {column: F.least(F.col(column).cast("double"), F.lit(float(x)))} for i, x in enumerate(sorted(thresholds))}
    scored = model.transform(with_settings(_widened(df, [column]), {"own": {}, **settings}, "__setting"))
    best = scored.groupBy(*keys).agg(F.max("prediction").alias(name))
    return df.join(best, list(keys)).select(*df.columns, name)
