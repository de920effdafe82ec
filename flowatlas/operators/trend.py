"""Trend forecast and hold-out comparison, per group, as aggregations.

The linear trend is ordinary least squares of the annual value on the year,
fitted on every year but the last ``holdout`` ones and *not* refitted. It
is computed in closed form from per-group sums of (x, y, xy, xx) with
x = year - first year of the group, so one aggregation fits thousands of
series at once (``group_cols``) and, for integer-valued counts, every sum
is exact - the fit does not depend on the order Spark adds rows in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Series and model labels of the forecast tables.
OBSERVED = "observed"
FORECAST = "linear_trend_forecast_exploratory"
NAIVE = "naive_last_observed"
LINEAR = "linear_trend"


def _grouped(annual: DataFrame, group_cols) -> tuple[DataFrame, list[str]]:
    """Without group columns the whole table is one group, keyed ``_g``."""
    g = list(group_cols or [])
    if g:
        return annual, g
    return annual.withColumn("_g", F.lit(0)), ["_g"]


def _ranked(annual: DataFrame, g: list[str], holdout: int) -> DataFrame:
    """Flag the last ``holdout`` years of each group as hold-out."""
    w = Window.partitionBy(*g).orderBy(F.col("year").desc())
    return annual.withColumn("_is_holdout", F.row_number().over(w) <= F.lit(int(holdout)))


def _line(sums: DataFrame) -> DataFrame:
    """Slope and intercept from the sums; null for fewer than two training years."""
    slope = F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"),
                         F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
    return sums.withColumn("slope", slope).withColumn(
        "intercept", F.try_divide(F.col("sy") - F.col("slope") * F.col("sx"), F.col("n")))


def ols_fit(annual: DataFrame, group_cols: list[str] | None = None, holdout: int = 3) -> DataFrame:
    """Per group: x0 (first year), slope, intercept (in x = year - x0),
    the last training year and its value, and the last observed year."""
    annual, g = _grouped(annual, group_cols)
    r = _ranked(annual, g, holdout)
    t = (r.withColumn("_x0", F.min("year").over(Window.partitionBy(*g)))
         .withColumn("_x", (F.col("year") - F.col("_x0")).cast("double")))
    tr = F.col("_is_holdout") == F.lit(False)
    y = F.col("value_observed")
    agg = t.groupBy(*g).agg(
        F.min("_x0").alias("x0"),
        F.sum(F.when(tr, F.lit(1.0))).alias("n"),
        F.sum(F.when(tr, F.col("_x"))).alias("sx"),
        F.sum(F.when(tr, y)).alias("sy"),
        F.sum(F.when(tr, F.col("_x") * y)).alias("sxy"),
        F.sum(F.when(tr, F.col("_x") * F.col("_x"))).alias("sxx"),
        F.max(F.when(tr, F.col("year"))).alias("last_train_year"),
        F.max_by(F.when(tr, y), F.when(tr, F.col("year"))).alias("last_train_value"),
        F.max("year").alias("last_year"),
    )
    return _line(agg)


def _predict(year_col) -> F.Column:
    return F.col("intercept") + F.col("slope") * (year_col - F.col("x0")).cast("double")


def trend_forecast(annual: DataFrame, horizon: int = 5, holdout: int = 3,
                   group_cols: list[str] | None = None) -> DataFrame:
    """Observed rows plus ``horizon`` forecast years after the last year."""
    g = list(group_cols or [])
    fit = ols_fit(annual, g, holdout)
    future = fit.select(*g, "x0", "slope", "intercept", F.explode(
        F.sequence(F.col("last_year") + 1, F.col("last_year") + int(horizon))).alias("year"))
    fc = future.select(*g, "year", _predict(F.col("year")).alias("value_observed"),
                       F.lit(FORECAST).alias("series"))
    obs = annual.select(*g, "year", F.col("value_observed").cast("double").alias("value_observed"),
                        F.lit(OBSERVED).alias("series"))
    return obs.unionByName(fc)


def forecast_compare(annual: DataFrame, holdout: int = 3,
                     group_cols: list[str] | None = None) -> DataFrame:
    """Hold-out MAE of the naive last-value forecast and of the linear
    trend, per group. The fit's sums are window aggregates over the group's
    annual rows (a handful of years per group), so each hold-out row sees its
    group's slope and intercept without a join."""
    keep = list(group_cols or [])
    annual, g = _grouped(annual, group_cols)
    w = Window.partitionBy(*g)
    t = _ranked(annual, g, holdout)
    t = t.withColumn("_x", (F.col("year") - F.min("year").over(w)).cast("double"))
    tr = F.col("_is_holdout") == F.lit(False)
    y = F.col("value_observed")
    t = t.select(
        *g, "year", "_x", "_is_holdout", y,
        F.sum(F.when(tr, F.lit(1.0))).over(w).alias("n"),
        F.sum(F.when(tr, F.col("_x"))).over(w).alias("sx"),
        F.sum(F.when(tr, y)).over(w).alias("sy"),
        F.sum(F.when(tr, F.col("_x") * y)).over(w).alias("sxy"),
        F.sum(F.when(tr, F.col("_x") * F.col("_x"))).over(w).alias("sxx"),
        F.max_by(F.when(tr, y), F.when(tr, F.col("year"))).over(w).alias("last_train_value"))
    t = _line(t.filter(F.col("_is_holdout")))
    err = t.select(*g, F.abs(y - F.col("last_train_value")).alias(NAIVE),
                   F.abs(y - (F.col("intercept") + F.col("slope") * F.col("_x"))).alias(LINEAR))
    mae = err.groupBy(*g).agg(F.avg(NAIVE).alias(NAIVE), F.avg(LINEAR).alias(LINEAR))
    # the smaller error wins, the naive forecast on a tie or without a trend
    winner = (F.when(F.col(LINEAR) < F.col(NAIVE), F.lit(LINEAR)).when(F.col(NAIVE).isNotNull(), F.lit(NAIVE)))
    mae = mae.withColumn("winner", winner)
    return mae.unpivot([*g, "winner"], [NAIVE, LINEAR], "model", "holdout_mae").select(*keep, "model", "holdout_mae", "winner")
