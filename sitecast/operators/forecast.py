"""Forecasters, forecast table and holdout error (T3-T6, P12, A8, S15 data).

Both forecasters are per-site aggregates over deduplicated history, so they
run in parallel over sites instead of the reference's per-site Python loop.
The recursions run inside ``aggregate`` (a JVM higher-order function) over a
bounded array: ``window`` values in, ``steps`` values out.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitecast.functions.columns import add_minutes, round6
from sitecast.operators.dedup import union_all
from sitecast.operators.features import latest_n_per_site, sliding_windows, train_eval_split
from sitecast.operators.reshape import impute_site_mean
from sitecast.schema import FORECAST_COLUMNS


def _explode_steps(df: DataFrame, forecasts: Column, last_time: Column, kind: str,
                   step_minutes: int, site: str) -> DataFrame:
    return (df.select(F.col(site), last_time.alias("_last"),
                      F.posexplode(forecasts).alias("_pos", "_f"))
            .select(F.col(site),
                    add_minutes(F.col("_last"), (F.col("_pos") + 1) * step_minutes).alias("measurement_time"),
                    round6(F.col("_f")).alias("vehicle_flow_rate"),
                    F.lit(kind).alias("forecast_type")))


def ma_forecast(d: DataFrame, window: int = 5, steps: int = 5, step_minutes: int = 1,
                divisor: str = "window", site: str = "site_id",
                time: str = "measurement_time", value: str = "vehicle_flow_rate") -> DataFrame:
    """Autoregressive moving average. ``f_k`` = mean of the last
    ``window`` values, each forecast appended and reused; forecasts are
    1..steps x ``step_minutes`` after the site's newest slot.

    ``divisor="window"`` (reference): a site with fewer than ``window`` rows
    counts the missing rows as 0. ``divisor="available"`` averages only the
    rows present. A null flow inside the window gives a null forecast.
    """
    latest = latest_n_per_site(d, window, site, time)
    g = latest.groupBy(site).agg(
        F.max(F.col(time)).alias("_last"),
        F.count(F.lit(1)).alias("_cnt"),
        F.sort_array(F.collect_list(F.struct(F.col("rn"), F.col(value).cast("double").alias("v")))).alias("_pts"))
    cnt = F.col("_cnt")
    if divisor == "window":
        idx = F.sequence(F.lit(window), F.lit(1), F.lit(-1))
        vals = F.transform(idx, lambda r: F.when(r > cnt, F.lit(0.0)).otherwise(
            F.try_element_at(F.col("_pts"), r)["v"]))
    elif divisor == "available":
        idx = F.sequence(F.least(cnt, F.lit(window)).cast("int"), F.lit(1), F.lit(-1))
        vals = F.transform(idx, lambda r: F.try_element_at(F.col("_pts"), r)["v"])
    else:
        raise ValueError(f"divisor must be 'window' or 'available', not {divisor!r}")

    def step(acc, _i):
        tail = F.slice(acc, F.greatest(F.size(acc) - F.lit(window - 1), F.lit(1)), F.lit(window))
        total = F.aggregate(tail, F.lit(0.0), lambda s, x: s + x)
        return F.concat(acc, F.array(total / F.size(tail)))

    grown = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), vals, step)
    forecasts = F.slice(grown, F.size(vals) + 1, F.lit(steps))
    return _explode_steps(g, forecasts, F.col("_last"), "moving_avg", step_minutes, site)


def ar1_coefficients(d: DataFrame, site: str = "site_id", time: str = "measurement_time",
                     value: str = "vehicle_flow_rate", run: str | None = None) -> DataFrame:
    """Per-site least-squares fit of ``v_t = a + b * v_{t-1}`` (closed form,
    one aggregate). Slope is null when the lagged series is constant.

    ``run`` names a column with the number of successive rows of one value that a
    row stands for (``impute_site_mean``); the fit is that of the single rows."""
    w = Window.partitionBy(site).orderBy(F.col(time))
    v = F.col(value).cast("double")
    if run is not None:
        return _ar1_of_runs(d.where(F.col(time).isNotNull()), w, v, site, time, run)
    pairs = d.where(F.col(time).isNotNull()).select(
        F.col(site), F.col(time), v.alias("y"), F.lag(v).over(w).alias("x"))
    return pairs.groupBy(site).agg(
        F.when(F.regr_sxx("y", "x") > 0, F.regr_slope("y", "x")).alias("slope"),
        F.when(F.regr_sxx("y", "x") > 0, F.regr_intercept("y", "x")).alias("intercept"),
        F.max_by(F.col("y"), F.col(time)).alias("last_value"),
        F.max(F.col(time)).alias("last_time"),
        F.regr_count("y", "x").alias("n_pairs"))


def _ar1_of_runs(d: DataFrame, w, v: Column, site: str, time: str, run: str) -> DataFrame:
    """The fit over runs: a run of n rows has n - 1 pairs of its own value, and
    one with the value before it. Values count from the site's first one, so the
    sums stay small and those of a constant series are 0."""
    pairs = d.select(site, time, v.alias("y"), F.lag(v).over(w).alias("x"), F.col(run).alias("_n"),
                     F.first(v, ignorenulls=True).over(w).alias("_c"))
    met, own = F.col("x").isNotNull() & F.col("y").isNotNull(), F.when(F.col("y").isNotNull(), F.col("_n") - 1).otherwise(0)
    one, x, y = F.when(met, 1).otherwise(0), F.col("x") - F.col("_c"), F.col("y") - F.col("_c")

    def total(of_met, of_own):
        return F.sum(F.when(met, of_met).otherwise(0.0) + F.when(own > 0, own * of_own).otherwise(0.0))

    s = pairs.groupBy(site).agg(
        F.sum(one + own).alias("n_pairs"), total(x, y).alias("_x"), total(y, y).alias("_y"),
        total(x * x, y * y).alias("_xx"), total(x * y, y * y).alias("_xy"),
        F.min(F.least(F.when(met, x), F.when(own > 0, y))).alias("_lo"),
        F.max(F.greatest(F.when(met, x), F.when(own > 0, y))).alias("_hi"),
        F.first("_c", ignorenulls=True).alias("_c"),
        F.max_by(F.col("y"), F.col(time)).alias("last_value"), F.max(F.col(time)).alias("last_time"))
    n = F.col("n_pairs")
    sxx = F.when(n > 0, F.col("_xx") - F.col("_x") * F.col("_x") / n)
    slope = F.when((F.col("_lo") < F.col("_hi")) & (sxx > 0), (F.col("_xy") - F.col("_x") * F.col("_y") / n) / sxx)
    return s.withColumn("slope", slope).select(
        site, "slope", F.when(F.col("slope").isNotNull(), F.col("_c") + F.col("_y") / n - F.col("slope") * (F.col("_c") + F.col("_x") / n))
        .alias("intercept"), "last_value", "last_time", "n_pairs")


def ar_recursion(a: Column, b: Column, last: Column, steps: int) -> Column:
    """``f_1 = a + b*last``, ``f_k = a + b*f_{k-1}``; without a slope the last
    value is repeated."""
    def step(acc, _i):
        prev = F.coalesce(F.try_element_at(acc, F.lit(-1)), last)
        nxt = F.when(b.isNull(), last).otherwise(a + b * prev)
        return F.concat(acc, F.array(nxt))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)),
                       F.array_repeat(F.lit(0.0), 0), step)


def ar1_forecast(d: DataFrame, steps: int = 5, step_minutes: int = 1, site: str = "site_id",
                 time: str = "measurement_time", value: str = "vehicle_flow_rate",
                 kind: str = "ar1", run: str | None = None) -> DataFrame:
    """T4(a): learned autoregressive forecaster, AR(1) per site, ``steps``
    recursive steps. Deterministic, unlike the reference's network. ``run`` as
    in ``ar1_coefficients``."""
    c = ar1_coefficients(d, site, time, value, run)
    fc = ar_recursion(F.col("intercept"), F.col("slope"), F.col("last_value"), steps)
    return _explode_steps(c, fc, F.col("last_time"), kind, step_minutes, site)


def arp_forecast(d: DataFrame, order: int = 5, steps: int = 5, step_minutes: int = 1,
                 site: str = "site_id", time: str = "measurement_time",
                 value: str = "vehicle_flow_rate", kind: str = "arp") -> DataFrame:
    """T4(b): AR(p) pooled over all sites, fitted with ``pyspark.ml``
    LinearRegression on lag windows (a distributed fit), then rolled
    forward ``steps`` times with column expressions. A site with fewer than
    ``order`` rows, or any site if nothing could be fitted, repeats its last
    value, as the AR(1) without a slope does."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    wins = sliding_windows(d, order, 1, site, time, value).where(F.col("y").isNotNull())
    lags = [f"w{i}" for i in range(1, order + 1)]
    train = VectorAssembler(inputCols=lags, outputCol="features", handleInvalid="skip").transform(wins)
    fitted = not train.isEmpty()
    if fitted:
        model = LinearRegression(featuresCol="features", labelCol="y", regParam=0.0, standardization=False,
                                 solver="normal").fit(train)
        coef, icpt = [float(x) for x in model.coefficients], float(model.intercept)
    latest = latest_n_per_site(d, order, site, time)
    g = latest.groupBy(site).agg(
        F.max(F.col(time)).alias("_last"),
        F.count(F.lit(1)).alias("_cnt"),
        F.sort_array(F.collect_list(F.struct(F.col("rn"), F.col(value).cast("double").alias("v")))).alias("_pts"))
    repeated = F.array_repeat(F.get("_pts", F.lit(0))["v"], steps)
    if not fitted:
        return _explode_steps(g, repeated, F.col("_last"), kind, step_minutes, site)
    hist = [F.get("_pts", F.lit(order - 1 - i))["v"] for i in range(order)]  # oldest first
    out = []
    for _ in range(steps):
        nxt = F.lit(icpt)
        for cf, h in zip(coef, hist[-order:]):
            nxt = nxt + F.lit(cf) * h
        out.append(nxt)
        hist.append(nxt)
    forecasts = F.when(F.col("_cnt") >= order, F.array(*out)).otherwise(repeated)
    return _explode_steps(g, forecasts, F.col("_last"), kind, step_minutes, site)


def forecast_horizon(d: DataFrame, steps: int = 5, step_minutes: int = 1,
                     site: str = "site_id", time: str = "measurement_time") -> DataFrame:
    """The forecast grid, newest slot + k x step for k = 1..steps."""
    last = d.groupBy(site).agg(F.max(F.col(time)).alias("_last"))
    return (last.select(F.col(site), F.col("_last"), F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
            .select(F.col(site), F.col("step"),
                    add_minutes(F.col("_last"), F.col("step") * step_minutes).alias(time)))


def gate_min_history(latest: DataFrame, min_history: int = 20, site: str = "site_id",
                     time: str = "measurement_time") -> DataFrame:
    """T7 as a filter on the newest rows of each site (at least ``min_history``
    of them must be asked for): a count over the site's few rows, which reuses
    the shuffle of the top-n."""
    n = F.count(F.col(time)).over(Window.partitionBy(site))
    return latest.withColumn("_n_slots", n).where(F.col("_n_slots") >= min_history).drop("_n_slots")


def model_grid(d: DataFrame, history: int = 20, site: str = "site_id", time: str = "measurement_time",
               value: str = "vehicle_flow_rate", runs: bool = False) -> DataFrame:
    """The model's input: each site's ``history`` newest rows on the grid of all
    their slots, missing cells filled with the site's mean (W1 -> T2); ``runs``
    as in ``impute_site_mean``."""
    return impute_site_mean(latest_n_per_site(d, history, site, time), site, time, value, runs=runs)


def recent_actuals(d: DataFrame, history: int = 20, k: int = 5, site: str = "site_id",
                   time: str = "measurement_time", value: str = "vehicle_flow_rate") -> DataFrame:
    """R4 on the model input: the ``k`` newest slots of the site-mean imputed
    grid built from each site's ``history`` newest rows, tagged ``actual``."""
    grid = impute_site_mean(latest_n_per_site(d, history, site, time), site, time, value, keep_last=k)
    return grid.select(F.col(site), F.col(time), F.col(value), F.lit("actual").alias("forecast_type"))


def forecast_table(d: DataFrame, methods: Sequence[str] = ("ar1", "moving_avg"),
                   window: int = 5, steps: int = 5, history: int = 20, actual_k: int = 5,
                   min_history: int = 20, step_minutes: int = 1) -> DataFrame:
    """Forecasts of the chosen methods plus the recent actuals, for the
    sites with enough history; sorted by site, time, type. All parts start from
    the newest rows of each site, so the cost does not follow the length of the
    history; the learned methods fit on the model grid, AR(1) on its runs of
    filled cells."""
    newest = latest_n_per_site(d, max(history, min_history)).drop("rn")
    elig = gate_min_history(newest, min_history)
    parts = []
    for m in methods:
        if m == "moving_avg":
            parts.append(ma_forecast(elig, window, steps, step_minutes))
        elif m == "ar1":
            parts.append(ar1_forecast(model_grid(elig, history, runs=True), steps, step_minutes, run="run"))
        elif m == "arp":
            parts.append(arp_forecast(model_grid(elig, history), window, steps, step_minutes))
        else:
            raise ValueError(f"unknown forecast method {m!r}")
    if actual_k:
        parts.append(recent_actuals(elig, history, actual_k))
    return union_all(p.select(*FORECAST_COLUMNS) for p in parts)


def missing_sites(wanted: DataFrame, d: DataFrame, site: str = "site_id") -> DataFrame:
    """Requested sites without any reading (they get no forecast)."""
    return wanted.select(site).distinct().join(d.select(site).distinct(), site, "left_anti")


def sorted_forecasts(df: DataFrame) -> DataFrame:
    return df.orderBy("site_id", "measurement_time", "forecast_type")


def _pair_moments(y: str, x: str) -> list[Column]:
    """Count, means and central moments of the pairs (y, x): what the fit and
    the error of any line over them follow from."""
    return [F.regr_count(y, x).alias("_n"), F.regr_avgx(y, x).alias("_mx"), F.regr_avgy(y, x).alias("_my"),
            F.regr_sxx(y, x).alias("_sxx"), F.regr_syy(y, x).alias("_syy"), F.regr_sxy(y, x).alias("_sxy")]


def _line_mse(slope: Column, intercept: Column) -> Column:
    """Mean squared error of the line over the pairs of a row of moments; with
    no slope the prediction repeats x."""
    b, a = F.coalesce(slope, F.lit(1.0)), F.when(slope.isNull(), 0.0).otherwise(intercept)
    spread = (F.col("_syy") - 2 * b * F.col("_sxy") + b * b * F.col("_sxx")) / F.col("_n")
    return F.when(F.col("_n") > 0, F.greatest(F.lit(0.0), spread) + F.pow(F.col("_my") - a - b * F.col("_mx"), 2))


def _fitted_on(rows: DataFrame, train: Column, *keys: str) -> DataFrame:
    """Adds _b, _a: the least-squares line of the training row of each key.
    There are at most two rows of moments a key."""
    of = Window.partitionBy(*keys)
    slope = F.when(F.col("_sxx") > 0, F.col("_sxy") / F.col("_sxx"))
    rows = rows.withColumn("_b", F.max(F.when(train, slope)).over(of))
    return rows.withColumn("_a", F.max(F.when(train, F.col("_my") - F.col("_b") * F.col("_mx"))).over(of))


def backtest_mse(d: DataFrame, window: int = 5, train_fraction: float = 0.5,
                 site: str = "site_id", time: str = "measurement_time",
                 value: str = "vehicle_flow_rate") -> DataFrame:
    """One-step holdout error per site and split, for the moving average
    and for an AR(1) fitted on the site's training windows only. One aggregate
    per site and split holds all that the fit and both errors need."""
    wins = train_eval_split(sliding_windows(d, window, 1, site, time, value), train_fraction)
    ma = sum((F.col(f"w{i}") for i in range(2, window + 1)), F.col("w1")) / window
    moments = wins.groupBy(site, "split").agg(
        F.count(F.lit(1)).alias("n_windows"), F.avg(F.pow(F.col("y") - ma, 2)).alias("_ma"), *_pair_moments("y", f"w{window}"))
    fitted = _fitted_on(moments, F.col("split") == "train", site)
    return fitted.select(site, "split", "n_windows", round6(F.col("_ma")).alias("mse_moving_avg"),
                         round6(_line_mse(F.col("_b"), F.col("_a"))).alias("mse_ar1"))


def loss_history(d: DataFrame, window: int = 5, train_fraction: float = 0.5,
                 site: str = "site_id", time: str = "measurement_time",
                 value: str = "vehicle_flow_rate") -> DataFrame:
    """Loss per model cycle (the reference writes one row per cycle).

    A cycle is one day of targets: the AR(1) pooled over all sites is fitted
    on the windows whose target falls in the first ``train_fraction`` of the
    day and evaluated on the rest; ``measurement_time`` is the cycle's newest
    target slot. One aggregate per cycle and half, no per-cycle ranking.
    """
    wins = sliding_windows(d, window, 1, site, time, value)
    cycle = F.date_trunc("day", F.col("target_time")).cast("timestamp_ntz")
    train = F.hour("target_time") < F.lit(24 * train_fraction)
    moments = wins.groupBy(cycle.alias("_cycle"), train.alias("_train")).agg(
        F.max("target_time").alias("_newest"), *_pair_moments("y", f"w{window}"))
    error = _line_mse(F.col("_b"), F.col("_a"))
    return (_fitted_on(moments, F.col("_train"), "_cycle").groupBy("_cycle").agg(
        round6(F.max(F.when(F.col("_train"), error))).alias("train_loss"),
        round6(F.max(F.when(~F.col("_train"), error))).alias("eval_loss"),
        F.max("_newest").alias("measurement_time"))
        .drop("_cycle"))


def newest_loss(d: DataFrame, window: int = 5, train_fraction: float = 0.5, site: str = "site_id",
                time: str = "measurement_time", value: str = "vehicle_flow_rate",
                newest: dt.datetime | None = None) -> DataFrame:
    """The loss row of the newest day alone, from that day's rows and the
    ``window`` rows of each site before it; no row if no site has a window in it.
    ``newest``: the newest time, if it is known."""
    last = d.agg(F.max(time)).scalar() if newest is None else F.lit(newest).cast("timestamp_ntz")
    day = F.date_trunc("day", last).cast("timestamp_ntz")
    before = latest_n_per_site(d.where(F.col(time) < day), window, site, time).drop("rn")
    return loss_history(before.unionByName(d.where(F.col(time) >= day)), window, train_fraction, site, time, value)


def newest_cycle(loss: DataFrame, time: str = "measurement_time") -> DataFrame:
    """The loss row of the newest cycle."""
    return loss.orderBy(F.desc_nulls_last(time)).limit(1)
