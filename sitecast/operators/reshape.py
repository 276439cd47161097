"""Pivot, unpivot, dense grids and gap imputation.

A dense grid (every site at every slot) is the wide table the reference
computes, in long form; its size is sites x slots by definition. Only its rows
by site and day are joined and shuffled: the readings of a site and day travel
as one array, and each such row meets the slots of its day where it lies. No
value holds more than a day, or the newest rows of a site, so the cost follows
the cells of the grid, which are never shuffled or sorted here.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitecast.functions.columns import TIME_FORMAT, format_time, round6


def _cells(df: DataFrame, site: str, time: str, value: str) -> DataFrame:
    return df.where(F.col(time).isNotNull()).select(site, time, F.col(value).cast("double").alias(value))


def _slot_days(slots: DataFrame, group: Sequence[str], time: str) -> DataFrame:
    """One row per group and day: its slots, with what else ``slots`` tells of each."""
    rest = [c for c in slots.columns if c not in (time, *group)]
    return slots.groupBy(*group, F.to_date(time).alias("_day")).agg(
        F.sort_array(F.collect_list(F.struct(time, *rest))).alias("_slots"))


def _packed(cells: DataFrame, group: Sequence[str], site: str, time: str, value: str) -> DataFrame:
    """One row per group, site and day: its slots, and under each the rows of the slot."""
    return (cells.groupBy(*group, site, time).agg(
                F.collect_list(F.struct(value)).alias("_rows"), F.sum(value).alias("_sum"), F.count(value).alias("_n"))
            .groupBy(*group, site, F.to_date(time).alias("_day")).agg(
                F.collect_list(F.struct(time, "_rows")).alias("_own"), F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))
            .withColumn("_times", F.col(f"_own.{time}")).withColumn("_rows", F.col("_own._rows")).drop("_own"))


def _unpacked(site_days: DataFrame, slot_days: DataFrame, group: Sequence[str], time: str, value: str) -> DataFrame:
    """The cells of the site days: every slot of the day, left joined with the
    site's own rows of it."""
    keep = [c for c in site_days.columns if c not in ("_day", "_times", "_rows")]
    slotted = (site_days.join(F.broadcast(slot_days), [*group, "_day"])
               .select(*keep, "_times", "_rows", F.explode("_slots").alias("_slot")))
    at = F.array_position("_times", F.col(f"_slot.{time}")).cast("int") - 1
    return (slotted.select(*keep, "_slot.*", F.explode_outer(F.get("_rows", at)).alias("_cell"))
            .withColumn(value, F.col("_cell")[value]).drop("_cell"))


def _day_grid(sites: DataFrame, slots: DataFrame, cells: DataFrame, site: str, time: str, value: str,
              group: Sequence[str] = ()) -> DataFrame:
    """Every row of ``sites`` at every row of ``slots`` (of its ``group``), left
    joined with ``cells`` on (group, site, slot). Sites are copied to each day and
    joined with their own readings of that day, packed into one row; only then does
    a day's list of slots (one broadcast row per group and day) turn them into cells."""
    slot_days = _slot_days(slots, group, time)
    if group:
        days = slot_days.groupBy(*group).agg(F.collect_set("_day").alias("_days"))
        site_days = sites.join(F.broadcast(days), list(group)).withColumn("_day", F.explode("_days")).drop("_days")
    else:
        site_days = sites.withColumn("_day", F.explode(slots.agg(F.collect_set(F.to_date(time))).scalar()))
    own = _packed(cells, group, site, time, value).drop("_sum", "_n")
    return _unpacked(site_days.join(own, [*group, site, "_day"], "left"), slot_days, group, time, value)


def _site_grid(cells: DataFrame, slots: DataFrame, site: str, time: str, value: str) -> DataFrame:
    """As ``_day_grid`` with the site's mean as _site_mean, for the few newest rows of
    each site: they fit one row per site, so the grid needs no join and its cells
    lie together by site, as the models want them. They sort it, so it has a
    number of partitions of its own: AQE would merge them by the size of the few
    rows that the grid comes from. A null site matches no reading."""
    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mean = F.when(F.sum("_n") > 0, F.sum("_sum") / F.sum("_n"))
    sites = (_packed(cells.repartition(max(n // 2, 1), site), (), site, time, value)
             .groupBy(site).agg(mean.alias("_site_mean"), F.collect_list(F.struct("_day", "_times", "_rows")).alias("_own"))
             .withColumn("_own", F.when(F.col(site).isNotNull(), F.col("_own")))
             .withColumn("_days", slots.agg(F.collect_set(F.to_date(time))).scalar()))
    at = lambda d: F.get("_own", F.array_position("_own._day", d).cast("int") - 1)
    days = F.transform("_days", lambda d: F.struct(
        d.alias("_day"), at(d)["_times"].alias("_times"), at(d)["_rows"].alias("_rows")))
    site_days = sites.select(site, "_site_mean", F.explode(days).alias("_of")).select(site, "_site_mean", "_of.*")
    return _unpacked(site_days, _slot_days(slots, (), time), (), time, value)


def _site_runs(cells: DataFrame, slots: DataFrame, site: str, time: str, value: str) -> DataFrame:
    """As ``_site_grid``, but successive slots without a row of the site are one
    row with the newest time of them; ``run`` tells of how many slots. A site has
    at most twice its own rows and one, however many slots there are. The slots'
    numbers come from their sorted list, one value each. A null site is one run. The number of partitions is set as in ``_site_grid``: AQE
    would merge them by the size of the rows before the sorts and runs."""
    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of, by_time = Window.partitionBy(site), Window.partitionBy(site).orderBy(time)
    numbered = F.transform("_all", lambda t, k: F.struct(t.alias(time), (k + 1).alias("_i"), F.get("_all", k - 1).alias("_before")))
    index = slots.agg(F.sort_array(F.collect_list(time)).alias("_all")).select(F.inline(numbered))
    end = slots.agg(F.struct(F.max(time).alias("at"), F.count(F.lit(1)).cast("int").alias("n"))).scalar()
    own = (cells.join(F.broadcast(index), time).repartition(max(n // 2, 1), site).withColumn("_end", end)
           .select(site, time, value, "_i", "_before", "_end", F.avg(value).over(of).alias("_site_mean"),
                   F.lag("_i", 1, 0).over(by_time).alias("_last"), F.lead("_i").over(by_time).isNull().alias("_newest")))
    some, none = F.col(site).isNotNull(), F.lit(None).cast("double")

    def row(at, v, run):
        return F.struct(F.col(at).alias(time), v.alias(value), run.alias("run"))

    runs = F.array(
        row("_before", none, F.when(some, F.col("_i") - 1 - F.col("_last")).otherwise(0)),
        row(time, F.col(value), F.when(some, 1).otherwise(0)),
        row("_end.at", none, F.when(F.col("_newest"), F.col("_end.n") - F.when(some, F.col("_i")).otherwise(0)).otherwise(0)))
    return (own.select(site, "_site_mean", F.explode(runs).alias("_run")).where(F.col("_run.run") > 0)
            .select(site, "_site_mean", "_run.*"))


def impute_site_mean(latest: DataFrame, site: str = "site_id",
                     time: str = "measurement_time", value: str = "vehicle_flow_rate",
                     keep_last: int | None = None, runs: bool = False) -> DataFrame:
    """grid = sites x (union of the slots present in ``latest``); a
    missing cell gets the site's own mean over its rows, then 0.

    ``keep_last`` keeps only the k newest grid slots (R4's recent actuals).
    Output: site, time, value (double), ``imputed`` flag.

    ``runs`` gives the same grid with successive slots that a site has no row in
    as one row, with the newest of their times and their number in ``run`` (1
    for the site's own rows): its rows follow those of ``latest``, not sites x
    slots.
    """
    if keep_last and runs:
        raise ValueError("keep_last and runs exclude each other")
    cells = _cells(latest, site, time, value)
    slots = cells.select(time).distinct()
    if keep_last:
        sites = cells.groupBy(site).agg(F.avg(value).alias("_site_mean"))
        newest = slots.orderBy(F.desc(time)).limit(keep_last).agg(F.collect_list(time)).scalar()
        grid = sites.withColumn(time, F.explode(newest)).join(cells, [site, time], "left")
    else:
        grid = (_site_runs if runs else _site_grid)(cells, slots, site, time, value)
    return grid.select(
        site, time, round6(F.coalesce(F.col(value), F.col("_site_mean"), F.lit(0.0))).alias(value),
        F.col(value).isNull().alias("imputed"), *(["run"] if runs else []))


def impute_slot_mean(d: DataFrame, site: str = "site_id", time: str = "measurement_time",
                     value: str = "vehicle_flow_rate", truncate_int: bool = False) -> DataFrame:
    """grid = sites x all slots of ``d``; a missing cell gets that slot's
    mean across sites, then 0 (also when the whole slot is null).

    ``truncate_int`` reproduces the reference's cast of the mean into an int
    column (14.9 -> 14); the default keeps the double.
    """
    cells = _cells(d, site, time, value)
    slots = cells.groupBy(time).agg(F.avg(value).alias("_fill"))
    if truncate_int:
        slots = slots.withColumn("_fill", F.col("_fill").cast("int").cast("double"))
    return _day_grid(cells.select(site).distinct(), slots, cells, site, time, value).select(
        site, time, round6(F.coalesce(F.col(value), F.col("_fill"), F.lit(0.0))).alias(value),
        F.col(value).isNull().alias("imputed"))


def gap_census(grid: DataFrame, value: str = "vehicle_flow_rate",
               site: str = "site_id", time: str = "measurement_time") -> DataFrame:
    """Nulls before imputation, after, and filled. Sites are summed up
    first, so the distinct counts are plain sums: every site has every slot."""
    per_site = grid.groupBy(site).agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(F.col("imputed")).alias("before"),
        F.count_if(F.col(value).isNull()).alias("after"))
    return per_site.agg(
        F.count(F.lit(1)).alias("n_sites"), F.max("cells").alias("n_slots"), F.sum("cells").alias("n_cells"),
        F.sum("before").alias("nulls_before"), F.sum("after").alias("nulls_after"),
    ).withColumn("filled", F.col("nulls_before") - F.col("nulls_after"))


def slot_calendar(start: dt.datetime, slots: int, step: dt.timedelta = dt.timedelta(hours=1)) -> list[str]:
    """Pivot labels of a fixed calendar: nothing is collected to find them."""
    return [(start + i * step).strftime("%Y-%m-%d %H:%M:%S") for i in range(slots)]


def calendar_of(d: DataFrame, time: str = "measurement_time",
                step: dt.timedelta = dt.timedelta(hours=1)) -> list[str]:
    """The calendar from the first to the last slot of ``d`` (two values)."""
    lo, hi = d.agg(F.min(time), F.max(time)).first()
    return [] if lo is None else slot_calendar(lo, int((hi - lo) / step) + 1, step)


def pivot_sites(d: DataFrame, values: Sequence[str] | None = None, site: str = "site_id",
                time: str = "measurement_time", value: str = "vehicle_flow_rate") -> DataFrame:
    """One row per site, one column per slot label
    (``yyyy-MM-dd HH:mm:ss``, sorted), empty cells null.

    Input must be unique per (site, slot) -- run ``dedup_latest`` first --
    which makes ``first`` deterministic. A slot that no label names exactly is
    an error rather than a dropped value.
    """
    # Columns come out in the order of the value list, so sort it up front
    # (re-selecting hundreds of columns afterwards costs more than the pivot).
    values = sorted(values) if values is not None else calendar_of(d, time)
    label = format_time(time)
    known = label.isin(values) & (F.col(time) == F.date_trunc("second", F.col(time)).cast("timestamp_ntz"))
    checked = F.when(known, label).otherwise(F.raise_error(
        F.concat(F.lit("no pivot label for slot "), F.col(time).cast("string"))))
    return (d.where(F.col(time).isNotNull())
            .withColumn("_label", checked)
            .groupBy(site).pivot("_label", values).agg(F.first(F.col(value))))


def pivot_strict(df: DataFrame, values: Sequence[str] | None = None, site: str = "site_id",
                 time: str = "measurement_time", value: str = "vehicle_flow_rate") -> DataFrame:
    """R2: like ``pivot_sites`` but a duplicate (site, slot) is an error. The
    count and the value come from one aggregate."""
    once = df.groupBy(site, time).agg(F.first(value).alias(value), F.count(F.lit(1)).alias("_n"))
    checked = once.withColumn(value, F.when(F.col("_n") > 1, F.raise_error(
        F.lit("duplicate (site_id, measurement_time) in a strict pivot"))).otherwise(F.col(value))).drop("_n")
    return pivot_sites(checked, values if values is not None else calendar_of(df, time), site, time, value)


def unpivot_sites(wide: DataFrame, site: str = "site_id", time: str = "measurement_time",
                  value: str = "vehicle_flow_rate") -> DataFrame:
    """Wide -> long, nulls kept (like a melt); labels back to timestamps.

    Each row explodes one array of (label, value) structs. With hundreds of
    slot columns this runs several times faster than ``DataFrame.unpivot``
    (whose Expand node carries one projection per column), and it is written
    as one SQL expression: building hundreds of Column objects one call at a
    time costs more than the query."""
    cols = [c for c in wide.columns if c != site]

    def cell(c):
        label = c.replace("'", "''")
        ref = c.replace("`", "``")
        return f"named_struct('_label', '{label}', '{value}', CAST(`{ref}` AS DOUBLE))"
    cells = "explode(array({})) AS _cell".format(", ".join(cell(c) for c in cols))
    long = wide.selectExpr(f"`{site}`", cells).select(site, "_cell.*")
    return long.select(site, F.to_timestamp_ntz(F.col("_label"), F.lit(TIME_FORMAT)).alias(time),
                       F.col(value))


def fill_grid(cells: DataFrame, group: str, site: str = "site_id", time: str = "measurement_time",
              value: str = "vehicle_flow_rate") -> DataFrame:
    """Per ``group`` value: grid = its sites x its slots; a missing cell gets
    the group's slot mean, then 0; ``imputed`` tells which. ``cells`` is unique
    per (group, site, slot); a null value counts as missing."""
    slots = cells.groupBy(group, time).agg(F.avg(value).alias("_fill"))
    return _day_grid(cells.select(group, site).distinct(), slots, cells, site, time, value, [group]).select(
        group, site, time, F.coalesce(F.col(value), F.col("_fill"), F.lit(0.0)).alias(value),
        F.col(value).isNull().alias("imputed"))


def merge_epochs(cells: DataFrame, n_epochs: int = 4, last_window=None, first_window: int = 1,
                 epoch: str = "epoch", site: str = "site_id", time: str = "measurement_time",
                 value: str = "vehicle_flow_rate") -> DataFrame:
    """Window ``o`` covers epochs ``o .. o + n - 1``, from window 1 on
    (the reference's first output is that of epoch n). Per (site, slot) the
    newest observed value wins over older ones and over any fill; the window's
    grid is then filled once with its slot means, then 0. ``cells`` holds null
    values where an epoch has no reading."""
    w = F.explode(F.sequence(F.col(epoch) - (n_epochs - 1), F.col(epoch))).alias("window_id")
    # shuffled once, before each cell is copied into its windows
    near = cells.select(epoch, site, time, F.col(value).cast("double").alias(value)).repartition(site)
    tagged = near.select("*", w)
    if last_window is None:
        last_window = cells.agg(F.max(epoch)).scalar() - (n_epochs - 1)
    merged = (tagged.where((F.col("window_id") >= first_window) & (F.col("window_id") <= last_window))
              .groupBy("window_id", site, time)
              .agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(epoch))).alias(value)))
    return fill_grid(merged, "window_id", site, time, value).withColumn(value, round6(F.col(value))).drop("imputed")
