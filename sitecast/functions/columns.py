"""Column expressions (all JVM-side built-ins, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# The string format of forecast times, and the version
# number's place in a forecast file name (``..._model_<n>_prediction...``).
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
VERSION_PATTERN = r"^.*model_(.*?)_prediction"

DECIMALS = 6


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round6(c) -> Column:
    """Results are compared at 6 decimals: sums taken in a different order
    differ in the last bits."""
    return F.round(col(c), DECIMALS)


def quality_flag(c="data_quality") -> Column:
    """``'good'`` (case-sensitive) -> 1; anything else, null included -> 0."""
    return F.when(col(c) == F.lit("good"), 1).otherwise(0)


def type_label(c="forecast_type") -> Column:
    """``actual`` -> ``Actual``; everything else, null included -> ``Prediction``."""
    return F.when(col(c) == F.lit("actual"), F.lit("Actual")).otherwise(F.lit("Prediction"))


def display_name(c="forecast_type") -> Column:
    # The chart names of the two forecasters.
    return (F.when(col(c) == F.lit("gru"), F.lit("GRU"))
            .when(col(c) == F.lit("moving_avg"), F.lit("Moving Avg"))
            .otherwise(col(c)))


def strict_int(c, kind: str = "int") -> Column:
    """Integer text only (optional sign, digits); ``60.0`` or ``6.55`` -> null,
    out of the range of ``kind`` (int or long) -> null."""
    s = F.trim(col(c))
    return F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast(kind))


def strict_float(c) -> Column:
    s = F.trim(col(c))
    return F.when(s.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
                  s.try_cast("float"))


def iso_time(c) -> Column:
    """ISO-8601 text -> timestamp_ntz in UTC wall-clock; an offset such as
    ``+01:00`` is honoured (shifted to UTC); bad text -> null."""
    s = F.trim(col(c))
    ltz = F.try_to_timestamp(s)
    return ltz.cast("timestamp_ntz")


def parse_time_strict(c, fmt: str = TIME_FORMAT) -> Column:
    """Strict pattern parse; fractional seconds or any other deviation -> null."""
    return F.try_to_timestamp(col(c), F.lit(fmt)).cast("timestamp_ntz")


def format_time(c, fmt: str = TIME_FORMAT) -> Column:
    return F.date_format(col(c), fmt)


def version_from_name(name_col) -> Column:
    """Version number embedded in a forecast file name; -1 when the part
    between ``model_`` and ``_prediction`` is not an integer."""
    part = F.regexp_extract(col(name_col), VERSION_PATTERN, 1)
    return F.coalesce(strict_int(part), F.lit(-1))


def average_rank(order_col, partition: list[str] | None = None) -> Column:
    """Average rank (ties share the mean of their positions: 1.5, 1.5, 3),
    as a double; null stays null.

    Only meant for pre-aggregated inputs (one row per cycle/slot): without a
    partition it is a single-task window.
    """
    partition = partition or []
    order = Window.partitionBy(*partition).orderBy(col(order_col).asc_nulls_last())
    ties = Window.partitionBy(*partition, col(order_col))
    r = F.rank().over(order) + (F.count(F.lit(1)).over(ties) - 1) / 2.0
    return F.when(col(order_col).isNotNull(), r.cast("double"))


def add_minutes(ts, minutes) -> Column:
    """timestamp_ntz + n minutes (n a column or an int)."""
    m = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return F.timestamp_add("MINUTE", m, col(ts))
