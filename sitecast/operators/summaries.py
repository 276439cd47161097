"""Subtotals with distinct counts, mergeable sketches, and change feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# -- grouping sets, cube, rollup ---------------------------------------------------

def subtotals(df: DataFrame, sets: Sequence[Sequence[str]], dims: Sequence[str],
              aggregates: Mapping[str, Column]) -> DataFrame:
    """Aggregates over several groupings in one pass (an Expand below a partial
    aggregate). ``<dim>_all`` is true where the row is a subtotal over all
    values of ``dim``, so a subtotal is told from a real null in the data."""
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dims])
    return grouped.agg(*[c.alias(n) for n, c in aggregates.items()],
                       *[F.grouping(c).cast("boolean").alias(f"{c}_all") for c in dims])


def rollup_sets(dims: Sequence[str]) -> list[list[str]]:
    return [list(dims[:k]) for k in range(len(dims), -1, -1)]


def cube_sets(dims: Sequence[str]) -> list[list[str]]:
    return [[c for i, c in enumerate(dims) if not mask >> i & 1] for mask in range(1 << len(dims))]


# -- sketches ----------------------------------------------------------------------

#: log2 of the registers of a distinct-count sketch; the relative standard
#: error is 1.04 / sqrt(2^lg_k) at most.
LG_K = 12
#: Items kept for each level of a quantile sketch; the rank error is below 1.7 %
#: at 200.
KLL_K = 200


def day_sketches(df: DataFrame, day: Column, distinct: str, value: str, lg_k: int = LG_K, k: int = KLL_K) -> DataFrame:
    """day, n, distinct_state, value_state: one row of bounded states a day.
    States of any days can be merged later without the rows."""
    return df.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(distinct, lg_k).alias("distinct_state"),
        F.expr(f"kll_sketch_agg_bigint(cast({value} AS BIGINT), {k})").alias("value_state"))


def merge_sketches(states: DataFrame, *keys: Column) -> DataFrame:
    """The states of all rows of a group merged into one."""
    return states.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.hll_union_agg("distinct_state").alias("distinct_state"),
        F.expr("kll_merge_agg_bigint(value_state)").alias("value_state"))


def distinct_estimate() -> Column:
    return F.hll_sketch_estimate("distinct_state")


def quantile_estimate(q: float) -> Column:
    return F.expr(f"kll_sketch_get_quantile_bigint(value_state, {q}D)")


# -- multiset difference -----------------------------------------------------------

def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """kind, then the columns: what turns one state of a table into another.
    Rows that both hold equally often cancel out (EXCEPT ALL, which treats nulls
    as equal). New rows are ``inserted``, or ``changed_to`` if their key was there
    before; rows that went are ``removed``, or ``changed_from`` if their key is
    still there. before - removed - changed_from + inserted + changed_to = after,
    repeated rows included."""
    cols = before.columns
    after = after.select(*cols)
    new, old = after.exceptAll(before), before.exceptAll(after)

    def kinds(rows: DataFrame, other: DataFrame, alone: str, both: str) -> DataFrame:
        there = other.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct().withColumn("_there", F.lit(True))
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        return rows.join(there, same, "left").select(
            F.when(F.col("_there"), F.lit(both)).otherwise(F.lit(alone)).alias("kind"), *cols)

    return kinds(new, before, "inserted", "changed_to").unionByName(kinds(old, after, "removed", "changed_from"))


def unchanged(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows of both states, as often as both hold them (INTERSECT ALL)."""
    return before.intersectAll(after.select(*before.columns))
