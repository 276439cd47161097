"""Joins of a large table with a small derived one (slot statistics, model
coefficients, the site dimension)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.session import cut_lineage

# Broadcast only below this many rows of the small side. The rows joined
# this way are narrow (a key and a few numbers), so the bound keeps a
# broadcast well under the executors' memory.
BROADCAST_MAX_ROWS = 2_000_000


def lookup_join(big: DataFrame, small: DataFrame, on, how: str = "left",
                max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``small`` only after checking its size.

    The small side is computed once into the shared folder (a checkpoint), and
    its rows are counted there. Within ``max_rows`` it is broadcast, and the
    large side is never shuffled. Beyond it the join stays a shuffle join
    whose skewed partitions AQE splits. Static size estimates cannot make this
    choice, because an aggregate's output is estimated as large as its input.

    Meant for small sides with a cheap upstream (a pruned scan plus a partial
    aggregate: slot statistics, the site table), which is then read once here
    and not again. Small sides with a bound known in advance (one row per epoch
    or per day) are broadcast directly where they are built.
    """
    small = cut_lineage(small)
    if small.count() <= max_rows:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
