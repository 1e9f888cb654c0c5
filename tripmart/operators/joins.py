"""Join helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Decision per DataFrame object (and bound): a frame reused across queries is
# counted once.  Weak keys, so nothing outlives the frames themselves.
_CHECKED: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()

# A taxi-zone lookup has a few hundred rows; anything far beyond this is not a
# dimension we are willing to replicate to every executor.
DEFAULT_BROADCAST_ROW_LIMIT = 200_000


def bounded_broadcast(
    df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROW_LIMIT, bound_by: DataFrame | None = None
) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows, else ``df`` unchanged.

    The probe asks for one row of a constant column after ``max_rows`` others,
    which Spark runs as an incremental take (one partition first, more only if
    needed), so it reads at most about ``max_rows`` rows, never the whole
    table, and hands one row to Python.  ``bound_by`` names a cheaper frame with at least as many rows
    (e.g. the fact side of a key lookup join) to probe instead of ``df``
    itself, so a join never has to run just to learn that it is too big.
    Above the bound the caller's join falls back to whatever Catalyst/AQE
    choose (sort-merge or shuffled hash), which scales with the data instead
    of the driver heap.
    """
    known = _CHECKED.get(df, {})
    if max_rows not in known:
        probe = df if bound_by is None else bound_by
        known[max_rows] = probe.select(F.lit(1).alias("_")).offset(max_rows).isEmpty()
        _CHECKED[df] = known
    return F.broadcast(df) if known[max_rows] else df
