"""gold → monthly borough-pair aggregate, and merging of partial aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import MEASURE_SCALE, PLACES, exact_units, fixed_parts, stable_sum
from ..schemas import AGG, AGG_KEYS
from .merge import SIGN


def monthly_borough_agg(gold: DataFrame, scale: int | None = MEASURE_SCALE) -> DataFrame:
    """One row per (year, month, pickup borough, dropoff borough).

    ``groupBy`` plans a partial hash aggregate before the shuffle, so each task
    ships at most one row per group: a borough pair holding a third of all trips
    costs the same shuffle bytes as any other.  NULL boroughs (zone misses)
    form their own group.
    """
    return gold.groupBy(*AGG_KEYS).agg(
        F.count("trip_id").alias("total_trips"),
        stable_sum("total_amount", scale).alias("total_revenue"),
        stable_sum("trip_distance", scale).alias("total_trip_distance"),
        F.sum("passenger_count").cast("bigint").alias("total_passengers"),
    )


def merge_partial_aggs(existing: DataFrame, delta: DataFrame, scale: int | None = MEASURE_SCALE) -> DataFrame:
    """Add a delta aggregate onto an existing one (union by name, re-sum).

    Note this is additive: applying the same delta twice counts it twice.  The
    pipeline therefore recomputes touched months instead (see ``plans``).
    """
    return (
        existing.select(*AGG.fieldNames())
        .unionByName(delta.select(*AGG.fieldNames()))
        .groupBy(*AGG_KEYS)
        .agg(
            F.sum("total_trips").cast("bigint").alias("total_trips"),
            stable_sum("total_revenue", scale).alias("total_revenue"),
            stable_sum("total_trip_distance", scale).alias("total_trip_distance"),
            F.sum("total_passengers").cast("bigint").alias("total_passengers"),
        )
    )


# Sums of the maintained aggregate, from gold columns, and whether they are money or distances (fixed-point).
MAINTAINED = {
    "total_revenue": ("total_amount", True),
    "total_trip_distance": ("trip_distance", True),
    "total_passengers": ("passenger_count", False),
}


def _signed_state(rows: DataFrame, sign: Column) -> DataFrame:
    """Per group: trips, and for each measure its exact signed sum and the signed number of values it has."""
    sums = [F.sum(F.when(F.col("trip_id").isNotNull(), sign).otherwise(0)).alias("total_trips"), F.sum(sign).alias("group_rows")]
    for name, (column, fixed) in MAINTAINED.items():
        known = F.when(F.col(column).isNotNull(), sign).otherwise(0)
        if fixed:
            high, low, odd = fixed_parts(F.col(column))
            odd = F.when(odd.isNotNull(), F.raise_error(F.lit(f"{column}: no fixed-point value")).cast("bigint"))
            total = exact_units(F.sum(F.coalesce(odd, high * sign)), F.sum(low * sign))
        else:
            total = F.sum(F.col(column) * sign).cast("decimal(38,0)")
        sums += [F.coalesce(total, F.lit(0).cast("decimal(38,0)")).alias(f"{name}_units"), F.sum(known).alias(f"{name}_known")]
    return rows.groupBy(*AGG_KEYS).agg(*sums)


def agg_state(gold: DataFrame) -> DataFrame:
    """The monthly aggregate in the form that can be kept up to date: exact sums and counts of known values."""
    return _signed_state(gold, F.lit(1).cast("bigint"))


def agg_delta(changes: DataFrame) -> DataFrame:
    """What a MERGE changes in ``agg_state``, from its replaced (-1) and written (+1) rows (``MergeResult.changes``)."""
    return _signed_state(changes, F.col(SIGN).cast("bigint"))


def add_states(state: DataFrame, delta: DataFrame) -> DataFrame:
    """``state`` brought up to date by ``delta``; groups without rows go.

    Both sides are aggregates (a row a group), so the work follows the touched
    and stored groups and never gold: a month with one changed trip costs its
    few groups.  Sums are exact, so the result is that of a full recomputation.
    """
    sums = [c for c in state.columns if c not in AGG_KEYS]
    types = dict(state.dtypes)
    added = state.unionByName(delta).groupBy(*AGG_KEYS).agg(*[F.sum(c).cast(types[c]).alias(c) for c in sums])
    return added.filter(F.col("group_rows") > 0)


def state_to_agg(state: DataFrame, scale: int = MEASURE_SCALE) -> DataFrame:
    """The aggregate's columns from its state; a sum without known values is NULL."""

    def total(name: str, fixed: bool) -> Column:
        units = F.col(f"{name}_units")
        if fixed:
            value = F.round(units.cast("decimal(38,6)") / F.lit(10**PLACES).cast("decimal(8,0)"), scale).cast("double")
        else:
            value = units.cast("bigint")
        return F.when(F.col(f"{name}_known") > 0, value).alias(name)

    return state.select(*AGG_KEYS, "total_trips", *[total(name, fixed) for name, (_, fixed) in MAINTAINED.items()])


def with_avg_revenue(agg: DataFrame, scale: int = MEASURE_SCALE) -> DataFrame:
    """Add ``avg_revenue = total_revenue / total_trips``, derived on read, never stored.

    Storing an average would make merges of partial aggregates wrong; deriving
    it from the two additive measures keeps every refresh exact.
    """
    avg = F.col("total_revenue") / F.when(F.col("total_trips") > 0, F.col("total_trips"))
    return agg.withColumn("avg_revenue", F.round(avg, scale))


def empty_agg(spark: SparkSession) -> DataFrame:
    """A typed, empty aggregate frame."""
    return spark.createDataFrame([], AGG)


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    """Single-row ``MAX(column) AS watermark``; NULL when ``df`` is empty."""
    return df.agg(F.max(column).alias("watermark"))
